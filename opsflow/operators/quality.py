"""Data-quality rules run as one fused aggregate, the report and the gate.

Rules over single rows, the row count and the newest date are all measured by
one ``df.agg``; each uniqueness or reference rule adds one ``groupBy``, which is kept until
its samples are taken. Samples of the row rules take one further pass for those that
list rows and one for those that list values, only if such a rule failed.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from opsflow.functions.dates import age_hours, parse_timestamp
from opsflow.functions.numeric import lenient_double
from opsflow.functions.text import starts_with_match

# The closed sets of the report; so are the rule ids, descriptions and message texts below.
CRITICAL, HIGH, MEDIUM, LOW = SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
PASS, FAIL, WARNING, SKIPPED = "PASS", "FAIL", "WARNING", "SKIPPED"
SAMPLE_SIZE = 5

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("severity", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_checked", T.LongType()),
        T.StructField("rows_failed", T.LongType()),
        T.StructField("failure_pct", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("sample_failures", T.StringType()),
    ]
)


@dataclass(frozen=True)
class CheckResult:
    rule_id: str
    description: str
    severity: str
    status: str
    rows_checked: int
    rows_failed: int = 0
    failure_pct: float = 0.0
    message: str = ""
    samples: tuple = ()

    def as_row(self) -> tuple:
        return (
            self.rule_id,
            self.description,
            self.severity,
            self.status,
            self.rows_checked,
            self.rows_failed,
            round(self.failure_pct, 2),
            self.message,
            str(list(self.samples[:SAMPLE_SIZE])),
        )


@dataclass(frozen=True)
class Rule:
    """One check.

    ``failing`` builds the row predicate (True = row fails) from the schema.
    ``measure`` builds one aggregate over the table, judged by ``judge``.
    ``unique`` names a column that must not repeat. ``outside`` holds a reference
    table too large for a literal set. ``check`` is a free function on the table.
    Exactly one of the five is set.
    """

    rule_id: str
    description: str
    severity: str
    failing: Callable[[T.StructType], Column] | None = None
    measure: Callable[[T.StructType], Column] | None = None
    judge: Callable[["Rule", int, object], CheckResult] | None = None
    unique: str | None = None
    outside: tuple[str, DataFrame, str] | None = None
    check: Callable[[DataFrame], CheckResult] | None = None
    column: str | None = None
    sample_of: Column | None = None
    distinct_samples: bool = False
    fail_text: str = "{n} row(s) failed"
    pass_text: str = "All rows pass"
    tags: tuple[str, ...] = field(default_factory=tuple)


def not_null(column: str, severity: str = CRITICAL) -> Rule:
    """Fails on NULL, and on NaN in a floating-point column."""

    def failing(schema: T.StructType) -> Column:
        c = F.col(column)
        floating = isinstance(schema[column].dataType, (T.FloatType, T.DoubleType))
        return c.isNull() | F.isnan(c) if floating else c.isNull()

    return Rule(
        f"not_null_{column}",
        f"Column '{column}' must not contain NULLs",
        severity,
        failing=failing,
        column=column,
        fail_text="{n} NULL(s) found",
        pass_text="All values present",
        tags=("completeness",),
    )


def is_unique(column: str, severity: str = CRITICAL) -> Rule:
    """Every member of a repeated value fails; NULLs count as equal."""
    return Rule(
        f"unique_{column}",
        f"Column '{column}' must be unique",
        severity,
        unique=column,
        column=column,
        distinct_samples=True,
        fail_text=f"{{n}} duplicate row(s) on '{column}'",
        pass_text="All values unique",
        tags=("uniqueness",),
    )


def in_range(column: str, low: float, high: float, severity: str = HIGH) -> Rule:
    """Inclusive bounds; NULL and text that is no number pass."""

    def failing(schema: T.StructType) -> Column:
        value = lenient_double(F.col(column))
        return F.coalesce(~F.isnan(value) & ((value < low) | (value > high)), F.lit(False))

    return Rule(
        f"range_{column}",
        f"Column '{column}' must be between {low} and {high}",
        severity,
        failing=failing,
        column=column,
        fail_text=f"{{n}} value(s) outside [{low}, {high}]",
        pass_text="All in range",
        tags=("validity",),
    )


def matches_regex(column: str, pattern: str, severity: str = MEDIUM) -> Rule:
    """Non-NULL values must match from their first character on."""

    def failing(schema: T.StructType) -> Column:
        return F.coalesce(~starts_with_match(F.col(column), pattern), F.lit(False))

    return Rule(
        f"regex_{column}",
        f"Column '{column}' must match pattern '{pattern}'",
        severity,
        failing=failing,
        column=column,
        fail_text="{n} value(s) fail pattern match",
        pass_text="All match pattern",
        tags=("validity", "format"),
    )


def referential_integrity(
    column: str, allowed: Collection | DataFrame, severity: str = HIGH, allowed_column: str | None = None
) -> Rule:
    """Non-NULL values must be in ``allowed``: a small collection, or a reference table of any size."""
    base = Rule(
        f"ref_int_{column}",
        f"Column '{column}' values must be in allowed set",
        severity,
        column=column,
        distinct_samples=True,
        fail_text="{n} unexpected value(s)",
        pass_text="All values valid",
        tags=("consistency",),
    )
    if isinstance(allowed, DataFrame):
        return replace(base, outside=(column, allowed, allowed_column or column))
    values = sorted(allowed, key=str)

    def failing(schema: T.StructType) -> Column:
        c = F.col(column)
        return F.coalesce(~c.isin(values), F.lit(False)) if values else c.isNotNull()

    return replace(base, failing=failing)


def row_count_threshold(minimum: int, maximum: int | None = None, severity: str = CRITICAL) -> Rule:
    wanted = f">= {minimum}" if maximum is None else f"{minimum}–{maximum}"

    def judge(rule: Rule, total: int, actual: object) -> CheckResult:
        failed = actual < minimum or (maximum is not None and actual > maximum)
        return _all_or_nothing(rule, total, failed, f"Got {actual:,} rows (expected {wanted})")

    return Rule(
        "row_count",
        f"Row count must be {wanted}",
        severity,
        measure=lambda schema: F.count(F.lit(1)),
        judge=judge,
        tags=("completeness",),
    )


def freshness(column: str, run_ts: datetime, max_age_hours: float = 24, severity: str = HIGH) -> Rule:
    """The newest date must be at most ``max_age_hours`` old; no readable date at all is a WARNING."""

    def measure(schema: T.StructType) -> Column:
        is_text = isinstance(schema[column].dataType, T.StringType)
        newest = F.max(parse_timestamp(F.col(column), is_text))
        return F.struct(
            F.date_format(newest, "yyyy-MM-dd HH:mm").alias("at"), age_hours(newest, run_ts).alias("age")
        )

    def judge(rule: Rule, total: int, found: object) -> CheckResult:
        if found["at"] is None:
            return CheckResult(
                "freshness", f"'{column}' freshness", severity, WARNING, total, message="No parseable dates found"
            )
        return _all_or_nothing(
            rule, total, found["age"] > max_age_hours, f"Latest record: {found['at']} ({found['age']:.1f}h ago)"
        )

    return Rule(
        f"freshness_{column}",
        f"'{column}' must be refreshed within {max_age_hours}h",
        severity,
        measure=measure,
        judge=judge,
        column=column,
        tags=("timeliness",),
    )


def predicate_rule(rule_id: str, description: str, severity: str, failing: Column, sample_of: Column | None = None) -> Rule:
    """A caller's own row predicate, fused with the built-in rules."""
    return Rule(
        rule_id,
        description,
        severity,
        failing=lambda schema: F.coalesce(failing, F.lit(False)),
        sample_of=sample_of,
    )


def table_rule(rule_id: str, description: str, severity: str, check: Callable[[DataFrame], CheckResult]) -> Rule:
    """A caller's own function of the whole table."""
    return Rule(rule_id, description, severity, check=check)


@dataclass(frozen=True)
class QualityReport:
    dataset: str
    row_count: int
    run_ts: datetime | None
    results: tuple[CheckResult, ...]

    @property
    def failed(self) -> list[CheckResult]:
        """Failures sorted by the severity's name."""
        return sorted((r for r in self.results if r.status == FAIL), key=lambda r: r.severity)

    @property
    def passed(self) -> list[CheckResult]:
        return [r for r in self.results if r.status == PASS]

    @property
    def critical_failures(self) -> list[CheckResult]:
        return [r for r in self.results if r.status == FAIL and r.severity == CRITICAL]

    @property
    def overall_pass(self) -> bool:
        return not self.critical_failures

    @property
    def score(self) -> float:
        return round(len(self.passed) / len(self.results) * 100, 1) if self.results else 0.0

    def results_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([r.as_row() for r in self.results], RESULT_SCHEMA)

    def summary_frame(self, spark) -> DataFrame:
        return self.results_frame(spark).agg(
            F.count("*").alias("checks"),
            F.count_if(F.col("status") == PASS).alias("passed"),
            F.count_if(F.col("status") == FAIL).alias("failed"),
            F.count_if((F.col("status") == FAIL) & (F.col("severity") == CRITICAL)).alias("critical_failures"),
            F.lit(self.score).alias("score"),
            F.lit(PASS if self.overall_pass else FAIL).alias("overall_status"),
            F.lit(self.row_count).cast("bigint").alias("rows_scanned"),
        )

    def write_csv(self, spark, path: str) -> None:
        self.results_frame(spark).write.mode("overwrite").option("header", True).csv(path)

    def raise_on_critical(self, strict: bool = False) -> None:
        """Raises if a CRITICAL rule failed; ``strict`` also blocks on a CRITICAL rule that could not run."""
        blocking = (FAIL, SKIPPED) if strict else (FAIL,)
        ids = [r.rule_id for r in self.results if r.severity == CRITICAL and r.status in blocking]
        if ids:
            raise ValueError(f"Data quality CRITICAL failures in '{self.dataset}': {ids}")


def run_suite(
    df: DataFrame, dataset: str, rules: Sequence[Rule], key: str | None = None, run_ts: datetime | None = None
) -> QualityReport:
    """Runs ``rules`` over ``df``.

    ``key`` stands for the row position: samples come in its order, and a
    ``not_null`` rule reports its values. A rule whose column is missing, or
    whose own code raises, is SKIPPED and the others run on.
    """
    skipped: dict[int, str] = {}
    measures: dict[int, Column] = {}
    for i, rule in enumerate(rules):
        try:
            if rule.column is not None and rule.column not in df.columns:
                raise KeyError(rule.column)
            if rule.failing is not None:
                measures[i] = F.count_if(rule.failing(df.schema))
            elif rule.measure is not None:
                measures[i] = rule.measure(df.schema)
        except Exception as error:  # a broken rule must not stop the suite
            skipped[i] = f"Error during check: {error}"
    measures = _analysable(df, measures, skipped)

    found = fused_measures(df, measures).first()
    total = found["_total"]
    results: dict[int, CheckResult] = {}
    grouped: dict[int, DataFrame] = {}
    for i, rule in enumerate(rules):
        if i in skipped:
            results[i] = CheckResult(rule.rule_id, rule.description, rule.severity, SKIPPED, total, message=skipped[i])
            continue
        try:
            if rule.failing is not None:
                results[i] = _counted(rule, total, found[f"m{i}"])
            elif rule.measure is not None:
                results[i] = rule.judge(rule, total, found[f"m{i}"])
            elif rule.unique is not None or rule.outside is not None:
                grouped[i] = failing_groups(df, rule, key).persist(StorageLevel.MEMORY_AND_DISK)
                results[i] = _counted(rule, total, _sum_rows(grouped[i]))
            else:
                results[i] = rule.check(df)
        except Exception as error:
            results[i] = CheckResult(
                rule.rule_id, rule.description, rule.severity, SKIPPED, total, message=f"Error during check: {error}"
            )

    failed = [i for i, r in results.items() if r.status == FAIL]
    sampled = failing_samples(df, rules, failed, key, grouped)
    if sampled is not None:
        picked = sorted(sampled.collect(), key=lambda r: r["place"])
        for i in failed:
            results[i] = replace(results[i], samples=tuple(r["value"] for r in picked if r["rule"] == i))
    for frame in grouped.values():
        frame.unpersist()
    return QualityReport(dataset, total, run_ts, tuple(results[i] for i in range(len(rules))))


def fused_measures(df: DataFrame, measures: dict[int, Column]) -> DataFrame:
    """All row-level and table-level measures in a single aggregate."""
    return df.agg(F.count(F.lit(1)).alias("_total"), *[m.alias(f"m{i}") for i, m in measures.items()])


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every row-level rule, and the others with the ids of the rules they break."""
    broken = F.array_compact(
        F.array(*[F.when(r.failing(df.schema), F.lit(r.rule_id)) for r in rules if r.failing is not None])
    )
    marked = df.withColumn("broken_rules", broken)
    return (
        marked.where(F.size("broken_rules") == 0).drop("broken_rules"),
        marked.where(F.size("broken_rules") > 0),
    )


def _analysable(df: DataFrame, measures: dict[int, Column], skipped: dict[int, str]) -> dict[int, Column]:
    """Drops measures Spark cannot analyse (say, an unknown column in a caller's predicate)."""
    kept = {}
    for i, measure in measures.items():
        try:
            df.agg(measure).schema
            kept[i] = measure
        except Exception as error:
            skipped[i] = f"Error during check: {str(error).splitlines()[0]}"
    return kept


def _sum_rows(counted: DataFrame) -> int:
    return counted.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]


def _counted(rule: Rule, total: int, failed: int) -> CheckResult:
    return CheckResult(
        rule.rule_id,
        rule.description,
        rule.severity,
        FAIL if failed else PASS,
        total,
        failed,
        failed / total * 100 if total else 0.0,
        rule.fail_text.format(n=failed) if failed else rule.pass_text,
    )


def _all_or_nothing(rule: Rule, total: int, failed: bool, message: str) -> CheckResult:
    return CheckResult(
        rule.rule_id,
        rule.description,
        rule.severity,
        FAIL if failed else PASS,
        total,
        int(failed),
        100.0 if failed else 0.0,
        message,
    )


def failing_groups(df: DataFrame, rule: Rule, key: str | None) -> DataFrame:
    """The values that break a uniqueness or reference rule: value, row_count, and ``at``, the first position."""
    column = rule.unique if rule.unique is not None else rule.outside[0]
    values = df.groupBy(column).agg(F.count("*").alias("row_count"), F.min(_position(key, column)).alias("at"))
    if rule.unique is not None:
        broken = values.where("row_count > 1")
    else:
        _, allowed, allowed_column = rule.outside
        reference = allowed.select(F.col(allowed_column).alias("_allowed"))
        broken = values.where(F.col(column).isNotNull()).join(reference, F.col(column) == F.col("_allowed"), "left_anti")
    return broken.select(F.col(column).cast("string").alias("value"), "row_count", "at")


def failing_samples(
    df: DataFrame, rules: Sequence[Rule], failed: Sequence[int], key: str | None, groups: Mapping[int, DataFrame] | None = None
) -> DataFrame | None:
    """Up to five samples (rule, value, place) of each failed rule; ``groups`` holds ``failing_groups`` already made.

    Each input task cuts every rule to five rows before the shuffle, so a rule
    that fails on most of the table costs no more than one that fails rarely.
    """
    frames = []
    plain = [i for i in failed if rules[i].failing is not None and not rules[i].distinct_samples]
    grouped = [i for i in failed if rules[i].failing is not None and rules[i].distinct_samples]
    if plain:
        frames.append(_failing_values(df, rules, plain, key))
    if grouped:
        frames.append(_failing_values(df, rules, grouped, key).groupBy("rule", "value").agg(F.min("at").alias("at")))
    for i in failed:
        if rules[i].unique is not None or rules[i].outside is not None:
            broken = (groups or {}).get(i)
            broken = failing_groups(df, rules[i], key) if broken is None else broken
            frames.append(broken.select(F.lit(i).alias("rule"), "value", "at"))
    if not frames:
        return None
    order = Window.partitionBy("rule").orderBy("at", "value")
    every = reduce(DataFrame.unionByName, [f.select("rule", "value", "at") for f in frames])
    return every.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_SIZE).drop("at")


def _failing_values(df: DataFrame, rules: Sequence[Rule], which: Sequence[int], key: str | None) -> DataFrame:
    entries = []
    for i in which:
        rule = rules[i]
        shown = rule.sample_of
        if shown is None:
            column = rule.column if not rule.rule_id.startswith("not_null_") else key
            shown = F.col(column) if column else F.lit(None)
        entry = F.struct(
            F.lit(i).alias("rule"), shown.cast("string").alias("value"), _position(key, rule.column).alias("at")
        )
        entries.append(F.when(rule.failing(df.schema), entry))
    exploded = df.select(F.explode(F.array_compact(F.array(*entries))).alias("_f"))
    return exploded.select("_f.*")


def _position(key: str | None, column: str | None) -> Column:
    # One key column gives one type for every rule; without it the rules' own columns differ in type.
    if key:
        return F.col(key)
    return F.col(column).cast("string") if column else F.lit(None).cast("string")
