"""Column masking by role."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsflow.functions.text import MAILBOX, MAILBOX_MASK, mask_mailbox

#: Session variable that holds the reader's role.
ROLE = "opsflow_reader_role"


@dataclass(frozen=True)
class MaskingPolicy:
    """Roles that read the plain value, and what everybody else reads."""

    clear_roles: frozenset[str]
    hide: Callable[[Column], Column]

    def applied_to(self, column: Column, role: str) -> Column:
        return F.when(F.lit(role in self.clear_roles), column).otherwise(self.hide(column))


def email_policy(clear_roles: Collection[str]) -> MaskingPolicy:
    return MaskingPolicy(frozenset(clear_roles), mask_mailbox)


def masked(df: DataFrame, policies: Mapping[str, MaskingPolicy], role: str) -> DataFrame:
    """``df`` as ``role`` may see it; columns without a policy are unchanged."""
    return df.withColumns({c: p.applied_to(F.col(c), role) for c, p in policies.items()})


def masked_view(df: DataFrame, policies: Mapping[str, MaskingPolicy], role: str, view: str) -> None:
    """Registers the masked form under a view name."""
    masked(df, policies, role).createOrReplaceTempView(view)


def declare_role(spark: SparkSession) -> None:
    """The session's role variable, empty until :func:`set_role`."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT ''")


def set_role(spark: SparkSession, role: str) -> None:
    """For the layer that knows who is reading; what is read from now on is masked for that role."""
    spark.sql(f"SET VAR {ROLE} = (SELECT :role)", args={"role": role})


def create_email_mask(spark: SparkSession, function: str, clear_roles: Collection[str]) -> None:
    """SQL function that hides mailboxes from all roles but ``clear_roles``, by the role variable at the time of reading."""
    named = ", ".join("'" + r.replace("'", "\\'") + "'" for r in sorted(clear_roles)) or "NULL"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(plain STRING) RETURNS STRING "
        f"RETURN CASE WHEN {ROLE} IN ({named}) THEN plain ELSE regexp_replace(plain, '{MAILBOX}', '{MAILBOX_MASK}') END"
    )


def governed_view(spark: SparkSession, view: str, source: str, columns: Collection[str], masks: Mapping[str, str]) -> None:
    """View on ``source`` (a table's name, or a file format and path) in which each column of ``masks`` passes its function.

    The view is kept as text and resolved by each query, so the same view shows every role
    what it may see. Readers are given the view and no access to the source.
    """
    shown = ", ".join(f"{masks[c]}(`{c}`) AS `{c}`" if c in masks else f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {shown} FROM {source}")
