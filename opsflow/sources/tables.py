"""Readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from opsflow.operators.layout import write_rebalanced
from opsflow.schemas import conform


def read_table(spark: SparkSession, name_or_path: str, schema: StructType | None = None) -> DataFrame:
    """Catalog table by name, or Parquet by path."""
    if "/" in name_or_path:
        return (spark.read.schema(schema) if schema else spark.read).parquet(name_or_path)
    return spark.table(name_or_path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet at ``path``, or no rows if nothing was written there yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system the path belongs to, whichever that is."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).isDirectory()


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a folder of this library's own; a missing one is fine."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    fetch_rows: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a JDBC read, cut into ranges of ``partition_column`` so that no task pulls the whole table."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), "pushDownPredicate": "true", **properties}
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Operational table; filters and columns are pushed to the database by Spark."""
    return spark.read.format("jdbc").options(**options).load()


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def create_if_missing(
    spark: SparkSession, table: str, schema: StructType, path: str, partition_by: Sequence[str] = ()
) -> None:
    """Catalog entry for a Parquet table; an existing one is left alone."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    layout = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout} LOCATION '{path}'")


def observed_rows(observation: Observation) -> int:
    """The ``rows`` metric of a finished write.

    If Spark finds at run time that a branch is empty it drops the branch with its
    metric, and reading the metric then fails; that branch had no rows to count.
    """
    try:
        return observation.get["rows"]
    except Py4JJavaError:
        return 0


def append_table(
    df: DataFrame,
    path: str,
    schema: StructType,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
) -> int:
    """Appends ``df`` in the declared types and returns the rows written, counted by the writing tasks."""
    loaded = Observation()
    count = F.count(F.lit(1)).alias("rows")
    write_rebalanced(conform(df, schema), path, partition_by, cluster_by, lambda rows: rows.observe(loaded, count))
    return observed_rows(loaded)


def insert_select(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT …`` by position, into an existing catalog table."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrites just the partitions that ``df`` has rows for.

    ``df`` must not read ``path`` itself; stage it first. The rebalance gathers a
    partition's rows into few files, and AQE cuts a large partition over tasks.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
