"""Writing reports: typed tables, delimited exports and window replacement."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulbook.functions.windows import in_window


def shared_dir(spark: SparkSession) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names. A temporary folder serves a local session alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="haulbook-")
    return f"{root.rstrip('/')}/haulbook-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    For an aggregate that several branches of a plan need: it is computed once, its
    size is known to the planner, and a lost executor costs no recomputation.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_report(df, shared_dir(df.sparkSession)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the report schema in order and type. A missing column is an error, as is a type that cannot be stored in
    the declared one; a value that does not fit fails the run. Further columns are left out."""
    missing = [n for n in schema.names if n not in df.columns]
    if missing:
        raise ValueError(f"the report lacks {', '.join(missing)}")
    return df.to(schema)


def write_report(df: DataFrame, path: str, schema: T.StructType | None = None) -> str:
    """Replace a report table."""
    (conform(df, schema) if schema else df).write.mode("overwrite").parquet(path)
    return path


def _trimmed(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def export_delimited(df: DataFrame, path: str, sep: str = "\t") -> str:
    """Header and separated, trimmed rows."""
    _trimmed(df).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
    return path


def export_by_key(df: DataFrame, path: str, key: str, sep: str = "\t", rows_per_file: int = 5_000_000) -> str:
    """One folder per key. Rows are brought together by key; a key with very many rows is split over as many tasks as its size asks for."""
    (_trimmed(df).hint("rebalance", key).write.mode("overwrite").option("sep", sep).option("header", True)
     .option("maxRecordsPerFile", rows_per_file).partitionBy(key).csv(path))
    return path


def replace_window(target: DataFrame, new: DataFrame, date_col: str, start, end, upper: str = "midnight") -> DataFrame:
    """The target without its rows dated in the window, plus the recomputed rows.

    Rows without a date stay. Give the new rows of the same window; a second run then
    changes nothing. Write the result to a new version of the table, or keep the table in day folders (``daytable``).
    """
    old = target.filter(~F.coalesce(in_window(date_col, start, end, upper), F.lit(False)))
    return old.unionByName(new.select(*target.columns))


def replace_partitions(new: DataFrame, path: str, day_col: str) -> None:
    """In place: overwrite the day folders present in the new rows; all other days stay.

    For a window whose days may lose all their rows, and for readers at work meanwhile, use ``daytable``.
    """
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)
