"""Query registry and the plain output form shared by Spark and the checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

STAMP = "yyyy-MM-dd HH:mm:ss"


def plain(df: DataFrame) -> DataFrame:
    """Dates and stamps as ISO text, decimals as doubles, whole numbers as long."""
    def one(f: T.StructField) -> str:
        if isinstance(f.dataType, T.DateType):
            return f"date_format(`{f.name}`, 'yyyy-MM-dd') as `{f.name}`"
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return f"date_format(`{f.name}`, '{STAMP}') as `{f.name}`"
        if isinstance(f.dataType, T.DecimalType):
            return f"cast(`{f.name}` as double) as `{f.name}`"
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return f"cast(`{f.name}` as bigint) as `{f.name}`"
        return f"`{f.name}`"

    return df.selectExpr(*[one(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a query under a name with its checking SQL, if it has one."""
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, path: plain(fn(spark, path))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def day(c: str) -> str:
    """SQL text: a date as ISO text."""
    return f"strftime(cast({c} as date), '%Y-%m-%d')"


def stamp(c: str) -> str:
    """SQL text: a stamp as ISO text to the second."""
    return f"strftime(cast({c} as timestamp), '%Y-%m-%d %H:%M:%S')"


def ratio(num: str, den: str, digits: int, scale: int = 1, empty: str = "0.0") -> str:
    """SQL text: scale * num / den of whole non-negative numbers, rounded half up by integer arithmetic."""
    up = scale * 10 ** digits
    return (f"(case when ({den}) = 0 then {empty} else "
            f"((2 * cast({num} as hugeint) * {up} + ({den})) // (2 * ({den}))) / {float(10 ** digits)} end)")


def pct(num: str, den: str, digits: int = 2) -> str:
    return ratio(num, den, digits, 100)


def money_ratio(num: str, den: str, digits: int = 3) -> str:
    """SQL text: ratio of two amounts with four decimals."""
    return ratio(f"({num}) * 10000", f"cast(({den}) * 10000 as hugeint)", digits)


def span(a: str, b: str) -> str:
    """SQL text: ``D HH:MM:SS`` from a to b."""
    s = f"abs(date_diff('second', {a}, {b}))"
    return (f"(case when date_diff('second', {a}, {b}) < 0 then '-' else '' end || cast({s} // 86400 as varchar) || ' ' "
            f"|| printf('%02d', ({s} // 3600) % 24) || ':' || printf('%02d', ({s} // 60) % 60) || ':' || printf('%02d', {s} % 60))")
