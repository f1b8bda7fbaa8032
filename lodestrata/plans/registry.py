"""Registration, and the bits of SQL that the oracles share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources import feeds

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def stream(self, name: str) -> DataFrame:
        """A streaming scan of a table. A stream reads folders; the pattern lets it take a
        table that is one file as well."""
        return feeds.stream(self.spark, self.path(name) + "*", getattr(self, name).schema)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(key: str, sql: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]):
        if key in _QUERIES:
            raise ValueError(f"{key} is registered twice")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLES[key] = sql
        return fn
    return add


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: keys as hexadecimal, clocks and lists as text, money
    as double."""
    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            c = F.lower(F.hex(c))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ";")
        return c.alias(f.name)
    return df.select(*[one(f) for f in df.schema])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: comparable(fn(Tables(spark, folder)))
    return {k: bind(fn) for k, fn in _QUERIES.items()}


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


# SQL snippets


def s_norm(c: str, upper: bool = True) -> str:
    text = f"trim(cast({c} as varchar))"
    return f"coalesce(nullif({f'upper({text})' if upper else text}, ''), '^^')"


def s_text(cols: Sequence[str], scope: str | None = None, upper: bool = True) -> str:
    parts = ([f"'{scope}'"] if scope else []) + [s_norm(c, upper) for c in cols]
    return f"concat_ws('||', {', '.join(parts)})"


def s_key(cols: Sequence[str], scope: str | None = None) -> str:
    return f"sha256({s_text(cols, scope)})"


def s_diff(cols: Sequence[str]) -> str:
    return rf"sha256(regexp_replace({s_text(cols, upper=False)}, '(\|\|\^\^)+$', ''))"


def s_money(c: str) -> str:
    return f"cast({c} as decimal(18,2))"
