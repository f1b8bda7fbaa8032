"""Results written to the shared folder and read again: lineage ends there, and no executor's loss undoes it."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A sieve never has more bits than this: 4,096 bitmaps of 4 KB, 16 MB in all.
SIEVE_BITS = 27


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, most: int = 1 << 23) -> None:
    """From now on rows cross to Python in Arrow batches of about so many bytes at most, whatever the texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


# What a worker keeps from one task to the next, by operator. Functions that are sent to workers reach it by ``kept``
# and ``begin`` only: what they name themselves is copied for every task.
_KEPT: dict[str, tuple] = {}


def kept(owner: str, key: object, make: Callable[[], object]) -> object:
    """What the operator keeps under the key in this worker, made if it is not there; under another key it goes."""
    if owner not in _KEPT or _KEPT[owner][0] != key:
        _KEPT.pop(owner, None)
        _KEPT[owner] = (key, make())
    return _KEPT[owner][1]


def begin(owner: str) -> None:
    """A task of the operator starts: what others keep goes."""
    pa.set_memory_pool(pa.system_memory_pool())
    for name in [k for k in _KEPT if k != owner]:
        del _KEPT[name]
    trim()


def tidy(owner: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that holds no memory for others: workers outlive their tasks, and what was freed
    would otherwise stay with them. What another operator keeps goes first."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(owner)
        yield from run(batches)
        trim()
    return tidied


def trim() -> None:
    """Gives freed memory back to the system."""
    gc.collect()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame as written to the shared folder. The schema is given, so an empty one reads as well."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables between the steps of one operator: they go together, once what was made of them is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(shared_path(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def remove(self) -> None:
        for path in map(self.spark._jvm.org.apache.hadoop.fs.Path, self.paths):
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def sieve(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Bitmaps of the hashed keys, for ``sifted``: (bucket, bitmap), and the number of bits.

    Sixteen bits a key, 2^27 at most, so what is broadcast never grows past 16 MB. A fuller
    sieve lets more rows through that have no key; it never holds one back that has.
    """
    bits = max(15, min(SIEVE_BITS, (16 * keys.count()).bit_length()))
    at = _position(F.col(key), bits)
    return (keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bitmap"))), bits


def free(df: DataFrame, name: str) -> str:
    """The name, or a longer one, that no column of the frame has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def sifted(df: DataFrame, key: str, of: tuple[DataFrame, int], flag: str) -> DataFrame:
    """Adds ``flag``: false only if the key is surely none of the sieve's. No shuffle."""
    bitmaps, bits = of
    bucket, spot, bitmap = (free(df, n) for n in ("_bucket", "_spot", "_bitmap"))
    at = _position(F.col(key), bits)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(F.col(spot) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return (df.withColumns({bucket: F.bitmap_bucket_number(at), spot: F.bitmap_bit_position(at)})
            .join(F.broadcast(bitmaps.toDF(bucket, bitmap)), bucket, "left")
            .withColumn(flag, F.coalesce(F.getbit(byte, (F.col(spot) % 8).cast("int")) == 1, F.lit(False)))
            .select(*[F.col(f"`{c}`") for c in df.columns], flag))


def _position(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def without(docs: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is not among the ids (one column, not null). Rows without an id stay. Rows that the
    sieve clears are not shuffled, so only those that may have to go meet the ids in a join."""
    gone, maybe = free(docs, "_gone"), free(docs, "_maybe")
    ids = saved(ids.toDF(gone).where(F.col(gone).isNotNull()).distinct(), "ids")
    marked = sifted(docs, column, sieve(ids, gone), maybe)
    rest = marked.where(maybe)
    return marked.where(~F.col(maybe)).drop(maybe).unionByName(rest.join(ids, rest[column] == ids[gone], "left_anti").drop(maybe))


class Bits:
    """A bitmap of hashes, for tasks in numpy: false only for one that surely is not among them. 16 MB at most."""

    def __init__(self, hashes: DataFrame, column: str):
        """hashes: different long values whose low bits are well mixed."""
        bits = max(15, min(SIEVE_BITS, (16 * hashes.count()).bit_length()))
        at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        self.bitmap, self.mask = np.zeros(1 << bits - 3, np.uint8), np.uint64((1 << bits) - 1)
        spot = at.bitwiseAND(F.lit((1 << 15) - 1).cast("bigint"))
        for r in hashes.groupBy(F.shiftright(at, 15).alias("at")).agg(F.bitmap_construct_agg(spot).alias("bits")).collect():  # 4,096 rows of 4 KB at most
            self.bitmap[r["at"] << 12:(r["at"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = h.astype(np.uint64) & self.mask
        return (self.bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
