"""Writing: append-only tables, mapped CSV files, and the shared folder runs work in."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How a stream's folders of digests are kept. A digest does not compress, so each file holds the bytes alone, without their
# length, and those of a parent that comes again once, also where a file names more parents than Parquet's usual 1 MB take.
# Whether that pays is judged by a column's first page and counts by row group; both have to hold enough rows for that.
DIGEST_FILES = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.dictionary.page.size": str(64 << 20),
                "parquet.page.row.count.limit": "1000000", "parquet.page.size": str(4 << 20), "parquet.block.size": str(256 << 20)}

MAPPED, UNMAPPED, UNRESOLVED = "mapped", "unmapped", "unresolved"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_once(df: DataFrame, table: str, folder: str, partition_by: Sequence[str] = ()) -> bool:
    """Rows into a folder of a table, which readers of the table see wholly or not at all: they are written to a hidden
    folder that then gets its name in one step. A folder that is there is left as it is and its rows are not computed;
    returns whether it was written now. A folder has one writer at a time."""
    spark, target = df.sparkSession, f"{table.rstrip('/')}/{folder}"
    hidden = f"{table.rstrip('/')}/_pending-{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place(target)):
        return False
    writer = df.write.mode("overwrite").options(**DIGEST_FILES)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(hidden)
    files.mkdirs(place(target).getParent())
    if not files.rename(place(hidden), place(target)):
        raise ValueError(f"{target} could not be published")
    return True


def export_columns(df: DataFrame, columns: Sequence[tuple[str, str | None, str]]) -> DataFrame:
    """(header, source column, status) to the file's columns: unmapped is blank, and a column
    nobody can resolve refuses the whole file, also one without rows."""
    unresolved = [h for h, _, status in columns if status == UNRESOLVED]
    if unresolved:
        raise ValueError(f"columns without a resolvable source: {unresolved}")
    return df.select(*[(F.lit("") if status == UNMAPPED else F.coalesce(F.col(source).cast("string"), F.lit(""))).alias(h)
                       for h, source, status in columns])


def write_csv(df: DataFrame, columns: Sequence[tuple[str, str | None, str]], path: str) -> None:
    """One header per part file; the number of files is Spark's to choose."""
    export_columns(df, columns).write.mode("errorifexists").option("header", True).option("emptyValue", "").csv(path)
