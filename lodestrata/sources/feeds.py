"""Reading feeds: batch and streaming scans, JSON ingest, landing stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet",
           max_files: int = 1000) -> DataFrame:
    """Streaming scan of a directory. The schema comes from a static read when not given,
    and ``max_files`` bounds what one micro-batch takes on; no flow's result depends on it."""
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    return (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(path))


def landed(df: DataFrame, source_system: str, batch_id: str, ingest_ts: str | None = None) -> DataFrame:
    """Landing stamps; ``ingest_date`` is the partition column of the landing table."""
    ts = F.current_timestamp() if ingest_ts is None else F.lit(ingest_ts).cast("timestamp")
    return df.withColumns({
        "_ingest_ts": ts, "ingest_date": F.to_date(ts), "_source_system": F.lit(source_system),
        "_batch_id": F.lit(batch_id), "_dup_flag": F.lit(None).cast("boolean")})
