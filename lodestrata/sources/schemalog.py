"""JSON deliveries under a logged schema: what does not fit is kept beside the row, and nothing is ever dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType, _parse_datatype_string

# What a column of one type may become when values of another arrive. No other change is made: the values that do
# not fit stay in the rescue column.
WIDER: Mapping[str, Sequence[str]] = {"bigint": ("double",)}
RESCUED, LINE = "_rescued", "_line"
# A feed does not get more columns than this; the fields of others are rescued.
MOST_COLUMNS = 1000


class SchemaLog:
    """The schemas of one feed, a version a folder. A version is what its micro-batch was read with, so a batch that
    runs again finds what it had learned."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[StructType]:
        """All versions in order; the first one has no column."""
        from lodestrata.streaming.flows import stored
        held = stored(self.spark, self.path)
        rows = [] if held is None else sorted(held.select("_version", "columns").collect())  # a row a version
        return [StructType()] + [StructType.fromJson({"type": "struct", "fields": [
            {"name": n, "type": _parse_datatype_string(t).jsonValue(), "nullable": True, "metadata": {}} for n, t in r["columns"]]}) for r in rows]

    def add(self, version: int, schema: StructType) -> None:
        columns = [(f.name, f.dataType.simpleString()) for f in schema]
        row = self.spark.createDataFrame([(columns,)], "columns array<struct<name string, type string>>")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_version={version}")


def kind(value: Column) -> Column:
    """The type of a JSON value as a column type: what is no number, boolean or text is kept as JSON text."""
    of = F.schema_of_variant(value)
    return (F.when(of == "VOID", F.lit(None)).when(of == "BOOLEAN", F.lit("boolean")).when(of == "BIGINT", F.lit("bigint"))
            .when(of.isin("DOUBLE", "FLOAT") | of.startswith("DECIMAL"), F.lit("double")).otherwise(F.lit("string")))


def fits(value: Column, type_: Column | str) -> Column:
    """Whether a JSON value can be a column's, without any loss: a whole number is a double only if it comes back."""
    type_ = F.lit(type_) if isinstance(type_, str) else type_
    own, whole = kind(value), F.try_variant_get(value, "$", "bigint")
    exact = whole.cast("double").cast("decimal(38,0)") == whole.cast("decimal(38,0)")
    return F.coalesce(own.isNull() | (type_ == "string") | (type_ == own) & (own != "string") | (type_ == "double") & (own == "bigint") & exact, F.lit(False))


def parsed(lines: DataFrame, schema: StructType, line: str = "value") -> DataFrame:
    """The columns of the schema and ``_rescued``: the fields, as JSON texts, that are no column of it or do not fit
    theirs, and under ``_line`` a line that is no JSON object. Names are told apart by their exact spelling; blank
    lines hold nothing."""
    known = {f.name: f.dataType.simpleString() for f in schema}
    rows = lines.where(F.trim(line) != "").select(F.col(line).alias("_line"), F.try_variant_get(F.try_parse_json(line), F.lit("$"), "map<string,variant>").alias("_fields"))
    columns = []
    for name, type_ in known.items():
        value = F.try_element_at("_fields", F.lit(name))
        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))
        typed = F.when(F.schema_of_variant(value) != "VOID", text) if type_ == "string" else F.try_variant_get(value, "$", type_)
        columns.append(F.when(fits(value, type_), typed).alias(name))
    types = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.lit(None).cast("map<string,string>")
    left = F.filter(F.map_entries("_fields"), lambda e: ~fits(e["value"], F.coalesce(F.try_element_at(types, e["key"]), F.lit("none"))))
    rescued = F.when(F.col("_fields").isNull(), F.create_map(F.lit(LINE), F.col("_line"))).when(
        F.size(left) > 0, F.map_from_entries(F.transform(left, lambda e: F.struct(e["key"], F.to_json(e["value"])))))
    return rows.select(*columns, rescued.alias(RESCUED))


def learned(schema: StructType, rescued: DataFrame, wider: Mapping[str, Sequence[str]] = WIDER) -> StructType:
    """The schema after what a batch had to rescue: new columns by name, types by the rules. A new column whose values
    are of several types is text, which holds them all, if no declared type does."""
    fields = rescued.where(F.col(RESCUED).isNotNull()).select(F.explode(RESCUED).alias("name", "text")).where(F.col("name") != LINE)
    found = fields.groupBy("name").agg(F.sort_array(F.collect_set(kind(F.try_parse_json("text")))).alias("kinds")).orderBy("name").limit(2 * MOST_COLUMNS).collect()
    known, lower = {f.name: f.dataType.simpleString() for f in schema}, {f.name.lower() for f in schema} | {RESCUED, LINE}
    for name, kinds in found:
        if name in known:
            fitting = [t for t in wider.get(known[name], ()) if all(k == t or t in wider.get(k, ()) for k in kinds)]
            known[name] = fitting[0] if fitting else known[name]
        elif kinds and name.lower() not in lower and name and len(known) < MOST_COLUMNS:
            fitting = [t for t in [*kinds, *(w for k in kinds for w in wider.get(k, ()))] if all(k == t or t in wider.get(k, ()) for k in kinds)]
            known[name] = fitting[0] if fitting else "string"
            lower.add(name.lower())
    return StructType([StructField(n, _parse_datatype_string(t)) for n, t in known.items()])


def write_batch(lines: DataFrame, path: str, log: SchemaLog, line: str = "value", wider: Mapping[str, Sequence[str]] = WIDER) -> int:
    """One micro-batch into its folder; returns the version it was written with.

    It is written with the schema known; only what it rescued is looked at. If that widens the schema, the new
    version is logged and the batch written again with it, once in a schema's life. No earlier file is read, and a
    batch that runs again replaces its whole folder.
    """
    versions = log.versions()
    version = len(versions) - 1
    while True:
        rows = parsed(lines, versions[version], line).withColumn("_schema", F.lit(version))
        rows.write.mode("overwrite").partitionBy("_schema").parquet(path)
        held = log.spark.read.schema(StructType([rescue_field()])).parquet(path)
        new = learned(versions[version], held, wider)
        if new == versions[version]:
            return version
        version += 1
        log.add(version, new)
        versions.append(new)


def rescue_field() -> StructField:
    return StructField(RESCUED, MapType(StringType(), StringType()))


def json_flow(spark: SparkSession, landing: str, path: str, root: str, flow: str, log: SchemaLog, generation: int = 0, wider: Mapping[str, Sequence[str]] = WIDER, max_files: int = 1000):
    """A stream of JSON lines into an insert-only log that takes late and retyped fields on by itself."""
    from lodestrata.streaming.flows import batch_flow, batch_path, checkpoint_of
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(landing)
    return batch_flow(lines, lambda batch, n: write_batch(batch, batch_path(path, flow, generation, n), log, "value", wider) and None, checkpoint_of(root, flow, generation))


def read_logged(spark: SparkSession, path: str, log: SchemaLog) -> DataFrame:
    """All rows of a log under its newest schema: rows of an earlier version are cast, which the rules make exact
    (a whole number that a double cannot hold moves to ``_rescued``)."""
    versions = log.versions()
    newest, parts = versions[-1], []
    for number, schema in enumerate(versions):
        files = spark.read.schema(StructType([*schema.fields, rescue_field()]))
        try:
            rows = files.parquet(f"{path}/_flow=*/_generation=*/_batch=*/_schema={number}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        own = {f.name: f.dataType for f in schema}
        lost = [f.name for f in newest if f.name in own and own[f.name].simpleString() == "bigint" and f.dataType.simpleString() == "double"]
        kept = {n: F.col(f"`{n}`").cast("double").cast("decimal(38,0)") == F.col(f"`{n}`").cast("decimal(38,0)") for n in lost}
        moved = [F.when(~kept[n], F.create_map(F.lit(n), F.col(f"`{n}`").cast("string"))) for n in lost]
        rescued = reduce(lambda a, b: F.coalesce(F.map_concat(a, b), a, b), moved, F.col(RESCUED))
        parts.append(rows.select(*[(F.when(kept[f.name], F.col(f"`{f.name}`").cast("double")) if f.name in kept else F.col(f"`{f.name}`").cast(f.dataType) if f.name in own else
                                    F.lit(None).cast(f.dataType)).alias(f.name) for f in newest], rescued.alias(RESCUED)))
    if not parts:
        return spark.createDataFrame([], StructType([*newest.fields, rescue_field()]))
    return reduce(DataFrame.unionByName, parts)
