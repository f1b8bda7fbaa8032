"""Removal of long repeated strings: buckets of q-grams refined by what follows, down to whole strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.store import Steps, saved, sieve, sifted
from lodestrata.llm.toxicity import BASE, INVERSE, MIX, powers, texts_of

# Bytes of a repeated string, and of the q-grams that the first buckets are made of.
LENGTH, Q = 200, 40
# String starts of a long text, and bytes of text, that are taken at a time.
PIECE, BUFFER = 1 << 18, 1 << 19

_UP, _DOWN = powers(BASE, BUFFER + PIECE), powers(INVERSE, BUFFER + PIECE)
_CODE = np.random.default_rng(200).integers(0, 1 << 64, 256, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(MIX[0])
    h = (h ^ h >> np.uint64(27)) * np.uint64(MIX[1])
    return h ^ h >> np.uint64(31)


class Hashes:
    """64-bit hashes of any stretch of some bytes."""

    def __init__(self, data: np.ndarray):
        self.total = np.r_[np.uint64(0), np.cumsum(_CODE[data] * _UP[:len(data)], dtype=np.uint64)]

    def all(self, length: int) -> np.ndarray:
        """Unmixed hashes of all stretches of one length, by their start."""
        return (self.total[length:] - self.total[:-length]) * _DOWN[:len(self.total) - length]

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * _DOWN[start] + np.asarray(salt).astype(np.uint64))


def buffers(column: pa.Array, length: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Texts as (row, place of the first byte, bytes), some at a time. Each string start of a text is in one piece."""
    held, size = [], 0
    for row, data in enumerate(texts_of(column)):
        for at in range(0, len(data) - length + 1, PIECE):
            part = data[at:at + PIECE + length - 1]
            if held and size + len(part) > BUFFER:
                yield held
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield held


def runs(held: list[tuple[int, int, np.ndarray]], length: int, q: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring string starts that have the same anchor: piece, bucket, run, start, further starts.

    A string's anchor is its q-gram with the smallest hash, the first of equals: a matter of the string alone,
    so equal strings anywhere have equal anchors at equal places. ``bucket`` is the hash of the anchor,
    ``run`` that of all the run's bytes with the anchor's place in them.
    """
    parts = [p for _, _, p in held]
    data, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    hashes, w = Hashes(data), length - q + 1
    grams = hashes.all(q)
    low = np.uint64((1 << 24) - 1)
    order = grams * np.uint64(MIX[0]) & ~low | np.arange(len(grams), dtype=np.uint64)  # places are below 2^24
    blocks = np.r_[order, np.full(-len(order) % w, ~np.uint64(0))].reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    n = len(data) - length + 1
    least = np.minimum(back[:n], ahead[w - 1:w - 1 + n])
    whole = owner[:n] == owner[length - 1:]  # strings do not cross texts
    turn = least[1:] != least[:-1]
    begin = np.flatnonzero(whole & np.r_[True, turn | ~whole[:-1]])
    end = np.flatnonzero(whole & np.r_[turn | ~whole[1:], True])
    anchor, piece = (least[begin] & low).astype(np.int64), owner[begin]
    place = begin - (np.cumsum(sizes) - sizes)[piece] + np.array([at for _, at, _ in held])[piece]
    return piece, mixed(grams[anchor]), hashes(begin, end + length, (anchor - begin) << 32 | end - begin), place, end - begin


def scanned(docs: DataFrame, length: int, q: int, full: bool) -> DataFrame:
    """The runs of all texts; only their buckets unless ``full``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for held in buffers(batch.column(1), length):
                piece, bucket, whole, place, more = runs(held, length, q)
                if not full:
                    yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64))], names=["bucket"])
                    continue
                rows = np.array([row for row, _, _ in held])[piece]
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(ids[rows]), pa.array(place, pa.int64()), pa.array(
                    more.astype(np.int32))], names=["bucket", "run", "rid", "start", "more"])
    shape = "bucket bigint, run bigint, rid bigint, start bigint, more int" if full else "bucket bigint"
    return docs.select("rid", "text").mapInArrow(run, shape)


def strings(docs: DataFrame, length: int) -> DataFrame:
    """rid, text and wanted (bucket, start, more, open) to rows (bucket, rid, start, open, hashes): the hash of
    each string of each wanted run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, data, wanted in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2)):
                out = []
                for r in wanted.as_py():
                    at, more = r["start"], r["more"]
                    ends = np.arange(more + 1)
                    out.append((r["bucket"], rid, at, r["open"], Hashes(data[at:at + more + length])(ends, ends + length).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())))], names=["bucket", "rid", "start", "open", "hashes"])
    return docs.mapInArrow(run, "bucket bigint, rid bigint, start bigint, open boolean, hashes array<bigint>")


def cut(docs: DataFrame, length: int) -> DataFrame:
    """doc, text and spans (start, more; null for none) to doc, n_bytes, n_removed, n_spans and kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, spans, kept = [], [], [], []
            for data, listed in zip(texts_of(batch.column(1)), batch.column(2)):
                edge = np.zeros(len(data) + 1, np.int64)
                if listed.is_valid and len(listed.values):
                    start, more = (listed.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("start", "more"))
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + more + length, -1)
                covered = np.cumsum(edge)[:len(data)] > 0
                size.append(len(data))
                removed.append(int(covered.sum()))
                spans.append(int((np.diff(np.r_[0, covered.astype(np.int8)]) == 1).sum()))
                kept.append(data[~covered].tobytes())
            counts = [pa.array(x, pa.int64()) for x in (size, removed, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(kept, pa.binary())], names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])
    return docs.mapInArrow(run, f"doc {docs.schema['doc'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def keyed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """rid, doc and text. The id itself is the row's key where it is a unique whole number; otherwise the rows
    are written with keys of their own."""
    rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if rows.schema["doc"].dataType.typeName() in ("byte", "short", "integer", "long"):
        if rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc is null").isEmpty():
            return rows.withColumn("rid", F.col("doc").cast("bigint"))
    return saved(rows.withColumn("rid", F.monotonically_increasing_id()), "keyed")


def repeated_spans(rows: DataFrame, steps: Steps, length: int = LENGTH, q: int = Q) -> DataFrame:
    """(rid, start, more): starts from ``start`` to ``start + more`` of strings of ``length`` bytes that also
    start elsewhere. Together they are all such starts.

    First buckets: strings by their anchor. Those with one run in all are done. A bucket is refined by its
    runs' hashes: equal runs repeat as a whole. A run without its equal in a bucket with others is refined to
    its strings; there one run of each kind is enough as a partner, so copies cost nothing here. A sieve keeps
    all other runs, strings and texts from being shuffled; joins then tell exactly. ``steps`` holds the tables
    in between, which can be removed once the result is written.
    """
    seen = steps.saved(scanned(rows, length, q, full=False).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "buckets")
    found = steps.saved(sifted(scanned(rows, length, q, full=True), "bucket", sieve(seen, "bucket"), "_some").where("_some").drop("_some"), "runs")

    kinds = steps.saved(found.groupBy("bucket", "run").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("rid", "start", "more")]), "kinds")  # of one row
    many = steps.saved(kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select(F.col("bucket").alias("_b")), "many")
    twice = steps.saved(kinds.where("n > 1").select(F.col("bucket").alias("_b"), F.col("run").alias("_r")), "twice")
    some = sifted(found.withColumn("_k", F.xxhash64("bucket", "run")), "_k", sieve(twice.select(F.xxhash64("_b", "_r").alias("_k")), "_k"), "_some").where("_some")
    whole = some.join(twice, (some["bucket"] == twice["_b"]) & (some["run"] == twice["_r"])).select("rid", "start", "more")

    wanted = kinds.join(many, kinds["bucket"] == many["_b"]).select("bucket", "rid", "start", "more", (F.col("n") == 1).alias("open"))
    wanted = steps.saved(wanted.groupBy(F.col("rid").alias("_rid")).agg(F.collect_list(F.struct("bucket", "start", "more", "open")).alias("wanted")), "wanted")
    texts = sifted(rows.select("rid", "text"), "rid", sieve(wanted, "_rid"), "_some").where("_some")
    hashed = steps.saved(strings(texts.join(wanted, texts["rid"] == wanted["_rid"]).select("rid", "text", "wanted"), length), "strings")
    each = hashed.select("bucket", "rid", "start", "open", F.posexplode("hashes").alias("at", "string"))
    equal = steps.saved(each.groupBy("bucket", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("bucket").alias("_b"), F.col("string").alias("_s"), F.xxhash64("bucket", "string").alias("_k")), "equal")
    open_ = sifted(each.where("open").withColumn("_k2", F.xxhash64("bucket", "string")), "_k2", sieve(equal, "_k"), "_some").where("_some")
    single = open_.join(equal, (open_["bucket"] == equal["_b"]) & (open_["string"] == equal["_s"]))
    return whole.unionByName(single.select("rid", (F.col("start") + F.col("at")).alias("start"), F.lit(0).alias("more")))


def without_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH, q: int = Q) -> DataFrame:
    """doc, n_bytes, n_removed, n_spans and kept (the bytes that stay) of every row.

    A byte of a text goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same
    row or another; strings do not cross rows, and all are judged on the input. Null texts are empty; rows
    that repeat, in their id or as a whole, are texts of their own, so equal rows of ``length`` bytes go whole.
    """
    rows = keyed(docs, doc, text)
    steps = Steps(docs.sparkSession)
    spans = repeated_spans(rows, steps, length, q)
    listed = saved(spans.groupBy(F.col("rid").alias("_rid")).agg(F.collect_list(F.struct("start", "more")).alias("spans")), "spans")
    steps.remove()
    marked = sifted(rows, "rid", sieve(listed, "_rid"), "_some")
    none = F.lit(0).cast("long")
    rest = marked.where(~F.col("_some")).select("doc", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
                                                F.encode("text", "UTF-8").alias("kept"))
    some = marked.where("_some").select("rid", "doc", "text")
    return rest.unionByName(cut(some.join(listed, some["rid"] == listed["_rid"], "left").select("doc", "text", "spans"), length))
