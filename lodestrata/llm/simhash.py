"""SimHash near-duplicates: fingerprints, bit-sliced comparison within buckets, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.components import components
from lodestrata.llm.store import bounded_batches, saved, tidy

BITS, SEED = 64, 42
# Buckets of more fingerprints than this are divided again.
LARGE = 4096
# Shingles hashed, rows of buckets and (fingerprint, block) comparisons at a time.
CHUNK, FLUSH, STEP = 1 << 16, 1 << 13, 1 << 14
PLANES = 8


def fingerprint(text: bytes, shingle: int) -> int:
    """Bits set in over half of the shingles' hashes; fewer words than a shingle are one shingle, none give 0."""
    words = text.lower().split()  # of bytes: A-Z, and ASCII white space
    if not words:
        return 0
    grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    ones, total = np.zeros(BITS, np.int64), max(1, len(words) - shingle + 1)
    while True:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, islice(grams, CHUNK), repeat(SEED)), "<u8")
        if not len(hashes):
            break
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc, fingerprint) of every row; a null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(v.as_buffer().to_pybytes() if v.is_valid else b"", shingle) for v in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc", "fingerprint"])
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc).alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(tidy("simhash", run), f"doc {rows.schema['doc'].dataType.simpleString()}, fingerprint bigint")


def block_masks(free: int, radius: int) -> list[int]:
    """Masks of two of the ``radius + 2`` blocks into which the free bits are cut: two values that differ in
    ``radius`` of these bits at most agree on one of the masks."""
    bits = [i for i in range(BITS) if free >> i & 1]
    blocks = [sum(1 << i for i in part) for part in np.array_split(np.array(bits, dtype=object), radius + 2)]
    return [a | b for a, b in combinations(blocks, 2)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def within(values: np.ndarray, bucket: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places (i, j), i < j, of one bucket whose values differ in ``radius`` bits at most.

    Each bucket's values are stored vertically in blocks of 64 lanes: plane b of a block has bit b of its
    values. A value is compared with a whole block at a time; the distances of the 64 lanes are kept in
    carry-save counters, and a block is given up once every lane is beyond the radius.
    """
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(values)])
    blocks_of = -(-sizes // 64)
    first_block = np.cumsum(blocks_of) - blocks_of
    owner = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(len(values)) - starts[owner]
    lane_at = (first_block[owner] + place // 64) * 64 + place % 64
    lanes = np.zeros(int(blocks_of.sum()) * 64, np.uint64)
    lanes[lane_at] = values
    row_at = np.full(len(lanes), -1)
    row_at[lane_at] = np.arange(len(values))
    used = np.packbits(row_at >= 0, bitorder="little").view("<u8")
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")  # block, lane, bit
    planes = np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]  # bit, block
    ahead = blocks_of[owner] - place // 64  # a value meets its own block and those after it
    digits = max(1, radius.bit_length())
    upto = np.cumsum(ahead)
    at = 0
    while at < len(values):  # some values at a time, with all their blocks
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP, "right")))
        part = ahead[at:to]
        q = np.repeat(np.arange(at, to), part)
        c = np.repeat(lane_at[at:to] // 64, part) + np.arange(len(q)) - np.repeat(np.cumsum(part) - part, part)
        at = to
        count = [np.zeros(len(q), np.uint64) for _ in range(digits)]
        beyond = ~used[c]
        for b in range(BITS):
            carry = planes[b, c] ^ (-(values[q] >> np.uint64(b) & np.uint64(1)).astype(np.int64)).view(np.uint64)
            for k in range(digits):
                count[k], carry = count[k] ^ carry, count[k] & carry
            beyond |= carry | _above(count, radius)
            if b % PLANES == PLANES - 1:
                live = beyond != ~np.uint64(0)
                q, c, beyond, count = q[live], c[live], beyond[live], [x[live] for x in count]
        near = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        item, lane = np.nonzero(near)
        i, j = q[item], row_at[c[item] * 64 + lane]
        yield i[i < j], j[i < j]


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius."""
    above, equal = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            equal = equal & count[k]
        else:
            above, equal = above | equal & count[k], equal & ~count[k]
    return above


def forest(values: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A link from each value to the smallest place of its component within the bucket."""
    root = np.arange(len(values))
    for i, j in within(values, bucket, radius):
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    child = np.flatnonzero(root != np.arange(len(values)))
    return values[child], values[root[child]]


def compare_buckets(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (kind, key, value) in order of bucket to links (a, b). Buckets are bounded, so is what is held."""
    def links(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        kind, key, value = rows
        change = np.r_[True, (kind[1:] != kind[:-1]) | (key[1:] != key[:-1])]
        bucket = np.cumsum(change) - 1
        many = np.bincount(bucket)[bucket] > 1
        if many.any():
            a, b = forest(value[many].view(np.uint64), bucket[many], radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    held = [np.empty(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
        if len(held[0]) >= FLUSH:
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])  # the last bucket may go on
            yield from links([h[~last] for h in held]) if not last.all() else ()
            held = [h[last] for h in held]
    if len(held[0]):
        yield from links(held)


def near_links(values: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect all distinct values at ``radius`` differing bits or fewer.

    Values meet in buckets of two equal blocks out of ``radius + 2``. A bucket of more than ``LARGE`` values
    is divided by two equal blocks of its other bits in the same way, which again loses no pair; then at most
    16 bits are free for radius 2, so no bucket has over 65,536 values, whatever the data. Within a bucket
    only links that join components come out, fewer than its values.
    """
    everything = (1 << BITS) - 1
    masks = block_masks(everything, radius)
    key = lambda mask: F.col("value").bitwiseAND(F.lit(signed(mask)))
    put = lambda df, kinds: df.select(F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("kind"), key(m).alias("key"), "value") for k, m in kinds])).alias("_b")).select("_b.*")
    tagged = put(values.select("value"), list(enumerate(masks)))
    large = saved(tagged.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LARGE).drop("n"), "large-buckets")
    kept = tagged.join(large, ["kind", "key"], "left_anti")
    parts = [tagged.join(large.where(F.col("kind") == k), ["kind", "key"], "left_semi").transform(
        put, [(len(masks) * (k + 1) + i, m | s) for i, s in enumerate(block_masks(everything & ~m, radius))]) for k, m in enumerate(masks)] if not large.isEmpty() else []
    for part in parts:
        kept = kept.unionByName(part)
    ordered = kept.repartition("kind", "key").sortWithinPartitions("kind", "key")
    return ordered.mapInArrow(tidy("simhash", lambda batches: compare_buckets(batches, radius)), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc, fingerprint, component) of every row. ``component`` is the smallest doc id that can be reached over
    fingerprints at ``radius`` differing bits or fewer, itself included. Empty and null texts have fingerprint
    zero and link like any other; rows that repeat an id keep a row each; null ids are never a component's name
    unless all its ids are null. Equal fingerprints meet once, so copies cost nothing beyond their own row."""
    rows = saved(fingerprints(docs, doc, text, shingle), "fingerprints")
    points = saved(rows.groupBy("fingerprint").agg(F.min("doc").alias("least")), "points")
    links = saved(near_links(points.select(F.col("fingerprint").alias("value")), radius), "links")
    labels = components(links)
    reached = saved(labels.join(points, labels["node"] == points["fingerprint"]).select("node", "label", "least"), "reached")
    names = saved(reached.groupBy("label").agg(F.min("least").alias("component")), "names")
    linked = saved(reached.join(names, "label").select("node", "component"), "linked")
    named = saved(points.join(linked, points["fingerprint"] == linked["node"], "left").select(
        F.col("fingerprint").alias("_f"), F.coalesce("component", "least").alias("component")), "named")
    return rows.join(named, rows["fingerprint"] == named["_f"]).select("doc", "fingerprint", "component")


def as_hex(fingerprint: str):
    """Sixteen lowercase digits."""
    return F.lower(F.lpad(F.hex(F.col(fingerprint)), 16, "0"))
