"""Benchmark decontamination by spaced seeds, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.store import saved

# Token places that a seed compares; the places between them may differ. Each laid wherever it fits, they find every
# stretch of 10 to 13 tokens of which any two were replaced, and every one of 8 or 9 with any one replaced.
MASKS = ((0, 1, 3, 6, 7), (0, 1, 3, 4, 5), (0, 1, 2, 3, 4))
SPAN = 1 + min(max(m) for m in MASKS)  # of the narrowest
# The places that all masks compare: a stretch is looked at further only if a benchmark holds these tokens.
STEM = tuple(sorted(set(MASKS[0]).intersection(*MASKS[1:])))
# An overlap is a stretch of 13 tokens (the whole item, if it is shorter) of which two at most differ, or one
# at most of fewer than ten: four fifths are equal. Of items shorter than ``LEAST`` no token differs.
WINDOW, LEAST = 13, 8
# Tokens of benchmark items whose sieve is broadcast at a time: a stem and three seeds a token, 16 MB at most.
BLOCK_TOKENS = 4_000_000
# A sieve has buckets of so many 64-bit words, and 2^12 buckets at most.
WORDS, BUCKET_BITS = 512, 12
# A seed that stands at more places of the benchmark than this is refined by the windows around it; the result is the same.
COMMON = 16
# Of three disjoint groups of a window's places one is without a difference, as two places at most differ.
GROUPS = 3

# Blocks of the scripts that are written without spaces (Thai, Lao, Tai, Myanmar, Khmer, Javanese, Balinese, Han, Kana, Bopomofo,
# Yi). The range that is tested first spares other texts the list.
FAR = r"[\x{E01}-\x{FF9F}\x{16FE0}-\x{3FFFF}]"
UNSPACED = (r"[\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{19FF}\x{1A20}-\x{1AAF}\x{1B00}-\x{1B7F}\x{2E80}-\x{312F}"
            r"\x{31A0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{A000}-\x{A4CF}\x{A980}-\x{A9FF}\x{AA60}-\x{AADF}\x{F900}-\x{FAFF}"
            r"\x{FF66}-\x{FF9F}\x{16FE0}-\x{18DFF}\x{1AFF0}-\x{1B16F}\x{20000}-\x{3FFFF}]")
# One character of them with the marks on it, and what stands between tokens: no letter, digit or mark on such a character.
CHARACTER = rf"([{FAR}&&{UNSPACED}&&[\p{{L}}\p{{N}}]][{FAR}&&{UNSPACED}&&\p{{M}}]*)"
BETWEEN = rf"[\P{{L}}&&\P{{N}}&&[\P{{M}}[^{UNSPACED[1:]}]]+"


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, in order; in scripts without spaces, of each character."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    parts = F.split(F.regexp_replace(lower, CHARACTER, " $1 "), BETWEEN)
    return F.transform(parts, lambda w: F.xxhash64(w))


def spared(size: Column) -> Column:
    """Tokens of a stretch that may differ."""
    return F.when(size < LEAST, 0).when(size < 10, 1).otherwise(2)


def seeds(hashes: Column, at: Column, masks: Mapping[int, tuple[int, ...]]) -> list[Column]:
    """The hashed seeds of all masks from one place on; null where a mask reaches beyond the end."""
    return [F.when(at + max(mask) < F.size(hashes), F.xxhash64(F.lit(k), *[F.get(hashes, at + i) for i in mask])) for k, mask in masks.items()]


def whole(size: int) -> dict[int, tuple[int, ...]]:
    """The one mask of items of fewer than ``LEAST`` tokens, all their places; numbered apart from ``MASKS``."""
    return {-size: tuple(range(size))}


def around(hashes: Column, at: Column) -> tuple[Column, Column]:
    """The tokens that any stretch around a seed at this place can reach, and the seed's place among them."""
    before = F.least(at, F.lit(WINDOW - SPAN))
    return F.slice(hashes, at - before + 1, before + WINDOW), before


def alike(a: Column, b: Column, places: int, shift: Column | int = 0) -> Column:
    """A bit for each place of ``a`` at which ``b`` has the same token ``shift`` places on."""
    bits = [F.when(F.get(a, F.lit(i)) == F.get(b, F.lit(i) + shift), F.lit(1 << i)).otherwise(0) for i in range(places)]
    return reduce(Column.bitwiseOR, bits).cast("long")


def overlap(same: Column, item: Column, doc: Column, shift: Column) -> Column:
    """Equal tokens of the best window of what is ``around`` an item's seed, by the places that are ``alike`` those of what is
    around the document's, ``shift`` places on; -1 where one of them ends before a window is full."""
    size = F.least(F.size(item), F.lit(WINDOW))
    first, last = F.greatest(F.lit(0), -shift), F.least(F.size(item), F.size(doc) - shift)
    full = F.call_function("shiftleft", F.lit(1).cast("long"), size) - 1
    sums = [F.when((first <= s) & (size + s <= last), F.bit_count(F.shiftright(same, s).bitwiseAND(full))) for s in range(WINDOW - SPAN + 1)]
    return F.coalesce(F.greatest(*sums), F.lit(-1))


def windows(known: DataFrame) -> DataFrame:
    """(_seed, _q, _size, _win, item): the stretches around each seed, which stands ``_q`` places after their start."""
    n, span = F.size("_item"), F.element_at(F.array(*[F.lit(1 + max(m)) for m in MASKS]), F.col("_k") + 1)
    size = F.least(n, F.lit(WINDOW))
    starts = F.sequence(F.greatest(F.lit(0), F.col("_q") + span - size), F.least(F.col("_q"), n - size))
    return (known.select("item", "_item", "_seed", "_q", size.alias("_size"), F.explode(starts).alias("_a"))
            .select("_seed", (F.col("_q") - F.col("_a")).alias("_q"), "_size", F.slice("_item", F.col("_a") + 1, F.col("_size")).alias("_win"), "item"))


def places(around: DataFrame) -> DataFrame:
    """(_seed, _q, _size, _order): the places of the stretches around a seed, those first in which they agree least."""
    by = ["_seed", "_q", "_size"]
    each = around.select(*by, "_win").distinct().select(*by, F.posexplode("_win").alias("_place", "_token"))
    alike = each.groupBy(*by, "_place", "_token").agg(F.count(F.lit(1)).alias("n")).groupBy(*by, "_place").agg(F.sum(F.col("n") * F.col("n")).alias("n"))
    order = F.transform(F.sort_array(F.collect_list(F.struct("n", "_place"))), lambda s: s["_place"])
    return alike.groupBy(*by).agg(F.slice(order, 1, 2 * GROUPS).alias("_order"))


def refined(window: Column) -> Column:
    """The names of a stretch in each group: its seed and the tokens in two of the places in which such stretches agree least."""
    return F.array(*[F.xxhash64(F.lit(g), "_seed", "_q", "_size", F.get(window, F.get("_order", F.lit(g))), F.get(window, F.get("_order", F.lit(g + GROUPS))))
                     for g in range(GROUPS)])


def bucket(stem: Column, buckets: int) -> Column:
    return F.shiftright(stem, 27).bitwiseAND(F.lit(buckets - 1))


def word(key: Column) -> Column:
    return F.shiftright(key, 18).bitwiseAND(F.lit(WORDS - 1)).cast("int")


def mark(key: Column) -> Column:
    """Three bits of a word."""
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(key, n).bitwiseAND(F.lit(63)).cast("int")) for n in (0, 6, 12)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def marked(key: Column) -> Column:
    """False only if the key is surely none of its bucket's."""
    return F.bitwise_not(F.get("_bits", word(key))).bitwiseAND(mark(key)) == 0


def sieve(known: DataFrame, buckets: int) -> DataFrame:
    """(_bucket, _bits): the marks of stems and seeds, those of a seed in its stem's bucket, so that a place of a document
    asks one bucket for all."""
    keys = known.select(bucket(F.col("_stem"), buckets).alias("_bucket"), F.explode(F.array("_stem", "_seed")).alias("_key"))
    none = known.sparkSession.range(buckets * WORDS).select(F.shiftright("id", WORDS.bit_length() - 1).alias("_bucket"), (F.col("id") % WORDS).cast("int").alias("_word"), F.lit(0).cast("long").alias("_mark"))
    words = keys.select("_bucket", word(F.col("_key")).alias("_word"), mark(F.col("_key")).alias("_mark")).unionByName(none).groupBy("_bucket", "_word").agg(F.bit_or("_mark").alias("_mark"))
    return words.groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct("_word", "_mark"))).getField("_mark").alias("_bits"))


def seeded(items: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(_stem, _seed, item, _item, _q, _n): the seeds of the items, each with the tokens around it and the number of its places."""
    known = []
    for n in (n for n in sizes if n < LEAST):
        seed = seeds(F.col("_item"), F.lit(0), whole(n))[0]
        known.append(items.where(F.size("_item") == n).select(seed.alias("_stem"), seed.alias("_seed"), "item", "_item", F.lit(0).alias("_q")))
    if LEAST in sizes:
        at = items.where(F.size("_item") >= LEAST).select("item", "_item", F.explode(F.sequence(F.lit(0), F.size("_item") - SPAN)).alias("_q"))
        tokens_around, place = around(F.col("_item"), F.col("_q"))
        stem, every = seeds(F.col("_item"), F.col("_q"), {len(MASKS): STEM})[0], F.array(*seeds(F.col("_item"), F.col("_q"), dict(enumerate(MASKS))))
        at = at.select("item", tokens_around.alias("_item"), place.alias("_q"), stem.alias("_stem"), F.posexplode(every).alias("_k", "_seed"))
        known.append(at.where(F.col("_seed").isNotNull()))
    known = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), known)
    return known.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("_seed")))  # of a block's tokens at most


def spots(docs: DataFrame, known: DataFrame, sizes: Sequence[int], buckets: int) -> DataFrame:
    """(doc, _doc, _p, _seed): the seeds of documents that may be among the known, with the tokens around them. Documents stay
    where they are; what is broadcast is the sieve. ``sizes`` are those of the items, each below ``LEAST`` by itself and
    from there on as ``LEAST``; documents are searched for no others."""
    short, spaced = [n for n in sizes if n < LEAST], LEAST in sizes
    stems = reduce(lambda a, n: a | whole(n), short, {len(MASKS): STEM} if spaced else {})
    reach = min([*short, *([SPAN] if spaced else [])])
    placed = docs.select("doc", "_doc", F.explode(F.when(F.size("_doc") >= min(sizes), F.sequence(F.lit(0), F.size("_doc") - reach))).alias("_p"))
    placed = placed.select("doc", "_doc", "_p", F.posexplode(F.array(*seeds(F.col("_doc"), F.col("_p"), stems))).alias("_k", "_stem"))
    met = placed.withColumn("_bucket", bucket(F.col("_stem"), buckets)).join(F.broadcast(sieve(known, buckets)), "_bucket").where(marked(F.col("_stem")))
    kinds = [F.when(F.col("_k") == 0, s) for s in seeds(F.col("_doc"), F.col("_p"), dict(enumerate(MASKS)))] if spaced else []
    kinds += [F.when(F.col("_k") >= int(spaced), F.col("_stem"))] if short else []
    met = met.select("doc", "_doc", "_p", "_bits", F.explode(F.array(*kinds)).alias("_seed")).where(marked(F.col("_seed")))
    tokens_around, place = around(F.col("_doc"), F.col("_p"))
    return met.select("doc", tokens_around.alias("_doc"), place.alias("_p"), "_seed")


def hits(found: DataFrame, known: DataFrame) -> DataFrame:
    """(doc, item, equal, size): verified overlaps around the seeds that a document and an item share.

    A seed of a phrase that many items share would bring each of them to each place of a document that holds it. It
    only says there which stretches of the document to look at: they go on alone, named by the seed and by two more
    tokens, and meet the distinct stretches of items of the same name. Where all tokens but three are shared, those are overlaps.
    """
    start, enough = F.col("_p") - F.col("_q"), F.col("equal") >= F.col("size") - spared(F.col("size"))
    met = found.join(known.where(F.col("_n") <= COMMON), "_seed")
    met = met.select("doc", "item", "_item", "_doc", start.alias("_shift"), F.explode(F.array(alike(F.col("_item"), F.col("_doc"), 2 * WINDOW - SPAN, start))).alias("_same"))  # once a row
    plain = met.select("doc", "item", F.least(F.size("_item"), F.lit(WINDOW)).alias("size"), overlap(F.col("_same"), F.col("_item"), F.col("_doc"), F.col("_shift")).alias("equal")).where(enough)
    often = known.where(F.col("_n") > COMMON)
    if often.isEmpty():
        return plain
    stretches = windows(often)
    met = found.join(places(stretches), "_seed").where((start >= 0) & (start + F.col("_size") <= F.size("_doc")))
    seen = met.select("doc", "_seed", "_q", "_order", F.col("_size"), F.slice("_doc", start + 1, F.col("_size")).alias("_seen"))
    named = (stretches.select("_seed", "_q", "_size", "_win").distinct().join(places(stretches), ["_seed", "_q", "_size"])
             .select("_win", F.explode(refined(F.col("_win"))).alias("_name")).distinct())
    same = F.bit_count(alike(F.col("_seen"), F.col("_win"), WINDOW))
    compared = (seen.select("doc", F.col("_size").alias("size"), "_seen", F.explode(refined(F.col("_seen"))).alias("_name")).join(named, "_name")
                .select("doc", "size", "_win", same.alias("equal")).where(enough))
    owners = stretches.select("_win", "item").distinct()
    return plain.unionByName(compared.groupBy("doc", "size", "_win").agg(F.max("equal").alias("equal")).join(owners, "_win").select("doc", "item", "size", "equal"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """doc, contaminated, n_items, overlap and items of every row of docs.

    ``overlap`` is the best share of equal tokens (null without an overlap), ``items`` the ids found, in order.
    Case, punctuation and white space do not count. Items of fewer than ``LEAST`` tokens are found where all
    their tokens stand in a row, a single token wherever it stands; items without a token or an id are found nowhere; null texts are empty; rows of one id share their verdict, also those
    without an id; equal items are each reported, and searched for once. All that is broadcast is a sieve of seeds; places
    that pass it are written with the tokens around them and meet the written seeds in a join. A benchmark of more than
    ``BLOCK_TOKENS`` tokens is searched in blocks, one after the other.
    """
    # Exploded, so that what is asked of the tokens below is not asked of a second derivation of them.
    rows = docs.select(F.col(doc).alias("doc"), F.explode(F.array(tokens(F.col(text).cast("string")))).alias("_doc"))
    ends = [F.xxhash64(F.lit(""))]  # a text that starts or ends with a separator has an empty token there
    named = (benchmark.select(F.col(item).alias("_id"), F.filter(tokens(F.col(item_text).cast("string")), lambda t: t != ends[0]).alias("_item"))
             .where((F.size("_item") > 0) & F.col("_id").isNotNull()).groupBy("_item").agg(F.collect_set("_id").alias("_ids")))
    items = saved(named.select(F.monotonically_increasing_id().alias("item"), "_item", "_ids"), "items")
    counted = items.groupBy(F.least(F.size("_item"), F.lit(LEAST)).alias("size")).agg(F.sum(F.size("_item")).alias("n")).collect()  # LEAST rows at most
    sizes, total = sorted(r["size"] for r in counted) or [LEAST], sum(r["n"] for r in counted)
    n = -(-total // BLOCK_TOKENS) or 1
    buckets = 1 << max(0, min(BUCKET_BITS, (4 * 16 * total // n // (64 * WORDS)).bit_length()))  # sixteen bits a key or more
    parts = []
    for k in range(n):
        known = saved(seeded(items if n == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k), sizes), "seeds")
        parts.append(hits(saved(spots(rows, known, sizes, buckets), "spots"), known))
    found = reduce(DataFrame.unionByName, parts).groupBy("doc", "item").agg(F.max(F.col("equal") / F.col("size")).alias("overlap"))
    found = (found.join(items.select("item", "_ids"), "item").select("doc", "overlap", F.explode("_ids").alias("_id")).groupBy(F.col("doc").alias("_d"))
             .agg(F.max("overlap").alias("overlap"), F.sort_array(F.collect_set("_id")).alias("items")))
    each = docs.select(F.col(doc).alias("doc"))
    found = found.withColumn("_hit", F.lit(True))
    return (each.join(found, each["doc"].eqNullSafe(found["_d"]), "left")
            .select("doc", F.coalesce("_hit", F.lit(False)).alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    "overlap", F.coalesce("items", F.array().cast(f"array<{items.schema['_ids'].dataType.elementType.simpleString()}>")).alias("items")))
