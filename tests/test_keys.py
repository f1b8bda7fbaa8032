"""Golden digests. The vectors are fixed values: every implementation must derive them."""

import pytest
from pyspark.sql import functions as F

from lodestrata.functions.keys import (
    digest, hash_key, hashdiff, hex_key, key_rules, key_text, link_key, norm, parent_key, payload_text, row_digest, zero_key,
)

KEYS = [
    (["CLI-00417"], None, "CLI-00417", "0959570c782c5783a9161f5ed2b0ce06ca0c8b2b92c90e0124d7adbf247afc51"),
    (["STR-2026-00912"], "STRIIVE_EU", "STRIIVE_EU||STR-2026-00912", "e0ccf17e53438ac758b29527e46ed1729d59c712b605dc72619371c2d1b75205"),
    (["BBBH-45821"], "BULLHORN_EU", "BULLHORN_EU||BBBH-45821", "cf5d8d5257a074543b6cfe9153d69289d89c8a7e53ef3bb81bddb80b5cd59545"),
    (["  str-2026-00912 "], "striive_eu", "STRIIVE_EU||STR-2026-00912", "e0ccf17e53438ac758b29527e46ed1729d59c712b605dc72619371c2d1b75205"),
    ([None], "STRIIVE_EU", "STRIIVE_EU||^^", "f01c04e8349ce6a4c5a5832d19a76fcd32a04ec5d41e587987bf8ae95d8e0731"),
    (["   "], "STRIIVE_EU", "STRIIVE_EU||^^", "f01c04e8349ce6a4c5a5832d19a76fcd32a04ec5d41e587987bf8ae95d8e0731"),
    (["W-4471", "JR-00912", "CLI-00417", "TS-2026-W34", "3"], "STRIIVE_EU",
     "STRIIVE_EU||W-4471||JR-00912||CLI-00417||TS-2026-W34||3", "cf071e4d56f9dc07554ca67a2d4d05b4edcfffa083c13de171626b328b69651b"),
]
BASE = ["Senior Java Developer", "Utrecht", "Contract", "3", "Open"]
DIFFS = [
    (BASE, "806e2e950bba07cad68d2f71e139a012e0c502be15d64e674ba1e2d3b349ae68"),
    ([*BASE, None], "806e2e950bba07cad68d2f71e139a012e0c502be15d64e674ba1e2d3b349ae68"),
    ([*BASE, None, None], "806e2e950bba07cad68d2f71e139a012e0c502be15d64e674ba1e2d3b349ae68"),
    ([*BASE, "EUR"], "eb8d45d970b094f9fa8b46822f5330f81562cf26e1ed3cf88375beafd092d9a1"),
    (["senior java developer", *BASE[1:]], "6163ac8eeb6b87da52f448bb424d8ff244c7f8d51a5535d1326a1650eaed89cc"),
    ([*BASE[:3], "2", "Open - Urgent"], "c628e10e74367e89cce3930ff05e58d7c6c87180f43659f5daacdeb2f0da69ec"),
    (["Utrecht", "Senior Java Developer", *BASE[2:]], "875f701823c2c04b1c2f4f50f67b1025e6c2c7f19f147107d8527537f9f4d8b6"),
]


def lits(values):
    return [F.lit(v).cast("string") for v in values]


def test_golden_keys(spark):
    cols = [c for vals, scope, _, _ in KEYS for c in (key_text(lits(vals), scope), hex_key(hash_key(lits(vals), scope)))]
    got = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
    assert list(got) == [x for _, _, text, want in KEYS for x in (text, want)]


def test_golden_hashdiffs(spark):
    got = spark.range(1).select(*[hex_key(hashdiff(lits(v))).alias(f"c{i}") for i, (v, _) in enumerate(DIFFS)]).first()
    assert list(got) == [want for _, want in DIFFS]


def test_an_empty_payload_keeps_its_first_token(spark):
    got = spark.range(1).select(payload_text(lits([None, None, " "])), payload_text(lits(["a||^^", "b"])), payload_text(lits(["a", "x||^^"]))).first()
    assert list(got) == ["^^", "a||^^||b", "a||x"]


def test_norm_trims_spaces_only(spark):
    got = spark.range(1).select(norm(F.lit(" a\t ")), norm(F.lit(" a "), upper=False), norm(F.lit(1.5))).first()
    assert list(got) == ["A\t", "a", "1.5"]


def test_keys_are_32_bytes_and_shared_between_parent_and_child(spark):
    df = spark.createDataFrame([("x1", "7")], "code string, line string")
    got = df.select(F.length(hash_key(["code"], "S")), hash_key([F.lit("t"), "code"], "S") == parent_key(["code"], "S", ["t"]),
                    link_key([["code"], ["line"]], scope="S") == hash_key(["code", "line"], "S"),
                    zero_key() == F.unhex(F.lit("00" * 32)), F.length(digest(F.lit("x"), "sha1"))).first()
    assert list(got) == [32, True, True, True, 20]


def test_row_digest_reads_binary_keys_as_text(spark):
    df = spark.createDataFrame([("a", "b")], "k string, v string").withColumn("hk", hash_key(["k"]))
    got = df.select(row_digest(["v"], ["hk"]) == F.sha2(F.concat_ws("||", F.lower(F.hex("hk")), "v"), 256)).first()
    assert got[0]


@pytest.mark.parametrize("scope", ["", "  ", "O'Brien", "a\\b"])
def test_bad_scopes_are_refused(scope):
    with pytest.raises(ValueError):
        hash_key(["a"], scope)


def test_no_columns_are_refused():
    for make in (hash_key, hashdiff):
        with pytest.raises(ValueError):
            make([])
    with pytest.raises(ValueError):
        hash_key(["a"], algorithm="md5")


def test_key_rules(spark):
    df = spark.createDataFrame([("a",), (None,), (" ",), ("a||b",), (" ^^ ",)], "k string")
    rules = key_rules(["k"])
    got = [tuple(r) for r in df.select(*[F.coalesce(r, F.lit(False)) for _, r in rules]).collect()]
    assert got == [(True, True, True), (False, True, True), (False, True, True), (True, False, True), (True, True, False)]
    assert [n for n, _ in key_rules(["k"], mandatory=False)] == ["key_no_delimiter_k", "key_not_null_token_k"]


def test_checksums_against_their_public_definitions(spark):
    """What the oracle's engine does not have: XXH64 with seed 42 and CRC32, on texts of every length class."""
    import zlib

    import xxhash
    texts = ["", "a", "abcd", "a" * 7, "b" * 8, "c" * 31, "d" * 32, "é" * 40, "The quick brown fox jumps over the lazy dog"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("x"), F.crc32(F.encode("t", "UTF-8")).alias("c"))
    for r in df.collect():
        assert r.x % 2**64 == xxhash.xxh64_intdigest(r.t.encode(), 42) and r.c == zlib.crc32(r.t.encode())
