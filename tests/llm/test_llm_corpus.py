"""Archives, whitening and collocations: brute force on whole tables, parts on small inputs, odd inputs."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import DATA
from lodestrata.llm import archive, collocations, whitening
from lodestrata.llm.queries import queries
from lodestrata.llm.store import saved, shared_path

QUERIES = queries()


def taken(df):
    return sorted(map(tuple, df.collect()), key=str)


# Archives

HTML = "<p>" + "x" * 1200 + "é</p>"
PAGES = [(1, "http://a/1", HTML), (7, "http://a/7?q=%0A b\r\n", HTML), (7, "http://a/7", HTML), (3, None, HTML), (None, "http://n/", HTML), (4, "http://a/4", "short"), (5, "u", "short"),
         (6, "", None), (8, " \u0085ü%", ""), (None, "x", "y" * 2000), (None, "x", "y" * 2000), (9, "http://z", "z" * 300000)]


def pages_of(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("own") for c in ("page", "digest", "size", "file", "_hash", "refers_to")})


def test_archives_of_odd_pages(spark):
    got = taken(archive.archived(pages_of(spark)).select("page", "url", "type", "digest", "refers_to", "payload_bytes"))
    want = []
    for page, url, html in PAGES:
        body = (html or "").encode()
        again = html == HTML and page != 7
        want.append((page, url, "revisit" if again else "response", hashlib.sha1(body).hexdigest(), 7 if again else None, len(body)))
    assert got == sorted(want, key=str)
    assert archive.archived(pages_of(spark, [])).count() == 0


def test_selected_records_and_the_payloads_of_revisits(spark):
    path = shared_path(spark, "warc-test")
    index = archive.write(pages_of(spark), path)
    assert index.columns == ["file", "offset", "length", "page", "url", "digest", "type"]
    some = index.where("page in (1, 3, 9)")
    got = {r["page"]: bytes(r["payload"]) for r in archive.payloads(index, some, path).collect()}
    assert got == {1: HTML.encode(), 3: HTML.encode(), 9: b"z" * 300000}
    assert archive.read(index.where("page = 4"), path).head()["payload"] == b"short"


@given(st.lists(st.tuples(st.integers(1, 50), st.integers(0, 30)), max_size=30))
@settings(max_examples=100, deadline=None)
def test_ranges_hold_each_record_once(steps):
    rows, at = [], 0
    for size, gap in steps:
        rows.append((at, size))
        at += size + gap
    reads = archive.ranges(rows, gap=10, most=60)
    assert [r for _, _, inside in reads for r in inside] == rows
    for start, size, inside in reads:
        assert inside[0][0] == start and inside[-1][0] + inside[-1][1] == start + size
        assert size <= 60 and all(b[0] - a[0] - a[1] <= 10 for a, b in zip(inside, inside[1:]))
    for a, b in zip(reads, reads[1:]):  # no two that could have been one
        assert b[0] - a[0] - a[1] > 10 or b[2][0][0] + b[2][0][1] - a[0] > 60


def test_a_damaged_record_is_refused():
    import zlib
    good = archive.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None, "1970-01-01T00:00:00Z")
    assert archive.parsed(good)["payload"] == b"payload"
    raw = zlib.decompress(good, 31).replace(b"payload\r\n", b"paXload\r\n")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        archive.parsed(packer.compress(raw) + packer.flush())


# Whitening

def symmetric(n, kind):
    r = np.random.default_rng(n)
    q = np.linalg.qr(r.standard_normal((n, n)))[0]
    e = {"any": r.random(n) * 100, "equal": np.full(n, 5.0), "rank": np.r_[np.zeros(n // 2), np.ones(n - n // 2)], "graded": np.logspace(3, -8, n), "pairs": np.repeat(r.random(n), 2)[:n],
         "signs": r.standard_normal(n)}[kind]
    return (q * e) @ q.T


@pytest.mark.parametrize("kind", ["any", "equal", "rank", "graded", "pairs", "signs"])
@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_divide_and_conquer_finds_the_eigenvectors(n, kind):
    a = symmetric(n, kind)
    a = (a + a.T) / 2
    values, vectors = whitening.divide(a)
    size = np.linalg.norm(a)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * n * size
    assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-14 * n * size
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() <= 1e-13


def test_the_polar_factor_is_the_sign_of_a_symmetric_matrix():
    a = symmetric(20, "signs")
    e, v = np.linalg.eigh((a + a.T) / 2)
    assert np.abs(whitening.polar((a + a.T) / 2) - (v * np.sign(e)) @ v.T).max() < 1e-12
    assert whitening.polar(np.zeros((3, 3))) is None


def brute_whitening(rows, components=16):
    """From (id, vector) with numpy's own eigenvectors: {(id, component): (n, deviation, |whitened|, explained)}."""
    x = {i: np.array([int(np.floor(64 * float(c))) + 1000000 for c in v]) for i, v in rows}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    out = {}
    for i, row in x.items():
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))
        for k in range(min(components, len(e))):
            out[i, k + 1] = (n, deviation, abs((row - s / n) @ q[:, -1 - k]) / np.sqrt(e[-1 - k]), e[-1 - k] / np.trace(v))
    return out


def test_whitening_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{DATA}/embeddings.parquet'").fetchall()
    want = brute_whitening([(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)])
    got = QUERIES["op12_whitening"](spark, DATA).collect()
    assert {(r["vec_id"], r["component"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(whitened, abs=1e-8) and r["explained"] == pytest.approx(explained, rel=1e-9)
        assert r["identity_error"] < 1e-9


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit("own"), "vec": F.lit("own"), "component": F.lit(0)})


def test_whitening_of_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0, 2.0]), (1, [1.0, 0.0, 2.0]), (2, [0.0, 0.0, 1.0]), (None, [3.0, 0.0, -1.0]), (4, None), (5, [None, 1.0, 1.0]), (6, [inf, 0.0, 0.0]), (7, [nan, 0.0, 0.0]), (8, []), (9, [1.0, 2.0])]
    got = whitening.whitened(vectors_of(spark, rows)).collect()
    assert sorted((str(r["vec"]), r["component"]) for r in got) == sorted([("1", k) for k in (1, 2, 3)] * 2 + [(v, k) for v in ("2", "None") for k in (1, 2, 3)])
    assert {r["n"] for r in got} == {3} and all((r["whitened"] is None) == (r["component"] == 3) for r in got)  # a dimension of no variance
    assert len({(r["component"], r["whitened"]) for r in got if r["vec"] == 1}) == 3  # copies are equal
    assert whitening.whitened(vectors_of(spark, [])).count() == 0
    alone = whitening.whitened(vectors_of(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in alone] == [(1, 0, None, None)] * 2


def test_deviation_is_exact_beyond_doubles(spark):
    rows = [(i, [float(2 ** 20 + i), 0.25 * i]) for i in range(5)] + [(9, [5e6, 1.0])]
    want = brute_whitening([(i, np.array(v, np.float32)) for i, v in rows])
    got = whitening.whitened(vectors_of(spark, rows)).collect()
    assert {(r["vec"], r["deviation"]) for r in got} == {(i, d) for (i, _), (_, d, _, _) in want.items()}
    huge = whitening.whitened(vectors_of(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 2.0])])).collect()
    assert len(huge) == 6 and all(r["deviation"] is None for r in huge if r["vec"] != 3)


# Collocations

def brute_phrases(rows, top=2000):
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for d in range(1, 5):
                for i in range(len(words) - d + 1):
                    f["und" if lang is None else lang][tuple(words[i:i + d])] += 1
    out = []
    for lang, many in f.items():
        n = sum(v for k, v in many.items() if len(k) == 1)
        found = {k: v for k, v in many.items() if len(k) > 1 and v >= 30}
        over = collections.Counter()
        for k, v in found.items():
            for m in range(2, len(k)):
                for i in range(len(k) - m + 1):
                    over[k[i:i + m]] = max(over[k[i:i + m]], v)
        kept = []
        for k, a in found.items():
            if 100 * over[k] < 80 * a:
                score, _, le, r = min((2000000 * a // (many[k[:j]] + many[k[j:]]), j, many[k[:j]], many[k[j:]]) for j in range(1, len(k)))
                kept.append((-score, -a, " ".join(k).encode(), a, le, r))
        out += [(lang, i, x[2].decode(), *x[3:], n, -x[0]) for i, x in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def test_collocations_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT lang, text FROM '{DATA}/documents.parquet'").fetchall()
    want = brute_phrases(rows)
    got = QUERIES["op13_collocations"](spark, DATA)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == want and len(want) >= 50


HARD = [("en", "Alpha beta gamma delta. ALPHA beta, gamma! " * 40), ("en", "alpha\tbeta \x0b beta gamma\x85delta alpha  beta " * 35), (None, "alpha beta " * 31), ("und", "alpha beta é "),
        ("de", None), ("de", ""), ("de", " .,; "), ("en", "solo " * 100), ("en", "x" * 30000 + " alpha beta"), ("fr", "l'été ßtraße 日本 語. " * 50), ("fr", "a b c d e f " * 45 + "! a b")] * 2


@pytest.mark.parametrize("budget, piece, words", [(1 << 18, 1 << 20, 1 << 20), (40, 256, 64), (1, 64, 8), (400, 1 << 20, 8)])
def test_small_budgets_and_buffers_change_nothing(spark, monkeypatch, budget, piece, words):
    """The functions run in workers of their own, so the constants are set there by the parameters of a call here."""
    docs = [pa.RecordBatch.from_pydict({"lang": [("und" if la is None else la) for la, _ in HARD], "text": [t or "" for _, t in HARD]})]
    for name, value in (("PIECE", piece), ("WORDS", words), ("BUDGET", budget)):
        monkeypatch.setattr(collocations, name, value)
    parts = [(lang, rows) for lang, rows in collocations.suffixes(iter(docs), 1, lambda h: h > 0) if len(rows)]
    name = {}
    for lang, text in zip(docs[0].column(0).to_pylist(), docs[0].column(1).to_pylist()):
        for data in collocations.spans(np.frombuffer(text.encode(), np.uint8)):
            w = collocations.words_of(data, collocations.salted(1, lang))
            name |= {(lang, h): bytes(data[a:b]) for h, a, b in zip(w.hashes.tolist(), w.start, w.end)}
    got = collections.Counter()
    for lang, rows in parts:
        distinct, n = collocations.distinct(rows, None)
        back = [collocations.unpacked(x) for x in collocations.packed(distinct, n)]
        assert (np.concatenate([r for r, _ in back]) == distinct).all() and (np.concatenate([m for _, m in back]) == n).all()
        for row, many in zip(distinct.tolist(), n.tolist()):
            got[lang, tuple(name[lang, h] for h in row if h)] += many
    want = collections.Counter()
    for lang, text in zip(docs[0].column(0).to_pylist(), docs[0].column(1).to_pylist()):
        for piece_ in re.split(rb"[.,;:!?\x0A-\x0D]", text.encode().lower()):
            ws = re.findall(rb"[^\x20\x09]+", piece_)
            want.update((lang, tuple(ws[i:i + 4])) for i in range(len(ws) - 1))
    assert got == want


@pytest.mark.parametrize("budget", [collocations.BUDGET, 200, 7])
def test_odd_texts_at_any_budget(spark, budget):
    docs = spark.createDataFrame([(la, t, 1) for la, t in HARD], "lang string, text string, phrase int").withColumns({"hash": F.lit(1), "n": F.lit(2)})
    assert taken(collocations.collocations(docs, budget=budget)) == sorted(brute_phrases(HARD), key=str)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", "a b " * 3)], "lang string, text string")).count() == 0


def test_top_cuts_after_ties_in_byte_order(spark):
    rows = [("en", " . ".join(f"{c}{i} {c}x{i}" for c in "bé" for i in range(9)) + " . ") for _ in range(30)]
    got = taken(collocations.collocations(saved(spark.createDataFrame(rows, "lang string, text string"), "ties"), top=11))
    assert got == sorted(brute_phrases(rows, 11), key=str) and len(got) == 11
