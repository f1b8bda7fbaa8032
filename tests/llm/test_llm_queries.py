"""Every registered query of the training-data operators: against its SQL, or against brute force on whole tables."""

import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from conftest import DATA
from lodestrata.llm import decontamination
from lodestrata.llm.queries import TARGETS, oracles, queries, tokenizer_path

import corpus_pipeline

QUERIES, ORACLES = queries(), oracles()
TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(con):
    return {d: t or "" for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}


def rows(spark, name):
    df = QUERIES[name](spark, DATA)
    return [r.asDict() for r in df.collect()]


def canonical(found, names):
    return sorted(tuple(str(r[n]) for n in sorted(names)) for r in found)


def test_one_query_for_each_operator():
    assert [sum(k.startswith(f"op{n}_") for k in QUERIES) for n in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    want = [dict(zip(names, r)) for r in cur.fetchall()]
    got = rows(spark, name)
    assert set(got[0]) == set(names) and canonical(got, names) == canonical(want, names)


def words_of(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def overlaps(doc, item):
    """Best share of equal words of a window of the item laid along the document, if that is an overlap."""
    size = min(len(item), decontamination.WINDOW)
    need, best = size - (1 if size < 10 else 2), 0
    for shift in range(size - len(item), len(doc) - size + 1):
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        if high - low < size:
            continue
        same = np.cumsum([0] + [item[i] == doc[i + shift] for i in range(low, high)])
        best = max(best, int((same[size:] - same[:-size]).max()))
    return best / size if best >= need else 0


def test_decontamination_against_brute_force(spark, con, texts):
    items = [(i, words_of(t)) for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()]
    got = {r["doc_id"]: r for r in rows(spark, "op1_decontamination")}
    assert set(got) == set(texts)
    for d, text in texts.items():
        doc, want = words_of(text), {}
        for i, item in items:
            if len(set(doc) & set(item)) * 3 >= len(set(item)) and (share := overlaps(doc, item)):
                want[i] = share
        r = got[d]
        assert r["items"] == ",".join(str(i) for i in sorted(want)) and r["n_items"] == len(want) and r["contaminated"] == bool(want)
        assert r["overlap"] == (max(want.values()) if want else None)
    assert any(r["contaminated"] for r in got.values())


def test_toxicity_on_held_out_documents(spark, con):
    labels = dict(con.execute("SELECT doc_id, toxic FROM labels").fetchall())
    got = rows(spark, "op2_toxicity")
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) >= 0.9 and not any(p for y, p in held if not y)


def test_main_text_is_the_article(spark, con):
    pages = dict(con.execute("SELECT page_id, html FROM pages").fetchall())
    import html
    for r in rows(spark, "op3_main_text"):
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in want if b) and r["n_chars"] == len(r["text"])


def brute_fingerprint(text, n=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius=2):
    names = sorted(values)
    parent = {d: d for d in names}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d
    for i, a in enumerate(names):
        for b in names[:i]:
            if (values[a] ^ values[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in names}


def test_simhash_against_brute_force(spark, texts):
    values = {d: brute_fingerprint(t) for d, t in texts.items()}
    want = brute_components(values)
    got = rows(spark, "op4_simhash")
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {d: (f"{values[d]:016x}", want[d]) for d in texts}


def test_mixing_reaches_its_targets(spark, texts):
    got = rows(spark, "op6_mixing")
    assert {r["doc_id"] for r in got} == set(texts)
    total = sum(r["n_tokens"] for r in got)
    for domain, share in TARGETS.items():
        assert sum(r["n_tokens"] * r["rate"] * r[f"p_{domain}"] for r in got) == pytest.approx(share * total, rel=1e-3)
    assert all(r["rate"] >= 0 and int(r["rate"]) <= r["copies"] <= int(r["rate"]) + 1 for r in got)
    assert all(sum(r[f"p_{d}"] for d in TARGETS) == pytest.approx(1) for r in got)


def brute_tokens(docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    out, at = [], 0
    for d, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_against_the_tokenizer(spark, texts):
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows(spark, "op8_token_files"))
    assert got == brute_tokens(sorted(texts.items()))


def brute_cut(texts, length):
    data = {d: t.encode() for d, t in texts.items()}
    seen = {}
    for x in data.values():
        for i in range(len(x) - length + 1):
            seen[x[i:i + length]] = seen.get(x[i:i + length], 0) + 1
    out = {}
    for d, x in data.items():
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                gone[i:i + length] = True
        out[d] = (len(x), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), bytes(np.frombuffer(x, np.uint8)[~gone]))
    return out


def test_repeats_against_brute_force(spark, texts):
    import hashlib
    want = {d: (n, r, s, hashlib.sha256(k).hexdigest()) for d, (n, r, s, k) in brute_cut(texts, 200).items()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows(spark, "op9_repeats")}
    assert got == want and any(r for _, r, _, _ in want.values())


def test_pipeline_stages_take_effect(spark, con, texts):
    """Each stage against what its operator's brute force, or its own report, says of its input."""
    from lodestrata.llm.store import saved
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "benchmark", "mixing", "tokens"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, docs, DATA), name)
        seen[name] = sorted(r[0] for r in out.select("doc_id").collect())
        if name != "tokens":
            assert out.columns == docs.columns
            for r in out.collect():
                assert r["text"] == texts[r["doc_id"]]
        docs = out
    toxic = {r["doc_id"] for r in rows(spark, "op2_toxicity") if r["predicted"]}
    assert toxic and seen["toxicity"] == sorted(set(texts) - toxic)
    components = brute_components({d: brute_fingerprint(texts[d]) for d in seen["toxicity"]})
    assert seen["near_copies"] == sorted(d for d, c in components.items() if d == c) and seen["near_copies"] != seen["toxicity"]
    items = [words_of(t) for _, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()]
    clean = []
    for d in seen["near_copies"]:
        doc = words_of(texts[d])
        if not any(len(set(doc) & set(i)) * 3 >= len(set(i)) and overlaps(doc, i) for i in items):
            clean.append(d)
    assert seen["benchmark"] == clean
    assert set(seen["mixing"]) <= set(clean) and len(set(seen["mixing"])) > 0.8 * len(clean)
    assert seen["tokens"] == seen["mixing"]
    files = sorted(tuple(r) for r in docs.select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert files == sorted(brute_tokens([(d, texts[d]) for d in seen["mixing"]]))
