"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns: each has a defined result."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import chat, decontamination, exact, mixing, pages, repeats, simhash, tokens, toxicity, urls
from lodestrata.llm.queries import tokenizer_path

# Columns that clash with names the operators use themselves.
CLASH = ("doc", "score", "_text", "fingerprint", "rid", "n_bytes", "rate", "copies", "digest", "page", "host", "_bucket", "conv", "formatted")
LONG = "word " * 60000
DOCS = [(1, "A b c d e f g h"), (2, None), (3, ""), (4, " \t\n"), (5, "a  B\nc d e f g h"), (6, LONG), (None, "nobody's text here"), (None, None), (1, "A b c d e f g h"),
        (7, "x"), (8, "ß ﬁ 日本"), (9, "Abcdefgh " * 60), (10, "-" + "Abcdefgh " * 60)]


def clashing():
    return {c: F.lit("own") for c in CLASH}


def docs_of(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(clashing())


def taken(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_decontamination(spark):
    bench = spark.createDataFrame([("i", "a, b, c, d! e f g h"), ("none", None), ("short", "x"), ("i", "a, b, c, d! e f g h"), ("twin", "A b c d e f g H")], "item_id string, text string").withColumns(clashing())
    got = taken(decontamination.contamination(docs_of(spark), bench).select("doc", "contaminated", "n_items", "items"))
    found = {1: ["i", "twin"], 5: ["i", "twin"], 7: ["short"]}
    assert got == sorted([(d, d in found, len(found.get(d, [])), found.get(d, [])) for d, _ in DOCS], key=str)
    assert decontamination.contamination(docs_of(spark, []), bench).count() == 0
    assert decontamination.contamination(docs_of(spark), bench.limit(0)).where("contaminated").count() == 0


def test_toxicity(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 11)] + [(None, 1), (3, None), (4, 1), (77, 1)], "doc_id long, toxic int").withColumns(clashing())
    got = toxicity.toxicity(docs_of(spark), labels).collect()
    assert len(got) == len(DOCS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.held_out for r in got if r.doc is None} == {None}
    for nothing in (labels.limit(0), labels.where("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert not any(r.predicted for r in toxicity.toxicity(docs_of(spark), nothing).collect())
    assert toxicity.toxicity(docs_of(spark, []), labels).count() == 0


def test_extraction(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>" + "the of and " * 100000), (None, None, "<article>a</article>"), (None, None, "<article>a</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(clashing()).withColumn("text", F.lit("own"))
    got = {(r.page, r.n_chars) for r in pages.extract(df).collect()}
    assert got == {(1, 0), (2, 0), (3, 1099999), (None, 1)} and pages.extract(df).count() == 5
    assert pages.extract(df.limit(0)).count() == 0


def test_simhash(spark):
    got = {}
    for doc, fp, comp in taken(simhash.near_duplicates(docs_of(spark))):
        got.setdefault(doc, set()).add((fp, comp))
    assert {f for d in (2, 3, 4) for f, _ in got[d]} == {0} and {c for d in (2, 3, 4) for _, c in got[d]} == {2}
    assert got[1] == got[5] and {c for _, c in got[1]} == {1}
    assert (0, 2) in got[None] and sum(len(v) for v in got.values()) >= 10
    assert simhash.near_duplicates(docs_of(spark)).count() == len(DOCS)
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
    alone = simhash.near_duplicates(docs_of(spark, [(None, "q r s t"), (None, "q r s t")])).collect()
    assert [r.component for r in alone] == [None, None]


def test_chat(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (1, 2, None, None), (2, 0, "system", None), (None, None, "assistant", "<|\\"),
            (3, None, "user", "first"), (3, 0, "assistant", None), (4, 1, "assistant", LONG), (5, 0, "a<|im_sep|>", "<|im_end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(clashing())
    out = {r.conv: r for r in chat.read_back(chat.examples(df)).collect()}
    for conv in (1, 2, None, 3, 4, 5):
        turns = sorted((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv)
        said, loss = "".join(f"{r}\n{x}\n" for _, r, x in turns), "".join(x for _, r, x in turns if r == "assistant")
        got = out[conv]
        assert (got.n_turns, got.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    each = [(r.example, r.loss_start is None) for r in chat.examples(df).where("conv = 1").orderBy("example").collect()]
    assert each == [(2, False), (3, False), (4, True)]
    assert chat.read_back(chat.examples(df.limit(0))).count() == 0


def test_mixing(spark):
    labels = spark.createDataFrame([(1, "x"), (5, "y"), (6, "x"), (6, None), (7, "z"), (None, "x")], "doc_id long, domain string").withColumns(clashing())
    targets = {"x": 3, "y": 1}
    out = mixing.mix(docs_of(spark), labels, targets).collect()
    assert len(out) == len(DOCS) and all(r.rate >= 0 and sum(r.posteriors) == pytest.approx(1) for r in out)
    assert {r.n_tokens for r in out if r.doc in (2, 3, 4)} == {1}
    even = mixing.mix(docs_of(spark), labels.limit(0), {"x": 1, "y": 1}).collect()
    assert all(r.posteriors == pytest.approx([0.5, 0.5]) and r.rate == pytest.approx(1) for r in even)
    assert mixing.mix(docs_of(spark, []), labels, targets).count() == 0
    assert [r.posteriors for r in mixing.mix(docs_of(spark), labels, {"x": 1}).limit(1).collect()] == [[1.0]]


def test_exact(spark):
    out = exact.exact_duplicates(docs_of(spark), hash_all=True).collect()
    assert len(out) == len(DOCS)
    twins = [r for r in out if r.doc == 1]
    assert [r.group_size for r in twins] == [2, 2] and sorted(r.kept for r in twins) == [False, True]
    blank = {r.doc: (r.keep, r.kept) for r in out if r.doc in (2, 3, 4)}
    assert blank == {2: (4, False), 3: (4, False), 4: (4, True)}  # the most code points
    some = {r.doc for r in exact.exact_duplicates(docs_of(spark)).collect() if r.digest is None}
    assert 6 in some and 1 not in some
    assert exact.exact_duplicates(docs_of(spark, [])).count() == 0
    tie = exact.exact_duplicates(docs_of(spark, [(None, "a b"), (4, "a b"), (3, "ab "), (2, "ab")])).collect()
    assert {r.keep for r in tie} == {3} and [r.doc for r in tie if r.kept] == [3]


def test_tokens(spark):
    out = taken(tokens.encoded(docs_of(spark), tokenizer_path()))
    assert len(out) == len(DOCS) and sum(r[0] is None for r in out) == 2
    ordered = sorted(out, key=lambda r: r[1])
    assert [r[0] for r in ordered] == sorted((d for d, _ in DOCS), key=lambda d: (d is not None, d or 0))
    assert all(a[1] + a[2] == b[1] for a, b in zip(ordered, ordered[1:])) and {r[2] for r in out if r[0] in (2, 3)} == {1}
    assert tokens.encoded(docs_of(spark, []), tokenizer_path()).count() == 0


def test_repeats(spark):
    out = repeats.without_repeats(docs_of(spark)).collect()
    assert len(out) == len(DOCS)
    got = {r.doc: (r.n_bytes, r.n_removed, r.n_spans) for r in out if r.doc is not None}
    assert got[6] == (300000, 300000, 1) and got[9] == (540, 540, 1) and got[10] == (541, 540, 1) and got[1] == (15, 0, 0) and got[2] == (0, 0, 0)
    assert [bytes(r.kept) for r in out if r.doc == 10] == [b"-"]
    assert repeats.without_repeats(docs_of(spark, [])).count() == 0
    text_ids = spark.createDataFrame([("a", "x" * 250), ("b", "x" * 30)], "doc_id string, text string")
    assert taken(repeats.without_repeats(text_ids).select("doc", "n_removed")) == [("a", 250), ("b", 0)]


RULES = [("org", "/", "allow"), ("EXAMPLE.org", "/es/", "block"), ("org", "/", "block"), ("b.org", "/x", "allow"), ("org", "/x/y", "block"), ("net", "", "block")]
PAGES = [(1, None), (2, ""), (3, "no scheme"), (4, "http://Sub.Example.ORG/es/x?/q#h"), (5, "http://org"), (6, "http://org/"), (7, "http://a.b.org/x/y"), (7, "http://a.b.org/x/y"),
         (8, "x://y.net#f"), (9, "http://xorg/"), (None, "://.org/ a"), (10, "http://h/" + "p" * 100000)]


def test_urls(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string").withColumns(clashing())
    got = urls.judge(df, urls.Index.build(spark, RULES)).collect()
    assert len(got) == len(PAGES)
    found = {r.page: (r.host, r.rule, r.verdict) for r in got}
    assert found[1] == found[2] == found[3] == ("", None, "allow")
    assert found[4] == ("sub.example.org", "example.org/es/", "block") and found[5] == ("org", None, "allow") and found[6] == ("org", "org/", "block")
    assert found[7] == ("a.b.org", "b.org/x", "allow") and found[8] == ("y.net", "net", "block") and found[9][1] is None and found[None] == (".org", "org/", "block")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    joined = taken(urls.judge_by_join(df, rules))
    assert joined == sorted(((r.page, r.url, r.host, r.path, r.rule, r.verdict) for r in got), key=str)
    assert urls.judge(df.limit(0), urls.Index.build(spark, RULES)).count() == 0
    assert {r.verdict for r in urls.judge(df, urls.Index.build(spark, [])).collect()} == {"allow"}
    assert {r.verdict for r in urls.judge_by_join(df, rules.limit(0), default="block").collect()} == {"block"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(1, 11)] + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("i", "a b c d e f g h")], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("rows", [DOCS, []])
def test_stages(spark, folder, rows):
    """Rows of every odd kind, beside columns of any name, pass through all stages."""
    docs = docs_of(spark, rows).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
            assert {r.doc for r in out.select("doc").distinct().collect()} <= {"own"}
        else:
            assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        if not rows:
            assert out.count() == 0
    if rows:
        near = corpus_pipeline.drop_near_copies(spark, docs, folder).select("doc_id").collect()
        ids = [r[0] for r in near]
        assert ids.count(1) == 1 and 5 not in ids and ids.count(None) == 2 and {2, 3, 4} & set(ids) == {2}
        kept = [r[0] for r in corpus_pipeline.drop_benchmark(spark, docs, folder).select("doc_id").collect()]
        assert 1 not in kept and 5 not in kept and kept.count(None) == 2


def test_urls_of_very_many_labels(spark):
    """Only domains that a rule can have are made, so one URL costs no more than its length."""
    host = "a." * 30000 + "example.org"
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("a.example.org", "", "block")]
    rows = [(1, f"http://{host}/es/1"), (2, f"http://{'b' * 5000}.example.org/es/"), (3, "http://..org/"), (4, "http://example.org./"), (5, "http://org"), (5, "http://org")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    import time
    index = urls.Index.build(spark, rules)
    start = time.monotonic()
    got = taken(urls.judge(df, index).select("page", "rule", "verdict"))
    assert time.monotonic() - start < 20
    assert got == [(1, "example.org/es/", "block"), (2, "example.org/es/", "block"), (3, "org/", "allow"), (4, None, "allow"), (5, None, "allow"), (5, None, "allow")]
    assert sum(len(t) for t, _ in urls.candidates(host, "/es/1", [0, 1, 4], 3, 13)) < 200


def test_a_list_above_the_bound_gives_the_same_rows(spark, monkeypatch):
    rules = [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("com", "/fr/", "allow")]
    df = spark.createDataFrame([(1, "http://x.example.org/es/1"), (1, "http://x.example.org/es/1"), (2, None), (None, "http://a.com/fr/"), (3, "http://a.com/de/")], "page_id long, url string")
    small = urls.judged(df, rules)
    monkeypatch.setattr(urls, "MAX_RULES", 2)
    large = urls.judged(df, rules)
    assert small.columns == large.columns and taken(small) == taken(large)


RUSSIAN = "Весь этот текст написан на другом языке, и в нём нет ни одного из известных здесь служебных слов, но он длинный и без ссылок. " * 3
POLISH = "Wszystkie dzieci nasze są, a każde ma swoje ulubione zabawki oraz książki, których nigdy nikomu nie chce pożyczyć. " * 3
CHINESE = "这是一个很长的段落没有任何空格也没有任何已知语言的停用词但是它仍然是文章的正文而不是菜单或者页脚" * 6


@pytest.mark.parametrize("text", [RUSSIAN, POLISH, CHINESE])
def test_pages_in_other_languages_keep_their_text(text):
    body = text.strip()
    page = f"<html><body><nav><a href=x>one</a> <a href=y>two</a></nav><div><p>{body}</p><p>{body}</p></div><footer>{body}</footer></body></html>"
    assert pages.main_text(page) == f"{body}\n\n{body}"


PROSE = " ".join("It was the best of the times and it was not the worst of them for he that is in the house was with you on a day".split() * 4)


def test_a_teaser_does_not_replace_the_story():
    page = f"<div class=story><p>{PROSE} one</p><p>{PROSE} two</p></div><section><article><p>{PROSE}</p></article></section>"
    assert pages.main_text(page).startswith(f"{PROSE} one\n\n{PROSE} two")


def test_a_hint_does_not_decide_over_prose_in_an_article():
    page = f"<article><p>{PROSE} one</p><div class='alert-story share'><p>{PROSE} two</p><p>Share this</p></div><div class=comments><p>{PROSE}</p></div></article>"
    assert pages.main_text(page) == f"{PROSE} one\n\n{PROSE} two"
