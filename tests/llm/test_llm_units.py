"""The parts of the operators, on small inputs."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import chat, decontamination, mixing, pages, repeats, simhash, tokens, toxicity, urls
from lodestrata.llm.queries import tokenizer_path
from lodestrata.llm.store import sieve, sifted
from pyspark.sql import functions as F


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50256), st.integers(0, 2**64 - 1)), max_size=3000), st.integers(0, 300))
@settings(max_examples=60, deadline=None)
def test_words_pack_and_unpack(ids, zeros):
    x = np.array(ids + [0] * zeros + ids[:50], np.uint64)
    if len(x):
        words, sizes = tokens.pack(x)
        assert sizes.sum() == len(words) and (tokens.unpack(words, sizes, len(x)) == x).all()


def test_small_ids_share_words():
    words, _ = tokens.pack(np.ones(1024, np.uint64))
    assert len(words) == -(-1024 // 60)


ODD = ["", " ", "  a", "a  b", "a b ", "\n", "a\n\nb c", " a", "<|endoftext|> a", "don't 's it's", "a \n b", "tab\tx y\t z", "é è", "日本 語 text", "1 2 3.5 #a",
       "\x1c a b \x1f", "a b ​ c", "a  \n\nb", "x 'a' 'b'. \"'c", "90's", "\n'tis", "a × b", "ünïcode ñandú", "trail  ", "a_b-c...d", "l'été",
       "naïve—dash", "x́y", "'" * 5, "a' .b", "a" * 5000 + " " + "b " * 3000]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokenizer_path())


@given(st.lists(st.text(alphabet=st.sampled_from("abs\x1c\x1d\x1e\x1f\x00\x7f Z'.,\n\t 9é× _—"), max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_pieces_make_the_ids_of_the_text(encoder, texts):
    texts = texts + ODD[:3]
    ids, counts = encoder.encode(pa.array(texts, pa.large_string()))
    want = [np.array(e.ids + [tokens.END_ID]) for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and (ids == np.concatenate(want)).all()


def test_no_difference_from_the_library_in_many_random_texts(encoder):
    """Control characters, apostrophes, white space and letters in any order: 40,000 short texts."""
    draw = np.random.default_rng(3)
    alphabet = np.array(list("abst llreé ' ' .,\n\t\r9\x1c\x1d\x1e\x1f\x00\x0b\x0c\x7f\x85\xa0  ñ日_-"))
    for _ in range(40):
        texts = ["".join(alphabet[draw.integers(0, len(alphabet), n)]) for n in draw.integers(0, 14, 1000)]
        ids, counts = encoder.encode(pa.array(texts, pa.large_string()))
        want = [[*e.ids, tokens.END_ID] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_odd_texts_and_bounded_pieces(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "CHARS", 1600)
    monkeypatch.setattr(tokens, "REMEMBERED", 6)
    batch = pa.record_batch({"doc": pa.array(range(len(ODD) + 1)), "text": pa.array([*ODD, None], pa.string())})
    got = [encoder.encode(r.column(1)) for r in tokens.chunks([batch])]
    want = [np.array(e.ids + [0]) for e in encoder.tokenizer.encode_batch([*ODD, ""], add_special_tokens=False)]
    assert (np.concatenate([i for i, _ in got]) == np.concatenate(want)).all()


END = "<|endoftext|>"
HELD = [f"a {END} b", f"a{END}b", END, END * 2, f" {END}", "<|endoftext", "|>", f"x {END} y " * 400, f"{'word ' * 200}{END}{' word' * 200}"]


def test_added_tokens_are_told_as_the_library_tells_them(encoder, monkeypatch):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    monkeypatch.setattr(tokens, "CHARS", 1600)
    ids, counts = encoder.encode(pa.array([*HELD, *ODD], pa.large_string()))
    want = [[*plain.encode(t, add_special_tokens=False).ids, tokens.END_ID] for t in [*HELD, *ODD]]
    assert ids.tolist() == sum(want, []) and counts.tolist() == [len(w) for w in want] and want[0] == [64, 220, 50256, 275, tokens.END_ID]


def test_no_cut_in_or_beside_an_added_token(tmp_path, monkeypatch):
    """Tokens that hold spaces, or take those beside them, as a file may declare them."""
    from tokenizers import AddedToken, Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    plain.add_tokens([AddedToken("two words", normalized=False), AddedToken("stop", rstrip=True, normalized=False), AddedToken("alone", single_word=True, normalized=False)])
    plain.save(str(tmp_path / "t.json"))
    monkeypatch.setattr(tokens, "CHARS", 160)
    texts = [f"{'a ' * n}{middle}{' b' * 30}" for n in range(12) for middle in ("two words", "stop x", "alone", "notalone alone", "one two words stop two")]
    ids, _ = tokens.Encoder(str(tmp_path / "t.json")).encode(pa.array([*texts, "plain text of no kind"], pa.large_string()))
    assert ids.tolist() == sum(([*plain.encode(t, add_special_tokens=False).ids, tokens.END_ID] for t in [*texts, "plain text of no kind"]), [])


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 63), st.integers(0, 63), st.integers(0, 63)), max_size=150), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_bit_sliced_comparison_finds_all_pairs(bases, edits, radius):
    values = sorted({bases[b % len(bases)] ^ 1 << i ^ 1 << j ^ 1 << k for b, i, j, k in edits} | set(bases))
    half = len(values) // 2
    bucket = np.array([0] * half + [1] * (len(values) - half))
    got = {(int(i), int(j)) for a, b in simhash.within(np.array(values, np.uint64), bucket, radius) for i, j in zip(a, b)}
    assert got == {(i, j) for i, j in combinations(range(len(values)), 2) if bucket[i] == bucket[j] and (values[i] ^ values[j]).bit_count() <= radius}


def test_near_values_agree_on_a_mask():
    masks = simhash.block_masks((1 << 64) - 1, 2)
    assert len(masks) == 6
    for bits in combinations(range(0, 64, 3), 2):
        assert any(not m >> bits[0] & 1 and not m >> bits[1] & 1 for m in masks)


def test_large_buckets_are_divided(spark, monkeypatch):
    """All values share 32 bits and more; a bucket of three is already large."""
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 2**63, 12)]
    values = sorted({b ^ (1 << i) ^ (1 << j) for b in base for i, j in rng.integers(0, 20, (30, 2)).tolist()})
    frame = spark.createDataFrame([(v,) for v in values], "value long")
    plain = simhash.near_links(frame)
    monkeypatch.setattr(simhash, "LARGE", 3)
    divided = simhash.near_links(frame)

    def groups(links):
        root = {v: v for v in values}

        def top(v):
            while root[v] != v:
                v = root[v]
            return v
        for a, b in links.collect():
            assert (a ^ b).bit_count() > 0
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
        return {v: top(v) for v in values}
    direct = {v: v for v in values}
    for _ in range(len(values)):
        for a, b in combinations(values, 2):
            if (a ^ b).bit_count() <= 2:
                direct[a] = direct[b] = min(direct[a], direct[b])
        if all(direct[direct[v]] == direct[v] for v in values):
            break
    assert groups(plain) == groups(divided)
    assert {frozenset(v for v in values if g[v] == r) for g in (groups(plain),) for r in set(g.values())} == {frozenset(v for v in values if direct[v] == r) for r in set(direct.values())}


def test_a_chain_is_one_component(spark):
    from lodestrata.llm.components import components
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_seeds_lose_no_overlap():
    def lost(size, k):
        return [gone for gone in combinations(range(size), k) if not any(
            all(s + i not in gone for i in mask) for mask in decontamination.MASKS for s in range(size - max(mask)))]
    assert not any(lost(n, 2) for n in range(10, 14)) and not lost(8, 1) and not lost(9, 1)


def test_short_overlaps_are_found_whatever_was_replaced(spark):
    """Items of 8 to 13 tokens, and one of 20 by its last 13; alone, and with words around them."""
    docs, items, want = [], [], {}
    for size in (*range(8, 14), 20):
        words, allowed = [f"s{size}w{i}" for i in range(size)], 1 if size < 10 else 2
        items.append((size, " ".join(words)))
        words = words[-13:]
        for k in range(allowed + 2):
            for gone in combinations(range(len(words)), k):
                text = " ".join("other" if i in gone else w for i, w in enumerate(words))
                for around in (text, f"some {text} more words"):
                    want[len(docs)] = (True, [size], 1 - k / len(words)) if k <= allowed else (False, [], None)
                    docs.append((len(docs), around))
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc"]: (r["contaminated"], r["items"], r["overlap"] and pytest.approx(r["overlap"])) for r in got.collect()} == want


@pytest.mark.parametrize("common", [0, 2, 16])
def test_items_with_a_common_phrase_are_told_apart(spark, monkeypatch, common):
    """Items that share ten words, in documents that hold the phrase many times: every overlap, with its share, and no other."""
    rng = np.random.default_rng(common)
    phrase, names = "which of the following is not a kind of".split(), "abcdefgh"
    made = lambda n: phrase + [str(x) for x in rng.choice(list(names), n)]
    items = [(i, made(int(rng.integers(0, 8)))) for i in range(40)] + [(i, [*"xyz"[:i % 3], *made(2)]) for i in range(40, 50)] + [(50, ["q"] * 15), (51, ["q"] * 9)]
    docs = [sum((made(int(rng.integers(0, 6))) for _ in range(6)), []) for _ in range(30)] + [made(0), made(1), ["q"] * 14, []]
    docs += [[str(rng.choice(list(names))) if rng.random() < 0.1 else w for w in words] for _, words in items]

    def best(item, doc):
        size = min(len(item), 13)
        allowed = 0 if size < 8 else 1 if size < 10 else 2
        found = [sum(a == b for a, b in zip(item[i:i + size], doc[j:j + size])) for i in range(len(item) - size + 1) for j in range(len(doc) - size + 1)]
        return max(found, default=-1) / size if max(found, default=-1) >= size - allowed else None
    want = {}
    for d, doc in enumerate(docs):
        hit = {i: best(item, doc) for i, item in items}
        want[d] = (sorted(i for i, v in hit.items() if v), max((v for v in hit.values() if v), default=None))
    monkeypatch.setattr(decontamination, "COMMON", common)
    got = decontamination.contamination(spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string"),
                                        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {r["doc"]: (r["items"], r["overlap"]) for r in got} == {d: (i, v and pytest.approx(v)) for d, (i, v) in want.items()}
    assert 0 < sum(bool(i) for i, _ in want.values()) and any(not i for i, _ in want.values())


def test_items_of_few_tokens_are_found_word_for_word(spark):
    items = [(1, "Who wrote Hamlet?"), (2, "oh, yes"), (3, "one two three four five six seven"), (4, "..."), (5, None), (6, "Oh yes!"), (7, "a b c d e f g h")]
    docs = {"He asked: who wrote 'Hamlet'": [1], "Who wrote Macbeth, Hamlet": [], "oh yes oh yes": [2, 6], "Oh - yes": [2, 6], "one two three four five six seven": [3],
            "one two three four five six, seven oh yes": [2, 3, 6], "one two three four five six eight": [], "wrote Hamlet": [], "": [], "...": [], "who wrote": [], "a b x d e f g h": [7]}
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    for kept in (items, items[:6], items[:1]):
        got = {r["doc"]: r["items"] for r in decontamination.contamination(frame, spark.createDataFrame(kept, "item_id long, text string")).collect()}
        assert got == {d: [i for i in found if i in [k for k, _ in kept]] for d, found in enumerate(docs.values())}


def test_scripts_without_spaces_count_by_character(spark):
    def split(*texts):
        frame = spark.createDataFrame([(t,) for t in texts], "t string")
        words = F.split(F.regexp_replace(F.lower("t"), decontamination.CHARACTER, " $1 "), decontamination.BETWEEN)
        return [[w for w in r[0] if w] for r in frame.select(words).collect()]
    assert split("日本語 text、カー。", "ที่นี่ ๆ", "don't x́y—“Q”", "한국어 문장", "a𠀀b9", "はか\u3099・") == [
        ["日", "本", "語", "text", "カ", "ー"], ["ที่", "นี่", "ๆ"], ["don", "t", "x", "y", "q"], ["한국어", "문장"], ["a", "𠀀", "b9"], ["は", "か\u3099"]]
    text = "今天天气很好我们一起去公园散步吧"
    docs = spark.createDataFrame([(1, f"他说：{text}。"), (2, text.replace("公", "花")), (3, "今天天气不好"), (4, text[:4])], "doc_id long, text string")
    items = spark.createDataFrame([(1, text), (2, "天气很好")], "item_id long, text string")
    got = {r["doc"]: r["items"] for r in decontamination.contamination(docs, items).collect()}
    assert got == {1: [1, 2], 2: [1, 2], 3: [], 4: []}


def test_a_benchmark_in_blocks(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, "x " + " ".join(words[:20]) + " y"), (2, " ".join(words[30:45]).replace("w33", "no").replace("w38", "no").upper()), (3, " ".join(words[30:45:2]))], "doc_id long, text string")
    items = spark.createDataFrame([(f"i{a}", ", ".join(words[a:a + 15])) for a in (0, 30, 45)], "item_id string, text string")
    whole = sorted(map(tuple, decontamination.contamination(docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_TOKENS", 10)
    assert sorted(map(tuple, decontamination.contamination(docs, items).collect())) == whole
    assert [(r[0], r[1], r[4]) for r in whole] == [(1, True, ["i0"]), (2, True, ["i30"]), (3, False, [])]


@pytest.mark.parametrize("block", [4_000_000, 100])
def test_only_a_sieve_of_a_benchmark_is_broadcast(spark, monkeypatch, block):
    """Of 60 texts, each in two items, next to nothing stands in documents: neither texts nor seeds are sent out, and each text is searched for once."""
    rng, sent, kept = np.random.default_rng(0), [], []
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, n)) for n in rng.integers(3, 30, 60)]
    docs = [f"some words {texts[7]} and {texts[8].upper()}", f"{' '.join(texts[9].split()[:-1])} x", "", None, " ".join(texts[10].split()[::-1])]
    broadcast, saved = F.broadcast, decontamination.saved
    monkeypatch.setattr(F, "broadcast", lambda df: sent.append(df) or broadcast(df))
    monkeypatch.setattr(decontamination, "saved", lambda df, name: kept.append((name, saved(df, name))) or kept[-1][1])
    monkeypatch.setattr(decontamination, "BLOCK_TOKENS", block)
    out = decontamination.contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
                                        spark.createDataFrame([(i, texts[i % 60]) for i in range(120)], "item_id long, text string"))
    want = [[7, 8, 67, 68], [9, 69] if len(texts[9].split()) >= 8 else [], [], [], []]
    assert [r["items"] for r in sorted(out.collect(), key=lambda r: r["doc"])] == want
    assert sent and all(df.columns == ["_bucket", "_bits"] and df.count() <= 1 << decontamination.BUCKET_BITS for df in sent)
    assert all(len(r["_bits"]) == decontamination.WORDS for df in sent for r in df.collect())
    assert [df.count() for name, df in kept if name == "items"] == [60] and (sum(name == "seeds" for name, _ in kept) > 1) == (block == 100)


@pytest.mark.parametrize("spread, target", [(0.05, 0.7), (0.1, 0.7), (0.1, 0.5), (0.3, 0.95)])
def test_domains_hard_to_tell_apart_meet_their_targets(spark, spread, target):
    rng = np.random.default_rng(5)
    x = np.clip(0.6 + spread * rng.standard_normal(4000), 0.001, 0.999)
    p, n = np.c_[x, 1 - x], rng.integers(1, 2000, 4000)
    frame = spark.createDataFrame([(int(a), b) for a, b in zip(n, p.tolist())], "n_tokens long, posteriors array<double>").cache()
    steps, miss = mixing.fit_rates(frame, np.array([target, 1 - target]) * n.sum())
    rates = np.ones(4000)
    for s in steps:
        rates = np.maximum(0, rates - p @ np.array(s))
    assert (n * rates) @ p / n.sum() == pytest.approx([target, 1 - target], abs=1e-5) and abs(miss).max() <= 1e-5 * n.sum() and len(steps) <= 60


def test_targets_out_of_reach_are_told(spark):
    docs = spark.createDataFrame([(i, "some words") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, domain string")
    with pytest.warns(UserWarning, match="misses its targets"):
        out = mixing.mix(docs, labels, {"x": 7, "y": 3}).collect()
    assert all(r.missed == pytest.approx([-0.2, 0.2]) for r in out)


def test_words_of_long_texts_are_hashed_in_pieces(monkeypatch):
    data = np.frombuffer(("Ab c9, déjà-vu " * 50).encode(), np.uint8)
    whole = toxicity.words(data)
    monkeypatch.setattr(toxicity, "PIECE", 37)
    assert (toxicity.words(data) == whole).all() and len(whole) == 200 and len(set(whole.tolist())) == 4


def test_ftrl_learns_few_weights():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(1500):
        x = set(rng.integers(10, 4000, 60).tolist())
        y = int(i % 9 == 0)
        rows.append((np.unique(np.array(sorted(x | ({1, 2} if y else set())), np.uint32)), y))
    model = toxicity.fit(rows)
    assert len(model.buckets) < 200 and {1, 2} <= set(model.buckets.tolist()) and min(model.weights[np.isin(model.buckets, [1, 2])]) > 1


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a> Site name</header><div id="cookie-notice">We use cookies and the like for the site.</div>
<div><h1>A title</h1><p>It is the first of many paragraphs that a reader of this page is to see, and it has words of the kind that one expects in the text of an article, as it was written for you to read it in the morning with the sun on the sea.</p><p>Short &amp; fine.</p>
<p>The last of the paragraphs is as long as the first, and it was made so by the hand of the one who wrote it, for the rules are that a long block with the words of the language is good, and the short are not on their own.</p></div>
<ul><li><a href=x>More</a></li><li><a href=y>Other</a></li></ul><section class="comments"><p>I am the one who says that this is not to be in the text of an article, for it is a comment of the reader and it is as long as the others are in it, so that the rules of length would be for it and not against it.</p></section>
<div>&copy; 2020 Some one</div><form><p>It is a form and not the text of the article that you are to read, for all the words in it that are as they are in the others of the page.</p></form><script>if (a<b) x("</p>")</script></body></html>"""


def test_main_text_without_an_article():
    blocks = pages.main_text(PAGE).split("\n\n")
    assert [b[:8] for b in blocks] == ["A title", "It is th", "Short & ", "The last"]


def test_an_article_keeps_its_short_blocks():
    page = "<nav><a href=a>x</a></nav><article><h1>Only</h1><div class='ad'>Buy it now</div><p>To.<p>Be\n it &lt; so<aside>No</aside></article><p>out</p><footer>f</footer>"
    assert pages.main_text(page) == "Only\n\nTo.\n\nBe it < so"


def test_frames_headers_and_comments():
    body = "<p>The words of the article are as they are, and it is for you to read them on and on, with all that is in the text of the page.</p>"
    page = f"""<div class="page with-sidebar"><div id="menu-wrapper" class="nav"><div class="banner"><main><div class="entry-header"><h1>Head</h1></div>{body}
      <p class="byline">By One</p><table><tr><td>a <td>b</table><div class="share">Share this</div></main></div></div>
      <div class="sidebar"><p>{body}</p></div><article class="comment"><p>{body}</p></article></div>"""
    text = pages.main_text(page)
    assert text.split("\n\n")[0] == "Head" and text.endswith("By One\n\na\n\nb") and text.count("words of the article") == 1


@pytest.mark.parametrize("page", [None, "", "<", "<p", "a<b", "<p>x", '<a "', "<!--", "<script>", '<div class="a>b">t</div>', "<p>" * 5, "</p></div>", "<article>"])
def test_broken_pages_do_no_harm(page):
    assert isinstance(pages.main_text(page), str)


def test_extraction_is_linear():
    import time
    start = time.time()
    for page in ('<a "' * 100000, "<" * 200000, "<p>a b <b>" * 40000, "<script>" * 20000):
        pages.main_text(page)
    assert time.time() - start < 30


def test_digests_that_collide_are_told_apart():
    index = urls.Index("")
    index.keys, index.starts, index.marks = np.array([5, 5], np.uint64), np.array([0, 4, 8], np.uint64), np.array([3 * 2, 3 * 2 + 1], np.uint64)
    index.texts = np.frombuffer(b"org/com/", np.uint8)
    real, urls.xxhash.xxh64_intdigest = urls.xxhash.xxh64_intdigest, lambda t: 5
    try:
        assert index.look(["com/", "org/", "net/"], [3, 3, 3]).tolist() == [2, 1, 0]
    finally:
        urls.xxhash.xxh64_intdigest = real


def test_escapes_are_reversible(spark):
    texts = ["", "<|im_end|>", "<\\|im_end|>", "\\<|", "\\\\|<|<|", "a\n|\\", "<", "|>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    assert df.where(F.col("e").contains("<|")).count() == 0 and df.where(chat.unescaped(F.col("e")) != F.col("t")).count() == 0


def test_a_sieve_holds_back_no_key(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    out = sifted(spark.range(3000), "id", sieve(keys, "k"), "some")
    assert out.where("id % 3 = 0 AND NOT some").count() == 0 and out.where("id % 3 <> 0 AND some").count() < 400 and out.count() == 3000


def test_runs_of_pieces_cover_every_string_once(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abc "), n)) for n in (0, 5, 19, 20, 200, 701)]
    column = pa.array(texts)

    def starts():
        out = []
        for held in repeats.buffers(column, 20):
            piece, bucket, _, place, more = repeats.runs(held, 20, 6)
            out += [(held[p][0], int(s) + k, int(b)) for p, b, s, m in zip(piece, bucket, place, more) for k in range(m + 1)]
        return sorted(out)
    whole = starts()
    assert [(d, s) for d, s, _ in whole] == [(d, s) for d, t in enumerate(texts) for s in range(len(t) - 19)]
    monkeypatch.setattr(repeats, "PIECE", 50)
    monkeypatch.setattr(repeats, "BUFFER", 120)
    assert starts() == whole


def brute_ftrl(rows):
    """FTRL-proximal with one dictionary per state, document by document."""
    t = toxicity
    seen = {}
    for x, _ in rows:
        for f in x.tolist():
            seen[f] = seen.get(f, 0) + 1
    z, n = {f: 0.0 for f, k in seen.items() if k >= t.LEAST}, {f: 0.0 for f, k in seen.items() if k >= t.LEAST}

    def weight(f):
        return 0.0 if abs(z[f]) <= t.L1 else -(z[f] - np.sign(z[f]) * t.L1) / ((t.BETA + n[f] ** 0.5) / t.ALPHA + t.L2)
    positive = sum(y for _, y in rows)
    bias, squares, order = np.log((positive + 0.5) / (len(rows) - positive + 0.5)), 1.0, np.random.default_rng(0)
    for _ in range(t.PASSES):
        for i in order.permutation(len(rows)):
            x, y = [f for f in rows[i][0].tolist() if f in z], rows[i][1]
            w = {f: weight(f) for f in x}
            g = 1 / (1 + np.exp(-np.clip(bias + sum(w.values()), -35, 35))) - y
            for f in x:
                z[f] += g - ((n[f] + g * g) ** 0.5 - n[f] ** 0.5) / t.ALPHA * w[f]
                n[f] += g * g
            squares += g * g
            bias -= 0.1 / squares ** 0.5 * g
    return {f: weight(f) for f in z if weight(f)}, bias


def labelled(many):
    draw = np.random.default_rng(5)
    plain, bad = [f"w{i}" for i in range(60)], ["vile", "foul", "rot"]
    out = []
    for i in range(many):
        words, y = list(draw.choice(plain, 25)), int(i % 3 == 0)
        if y:
            words[4:4] = draw.choice(bad, 3)
        out.append((i, " ".join(words), y))
    return out


def test_ftrl_against_brute_force():
    rows = [(np.unique(toxicity.features(toxicity.words(np.frombuffer(t.encode(), np.uint8)))), y) for _, t, y in labelled(300)]
    want, bias = brute_ftrl(rows)
    model = toxicity.fit(rows)
    assert dict(zip(model.buckets.tolist(), model.weights.tolist())) == pytest.approx(want) and model.bias == pytest.approx(bias) and want


def test_learning_prunes_features_without_loss_and_keeps_to_its_bounds(spark, monkeypatch):
    rows = labelled(400)
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    import zlib
    used = sorted(((str(i), np.unique(toxicity.features(toxicity.words(np.frombuffer(t.encode(), np.uint8)))), y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5),
                  key=lambda r: r[0])
    want = toxicity.fit([(x, y) for _, x, y in used])
    got = toxicity.learn(docs, labels)
    assert got.buckets.tolist() == want.buckets.tolist() and got.weights == pytest.approx(want.weights) and got.bias == pytest.approx(want.bias)
    monkeypatch.setattr(toxicity, "FEATURES", 0)
    assert not len(toxicity.learn(docs, labels).buckets)
