"""Token ids as files of Simple-8b words: written in order of document id, decoded a block at a time."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.store import bounded_batches, kept, saved, shared_path, tidy

# Ids of a block; blocks packed, unpacked and read at a time.
BLOCK, AT_ONCE = 1024, 512
# Words whose ids a worker remembers, the longest of them, and the bytes of text it encodes at a time; and how many
# words are remembered where a caller asks for smaller pieces.
REMEMBERED, WORD, CHARS, FEW = 400_000, 64, 1 << 21, 100_000
END_ID = 0
MAGIC = b"S8BLOCK1"

# Simple-8b layouts, fixed values: (ids in a word, bits of an id) by selector, in the word's top four bits.
# Selector 0 is the escape: the next word is one id as it is. Selector 1 is a run of zeros.
LAYOUTS = [(1, 64), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
COUNTS = np.array([c for c, _ in LAYOUTS])


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id; from 2^53 on it may be one too many, which only costs room."""
    if len(ids) and ids.max() < len(_WIDTHS):
        return _WIDTHS[ids]
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


_WIDTHS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """uint64 ids to (words, words of each block). All blocks are walked at once, each from its own start."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    kind = np.uint32 if n and ids.max() >> np.uint64(32) == 0 else np.uint64
    grid = np.zeros((blocks, BLOCK + 128), kind)  # blocks end in zeros, which fit anywhere; a reader knows how many ids there are
    flat = np.zeros(blocks * BLOCK, kind)
    flat[:n] = ids
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    flat_grid = grid.ravel()
    most = {1: widths(grid)}  # by length: the widest of so many ids from here on
    for k in (2, 4, 8, 16, 32, 64):
        half = most[k // 2]
        most[k] = half.copy()
        most[k][:, :-(k // 2)] = np.maximum(half[:, :-(k // 2)], half[:, k // 2:])
    fits = np.zeros(grid.shape, np.uint8)  # what a layout holds, every later one holds; with none, 16 becomes 0, the escape
    for count, bits in LAYOUTS[1:]:
        k = max(x for x in most if x <= count)
        fit = most[k] <= bits
        if count > k:
            fit[:, :k - count] &= fit[:, count - k:]
        fits += fit
    choice = len(LAYOUTS) - fits & len(LAYOUTS) - 1
    ends = np.full(blocks, BLOCK)
    ends[-1:] = n - (blocks - 1) * BLOCK
    place, row, steps = np.zeros(blocks, np.int64), np.arange(blocks) * grid.shape[1], []
    flat_choice = choice.ravel()
    while (live := place < ends).any():
        picked = flat_choice[row + np.minimum(place, BLOCK)]
        steps.append((live, place, picked))
        place = place + COUNTS[picked] * live
    live, start, selector = (np.stack([s[k] for s in steps], axis=1) if steps else np.zeros((0, 0), bool) for k in range(3))
    line, start, selector = np.nonzero(live)[0], start[live], selector[live].astype(np.int64)
    size = 1 + (selector == 0)
    at = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[at] = selector.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in enumerate(LAYOUTS):
        mine = selector == s
        if s == 0:
            words[at[mine] + 1] = grid[line[mine], start[mine]]
        elif bits and mine.any():
            first, word = (line * grid.shape[1] + start)[mine], np.zeros(int(mine.sum()), np.uint64)
            for k in range(count):
                word |= flat_grid[first + k].astype(np.uint64) << np.uint64(bits * k)
            words[at[mine]] |= word
    return words, np.bincount(line, weights=size, minlength=blocks).astype(np.int64)


def unpack(words: np.ndarray, block_words: np.ndarray, n: int) -> np.ndarray:
    """Whole blocks back to their n ids; only the last block may be short."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == 0):  # escapes are rare: only ids of more than 60 bits
        if not raw[i]:
            raw[i + 1] = True
    line = np.repeat(np.arange(len(block_words)), block_words)
    count = np.where(raw, 0, COUNTS[selector])
    before = np.cumsum(count) - count
    first = np.cumsum(block_words) - block_words
    start = before - np.repeat(before[first], block_words)  # within its block
    out = np.zeros(len(block_words) * BLOCK, np.uint64)
    for s, (c, bits) in enumerate(LAYOUTS):
        mine = np.flatnonzero((selector == s) & ~raw)
        if not len(mine) or s == 1:
            continue
        body = words[mine + 1][:, None] if s == 0 else (words[mine][:, None] >> (np.uint64(bits) * np.arange(c, dtype=np.uint64))) & np.uint64((1 << bits) - 1)
        inside = start[mine][:, None] + np.arange(c)
        kept = inside < BLOCK
        out[(line[mine][:, None] * BLOCK + inside)[kept]] = body[kept]
    return out[:n]


# Bytes by what they are in a text, as bits: letters (and the apostrophe, which may belong to a word), white
# space, marks, apostrophes, and lead bytes of characters that may be any of these; of two-byte characters those
# from U+00C0 to U+024F are taken as letters.
_B = np.arange(256)
LETTER, BLANK, MARK, QUOTE, UNSURE = 1, 2, 4, 8, 16
_LETTERS = ((_B | 32 >= 97) & (_B | 32 <= 122) & (_B < 128)) | (_B == 39) | ((_B >= 0x80) & (_B < 0xC0)) | ((_B >= 0xC3) & (_B <= 0xC9))
_BLANKS = ((_B >= 9) & (_B <= 13)) | (_B == 32)
_MARKS = (_B < 128) & ~_LETTERS & ~_BLANKS & ~((_B >= 48) & (_B <= 57))
KIND = (LETTER * _LETTERS + BLANK * _BLANKS + MARK * _MARKS + QUOTE * (_B == 39) + UNSURE * ((_B == 0xC2) | (_B > 0xC9))).astype(np.uint8)

# The byte-level vocabulary's character for each byte, by its published rule: printable ones stand for
# themselves, the others follow from U+0100 on in order.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
AS_CHAR = {b: chr(b) if b in _SELF else chr(256 + sum(x not in _SELF for x in range(b))) for b in range(256)}


class Encoder:
    """Ids of texts by the tokenizers library, which sees a frequent word once and not each time.

    Texts are cut where the tokenizer starts a new piece in any case: before and after a run of letters, with
    the one space before it. So the pieces' ids are the text's. Arrow tells the different pieces apart; those that
    are not remembered are encoded, many at a time. A text with a place that might be no such cut (rare
    characters, white space side by side before a letter, apostrophes beside other marks), or that holds an added
    token's content, which the library takes for that token, is encoded by itself.
    """

    CUT = re.compile(r"(?<=[\w.,]) (?=\w)")

    def __init__(self, path: str, chars: int | None = None):
        self.chars = chars
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and every thread memory of its own
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.line = vocabulary["Ċ"]
        self.words = Tokenizer(self.tokenizer.model)  # for runs of letters, which need not be cut any further
        self.words.pre_tokenizer = WhitespaceSplit()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def whole(self, text: str) -> bytes:
        """A text of any kind, in parts of bounded length where it can be cut: not in or beside an added token."""
        parts, start = [], 0
        for m in self.CUT.finditer(text):
            at = m.start()
            if at - start > (self.chars or CHARS) // 16 and not any(text.find(x, max(0, at - len(x)), at + len(x)) >= 0 for x in self.added):
                parts.append(text[start:at])
                start = at
        return b"".join(x for p in [*parts, text[start:]] for x in self.plain([p]))

    def added_at(self, data: bytes) -> np.ndarray:
        """Places where an added token's content starts."""
        found = []
        for x in map(str.encode, self.added):
            at = data.find(x)
            while at >= 0:
                found.append(at)
                at = data.find(x, at + 1)
        return np.array(found, np.int64)

    def together(self, words: list[bytes], spaced: bool) -> list[bytes]:
        """Ids of many runs of letters, each after a space or each without one, told apart by their first ids."""
        gap = " " if spaced else f" {AS_CHAR[10]} "
        each = [self.words.encode_batch_fast([(" " if spaced else gap) + b"\xff".join(words[at:at + 300]).decode("latin-1").translate(AS_CHAR).replace(
            AS_CHAR[255], gap)], add_special_tokens=False)[0].ids for at in range(0, len(words), 300)]  # no byte of a text is 0xFF
        ids = np.concatenate([np.array(x, "<u4") for x in each]) if each else np.zeros(0, "<u4")
        first = np.flatnonzero(self.spaced[ids] if spaced else ids == self.line)
        if len(first) != len(words):
            return self.plain([w.decode() for w in words])
        raw, at = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
        return [raw[a + 4 * (not spaced):b] for a, b in zip(at, at[1:])]

    def pieces(self, pieces: list[bytes], kinds: np.ndarray) -> list[bytes]:
        """The ids of each piece; kinds: 0 a word after a space, 1 a word, 2 anything else."""
        if len(self.known) > (REMEMBERED if self.chars is None else FEW) // 2:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, pieces))
        unseen = [i for i, x in enumerate(found) if x is None]
        missing: tuple[list[int], list[int], list[int]] = ([], [], [])
        for i, kind in zip(unseen, kinds[unseen].tolist()):
            found[i] = self.older.get(pieces[i])
            if found[i] is None:
                missing[kind].append(i)
        for kind, at in enumerate(missing):
            own = [pieces[i] for i in at]
            for i, x in zip(at, self.plain([w.decode() for w in own]) if kind == 2 else self.together(own, kind == 0)):
                found[i] = x
        self.known.update((pieces[i], found[i]) for i in unseen if len(pieces[i]) <= WORD)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``END_ID`` behind, and the number of ids of each."""
        texts = texts.cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True  # where a text starts
        kind = KIND[data]
        letter, blank = (kind & LETTER).view(bool), (kind & BLANK) > 0
        joined = ~edge[1:-1]  # a byte and the next are of one text
        attached = np.zeros(len(data), bool)  # the space before a word
        attached[:-1] = (data[:-1] == 32) & letter[1:] & joined
        turn = np.zeros(len(data), bool)
        turn[1:] = (letter[1:] != letter[:-1]) & ~attached[:-1]
        start = np.flatnonzero(turn | attached | edge[:-1])

        odd = [np.flatnonzero(kind & UNSURE), np.flatnonzero((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))]
        odd.append(np.flatnonzero(letter[2:] & blank[1:-1] & (data[1:-1] != 32) & blank[:-2] & joined[1:] & joined[:-1]))
        quotes = np.flatnonzero(kind & QUOTE)
        for step in (-1, 1):  # an apostrophe and a mark beside it are one piece
            near = np.clip(quotes + step, 0, max(0, len(data) - 1))
            odd.append(quotes[(kind[near] & MARK) > 0])
        odd.append(self.added_at(data.tobytes()))
        careful = np.unique(np.searchsorted(bounds, np.concatenate(odd), "right") - 1)

        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.r_[start, len(data)].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        told = pc.dictionary_encode(column)
        codes, values = told.indices.to_numpy().astype(np.int64), told.dictionary
        at = np.zeros(len(values), np.int64)
        at[codes] = start  # one place of each different piece
        ahead = np.minimum(at + 1, max(0, len(data) - 1))
        kinds = np.where(letter[at], 1, np.where(attached[at] & letter[ahead], 0, 2)) if len(at) else at
        if len(quotes):  # words with an apostrophe may be several pieces
            kinds[codes[np.searchsorted(start, quotes, "right") - 1]] = 2
        doc = np.searchsorted(bounds, start, "right") - 1
        kept = np.flatnonzero(~np.isin(doc, careful)) if len(careful) else np.arange(len(start))
        if len(careful):  # their pieces are not looked up
            used = np.unique(codes[kept])
            values, kinds = values.take(pa.array(used)), kinds[used]
            codes = np.searchsorted(used, codes)
        ids = self.pieces(values.to_pylist(), kinds)

        # The table of all pieces: the words, the careful texts, the end.
        table = [*ids, *(self.whole(texts[i].as_py().decode()) for i in careful.tolist()), np.array([END_ID], "<u4").tobytes()]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        place = np.cumsum(sizes) - sizes
        single = np.zeros(len(texts) + 1, np.int64)
        single[careful + 1] = 1
        single = np.cumsum(single)  # careful texts before each
        code = np.full(len(kept) + len(careful) + len(texts), len(table) - 1)
        code[np.arange(len(kept)) + doc[kept] + single[doc[kept]]] = codes[kept]
        many = np.bincount(doc[kept], minlength=len(texts)) + np.diff(single)
        code[(np.cumsum(many) - many + np.arange(len(texts)))[careful]] = len(ids) + np.arange(len(careful))
        n = sizes[code]
        pool = np.frombuffer(b"".join(table), "<u4")
        out = pool[np.repeat(place[code] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return out, np.bincount(np.repeat(np.arange(len(texts)), many + 1), weights=n, minlength=len(texts)).astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], chars: int | None = None) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, of a bounded number of bytes unless one row alone has more; null texts are empty."""
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + (chars or CHARS), "right")))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), texts.slice(at, end - at)], names=["doc", "text"])
            at = end


class Writer:
    """One file: blocks, then the words of each block, the documents' ids and starts, and a trailer."""

    def __init__(self, out):
        self.out, self.rest = out, np.zeros(0, "<u4")
        self.block_words, self.docs, self.counts, self.n = [], [], [], 0

    def add(self, docs: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.append(docs)
        self.counts.append(counts)
        self.n += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // (BLOCK * AT_ONCE) * BLOCK * AT_ONCE
        self.put(ids[:whole])
        self.rest = ids[whole:]

    def put(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), BLOCK * AT_ONCE):
            words, sizes = pack(ids[at:at + BLOCK * AT_ONCE].astype(np.uint64))
            self.out.write(words.astype("<u8").tobytes())
            self.block_words.append(sizes)

    def close(self) -> None:
        self.put(self.rest)
        sizes, docs, counts = np.concatenate(self.block_words), pa.concat_arrays(self.docs), np.concatenate(self.counts)
        for part in (sizes, docs.fill_null(0), np.cumsum(counts) - counts, docs.is_null().cast(pa.int64()), [len(sizes), len(docs), self.n]):
            self.out.write(np.asarray(part, "<i8").tobytes())
        self.out.write(MAGIC)


def write(docs: DataFrame, path: str, tokenizer: str, doc: str = "doc_id", text: str = "text", chars: int | None = None) -> DataFrame:
    """Writes the ids of all documents below ``path`` in ascending order of id; returns the list of files:
    part, file, docs and ids.

    Each partition of the ids' range is a file, named when it is whole, so a task that runs again replaces its
    own. ``END_ID`` ends every document. Null texts are empty, null ids come first, and rows of equal ids stand
    side by side in order of their texts' hash, each as a document of its own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, writer = kept("tokens", (tokenizer, chars), lambda: Encoder(tokenizer, chars)), TaskContext.get().partitionId(), None
        store, root = fs.FileSystem.from_uri(path)
        name = f"{root}/part-{part:06d}.s8b"
        attempt = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
        for rows in chunks(batches, chars):
            if writer is None:
                store.create_dir(root)
                writer = Writer(store.open_output_stream(attempt))
            writer.add(rows.column(0), *encoder.encode(rows.column(1)))
        if writer is not None:
            writer.close()
            writer.out.close()
            store.move(attempt, name)
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [f"part-{part:06d}.s8b"], "docs": [sum(map(len, writer.docs))], "ids": [writer.n]})
    bounded_batches(docs.sparkSession, chars or 2 * CHARS)
    rows = docs.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text")).withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc", "_h").sortWithinPartitions("doc", "_h").select("doc", "text")
    return saved(ordered.mapInArrow(tidy("tokens", run), "part bigint, file string, docs bigint, ids bigint"), "token-files")


def read(files: DataFrame, path: str) -> DataFrame:
    """The files back: doc, start (ids of all documents before it), n_tokens and ids_crc32 of every document."""
    spark = files.sparkSession
    listed, before = [], 0
    for row in files.orderBy("part").collect():  # a row for each file
        listed.append((row["file"], before))
        before += row["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(f"{root}/{file}") as f:
                    yield from documents(f, base)
    shape = "doc bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not listed:
        return spark.createDataFrame([], shape)
    frame = spark.createDataFrame(listed, "file string, base bigint").repartition(len(listed), "file")
    return frame.mapInArrow(run, shape)


def documents(f, base: int) -> Iterator[pa.RecordBatch]:
    """The documents of one file, a few blocks at a time."""
    size = f.size()
    tail = f.read_at(32, size - 32)
    if tail[24:] != MAGIC:
        raise ValueError("not a file of token blocks")
    blocks, docs, n = (int(x) for x in np.frombuffer(tail[:24], "<i8"))
    index = np.frombuffer(f.read_at(8 * (blocks + 3 * docs), size - 32 - 8 * (blocks + 3 * docs)), "<i8")
    sizes, names, starts, null = np.split(index, [blocks, blocks + docs, blocks + 2 * docs])
    ends, offsets = np.r_[starts[1:], n], np.r_[0, np.cumsum(sizes)]
    sums, at = np.zeros(docs, np.int64), 0
    for first in range(0, blocks, AT_ONCE):
        last = min(first + AT_ONCE, blocks)
        low, high = first * BLOCK, min(last * BLOCK, n)
        words = np.frombuffer(f.read_at(8 * int(offsets[last] - offsets[first]), 8 * int(offsets[first])), "<u8")
        raw = unpack(words, sizes[first:last], high - low).astype("<u4").tobytes()
        while at < docs and starts[at] < high:
            a, b = max(int(starts[at]), low), min(int(ends[at]), high)
            sums[at] = zlib.crc32(raw[4 * (a - low):4 * (b - low)], int(sums[at]))
            if ends[at] > high:
                break
            at += 1
    yield pa.RecordBatch.from_arrays([pa.array(names, mask=null.astype(bool)), pa.array(base + starts), pa.array(ends - starts), pa.array(sums)],
                                     names=["doc", "start", "n_tokens", "ids_crc32"])


def encoded(docs: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", chars: int | None = None) -> DataFrame:
    """Writes the files to a new folder of the shared one and reads them back."""
    path = shared_path(docs.sparkSession, "tokens")
    return read(write(docs, path, tokenizer, doc, text, chars), path)
