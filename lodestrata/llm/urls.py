"""URL rules in a sorted digest array: probed by binary search, confirmed on the stored text."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm.store import shared_path

# The largest rule list that is shipped as one file; a larger one meets the pages in a join.
MAX_RULES = 5_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parted(pages: DataFrame, page: str, url: str) -> DataFrame:
    """page, url, host and path. A URL that is null or has no ``://`` has both empty."""
    def part(n: int):
        return F.coalesce(F.regexp_extract(F.col("url"), r"(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    return (pages.select(F.col(page).alias("page"), F.col(url).alias("url"))
            .withColumn("host", F.translate(part(1), UPPER, LOWER)).withColumn("path", part(2)))


class Index:
    """Rules as a file of sorted 64-bit keys, verdicts and texts, read through a memory map."""

    def __init__(self, name: str):
        self.name = name

    @staticmethod
    def build(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> Index:
        """rules: (host, path, allow or block). Said twice with both verdicts, a rule blocks."""
        verdicts: dict[tuple[str, str], bool] = {}
        for host, path, verdict in rules:
            key = (host.translate(str.maketrans(UPPER, LOWER)), path)
            verdicts[key] = verdicts.get(key, False) or verdict == "block"
        rows = sorted((xxhash.xxh64_intdigest(h + p), h + p, len(h), len(p), b) for (h, p), b in verdicts.items())
        texts = [r[1].encode() for r in rows]
        head = json.dumps({"rules": len(rows), "lengths": sorted({r[3] for r in rows}), "host": max((r[2] for r in rows), default=0),
                           "labels": max((h.count(".") + 1 for h, _ in verdicts), default=0)}).encode()
        parts = [np.array([len(head)], "<u8").tobytes(), head + b" " * (-len(head) % 8),
                 np.array([r[0] for r in rows], "<u8").tobytes(),
                 np.cumsum([0] + [len(t) for t in texts]).astype("<u8").tobytes(),
                 np.array([r[2] * 2 + r[4] for r in rows], "<u8").tobytes(), b"".join(texts)]
        target = shared_path(spark, "url-rules") + ".idx"
        store, path = fs.FileSystem.from_uri(target) if "://" in target or target.startswith("file:") else (fs.LocalFileSystem(), target)
        store.create_dir(path.rpartition("/")[0])
        with store.open_output_stream(path) as out:
            for part in parts:
                out.write(part)
        spark.sparkContext.addFile(target)
        return Index(target.rpartition("/")[2])

    def open(self) -> Index:
        """In a task: maps the executor's copy."""
        raw = np.memmap(SparkFiles.get(self.name), np.uint8, "r")
        size = int(raw[:8].view("<u8")[0])
        head = json.loads(bytes(raw[8:8 + size]))
        n, at = head["rules"], 8 + size + -size % 8
        self.lengths, self.host, self.labels = head["lengths"], head["host"], head["labels"]
        self.keys, self.starts, self.marks = (raw[at + a:at + b].view("<u8") for a, b in (
            (0, 8 * n), (8 * n, 16 * n + 8), (16 * n + 8, 24 * n + 8)))
        self.texts = raw[at + 24 * n + 8:]
        return self

    def look(self, texts: list[str], hosts: list[int]) -> np.ndarray:
        """For each candidate (text, length of its host): 0 none, 1 allow, 2 block."""
        found = np.zeros(len(texts), np.int8)
        if not len(self.keys) or not texts:
            return found
        keys = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        first = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero(self.keys[np.minimum(first, len(self.keys) - 1)] == keys):
            at = int(first[i])
            while at < len(self.keys) and self.keys[at] == keys[i]:  # digests that collide stand side by side
                mark = int(self.marks[at])
                if mark >> 1 == hosts[i] and bytes(self.texts[int(self.starts[at]):int(self.starts[at + 1])]) == texts[i].encode():
                    found[i] = 1 + (mark & 1)
                at += 1
        return found


def candidates(host: str, path: str, lengths: Sequence[int], labels: int, longest: int) -> Iterator[tuple[str, int]]:
    """The rules that could fit a URL: its host and every domain above it, each with the starts of its path. Only
    domains that a rule can have, of at most so many labels and characters, are made."""
    parts = host.rsplit(".", labels)
    for k in range(max(0, len(parts) - labels), len(parts)):
        if sum(map(len, parts[k:])) + len(parts) - 1 - k > longest:
            continue
        domain = ".".join(parts[k:])
        if domain:
            for n in lengths:
                if n <= len(path):
                    yield domain + path[:n], len(domain)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]], page: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``judge`` by a rule list of any length."""
    if len(rules) <= MAX_RULES:
        return judge(pages, Index.build(pages.sparkSession, rules), page, url, default)
    return judge_by_join(pages, pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string"), page, url, default)


def judge(pages: DataFrame, index: Index, page: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """page, url, host, path, rule and verdict of every row; the longest rule decides, of two equally long
    ones that of the longer host. Where none fits the rule is null and the verdict is ``default``: the list
    knows nothing of the URL. Null and odd URLs have an empty host and fit no rule; rows are never merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = index.open()
        for batch in batches:
            owner, texts, hosts = [], [], []
            for row, (host, path) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())):
                for text, n in candidates(host, path, rules.lengths, rules.labels, rules.host):
                    owner.append(row)
                    texts.append(text)
                    hosts.append(n)
            rule, verdict, best = [None] * batch.num_rows, [default] * batch.num_rows, [(-1, -1)] * batch.num_rows
            found = rules.look(texts, hosts)
            for i in np.flatnonzero(found):
                row, size = owner[i], (len(texts[i]), hosts[i])
                if size > best[row]:
                    best[row], rule[row], verdict[row] = size, texts[i], "block" if found[i] == 2 else "allow"
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=[*batch.schema.names, "rule", "verdict"])
    rows = parted(pages, page, url)
    kind = rows.schema["page"].dataType.simpleString()
    return rows.mapInArrow(run, f"page {kind}, url string, host string, path string, rule string, verdict string")


def judge_by_join(pages: DataFrame, rules: DataFrame, page: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``judge`` for a list (host, path, verdict) too large to ship: candidates meet the rules in a join."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("_h"), F.col("path").alias("_p"), "verdict")
    rules = rules.groupBy("_h", "_p").agg(F.max(F.col("verdict") == "block").alias("_block"))
    lengths = [r[0] for r in rules.select(F.length("_p")).distinct().collect()]  # of paths, so few
    rows = parted(pages, page, url)
    longest, labels = rules.agg(F.coalesce(F.max(F.length("_h")), F.lit(0)), F.coalesce(F.max(F.size(F.split("_h", r"\."))), F.lit(0))).head()
    parts = F.split("host", r"\.")
    hosts = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.filter(F.transform(F.sequence(F.greatest(
        F.lit(1), F.size(parts) - labels + 1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")), lambda h: (h != "") & (F.length(h) <= longest)))
    starts = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]), lambda s: s.isNotNull())
    probes = (rows.distinct().select("page", "url", F.explode(hosts).alias("_h"), starts.alias("_s"))
              .select("page", "url", "_h", F.explode("_s").alias("_p")))
    hits = (probes.join(rules, ["_h", "_p"]).groupBy(F.col("page").alias("_page"), F.col("url").alias("_url"))
            .agg(F.max(F.struct((F.length("_h") + F.length("_p")).alias("n"), F.length("_h").alias("m"), F.concat("_h", "_p").alias("rule"), "_block")).alias("_best")))
    on = F.col("page").eqNullSafe(F.col("_page")) & F.col("url").eqNullSafe(F.col("_url"))
    return rows.join(hits, on, "left").select("page", "url", "host", "path", F.col("_best.rule").alias("rule"), F.when(
        F.col("_best._block"), "block").when(~F.col("_best._block"), "allow").otherwise(default).alias("verdict"))
