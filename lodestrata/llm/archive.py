"""Pages as WARC archives behind an index: written where they lie, read back by coalesced byte ranges."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.store import Steps, bounded_batches, saved, shared_path, sieve, sifted

# Payloads of fewer bytes are never told to be copies.
LEAST = 1000
# Ranges with a smaller gap between them are read in one, up to so many bytes; and the stretch of a file that one group of reads covers.
GAP, MOST, STRETCH = 1 << 14, 1 << 22, 1 << 24
LEVEL = 6

# Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset bigint, length bigint, page bigint, url string, digest string, type string"


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page is None else page}:{digest}>"


def page_of(identifier: str) -> int | None:
    page = identifier.strip("<>").split(":")[2]
    return int(page) if page else None


def sha1_text(digest: str) -> str:
    """A hexadecimal digest in the base32 form that WARC headers use."""
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member of its own. A revisit has the reply's head and no payload.

    The head names the payload's length in either case. Control characters, blanks and percent signs of the URL
    are escaped, so that it is one line and can be read back.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if refers_to is not None else head + payload
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(quote(c) if c <= " " or c in "%\x7f\x85  " else c for c in url))
    lines.append(f"WARC-Payload-Digest: {sha1_text(digest)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {SAME_PAYLOAD}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> dict:
    """A record's gzip member back: page, url, type, digest, refers_to, payload_bytes and payload (None of a revisit).
    A payload that does not have its digest or length raises."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError("not a WARC record")
    named = dict(line.split(": ", 1) for line in lines)
    body = rest[:int(named["Content-Length"])]
    reply, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in reply.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(named["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    out = {"page": page_of(named["WARC-Record-ID"]), "url": unquote(named["WARC-Target-URI"]) if "WARC-Target-URI" in named else None,
           "type": named["WARC-Type"], "digest": digest, "payload_bytes": size, "refers_to": None, "payload": payload}
    if out["type"] == "revisit":
        return out | {"refers_to": page_of(named["WARC-Refers-To"]), "payload": None}
    if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"record {named['WARC-Record-ID']} is damaged")
    return out


def decided(pages: DataFrame, steps: Steps, least: int) -> DataFrame:
    """Adds refers_to: the page whose equal payload stays, null for a response.

    Only ids and digests are grouped and joined. A row that a sieve clears of being a revisit is not shuffled;
    the others meet the decisions by id and digest together, so a payload with very many copies spreads out.
    """
    keys = steps.saved(pages.select("page", "digest", "size"), "keys")
    # A payload's copies of one id are one entry, so that a hot payload is counted by id.
    copies = (keys.where(F.col("size") >= least).groupBy("digest").agg(F.max("page").alias("keep"), F.min(F.struct("page")).alias("least"))
              .where(F.col("keep").isNotNull() & ~F.col("least.page").eqNullSafe(F.col("keep"))).select(F.col("digest").alias("_digest"), "keep"))
    copies = steps.saved(copies, "copies")
    again = keys.join(copies, keys["digest"] == copies["_digest"]).where(~F.col("page").eqNullSafe(F.col("keep")))
    again = steps.saved(again.select(F.struct("page", "digest").alias("_key"), F.col("keep").alias("refers_to")).distinct(), "revisits")
    known = again.select(F.xxhash64("_key").alias("_hash"))
    marked = sifted(pages.withColumn("_hash", F.xxhash64(F.struct("page", "digest"))), "_hash", sieve(known, "_hash"), "_some").drop("_hash")
    rest = marked.where("_some").withColumn("_key", F.struct("page", "digest")).join(again, "_key", "left").drop("_key")
    return marked.where("not _some").withColumn("refers_to", F.lit(None).cast("bigint")).unionByName(rest).drop("_some")


def write(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record for every row below ``path`` and returns the index: file, offset and length of the record's
    gzip member, page, url, digest and type.

    Of equal payloads of at least ``least`` bytes, the row of the largest id is a response and the others revisit it;
    rows that share that id are all responses, a null id is smaller than any other, and if all ids are null nobody is
    revisited. A null html is an empty payload, a null url has no target. Each task writes one file, named by its
    attempt; the index row is what makes a file count, so what a lost attempt has left is never read.
    """
    spark, steps = pages.sparkSession, Steps(pages.sparkSession)
    bounded_batches(spark)
    rows = pages.select(F.col(page).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("bigint")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, at = TaskContext.get(), None, 0
        store, root = fs.FileSystem.from_uri(path)
        name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(root)
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            index = []
            for p, u, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                member = record(p, u, payload, digest, refers_to, date)
                out.write(member)
                index.append((name, at, len(member), p, u, digest, "response" if refers_to is None else "revisit"))
                at += len(member)
            if len(index):
                last = pa.array([x[6] for x in index])
                yield pa.RecordBatch.from_arrays([*(pa.array([x[k] for x in index], t) for k, t in enumerate(
                    (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))), last], names=["file", "offset", "length", "page", "url", "digest", "type"])
        if out is not None:
            out.close()
    index = saved(decided(rows, steps, least).select("page", "url", "payload", "digest", "refers_to").mapInArrow(run, INDEX), "warc-index")
    steps.remove()
    return index


def ranges(rows: list[tuple[int, int]], gap: int = GAP, most: int = MOST) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) of one file to reads: (start, size, records within). No read but that of a single
    longer record has more than ``most`` bytes, and no gap of more than ``gap`` is read."""
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for at, size in rows:
        if out and at - (out[-1][0] + out[-1][1]) <= gap and at + size - out[-1][0] <= most:
            start, old, inside = out[-1]
            out[-1] = (start, max(old, at + size - start), inside)
            inside.append((at, size))
        else:
            out.append((at, size, [(at, size)]))
    return out


def read(selected: DataFrame, path: str, payload: bool = True) -> DataFrame:
    """The records that rows of an index name: page, url, type, digest, refers_to, payload_bytes and payload.

    Rows go to tasks by stretches of their files and are sorted there; neighbours are read in one. Rows that repeat
    are read as often. ``payload`` False leaves the payload out, which is then only checked.
    """
    spark = selected.sparkSession
    bounded_batches(spark)
    names = ["page", "url", "type", "digest", "refers_to", "payload_bytes", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        opened, source = None, None
        for batch in batches:
            files, offsets, lengths = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(files):
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                if files[at] != opened:
                    if source is not None:
                        source.close()
                    opened, source = files[at], store.open_input_file(f"{root}/{files[at]}")
                for start, size, inside in ranges(list(zip(offsets[at:end], lengths[at:end]))):
                    data = source.read_at(size, start)
                    found = [parsed(data[a - start:a - start + n]) for a, n in inside]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] if k != "payload" or payload else None for r in found], t) for k, t in zip(names, kinds)], names=names)
                at = end
        if source is not None:
            source.close()
    # The rows are short and what they name is long, so the number of tasks follows the bytes that are named.
    size = selected.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).head()["n"]
    rows = selected.select("file", "offset", "length", F.floor(F.col("offset") / STRETCH).alias("_stretch"))
    rows = rows.repartition(1 + size // MOST, "file", "_stretch").sortWithinPartitions("file", "offset").select("file", "offset", "length")
    return rows.mapInArrow(run, "page bigint, url string, type string, digest string, refers_to bigint, payload_bytes bigint, payload binary")


def payloads(index: DataFrame, selected: DataFrame, path: str) -> DataFrame:
    """page, url, type, digest and payload of the selected index rows, those of revisits taken from the response
    that they refer to: each such response is read once, however many visits it has."""
    steps = Steps(index.sparkSession)
    own = steps.saved(read(selected, path), "own")
    names = ["page", "url", "type", "digest"]
    visits = own.where("type = 'revisit'").select(*names, "refers_to")
    wanted = visits.select(F.col("refers_to").alias("_page"), F.col("digest").alias("_digest")).distinct()
    first = index.where("type = 'response'").groupBy("page", "digest").agg(F.min(F.struct("file", "offset", "length")).alias("_at"))
    at = first.join(wanted, (first["page"] == wanted["_page"]) & (first["digest"] == wanted["_digest"])).select("_at.*")
    there = saved(read(at, path).select(F.col("page").alias("_page"), F.col("digest").alias("_digest"), "payload"), "there")
    again = visits.join(there, (visits["refers_to"] == there["_page"]) & (visits["digest"] == there["_digest"])).select(*names, "payload")
    return own.where("type = 'response'").select(*names, "payload").unionByName(again)


def archived(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the archives to a new folder of the shared one and reads all records back."""
    path = shared_path(pages.sparkSession, "warc")
    return read(write(pages, path, page, url, html), path, payload=False)
