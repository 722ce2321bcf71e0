"""Web archives with a two-level capture index (operator 12).

Pages become WARC records, each a gzip member of its own, in archive files of the shared
folder. Of records with equal payloads the one of the smallest id is written in full; the
others are revisit records that refer to it.

The index has an entry per record, under a key that holds the host from its last label
back, then port, path and query. Sorted entries are cut into compressed blocks; a shard of
the index is a file of blocks with a sparse directory of them at its end: the first and
last key of each, its place and size. To look up a key, the shard list and then the
directory are searched by halving, only the blocks that may hold the key are read, and
in a block the key is searched by halving again. Records are read by their places, with
neighbours in one read.

Keys in lists and directories are cut to `KEY_SIGNS`, so that their size is bounded: cut
keys keep their order, and what they let through beyond the key is told apart in the
block. A shard holds up to `SHARD_ENTRIES`, so there are 40,000 shards for 10 billion
records, each a line of the list that every lookup task gets. A key of very many records
covers several shards, which are read by several tasks.

Defined cases: a null payload is an empty one, and empty payloads are equal; a null URL, or
one without `://`, is indexed under the empty key; null ids come after all others, and of
rows with one id and payload the first as stored is the response; repeated rows are
records each; control signs and blanks in a URL are percent-encoded in the record; an empty
table gives an empty archive; other columns do not matter.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import ascii_lower, lookup
from pairmill.llm.shards import stable
from pairmill.session import durable, fresh_path
from pairmill.sinks.folder import fresh_name, open_folder, read_range

# An archive file ends after about this many bytes.
FILE_BYTES = 1 << 28
# Entries of a block, and of a shard.
BLOCK_ENTRIES = 2000
SHARD_ENTRIES = 1 << 18
# Entries that make another shard worth while, when there are tasks for it.
LEAST_SHARD = 4000
KEY_SIGNS = 256
# Records nearer than this are read together, up to so many bytes.
NEAR_BYTES = 1 << 16
READ_BYTES = 1 << 23
# Compressed records that one task reads, about.
TASK_BYTES = 1 << 26

GZIP_LEVEL = 4
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = "key string, file string, start bigint, length bigint, record_type string"
ENTRIES = pa.schema(
    [("key", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("record_type", pa.string())]
)


def surt(url: Column) -> Column:
    """The sort key of a URL: `org,example,www)/path?query`; empty without a host."""
    place = ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))
    place = F.regexp_replace(place, r"(?s)^.*@", "")
    host, port = F.regexp_replace(place, r":\d*$", ""), F.regexp_extract(place, r"(:\d+)$", 1)
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1), F.lit(""))
    back = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(url.contains("://"), F.concat(back, port, F.lit(")"), rest)).otherwise("")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, name: str, uri: str | None, payload: bytes, digest: str, refers: str | None, date: str) -> bytes:
    """One WARC record, compressed; a revisit holds the response's header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {uri}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def parsed(data: bytes) -> dict:
    """Headers of a record by lower-case name, and its payload (None in a revisit)."""
    plain = zlib.decompress(data, 31)
    head, _, block = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    got = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}
    block = block[: int(got["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    got["payload-length"] = int(sizes[0])
    got["payload"] = payload if got["warc-type"] == "response" else None
    return got


def record_name(row: int, key: str | None) -> str:
    """A record's URI: unique by the row, and with the page's id to be read back."""
    return f"urn:capture:{row}" + ("" if key is None else ":" + quote(key, safe=""))


def id_in(name: str | None) -> str | None:
    """The page's id in a record's URI."""
    parts = (name or "").strip("<>").split(":")
    return unquote(parts[3]) if len(parts) > 3 else None


def write(pages: DataFrame, key: str, url: str, payload: str, date: str = DATE) -> DataFrame:
    """Write all pages to archives; return the stored entries (`ENTRY`) of their records."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).alias("id"),
        F.col(url).alias("url"),
        surt(F.col(url)).alias("key"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    # Numbers that Spark gives to rows are kept by a stored table alone.
    rows = _numbered(rows)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("least")
    same = rows.groupBy("content").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    same = durable(same.selectExpr("content", "least.row as first", "cast(least.id as string) as first_id"), "copies")
    known = lookup(rows, same, ["content"])
    root = fresh_path(spark, "warc")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(root)
        file, out, at = None, None, 0
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                if out is None:
                    file, at = fresh_name(".warc.gz"), 0
                    out = system.open_output_stream(f"{folder}/{file}", compression=None)
                body = r["payload"].encode()
                revisit = r["first"] is not None and r["first"] != r["row"]
                kind = "revisit" if revisit else "response"
                uri = None if r["url"] is None else quote(r["url"], safe="%/:?#[]@!$&'()*+,;=~-._")
                refers = record_name(r["first"], r["first_id"]) if revisit else None
                data = record(kind, record_name(r["row"], r["id"]), uri, body, digest_of(body), refers, date)
                out.write(data)
                made.append({"key": r["key"], "file": file, "start": at, "length": len(data), "record_type": kind})
                at += len(data)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(made, schema=ENTRIES)
        if out is not None:
            out.close()

    named = known.select(F.col("id").cast("string").alias("id"), "row", "url", "key", "payload", "first", "first_id")
    entries = named.mapInArrow(store, ENTRY)
    return durable(entries.withColumn("root", F.lit(root)), "captures")


def _numbered(rows: DataFrame) -> DataFrame:
    """`row`, the same each time it is computed, and `content`, the name of the payload."""
    return stable(rows).withColumn("row", F.monotonically_increasing_id()).withColumn(
        "content", F.concat(F.sha2("payload", 256), F.lit(":"), F.octet_length("payload").cast("string"))
    )


def build(entries: DataFrame) -> DataFrame:
    """Write the index of stored entries; return its stored shard list.

    `first, last` (cut keys), `file` of the shard, `root` of the index, `archive`.
    """
    spark = entries.sparkSession
    root = fresh_path(spark, "captures-index")
    count = entries.count()
    tasks = min(2 * spark.sparkContext.defaultParallelism, count // LEAST_SHARD)
    shards = max(1, tasks, -(-count // SHARD_ENTRIES))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out, at, folder, directory, file = None, 0, None, [], None
        system, path = open_folder(root)
        archive = None

        def block(rows: list[dict]) -> None:
            nonlocal at
            columns = {c: [r[c] for r in rows] for c in ENTRIES.names}
            data = zlib.compress(json.dumps(columns).encode(), 6)
            out.write(data)
            directory.append((rows[0]["key"][:KEY_SIGNS], rows[-1]["key"][:KEY_SIGNS], at, len(data)))
            at += len(data)

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    file, archive = fresh_name(".idx"), r["root"]
                    out = system.open_output_stream(f"{path}/{file}", compression=None)
                held.append(r)
                if len(held) == BLOCK_ENTRIES:
                    block(held)
                    held = []
        if out is None:
            return
        if held:
            block(held)
        footer = zlib.compress(json.dumps(directory).encode())
        out.write(footer + len(footer).to_bytes(8, "big"))
        out.close()
        yield pa.RecordBatch.from_pylist(
            [{"first": directory[0][0], "last": directory[-1][1], "file": file, "root": root, "archive": archive}]
        )

    ordered = entries.repartitionByRange(shards, "key", "file", "start").sortWithinPartitions("key", "file", "start")
    made = ordered.mapInArrow(store, "first string, last string, file string, root string, archive string")
    return durable(made, "index-shards")


class Shard:
    """A file of the index, open, and its directory."""

    def __init__(self, system, path: str):
        self.file = system.open_input_file(path)
        end = self.file.size()
        size = int.from_bytes(read_range(self.file, end - 8, 8), "big")
        self.directory = json.loads(zlib.decompress(read_range(self.file, end - 8 - size, size)))
        self.lasts = [d[1] for d in self.directory]
        self.held = (-1, {})

    def block(self, number: int) -> dict:
        if self.held[0] != number:
            _, _, start, length = self.directory[number]
            self.held = number, json.loads(zlib.decompress(read_range(self.file, start, length)))
        return self.held[1]

    def entries(self, key: str) -> Iterator[tuple]:
        """All entries of the key: the blocks that may hold it, from the first on."""
        cut = key[:KEY_SIGNS]
        for number in range(bisect.bisect_left(self.lasts, cut), len(self.directory)):
            if self.directory[number][0] > cut:
                return
            columns = self.block(number)
            at = bisect.bisect_left(columns["key"], key)
            while at < len(columns["key"]) and columns["key"][at] == key:
                yield tuple(columns[c][at] for c in ENTRIES.names)
                at += 1


def find(keys: DataFrame, shards: DataFrame) -> DataFrame:
    """Entries of the distinct values of `key`, through the index: `ENTRY` and `root`.

    The shard list is sent to the tasks: one line of bounded width for each shard.
    """
    listed = sorted(shards.collect(), key=lambda r: (r["last"], r["first"], r["file"]))
    firsts, lasts = [r["first"] for r in listed], [r["last"] for r in listed]
    root = listed[0]["root"] if listed else ""
    archive = listed[0]["archive"] if listed else ""
    files = [r["file"] for r in listed]
    sent = keys.sparkSession.sparkContext.broadcast((firsts, lasts))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts = sent.value
        for batch in batches:
            found: list[int] = []
            wanted: list[str] = []
            for key in batch["key"].to_pylist():
                cut = key[:KEY_SIGNS]
                for number in range(bisect.bisect_left(lasts, cut), len(lasts)):
                    if firsts[number] > cut:
                        break
                    found.append(number)
                    wanted.append(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(wanted, pa.string())], names=["shard", "key"]
            )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(root)
        at, shard = -1, None
        for batch in batches:
            made = []
            for number, key in zip(batch["shard"].to_pylist(), batch["key"].to_pylist(), strict=True):
                if number != at:
                    at, shard = number, Shard(system, f"{path}/{files[number]}")
                for entry in shard.entries(key):
                    made.append(entry)
                    if len(made) == 10_000:
                        yield _entries(made)
                        made = []
            yield _entries(made)

    wanted = keys.select("key").where("key is not null").distinct().mapInArrow(place, "shard int, key string")
    ordered = wanted.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key")
    return ordered.mapInArrow(fetch, ENTRY).withColumn("root", F.lit(archive))


def _entries(made: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*made, strict=True)) if made else [()] * len(ENTRIES.names)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ENTRIES, strict=True)], schema=ENTRIES)


RECORD = """id string, uri string, record_type string, payload_bytes bigint, payload_digest string,
    refers_to string, payload binary"""


def read(entries: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of entries that have one `root`, read by their places (`RECORD`).

    A response's digest is that of the payload as read; a revisit has the one written, and
    the payload's length from the header it repeats. `payload` is null in revisits, and
    everywhere without `with_payload`.
    """
    names = ["id", "uri", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path, file, name = None, None, None, None

        def spans() -> Iterator[tuple[str, str, list[tuple[int, int]]]]:
            """Records that lie near one another, by file."""
            held: list[tuple[int, int]] = []
            where = None
            for batch in batches:
                columns = (batch[c].to_pylist() for c in ("root", "file", "start", "length"))
                for root, file, start, length in zip(*columns, strict=True):
                    near = held and where == (root, file) and start - sum(held[-1]) <= NEAR_BYTES
                    if held and not (near and start + length - held[0][0] <= READ_BYTES):
                        yield *where, held
                        held = []
                    where = (root, file)
                    held.append((start, length))
            if held:
                yield *where, held

        opened = None
        for root, name, places in spans():
            if opened != (root, name):
                system, path = open_folder(root)
                file, opened = system.open_input_file(f"{path}/{name}"), (root, name)
            base = places[0][0]
            data = read_range(file, base, sum(places[-1]) - base)
            made = []
            for start, length in places:
                got = parsed(data[start - base : start - base + length])
                payload = got["payload"]
                digest = got["warc-payload-digest"].removeprefix("sha1:") if payload is None else digest_of(payload)
                size = got["payload-length"] if payload is None else len(payload)
                kept = payload if with_payload else None
                uri, refers = got.get("warc-target-uri"), id_in(got.get("warc-refers-to"))
                made.append((id_in(got["warc-record-id"]), uri, got["warc-type"], size, digest, refers, kept))
            columns = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # Tasks are cut by the bytes of the records, not by those of the entries, which are few.
    entries = durable(entries, "wanted-records")
    total = entries.agg(F.sum("length")).first()[0] or 0
    tasks = max(2 * entries.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    ordered = entries.repartitionByRange(tasks, "file", "start").sortWithinPartitions("file", "start")
    return ordered.mapInArrow(run, RECORD)
