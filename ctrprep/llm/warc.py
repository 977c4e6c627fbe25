"""Web archives of pages, written in deterministic shards and read back.

Records are sorted by page id, digest and address and cut into shards of equal bytes: the places of all records, without their
payloads, are sorted over all partitions, and a shard begins where the running total of bytes passes a multiple of its size. The shards
follow from the data alone; a crowd of ids, one id with many pages and pages without an id are cut like any others. Each shard is written by one task as files that roll at a compressed size. A file is written under a temporary
name of its attempt and renamed when complete; headers, record ids and compression depend on the records only, so a repeated attempt
renames the same bytes to the same name. The manifest, a table that lists the files with their sizes and digests, is committed last:
an archive without one is not complete, and files that it does not list do not count.

Pages of equal payload become one response, of the smallest page id, and revisits that refer to it.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ctrprep.llm.components import apart
from ctrprep.operators.ranking import SEQ, SLOT, broadcast_rows, slot, slot_totals, store_ranked, with_running
from ctrprep.sources.scratch import store

#: Payloads of fewer bytes are always stored.
LEAST_REVISITED = 100
SHARD_BYTES, FILE_BYTES = 64 << 20, 16 << 20
#: More shards than this become larger instead, since the first place of each is sent to the tasks.
MOST_SHARDS = 100_000
#: What a record has besides its payload, about; the columns that records are sorted by.
_OVERHEAD = 512
_ORDER = ["page_id", "digest", "url_hash", "salt"]
#: The size of a row that only says what the page of the same id and digest refers to.
_NOTE = -1
DATE = "1970-01-01T00:00:00Z"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_FILE_ROW = "file string, shard int, number int, records bigint, bytes bigint, sha256 string"
_RECORD_ROW = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, stored boolean"


def payloads(pages: DataFrame, html: str = "html", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """Each page with its payload, the payload's digest and size. A NULL html is an empty payload."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    return rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))


def revisits(rows: DataFrame) -> DataFrame:
    """``page_id``, ``digest`` and ``refers_to`` of the pages whose payload was seen under a smaller id; payloads do not travel.

    A page without an id is a response and nothing refers to it; rows of the same id do not refer to each other.
    """
    narrow = rows.where((F.col("size") >= LEAST_REVISITED) & F.col("page_id").isNotNull())
    narrow = narrow.select("page_id", F.xxhash64("digest").alias("key"), "digest")
    first = narrow.groupBy("key", "digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    first = first.select(apart("key").alias("key"), "digest", "refers_to")
    later = narrow.withColumn("key", apart("key")).join(first, ["key", "digest"]).where("refers_to < page_id")
    return later.select("page_id", "digest", "refers_to").distinct()


def _place(page_id, digest: str, url, salt: float) -> tuple:
    """A record's place in the order of the archive, as it can be compared here; no id and no address come first."""
    return page_id is not None, page_id or 0, digest, url is not None, url or 0, salt


def _cuts(narrow: DataFrame, shard_bytes: int) -> list[tuple]:
    """The first place of every shard but the first. Shards are cut where the running total of bytes passes a multiple of their size.

    The places are sorted over all partitions and stored; one total for each partition and one place for each shard come to the driver.
    """
    ranked = store_ranked(narrow.select(*_ORDER, (F.col("size") + _OVERHEAD).alias("bytes")), _ORDER, "archive-order")
    totals = with_running(slot_totals(ranked, [], {"bytes": F.sum("bytes")}), "bytes")
    whole = sum(t["bytes"] for t in totals)
    size = max(shard_bytes, -(-whole // MOST_SHARDS))
    before = broadcast_rows(narrow.sparkSession, totals, {SLOT: pa.int64(), "before": pa.int64()})
    up_to_here = Window.partitionBy(SLOT).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum("bytes").over(up_to_here)
    placed = ranked.withColumn(SLOT, slot()).withColumn("running", running).join(before, SLOT)
    shard = F.floor((F.col("before") + F.col("running") - F.col("bytes")) / F.lit(size))
    firsts = placed.groupBy(shard.alias("shard")).agg(F.min(F.struct(SEQ, *_ORDER)).alias("first")).where("shard > 0")
    found = sorted((r["shard"], r["first"]) for r in firsts.collect())
    return [_place(*(first[c] for c in _ORDER)) for _, first in found]


def _shard_of(cuts: list[tuple]):
    """The shard of a record, by its place."""

    @F.arrow_udf("int")
    def shard(page_id: pa.Array, digest: pa.Array, url: pa.Array, salt: pa.Array) -> pa.Array:
        places = zip(*(c.to_pylist() for c in (page_id, digest, url, salt)), strict=True)
        return pa.array([bisect_right(cuts, _place(*p)) for p in places], pa.int32())

    return shard(*_ORDER)


def _shards_of(cuts: list[tuple]):
    """All shards that records of a page id and digest can be in."""

    @F.arrow_udf("array<int>")
    def shards(page_id: pa.Array, digest: pa.Array) -> pa.Array:
        out = []
        for page, code in zip(page_id.to_pylist(), digest.to_pylist(), strict=True):
            start = _place(page, code, None, 0.0)
            lo, hi = bisect_right(cuts, start), bisect_right(cuts, (*start[:2], code + "~"))
            out.append(list(range(lo, hi + 1)))
        return pa.array(out, pa.list_(pa.int32()))

    return shards("page_id", "digest")


def write_archive(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, **columns: str) -> DataFrame:
    """Write ``pages`` below ``folder`` and return the committed manifest, read again.

    Equal rows are told apart by draws in the order of the table, which has to give its rows in the same order when a task runs again,
    as files do; they only decide where equal records go.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    rows = payloads(pages, **columns).withColumns({"url_hash": F.when(F.col("url").isNotNull(), F.xxhash64("url")), "salt": F.rand(7)})
    narrow = store(rows.select("page_id", "digest", "url_hash", "salt", "size"), "archive-places")
    cuts = _cuts(narrow, shard_bytes)
    # What a page refers to travels as a row of its own that comes before the page, so payloads are dealt out once, by shard.
    notes = revisits(narrow).withColumns({"size": F.lit(_NOTE).cast("long"), "shard": F.explode(_shards_of(cuts))})
    fields = ["shard", "page_id", "url", "payload", "digest", "size", "refers_to", "salt"]
    each = rows.withColumns({"refers_to": F.lit(None).cast("long"), "shard": _shard_of(cuts)}).select(*fields)
    every = each.unionByName(notes, allowMissingColumns=True)
    dealt = every.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", "page_id", "digest", "size", "url", "salt")
    manifest = dealt.select(*fields[:-1]).mapInArrow(_writer(folder, file_bytes), _FILE_ROW)
    manifest.write.mode("error").parquet(f"{folder}/manifest")
    return spark.read.schema(_FILE_ROW).parquet(f"{folder}/manifest")


def qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme of the file system that Spark takes it to be on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", full)


class _File:
    """One archive file, open under its temporary name."""

    def __init__(self, folder: str, shard: int, number: int) -> None:
        self.system, root = FileSystem.from_uri(folder)
        self.name, self.shard, self.number = f"part-{shard:05d}-{number:05d}.warc.gz", shard, number
        self.final, self.temporary = f"{root}/{self.name}", f"{root}/.{self.name}.{uuid.uuid4().hex}"
        self.system.create_dir(root, recursive=True)
        self.out = self.system.open_output_stream(self.temporary, compression=None)
        self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
        body = b"software: ctrprep\r\nformat: WARC File Format 1.1\r\n"
        self.add(_record("warcinfo", self.name, {"WARC-Filename": self.name, "Content-Type": "application/warc-fields"}, body))

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)

    def close(self) -> tuple:
        self.out.close()
        self.system.move(self.temporary, self.final)
        return self.name, self.shard, self.number, self.records, self.bytes, self.digest.hexdigest()

    def abandon(self) -> None:
        self.out.close()
        self.system.delete_file(self.temporary)


def _record(kind: str, name: str, headers: dict[str, str], body: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMES, name)}>", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in headers.items()]
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode()
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head + body + b"\r\n\r\n") + pack.flush()


def _escaped(text: str) -> str:
    return re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), text)


def _page_record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    headers = {"WARC-Target-URI": _escaped(url) if url else f"urn:page:{page}", "Page-Id": "" if page is None else str(page)}
    headers["Page-Has-Address"] = str(int(bool(url)))
    headers |= {"WARC-Payload-Digest": f"sha256:{digest}", "Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response"}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = f"{page} {digest} {url}"
    if refers_to is None:
        return _record("response", name, headers | {"WARC-Block-Digest": f"sha256:{hashlib.sha256(http + payload).hexdigest()}"}, http + payload)
    headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "Refers-To-Page": str(refers_to)}
    return _record("revisit", name, headers | {"WARC-Block-Digest": f"sha256:{hashlib.sha256(http).hexdigest()}"}, http)


def _writer(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _File | None = None
        noted: tuple | None = None
        done: list[tuple] = []
        try:
            for batch in batches:
                for k in range(batch.num_rows):
                    shard, page, url, payload, digest, size, refers_to = (column[k].as_py() for column in batch.columns)
                    if size == _NOTE:
                        noted = (page, digest, refers_to)
                        continue
                    refers_to = noted[2] if noted and noted[:2] == (page, digest) else None
                    if current and (current.shard != shard or current.bytes >= file_bytes):
                        number = current.number + 1 if current.shard == shard else 0
                        done.append(current.close())
                        current = None
                        current = _File(folder, shard, number)
                    elif current is None:
                        current = _File(folder, shard, 0)
                    current.add(_page_record(page, url, payload, digest, refers_to))
            if current:
                last, current = current, None
                done.append(last.close())
        except BaseException:
            if current:
                current.abandon()
            raise
        columns = list(zip(*done, strict=True)) if done else [[]] * 6
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        names = ["file", "shard", "number", "records", "bytes", "sha256"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def read_archive(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """The page records of all files in the manifest; digests and sizes of stored payloads are computed from what was read.

    A file that differs from its manifest entry, or a payload from its header, raises. With ``payload`` the stored pages are returned too.
    """
    folder = qualified(spark, folder)
    manifest = spark.read.schema(_FILE_ROW).parquet(f"{folder}/manifest")
    files = max(1, manifest.count())
    schema = _RECORD_ROW + (", payload binary" if payload else "")
    return manifest.select("file", "sha256").repartition(files, "file").mapInArrow(_reader(folder, payload), schema)


def _members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed records of a file, one at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(size)):
        parts.append(unpack.decompress(data))
        data = b""
        if unpack.eof:
            data = unpack.unused_data
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the file ends within a record")


class _Hashed:
    """A stream that hashes what is read from it."""

    def __init__(self, stream) -> None:
        self.stream, self.digest = stream, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.digest.update(data)
        return data


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _page_row(record: bytes, payload: bool) -> tuple | None:
    headers, block = _parsed(record)
    kind = headers["WARC-Type"]
    if kind == "warcinfo":
        return None
    body = block.partition(b"\r\n\r\n")[2]
    size, digest = int(headers["Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response":
        found = len(body), hashlib.sha256(body).hexdigest()
        if found != (size, digest):
            raise ValueError(f"payload of page {headers['Page-Id']} differs from its header")
    refers_to = int(headers["Refers-To-Page"]) if kind == "revisit" else None
    page = int(headers["Page-Id"]) if headers["Page-Id"].strip() else None
    url = headers["WARC-Target-URI"] if headers["Page-Has-Address"] == "1" else None
    row = (page, size, digest, kind, refers_to, url, kind == "response")
    return (*row, body if kind == "response" else None) if payload else row


def _reader(folder: str, payload: bool):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), *([pa.binary()] if payload else [])]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "stored", *(["payload"] if payload else [])]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(folder)
        for batch in batches:
            for name, sha256 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, size = [], 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as raw:
                    stream = _Hashed(raw)
                    for record in _members(stream):
                        row = _page_row(record, payload)
                        if row:
                            rows.append(row)
                            size += len(record) if payload else 256
                        if size > 4 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if stream.digest.hexdigest() != sha256:
                    raise ValueError(f"{name} differs from its manifest entry")
                yield batch_of(rows)

    return run
