"""WARC archives: a deterministic sharded writer and its reader.

Writer: one pass of small rows finds payloads that several pages share (an aggregate, so a payload on a third of all
pages is no hot key); pages and these findings are then range-sorted together by page, so each payload is shuffled once.
Each task writes its range as gzip members, one for a record, into files that roll at ``roll_bytes`` compressed bytes.
Headers, record ids and digests are made anew from the rows alone, so a repeated write gives the same records.

Commit: a task writes under temporary names that contain its attempt, and reports its files as rows of a manifest.  The
manifest is written by Spark, which keeps the rows of one attempt of each task; then the named files are renamed, which
can be repeated, and the manifest of final names is written last.  Readers open only what that manifest lists.

Defined cases: null html is an empty payload; null page ids are archived without an id, a null url as "urn:unknown";
equal rows are archived each (the first is the response, the others revisit it when large enough); no pages give no
files; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_batches, staged

#: Least payload that a revisit record stands in for, size at which a file is closed, date of all records.
LEAST_REVISIT, ROLL_BYTES, DATE = 100, 256 << 20, "2025-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "place int, number int, temporary string, name string, records long, bytes long, digest string"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, from inside a task."""
    if re.match(r"^/", folder):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", folder))


def _id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, revisits: bool, first) -> bytes:
    """A gzip member with the whole record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisits else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: {_id(page_id, digest)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~') if url else 'urn:unknown'}", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisits:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(first, digest)}"]
        head += [f"X-Refers-To-Page: {first}"] if first is not None else []
    head.append(f"Content-Length: {len(block)}")
    return _member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _prepared(pages: DataFrame) -> DataFrame:
    """Pages, and before each page whose payload others share a row with the least page of that payload."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("html"), F.sha2(payload, 256).alias("digest"))
    small = rows.where(F.octet_length("html") >= LEAST_REVISIT).select("page_id", "digest")
    shared = small.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = staged(small.join(shared, "digest").select("page_id", "digest", "first").distinct(), "shared")
    none = lambda kind: F.lit(None).cast(kind)
    told = found.select("page_id", "digest", F.lit(0).alias("kind"), "first", none("string").alias("url"), none("string").alias("html"))
    return told.unionByName(rows.select("page_id", "digest", F.lit(1).alias("kind"), none("long").alias("first"), "url", "html"))


def write_archive(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Archive (page_id, url, html) in ``folder``, which all executors reach; returns the manifest."""
    spark = pages.sparkSession
    arrow_batches(spark)
    run = uuid.uuid4().hex
    keys = ("page_id", "digest", "kind")
    ordered = _prepared(pages).repartitionByRange("page_id", "digest").sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, (files, root) = TaskContext.get(), filesystem(folder)
        place, unique = context.partitionId(), f"{run}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        files.create_dir(f"{root}/_temporary", recursive=True)
        done, out, told, written = [], None, None, None

        def closed():
            if out:
                out[0].close()
                done.append({"place": place, "number": len(done), "temporary": out[1], "name": f"part-{place:06d}-{len(done):04d}.warc.gz", "records": out[2], "bytes": out[3], "digest": out[4].hexdigest()})

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["page_id"], row["digest"])
                if row["kind"] == 0:
                    told, written = (key, row["first"]), False
                    continue
                ours = told is not None and told[0] == key
                revisits = ours and (written or (row["page_id"] != told[1]))
                written = True
                if out is None or out[3] >= roll_bytes:
                    closed()
                    name = f"{root}/_temporary/{place:06d}-{len(done):04d}-{unique}"
                    out = [files.open_output_stream(name, compression=None), name, 0, 0, hashlib.sha256()]
                raw = record(row["page_id"], row["url"], row["html"].encode(), row["digest"], revisits, told[1] if ours else None)
                out[0].write(raw)
                out[2], out[3] = out[2] + 1, out[3] + len(raw)
                out[4].update(raw)
        closed()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("place", pa.int32()), ("number", pa.int32()), ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string())]))

    planned = staged(ordered.mapInArrow(write, MANIFEST), "manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                final = f"{root}/{row['name']}"
                try:
                    files.move(row["temporary"], final)
                except OSError:  # an earlier attempt of this task may have renamed it
                    if files.get_file_info(final).size != row["bytes"]:
                        raise
            yield batch

    planned.mapInArrow(rename, MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The unpacked gzip members of a file, one by one."""
    rest = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            rest = rest or stream.read(chunk)
            if not rest:
                if parts:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        yield b"".join(parts)


def parsed(raw: bytes) -> dict:
    """A record's fields and payload, its digests checked."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = body[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}" or body[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"damaged payload in {fields.get('WARC-Record-ID')}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"), "url": fields["WARC-Target-URI"], "record_type": kind, "refers_to": number("X-Refers-To-Page"),
        "payload_bytes": number("X-Payload-Length"), "payload_digest": digest, "payload": payload,
    }


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive; a revisit's payload is null, its length and digest are those of the whole payload."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (x.split() for x in RECORDS.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    held, size = [], 0
                    for raw in members(stream):
                        held.append(parsed(raw))
                        size += len(raw)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    tasks = max(1, manifest.count())
    return manifest.repartition(tasks, "name").mapInArrow(read, RECORDS)
