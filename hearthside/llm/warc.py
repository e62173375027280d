"""WARC archives: a sharded writer with a two-step commit, and a reader.

Records are range-sorted by id. Each task writes its range as gzip members, one per record, to files under a temporary
name that holds its attempt, and begins a new file when the compressed size passes a limit. The tasks' rows are the
manifest: only files of attempts that Spark counts become final names, so a retried or doubled task leaves nothing
behind that a reader sees. The manifest file is written last; without it the archive is not complete.
"""

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthside.llm.common import LAST_ID, parts, row_id, stored

DATE = "2024-01-01T00:00:00Z"
FILES = "temporary string, final string, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, verified boolean"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", path) if ":/" in path else f"file://{path}")


def _base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; its headers are made anew from the row. A revisit holds the response's head without the payload."""
    digest = f"sha1:{_base32(payload)}"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_CONTROL.sub(lambda m: f'%{ord(m.group()):02X}', url)}"] if url is not None else []),
        f"WARC-Payload-Digest: {digest}",
        f"WARC-Block-Digest: sha1:{_base32(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Row-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Row: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def references(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """(_id, digest, first) of the rows (_id, payload) whose payload also occurs under a smaller id, ``first``.

    Payloads under ``revisit_from`` bytes never refer. Equal means equal SHA-256 and length. Digests are gathered per
    input block first, so a payload that a third of all rows share is one row of each block.
    """
    marks = stored(
        pages.select("_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n"), F.spark_partition_id().alias("block")),
        "payload-digests",
    )
    inner = marks.where(F.col("n") >= revisit_from).groupBy("block", "digest", "n").agg(F.min("_id").alias("first"))
    whole = inner.groupBy("digest", "n").agg(F.min("first").alias("first"))
    answers = inner.drop("first").join(whole, ["digest", "n"])
    return marks.join(answers, ["block", "digest", "n"]).where("_id != first").select("_id", "digest", "first").distinct()


def write_archive(pages: DataFrame, folder: str, roll_bytes: int = 256 << 20, revisit_from: int = 0, shards: int | None = None) -> DataFrame:
    """Write page_id, url, html of ``pages`` to ``folder`` and return the manifest (final, records, bytes, sha256).

    A null html has an empty payload, a null url no target header. Rows without a page_id come last and each is a
    response or a revisit like any other row; rows that repeat a page_id are records of their own (of equal payloads
    under one id all are responses). An empty table gives an empty manifest. Other columns are not read. ``folder``
    may be any place that pyarrow reaches by the name Spark uses for it, and must be shared.
    """
    spark = pages.sparkSession
    rows = pages.select(
        row_id("page_id").alias("_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    # references travel as rows of their own that sort before their pages: the payloads are shuffled once, without a join
    empty = {"url": F.lit(None).cast("string"), "payload": F.lit(None).cast("binary"), "kind": F.lit(0)}
    marks = references(rows, revisit_from).withColumns(empty)
    both = rows.withColumns({"digest": F.lit(None).cast("string"), "first": F.lit(None).cast("long"), "kind": F.lit(1)}).unionByName(marks)
    ordered = both.repartitionByRange(shards or parts(spark), "_id").sortWithinPartitions("_id", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, top = _place(folder)
        task = TaskContext.get()
        temporary = f"{top}/_temporary/{task.partitionId()}-{task.taskAttemptId()}"
        made, out, sums = [], None, None

        def close():
            nonlocal out
            out.close()
            made[-1]["sha256"] = sums.hexdigest()
            out = None

        owner, known = None, {}  # of the id at hand: the first page by digest
        for batch in batches:
            columns = batch.select(["_id", "url", "payload", "digest", "first"]).columns
            for key, url, payload, digest, first in zip(*(c.to_pylist() for c in columns)):
                if key != owner:
                    owner, known = key, {}
                if payload is None:
                    known[digest] = first
                    continue
                first = known.get(hashlib.sha256(payload).hexdigest()) if known else None
                if out is None:
                    place.create_dir(temporary, recursive=True)
                    name = f"part-{task.partitionId():06d}-{len(made):06d}.warc.gz"
                    made.append({"temporary": f"{temporary}/{name}", "final": f"{top}/{name}", "records": 0, "bytes": 0})
                    out, sums = place.open_output_stream(made[-1]["temporary"], compression=None), hashlib.sha256()
                data = _gzip(record_bytes(None if key == LAST_ID else key, url, payload, first))
                out.write(data)
                sums.update(data)
                made[-1]["records"] += 1
                made[-1]["bytes"] += len(data)
                if made[-1]["bytes"] >= roll_bytes:
                    close()
        if out is not None:
            close()
        names = [x.split()[0] for x in FILES.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([m[n] for m in made], k) for n, k in zip(names, kinds)], names=names)

    manifest = stored(ordered.mapInArrow(run, FILES), "warc-manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, _ = _place(folder)
        for batch in batches:
            for old, new in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if place.get_file_info(old).type != fs.FileType.NotFound:  # else an earlier attempt has moved it
                    place.move(old, new)
            yield batch

    done = stored(manifest.mapInArrow(commit, FILES), "warc-committed")
    place, top = _place(folder)
    place.create_dir(top, recursive=True)
    with place.open_output_stream(f"{top}/_temporary-manifest.json") as f:
        for row in done.drop("temporary").orderBy("final").toLocalIterator():  # a row per file, not per record
            f.write((json.dumps(row.asDict()) + "\n").encode())
    place.move(f"{top}/_temporary-manifest.json", f"{top}/manifest.json")
    return done.drop("temporary")


def members(content: bytes) -> Iterator[bytes]:
    while content:
        unpacker = zlib.decompressobj(31)
        yield unpacker.decompress(content) + unpacker.flush()
        content = unpacker.unused_data


def parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    sound = fields["WARC-Block-Digest"] == f"sha1:{_base32(block)}"
    if kind == "response":
        sound = sound and _base32(payload) == digest and len(payload) == int(fields["X-Payload-Length"])
    number = lambda name: int(fields[name]) if fields.get(name, "").strip() else None
    return number("X-Row-Id"), fields.get("WARC-Target-URI"), kind, number("X-Refers-To-Row"), number("X-Payload-Length"), digest, sound


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``name, records, bytes, sha256`` of the archive's files. An archive without a manifest is not complete: an error."""
    rows = spark.read.schema("final string, records long, bytes long, sha256 string").json(f"{folder}/manifest.json")
    return rows.select(_name("final"), "records", "bytes", "sha256")


def _name(path: str):
    return F.regexp_extract(path, "[^/]+$", 0).alias("name")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the files in the manifest; ``verified``: block and payload have the digests in the headers.

    The files must be those of the manifest: a missing or an unlisted one, or another size, fails at once; another SHA-256
    or number of records fails the job that reads the file. A page without an id or url has null there. An archive of no
    pages has an empty manifest and gives no rows.
    """
    listed = read_manifest(spark, folder)
    if listed.isEmpty():
        return spark.createDataFrame([], RECORDS)
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    odd = listed.join(there.select(_name("path"), F.col("length").alias("found")), "name", "full").where("bytes IS NULL OR found IS NULL OR bytes <> found")
    if wrong := odd.limit(5).collect():
        raise ValueError(f"archive and manifest differ: {[r['name'] for r in wrong]}")
    # one row per file: Spark sends the manifest to the files or, where it is long, joins by name
    files = there.select(_name("path"), "content").join(listed, "name").select("content", "records", "sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        for batch in batches:
            for content, records, digest in zip(*batch.columns):
                content = content.as_py()
                if hashlib.sha256(content).hexdigest() != digest.as_py():
                    raise ValueError("a file of the archive has not the digest of the manifest")
                found = [parsed(m) for m in members(content)]
                if len(found) != records.as_py():
                    raise ValueError("a file of the archive has not the records of the manifest")
                cols = list(zip(*found)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return files.mapInArrow(run, RECORDS)
