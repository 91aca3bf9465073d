"""WARC: write records to archives and read them back as a chunked record table.

A payload travels as rows (record id, chunk number, chunk): the writer appends chunk by chunk, the reader streams
each archive and emits a row per chunk that carries the SHA-1 and the byte count of the payload so far.  The last
chunk of a record therefore holds the digest of the whole payload.  What is written comes from a table whose cells
hold whole payloads: up to the cutting, Spark has a payload as one value, digests it there and moves it through the
join that finds revisits where these are many.

Archives are gzip files with one member per record, written under a name of the attempt's own; only archives
listed in the manifest table are read, so a repeated or lost task leaves nothing behind that counts.

Defined cases.  A null payload is an empty one.  Empty payloads give one empty chunk.  Of equal payloads of at
least ``min_revisit`` bytes the record with the largest id is the response, the others revisit it; records
with that same largest id (repeated rows) are all responses.  A null id is written as an empty one, comes back
null, and is always a response.  Ids are integers; others are refused by name.  A very long payload is many chunks.
Other columns are not written, whatever their names.  An empty table writes no archive and reads back as no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import re
import uuid
import zlib
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_run_dir, stage
from .common import integer_id, ship_by_value

CHUNK_BYTES = 256 * 1024
BATCH_BYTES = 8 * 1024 * 1024
MANIFEST = "archive string, records long"
CHUNKS = ("archive string, record_id string, record_type string, refers_to string, url string, chunk_no int, "
          "chunk binary, bytes_so_far long, digest_so_far string, header_digest string, last boolean")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# Fixed by the WARC format.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def open_stream(path: str, mode: str):
    """A byte stream of a local file or of any store that Arrow's file systems reach."""
    at = urlparse(path)
    if at.scheme in ("", "file"):
        if "w" in mode:
            os.makedirs(os.path.dirname(at.path), exist_ok=True)
        return open(at.path, mode)
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    if "w" in mode:
        store.create_dir(os.path.dirname(name), recursive=True)
        return store.open_output_stream(name)
    return store.open_input_stream(name)


def _header(rid, url, kind, refers, digest, size):
    clean = re.sub(r"[\r\n]+", " ", url or "")
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{'' if rid is None else rid}>",
             f"WARC-Target-URI: {clean}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:record:{refers}>", f"WARC-Profile: {PROFILE}"]
    lines.append(f"Content-Length: {size + len(HTTP)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + HTTP


def _writer(folder: str):
    def write(batches):
        name, out, records, member = f"{folder}/part-{uuid.uuid4().hex}.warc.gz", None, 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["chunk_no"] == 0:
                    out = out or open_stream(name, "wb")
                    member, records = zlib.compressobj(1, zlib.DEFLATED, 31), records + 1
                    size = r["size"] if r["kind"] == "response" else 0
                    out.write(member.compress(_header(r["rid"], r["url"], r["kind"], r["refers_to"], r["digest"], size)))
                out.write(member.compress(r["chunk"]))
                if r["chunk_no"] == r["chunks"] - 1:
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{"archive": name, "records": records}])
    return write


def write_warc(records: DataFrame, folder: str, record_id: str, url: str, payload: str,
               min_revisit: int = 1000, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write a record per row into archives under ``folder``; returns the manifest table (archive, records)."""
    def name(c):
        return F.col("`" + c.replace("`", "``") + "`")

    integer_id(records, record_id)
    rows = records.select(name(record_id).cast("long").alias("rid"), name(url).cast("string").alias("url"),
                          F.coalesce(name(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    groups = (rows.where(F.col("size") >= min_revisit).groupBy("digest", "size")
              .agg(F.max("rid").alias("newest"), F.count("*").alias("copies")).where("copies > 1")
              .select(F.col("digest").alias("d"), F.col("size").alias("n"), "newest"))
    rows = rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("n")), "left")
    again = F.col("newest").isNotNull() & F.col("rid").isNotNull() & (F.col("rid") != F.col("newest"))
    rows = rows.withColumns({"kind": F.when(again, "revisit").otherwise("response"),
                             "refers_to": F.when(again, F.col("newest")),
                             "body": F.when(again, F.lit(b"")).otherwise(F.col("payload"))})
    chunks = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / chunk_bytes)).cast("int")
    # A row per chunk number; each chunk is cut out as its row goes by, so a record's chunks are never all there.
    rows = rows.select("rid", "url", "kind", "refers_to", "digest", "size", "body", chunks.alias("chunks"),
                       F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk_no"))
    rows = rows.withColumn("chunk", F.substring("body", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))).drop("body")
    return stage(rows.mapInArrow(_writer(folder), MANIFEST), f"{folder}/manifest")


def _record_header(stream):
    """The named fields of the next record, or None at the end of the archive."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        key, _, value = line.decode().partition(":")
        fields[key.strip().lower()] = value.strip()
    return fields


def _urn(value):
    return (value or "").removeprefix("<urn:record:").removesuffix(">") or None


def _payload_chunks(stream, size: int, chunk_bytes: int):
    """Chunks of the record's payload (what follows the HTTP header), at least one, each read on its own."""
    left = size
    while left:
        line = stream.readline(left)
        left -= len(line)
        if line in (b"\r\n", b"\n"):
            break
    first = True
    while left or first:
        chunk = stream.read(min(chunk_bytes, left)) if left else b""
        if left and not chunk:
            raise ValueError("the archive ends within a record")
        left -= len(chunk)
        first = False
        yield chunk, left == 0


def _reader(chunk_bytes: int, batch_bytes: int):
    def read(batches):
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_stream(archive, "rb") as raw, gzip.GzipFile(fileobj=raw) as stream:
                    while (h := _record_header(stream)) is not None:
                        sha, seen = hashlib.sha1(), 0
                        for no, (chunk, last) in enumerate(_payload_chunks(stream, int(h["content-length"]), chunk_bytes)):
                            sha.update(chunk)
                            seen += len(chunk)
                            rows.append((archive, _urn(h.get("warc-record-id")), h.get("warc-type"),
                                         _urn(h.get("warc-refers-to")), h.get("warc-target-uri"), no, chunk, seen,
                                         sha.hexdigest(), h.get("warc-payload-digest", "").removeprefix("sha1:"), last))
                            held += len(chunk) + 200
                            if held >= batch_bytes:
                                yield _as_batch(rows)
                                rows, held = [], 0
                if rows:
                    yield _as_batch(rows)
    return read


def _as_batch(rows):
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    types = {"chunk_no": pa.int32(), "chunk": pa.binary(), "bytes_so_far": pa.int64(), "last": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(v, types.get(n, pa.string())) for n, v in zip(names, zip(*rows), strict=True)], names)


def read_warc(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of the archives that ``manifest`` lists, one task per archive."""
    archives = manifest.select("archive")
    n = archives.count()
    return archives.repartition(max(1, n)).mapInArrow(_reader(chunk_bytes, BATCH_BYTES), CHUNKS)


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record: record_id, record_type, refers_to, and the full payload's bytes and digest.  A
    revisit holds no payload: its size comes from the response it refers to, whose digest must agree."""
    whole = stage(chunks.where("last").select("record_id", "record_type", "refers_to", "url", "bytes_so_far",
                                              "digest_so_far", "header_digest"), new_run_dir(chunks.sparkSession, "records"))
    again = whole.where("record_type = 'revisit'")
    named = again.select(F.col("refers_to").alias("named_id")).distinct()
    # Only responses that a revisit names; they may grow with the archives, so they are not broadcast.
    full = (whole.where("record_type = 'response'").join(named.hint("shuffle_merge"), F.col("record_id") == F.col("named_id"), "left_semi")
            .groupBy("record_id", "digest_so_far").agg(F.max("bytes_so_far").alias("full_bytes"))
            .select(F.col("record_id").alias("full_id"), F.col("digest_so_far").alias("full_digest"), "full_bytes"))
    revisits = again.join(full.hint("shuffle_merge"), (F.col("refers_to") == F.col("full_id")) & (F.col("header_digest") == F.col("full_digest")), "left")
    return whole.where("record_type = 'response'").select(
        "record_id", "record_type", "refers_to", "url", F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest")).unionByName(revisits.select(
            "record_id", "record_type", "refers_to", "url", F.col("full_bytes").alias("payload_bytes"),
            F.col("full_digest").alias("payload_digest")))


ship_by_value(__name__)
