"""WARC archives with an index made as they are written, and reads of selected records by coalesced byte ranges.

Each record is a gzip member of its own. Writing gives one index row per record: file, offset, length, URL, payload
digest and record type. Reading takes any selection of index rows, sorts them by file and offset, and joins neighbouring
ranges into single reads. A page whose payload equals that of a page with a larger id becomes a revisit record of it.
Files go to a shared folder under names of their own per attempt; only files that a finished task reports are used.

Defined cases: a null payload counts as empty; a null URL gives a record without a target; a null id sorts below all
others and writes no id; rows that repeat with the largest id of their group are all responses; payloads below
``least`` bytes are never revisits; an empty table writes no file. Control characters and spaces in a URL are
percent-encoded in the record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import workspace
from .common import file_system, stored, text_of
from .registry import query

#: A file is closed when it has this size, and another begun.
FILE_BYTES = 1 << 28
#: Ranges no further apart are read together, up to a size.
GAP_BYTES, RANGE_BYTES = 1 << 16, 1 << 23
#: Bytes of archives that one task reads, about.
TASK_BYTES = 8 << 20
INDEX = ("file string, offset long, length long, url string, payload_digest string, record_type string, "
         "page_id string, payload_bytes long")
RECORD = "record_id string, record_type string, url string, payload_digest string, refers_to string, payload_bytes long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(name: str | None) -> str:
    return f"urn:page:{'' if name is None else name}"


def safe_url(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(name: str | None, url: str | None, payload: bytes, origin: str | None, is_revisit: bool) -> tuple[bytes, str]:
    """A WARC record as one gzip member, and its payload digest. A revisit holds the HTTP head only."""
    mark = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if is_revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <{record_uri(name)}>",
             "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {safe_url(url)}")
    if is_revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{record_uri(origin)}>"]
    lines += [f"WARC-Payload-Digest: sha1:{mark}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()
    return data, mark


def headers(head: bytes) -> dict[str, str]:
    """Names and values of header lines after the first; white space around a value doesn't belong to it."""
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name: value.strip() for name, _, value in lines}


def parse(member: bytes) -> tuple:
    """The fields of RECORD from a gzip member; the digest of a response's payload is checked."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = headers(head)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, mark = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest(payload) != mark:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    size = int(headers(http)["Content-Length"])
    name = fields["WARC-Record-ID"].strip("<>").removeprefix("urn:page:")
    origin = fields["WARC-Refers-To"].strip("<>").removeprefix("urn:page:") if kind == "revisit" else None
    return name, kind, fields.get("WARC-Target-URI"), mark, origin, size, None if kind == "revisit" else payload


def revisits(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """The pages whose payload equals that of a page with a larger id: ``_id`` and ``_origin``.

    Only ids, digests and sizes move; equal payloads are summed by digest in each task first.
    """
    body = text_of(payload)
    marks = pages.select(F.col(key).alias("_id"), F.sha2(body, 256).alias("_mark"), F.octet_length(body).alias("_size"))
    marks = marks.where(F.col("_size") >= least)
    groups = marks.groupBy("_mark", "_size").agg(F.max("_id").alias("_origin"), F.count("*").alias("_rows"))
    groups = groups.where("_rows > 1 AND _origin IS NOT NULL")
    found = marks.join(groups, ["_mark", "_size"]).where("_id IS NULL OR _id < _origin")
    return found.select("_id", "_mark", "_origin").distinct()


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
          least: int = 0) -> DataFrame:
    """Write a record for each page and return the index, one row per record."""
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    body = text_of(payload)
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), body.cast("binary").alias("body"),
                        F.sha2(body, 256).alias("mark"))
    # Written, so that the planner knows its size: a short list is broadcast, a long one joined by shuffle.
    again = stored(revisits(pages, key, payload, least), "revisits")
    rows = rows.alias("p").join(again.alias("r"), F.col("p.id").eqNullSafe(F.col("r._id")) & (F.col("p.mark") == F.col("r._mark")), "left")
    rows = rows.select(F.col("id").cast("string"), "url", "body", F.col("_origin").cast("string").alias("origin"))

    def work(batches):
        system, path = file_system(folder)
        number, out, file, at = TaskContext.get().partitionId(), None, None, 0
        try:
            for batch in batches:
                index = []
                for name, target, data, origin in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        file, at = f"pages-{number:06d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{path}/{file}", compression=None)
                    member, mark = record(name, target, data, origin, origin is not None)
                    out.write(member)
                    index.append((file, at, len(member), target, mark, "revisit" if origin is not None else "response", name, len(data)))
                    at += len(member)
                if index:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*index), types)],
                                                     [f.split()[0] for f in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return stored(rows.mapInArrow(work, INDEX), "warc-index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows; rows are read in file order, neighbouring ranges at once.

    The index is small beside the archives, so the number of tasks comes from the bytes that it lists.
    """
    wanted = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-wanted // TASK_BYTES))
    ordered = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    names = [f.split()[0] for f in RECORD.split(", ")]
    types = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def work(batches):
        system, path = file_system(folder)
        name, source = None, None
        try:
            for batch in batches:
                files, at, size = (c.to_pylist() for c in batch.columns)
                lo = 0
                for i in range(1, len(files) + 1):
                    if i < len(files) and files[i] == files[lo] and at[i] - (at[i - 1] + size[i - 1]) <= GAP_BYTES \
                            and at[i] + size[i] - at[lo] <= RANGE_BYTES:
                        continue
                    if files[lo] != name:
                        if source is not None:
                            source.close()
                        name, source = files[lo], system.open_input_file(f"{path}/{files[lo]}")
                    source.seek(at[lo])
                    data = source.read(at[i - 1] + size[i - 1] - at[lo])
                    found = [parse(data[at[k] - at[lo]:at[k] - at[lo] + size[k]]) for k in range(lo, i)]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), types)], names)
                    lo = i
        finally:
            if source is not None:
                source.close()

    return ordered.mapInArrow(work, RECORD)


@query("op7_warc", """
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id < last THEN last END AS refers_to
    FROM (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                 max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last,
                 (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST('0b' || substr(bits, 1 + 5 * i, 5) AS INTEGER), 1), '' ORDER BY i)
                  FROM range(32) t(i)) AS payload_digest
          FROM (SELECT *, (SELECT string_agg(bin_of, '' ORDER BY j) FROM (
                  SELECT j, substr('0000000100100011010001010110011110001001101010111100110111101111',
                                   1 + 4 * (instr('0123456789abcdef', substr(sha1(coalesce(html, '')), j + 1, 1)) - 1), 4) AS bin_of
                  FROM range(40) s(j))) AS bits
                FROM pages))""")
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    place = workspace(spark, "warc")
    records = read(write(pages, place), place)
    return records.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast("long").alias("refers_to"))
