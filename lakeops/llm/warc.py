"""WARC archives with an index that is written first and read by sorted byte ranges.

Payloads are hashed and equal ones found before anything is written: of records with equal
payloads of at least ``MIN_REVISIT`` bytes the one with the largest id holds the payload,
the others are revisit records that name it. Then every task writes one archive, each
record a gzip member of its own, and returns the index rows of what it wrote: file, offset,
length, url, digest, page_id, type. An archive's name carries the task attempt, so a task
that is run twice leaves a file that no index row names, and does no harm.

To read, selected index rows are sorted by file and offset over range partitions; in a task
neighbouring ranges are read in one request while the gap between them is small. Every
payload is hashed again and compared with its record's digest.

Archives lie on storage that pyarrow's file systems reach (file, hdfs, s3, gs), as the shared
scratch folder does. Pages are read by Spark alone.

Defined cases: a null page is an empty payload; a null url has no target line and reads back
as null; a null id is never the one that others refer to; rows with the same id and payload
are responses both; an empty table writes nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.frames import materialise, small_side
from lakeops.llm.words import text_of

MIN_REVISIT = 1000
#: Ranges closer than this are read in one request, of at most so many bytes.
MAX_GAP, MAX_READ = 64 << 10, 8 << 20
#: Bytes of archives that a reading task is given.
TASK_BYTES = 16 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset bigint, length bigint, url string, digest string, page_id bigint, record_type string"
READ = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, payload binary"
)


def name_of(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, keeper: int | None, date: str) -> bytes:
    """One WARC record, uncompressed; a revisit if ``keeper`` names another page."""
    revisit = keeper is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name_of(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html",
        f"Content-Length: {0 if revisit else len(payload)}",
    ]
    if url is not None:
        # a control character would end the line; quoting % as well makes it reversible
        head.insert(3, "WARC-Target-URI: " + re.sub(r"[%\x00-\x20\x7f]", lambda m: quote(m[0], safe=""), url))
    if revisit:
        head += [f"WARC-Refers-To: {name_of(keeper, digest)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + (b"" if revisit else payload) + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of READ from one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    payload = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    page = lambda name: int(n) if (n := fields[name].split(":")[2]) else None
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": page("WARC-Record-ID"),
        "url": url if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To") if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def pack(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write ``pages`` below ``path`` and return the stored index."""
    rows = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.encode(text_of(f"`{html}`"), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    keepers = materialise(
        rows.where(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND keeper IS NOT NULL")
        .select(F.col("digest").alias("_digest"), "keeper"),
        "keepers",
    )
    joined = rows.join(small_side(keepers), F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("keeper")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        task = TaskContext.get()
        files, root = fs.FileSystem.from_uri(path)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        files.create_dir(root, recursive=True)
        offset, sink = 0, None
        try:
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    sink = sink or files.open_output_stream(f"{root}/{name}", compression=None)
                    data = pack(record(r["page_id"], r["url"], r["payload"], r["digest"], r["keeper"], date))
                    sink.write(data)
                    kind = "response" if r["keeper"] is None else "revisit"
                    out.append((name, offset, len(data), r["url"], r["digest"], r["page_id"], kind))
                    offset += len(data)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), INDEX_TYPES)], INDEX_NAMES)
        finally:
            if sink is not None:
                sink.close()

    return materialise(joined.mapInArrow(write, INDEX), "warc-index")


INDEX_NAMES = ["file", "offset", "length", "url", "digest", "page_id", "record_type"]
INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]


def ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """file, start, end and the records of each request, from rows sorted by file and offset."""
    file, start, end, inside = None, 0, 0, []
    for f, offset, length in rows:
        if f != file or offset - end > MAX_GAP or offset + length - start > MAX_READ:
            if inside:
                yield file, start, end, inside
            file, start, end, inside = f, offset, offset, []
        inside.append((offset, length))
        end = max(end, offset + length)
    if inside:
        yield file, start, end, inside


def read_records(selected: DataFrame, path: str) -> DataFrame:
    """The fields of READ for the selected index rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))))
        name, source = None, None
        for file, start, end, inside in ranges(rows):
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, files.open_input_file(f"{root}/{file}")
            block = source.read_at(end - start, start)
            found = [parse(zlib.decompress(block[o - start : o - start + n], 31)) for o, n in inside]
            yield pa.RecordBatch.from_pylist(found, READ_ARROW)
        if source is not None:
            source.close()

    # the index is small beside what it points at: tasks are made for the bytes to be read
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = total // TASK_BYTES + 1
    ordered = (
        selected.select("file", "offset", "length")
        .repartitionByRange(tasks, "file", "offset")
        .sortWithinPartitions("file", "offset")
    )
    return ordered.mapInArrow(read, READ)


READ_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
)


def read_payloads(spark: SparkSession, index: DataFrame, selected: DataFrame, path: str) -> DataFrame:
    """As read_records, a revisit's payload taken from the record that it refers to."""
    found = materialise(read_records(selected, path), "warc-records")
    wanted = found.where("record_type = 'revisit'").select(F.col("payload_digest").alias("digest"), F.col("refers_to").alias("page_id")).distinct()
    held = index.where("record_type = 'response'").join(wanted, ["digest", "page_id"], "left_semi").dropDuplicates(["digest", "page_id"])
    payloads = read_records(held, path).select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"), F.col("payload").alias("_payload"))
    same = (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    return found.join(payloads, same, "left").withColumn("payload", F.coalesce("payload", "_payload")).drop("_page", "_digest", "_payload")
