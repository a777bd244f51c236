"""Line dedup with exact reference counts and sharded cuckoo filters, reversible.

The index of a corpus is a folder of three tables:

  counts     key (128-bit digest of a line's key), docs: how many documents have the line
  filters    shard, buckets: a cuckoo filter over the shard's frequent keys
  exceptions key: infrequent keys that a filter takes for frequent ones

A line is frequent if its count reaches the threshold. Filter and exceptions together decide
that exactly, with about two bytes for a frequent line, so documents are cleaned in one pass
without a shuffle while both are small (``BROADCAST_BYTES``, measured first); beyond that the
documents' keys are joined with the counts.

``insert`` and ``delete`` add and take away whole documents: counts are added up, keys that
cross the threshold are put into or taken out of their filters. Where the frequent keys have
outgrown the shards, their number is doubled until they fit and the filters are made anew
from the counts, so no shard grows without bound however small the first batch was. Deleting
what was inserted gives back the counts and the texts as they were. Every version is a new folder; the old one
stays valid, so a job that dies is simply run again.

Defined cases: a null or empty text is one empty line; empty keys are never dropped; a line
that a document repeats counts once for it; every row is a document of its own, also one
that repeats another; an empty table gives an empty index; other columns stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.frames import materialise, small_side
from lakeops.llm.words import hidden, text_of
from lakeops.session import new_scratch

THRESHOLD = 10
SLOTS = 4
KEYS_PER_SHARD = 1 << 18
BROADCAST_BYTES = 64 << 20
_U = np.uint64


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return line.strip().lower()


def digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key's two buckets differ by its fingerprint's hash."""

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets
        self.mask = len(buckets) - 1

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        n = 1 << max(2, math.ceil(math.log2(max(1, keys) / (SLOTS * 0.85))))
        return cls(np.zeros((n, SLOTS), np.uint16))

    def places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets."""
        raw = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        mark = (raw[:, 1] % _U(65535) + _U(1)).astype(np.uint16)
        first = (raw[:, 1] >> _U(20)).astype(np.int64) & self.mask
        return mark, first, first ^ self._jump(mark)

    def _jump(self, mark: np.ndarray) -> np.ndarray:
        return (mark.astype(_U) * _U(0x9E3779B97F4A7C15) >> _U(24)).astype(np.int64) & self.mask

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, bool)
        mark, a, b = self.places(keys)
        return ((self.buckets[a] == mark[:, None]) | (self.buckets[b] == mark[:, None])).any(1)

    def insert(self, keys: list[bytes]) -> bool:
        """False if no room was found; the filter must then be made anew, larger."""
        if not keys:
            return True
        rng = np.random.default_rng(len(keys))
        for mark, a, b in zip(*(x.tolist() for x in self.places(keys))):
            if not (self._put(a, mark) or self._put(b, mark)) and not self._kick(a, mark, rng):
                return False
        return True

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.buckets[bucket] == 0)
        if len(free):
            self.buckets[bucket, free[0]] = mark
        return bool(len(free))

    def _kick(self, bucket: int, mark: int, rng: np.random.Generator) -> bool:
        for _ in range(500):
            slot = rng.integers(SLOTS)
            mark, self.buckets[bucket, slot] = int(self.buckets[bucket, slot]), mark
            bucket ^= int(self._jump(np.array([mark], np.uint16))[0])
            if self._put(bucket, mark):
                return True
        return False

    def delete(self, keys: list[bytes]) -> None:
        """Take out keys that were put in."""
        if not keys:
            return
        for mark, a, b in zip(*(x.tolist() for x in self.places(keys))):
            for bucket in (a, b):
                held = np.flatnonzero(self.buckets[bucket] == mark)
                if len(held):
                    self.buckets[bucket, held[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.buckets.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, "<u2").reshape(-1, SLOTS).astype(np.uint16))


def filled(keys: list[bytes]) -> CuckooFilter:
    room = len(keys)
    while True:
        made = CuckooFilter.sized(room)
        if made.insert(keys):
            return made
        room = room * 2 + 4


def shard_of(key: bytes, shards: int) -> int:
    return int.from_bytes(key[:4], "little") % shards


@dataclass(frozen=True)
class LineIndex:
    """Where a version of the index lies."""

    path: str
    shards: int
    threshold: int = THRESHOLD

    def counts(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/counts")

    def filters(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/filters")

    def exceptions(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/exceptions")


def document_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """key, docs: the distinct keys of every document, counted over all documents."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = []
                for t in batch.column(0).slice(at, 500).to_pylist():
                    own = {line_key(x) for x in t.encode("utf-8").split(b"\n")}
                    own.discard(b"")
                    found += map(digest, own)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["key"])

    each = docs.select(text_of(f"`{text}`").alias("text")).mapInArrow(keys, "key binary")
    return each.groupBy("key").agg(F.count(F.lit(1)).alias("docs"))


def _shard_column(shards: int):
    """As shard_of, of the first four bytes, little end first."""
    turned = F.concat(*[F.hex(F.substring("key", i, 1)) for i in (4, 3, 2, 1)])
    return (F.conv(turned, 16, 10).cast("bigint") % shards).cast("int")


def _make_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """shard, buckets from the frequent keys; about KEYS_PER_SHARD of them meet in a shard."""

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = sorted(bytes(k) for k in pdf["key"])
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "buckets": [filled(keys).to_bytes()]})

    by_shard = frequent.select("key", _shard_column(shards).alias("shard"))
    return by_shard.groupBy("shard").applyInPandas(make, "shard int, buckets binary")


def build(docs: DataFrame, text: str = "text", threshold: int = THRESHOLD, path: str | None = None) -> LineIndex:
    """The index of ``docs``."""
    spark = docs.sparkSession
    path = path or new_scratch(spark, "lines")
    document_keys(docs, text).write.parquet(f"{path}/counts")
    frequent = spark.read.parquet(f"{path}/counts").where(F.col("docs") >= threshold)
    index = LineIndex(path, max(1, math.ceil(frequent.count() / KEYS_PER_SHARD)), threshold)
    _make_filters(frequent, index.shards).write.parquet(f"{path}/filters")
    _find_exceptions(spark, index)
    return index


def _change(spark: SparkSession, index: LineIndex, docs: DataFrame, sign: int, text: str) -> LineIndex:
    path = new_scratch(spark, "lines")
    step = document_keys(docs, text).withColumn("docs", F.col("docs") * sign)
    both = index.counts(spark).select("key", "docs", F.col("docs").alias("old")).unionByName(
        step.select("key", "docs", F.lit(0).cast("bigint").alias("old"))
    )
    merged = materialise(both.groupBy("key").agg(F.sum("docs").alias("docs"), F.sum("old").alias("old")), "counts")
    merged.where("docs > 0").select("key", "docs").write.parquet(f"{path}/counts")
    is_now, was = F.col("docs") >= index.threshold, F.col("old") >= index.threshold
    frequent, shards = merged.where(is_now), index.shards
    n_frequent = frequent.count()
    while n_frequent > shards * KEYS_PER_SHARD:
        shards *= 2
    new = LineIndex(path, shards, index.threshold)
    if shards > index.shards:
        filters = _make_filters(frequent, shards)
    else:
        moved = merged.where(is_now != was).select("key", _shard_column(shards).alias("shard"), is_now.alias("come"))
        filters = _updated_filters(index.filters(spark), moved, frequent, shards)
    filters.write.parquet(f"{path}/filters")
    _find_exceptions(spark, new)
    return new


def _updated_filters(old: DataFrame, moved: DataFrame, frequent: DataFrame, shards: int) -> DataFrame:
    """The filters after the keys of ``moved`` have come or gone; full ones are made anew."""

    def update(pdf: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        shard = int((pdf if len(pdf) else old)["shard"].iloc[0])
        made = CuckooFilter.from_bytes(old["buckets"].iloc[0]) if len(old) else CuckooFilter.sized(len(pdf))
        made.delete([bytes(k) for k in pdf.loc[~pdf["come"], "key"]])
        room = made.insert([bytes(k) for k in pdf.loc[pdf["come"], "key"]])
        return pd.DataFrame({"shard": [shard], "buckets": [made.to_bytes() if room else None]})

    done = materialise(
        moved.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(update, "shard int, buckets binary"), "filters"
    )
    full = done.where("buckets IS NULL").select("shard")
    again = frequent.withColumn("shard", _shard_column(shards)).join(full, "shard", "left_semi")
    return done.where("buckets IS NOT NULL").unionByName(_make_filters(again, shards))


def insert(spark: SparkSession, index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    return _change(spark, index, docs, 1, text)


def delete(spark: SparkSession, index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """Take back documents that were inserted."""
    return _change(spark, index, docs, -1, text)


def _probe(filters: DataFrame, shards: int):
    """The filters on every executor, or None if they are too large for that."""
    size = filters.agg(F.sum(F.octet_length("buckets"))).first()[0] or 0
    if size > BROADCAST_BYTES:
        return None
    held = {r["shard"]: bytes(r["buckets"]) for r in filters.collect()}
    return filters.sparkSession.sparkContext.broadcast((shards, held))


def _maybe(filters: dict[int, CuckooFilter], shards: int, keys: list[bytes]) -> np.ndarray:
    out = np.zeros(len(keys), bool)
    if shards == 1:
        return filters[0].contains(keys) if 0 in filters else out
    places = np.array([shard_of(k, shards) for k in keys])
    for s in np.unique(places):
        if s in filters:
            at = np.flatnonzero(places == s)
            out[at] = filters[s].contains([keys[i] for i in at])
    return out


def _find_exceptions(spark: SparkSession, index: LineIndex) -> None:
    rare = index.counts(spark).where(F.col("docs") < index.threshold).select("key")
    sent = _probe(index.filters(spark), index.shards)
    if sent is None:  # documents will be joined with the counts instead
        rare.limit(0).write.parquet(f"{index.path}/exceptions")
        return

    def wrong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, held = sent.value
        filters = {s: CuckooFilter.from_bytes(b) for s, b in held.items()}
        for batch in batches:
            keys = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, m in zip(keys, _maybe(filters, shards, keys)) if m], pa.binary())], ["key"]
            )

    rare.mapInArrow(wrong, "key binary").write.parquet(f"{index.path}/exceptions")


def clean(docs: DataFrame, index: LineIndex, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (the document's own columns, or those to ``keep``), n_lines, n_dropped, kept (the text)."""
    spark = docs.sparkSession
    rows = docs.select(hidden(docs if keep is None else docs.select(*keep)), text_of(f"`{text}`").alias("text"))
    sent = _probe(index.filters(spark), index.shards)
    exceptions = index.exceptions(spark)
    if sent is None or exceptions.count() * 16 > BROADCAST_BYTES:
        return _clean_by_join(rows, index.counts(spark).where(F.col("docs") >= index.threshold))
    odd = spark.sparkContext.broadcast({bytes(r[0]) for r in exceptions.collect()})

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, held = sent.value
        filters = {s: CuckooFilter.from_bytes(b) for s, b in held.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lines = [t.encode("utf-8").split(b"\n") for t in part.column("text").to_pylist()]
                keys = [line_key(x) for own in lines for x in own]
                digests = [digest(k) for k in keys]
                gone = _maybe(filters, shards, digests).tolist()
                gone = [g and k != b"" and d not in odd.value for g, k, d in zip(gone, keys, digests)]
                kept, dropped, i = [], [], 0
                for own in lines:
                    marks = gone[i : i + len(own)]
                    i += len(own)
                    dropped.append(sum(marks))
                    kept.append(b"\n".join(x for x, m in zip(own, marks) if not m).decode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array([len(x) for x in lines], pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
                    ["row", "n_lines", "n_dropped", "kept"],
                )

    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(drop, f"row {row_type}, n_lines bigint, n_dropped bigint, kept string")


def _clean_by_join(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """The same by joins: a text's frequent keys are found once for all rows with that text."""

    @F.pandas_udf("array<binary>")
    def keys_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [digest(line_key(x)) if line_key(x) else b"" for x in t.encode("utf-8").split(b"\n")])

    keyed = rows.select("row", F.split("text", "\n").alias("lines"), keys_of("text").alias("keys"), F.sha2("text", 256).alias("t"))
    found = (
        keyed.select("t", F.explode(F.array_distinct("keys")).alias("key"))
        .distinct()
        .join(frequent, "key", "left_semi")
        .groupBy("t")
        .agg(F.collect_set("key").alias("hot"))
    )
    both = keyed.join(small_side(materialise(found, "hot-lines").withColumnRenamed("t", "_t"), 10_000), F.col("t") == F.col("_t"), "left")
    pairs = F.filter(F.arrays_zip("lines", "keys"), lambda p: F.col("hot").isNull() | ~F.array_contains("hot", p["keys"]))
    kept = F.transform(pairs, lambda p: p["lines"])
    n = F.size("lines").cast("bigint")
    return both.select("row", n.alias("n_lines"), (n - F.size(kept)).alias("n_dropped"), F.array_join(kept, "\n").alias("kept"))
