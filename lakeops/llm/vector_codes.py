"""Product quantisation of vectors by member-resident Lloyd.

A vector's components become integers floor(1024 * x); the vector is cut into ``PARTS``
equal parts, and each position has a codebook of up to ``ENTRIES`` entries. The parts are
rows of a stored table, dealt out by (position, entry, salt): an owner holds members of
few entries. A round works on the members where they are: owners sum what is resident, the
sums, one row an entry and task, make the new entries, and every member looks for its
nearest one. A member that keeps its entry is written again by the task that has read it;
only members that change theirs go through the shuffle, to their new owner. The salt
splits an entry however many members it has, so that an owner has about ``OWNER_ROWS`` rows.

The codebooks, 256 entries of a vector's length, are all that the driver sees. They go to
the tasks with the function; the last assignment is one pass over the vectors themselves.

Arithmetic is exact: 64-bit floats while every sum fits their 53 bits, Python's integers
beyond that. Every table that is read again is stored in the shared scratch area; a round's
table goes as soon as the next one is stored.

Defined cases: a null vector, or one with a null, NaN or infinite component, has no result
row; a null id comes after all others when the first entries are picked; rows with the same
id are told apart by their vectors, equal rows each count; with fewer kept rows than entries
there are as many entries as rows; an empty vector has empty parts and the first entry's
code; an empty table gives an empty result; an error beyond 64 bits is the largest 64-bit
number; vectors of different lengths, or of a length that the parts don't divide, end the job
with a ValueError. Columns that are neither read nor kept are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.frames import materialise, small_side
from lakeops.session import new_scratch, remove

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
OWNER_ROWS = 1 << 16
_EXACT = float(1 << 52)
_LONGEST = (1 << 63) - 1
#: Rows a task works on at a time: the distances to all entries take 2 KB a row.
_CHUNK = 4096

Codebooks = list[np.ndarray]


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x): integral floats, or Python integers where floats would not be exact."""
    x = x.astype(np.float64)
    if not x.size or np.abs(x).max() * SCALE < _EXACT:
        return np.floor(x * SCALE)
    exact = lambda v: int(v) * SCALE + math.floor((v - int(v)) * SCALE)
    return np.array([exact(v) for v in x.ravel().tolist()], object).reshape(x.shape)


def _as_python(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else x.astype(np.int64).astype(object)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row the nearest entry, of several the first, and the squared distance."""
    size = x.shape[1]
    if x.dtype != object and entries.dtype != object:
        most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
        if 4 * most * most * max(size, 1) < _EXACT:
            apart = (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]
            entry = apart.argmin(1)
            return entry, apart[np.arange(len(x)), entry].astype(np.int64)
    rows, known = _as_python(x).tolist(), _as_python(entries).tolist()
    best = [min((sum((a - b) ** 2 for a, b in zip(r, e)), k) for k, e in enumerate(known)) for r in rows]
    return np.array([k for _, k in best], np.int64), np.array([min(d, _LONGEST) for d, _ in best], np.int64)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * size:
        raise ValueError("the vectors differ in length")
    return flat.reshape(len(column), size)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _CHUNK):
            yield batch.slice(at, _CHUNK)


class Totals:
    """Sums and counts of integer rows by (position, entry); exact."""

    def __init__(self, size: int):
        self.sums, self.bound = np.zeros((PARTS, ENTRIES, size), np.int64), 0.0
        self.counts = np.zeros((PARTS, ENTRIES), np.int64)

    def add(self, pos: np.ndarray, entry: np.ndarray, x: np.ndarray, counts: np.ndarray | int = 1) -> None:
        if self.sums.dtype != object:
            most = float(np.abs(x).max()) if x.size else 0.0
            self.bound += most * len(x)
            if self.bound >= 2.0**62:
                self.sums = self.sums.astype(object)
        np.add.at(self.sums, (pos, entry), _as_python(x) if self.sums.dtype == object else x.astype(np.int64))
        np.add.at(self.counts, (pos, entry), counts)

    def rows(self) -> pa.RecordBatch:
        pos, entry = np.nonzero(self.counts)
        sums = [[str(v) for v in self.sums[p, e].tolist()] for p, e in zip(pos, entry)]
        return pa.RecordBatch.from_arrays(
            [pa.array(pos, pa.int32()), pa.array(entry, pa.int32()), pa.array(self.counts[pos, entry]), pa.array(sums, pa.list_(pa.string()))],
            ["pos", "entry", "members", "sums"],
        )


SUMS = "pos int, entry int, members bigint, sums array<string>"


def _sum_members(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(size)
        for b in _chunks(batches):
            totals.add(b.column("pos").to_numpy(), b.column("entry").to_numpy(), integers(_matrix(b.column("x"), size)))
        yield totals.rows()

    return run


def _sum_sums(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Totals(size)
        for b in _chunks(batches):
            x = np.array([int(v) for v in b.column("sums").flatten().to_pylist()], object).reshape(b.num_rows, size)
            totals.add(b.column("pos").to_numpy(), b.column("entry").to_numpy(), x, b.column("members").to_numpy())
        yield totals.rows()

    return run


def _updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry that has members becomes the floor of their mean."""
    size = books[0].shape[1]
    sums = members.select("pos", "entry", "x").mapInArrow(_sum_members(size), SUMS)
    sums = sums.repartition("pos", "entry").mapInArrow(_sum_sums(size), SUMS)  # an entry's sums stream through one task
    new = [_as_python(b).copy() for b in books]
    for row in sums.collect():  # one row an entry
        new[row["pos"]][row["entry"]] = [int(v) // row["members"] for v in row["sums"]]
    return [_narrow(b) for b in new]


def _narrow(book: np.ndarray) -> np.ndarray:
    small = all(abs(v) < _EXACT for v in book.ravel().tolist())
    return book.astype(np.float64) if small else book


def _assign_members(books: Codebooks) -> Callable:
    """Members with their new entry; moved tells whether it is another one."""
    size = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            pos, x = b.column("pos").to_numpy(), integers(_matrix(b.column("x"), size))
            entry = np.zeros(len(pos), np.int32)
            for p in np.unique(pos).tolist():
                at = np.flatnonzero(pos == p)
                entry[at] = nearest(x[at], books[p])[0]
            moved = entry != b.column("entry").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column("pos"), pa.array(entry), b.column("salt"), b.column("x"), pa.array(moved)], ["pos", "entry", "salt", "x", "moved"]
            )

    return run


def _cut(books: Codebooks, kind: pa.DataType) -> Callable:
    """A row for each part of a vector, with its first entry."""
    size = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            whole = _matrix(b.column("x"), PARTS * size)
            for p, book in enumerate(books):
                part = np.ascontiguousarray(whole[:, p * size : (p + 1) * size])
                entry = nearest(integers(part), book)[0].astype(np.int32)
                ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * size)
                x = pa.ListArray.from_arrays(ends, pa.array(part.ravel(), kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), p, np.int32)), pa.array(entry), b.column("salt"), x], ["pos", "entry", "salt", "x"]
                )

    return run


def _encode(books: Codebooks) -> Callable:
    """row, code, error of every vector."""
    size = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            whole = integers(_matrix(b.column("x"), PARTS * size))
            found = [nearest(whole[:, p * size : (p + 1) * size], book) for p, book in enumerate(books)]
            codes = np.stack([e for e, _ in found], 1).astype(np.uint8)
            errors = [min(sum(e), _LONGEST) for e in zip(*[d.tolist() for _, d in found])]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors, pa.int64())],
                ["row", "code", "error"],
            )

    return run


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, odd)


def codebook_digest(books: Codebooks) -> str:
    flat = [str(int(v)) for b in books for v in _as_python(b).ravel().tolist()]
    return hashlib.sha256(",".join(flat).encode()).hexdigest()


def learn(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> Codebooks:
    """The final codebooks, one array of entries for each position; none without a usable vector."""
    spark = vectors.sparkSession
    rows, kind = _narrowed(vectors, vector, [F.col(f"`{vec_id}`").alias("id")])
    length = F.size("x")
    n, shortest, longest = rows.agg(F.count(F.lit(1)), F.min(length), F.max(length)).first()
    if not n:
        return []
    if shortest != longest or longest % PARTS:
        raise ValueError(f"the vectors need one length that {PARTS} divides; there are {shortest} to {longest}")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    start = integers(np.array([r["x"] for r in first], np.float64).reshape(len(first), longest))
    books = [_narrow(b) for b in np.split(_as_python(start), PARTS, 1)]

    salts = -(-n // OWNER_ROWS)
    schema = f"pos int, entry int, salt int, x array<{kind}>"
    arrow = pa.float32() if kind == "float" else pa.float64()
    parts = rows.select(F.pmod(F.xxhash64("id", "x"), F.lit(salts)).cast("int").alias("salt"), "x").mapInArrow(_cut(books, arrow), schema)
    owned = lambda df: df.repartition("pos", "entry", "salt")
    read = lambda *paths: spark.read.schema(schema).parquet(*paths)
    resident = new_scratch(spark, "members")
    owned(parts).write.parquet(f"{resident}/all")
    members = read(f"{resident}/all")
    books = _updated(members, books)
    for _ in range(ROUNDS - 1):
        path = new_scratch(spark, "members")
        assigned = members.mapInArrow(_assign_members(books), f"{schema}, moved boolean")
        assigned.write.partitionBy("moved").parquet(f"{path}/by")
        whole = spark.read.schema(f"{schema}, moved boolean").parquet(f"{path}/by")
        owned(whole.where("moved").drop("moved")).write.parquet(f"{path}/arrived")
        members = whole.where("NOT moved").drop("moved").unionByName(read(f"{path}/arrived"))
        remove(spark, resident)
        resident = path
        books = _updated(members, books)
    remove(spark, resident)
    return books


def _narrowed(vectors: DataFrame, vector: str, more: Sequence[Column]) -> tuple[DataFrame, str]:
    kind = "float" if dict(vectors.dtypes)[vector] == "array<float>" else "double"
    x = F.col(f"`{vector}`").cast(f"array<{kind}>")
    return vectors.where(usable(x)).select(*more, x.alias("x")), kind


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding", keep: Sequence[str] = ("vec_id", "label")) -> DataFrame:
    """row (the columns ``keep``), code and error of every usable vector."""
    rows, _ = _narrowed(vectors, vector, [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")])
    if not books:
        return rows.where("false").select("row", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_encode(books), f"row {kind}, code string, error bigint")


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with label_error: the errors of all rows with an equal ``row`` label, nulls together."""
    coded = materialise(coded, "coded")
    of_label = F.col(f"row.`{label}`")
    exact = F.sum(F.col("error").cast("decimal(28,0)"))
    sums = coded.groupBy(of_label.alias("_label")).agg(F.least(exact, F.lit(_LONGEST).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    sums = materialise(sums, "label_errors")
    return coded.join(small_side(sums), of_label.eqNullSafe(F.col("_label"))).drop("_label")
