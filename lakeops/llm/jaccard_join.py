"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its distinct 5-word shingles. Sets fall into bands of size; two
sets of a Jaccard similarity of at least 0.8 differ in at most (a + b) / 9 shingles, so in
a band with largest size r in at most k = 2r/9. The shingle domain is cut by a hash into
groups, 9k/16 + SPARE of them, and every group into three parts. On the first level k
differences cannot put two into every group; on the second, a group with one difference
keeps two of its three parts: so the subsets of two parts of each group are enumerated, and
the set's shingles in such a subset, if two or more, make a signature. How many signatures
of a set k differences can spoil at most is counted exactly, group by group; a set with more
agrees with every similar set of the band in one of them. The few sets with fewer also give
every shingle as a signature, which settles pairs of two such sets. A set near the upper end
of its band also signs for the next band. No similar pair is missed. (Subsets with a single
shingle are left out because every passage that two documents share would make them candidates.)

Sets that share a signature are candidates. More is promised: similar sets agree in at least
t = signatures - spoiled ones, so each set goes without its t - 1 most frequent ones. True overlaps
are counted, but not for all pairs of a signature's bucket. Each set is compared with its pivot, the
set that leads most of its buckets; that unites
most of a group of near copies at the cost of one comparison each. Sets that have their pivot
in common are then joined on what sets them apart from it (prefixes of the rarest hashes
first), which finds their similar pairs without going through all. Sets that still share a
signature with one of another pivot that is not united with them are joined on their own
shingles, the rarest first: two similar sets have one in common among the few first of both, so
what many sets share brings none of them together. No link between different groups is lost.

Defined cases: a null or wordless text has an empty set and is linked with nothing; fewer
than five words are one shingle; rows with the same id are one node with several sets; rows
with a null id are linked with nothing and get a null component; an empty table gives an
empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from lakeops.llm.frames import components, materialise, scratch_folder, small_side
from lakeops.llm.words import hidden
from lakeops.session import remove

WORDS = 5
#: The similarity as a ratio: 4 / 5.
NUM, DEN = 4, 5
#: Groups beyond 9k/16, so that poor groups hardly ever use up the guarantee.
SPARE = 4
#: Parts of a group; its signatures leave out one of them each.
SPLIT = 3
#: Bands grow by 1 / 0.64: two steps of the largest ratio between similar sets.
GROWTH = (25, 16)
_CACHE_WORDS = 500_000
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixing bijection of unsigned 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit hashes of words; forgotten when they become too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(hashes.__getitem__, words), _U, len(words))
    n = min(len(h), WORDS)
    out = np.full(len(h) - n + 1, n, _U)
    for i in range(n):
        out = out * _U(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i]
    return np.unique(mix(out))


def band_of(size: int) -> tuple[int, int]:
    """Number and largest size of the band that holds ``size``."""
    band, low = 0, 1
    while True:
        top = max(low, low * GROWTH[0] // GROWTH[1])
        if size <= top:
            return band, top
        band, low = band + 1, top + 1


def sign(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of a set, and beside each -(2 t + place).

    Place 0 is the set's own band, 1 the next. A similar set of that band agrees in at least
    t of the place's signatures (1 where the parts don't promise more).
    """
    size = len(u)
    if not size:
        return np.empty(0, _U), np.empty(0, np.int64)
    band, top = band_of(size)
    largest_partner = size * DEN // NUM
    places = [(band, top)]
    if largest_partner > top:
        places.append(band_of(top + 1))
    out, notes = [], []
    inner = mix(u + _U(0x632BE59BD9B4E019))
    for place, (number, most) in enumerate(places):
        groups = 9 * (2 * most // 9) // 16 + SPARE
        part = (u % _U(groups * SPLIT)).astype(np.int64)
        total = np.zeros(groups * SPLIT, _U)
        np.add.at(total, part, inner)
        total = total.reshape(groups, SPLIT)
        count = np.bincount(part, minlength=groups * SPLIT).reshape(groups, SPLIT)
        # a signature is a group without one of its parts
        used = count.sum(1, keepdims=True) - count > 1
        content = (total.sum(1, keepdims=True, dtype=_U) - total)[used]
        salt = mix(np.array([number + 1], _U))
        out.append(mix(content + salt * (np.flatnonzero(used).astype(_U) + _U(1))))
        # the first difference in a group spoils all but one of its signatures, the second that one
        have = used.sum(1)
        first = have - used.min(1)
        spoils = np.sort(np.concatenate([first, have - first]))
        differences = (size + min(largest_partner, most)) // 9
        agree = int(have.sum() - spoils[max(0, len(spoils) - differences) :].sum())
        if agree < 1:
            out.append(mix(u + salt))
        count = sum(map(len, out)) - sum(map(len, notes))
        notes.append(np.full(count, -(2 * max(agree, 1) + place), np.int64))
    return np.concatenate(out), np.concatenate(notes)


ROWS = "sig bigint, id bigint, n bigint, rest bigint"


def _sign_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ROWS: a document's signatures (n < 0, see sign), and one row that describes its set.

    That row holds the set's size as n and its 128-bit digest as sig and rest.
    """
    hashes = WordHashes()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            out: list[tuple[np.ndarray, ...]] = []
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                u = shingle_set(text, hashes)
                signed, notes = sign(u if doc is not None else u[:0])
                digest = np.frombuffer(xxhash.xxh3_128_digest(u.tobytes()), np.int64)
                n, rest = np.append(notes, len(u)), np.zeros(len(signed) + 1, np.int64)
                rest[-1] = digest[1]
                out.append((np.append(signed.view(np.int64), digest[0]), np.full(len(n), doc or 0, np.int64), np.full(len(n), doc is None), n, rest))
            sig, ids, no_id, n, rest = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig), pa.array(ids, mask=no_id), pa.array(n), pa.array(rest)], ["sig", "id", "n", "rest"]
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            blobs = [shingle_set(t, hashes).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(blobs, pa.binary())], ["id", "shingles"])


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature: those that share theirs with another, and all that describe sets."""
    last, given = None, True  # the latest row, and whether it was given out
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, n = batch.column("sig").to_numpy(), batch.column("n").to_numpy()
        same = sig[1:] == sig[:-1]
        as_before = last is not None and last.column("sig")[0].as_py() == sig[0]
        keep = n >= 0
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= as_before
        if as_before and not given:
            yield last
        yield batch.filter(pa.array(keep))
        last, given = batch.slice(batch.num_rows - 1, 1), bool(keep[-1])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """linked: 100 * intersection >= 80 * union; difference: the hashes in one set only."""
    for batch in batches:
        linked, differences = [], []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            a, b = np.frombuffer(x, _U), np.frombuffer(y, _U)
            apart = np.setxor1d(a, b, assume_unique=True)
            common = (len(a) + len(b) - len(apart)) // 2
            linked.append(bool(common) and DEN * common >= NUM * (len(apart) + common))
            differences.append(apart.view(np.int64))
        ends = np.cumsum([0, *map(len, differences)]).astype(np.int32)
        flat = np.concatenate(differences) if differences else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
            ["a", "b", "linked", "apart"],
        )


def join_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, component: one row per row of ``docs``, stored; all else that was stored on the way goes."""
    spark = docs.sparkSession
    with scratch_folder(spark, "jaccard") as folder:
        found = _join(docs, doc_id, text)
    stored = materialise(found, "similar")
    remove(spark, folder)
    return stored


def _join(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = _narrow(docs, doc_id, text)
    buckets = materialise(
        rows.mapInArrow(_sign_all, ROWS).repartition("sig").sortWithinPartitions("sig").mapInArrow(_shared, ROWS), "buckets"
    )
    sets = buckets.where("n >= 0").select("id", F.col("n").alias("n_shingles"), "sig", "rest")
    # copies of one set are one class, known by its smallest id
    known = sets.where("id IS NOT NULL AND n_shingles > 0")
    classes = materialise(known.groupBy("sig", "rest").agg(F.min("id").alias("rep")), "classes")
    rep_of = materialise(known.join(classes, ["sig", "rest"]).select("id", "rep", "n_shingles").distinct(), "reps")
    buckets = buckets.where("n < 0").select("sig", "id", "n")
    links = _resolve(rows, buckets, rep_of)
    nodes = components(links.select("a", "b").unionByName(rep_of.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    found = nodes.select(F.col("node").alias("_node"), "component")
    return sets.join(found, F.col("id") == F.col("_node"), "left").select(
        "id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component")
    )


def _resolve(rows: DataFrame, buckets: DataFrame, rep_of: DataFrame) -> DataFrame:
    """Links (a, b) between classes that connect whatever is connected by similar pairs."""
    # the sizes of a class, least and greatest should an id have several sets
    sizes = materialise(rep_of.groupBy("rep").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high")), "sizes")
    of_class = buckets.join(rep_of.select("id", "rep").distinct(), "id").select("sig", "rep", "n").distinct()
    several = of_class.groupBy("sig").agg(F.min("rep").alias("x"), F.max("rep").alias("y"), F.count(F.lit(1)).alias("size"))
    met = of_class.join(several.where("x < y").select("sig", "size"), "sig")
    # a set that agrees with a similar one in t signatures agrees in one of all but its t - 1
    # most frequent ones: what many share, such as a passage, makes no candidates
    hottest = F.row_number().over(W.partitionBy("rep", "n").orderBy(F.desc("size"), "sig"))
    kept = met.withColumn("hot", hottest).where(F.col("hot") >= F.floor(-F.col("n") / 2)).select("sig", "rep")
    kept = materialise(kept.distinct(), "kept")
    several = kept.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialise(kept.join(several, "sig"), "members")
    shared = members.groupBy("rep").agg(F.sum("size").alias("shared"))
    members = materialise(members.drop("size").join(shared, "rep").join(sizes, "rep"), "members")

    # each set is compared with its pivot: of the sets that lead its buckets, of similar
    # size, the one it meets most often; the set that meets most others leads a bucket
    order = W.partitionBy("sig").orderBy(F.desc("shared"), "rep")
    ranked = members.withColumns({
        "head": F.first("rep").over(order), "head_low": F.first("low").over(order), "head_high": F.first("high").over(order)
    })
    led = ranked.where("rep <> head").where(_sizes_fit("low", "high", "head_low", "head_high"))
    often = led.groupBy(F.col("rep").alias("b"), "head").agg(F.struct(F.count(F.lit(1)), -F.col("head")).alias("often"))
    pivots = materialise(often.groupBy("b").agg(F.max_by("head", "often").alias("a")), "pivots")
    first = _verify(rows, pivots.select("a", "b"))
    links = first.where("linked").select("a", "b")
    tested = first.select("a", "b")

    # sets with one pivot: by what sets them apart from it
    # (an id with several sets gives several answers; it goes without a family)
    single = materialise(first.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("b"))).where("_n = 1").drop("_n"), "single")
    family = _family_candidates(single, sizes)
    more = _verify(rows, _ordered(family).join(_ordered(tested), ["a", "b"], "left_anti").distinct())
    links = links.unionByName(more.where("linked").select("a", "b"))
    tested = _ordered(tested.unionByName(more.select("a", "b")))

    # what is left in a bucket: sets of different families that are not united
    is_pivot = pivots.select(F.col("a").alias("rep")).distinct().withColumn("_pivot", F.lit(True))
    of_family = (
        members.select("rep").distinct()
        .join(single.select(F.col("b").alias("rep"), F.col("a").alias("_of")), "rep", "left")
        .join(is_pivot, "rep", "left")
        .select("rep", F.when(F.col("_pivot"), F.col("rep")).otherwise(F.coalesce("_of", "rep")).alias("family"))
    )
    of_family = of_family.groupBy("rep").agg(F.min("family").alias("family"))
    label = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_label"))
    known = of_family.join(label, F.col("rep") == F.col("_node"), "left")
    known = materialise(known.select("rep", "family", F.coalesce("_label", "rep").alias("label")), "families")
    labelled = members.select("sig", "rep").join(known, "rep")
    several = labelled.groupBy("sig").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("label", "family") for f in (F.min, F.max)])
    several = several.where("min_label < max_label AND min_family < max_family").select("sig")
    left = materialise(labelled.join(several, "sig").select("rep", "family", "label").distinct(), "left")
    rest = _ordered(_prefix_candidates(rows, left)).distinct()
    checked = _verify(rows, rest.join(tested, ["a", "b"], "left_anti"))
    return links.unionByName(checked.where("linked").select("a", "b"))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each hash of a set; s tells the sets of one id apart."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            sets = [np.frombuffer(x, np.int64) for x in part.column("shingles").to_pylist()]
            sizes = np.array(list(map(len, sets)), np.int64)
            keys = [xxhash.xxh3_64_intdigest(x, seed=i & 0xFFFFFFFF) for x, i in zip(part.column("shingles").to_pylist(), part.column("id").to_pylist())]
            wide = lambda x: pa.array(np.repeat(x, sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    wide(np.array(keys, _U).view(np.int64)), wide(part.column("id").to_numpy()), wide(sizes),
                    pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64)),
                ],
                ["s", "rep", "n", "e"],
            )


def _prefix_candidates(rows: DataFrame, left: DataFrame) -> DataFrame:
    """Pairs (a, b) of the sets ``left`` of different label and family that may be similar.

    Sets of x and y hashes are similar only if they have t = 4 (x + y) / 9 of them in common. In
    any order of the hashes that all sets keep to, the first common one is then
    among the first x - t + 1 of one and the first y - t + 1 of the other. The order is from
    the rarest on; hashes that only one set has are counted and not joined.
    """
    own = _sets_of(rows, left.select("rep")).mapInArrow(_prefixes, "s bigint, rep bigint, n bigint, e bigint")
    own = materialise(own, "elements")
    often = own.groupBy("e").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    common = own.join(often, "e")
    alone = F.col("n") - F.count(F.lit(1)).over(W.partitionBy("s"))
    place = alone + F.row_number().over(W.partitionBy("s").orderBy("often", "e"))
    # the longest prefix that any partner asks for, the smallest one
    placed = common.withColumn("pos", place).where(F.col("pos") <= F.floor(F.col("n") / DEN) + 1).join(left, "rep")
    placed = materialise(placed.select("e", "rep", "n", "pos", "label", "family"), "placed")
    shared = placed.groupBy("e").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("label", "family") for f in (F.min, F.max)])
    shared = shared.where("min_label < max_label AND min_family < max_family").select("e")
    placed = materialise(placed.join(shared, "e"), "shared")
    x, y = (placed.select("e", *[F.col(c).alias(f"{c}_{k}") for c in ("rep", "n", "pos", "label", "family")]) for k in "xy")
    needed = F.ceil(NUM * (F.col("n_x") + F.col("n_y")) / (NUM + DEN))
    meet = (
        (F.col("rep_x") < F.col("rep_y"))
        & (F.col("label_x") != F.col("label_y"))
        & (F.col("family_x") != F.col("family_y"))
        & (F.col("pos_x") <= F.col("n_x") - needed + 1)
        & (F.col("pos_y") <= F.col("n_y") - needed + 1)
    )
    return x.join(y, "e").where(meet).select(F.col("rep_x").alias("a"), F.col("rep_y").alias("b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _sizes_fit(low: str, high: str, other_low: str, other_high: str) -> str:
    """Sets of too different sizes are not similar, whatever they hold."""
    return f"{DEN} * {high} >= {NUM} * {other_low} AND {DEN} * {other_high} >= {NUM} * {low}"


def _verify(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, linked, apart (hashes in one of the sets only), stored; only the pairs' texts are read again."""
    pairs = materialise(pairs, "pairs")
    sets = _sets_of(rows, pairs.select(F.col("a").alias("rep")).union(pairs.select("b")))
    left, right = (sets.select(F.col("id").alias(k), F.col("shingles").alias(f"set_{k}")) for k in ("a", "b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b")
    return materialise(both.mapInArrow(_compare, "a bigint, b bigint, linked boolean, apart array<bigint>"), "checked")


def _sets_of(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """id, shingles of the sets with these ids, stored; each once."""
    wanted = materialise(reps.select(F.col("rep").alias("_rep")).distinct(), "wanted")
    texts = rows.join(small_side(wanted), F.col("id") == F.col("_rep"), "left_semi")
    sets = materialise(texts.mapInArrow(_sets, "id bigint, shingles binary"), "sets")
    return sets.distinct() if sets.count() > wanted.count() else sets  # rows that repeat an id


def _family_candidates(first: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets with one pivot that may be similar, of which one is not linked with it.

    With Dx the hashes that set x apart from the pivot, two sets differ in Dx xor Dy. They
    are similar only if Dx and Dy have t >= (dx + dy - k) / 2 hashes in common, k = (nx + ny)
    / 9. Ordered from the rarest in the family, Dx and Dy then share a hash among their first
    (dx - dy + k) / 2 + 1 and (dy - dx + k) / 2 + 1. What many members have changed alike
    comes late in that order, so pairs meet only over changes that few others have.
    """
    n = sizes.select(F.col("rep").alias("x"), F.col("low").alias("n"), F.col("high").alias("n_high"))
    own = first.select(F.col("a").alias("c"), F.col("b").alias("x"), "linked", "apart").join(n, "x")
    pivot = sizes.select(F.col("rep").alias("c"), F.col("low").alias("nc"))
    mixed = own.groupBy("c").agg(F.count(F.lit(1)).alias("m"), F.bool_and("linked").alias("all")).where("m > 1 AND NOT all")
    own = own.join(mixed.select("c"), "c").join(pivot, "c")
    own = own.select("c", "x", "linked", "n", "n_high", "nc", F.size("apart").alias("d"), F.explode("apart").alias("e"))
    own = materialise(own, "apart")
    rare = own.groupBy("c", "e").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # a hash that no other member has joins nothing, but it counts in the order: first
    placed = own.join(rare, ["c", "e"], "left").withColumn("often", F.coalesce("often", F.lit(1)))
    order = W.partitionBy("c", "x").orderBy("often", "e")
    placed = placed.withColumn("pos", F.row_number().over(order)).where("often > 1")
    # the longest prefix that any partner asks for: partners without a link to the pivot are
    # more than (n + nc) / 9 away from it, others of any distance
    from_open = F.col("pos") <= (F.col("d") + (F.col("n_high") - F.col("nc")) / 9) / 2 + 1
    from_any = F.col("pos") <= (F.col("d") + F.col("n_high") / 4) / 2 + 1
    placed = materialise(placed.where(from_open | (from_any & ~F.col("linked"))), "prefixes")
    open_side = placed.where(~F.col("linked")).select("c", "e", *[F.col(c).alias(f"{c}_a") for c in ("x", "d", "n_high", "pos")])
    other = placed.where(from_open).select("c", "e", *[F.col(c).alias(f"{c}_b") for c in ("x", "d", "n_high", "pos")])
    met = open_side.join(other, ["c", "e"]).where("x_a <> x_b")
    k = F.floor((F.col("n_high_a") + F.col("n_high_b")) / 9)
    gap = F.col("d_a") - F.col("d_b")
    met = met.where((F.abs(gap) <= k) & (F.col("pos_a") <= (gap + k) / 2 + 1) & (F.col("pos_b") <= (k - gap) / 2 + 1))
    return met.select(F.col("x_a").alias("a"), F.col("x_b").alias("b")).distinct()


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every group, that with the smallest id, with its own columns.

    Wordless documents and those without an id all stay; of rows that repeat an id one stays.
    """
    found = join_similar(docs, doc_id, text).where("id IS NOT NULL AND n_shingles > 0")
    repeated = found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    repeated = materialise(repeated, "repeated")
    gone = found.where("id <> component").select("id").unionByName(repeated).distinct()
    gone = materialise(gone.select(F.col("id").alias("_gone")), "gone")
    rows = docs.select(hidden(docs), F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    stay = rows.join(small_side(gone), F.col("id") == F.col("_gone"), "left_anti").select("row.*")
    if repeated.isEmpty():
        return stay
    heads = found.join(repeated, "id").where("id = component").select(F.col("id").alias("_head")).distinct()
    wordless = F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     ")) == ""
    again = rows.join(repeated.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_semi")
    chosen = W.partitionBy("id").orderBy(F.xxhash64("text"))
    one = (
        again.where(~wordless)
        .join(heads, F.col("id") == F.col("_head"), "left_semi")
        .withColumn("n", F.row_number().over(chosen))
        .where("n = 1")
    )
    return stay.unionByName(one.select("row.*")).unionByName(again.where(wordless).select("row.*"))
