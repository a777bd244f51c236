"""Benchmark decontamination by a hash set of normalised test n-grams.

Items of the benchmark give windows of 13 words (a shorter item is one window). The windows
of every document are hashed in the row itself and probed against the set; the few hits are
then compared word by word, so a hash that collides does no harm. Nothing of a document but
its hits, and one row for the document itself, is shuffled.

The set is broadcast while it is known to be small (``BROADCAST_WINDOWS``, counted first);
beyond that the probe is an ordinary shuffled join with the same result.

Defined cases: a null or wordless text has no words and is clean; a null or wordless item
has no windows; items with a null id count for hits but not in the list of items; rows that
repeat a document are answered each; an empty table gives an empty result, an empty
benchmark leaves all documents clean; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.frames import materialise
from lakeops.llm.words import ascii_lower, hidden, text_of, with_windows

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: The set of windows is broadcast up to so many rows and, as measured, so many bytes in memory.
BROADCAST_WINDOWS, BROADCAST_BYTES = 2_000_000, 256 << 20


def item_words(text: str) -> Column:
    return F.regexp_extract_all(ascii_lower(text_of(text)), F.lit(WORD), F.lit(0))


def windows_of(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add the array ``windows`` of (h, n, at) for all windows of the given lengths."""
    df = with_windows(df, "words", lengths, "h")

    def placed_windows(n: int) -> Column:
        size = F.lit(n)
        return F.transform(f"h{n}", lambda h, i: F.struct(F.xxhash64(h, size).alias("h"), size.alias("n"), i.alias("at")))

    placed = [placed_windows(n) for n in lengths]
    return df.withColumn("windows", F.concat(*placed)).drop(*[f"h{n}" for n in lengths])


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """gram (number), h, n, gram_words, item_ids: one row per distinct window."""
    words = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), item_words(f"`{text}`").alias("words")).where(
        F.size("words") > 0
    )
    n = F.least(F.size("words"), F.lit(window))
    last = F.size("words") - n
    grams = words.select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, n))).alias("gram_words"))
    by_gram = grams.groupBy("gram_words").agg(F.collect_set("item").alias("item_ids"))
    counted = materialise(by_gram.withColumn("n", F.size("gram_words")), "grams")
    lengths = [r[0] for r in counted.select("n").distinct().collect()]  # at most ``window`` of them
    hashed = [
        with_windows(counted.where(F.col("n") == size), "gram_words", [size], "h").select(
            F.xxhash64(F.col(f"h{size}")[0], F.lit(size)).alias("h"), "n", "gram_words", "item_ids"
        )
        for size in lengths
    ]
    out = counted.select(F.lit(0).cast("bigint").alias("h"), "n", "gram_words", "item_ids").limit(0)
    for part in hashed:
        out = out.unionByName(part)
    return materialise(out, "grams-hashed")


def can_broadcast(grams: DataFrame) -> bool:
    """Whether the windows, with their words and all their item ids, are small enough."""
    text = lambda c: F.octet_length(F.array_join(c, "")) + 24 * F.size(c)
    rows, size = grams.agg(F.count(F.lit(1)), F.sum(64 + text("gram_words") + text("item_ids"))).first()
    return rows <= BROADCAST_WINDOWS and (size or 0) <= BROADCAST_BYTES


def find_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """id, text_key, copies, n_words, hits (array of (at, n)), items (sorted ids as strings).

    One row per distinct (id, text); ``copies`` says how many rows of the table it stands for.
    Every document sends one row without a position besides its hits, so that the table is
    read once and no document is lost.

    A set of windows too large to broadcast is joined by hash, on rows of a position and a hash
    each; what is found meets its document's words, to be verified, once per document. That
    moves every text once, however long it is.
    """
    grams = benchmark_windows(benchmark, item_id, item_text, window)
    lengths = sorted(r[0] for r in grams.select("n").distinct().collect())
    flat = docs.select(
        F.col(f"`{doc_id}`").alias("id"),
        F.xxhash64(text_of(f"`{text}`"), F.lit(1)).alias("text_key"),
        item_words(f"`{text}`").alias("words"),
    ).withColumn("n_words", F.size("words").cast("bigint"))
    if not can_broadcast(grams):
        return _find_shuffled(flat, grams, lengths)
    nothing = F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(0).alias("n"), F.lit(-1).alias("at"))
    spread = windows_of(flat, lengths) if lengths else flat.withColumn("windows", F.array().cast("array<struct<h:bigint,n:int,at:int>>"))
    probe = spread.select("id", "text_key", "n_words", "words", F.explode(F.concat(F.array(nothing), "windows")).alias("w")).select(
        "id", "text_key", "n_words", "words", "w.*"
    )
    table = grams.withColumnsRenamed({"h": "_h", "n": "_n"})
    match = (F.col("h") == F.col("_h")) & (F.col("n") == F.col("_n"))
    found = probe.join(F.broadcast(table), match, "left").where(
        "at < 0 OR (_h IS NOT NULL AND slice(words, at + 1, n) = gram_words)"
    )
    found = found.select("id", "text_key", "n_words", "at", "n", "item_ids")
    return found.groupBy("id", "text_key", "n_words").agg(
        F.count(F.when(F.col("at") < 0, 1)).alias("copies"),
        F.collect_set(F.when(F.col("at") >= 0, F.struct("at", "n"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("items"),
    )


def _find_shuffled(flat: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    keys = ["id", "text_key", "n_words"]
    once = flat.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.first("words").alias("words"))
    once = materialise(once, "document-words")
    probe = windows_of(once, lengths).select(*keys, F.explode("windows").alias("w")).select(*keys, "w.*")
    found = probe.join(grams, ["h", "n"]).groupBy(*keys).agg(F.collect_list(F.struct("at", "n", "gram_words", "item_ids")).alias("found"))
    found = found.select(*[F.col(k).alias(f"_{k}") for k in keys], "found")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text_key")) & (F.col("n_words") == F.col("_n_words"))
    both = once.join(found, same, "left").select(
        *keys, "copies", F.filter("found", lambda w: F.slice("words", w["at"] + 1, w["n"]) == w["gram_words"]).alias("found")
    )
    hits = F.array_distinct(F.transform("found", lambda w: F.struct(w["at"].alias("at"), w["n"].alias("n"))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda w: w["item_ids"]))))
    return both.select(
        *keys, "copies",
        F.coalesce(hits, F.array().cast("array<struct<at:int,n:int>>")).alias("hits"),
        F.coalesce(items, F.array().cast("array<string>")).alias("items"),
    )


def hit_words(hits: Column) -> Column:
    """How many words the windows cover: sorted by start, each adds what lies beyond the last."""
    return F.aggregate(
        F.sort_array(hits),
        F.struct(F.lit(0).alias("until"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, w: F.struct(
            F.greatest(acc["until"], w["at"] + w["n"]).alias("until"),
            (acc["n"] + F.greatest(w["at"] + w["n"] - F.greatest(acc["until"], w["at"]), F.lit(0))).alias("n"),
        ),
    )["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20, **names) -> DataFrame:
    """id, text_key, copies, n_words, n_hit, items, hits, contaminated; a row per (id, text)."""
    hits = find_hits(docs, benchmark, **names).withColumn("n_hit", hit_words(F.col("hits")))
    bad = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return hits.withColumn("contaminated", bad)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents that are not contaminated, unchanged, with their own columns."""
    bad = materialise(
        contamination(docs, benchmark, doc_id=doc_id, text=text, **names)
        .where("contaminated")
        .select(F.col("id").alias("_id"), F.col("text_key").alias("_key")),
        "contaminated",
    )
    rows = docs.select(
        hidden(docs), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(text_of(f"`{text}`"), F.lit(1)).alias("text_key")
    )
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return rows.join(bad, same, "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", mask: str = " ", **names) -> DataFrame:
    """All documents, the words inside hits replaced by ``mask`` in the text of contaminated ones.

    The text is cut into words and what lies between them; everything else stays as it was.
    """
    hits = contamination(docs, benchmark, doc_id=doc_id, text=text, **names).where("contaminated")
    hits = materialise(hits.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), "hits"), "hits")
    rows = docs.select(
        hidden(docs), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(text_of(f"`{text}`"), F.lit(1)).alias("text_key")
    )
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    both = rows.join(hits, same, "left")
    t = text_of(F.col(f"row.`{text}`"))
    any_case = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    between = F.split(t, any_case, -1)  # one more than there are words
    words = F.regexp_extract_all(t, F.lit(any_case), F.lit(0))
    inside = lambda i: F.exists("hits", lambda w: (w["at"] <= i) & (i < w["at"] + w["n"]))
    kept = F.transform(words, lambda w, i: F.when(inside(i), F.lit(mask)).otherwise(w))
    cleaned = F.array_join(F.zip_with(between, kept, lambda s, w: F.concat(F.coalesce(s, F.lit("")), F.coalesce(w, F.lit("")))), "")
    new = F.when(F.col("hits").isNotNull(), cleaned).otherwise(F.col(f"row.`{text}`"))
    return both.select(*[new.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
