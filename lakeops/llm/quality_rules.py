"""Quality rules for documents, with verdicts on whole hosts.

Every document is measured by rules that look at it alone. Failures are added up by host
(for ``documents`` its source), each host's failure rate is shrunk towards the mean of all
hosts by a beta prior fitted to the hosts themselves, and the hosts' verdicts are joined
back to their documents.

Base rules reject by themselves. A document that fails only finer rules is kept unless its
host is bad; a host that is bad nearly throughout is blocked as a whole.

Defined cases: a null text has no words (and fails the base rules); a null host is a host
of its own; repeated rows are judged each by itself and count each in their host's rate; an
empty table gives an empty result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.frames import materialise
from lakeops.llm.words import SPACES, hidden, space_words, stretch, text_of, with_windows, without

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Base limits, finer limits, and what makes a host bad."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_mean_word: float = 2.0
    max_mean_word: float = 14.0
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    max_fine_repeat_percent: int = 30
    strict_rate: float = 0.5
    block_rate: float = 0.9


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns of MEASURES; ``df`` must not have columns of these names.

    Repeated words: hash every window of three words, sort the hashes with their positions,
    keep those that equal a neighbour, and count the words that they cover.
    """
    own = df.columns
    t = text_of(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.select(
        "*",
        space_words(t).alias("_words"),
        F.length(without(t, SPACES)).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(without(t, SYMBOLS))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
    )
    df = df.select(
        *own, "word_chars", "n_symbols", "_words",
        F.size("_words").cast("bigint").alias("n_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
    )
    df = with_windows(df, "_words", [3], "_h").drop("_words")
    placed = F.transform("_h3", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_placed", placed).drop("_h3").withColumn("_sorted", F.sort_array("_placed")).drop("_placed")
    found_twice = F.filter(
        "_sorted",
        lambda x, i: (F.get("_sorted", i - 1)["h"] == x["h"]) | (F.get("_sorted", i + 1)["h"] == x["h"]),
    )
    df = df.withColumn("_twice", F.sort_array(F.transform(found_twice, lambda x: x["i"]))).drop("_sorted")
    steps = F.size("_twice") - 1
    covered = F.aggregate(
        F.zip_with(stretch(F.col("_twice"), 0, steps), stretch(F.col("_twice"), 1, steps), lambda a, b: F.least(b - a, F.lit(3))),
        F.lit(3).cast("int"),
        lambda a, b: a + b,
    )
    repeat = F.when(F.size("_twice") == 0, F.lit(0)).otherwise(covered).cast("bigint")
    return df.withColumn("n_repeat_words", repeat).select(*own, *MEASURES)


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )


def fine_failed(limits: Limits) -> Column:
    """Finer rules; false, not null, for a text without words."""
    n = F.col("n_words")
    return (n > 0) & (
        (F.col("word_chars") < limits.min_mean_word * n)
        | (F.col("word_chars") > limits.max_mean_word * n)
        | (100 * F.col("n_symbols") > limits.max_symbol_percent * n)
        | (100 * F.col("n_dup_lines") > limits.max_dup_line_percent * F.col("n_lines"))
        | (100 * F.col("n_repeat_words") > limits.max_fine_repeat_percent * n)
    )


def host_verdicts(judged: DataFrame, host: str, limits: Limits) -> DataFrame:
    """host, n_docs, n_failed, failure_rate (shrunk), verdict: ok, strict or block.

    One aggregation with map-side partial sums, so that a host with a third of all rows is
    no burden. The prior comes from the hosts' counts by moments: one row of five numbers,
    all that the driver sees.
    """
    failed = (F.col("base_failed") | F.col("fine_failed")).cast("bigint")
    hosts = materialise(
        judged.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"), F.sum(failed).alias("n_failed")
        ),
        "hosts",
    )
    f, n = F.col("n_failed").cast("double"), F.col("n_docs").cast("double")
    a, b = beta_prior(*hosts.agg(F.count(F.lit(1)), F.sum(f), F.sum(n), F.sum(f * f / n), F.sum(n * n)).first())
    shrunk = F.round((F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b)), 9)
    return hosts.select(
        "*",
        shrunk.alias("failure_rate"),
        F.when(shrunk > limits.block_rate, "block")
        .when(shrunk > limits.strict_rate, "strict")
        .otherwise("ok")
        .alias("verdict"),
    )


#: Strength of the prior, in documents, where the hosts do not differ more than by chance, and the least one.
STRONGEST, WEAKEST = 1e6, 1e-6


def beta_prior(
    hosts: int, failed: float | None, docs: float | None, failed_by_docs: float | None, docs_squared: float | None
) -> tuple[float, float]:
    """Alpha and beta of the hosts' failure rates, by the moments of the beta-binomial distribution.

    From the number of hosts and the sums of f, n, f * f / n and n * n over them. A host's
    rate varies by the beta distribution and by the chance in n documents; the share of
    chance is taken out, so hosts of few documents do not count as spread.
    """
    if not hosts:
        return 0.5, 0.5
    mean = failed / docs
    apart = docs - docs_squared / docs - (hosts - 1)
    share = 0.0
    if 0 < mean < 1 and apart > 1e-9:
        between = (failed_by_docs - failed * failed / docs) / (mean * (1 - mean))
        share = (between - (hosts - 1)) / apart
    strength = STRONGEST if share <= 0 else min(max(1 / share - 1, WEAKEST), STRONGEST)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits(),
          keep: Sequence[str] | None = None) -> DataFrame:
    """row (the document's own columns, or those to ``keep``), measures, base_failed, fine_failed, failure_rate, kept.

    The measured rows are stored once in the shared scratch area: hosts and verdicts both
    read them, and what is slow is not done twice.
    """
    flat = docs.select(hidden(docs if keep is None else docs.select(*keep)), F.col(f"`{text}`").alias("t"), F.col(f"`{host}`").alias("host"))
    measured = measure(flat, "t").drop("t")
    judged = materialise(
        measured.withColumns({"base_failed": base_failed(limits), "fine_failed": fine_failed(limits)}), "rules"
    )
    verdicts = host_verdicts(judged, "host", limits).select(
        F.col("host").alias("_host"), "failure_rate", "verdict"
    )
    kept = ~(
        F.col("base_failed")
        | (F.col("verdict") == "block")
        | ((F.col("verdict") == "strict") & F.col("fine_failed"))
    )
    # Spark broadcasts the verdicts by their stored size, or else splits a hot host's rows
    return judged.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left").select(
        "row", "host", *MEASURES, "base_failed", "fine_failed", "failure_rate", kept.alias("kept")
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, text, host, limits).where("kept").select("row.*")
