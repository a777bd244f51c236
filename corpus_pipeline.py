"""Documents to training tokens in five stages.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents. What a stage has stored
on the way goes when the next one begins, unless that one still reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import decontaminate, jaccard_join, mixing, quality_rules, token_grammar
from lakeops.llm.frames import scratch_folder, ship
from lakeops.llm.queries import table, tokenizer_file
from lakeops.session import materialise, new_scratch, remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards on disk; one row per stored document, read back from them."""
    path = new_scratch(spark, "tokens")
    token_grammar.write_tokens(docs, path, tokenizer_file())
    return token_grammar.read_documents(spark, path)


#: Folders of stages that have returned.
_passed: list[str] = []


def _staged(name: str, stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        still_read = docs.inputFiles() if _passed else []
        for folder in [*_passed]:
            place = folder.split("://")[-1].removeprefix("file:")
            if not any(place in f for f in still_read):
                remove(spark, folder)
                _passed.remove(folder)
        with scratch_folder(spark, name) as folder:
            out = stage(ship(spark), docs, sf_dir)
        _passed.append(folder)
        return out

    return name, run_stage


STAGES = [
    _staged("quality_rules", quality),
    _staged("ngram_jaccard_join", near_duplicates),
    _staged("decontamination", decontamination),
    _staged("source_mix", mixture),
    _staged("token_grammar", tokens),
]

#: No SQL form: the last stage encodes with a tokenizer. Tests compare it with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
