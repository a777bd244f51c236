"""The registered queries of this folder: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import (
    decontaminate,
    html_main,
    jaccard_join,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    pii,
    prefix_bpe,
    quality_rules,
    token_grammar,
    vector_codes,
    warc,
)
from lakeops.llm.frames import ship
from lakeops.llm.oracles import ORACLES  # noqa: F401
from lakeops.session import new_scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    """The public vocabulary that the token queries use; a path on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("row_of_id"),
    ).drop("row_of_id")


@query
def op2_token_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "tokens")
    token_grammar.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_grammar.read_documents(spark, path)


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join_similar(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index takes English documents, then all others, loses these and gets them back."""
    docs = table(spark, sf_dir, "documents")
    english = F.col("lang").eqNullSafe("en")
    index = line_dedup.insert(spark, line_dedup.build(docs.where(english)), docs.where(~english))
    index = line_dedup.insert(spark, line_dedup.delete(spark, index, docs.where(~english)), docs.where(~english))
    cleaned = line_dedup.clean(docs, index, keep=["doc_id"])
    return cleaned.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "warc")
    index = warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_records(index, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_main.extract(pages).select("row.page_id", "row.url", "text", "n_chars")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"), license_scan.notices(spark))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.concat_ws(",", "licenses").alias("licenses"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("row_of_id"),
    ).drop("row_of_id")


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mix.select("row.doc_id", "size", "source_size", "target", "taken")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = quality_rules.judge(docs, keep=["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = prefix_bpe.encode(table(spark, sf_dir, "documents"), tokenizer_file())
    decoded = prefix_bpe.decode(encoded, tokenizer_file())
    return decoded.select(
        "row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = vector_codes.learn(vectors)
    coded = vector_codes.with_label_errors(vector_codes.encode(vectors, books))
    return coded.select(
        "row.vec_id", "code", "error", "label_error", F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256")
    )


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = merkle.manifest(docs, altered=merkle.lowered(docs))
    folded = found.withColumns({
        "proof_sha256": merkle.proof_digest(F.col("proof")),
        "folded_root": merkle.fold(F.coalesce("altered_leaf", "leaf"), F.col("proof")),
    })
    return folded.select(
        "row.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
