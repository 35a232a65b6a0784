"""The operators of this package as queries over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm.common import remainder, ship, stored, table
from plantlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(configure(spark)), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_secret_scan(spark, sf_dir):
    from plantlake.llm.secrets import rendered, train, with_secrets

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_secrets(docs, train(docs))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(rendered("base"), 256).alias("base_sha256"),
        rendered("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_random"),
    )


@query
def op2_fingerprints(spark, sf_dir):
    from plantlake.llm.fingerprints import compare_with_edits

    return compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark, sf_dir):
    from plantlake.llm.quality import agreed_labels
    from plantlake.llm.toxicity import fit_toxicity, score_texts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = agreed_labels(table(spark, sf_dir, "labels"), "toxic").filter(remainder("doc_id", 3) != 1)
    model = fit_toxicity(docs, known)
    return score_texts(docs, model).select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "matched_clauses",
    )


@query
def op4_sentencepiece(spark, sf_dir):
    from plantlake.llm.sentencepiece import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_ngram_join(spark, sf_dir):
    from plantlake.llm.ngram_join import similar_texts

    return similar_texts(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_links", "component_id"
    )


@query
def op6_token_counts(spark, sf_dir):
    from plantlake.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_quality(spark, sf_dir):
    from plantlake.llm.quality import fit_rules, labelled, text_statistics

    measured = stored(text_statistics(table(spark, sf_dir, "documents")), "quality-statistics")
    model = fit_rules(labelled(measured, table(spark, sf_dir, "labels"), "quality", "doc_id", 4, 2))
    return measured.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op8_mixing(spark, sf_dir):
    from plantlake.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op9_repeated_passages(spark, sf_dir):
    from plantlake.llm.repeats import without_repeats

    return without_repeats(table(spark, sf_dir, "documents"))


@query
def op10_embedding_near_duplicates(spark, sf_dir):
    from plantlake.llm.embeddings import similar_vectors

    found = similar_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )


@query
def op11_warc(spark, sf_dir):
    from plantlake.llm.warc import archived_pages

    return archived_pages(table(spark, sf_dir, "pages"))


@query
def op12_hard_negatives(spark, sf_dir):
    """Where 7 divides the id, the label counts as the next one, modulo 10; every hundredth row is an anchor."""
    from plantlake.llm.negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


@query
def op13_merkle_manifest(spark, sf_dir):
    """Where 7 divides crc32 of the id, the present row has one more in n_chars."""
    from plantlake.llm.manifest import leaf_digest, verified_rows

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = leaf_digest([F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in docs.columns])
    return verified_rows(docs, docs.columns, "doc_id", "lang", F.when(remainder("doc_id", 7) == 0, tampered))
