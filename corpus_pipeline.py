"""Corpus preparation in stages: quality, near duplicates, secrets, mixture, tokens.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet, and the next stage reads that. All but the
last return the columns of ``docs``. NULL texts count as empty and pass like them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm.common import ship, stored, table
from plantlake.llm.mixing import mixed_rows
from plantlake.llm.ngram_join import similar_texts
from plantlake.llm.quality import fit_rules, labelled, text_statistics
from plantlake.llm.secrets import redacted, train, with_secrets
from plantlake.llm.sentencepiece import encode_texts
from plantlake.session import configure

QUALITY_BOUND = 0.7
#: Names that no column of the documents has.
ROW, MARK = "__packed_row", "__text_mark"


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one, so that an operator's own columns can't meet them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.7 stay; without labels of both kinds to learn from, all do.

    The statistics of the labelled documents alone are written for training. Scoring measures a text on its way
    from the input to the output, so that no text is shuffled or written twice. Rows travel packed, so columns may have any names.
    """
    ship(configure(spark))
    labels = table(spark, sf_dir, "labels")
    measured = stored(text_statistics(docs), "pipeline-quality")
    model = fit_rules(labelled(measured, labels, "quality", "doc_id", 4, 2))
    if not model.rules:
        return docs
    rows = docs.select(packed(docs), "text")
    return text_statistics(rows, keep=[ROW]).filter(model.score() >= QUALITY_BOUND).select(f"{ROW}.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 the one with the smallest id stays.

    Of rows that agree in id and text one stays. Documents without words stay, and so do rows without ids.
    """
    ship(configure(spark))
    groups = similar_texts(docs).withColumnsRenamed({"id": "doc_id", "text_hash": MARK})
    gone = stored(groups.filter("doc_id <> component_id").select("doc_id", MARK).distinct(), "pipeline-copies")
    same = groups.filter("doc_id = component_id and n_links > 0").groupBy("doc_id", MARK).count().filter("count > 1")
    same = stored(same.select("doc_id", MARK), "pipeline-repeated")
    # One join form at every size: what goes grows with the input, so it is not broadcast.
    kept = docs.withColumn(MARK, F.xxhash64("text")).join(gone.hint("merge"), ["doc_id", MARK], "left_anti")
    if not same.isEmpty():
        once = kept.join(same.hint("merge"), ["doc_id", MARK], "left_semi").dropDuplicates(["doc_id", MARK])
        kept = kept.join(same.hint("merge"), ["doc_id", MARK], "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text become a mark, and n_chars follows."""
    configure(spark)
    found = with_secrets(docs.select(packed(docs), "text"), train(docs))
    # The text is built once; evaluated twice in one projection, its second copy would lose the end of the text.
    found, row = found.withColumn("redacted", redacted("text", "spans")), F.col(ROW)
    n_chars = F.when(F.size("spans") > 0, F.length("redacted").cast("long")).otherwise(row["n_chars"])
    changed = {"text": F.col("redacted"), "n_chars": n_chars}
    return found.select(*[changed.get(c, row[c]).alias(c) for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows appear as often as the mixture takes them, so that sources come near their targets."""
    configure(spark)
    return mixed_rows(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and whether decoding gives the text again."""
    ship(configure(spark))
    return encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: SQL can express neither the learnt model nor the draws of the mixture; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
