"""The corpus pipeline: rules, near copies, repeated passages, benchmark leaks, tokens.

STAGES are applied in order to ``documents``; what a stage returns is written as Parquet in the shared folder and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import bpe, decontaminate, near, rules, suffix
from meridian.llm.common import discard, quoted, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that neither the base rules nor the learned decision list rejects. Null and empty texts fail
    the base rules; rows that repeat a doc_id are judged each by its text."""
    return rules.passed(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (five-word shingles, similarity 0.8 or more): the one with the smallest
    doc_id, null last; of different texts with that doc_id the one of the smallest row key; of rows that repeat both
    the one whose columns are smallest as JSON. Null, empty and blank texts are one group."""
    first = near.near_copies(docs).filter("row = first").select("row").distinct()
    one = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("one")
    others = F.to_json(F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"])).alias("others")
    rows = docs.select(near.row_key().alias("row"), one, others).join(first, "row", "left_semi")
    return rows.groupBy("row").agg(F.min_by("one", "others").alias("one")).select("one.*")


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated 100-byte strings out of the texts; a character of which only a part is left goes too. A null text
    becomes empty; no row goes. Of rows that repeat a doc_id neither is earlier than the other. n_chars, where documents
    have it, counts the new text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", *([F.struct(*[F.col(quoted(c)) for c in others]).alias("others")] if others else []))
    out = suffix.remove_repeats(rows, keep=("others",) if others else (), as_text=True)
    made = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept")}
    if "n_chars" in others:
        made["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return out.select(*[(made[c] if c in made else F.col("others")[c]).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item within its error budget; null and empty texts hold none. Rows that
    repeat are judged each for itself."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as ids, with the digest of what they decode to; one row for each row, none of its other columns. A null
    or empty text has no ids."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(docs, ranks, decoded="decoded")
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: Learned rules, hashed shingles and suffix sorting have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
