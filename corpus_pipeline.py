"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the columns of documents (the
last one: pieces). run() writes each result to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlog.llm.common import WORD, materialize, read
from cinderlog.llm.line_dedup import dedup_lines
from cinderlog.llm.mixing import mix
from cinderlog.llm.ngram_join import BROADCAST_IDS, jaccard_components, text_hash
from cinderlog.llm.packing import pack
from cinderlog.llm.quality import CUT, classify, train


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go, those without any word among them (they score 0). Where labels do not suffice to fit it, it
    says nothing of any document: all stay. Rows are judged one by one, also where they share an id or have none; all columns pass."""
    labels = read(spark, sf_dir, "labels")
    model = train(docs, labels)
    if not model.fitted:
        return docs
    scored = classify(docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), docs["text"]), labels, fitted=model)
    return scored.where(F.col("q_score") >= CUT).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat across documents stay in the first one. A document that lost a line and has no word left goes: all it said stands in
    others, so that of exact copies one stays. Texts that never had a word stay, null ones as empty ones. n_chars follows the text; other columns pass."""
    out = dedup_lines(docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), "doc_id", "text"))
    out = out.where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram similarity connects, the one of smallest id stays. Rows are judged one by one: of rows that share an id only
    those go that such a document stands for. Rows without id go if one with an id stands for them; empty texts stay."""
    found = jaccard_components(docs).where("component_id is not null and not doc_id <=> component_id").select("doc_id", F.col("text_hash").alias("h")).distinct()
    found = materialize(found, "losers")
    lost = (F.broadcast(found) if found.count() <= BROADCAST_IDS else found).alias("lost")
    return docs.alias("own").join(lost, F.col("own.doc_id").eqNullSafe(F.col("lost.doc_id")) & (text_hash("own.text") == F.col("lost.h")), "left_anti").select(*(docs[f"`{c}`"] for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; documents repeat, or drop out, as the mix says. A null source is one of its own; all columns pass."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, each a sequence, with their ids. A text without words is a piece of the end id alone."""
    return pack(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("ngram_join", ngram_join), ("mixing", mixing), ("packing", packing)]

#: The classifier can't be expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
