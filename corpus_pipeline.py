"""From raw documents to packed training sequences, one written stage after another.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns what the next
one gets as ``docs``.  All but the last return the columns of documents.  ``run`` writes every
stage as Parquet in the shared checkpoint folder and reads it back, so a lost executor repeats one stage at
most.  The stages cut text, score it and tokenise it, which SQL can't express: ``ORACLE_SQL`` is None and
``tests/llm/`` compares ``run`` with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kitchenlens.llm.common import cut_lineage, drop_stage, table
from kitchenlens.llm.decontaminate import drop_contaminated
from kitchenlens.llm.packing import pack_documents
from kitchenlens.llm.pii import with_surrogates
from kitchenlens.llm.simhash import drop_near_copies
from kitchenlens.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go; the model learns from the labels of the documents given."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (three-word shingles, two bits)."""
    return drop_near_copies(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets in the texts give way to surrogates; n_chars follows the new text."""
    out = with_surrogates(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 4096: one row for each piece, with its token ids."""
    return pack_documents(docs, keep_ids=True)


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("decontamination", decontamination),
          ("surrogates", surrogates), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_stage(before)
        before = docs
    return docs
