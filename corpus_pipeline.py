"""Corpus pipeline: toxicity, line dedup, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet to the shared checkpoint folder and read back as the next one's docs.
"""

from pyspark.sql import functions as F

from usage_rollup.llm import line_dedup, ngram_join, packing, secrets, toxicity
from usage_rollup.llm.common import documents, remove_since, stored, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark, docs, sf_dir):
    """Drops documents that score 0.5 or more; the model is fitted on the labelled rows that are not held out."""
    labels = documents(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out())
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return toxicity.score_toxicity(docs.select(*COLUMNS), model).where("score < 0.5").select(*COLUMNS)


def line_dedup_stage(spark, docs, sf_dir):
    """Cuts lines that an earlier document holds, and drops documents of which nothing but white space is left then."""
    cut = line_dedup.drop_recurring_lines(docs.select(*COLUMNS))
    return _recount(cut.where(F.expr(r"n_dropped = 0 or rlike(text, '[^\\x20\\x09-\\x0D]')")))


def near_duplicate_stage(spark, docs, sf_dir):
    """Keeps the smallest doc_id of each group of near duplicates."""
    return ngram_join.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def secrets_stage(spark, docs, sf_dir):
    """Replaces secrets in the texts; documents stay."""
    docs = docs.select(*COLUMNS)
    return _recount(secrets.redact(secrets.find_secrets(docs, secrets.fit(docs))))


def packing_stage(spark, docs, sf_dir):
    """The place of every piece of every document."""
    return packing.pack_documents(docs)


def _recount(docs):
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", near_duplicate_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Fits (toxicity, secrets) and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, mark = documents(spark, sf_dir), written()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove_since(spark, mark, docs)  # a stage's output is whole: nothing it was made from is read again
    return docs
