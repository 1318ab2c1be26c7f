"""Queries and SQL of the subpackage, as ``__spark_entry__`` adds them."""

from __future__ import annotations

from . import centroids, chat, importance, line_dedup, minhash, neighbours, ngram_join, packing, quality, secrets, segmentation, toxicity, warc


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {
        "op1_line_dedup": line_dedup.op1_query,
        "op2_neighbours": neighbours.op2_query,
        "op3_secrets": secrets.op3_query,
        "op4_chat": chat.op4_query,
        "op5_quality": quality.op5_query,
        "op6_segmentation": segmentation.op6_query,
        "op7_packing": packing.op7_query,
        "op8_toxicity": toxicity.op8_query,
        "op9_warc": warc.op9_query,
        "op10_ngram_join": ngram_join.op10_query,
        "op11_minhash": minhash.op11_query,
        "op12_centroids": centroids.op12_query,
        "op13_importance": importance.op13_query,
        "pipeline": _pipeline,
    }


def oracle_sql():
    return {
        "op1_line_dedup": line_dedup.OP1_SQL,
        "op4_chat": chat.OP4_SQL,
        "op10_ngram_join": ngram_join.OP10_SQL,
        "op11_minhash": minhash.OP11_SQL,
        "op12_centroids": centroids.OP12_SQL,
        "op13_importance": importance.OP13_SQL,
    }
