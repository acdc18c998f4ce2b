"""Queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import jaccard, language, mixing, negatives, pieces, pii, quality, runs, secrets, toxicity, vectors, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_forest": vectors.op1_forest,
    "op2_jaccard": jaccard.op2_jaccard,
    "op3_pieces": pieces.op3_pieces,
    "op4_pii": pii.op4_pii,
    "op5_mixing": mixing.op5_mixing,
    "op6_products": vectors.op6_products,
    "op7_quality": quality.op7_quality,
    "op8_secrets": secrets.op8_secrets,
    "op9_warc": warc.op9_warc,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_runs": runs.op11_runs,
    "op12_negatives": negatives.op12_negatives,
    "op13_language": language.op13_language,
}

ORACLES: dict[str, str] = {"op5_mixing": mixing.OP5_SQL, "op6_products": vectors.OP6_SQL, "op9_warc": warc.OP9_SQL, "op12_negatives": negatives.OP12_SQL}
