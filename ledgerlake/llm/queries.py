"""The queries of the ten operators and of the pipeline, with SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerlake.llm import bpe, exact_dedup, html_extract, langid, line_dedup, minhash, packing, secret_scan, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        secret_scan.op1_secret_scan,
        packing.op2_packing,
        topk.op3_topk,
        bpe.op4_bpe,
        toxicity.op5_toxicity,
        minhash.op6_near_dedup,
        exact_dedup.op7_exact_dedup,
        langid.op8_language_id,
        line_dedup.op9_line_dedup,
        html_extract.op10_html_extract,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE_SQL: dict[str, str] = {
    "op3_topk": topk.SQL,
    "op6_near_dedup": minhash.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op9_line_dedup": line_dedup.SQL,
}
