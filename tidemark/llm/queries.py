"""Registered queries of the operators of this package."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (ann, decontaminate, fixity, licenses, neardup, packing, periodic, pii, search, secrets,
                          suffix_dedup, tokens, toxicity)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _replica(pages):
    """A second replica with planted damage, so that the audit has work."""
    return pages.where("page_id % 101 <> 7").withColumn(
        "html", F.when(F.col("page_id") % 97 == 5, F.concat("html", F.lit("\0"))).otherwise(F.col("html")))


def _fixity(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    files = fixity.file_count(pages)
    return fixity.audit(fixity.records(pages, files), fixity.records(_replica(pages), files))


QUERIES = {
    "op1_toxicity": lambda s, d: toxicity.score(_table(s, d, "documents"), _table(s, d, "labels")),
    "op2_pii": lambda s, d: pii.scan(_table(s, d, "documents")),
    "op3_secrets": lambda s, d: secrets.scan(_table(s, d, "documents")),
    "op4_ann": lambda s, d: ann.search(_table(s, d, "embeddings"), 100),
    "op5_suffix_dedup": lambda s, d: suffix_dedup.dedup(_table(s, d, "documents")),
    "op6_packing": lambda s, d: packing.pack(_table(s, d, "documents")),
    "op7_decontaminate": lambda s, d: decontaminate.contamination(
        _table(s, d, "documents"), _table(s, d, "benchmark")),
    "op8_fixity": _fixity,
    "op9_neardup": lambda s, d: neardup.groups(_table(s, d, "documents"), 3, 85, 100),
    "op10_licenses": lambda s, d: licenses.scan(_table(s, d, "documents")),
    "op11_token_counts": lambda s, d: tokens.count_tokens(
        _table(s, d, "documents"), public_tokenizers.path("byte_bpe_50k.json")),
    "op12_lexical_search": lambda s, d: search.rank_items(_table(s, d, "documents"), _table(s, d, "benchmark")),
    "op13_periodic_runs": lambda s, d: periodic.scan(_table(s, d, "documents"), periodic.spliced),
}
ORACLES: dict[str, str] = {"op12_lexical_search": search.ORACLE}
