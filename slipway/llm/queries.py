"""The queries of this package, each over a whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slipway.llm import speculative_bpe
from slipway.llm.byte_bpe import round_trip
from slipway.llm.collocations import COLLOCATIONS_ORACLE, collocations
from slipway.llm.decontaminate import benchmark_passages
from slipway.llm.fill_middle import FILL_ORACLE, fill_in_middle_digests
from slipway.llm.license_scan import license_scan
from slipway.llm.quality_model import quality_scores
from slipway.llm.quality_rules import QUALITY_ORACLE, quality_rules
from slipway.llm.secret_scan import secret_scan
from slipway.llm.simhash_dedup import near_duplicates
from slipway.llm.token_counts import token_counts
from slipway.llm.url_trust import URL_ORACLE, url_verdicts
from slipway.llm.warc import WARC_ORACLE, warc_round_trip


def _of(table: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(spark.read.parquet(f"{folder}/{table}.parquet"))


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    tables = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    return benchmark_passages(*tables)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": _of("pages", warc_round_trip),
    "op2_token_counts": _of("documents", token_counts),
    "op3_byte_bpe": _of("documents", round_trip),
    "op4_secret_scan": _of("documents", secret_scan),
    "op5_quality_rules": _of("documents", quality_rules),
    "op6_license_scan": _of("documents", license_scan),
    "op7_quality_model": _of("documents", quality_scores),
    "op8_benchmark_passages": _leaks,
    "op9_url_trust": _of("pages", url_verdicts),
    "op10_near_duplicates": _of("documents", near_duplicates),
    "op11_collocations": _of("documents", collocations),
    "op12_fill_in_middle": _of("documents", fill_in_middle_digests),
    "op13_speculative_bpe": _of("documents", speculative_bpe.round_trip),
}

ORACLES = {
    "op1_warc_index": WARC_ORACLE,
    "op5_quality_rules": QUALITY_ORACLE,
    "op9_url_trust": URL_ORACLE,
    "op11_collocations": COLLOCATIONS_ORACLE,
    "op12_fill_in_middle": FILL_ORACLE,
}
