"""Problem 8: documents mixed to the target shares of their sources."""

from __future__ import annotations

import importlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.mixture import count_tokens, mix_sources
from corvane.plans.common import table


def vocabulary() -> tuple[str, str]:
    """File and splitting pattern of a byte-level vocabulary: CORVANE_TOKENIZERS names its folder and
    CORVANE_TOKENIZER_PATTERN its pattern; what is unset comes from the package of public tokenizers that is installed."""
    folder, pattern = os.environ.get("CORVANE_TOKENIZERS"), os.environ.get("CORVANE_TOKENIZER_PATTERN")
    name = "byte_bpe_50k.tiktoken"
    if folder and pattern:
        return os.path.join(folder, name), pattern
    public = importlib.import_module("public_tokenizers")
    return (os.path.join(folder, name) if folder else public.path(name)), pattern or public.PATTERN


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    path, pattern = vocabulary()
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mix_sources(count_tokens(docs, "text", path, pattern), table(spark, folder, "mixture_targets"))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the mixture, with the epoch that takes it, from all documents."""
    return _mix(spark, folder)[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and reached share of every source that has a target."""
    return _mix(spark, folder)[1].withColumn("actual_share", F.round("actual_share", 6))


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares}
SQL: dict[str, str] = {}
