"""Hosts of web addresses typed in differing layouts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.nameforms import KINDS, LEGAL, company_tokens
from corvane.llm.survivor import present_text


def host(c: str) -> Column:
    """Host of an address or bare domain, lower-case, without www. and app.; NULL for a placeholder or a host without a dot."""
    bare = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z]+://", "")
    bare = F.regexp_replace(F.regexp_extract(bare, r"^([^/?#:\s]*)", 1), r"^(www\.|app\.)+", "")
    return F.when(present_text(c) & bare.contains("."), F.rtrim(bare, F.lit(".")))


def first_path(c: str) -> Column:
    """First path segment of an address; NULL where there is none."""
    path = F.regexp_extract(F.lower(F.trim(c)), r"^(?:[a-z]+://)?[^/?#]+/([^/?#]+)", 1)
    return F.when(present_text(c) & (path != ""), path)


def shared_hosts(df: DataFrame, c: str, name: str, least: int = 5, common: float = 0.5, alike: float = 0.34) -> DataFrame:
    """(host) of unrelated companies: ``least`` different names or more are on it, no word but legal forms and kinds of
    organisation is in ``common`` of them, and fewer than ``alike`` of them begin a word as the host's own name has it. Only the
    names on the host count, so it does not matter how many others there are."""
    seen = df.select(host(c).alias("host"), F.lower(name).alias("n")).where("host is not null and n is not null").distinct()
    sizes = seen.groupBy("host").agg(F.count("*").alias("size")).where(F.col("size") >= least)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [[t for t in dict.fromkeys(company_tokens(n)) if len(t) > 2 and t not in LEGAL and t not in KINDS] for n in batch["n"]]
            labels = ["".join(ch for ch in h.rpartition(".")[0] if ch.isalnum()) for h in batch["host"]]
            yield pd.DataFrame({"host": batch["host"], "words": words, "like": [any(w[:4] in label for w in ws) for ws, label in zip(words, labels)]})

    about = seen.join(sizes, "host", "left_semi").mapInPandas(run, "host string, words array<string>, like boolean")
    top = about.select("host", F.explode("words").alias("w")).groupBy("host", "w").agg(F.count("*").alias("k")).groupBy("host").agg(F.max("k").alias("k"))
    homes = about.groupBy("host").agg(F.count("*").alias("size"), F.count_if("like").alias("like"))
    return homes.join(top, "host", "left").where((F.coalesce("k", F.lit(0)) < common * F.col("size")) & (F.col("like") < alike * F.col("size"))).select("host")


def mark_shared(df: DataFrame, c: str, shared: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: the host in column ``c`` is one of ``shared(host)``. Rows without a host are spread over the join."""
    key = F.coalesce(c, F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*df.columns), F.lit(4096)).cast("string")))
    marks = shared.select(F.col("host").alias("__host"), F.lit(True).alias(flag))
    return df.withColumn("__key", key).join(marks, F.col("__key") == F.col("__host"), "left").drop("__key", "__host").withColumn(flag, F.coalesce(flag, F.lit(False)))
