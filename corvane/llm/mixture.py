"""Mixing sources to target weights.

Every document gets a key from a hash of its id. Within a source, documents are ordered by that key: first into
ranges of the key, whose token sums give a distributed prefix sum, then inside a range. A source whose budget is
larger than its tokens is repeated whole, up to its cap, and the last epoch is cut where the prefix sum reaches the
budget. Equal keys are settled by the document id. There is a range for every 50,000 documents, so no task holds a source.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.scratch import Scratch


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    """Encoding of a vocabulary file that was sent with the job."""
    import tiktoken

    with open(SparkFiles.get(path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corvane", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, text: str, path: str, pattern: str) -> DataFrame:
    """``docs`` without ``text`` and with ``n_tokens``: tokens of the whole text under the vocabulary at
    ``path`` with its splitting ``pattern``; 0 for NULL. The driver sends the file to the executors."""
    docs.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)
    kept = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "n_tokens bigint"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(name, pattern)
        for batch in batches:
            texts = [x if isinstance(x, str) else "" for x in batch[text]]
            yield batch.drop(columns=[text]).assign(n_tokens=[len(enc.encode_ordinary(x)) for x in texts])

    return docs.mapInPandas(run, schema)


def mix_sources(docs: DataFrame, targets: DataFrame, *, total_tokens: int | None = None, ranges: int | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mixture and its report from ``docs(doc_id, source, n_tokens)`` and ``targets(source, target_share,
    max_repeats)``.

    The budget of a source is its share of ``total_tokens`` (by default, all tokens of the sources that have a target).
    A source gives whole epochs, then documents in key order while the running sum stays within what is left of the
    budget; it gives no more than ``max_repeats`` epochs. So a source falls short of its budget by less than one
    document, unless its cap or its absence stops it; the report shows the share it reached. Documents without tokens,
    without a source or of a source without a target are not taken. ``targets`` holds one row a source. Returns
    (source, doc_id, epoch, n_tokens) and a report with one row for each target.
    """
    scratch = Scratch(docs.sparkSession)
    want = targets.select("source", F.col("target_share").cast("double").alias("target_share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats"))
    want = want.where(F.col("source").isNotNull())
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    have = docs.where(F.col("n_tokens") > 0).join(F.broadcast(want.select("source")) if want.count() <= 10_000 else want.select("source"), "source", "left_semi")
    have = have.select("source", "doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), key.alias("key"))
    have = scratch.keep(have)
    if ranges is None:
        ranges = max(64, have.count() // 50_000)
    #: Ranges of equal width over the key, as the key is uniform.
    have = have.withColumn("span", F.floor((F.shiftright("key", 32) + F.lit(2**31)) * F.lit(ranges) / F.lit(2**32)).cast("int"))
    spans = have.groupBy("source", "span").agg(F.sum("n_tokens").alias("span_tokens"))
    before = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = scratch.keep(spans.withColumn("base", F.coalesce(F.sum("span_tokens").over(before), F.lit(0))))
    sizes = spans.groupBy("source").agg(F.sum("span_tokens").alias("available"))
    total = total_tokens if total_tokens is not None else (sizes.agg(F.sum("available").alias("n")).first().n or 0)
    plan = want.join(sizes, "source", "left").fillna({"available": 0})
    budget = F.floor(F.col("target_share") * F.lit(float(total))).cast("long")
    plan = plan.withColumn("budget", budget).withColumn("supply", F.least("budget", F.col("available") * F.col("max_repeats")))
    plan = plan.withColumn("whole", F.when(F.col("available") > 0, F.floor(F.col("supply") / F.col("available"))).otherwise(0).cast("int"))
    plan = plan.withColumn("part", F.col("supply") - F.col("whole") * F.col("available"))
    plan = scratch.keep(plan)
    within = Window.partitionBy("source", "span").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    run = have.join(spans.select("source", "span", "base"), ["source", "span"]).withColumn("upto", F.col("base") + F.sum("n_tokens").over(within))
    run = run.join(plan.select("source", "whole", "part"), "source")
    epochs = F.col("whole") + F.when(F.col("upto") <= F.col("part"), 1).otherwise(0)
    taken = run.where(epochs > 0).select("source", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(1), epochs)).alias("epoch"))
    mix = scratch.keep(taken.select("source", "doc_id", "epoch", "n_tokens"))
    got = mix.groupBy("source").agg(F.sum("n_tokens").alias("taken"), F.max("epoch").alias("epochs"), F.count("*").alias("n_records"))
    report = plan.join(got, "source", "left").fillna({"taken": 0, "epochs": 0, "n_records": 0})
    all_taken = report.agg(F.sum("taken").alias("n")).first().n or 0
    report = report.select("source", "target_share", "max_repeats", F.col("available").alias("available_tokens"), F.col("budget").alias("budget_tokens"), F.col("taken").alias("taken_tokens"), "epochs", "n_records", F.coalesce(F.try_divide(F.col("taken").cast("double"), F.lit(float(all_taken))), F.lit(0.0)).alias("actual_share"))
    return mix, report
