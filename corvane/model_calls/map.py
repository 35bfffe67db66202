"""Mapping a model over a table."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.model_calls.prompts import render
from corvane.model_calls.provider import Provider, Retryable, parse_answer, with_retries
from corvane.operators.rank import within_budget
from corvane.shipping import ship


def call_model(df: DataFrame, row_id: str, variables: list[str], prompt: str, provider: Provider, *, budget: int = 0, max_tokens: int = 400, order: list[Column] | None = None, least_text: int = 0, parallel: int = 0, dry_run: bool = False) -> DataFrame:
    """(row_id, status, answer, n_in, n_out): one call a row.

    Status is 'ok', 'unparsed' (the answer is no JSON), 'failed' (retries used up), 'short' (less than ``least_text``
    characters of variables), 'over_budget' or 'dry_run'. Rows that are not called keep a NULL answer, so a later run can
    take them. ``parallel`` bounds the number of tasks that call at once.
    """
    ship(df.sparkSession)
    text = F.concat_ws(" ", *[F.trim(F.col(v).cast("string")) for v in variables])
    rows = within_budget(df.select(row_id, *variables, text.alias("__t")), order or [F.col(row_id)], budget)
    rows = rows.repartition(parallel) if parallel else rows
    kind = df.schema[row_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                if len((r["__t"] or "").strip()) < least_text:
                    out.append((r[row_id], "short", None, 0, 0))
                    continue
                if not r["allowed"]:
                    out.append((r[row_id], "over_budget", None, 0, 0))
                    continue
                system, user = render(prompt, {v: "" if r[v] is None else r[v] for v in variables})
                if dry_run:
                    out.append((r[row_id], "dry_run", None, (len(system) + len(user)) // 4, max_tokens // 3))
                    continue
                try:
                    a = with_retries(lambda: provider.ask(system, user, max_tokens))  # noqa: B023
                except Retryable:
                    out.append((r[row_id], "failed", None, 0, 0))
                    continue
                parsed = parse_answer(a.text)
                out.append((r[row_id], "ok" if parsed is not None else "unparsed", json.dumps(parsed, sort_keys=True) if parsed is not None else None, a.n_in, a.n_out))
            yield pd.DataFrame(out, columns=[row_id, "status", "answer", "n_in", "n_out"])

    return rows.mapInPandas(run, f"{row_id} {kind}, status string, answer string, n_in int, n_out int")


def costs(log: DataFrame, price_in: float, price_out: float) -> DataFrame:
    """Calls, tokens and cost of a call log, by status."""
    return log.groupBy("status").agg(F.count("*").alias("calls"), F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"), (F.sum(F.col("n_in") * price_in + F.col("n_out") * price_out) / 1_000_000).alias("cost"))


def answered(df: DataFrame, log: DataFrame, row_id: str, shape: str, defaults: dict[str, object]) -> DataFrame:
    """``df`` with the fields of the answers; ``defaults`` where a row was called but its answer is no good, NULL where it was
    not called."""
    parsed = log.select(row_id, "status", F.from_json("answer", shape).alias("__a"))
    called = F.col("status").isin("ok", "unparsed", "failed")
    cols = [F.when(called, F.coalesce(F.col(f"__a.{k}"), F.lit(v))).alias(k) for k, v in defaults.items()]
    return df.join(parsed, row_id, "left").select(*[F.col(c) for c in df.columns], *cols)


def add_known(found: Column, known: Column, name: str) -> Column:
    """Known structs that are not among the found (by name, case ignored), in reverse, before the found."""
    names = F.transform(found, lambda x: F.lower(x[name]))
    return F.concat(F.reverse(F.filter(known, lambda k: ~F.array_contains(names, F.lower(k[name])))), found)
