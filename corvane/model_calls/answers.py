"""What becomes of a model's answers: fields with defaults, correction from a map, review flags, caps, examples, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.model_calls.map import answered
from corvane.model_calls.prompts import FIELD


def fields(df: DataFrame, log: DataFrame, row_id: str, shape: str, defaults: dict[str, object]) -> DataFrame:
    """``df`` with the fields of its rows' answers; a default where a call has no good answer, NULL where there was no call."""
    return answered(df, log, row_id, shape, defaults)


def corrected(df: DataFrame, label: str, confidence: str, parents: dict[str, str], unknown: tuple[str, str, str]) -> DataFrame:
    """``df`` with ``parent`` from a map of classes, whatever the answer says of it. A class that the map does not have, or NULL,
    becomes the first of ``unknown``, with the other two as parent and confidence."""
    table = F.create_map(*[F.lit(x) for kv in parents.items() for x in kv])
    parent = F.try_element_at(table, F.coalesce(F.col(label), F.lit("")))
    known = parent.isNotNull()
    return df.select(
        *[F.when(known, F.col(c)).otherwise(F.lit({label: unknown[0], confidence: unknown[2]}[c])).alias(c) if c in (label, confidence) else F.col(c) for c in df.columns],
        F.coalesce(parent, F.lit(unknown[1])).alias("parent"),
    )


def needs_review(flag: Column, borderline: Column, confidence: Column) -> Column:
    """The answer's own flag; where it has none, true for a borderline case or low confidence."""
    return F.coalesce(flag, borderline | (confidence == "LOW"))


def augmented(found: DataFrame, allowed: DataFrame, by: list[str], category: str, points: str, cap: float) -> DataFrame:
    """Points of ``found`` in allowed categories, summed by ``by`` up to ``cap``."""
    kept = found.join(allowed.select(category).distinct(), category, "left_semi")
    return kept.groupBy(*by).agg(F.least(F.sum(points), F.lit(cap)).alias(points))


def examples(df: DataFrame, by: str, order: list[Column], k: int, given: Column, wanted: Column) -> DataFrame:
    """(by, examples): the first ``k`` rows of each class as JSON lines of input and output, in order."""
    from corvane.operators.rank import top_k_per_key

    line = F.to_json(F.struct(given.alias("input"), wanted.alias("output")))
    top = top_k_per_key(df.withColumn("__line", line), by, order, k)
    return top.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "__line"))), lambda x: x["__line"]).alias("examples"))


def filled(texts: dict[str, str], variables: dict[str, Column], version: Column) -> Column:
    """A prompt with its variables filled in, of the version that each row asks for; NULL for a version that is not there."""

    def one(text: str) -> Column:
        pieces = FIELD.split(text)
        return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(variables[p].cast("string"), F.lit("")) for i, p in enumerate(pieces) if p or i % 2])

    return F.coalesce(*[F.when(version == v, one(t)) for v, t in texts.items()])
