"""Rules and scores as data: first match wins, additive signals with a trace, capped sums and products."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Rule:
    """A rule with its reason; ``when`` may be NULL, which is false."""

    rule_id: str
    when: Column
    reason: Column


def first_match(rules: list[Rule]) -> Column:
    """struct(matched, rule_id, reason) of the first rule that holds; not matched gives NULLs."""
    hits = [F.when(r.when, F.struct(F.lit(True).alias("matched"), F.lit(r.rule_id).alias("rule_id"), r.reason.alias("reason"))) for r in rules]
    none = F.struct(F.lit(False).alias("matched"), F.lit(None).cast("string").alias("rule_id"), F.lit(None).cast("string").alias("reason"))
    return F.coalesce(*hits, none)


@dataclass
class Signal:
    """A signal with weight, category and evidence; it has weight 0 and a flag where ``discount`` holds."""

    signal_id: str
    when: Column
    weight: float
    category: str
    evidence: Column
    discount: Column | None = None
    flag: str | None = None


def fired(signals: list[Signal]) -> Column:
    """Array of the signals that fired, in their order."""
    out = []
    for s in signals:
        off = F.coalesce(s.discount, F.lit(False)) if s.discount is not None else F.lit(False)
        out.append(
            F.when(
                s.when,
                F.struct(
                    F.lit(s.signal_id).alias("signal_id"), F.when(off, F.lit(0.0)).otherwise(F.lit(float(s.weight))).alias("weight"),
                    F.lit(s.category).alias("category"), s.evidence.cast("string").alias("evidence"), F.when(off, F.lit(s.flag)).alias("flag"),
                ),
            )
        )
    return F.array_compact(F.array(*out))


def total(signals: Column) -> Column:
    return F.aggregate(signals, F.lit(0.0), lambda a, s: a + s["weight"])


def counted(signals: Column, category: str) -> Column:
    """Contributing signals of a category."""
    return F.size(F.filter(signals, lambda s: (s["category"] == category) & (s["weight"] > 0)))


def only(signals: Column, category: str) -> Column:
    """True if something contributes and all of it is of the category."""
    live = F.filter(signals, lambda s: s["weight"] > 0)
    return (F.size(live) > 0) & F.forall(live, lambda s: s["category"] == category)


def flagged(signals: Column) -> Column:
    return F.exists(signals, lambda s: s["flag"].isNotNull())


def capped_sum(points: Column, cap: float) -> Column:
    return F.aggregate(points, F.lit(0.0), lambda a, p: a + F.least(p, F.lit(cap)))


def capped_product(factors: Column, cap: float) -> Column:
    """Product of factors up to a cap; 1 for none."""
    return F.least(F.aggregate(factors, F.lit(1.0), lambda a, f: a * f), F.lit(cap))


def band(score: Column, bands: list[tuple[float, str]], below: str) -> Column:
    """Name of the first band (from high to low) that the score reaches."""
    out = F.lit(below)
    for least, name in reversed(bands):
        out = F.when(score >= least, F.lit(name)).otherwise(out)
    return out


def trace(signals: Column) -> Column:
    """'id=weight; ...' of the signals."""
    return F.array_join(F.transform(signals, lambda s: F.concat(s["signal_id"], F.lit("="), s["weight"].cast("string"))), "; ")
