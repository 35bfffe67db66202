"""Column-level data quality profile of the loads of a table.

Every profiled column is turned into (load, column, value) and counted in one aggregation, and from the counts come null
rates, distinct counts, ranges, exact medians and the column's expressions.

Expressions are induced by minimum description length over all distinct values. A value can be described by
one of four generalisations: exact character classes (``[0-9]{4}-[0-9]{2}``), class runs (``[0-9]+-[0-9]+``),
hexadecimal digits with exact lengths, alphanumeric runs with exact lengths; or by nothing but its own text.
The description length of an expression is its own length plus, for each distinct value it describes, the bits
that select the value among those the expression admits. Each value goes to the candidate whose group saves the
most bits against the plain text; an expression is kept when two or more values that chose it still save bits. The two-digit
fields of a kept expression are then narrowed to the token (month, day, hour, minute or any) that describes the field in
the fewest bits, values outside it being paid as plain text. A column with a standard expression (one that many rows
have) has a pattern, and its values under no standard expression do not conform. All of it is grouping and joining: no
group is held in one task, and nothing but the names of the columns with a pattern leaves the cluster.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.scratch import Scratch

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits of one character of plain text, of each class, and of the length of a run.
TEXT_BITS, RUN_BITS, CHAR_BITS = 6.6, 4.0, 8.0
#: Stands for a hexadecimal digit in an expression, as letters beyond f stand for themselves there.
HEX = "\x01"
CLASSES = {"c": {"a": "[a-z]", "A": "[A-Z]", "9": "[0-9]"}, "h": {HEX: "[0-9a-f]"}, "w": {"w": "[A-Za-z0-9]"}}


#: Tokens of two-digit fields: what stands for one in an expression, its range and its regular expression.
FIELDS = (
    ("\x02", 1, 12, "(?:0[1-9]|1[0-2])"), ("\x04", 0, 23, "(?:[01][0-9]|2[0-3])"), ("\x03", 1, 31, "(?:0[1-9]|[12][0-9]|3[01])"),
    ("\x05", 0, 59, "[0-5][0-9]"), ("99", 0, 99, "[0-9]{2}"),
)
FIELD = "(?<![0-9])[0-9]{2}(?![0-9])"


@dataclass
class TableSpec:
    """What to profile: the load and row-id columns and the columns. ``checks`` are true for a non-null value outside what a
    column can hold, for columns without a pattern. ``confirm`` is true for a non-null value that does not conform to the
    column's expressions and cannot be right, ``meaning`` for one that conforms and cannot be right all the same.
    ``numeric`` columns get ranges and medians, ``patterned`` ones expressions. An expression that at least ``standard``
    of a column's values have is a standard one."""

    name: str
    load: str
    row_id: str
    columns: list[str]
    checks: dict[str, Column] = field(default_factory=dict)
    numeric: list[str] = field(default_factory=list)
    patterned: list[str] = field(default_factory=list)
    standard: float = 0.02
    confirm: dict[str, Column] = field(default_factory=dict)
    meaning: dict[str, Column] = field(default_factory=dict)


def _exact(v: Column) -> Column:
    return F.translate(v, LOWER + UPPER + "0123456789", "a" * 26 + "A" * 26 + "9" * 10)


KINDS = ("c", "r", "h", "w")


def _shapes(values: DataFrame) -> DataFrame:
    """``values`` with the four generalisations of ``value`` (c, r, h, w), each worked out once."""
    v = F.col("value")
    hexa = F.concat(F.lit("h:"), F.translate(v, "abcdef0123456789", HEX * 16))
    out = values.withColumn("c", F.concat(F.lit("c:"), _exact(v))).withColumn("h", hexa)
    return out.withColumn("r", F.concat(F.lit("r:"), F.regexp_replace(F.substring("c", 3, 2**30), r"([aA9])\1*", "$1+"))).withColumn("w", F.concat(F.lit("w:"), F.translate(F.substring("c", 3, 2**30), "aA9", "www")))


def _costs(shapes: DataFrame) -> DataFrame:
    """(column_name, value, t), ``t`` holding for each generalisation its number, hash, own bits and the bits it saves."""
    n = F.length("value")
    less = lambda text, letters: F.length(text) - F.length(F.translate(text, letters, ""))
    shapes = shapes.withColumn("n9", less(F.col("c"), "9")).withColumn("na", less(F.col("c"), "aA")).withColumn("nx", less(F.col("h"), HEX))
    shapes = shapes.withColumn("letters", F.col("na") * F.lit(4.7) + F.col("n9") * F.lit(3.32)).withColumn("n_runs", less(F.col("r"), "+")).withColumn("plain", n * F.lit(TEXT_BITS))
    bits = {
        "c": F.col("letters"),
        "r": F.col("letters") + F.col("n_runs") * RUN_BITS,
        "h": F.col("nx") * F.lit(4.0) + F.when(F.translate("value", "abcdef0123456789-", "") == "", F.lit(0.0)).otherwise((n - F.col("nx")) * F.lit(TEXT_BITS)),
        "w": (F.col("na") + F.col("n9")) * F.lit(5.95),
    }
    each = [F.struct(F.lit(i).alias("kind"), F.xxhash64(k).alias("hash"), ((F.length(k) - 2) * CHAR_BITS).alias("own"), (F.col("plain") - bits[k]).alias("saved")) for i, k in enumerate(KINDS)]
    return shapes.select("column_name", "value", F.array(*each).alias("t"))


def induce_expressions(values: DataFrame) -> DataFrame:
    """(column_name, value) of distinct non-null texts to (column_name, value, expression); NULL where the value
    conforms to no kept expression."""
    scratch = Scratch(values.sparkSession)
    costs = scratch.keep(_costs(_shapes(values.select("column_name", "value"))))
    spread = costs.select("column_name", "value", F.explode("t").alias("t")).select("column_name", "value", "t.*")
    group = spread.groupBy("column_name", "kind", "hash").agg((F.sum("saved") - F.max("own")).alias("gain"), F.count("*").alias("n"), F.min("value").alias("value"))
    named = _shapes(group.where((F.col("n") > 1) & (F.col("gain") > 0)))
    named = scratch.keep(named.select("column_name", "kind", "hash", "gain", F.coalesce(*[F.when(F.col("kind") == i, F.col(k)) for i, k in enumerate(KINDS)]).alias("expr")))
    best = (
        spread.join(named, ["column_name", "kind", "hash"])
        .groupBy("column_name", "value")
        .agg(F.max(F.struct("gain", "expr", "saved", "own")).alias("b"))
        .select("column_name", "value", "b.expr", "b.saved", "b.own")
    )
    best = scratch.keep(best)
    kept = best.groupBy("column_name", "expr").agg((F.sum("saved") - F.max("own")).alias("gain"), F.count("*").alias("values"))
    kept = kept.where((F.col("gain") > 0) & (F.col("values") > 1)).select("column_name", "expr")
    fields = F.when(F.col("expr").startswith("c:"), F.regexp_extract_all("value", F.lit(FIELD), F.lit(0))).otherwise(F.array().cast("array<string>"))
    described = scratch.keep(best.join(kept, ["column_name", "expr"]).select("column_name", "value", "expr", F.transform(fields, lambda x: x.cast("int")).alias("f")))
    narrow = scratch.keep(_narrowed(described))
    found = described.join(narrow, ["column_name", "expr"], "left")
    inside = F.forall(F.arrays_zip("f", "ranges"), lambda x: x["f"].between(x["ranges"]["lo"], x["ranges"]["hi"]))
    found = found.where(F.col("ranges").isNull() | inside).select("column_name", "value", F.coalesce("narrowed", "expr").alias("expression"))
    return values.select("column_name", "value").join(found, ["column_name", "value"], "left")


def _narrowed(described: DataFrame) -> DataFrame:
    """(column_name, expr, narrowed, ranges) of expressions with two-digit fields: each field under the token that describes
    it in the fewest bits. Fields of an expression are bounded by its own length."""
    each = described.select("column_name", "expr", F.posexplode("f").alias("at", "v"))
    counts = each.groupBy("column_name", "expr", "at").agg(F.count("*").alias("n"), *[F.count_if(F.col("v").between(lo, hi)).alias(f"n{i}") for i, (_, lo, hi, _) in enumerate(FIELDS)])
    price = lambda i, size: F.col(f"n{i}") * F.lit(math.log2(size)) + (F.col("n") - F.col(f"n{i}")) * (F.length("expr") - 2) * TEXT_BITS
    tokens = F.array(*[F.struct(price(i, hi - lo + 1).alias("bits"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(t).alias("token")) for i, (t, lo, hi, _) in enumerate(FIELDS)])
    chosen = counts.select("column_name", "expr", F.struct("at", F.array_min(tokens).alias("t")).alias("s"))
    ranges = chosen.groupBy("column_name", "expr").agg(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["t"]).alias("ranges"))
    parts = F.split("expr", "(?<!9)99(?!9)")
    text = F.array_join(F.zip_with(parts, "ranges", lambda p, r: F.concat(p, F.coalesce(r["token"], F.lit("")))), "")
    return ranges.select("column_name", "expr", text.alias("narrowed"), "ranges")


def regex_of(expression: str) -> str:
    """The regular expression that an induced expression stands for."""
    kind, body = expression[0], expression[2:]
    if kind == "r":
        return "^" + "".join(CLASSES["c"][m[0]] + "+" if len(m) == 2 else re.escape(m) for m in re.findall(r"[aA9]\+|.", body, re.S)) + "$"
    tokens = {t: pattern for t, _, _, pattern in FIELDS}
    out = []
    for m in re.finditer(r"(.)\1*", body, re.S):
        unit, n = CLASSES[kind].get(m.group(1)), len(m.group())
        if kind == "c" and m.group(1) in tokens:
            out.append(tokens[m.group(1)] * n)
        else:
            out.append(re.escape(m.group()) if unit is None else unit + (f"{{{n}}}" if n > 1 else ""))
    return "^" + "".join(out) + "$"


class Profile:
    """The profile of one table. ``cells``: one row for each value that a check of its column refuses, or that does not conform
    to the column's standard expressions. ``aggregates``: one row for each column and load; ``loads`` has the coverage of the
    expressions besides. An empty table has no rows in any; rows with a NULL load appear in ``cells`` only; extra
    columns are not read. A column without a standard expression has no pattern, and no value that does not conform."""

    def __init__(self, df: DataFrame, spec: TableSpec):
        self.spec, self.df = spec, df
        self.scratch = Scratch(df.sparkSession)
        bad = lambda c: F.coalesce(spec.checks[c], F.lit(False)) if c in spec.checks else F.lit(False)
        entries = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).cast("string").alias("value"),
                (F.col(c).cast("double") if c in spec.numeric else F.lit(None).cast("double")).alias("num"),
                (bad(c) & F.col(c).isNotNull()).alias("bad"),
            )
            for c in spec.columns
        ]
        long = df.select(F.col(spec.load).alias("load_no"), F.explode(F.array(*entries)).alias("e")).select("load_no", "e.*")
        #: The only pass over all cells; a NULL load is kept for the expressions, which are over all values.
        counted = self.scratch.keep(long.groupBy("column_name", "load_no", "value").agg(F.count("*").alias("n"), F.count_if(~F.col("bad")).alias("good"), F.max("num").alias("num")))
        self.counted = counted.where("load_no is not null")
        texts = counted.where(F.col("value").isNotNull() & F.col("column_name").isin(spec.patterned))
        induced = self.scratch.keep(induce_expressions(texts.select("column_name", "value").distinct()))
        used = texts.join(induced, ["column_name", "value"]).groupBy("column_name", "expression").agg(F.sum("n").alias("k"))
        every = used.groupBy("column_name").agg(F.sum("k").alias("all_k"))
        standard = used.where("expression is not null").join(every, "column_name").where(F.col("k") >= spec.standard * F.col("all_k"))
        standard = self.scratch.keep(standard.select("column_name", "expression", F.lit(True).alias("standard")))
        self.expressions = self.scratch.keep(induced.join(standard, ["column_name", "expression"], "left").select("column_name", "value", "expression", F.coalesce("standard", F.lit(False)).alias("standard")))
        #: One name a column of the table: the columns that have a pattern.
        self.with_pattern = sorted(r.column_name for r in standard.select("column_name").distinct().collect())
        self.aggregates = self._aggregates()

    @property
    def nonconforming(self) -> DataFrame:
        """(column_name, value) of the distinct values that conform to no standard expression of a column with a pattern."""
        return self.expressions.where(~F.col("standard") & F.col("column_name").isin(self.with_pattern)).select("column_name", "value")

    @property
    def cells(self) -> DataFrame:
        """(table_name, column_name, case_id, load_no, value, reason) of the offending cells. The reason is ``range`` where a
        check refuses the value, ``pattern`` where it does not conform and, if the column has a ``confirm``, that
        confirms it, ``meaning`` where the column's ``meaning`` refuses what is left."""
        spec = self.spec
        at = [F.col(spec.row_id).alias("case_id"), F.col(spec.load).alias("load_no")]
        entry = lambda c, *more: F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), *more)
        out = [F.lit(spec.name).alias("table_name"), "column_name", "case_id", "load_no", "value", "reason"]
        ranged = [F.when(F.coalesce(spec.checks[c], F.lit(False)) & F.col(c).isNotNull(), entry(c)) for c in spec.checks]
        patterned = [entry(c, F.coalesce(spec.confirm.get(c, F.lit(True)), F.lit(False)).alias("wrong"), F.coalesce(spec.meaning.get(c, F.lit(False)), F.lit(False)).alias("senseless")) for c in self.with_pattern]
        found = self.df.select(*at, F.explode(F.array_compact(F.array(*ranged))).alias("e")).select("case_id", "load_no", "e.*", F.lit("range").alias("reason")).select(*out) if ranged else None
        if patterned:
            rows = self.df.select(*at, F.explode(F.array(*patterned)).alias("e")).select("case_id", "load_no", "e.*").where("value is not null")
            odd = self.scratch.keep(self.nonconforming.withColumn("odd", F.lit(True)))
            reason = F.when(F.col("odd") & F.col("wrong"), "pattern").when(F.col("senseless"), "meaning")
            judged = rows.join(odd, ["column_name", "value"], "left").withColumn("reason", reason).where("reason is not null").select(*out)
            found = judged if found is None else found.unionByName(judged)
        if found is None:
            found = self.df.select(*at, F.lit("").alias("column_name"), F.lit("").alias("value"), F.lit("").alias("reason")).where(F.lit(False)).select(*out)
        return found

    def _aggregates(self) -> DataFrame:
        base = self.counted.groupBy("column_name", "load_no").agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
            F.count("value").alias("n_distinct"),
            F.min(F.when(F.col("good") > 0, F.col("num"))).alias("low"),
            F.max(F.when(F.col("good") > 0, F.col("num"))).alias("high"),
        )
        out = base.join(exact_medians(self.counted), ["column_name", "load_no"], "left")
        return self.scratch.keep(
            out.select(
                F.lit(self.spec.name).alias("table_name"), "column_name", "load_no", "n_rows",
                (F.col("n_null") / F.col("n_rows")).alias("null_rate"), "n_distinct", "low", "high", "median",
            )
        )

    @cached_property
    def coverage(self) -> DataFrame:
        """(table_name, column_name, load_no, expression, n, loose): rows of each load under each expression."""
        covered = self.counted.where(F.col("value").isNotNull()).join(self.expressions, ["column_name", "value"])
        covered = covered.groupBy("column_name", "load_no", "expression").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("standard"), 0).otherwise(F.col("n"))).alias("loose"))
        return self.scratch.keep(covered.select(F.lit(self.spec.name).alias("table_name"), "column_name", "load_no", "expression", "n", "loose"))

    @cached_property
    def loads(self) -> DataFrame:
        """``aggregates`` with the rows that do not conform and the shift of the expressions' coverage against all loads."""
        coverage = self.coverage
        total = coverage.groupBy("column_name", "load_no").agg(F.sum("n").alias("n_text"), F.sum("loose").alias("n_nonconforming"))
        whole = coverage.groupBy(F.col("column_name").alias("c2"), F.col("expression").alias("e2")).agg(F.sum("n").alias("all_n"))
        sizes = coverage.groupBy("column_name").agg(F.sum("n").alias("all_text"))
        shares = (
            coverage.join(total.select("column_name", "load_no", "n_text"), ["column_name", "load_no"])
            .join(whole, (F.col("column_name") == F.col("c2")) & F.col("expression").eqNullSafe(F.col("e2")))
            .join(sizes, "column_name")
        )
        #: Half the summed difference of coverage would also count expressions absent from the load; what is missing
        #: there is what is too much here, so the positive part alone gives the same distance.
        drift = shares.groupBy("column_name", "load_no").agg(
            F.sum(F.greatest(F.lit(0.0), F.col("n") / F.col("n_text") - F.col("all_n") / F.col("all_text"))).alias("pattern_shift")
        )
        out = self.aggregates.join(total.select("column_name", "load_no", "n_nonconforming"), ["column_name", "load_no"], "left").join(drift, ["column_name", "load_no"], "left")
        kept = [c for c in self.aggregates.columns]
        return out.select(*kept, F.coalesce("n_nonconforming", F.lit(0)).alias("n_nonconforming"), F.coalesce("pattern_shift", F.lit(0.0)).alias("pattern_shift"))

    def expressions_by_load(self) -> DataFrame:
        """(table_name, column_name, load_no, regex, n): rows of each load under each expression; NULL for those under none."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(regex=[regex_of(e) if isinstance(e, str) else None for e in batch["expression"]]).drop(columns="expression")

        load = self.coverage.schema["load_no"].dataType.simpleString()
        return self.coverage.drop("loose").mapInPandas(run, f"table_name string, column_name string, load_no {load}, n bigint, regex string")


def exact_medians(counted: DataFrame) -> DataFrame:
    """Exact median of the good numbers of each column and load, from value counts: a running count over the
    distinct values in order. The window streams and spills; it holds no group in memory."""
    good = counted.where((F.col("good") > 0) & F.col("num").isNotNull()).groupBy("column_name", "load_no", "num").agg(F.sum("good").alias("good"))
    w = Window.partitionBy("column_name", "load_no").orderBy("num").rowsBetween(Window.unboundedPreceding, 0)
    run = good.withColumn("upto", F.sum("good").over(w))
    size = good.groupBy("column_name", "load_no").agg(F.sum("good").alias("size"))
    lo, hi = F.floor((F.col("size") + 1) / 2), F.floor(F.col("size") / 2) + 1
    holds = lambda at: (F.col("upto") - F.col("good") < at) & (at <= F.col("upto"))
    return (
        run.join(size, ["column_name", "load_no"])
        .groupBy("column_name", "load_no")
        .agg(((F.max(F.when(holds(lo), F.col("num"))) + F.max(F.when(holds(hi), F.col("num")))) / 2).alias("median"))
    )



def find_issues(profile: Profile, *, nulls: list[str], shift: list[str], distinct: list[str], null_margin: float = 0.155) -> DataFrame:
    """(table_name, column_name, issue, case_key): the profile's offending cells and odd loads. A load is odd in ``nulls`` if its
    null rate is ``null_margin`` or more above the median load's, in ``shift`` if its median is at least 3 times or at most
    a third of the loads' median, in ``distinct`` if it has at most half of the median load's distinct values."""
    cells = profile.cells.select("table_name", "column_name", F.lit("cell").alias("issue"), F.col("case_id").cast("long").alias("case_key"))
    loads = profile.aggregates
    typical = loads.groupBy("column_name").agg(
        F.expr("percentile(null_rate, 0.5)").alias("m_null"), F.expr("percentile(median, 0.5)").alias("m_median"), F.expr("percentile(n_distinct, 0.5)").alias("m_distinct")
    )
    judged = loads.join(typical, "column_name")
    rules = F.array_compact(
        F.array(
            F.when(F.col("column_name").isin(nulls) & (F.col("null_rate") - F.col("m_null") >= null_margin), F.lit("nulls")),
            F.when(F.col("column_name").isin(shift) & (F.col("m_median") > 0) & ((F.col("median") >= 3 * F.col("m_median")) | (3 * F.col("median") <= F.col("m_median"))), F.lit("shift")),
            F.when(F.col("column_name").isin(distinct) & (2 * F.col("n_distinct") <= F.col("m_distinct")), F.lit("distinct")),
        )
    )
    odd = judged.select("table_name", "column_name", F.explode(rules).alias("issue"), F.col("load_no").cast("long").alias("case_key"))
    return cells.unionByName(odd)


def real_date(c: str) -> Column:
    """True for a real date written YYYY-MM-DD."""
    return F.coalesce(F.col(c).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))


def real_time(c: str) -> Column:
    """True for a real time written YYYY-MM-DDTHH:MM:SSZ."""
    shape = F.col(c).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z")
    return F.coalesce(shape & F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).isNotNull(), F.lit(False))


def is_uuid(c: str) -> Column:
    """True for a lower-case UUID with hyphens."""
    return F.col(c).rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z")
