"""Best representative of each duplicate group.

``truth_discovery`` follows the method named for this problem: source reliability and weighted votes for field
values are estimated in turn until they settle, and the best supported value of each field is chosen.

``survivors`` takes each field from the first row, in a stated order of precedence, that has it. It exists because
votes cannot give that result: the order ranks rows by registered trust, score, age and id, whatever other rows
say (see the README). Both reduce groups by aggregation with map-side combine; a group of any size costs one row a
partition and field.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.scratch import Scratch

#: Texts that stand for a missing value.
ABSENT = ["", "n/a", "unknown", "tbd", "-", "none"]
UNRANKED = 2**31 - 1


def present_text(c: str) -> Column:
    """True for a text that is there: not NULL, blank or a placeholder."""
    return F.coalesce(~F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")).isin(ABSENT), F.lit(False))


def valid_score(c: str) -> Column:
    return F.coalesce(F.col(c).between(0, 10) & ~F.isnan(c), F.lit(False))


def instant(c: str) -> Column:
    """Microseconds of a time written as ISO-8601, without a zone (then UTC) or as epoch seconds; NULL if unknown."""
    t = F.trim(c)
    zoned = (
        F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.concat(t, F.lit("T00:00:00Z")))
        .when(t.rlike(r"([Zz]|[+-][0-9]{2}:?[0-9]{2})$"), F.regexp_replace(t, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2"))
        .otherwise(F.concat(t, F.lit("Z")))
    )
    return F.when(t.rlike(r"^[0-9]+$"), F.expr(f"try_cast(trim({c}) AS BIGINT)") * 1_000_000).otherwise(F.unix_micros(zoned.try_cast("timestamp")))


def source_names(c: str) -> Column:
    """Names in a JSON array of texts, trimmed and lower-case; NULL if it is none."""
    return F.transform(F.from_json(F.col(c), "array<string>"), lambda x: F.lower(F.trim(x)))


def trust_of(df: DataFrame, registry: DataFrame, row_id: str, sources: str, bound: int = 100) -> DataFrame:
    """``df`` with ``trust``: the lowest rank among a row's registered sources, else ``UNRANKED``. A registry of up to
    ``bound`` names is looked up as a literal map; a larger one is joined."""
    ranks = registry.where(F.col("source_name").isNotNull() & F.col("trust_rank").isNotNull()).groupBy(F.lower(F.trim("source_name")).alias("name")).agg(F.min("trust_rank").alias("rank"))
    few = ranks.limit(bound + 1).collect()
    names = source_names(sources)
    if len(few) <= bound:
        table = F.create_map(*[F.lit(x) for r in few for x in (r.name, int(r.rank))]) if few else F.create_map().cast("map<string,int>")
        return df.withColumn("trust", F.coalesce(F.array_min(F.transform(names, lambda x: F.try_element_at(table, x))), F.lit(UNRANKED)))
    best = df.select(row_id, F.explode(names).alias("name")).join(ranks, "name").groupBy(row_id).agg(F.min("rank").alias("trust"))
    return df.join(best, row_id, "left").fillna({"trust": UNRANKED})


def duplicate_groups(df: DataFrame, row_id: str, pointer: str) -> DataFrame:
    """``df`` with ``group_id``: every row under what it points to (trimmed, lower-case), and the row of that id. A row
    may be in two groups. Blank pointers are none."""
    gid = F.lower(F.trim(pointer))
    pointing = df.where(gid != "").withColumn("group_id", gid)
    wanted = pointing.select("group_id").distinct()
    named = df.withColumn("group_id", F.col(row_id)).join(wanted, "group_id", "left_semi")
    named = named.where(~F.coalesce(gid == F.col("group_id"), F.lit(False)))
    return pointing.unionByName(named)


def survivors(members: DataFrame, row_id: str, order: list[Column], fields: Mapping[str, tuple[Column, list[Column]]]) -> DataFrame:
    """(group_id, field_name, from_id) of groups of two or more rows.

    Rows compete by ``order``, then by id. ``fields`` gives, for each field, when a row has it and, if not empty, an
    order of its own that replaces ``order``. A field that no row has gets no row; so does a group of one; repeated
    rows (same id) count once.
    """
    keys = {f: F.struct(*(own or order), F.col(row_id)) for f, (_, own) in fields.items()}
    best = members.groupBy("group_id").agg(
        F.min(row_id).alias("__a"),
        F.max(row_id).alias("__b"),
        *[F.min(F.when(has, keys[f]))[row_id].alias(f) for f, (has, _) in fields.items()],
    )
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("from_id")) for f in fields])
    return best.where("__a <> __b").select("group_id", F.explode(pairs).alias("p")).select("group_id", "p.*").where(F.col("from_id").isNotNull())


def truth_discovery(claims: DataFrame, *, prior: float = 0.8, rounds: int = 100, tolerance: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """Chosen values and source reliabilities from ``claims(group_id, field_name, value, source)``.

    Repeated: a value's support is the sum of its sources' log odds of being right, as a share of all support in its
    group and field; a source's reliability is the mean share of what it claims, smoothed towards ``prior``. Ends when no
    reliability moves by ``tolerance``; raises if ``rounds`` do not suffice. Ties go to the smaller value. Returns
    (group_id, field_name, value, support, n_values) and (source, reliability). NULL values are no claims, a NULL source
    is a source of its own, repeated claims count once.

    Claims that say the same in the same way are one: a group and field whose claims come from the same sources, told apart in
    the same way, has a pattern, and a pattern is voted on once with the number of its cases. Only patterns, sources and
    counts move in a round; the claims themselves are read at the beginning and at the end.
    """
    scratch = Scratch(claims.sparkSession)
    said = claims.where(F.col("value").isNotNull()).select("group_id", "field_name", "value", F.coalesce("source", F.lit("")).alias("source"))
    # sources of a value, in order: their number is bounded by that of the registered sources, as repeated claims count once
    camps = said.groupBy("group_id", "field_name", "value").agg(F.array_sort(F.collect_set("source")).alias("camp"))
    camps = scratch.keep(camps.withColumn("camp_id", F.xxhash64("camp")))
    whole = camps.groupBy("group_id", "field_name").agg(F.count("*").alias("n_values"), F.sum(F.xxhash64("camp_id", F.lit(7)).cast("decimal(38,0)")).alias("mark"))
    whole = scratch.keep(whole.select("group_id", "field_name", "n_values", F.xxhash64("n_values", "mark").alias("pattern")))
    placed = camps.select("group_id", "field_name", "value", "camp_id").join(whole.select("group_id", "field_name", "pattern"), ["group_id", "field_name"])
    placed = scratch.keep(placed)
    cases = placed.groupBy("pattern", "camp_id").agg(F.count("*").alias("held"))  # values of a camp over all cases of a pattern
    sizes = whole.groupBy("pattern").agg(F.count("*").alias("cases"))
    cases = cases.join(sizes, "pattern").select("pattern", "camp_id", F.col("held").cast("double").alias("held"), (F.col("held") / F.col("cases")).alias("each"))
    cases = scratch.keep(cases)
    members = scratch.keep(camps.select("camp_id", "camp").distinct().select("camp_id", F.explode("camp").alias("source")))
    trust = scratch.keep(members.select("source").distinct().withColumn("reliability", F.lit(prior)))
    for _ in range(rounds):
        shares = _shares(cases, members, trust)
        backed = shares.groupBy("camp_id").agg(F.sum(F.col("held") * F.col("support")).alias("support"), F.sum("held").alias("claims"))
        new = scratch.keep(
            members.join(backed, "camp_id")
            .groupBy("source")
            .agg(((F.sum("support") + 4 * prior) / (F.sum("claims") + 4)).alias("reliability"))
            .select("source", F.greatest(F.lit(0.05), F.least(F.lit(0.95), "reliability")).alias("reliability"))
        )
        moved = new.join(trust.withColumnRenamed("reliability", "was"), "source").agg(F.max(F.abs(F.col("reliability") - F.col("was"))).alias("m")).first().m
        scratch.drop(trust)
        trust = new
        if moved is None or moved < tolerance:
            break
    else:
        raise RuntimeError(f"reliabilities are not stable after {rounds} rounds")
    shares = scratch.keep(_shares(cases, members, trust).select("pattern", "camp_id", "support"))
    voted = placed.join(shares, ["pattern", "camp_id"])
    chosen = voted.groupBy("group_id", "field_name").agg(F.min(F.struct((-F.round("support", 12)).alias("s"), "value")).alias("m"), F.count("*").alias("n_values"))
    return chosen.select("group_id", "field_name", F.col("m.value").alias("value"), (-F.col("m.s")).alias("support"), "n_values"), trust


def _shares(cases: DataFrame, members: DataFrame, trust: DataFrame) -> DataFrame:
    """Support of a value of each camp as a share of its case. Log odds are kept positive: a source worse than chance
    still counts a little for what it says."""
    weight = F.greatest(F.lit(0.05), F.log(F.col("reliability") / (1 - F.col("reliability"))))
    votes = members.join(trust, "source").groupBy("camp_id").agg(F.sum(weight).alias("votes"))
    held = cases.join(votes, "camp_id")
    total = held.groupBy("pattern").agg(F.sum(F.col("votes") * F.col("each")).alias("total"))
    return held.join(total, "pattern").withColumn("support", F.col("votes") / F.col("total"))
