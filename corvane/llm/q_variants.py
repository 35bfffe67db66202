"""Problem 4: spellings of company and founder names."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.hosts import host, mark_shared, shared_hosts
from corvane.llm.nameforms import Vocabulary, company_tokens, general_words, given_classes, person_tokens
from corvane.llm.variants import candidate_pairs, entities, spelling_pairs, verify
from corvane.plans.common import table
from corvane.scratch import Scratch


def company_vocabulary(names: DataFrame) -> dict[str, int]:
    """General words over all distinct ``names(name)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for n in batch["name"]:
                tokens = company_tokens(n) if n else []
                first = {t: i for i, t in reversed(list(enumerate(tokens)))}
                rows += [(n, t, tokens[i - 1] if i else None, tokens[i + 1] if i + 1 < len(tokens) else None) for t, i in first.items()]
            yield pd.DataFrame(rows, columns=["name", "token", "before", "after"])

    return general_words(names.select("name").mapInPandas(run, "name string, token string, before string, after string"))


def parse_companies(names: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``names`` with own, line, lines, number."""
    shared = names.sparkSession.sparkContext.broadcast(vocabulary)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in names.schema.fields], "own string, line string, lines string, number int"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        for batch in batches:
            parsed = [v.company(n or "") for n in batch["name"]]
            yield batch.assign(own=[p[0] for p in parsed], line=[p[1] for p in parsed], lines=[p[2] for p in parsed], number=[p[3] for p in parsed])

    return names.mapInPandas(run, schema)


def company_entities(spark: SparkSession, folder: str) -> DataFrame:
    """(name, star) of all different company names, lower-case: names of one star are spellings of one company."""
    scratch = Scratch(spark)
    rows = table(spark, folder, "companies").select(F.lower(F.trim("name")).alias("name"), "canonical_domain", "sub_sector").where("name <> ''")
    shared = scratch.keep(shared_hosts(rows, "canonical_domain", "name"))
    rows = mark_shared(rows.withColumn("own", host("canonical_domain")), "own", shared, "shared")
    rows = scratch.keep(rows.select("name", F.when(~F.col("shared"), F.col("own")).alias("host"), "sub_sector").distinct())
    names = scratch.keep(rows.select("name").distinct())
    parsed = parse_companies(names, Vocabulary(company_vocabulary(names), {}))
    node = F.xxhash64("own", "lines", "number")
    parsed = scratch.keep(parsed.withColumn("node", node))
    # all hosts and sectors of a node, one row each
    placed = rows.join(parsed.select("name", "node"), "name")
    hosts = scratch.keep(placed.where("host is not null").select("node", "host").distinct())
    about = placed.groupBy("node").agg(F.array_sort(F.collect_set("sub_sector")).alias("sectors"), F.coalesce(F.bool_or(F.col("host").isNotNull()), F.lit(False)).alias("located"))
    nodes = scratch.keep(parsed.where("own <> ''").select("node", "own", "line", "lines", "number").distinct().join(about, "node"))
    full, open_ = nodes.where("line <> ''"), nodes.where("line = ''")
    typos = candidate_pairs(full.withColumn("class", F.concat_ws("|", "line", "number")))
    own = full.select("own", "number", F.col("node").alias("n"), "sectors", "located", "lines")
    a, b = _side(full, "a"), _side(full, "b")
    pairs = scratch.keep(typos.join(a, "a").join(b, "b").where(F.levenshtein("own_a", "own_b", 6) >= 0))
    pairs = pairs.join(_meeting(pairs, hosts), ["a", "b"], "left")
    supported = F.coalesce("same", F.lit(False))
    pairs = pairs.where(~(F.col("located_a") & F.col("located_b") & ~supported))
    checked = verify(pairs.select("a", "b", "own_a", "own_b", F.concat_ws(" ", "own_a", "lines_a").alias("words_a"), F.concat_ws(" ", "own_b", "lines_b").alias("words_b"), supported.alias("supported")))
    # lines that contain one another under the same own part
    x, y = own.select("own", "number", F.col("n").alias("a"), F.col("lines").alias("la")), own.select("own", "number", F.col("n").alias("b"), F.col("lines").alias("lb"))
    inside = F.size(F.array_except(F.split("la", " "), F.split("lb", " "))) == 0
    nested = x.join(y, ["own", "number"]).where(inside & (F.col("a") != F.col("b"))).select("a", "b")
    # names without a line: the only line of their own part, or the one at the same host or in the same sector
    o = open_.select("own", "number", F.col("node").alias("a"), F.col("located").alias("o_located"), F.col("sectors").alias("o_sectors"))
    met = scratch.keep(o.join(own.withColumnRenamed("n", "b"), ["own", "number"]).drop("lines"))
    met = met.join(_meeting(met, hosts), ["a", "b"], "left")
    hosted = F.coalesce("same", F.lit(False))
    clash = F.col("o_located") & F.col("located") & ~hosted
    sector = (F.size("sectors") > 0) & (F.col("o_sectors") == F.col("sectors"))
    score = F.when(hosted, 3).when(clash, 0).when(sector, 2).otherwise(1)
    met = scratch.keep(met.select("a", "b", score.alias("score")))
    best = met.groupBy("a").agg(F.max("score").alias("top"), F.count("*").alias("options"))
    joined = met.join(best, "a").where((F.col("score") == F.col("top")) & ((F.col("top") >= 2) | ((F.col("top") == 1) & (F.col("options") == 1)))).select("a", "b")
    # slips at the same host, where one line is missing or both are equal; a host of one company has few names
    there = hosts.join(full.select("node", "own", "number", "line"), "node").select("host", "number", F.col("node").alias("b"), F.col("own").alias("own_b"), F.col("line").alias("line_b"))
    here = hosts.join(nodes.select("node", "own", "number", "line"), "node").select("host", "number", F.col("node").alias("a"), F.col("own").alias("own_a"), F.col("line").alias("line_a"))
    slips = here.join(there, ["host", "number"])
    slips = slips.where(F.col("line_a").isin("") | ((F.col("line_a") == F.col("line_b")) & (F.col("a") < F.col("b"))))
    slips = verify(slips.select("a", "b", "own_a", "own_b", F.col("own_a").alias("words_a"), F.col("own_b").alias("words_b"), F.lit(True).alias("supported")), 0.6)
    links = scratch.keep(checked.unionByName(nested).unionByName(joined).unionByName(slips).distinct())
    return entities(parsed.select("name", "node"), links, scratch)


def _side(nodes: DataFrame, s: str) -> DataFrame:
    return nodes.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("own", "lines", "located") if c in nodes.columns])


def _meeting(pairs: DataFrame, hosts: DataFrame) -> DataFrame:
    """(a, b, same = true) of the ``pairs`` of nodes that have any of their ``hosts(node, host)`` in common."""
    left = pairs.select("a", "b").join(hosts.withColumnRenamed("node", "a"), "a")
    return left.join(hosts.withColumnRenamed("node", "b"), ["b", "host"]).select("a", "b").distinct().withColumn("same", F.lit(True))


def parse_people(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` with own (the surname), class and initial."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields], "own string, class string, initial string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        for batch in batches:
            parsed = [v.person(n or "") for n in batch["name"]]
            yield batch.assign(**{"own": [p[0] for p in parsed], "class": [p[1] for p in parsed], "initial": [p[2] for p in parsed]})

    return rows.mapInPandas(run, schema)


def people_vocabulary(rows: DataFrame) -> dict[str, str]:
    """Given-name classes over all ``rows(name, company_id)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for n, c in zip(batch["name"], batch["company_id"]):
                given, last = person_tokens(n or "")
                if given and last:
                    out.append(("".join(given[:2]) if len(given) > 1 and len(given[1]) > 2 else given[0], "".join(last), c))
            yield pd.DataFrame(out, columns=["given", "surname", "company_id"])

    return given_classes(rows.select("name", "company_id").mapInPandas(run, "given string, surname string, company_id string"))


def founder_entities(spark: SparkSession, folder: str, companies: DataFrame) -> DataFrame:
    """(name, star) of all different founder names, lower-case. A name with an initial only joins the one person of that surname
    and initial at the same company (all rows that ``companies(name, star)`` has as one), or the only person that has the
    surname at all."""
    scratch = Scratch(spark)
    rows = table(spark, folder, "founder_company_edges").select(F.lower(F.trim("founder_name")).alias("name"), "company_id").where("name <> ''").distinct()
    rows = scratch.keep(rows)
    classes = people_vocabulary(rows)
    parsed = parse_people(rows, Vocabulary(set(), classes)).where("own <> ''")
    parsed = scratch.keep(parsed.withColumn("node", F.xxhash64("own", "class", F.when(F.col("class") == "", F.col("initial")).otherwise(F.lit("")))))
    nodes = scratch.keep(parsed.select("node", "own", "class", F.when(F.col("class") == "", F.col("initial")).otherwise(F.lit("")).alias("initial")).distinct())
    full, open_ = nodes.where("class <> ''"), nodes.where("class = ''")
    typos = candidate_pairs(full)
    pairs = typos.join(full.select(F.col("node").alias("a"), F.col("own").alias("own_a"), "class"), "a").join(full.select(F.col("node").alias("b"), F.col("own").alias("own_b")), "b")
    pairs = pairs.where(F.levenshtein("own_a", "own_b", 6) >= 0)
    checked = verify(pairs.select("a", "b", "own_a", "own_b", F.concat_ws(" ", "class", "own_a").alias("words_a"), F.concat_ws(" ", "class", "own_b").alias("words_b"), F.lit(False).alias("supported")))
    letters = spark.createDataFrame(sorted({(c, g[0]) for g, c in classes.items()} | {(c, c[0]) for c in classes.values()}) or [("", "")], "class string, initial string")
    known = full.drop("initial").join(F.broadcast(letters), "class", "left").withColumn("initial", F.coalesce("initial", F.substring("class", 1, 1)))
    met = open_.select(F.col("node").alias("a"), "own", "initial").join(known.select(F.col("node").alias("b"), "own", "initial").distinct(), ["own", "initial"]).select("a", "b")
    met = scratch.keep(met)
    named = table(spark, folder, "companies").select(F.col("id").alias("company_id"), F.lower(F.trim("name")).alias("cname")).distinct()
    star = named.join(companies.withColumnRenamed("name", "cname"), "cname").groupBy("company_id").agg(F.min("star").alias("star"))
    at = parsed.select("node", "company_id").distinct().join(star, "company_id", "left").select("node", F.coalesce("star", F.xxhash64("company_id")).alias("place")).distinct()
    at = scratch.keep(at)
    together = met.join(at.withColumnRenamed("node", "a"), "a").join(at.withColumnRenamed("node", "b"), ["b", "place"])
    together = together.groupBy("a", "place").agg(F.min("b").alias("b"), F.max("b").alias("last")).where("b = last").select("a", "b").distinct()
    bearers = full.groupBy("own").agg(F.count_distinct("class").alias("k")).where("k = 1").select("own")
    alone = met.join(nodes.select(F.col("node").alias("a"), "own"), "a").join(bearers, "own", "left_semi").select("a", "b")
    # at one company, two or three slips, also under an initial
    placed = parsed.select("company_id", "node", "own", "class", "initial", F.substring("own", 1, 1).alias("first")).where("initial <> ''").distinct()
    other = placed.select("company_id", "first", "class", "initial", F.col("node").alias("b"), F.col("own").alias("own_b"))
    known, bare = placed.where("class <> ''"), placed.where("class = ''")
    near = known.join(other, ["company_id", "first", "class"]).where("node < b").select("node", "b", "own", "own_b")
    near = near.unionByName(bare.join(other.drop("class"), ["company_id", "first", "initial"]).where("node <> b").select("node", "b", "own", "own_b"))
    near = near.where(F.levenshtein("own", "own_b", 5) >= 0)
    near = verify(near.select(F.col("node").alias("a"), "b", F.col("own").alias("own_a"), "own_b", F.col("own").alias("words_a"), F.col("own_b").alias("words_b"), F.lit(True).alias("supported")), 0.6)
    links = scratch.keep(checked.unionByName(together).unionByName(alone).unionByName(near).distinct())
    return entities(parsed.select("name", "node").distinct(), links, scratch)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of spellings of one company or founder, over all names of both tables."""
    companies = company_entities(spark, folder)
    found = spelling_pairs(companies).select(F.lit("company").alias("entity_kind"), "name_a", "name_b")
    return found.unionByName(spelling_pairs(founder_entities(spark, folder, companies)).select(F.lit("founder").alias("entity_kind"), "name_a", "name_b"))


QUERIES = {"p4_found": p4_found}
SQL: dict[str, str] = {}
