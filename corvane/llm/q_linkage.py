"""Problem 2: which company an unresolved sighting describes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.hosts import first_path, host, mark_shared, shared_hosts
from corvane.llm.linkage import PROFILE_SCHEMA, blocking_keys, first_known, led_by, link, names_in_json, person_keys, place, words_and_pairs
from corvane.llm.nameforms import Vocabulary
from corvane.llm.q_variants import company_vocabulary, people_vocabulary
from corvane.plans.common import table
from corvane.scratch import Scratch

#: Path segments that are pages of a site, not names.
PAGES = frozenset("about team contact home index news en portfolio company companies".split())


def _profiles(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Profiles of ``df(id, name, host, slug, sector, place, text, people, sources)`` with blocking keys."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                own, _, lines, number = v.company(r.name.lower().strip() if isinstance(r.name, str) else "")
                h = r.host if isinstance(r.host, str) else ""
                slug = r.slug if isinstance(r.slug, str) and r.slug not in PAGES else ""
                people = person_keys(names_in_json(r.people) + ([r.contact] if isinstance(r.contact, str) else []) + led_by(r.text), v)
                sources = "|".join(sorted({s.strip().lower() for s in (names_in_json(r.sources) or ([r.sources] if isinstance(r.sources, str) else []))}))
                rows.append((r.id, own, lines, number, h, slug, r.sector if isinstance(r.sector, str) else "", r.place if isinstance(r.place, str) else "", people, sources, blocking_keys(own, number, h, slug, v)))
            yield pd.DataFrame(rows, columns=["id", "own", "lines", "number", "host", "slug", "sector", "place", "people", "sources", "keys"])

    return df.mapInPandas(run, f"id {kind}, {PROFILE_SCHEMA}, keys array<bigint>")


def _recurring(values: DataFrame, least: int = 2) -> DataFrame:
    """Different ``values(value)`` that ``least`` rows or more have."""
    return values.where("value <> ''").groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("value")


def _located(df: DataFrame, addresses: list[str], shared: DataFrame) -> DataFrame:
    """``df`` with the host that is a row's own and, on a shared host, the first path segment: of the first of its
    ``addresses`` that has one."""
    for i, c in enumerate(addresses):
        df = mark_shared(df.withColumn(f"__host{i}", host(c)), f"__host{i}", shared, f"__shared{i}")
    own = F.coalesce(*[F.when(~F.col(f"__shared{i}"), F.col(f"__host{i}")) for i in range(len(addresses))])
    path = F.coalesce(*[F.when(F.col(f"__shared{i}"), first_path(c)) for i, c in enumerate(addresses)])
    return df.withColumn("own_host", own).withColumn("own_path", path)


def link_sightings(raw: DataFrame, companies: DataFrame, founders: DataFrame) -> DataFrame:
    """(left_id, right_id, confidence) of sightings and companies rows. General words, given names, shared hosts, places and
    sectors are learned from all names, edges, domains, locations and companies; what makes each of them one is counted
    among the rows that hold it, so it does not depend on how many others there are."""
    scratch = Scratch(raw.sparkSession)
    raw = raw.select("id", "source", "name_raw", "website", "description", "tags", "location_raw", "extra")
    companies = companies.select("id", "name", "canonical_domain", "website", "sub_sector", "summary", "founder_names", "source_ids")
    named = companies.select(F.lower(F.trim("name")).alias("name"), "canonical_domain").where("name <> ''")
    shared = scratch.keep(shared_hosts(named, "canonical_domain", "name"))
    people = founders.select(F.lower(F.trim("founder_name")).alias("name"), "company_id").where("name <> ''")
    vocabulary = Vocabulary(company_vocabulary(named.select("name").distinct()), people_vocabulary(people))
    places = scratch.keep(_recurring(raw.select(place("location_raw").alias("value"))))
    sectors = scratch.keep(_recurring(companies.select(F.col("sub_sector").alias("value"))))
    mention = lambda df, text: first_known(df, "id", words_and_pairs(text), places).withColumnRenamed("value", "mentioned")
    tagged = first_known(raw, "id", F.from_json("tags", "array<string>"), sectors).withColumnRenamed("value", "sector")
    left = _located(raw.withColumn("typed", place("location_raw")), ["website"], shared)
    left = left.join(tagged, "id", "left").join(mention(left.where("typed = ''"), "description"), "id", "left")
    left = left.select(
        "id", F.col("name_raw").alias("name"), F.col("own_host").alias("host"), F.col("own_path").alias("slug"), "sector",
        F.when(F.col("typed") == "", F.col("mentioned")).otherwise(F.col("typed")).alias("place"), F.col("description").alias("text"),
        F.lit(None).cast("string").alias("people"), F.get_json_object("extra", "$.contact").alias("contact"), F.col("source").alias("sources"),
    )
    right = _located(companies, ["canonical_domain", "website"], shared).join(mention(companies, "summary"), "id", "left")
    right = right.select(
        "id", "name", F.col("own_host").alias("host"), F.col("own_path").alias("slug"), F.col("sub_sector").alias("sector"), F.col("mentioned").alias("place"),
        F.col("summary").alias("text"), F.col("founder_names").alias("people"), F.lit(None).cast("string").alias("contact"), F.col("source_ids").alias("sources"),
    )
    return link(_profiles(left, vocabulary), _profiles(right, vocabulary))


def p2_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every blocked pair of an unresolved sighting and a companies row with its confidence."""
    raw = table(spark, folder, "raw_records").where("company_id is null")
    found = link_sightings(raw, table(spark, folder, "companies"), table(spark, folder, "founder_company_edges"))
    return found.select(F.col("right_id").alias("company_id"), F.col("left_id").alias("raw_id"), F.round("confidence", 6).alias("confidence"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sightings and companies rows that describe one company: confidence above one half."""
    return p2_scores(spark, folder).where("confidence > 0.5").select("company_id", "raw_id")


QUERIES = {"p2_found": p2_found, "p2_scores": p2_scores}
SQL: dict[str, str] = {}
