"""Matching entities across sources without keys.

Two tables are reduced to profiles of comparable attributes (name parts, host, sector, place, people, source). Pairs
that share a blocking key become similarity vectors on a fixed grid of levels, so that all vectors together are a
histogram of bounded size. A two-component Gaussian mixture, regularised and without labels, is fitted to the whole
histogram by expectation-maximisation on the driver. Every expectation step is held to transitivity: where a record
matches its best candidate, another candidate may match it no more than the two candidates match each other. For that the
pairs of a record's candidates are compared too, and come to the driver as a histogram of triples of cells. The best
candidates follow from the fit, so both are repeated until the candidates stay. The result has a posterior for every pair.

Equal profiles are compared once; blocking keys are exact words, words without one letter (so one slip of the pen or two
swapped letters are always met), sounds and hosts; no bucket is cut.

A record without a name is met by its host only, without either it has no row. Unknown fields neither match nor clash.
Repeated rows give repeated rows. Among equally good candidates the one with the larger profile hash is the best one.
Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.nameforms import Vocabulary, edits, fold, sound
from corvane.scratch import Scratch

PROFILE = ["own", "lines", "number", "host", "slug", "sector", "place", "people", "sources"]
PROFILE_SCHEMA = "own string, lines string, number int, host string, slug string, sector string, place string, people string, sources string"
#: Levels of each feature: no, unknown, partly, yes.
LEVELS = np.array([0.0, 0.5, 0.8, 1.0])
FEATURES = ["name", "line", "number", "host", "sector", "place", "person", "source"]

LED = re.compile(r"(?:Founder|Led by):?\s((?:[^\W\d_]{1,4}\.\s)*[^.]+)\.")


def person_keys(names: list[str], vocabulary: Vocabulary) -> str:
    """People as sorted ``surname|class|initial``."""
    out = set()
    for n in names:
        surname, cls, initial = vocabulary.person(n.lower())
        if surname:
            out.add(f"{surname}|{cls}|{initial}")
    return " ".join(sorted(out))


def led_by(text: str | None) -> list[str]:
    return LED.findall(text) if isinstance(text, str) else []


def names_in_json(text: str | None) -> list[str]:
    """Texts of a JSON array; none if it is no such thing."""
    try:
        found = json.loads(text) if isinstance(text, str) and text.lstrip().startswith("[") else []
    except ValueError:
        return []
    return [x for x in found if isinstance(x, str)] if isinstance(found, list) else []


def place_of(location: str | None) -> str:
    """City of a location as typed: without region, brackets and 'greater ... area'."""
    if not isinstance(location, str):
        return ""
    s = re.sub(r"\(.*?\)", " ", fold(location)).split(",")[0]
    s = re.sub(r"\b(greater|area|metro|metropolitan|region|city of)\b", " ", s)
    return " ".join(re.findall(r"[a-z]+", s))


#: Lower-case Latin letters with marks and the letters they are without them, by their decomposition.
MARKED = {c: base for o in (*range(0xE0, 0x250), *range(0x1E00, 0x1F00)) if (c := chr(o)).islower() and len(base := fold(c)) == 1 and base.isascii()}


def plain(c: Column) -> Column:
    """Lower-case text without marks on Latin letters."""
    return F.translate(F.lower(c), "".join(MARKED), "".join(MARKED.values()))


def place(c: str) -> Column:
    """``place_of`` as a column; empty where there is none."""
    s = F.get(F.split(F.regexp_replace(plain(F.col(c)), r"\(.*?\)", " "), ","), F.lit(0))
    s = F.regexp_replace(s, r"\b(greater|area|metro|metropolitan|region|city of)\b", " ")
    return F.coalesce(F.array_join(F.regexp_extract_all(s, F.lit("([a-z]+)"), F.lit(1)), " "), F.lit(""))


def words_and_pairs(c: str) -> Column:
    """The words of a text and each two that follow one another, in order, a pair before its first word."""
    words = F.regexp_extract_all(plain(F.col(c)), F.lit("([a-z]+)"), F.lit(1))
    return F.flatten(F.transform(words, lambda w, i: F.array(F.concat_ws(" ", w, F.get(words, i + 1)), w)))


def first_known(df: DataFrame, row: str, values: Column, known: DataFrame) -> DataFrame:
    """(row, value) of the first of an array of ``values`` that ``known(value)`` has; rows with none are left out. The known
    values are joined, so there may be any number of them."""
    each = df.select(F.col(row), F.posexplode(values).alias("__at", "value"))
    met = each.join(known.select("value"), "value").groupBy(row).agg(F.min(F.struct("__at", "value")).alias("__m"))
    return met.select(row, F.col("__m.value").alias("value"))


def host_core(label: str, vocabulary: Vocabulary) -> str:
    """The own part of a host label or path: without prefixes, suffixes and a line of business at its end."""
    word = re.sub(r"[^a-z0-9]", "", label)
    while found := vocabulary.line_at_end(word):
        word = word[: -len(found)]
    return word


def blocking_keys(own: str, number: int, host: str, slug: str, vocabulary: Vocabulary) -> list[int]:
    """Keys of a profile: its own part whole, without each letter and by sound, its host and the words of its host."""
    words = {f"d{own}", f"s{sound(own)}"} if own else set()
    if len(own) >= 5:
        words |= {f"d{own[:i]}{own[i + 1 :]}" for i in range(len(own))}
    if host:
        words.add(f"h{host}")
    for label in (host.split(".")[0] if host else "", slug):
        core = host_core(label, vocabulary)
        if len(core) >= 5:
            words |= {f"d{core}"}
            if core.startswith("go") and len(core) >= 7:
                words.add(f"d{core[2:]}")
            if core.endswith("hq") and len(core) >= 7:
                words.add(f"d{core[:-2]}")
    return [xxhash.xxh64_intdigest(w) - 2**63 for w in words]


def _host_level(a: dict, b: dict) -> int:
    if a["host"] and b["host"]:
        return 3 if a["host"] == b["host"] else 0
    for x, y in ((a, b), (b, a)):
        label = x["host"].split(".")[0].replace("-", "") if x["host"] else x["slug"].replace("-", "")
        if label and y["own"] and y["own"] in label:
            return 2 if x["host"] else 2
    if a["slug"] and b["slug"]:
        return 3 if a["slug"] == b["slug"] else 1
    return 1


def _people_level(a: str, b: str) -> int:
    if not a or not b:
        return 1
    best = 0
    for x in a.split(" "):
        sx, cx, ix = x.split("|")
        for y in b.split(" "):
            sy, cy, iy = y.split("|")
            near = sx == sy or sound(sx) == sound(sy) or edits(sx, sy, 1) <= 1
            if near and (cx == cy if cx and cy else ix == iy):
                return 3
    return best


def compare(a: dict, b: dict) -> tuple[int, ...]:
    """Levels (indices of ``LEVELS``) of the features of two profiles."""
    x, y = a["own"], b["own"]
    d = edits(x, y, 3)
    name = 3 if d == 0 or sound(x) == sound(y) else 2 if d == 1 else 1 if d <= 3 and min(len(x), len(y)) >= 7 else 0
    p, q = set(a["lines"].split()), set(b["lines"].split())
    line = 1 if not p or not q else 3 if p == q else 2 if p <= q or q <= p else 0
    number = 3 if a["number"] == b["number"] else 0
    sector = 1 if not a["sector"] or not b["sector"] else 3 if a["sector"] == b["sector"] else 0
    place = 1 if not a["place"] or not b["place"] else 3 if a["place"] == b["place"] else 0
    s, t = set(a["sources"].split("|")) - {""}, set(b["sources"].split("|")) - {""}
    source = 1 if not s or not t else 3 if s & t else 0
    return name, line, number, _host_level(a, b), sector, place, _people_level(a["people"], b["people"]), source


def compare_pairs(pairs: DataFrame) -> DataFrame:
    """``cell``, the mixed number of the levels, for pairs with both profiles' columns (suffixes _a and _b)."""
    keep = [f for f in pairs.schema.fields if f.name[:-2] not in PROFILE]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keep], "cell int"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a = batch[[f"{c}_a" for c in PROFILE]].set_axis(PROFILE, axis=1).to_dict("records")
            b = batch[[f"{c}_b" for c in PROFILE]].set_axis(PROFILE, axis=1).to_dict("records")
            cells = []
            for x, y in zip(a, b):
                n = 0
                for level in compare(x, y):
                    n = n * len(LEVELS) + level
                cells.append(n)
            yield batch[[f.name for f in keep]].assign(cell=np.array(cells, dtype=np.int32))

    return pairs.mapInPandas(run, schema)


def vectors_of(cells: np.ndarray) -> np.ndarray:
    """Similarity vectors of cells."""
    out = np.empty((len(cells), len(FEATURES)))
    rest = cells.copy()
    for j in range(len(FEATURES) - 1, -1, -1):
        out[:, j] = LEVELS[rest % len(LEVELS)]
        rest //= len(LEVELS)
    return out


class Mixture:
    """Two Gaussians over weighted similarity vectors; the covariances are shrunk to their diagonal and kept off zero."""

    def __init__(self, ridge: float = 0.02, shrink: float = 0.5):
        self.ridge, self.shrink = ridge, shrink

    def _density(self, x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
        gap = x - mean
        return -0.5 * (np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) + np.linalg.slogdet(cov)[1])

    def maximise(self, x: np.ndarray, n: np.ndarray, gamma: np.ndarray) -> None:
        self.parts = []
        for g in (gamma * n, (1 - gamma) * n):
            total = max(g.sum(), 1e-9)
            mean = (x * g[:, None]).sum(0) / total
            cov = np.einsum("i,ij,ik->jk", g, x - mean, x - mean) / total
            cov = self.shrink * np.diag(np.diag(cov)) + (1 - self.shrink) * cov + self.ridge * np.eye(x.shape[1])
            self.parts.append((total / n.sum(), mean, cov))

    def expect(self, x: np.ndarray) -> np.ndarray:
        """Posterior of a match by the features that ``x`` has: all, or the first ones. It never falls when a similarity rises
        beyond the matched mean: such vectors are moved to the mean of the matched component where they exceed it."""
        k = x.shape[1]
        (pm, mm, cm), (pu, mu, cu) = [(p, mean[:k], cov[:k, :k]) for p, mean, cov in self.parts]
        y = np.minimum(x, np.maximum(mm, mu))
        score = np.log(max(pm, 1e-12)) + self._density(y, mm, cm) - np.log(max(pu, 1e-12)) - self._density(y, mu, cu)
        return 1 / (1 + np.exp(-np.clip(score, -50, 50)))

    def fit(self, x: np.ndarray, n: np.ndarray, gamma: np.ndarray, rivals: Rivals, rounds: int = 500) -> np.ndarray:
        """Expectation-maximisation until no cell moves by 1e-4 (after 300 rounds, by 1e-2); every expectation step is held to
        transitivity. Raises if it does not settle."""
        for turn in range(rounds):
            self.maximise(x, n, gamma)
            new = rivals.hold(self, self.expect(x), n)
            if np.abs(new - gamma).max() < (1e-4 if turn < 300 else 1e-2):
                return new
            gamma = new if turn < 100 else (new + gamma) / 2  # what swings between two states meets in the middle
        raise RuntimeError("the mixture does not settle")


class Rivals:
    """Cells of pairs (record, other candidate), (record, best candidate) and (other candidate, best candidate), with counts.
    Transitivity: the other candidate matches no more than as both candidates match each other, given the best one."""

    def __init__(self, cells: np.ndarray, rows: pd.DataFrame | None = None):
        rows = pd.DataFrame({"cell": [], "star": [], "between": [], "n": []}) if rows is None else rows
        at = {int(c): i for i, c in enumerate(cells)}
        self.cell = np.array([at[int(c)] for c in rows["cell"]], dtype=np.int64)
        self.star = np.array([at[int(c)] for c in rows["star"]], dtype=np.int64)
        self.kinds, self.between = np.unique(rows["between"].to_numpy(dtype=np.int64), return_inverse=True)
        self.n = rows["n"].to_numpy(dtype=float)

    def within(self, mixture: Mixture) -> np.ndarray:
        """Posteriors of the cells between candidates. The source, the last feature, is left out: two rows of one table need
        not share one."""
        return mixture.expect(vectors_of(self.kinds)[:, :-1])

    def hold(self, mixture: Mixture, gamma: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Mean posterior of each cell once the pairs among the rivals are held to transitivity."""
        if not len(self.n):
            return gamma
        cap = np.minimum(1.0, self.within(mixture)[self.between] / np.maximum(gamma[self.star], 1e-9))
        lost = np.zeros(len(gamma))
        np.add.at(lost, self.cell, np.maximum(gamma[self.cell] - cap, 0.0) * self.n)
        return np.maximum(gamma - lost / n, 0.0)


#: Weights of the features in the first guess of who matches.
FIRST_GUESS = np.array([0.25, 0.15, 0.1, 0.2, 0.1, 0.05, 0.1, 0.05])


def link(left: DataFrame, right: DataFrame, *, max_rounds: int = 20, transitive: bool = True) -> DataFrame:
    """(left_id, right_id, confidence) of all blocked pairs, from profiles with an ``id`` and ``keys``.

    ``left`` and ``right`` hold id, the columns of ``PROFILE`` (texts, empty where unknown) and ``keys``. Records without
    keys or without a partner under any key have no row; with no pairs at all the result is empty. Ends when the best
    candidates and their rivals are those of an earlier fit; raises if they still change after ``max_rounds`` fits.
    ``transitive=False`` leaves the constraint out.
    """
    spark = left.sparkSession
    scratch = Scratch(spark)
    sides = []
    for df in (left, right):
        df = scratch.keep(df.withColumn("pid", F.xxhash64(*PROFILE)))
        profiles = scratch.keep(df.groupBy("pid").agg(*[F.first(c).alias(c) for c in PROFILE], F.first("keys").alias("keys")))
        sides.append((df.select("id", "pid"), profiles))
    (ids_a, a), (ids_b, b) = sides
    ka = a.select(F.col("pid").alias("pa"), F.explode("keys").alias("key"))
    kb = b.select(F.col("pid").alias("pb"), F.explode("keys").alias("key"))
    # keys are many times the rows the planner counts: without the hint it may broadcast them
    met = ka.hint("merge").join(kb, "key").select("pa", "pb").distinct()
    side = lambda df, s: df.select(F.col("pid").alias(f"p{s}"), *[F.col(c).alias(f"{c}_{s}") for c in PROFILE])
    pairs = scratch.keep(compare_pairs(met.join(side(a, "a"), "pa").join(side(b, "b"), "pb")))
    histogram = pairs.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").toPandas()  # at most 4^8 cells, whatever the input
    if histogram.empty:
        return ids_a.join(ids_b, ["id", "pid"]).select(F.col("id").alias("left_id"), F.col("id").alias("right_id"), F.lit(0.0).alias("confidence")).where(F.lit(False))
    cells, n = histogram["cell"].to_numpy(), histogram["n"].to_numpy(dtype=float)
    x = vectors_of(cells)
    mixture, rivals, held, marks = Mixture(), Rivals(cells), None, set()
    gamma = (x @ FIRST_GUESS > 0.72).astype(float) * 0.9 + 0.05
    cell_table = lambda name, at, values: F.broadcast(spark.createDataFrame(pd.DataFrame({name: at, f"p_{name}": values})))  # noqa: E731  at most 4^8 rows
    for _ in range(max_rounds):
        gamma = mixture.fit(x, n, gamma, rivals)
        if not transitive:
            break
        scored = pairs.join(cell_table("cell", cells, mixture.expect(x)), "cell").where("p_cell > 0.5")
        best = scored.groupBy("pa").agg(F.max(F.struct("p_cell", "pb", "cell")).alias("m")).select("pa", F.col("m.pb").alias("pstar"), F.col("m.cell").alias("star"))
        others = scratch.keep(scored.join(best, "pa").where("pb <> pstar").select("pa", "pb", "cell", "pstar", "star"))
        mark = tuple(others.agg(F.count("*").alias("n"), F.sum(F.xxhash64("pa", "pb", "pstar").cast("decimal(38,0)")).alias("s")).first())
        if mark in marks:  # as in the round before, or in an earlier one if two states alternate
            break
        marks.add(mark)
        two = others.select("pb", "pstar").distinct().join(side(b, "b"), "pb").join(b.select(F.col("pid").alias("pstar"), *[F.col(c).alias(f"{c}_a") for c in PROFILE]), "pstar")
        held = scratch.keep(others.join(compare_pairs(two).withColumnRenamed("cell", "between"), ["pb", "pstar"]))
        #: Different triples of cells, not pairs: their number depends on the grid, not on the input.
        rivals = Rivals(cells, held.groupBy("cell", "star", "between").agg(F.count("*").alias("n")).orderBy("cell", "star", "between").toPandas())
    else:
        raise RuntimeError(f"the best candidates are not stable after {max_rounds} fits")
    final = pairs.join(cell_table("cell", cells, mixture.expect(x)), "cell").select("pa", "pb", F.col("p_cell").alias("confidence"))
    if held is not None and len(rivals.n):
        capped = held.join(cell_table("cell", cells, mixture.expect(x)), "cell").join(cell_table("star", cells, mixture.expect(x)), "star").join(cell_table("between", rivals.kinds, rivals.within(mixture)), "between")
        capped = capped.select("pa", "pb", F.least("p_cell", F.col("p_between") / F.col("p_star")).alias("adjusted"))
        final = final.join(capped, ["pa", "pb"], "left").select("pa", "pb", F.coalesce("adjusted", "confidence").alias("confidence"))
    out = final.join(ids_a.select(F.col("id").alias("left_id"), F.col("pid").alias("pa")), "pa").join(ids_b.select(F.col("id").alias("right_id"), F.col("pid").alias("pb")), "pb")
    return out.select("left_id", "right_id", "confidence")
