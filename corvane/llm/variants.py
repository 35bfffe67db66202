"""Variant spellings of names typed by people.

Names are parsed into a part of their own (the company's word, the surname) and a class (line of business and numeral, or
class of the given name); equal parses are one node. Within a class, own parts are compared by MinHash over padded
q-grams: signatures are cut into bands, and nodes that share a band are candidates. The number of bands follows from
the collision curve ``1 - (1 - s^k)^b`` at the similarity ``s`` that one slip leaves in a word of that length, so that no
length is missed more often than 1 - ``recall``; short words get wide bands, long ones narrow bands. What the curve
leaves out is met by exact keys: own parts also share their forms without one letter.
Candidates are verified by Monge-Elkan similarity of their words and by the distance of their own parts, and the
verified graph is clustered into stars: a node of highest degree and its neighbours. Names that leave the class open (no
line of business, only an initial) join the only star of their own part, or the one that other evidence points to.

Only distinct nodes are compared, so repeated spellings cost nothing; signatures are keyed by class, so a bucket holds
names that are similar in both parts.

NULL and blank names have no rows; repeated names count once; a name that stands alone has no pair; ties between centres
go to the smaller node, so the result does not depend on the order of rows; without names the result is empty.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.nameforms import edits, sound
from corvane.scratch import Scratch


def bands_for(similar: float, rows: int, recall: float) -> int:
    """Bands of ``rows`` hashes that find a pair of Jaccard similarity ``similar`` with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similar**rows))


def slip_similarity(letters: int, q: int) -> float:
    """Jaccard similarity of the padded q-grams of two words of ``letters`` letters with two neighbours swapped inside: of all
    single slips the one that leaves least in common."""
    grams, hit = letters + q - 1, q + 1
    return (grams - hit) / (grams + hit)


def qgrams(word: str, q: int) -> list[str]:
    """Different q-grams of a word padded on both sides."""
    padded = "#" * (q - 1) + word + "#" * (q - 1)
    return list(dict.fromkeys(padded[i : i + q] for i in range(len(padded) - q + 1)))


def slip_forms(word: str) -> list[str]:
    """The word, and the word without each letter: words of four letters or more that are one slip apart (a letter inserted,
    deleted or replaced, neighbours swapped) share a form. Shorter words have none, as ``close`` takes no slip in them."""
    return list(dict.fromkeys([word, *(word[:i] + word[i + 1 :] for i in range(len(word)))])) if len(word) >= 4 else []


class MinHash:
    """Band keys of words. The hash family is fixed by ``seed``; ``scheme`` goes into the keys."""

    def __init__(self, rows: int, bands: int, q: int = 2, seed: int = 11, scheme: int = 0):
        rng = np.random.default_rng(seed)
        self.rows, self.bands, self.q = rows, bands, q
        self.a = rng.integers(1, 2**63, rows * bands, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 2**63, rows * bands, dtype=np.uint64)
        self.mix = rng.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)
        self.number = np.arange(bands, dtype=np.uint64) + np.uint64(1000 * scheme)

    def keys(self, words: list[str]) -> np.ndarray:
        """Array (words, bands) of 64-bit keys; the band's number is part of a key."""
        grams, spans, ids = {}, [], []
        for w in words:
            own = [grams.setdefault(g, len(grams)) for g in qgrams(w, self.q)]
            spans.append(len(ids))
            ids.extend(own)
        codes = np.array([xxhash.xxh64_intdigest(g) for g in grams], dtype=np.uint64)
        with np.errstate(over="ignore"):
            table = ((codes[:, None] * self.a + self.b) >> np.uint64(32)).astype(np.uint32)
            low = np.minimum.reduceat(table[np.array(ids)], np.array(spans), axis=0).astype(np.uint64)
            low = low.reshape(len(words), self.bands, self.rows)
            key = (low * self.mix).sum(axis=2, dtype=np.uint64)
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + self.number * np.uint64(0x9E3779B97F4A7C15)
        return (key ^ (key >> np.uint64(32))).view(np.int64)


#: Lengths from which a scheme of bands holds, and the hashes a band of it.
SCHEMES = ((4, 2), (8, 3), (11, 3))


class Banding:
    """MinHash schemes by the length of the shorter word of a pair. Each has so many bands that a pair whose similarity is that
    of one slip in the shortest word it serves is missed with probability 1 - ``recall``. A word takes part in the scheme of
    its own length and in that of the length below, as a partner may be one letter shorter."""

    def __init__(self, recall: float = 0.97, q: int = 2):
        self.starts = [n for n, _ in SCHEMES]
        self.hashes = [MinHash(rows, bands_for(slip_similarity(n, q), rows, recall), q, scheme=i) for i, (n, rows) in enumerate(SCHEMES)]

    def schemes(self, letters: int) -> set[int]:
        """Schemes of a word; none below four letters, where no slip is taken."""
        return {bisect_right(self.starts, n) - 1 for n in (letters, letters - 1) if n >= self.starts[0]}

    def keys(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of words and their band keys."""
        where, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        at = [self.schemes(len(w)) for w in words]
        for i, minhash in enumerate(self.hashes):
            own = np.array([k for k, s in enumerate(at) if i in s], dtype=np.int64)
            if len(own):
                where.append(np.repeat(own, minhash.bands))
                keys.append(minhash.keys([words[k] for k in own]).ravel())
        return np.concatenate(where), np.concatenate(keys)


def letters_of(word: str) -> int:
    """Bits of the letters and digits that a word holds. One slip changes two of them at most."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) - 48 if c.isdigit() else ord(c) - 87) % 63
    return bits


def band_keys(nodes: DataFrame, banding: Banding, slips: bool = True, chunk: int = 2000) -> DataFrame:
    """(key, node, letters, size) of ``nodes(node bigint, own string, class string)``: band keys and, with ``slips``, those of the
    forms without one letter, with the word's letters and length; and the key of the sound, with neither."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), chunk):
                part = batch.iloc[at : at + chunk]
                words, nodes = part["own"].tolist(), part["node"].to_numpy()
                salt = np.array([xxhash.xxh64_intdigest(c) for c in part["class"]], dtype=np.uint64).view(np.int64)
                letters, size = np.array([letters_of(w) for w in words], dtype=np.int64), np.array([len(w) for w in words], dtype=np.int32)
                where, keys = banding.keys(words)
                if slips:
                    forms = [slip_forms(w) for w in words]
                    own = np.array([xxhash.xxh64_intdigest(f, seed=1) for of in forms for f in of], dtype=np.uint64).view(np.int64)
                    where, keys = np.concatenate([where, np.repeat(np.arange(len(words)), [len(of) for of in forms])]), np.concatenate([keys, own])
                yield pd.DataFrame({"key": keys ^ salt[where], "node": nodes[where], "letters": letters[where], "size": size[where]})
                heard = np.array([xxhash.xxh64_intdigest(sound(w), seed=2) for w in words], dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"key": heard ^ salt, "node": nodes, "letters": np.int64(0), "size": np.int32(0)})

    return nodes.mapInPandas(run, "key bigint, node bigint, letters bigint, size int")


def candidate_pairs(nodes: DataFrame, *, recall: float = 0.97, q: int = 2, slips: bool = True) -> DataFrame:
    """(a, b) of nodes of one class that sound alike, or share a band or a form without one letter and have the letters and
    lengths of words at most one slip apart; each pair once, a < b."""
    keys = band_keys(nodes.select("node", "own", "class"), Banding(recall, q), slips)
    left, right = keys.toDF("key", "a", "la", "na"), keys.toDF("key", "b", "lb", "nb")
    one_slip = (F.abs(F.col("na") - F.col("nb")) <= 1) & (F.bit_count(F.col("la").bitwiseXOR(F.col("lb"))) <= 2)
    # a row has as many keys as there are bands, which the planner does not see: without the hint it may broadcast them
    return left.hint("merge").join(right, "key").where((F.col("a") < F.col("b")) & one_slip).select("a", "b").distinct()


def monge_elkan(a: list[str], b: list[str]) -> float:
    """Symmetric Monge-Elkan similarity: each word's best match, averaged, over both directions."""
    if not a or not b:
        return 0.0

    def one_way(x: list[str], y: list[str]) -> float:
        return sum(max(_word_similarity(p, r) for r in y) for p in x) / len(x)

    return (one_way(a, b) + one_way(b, a)) / 2


def _word_similarity(p: str, r: str) -> float:
    if p == r or sound(p) == sound(r):
        return 1.0
    d = edits(p, r, 2)
    return 1 - d / max(len(p), len(r)) if d <= 2 else 0.0


def close(a: str, b: str, supported: bool) -> bool:
    """Own parts that may be one: one slip of the pen, or equal sound; two or three slips where other evidence supports it."""
    d = edits(a, b, 3)
    n = min(len(a), len(b))
    if n < 4:
        return d == 0
    if d <= 1 or (d <= 3 and sound(a) == sound(b)):
        return True
    return supported and d <= (3 if n >= 7 else 2)


def verify(pairs: DataFrame, least: float = 0.8) -> DataFrame:
    """The pairs ``(a, b, own_a, own_b, words_a, words_b, supported)`` that are variants: (a, b)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                close(x, y, s) and monge_elkan(v.split(), w.split()) >= least
                for x, y, v, w, s in zip(batch["own_a"], batch["own_b"], batch["words_a"], batch["words_b"], batch["supported"])
            ]
            yield batch.loc[keep, ["a", "b"]]

    return pairs.mapInPandas(run, "a bigint, b bigint")


def star_clusters(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, star) of ``edges(a, b)``: in each round, a node whose degree is the highest among its free neighbours (ties:
    smallest id) becomes a centre and takes its free neighbours; a node between two centres goes to the stronger."""
    both = scratch.keep(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    done = None
    for _ in range(max_rounds):
        degree = both.groupBy("a").agg(F.count("*").alias("d"))
        rank = scratch.keep(degree.select("a", "d"))
        ranked = both.join(rank, "a").join(rank.select(F.col("a").alias("b"), F.col("d").alias("db")), "b")
        beaten = (F.col("db") > F.col("d")) | ((F.col("db") == F.col("d")) & (F.col("b") < F.col("a")))
        centres = ranked.groupBy("a").agg(F.max(beaten.cast("int")).alias("x"), F.max("d").alias("d")).where("x = 0").select("a", "d")
        centres = scratch.keep(centres)
        taken = both.join(centres, "a").groupBy("b").agg(F.max(F.struct("d", (-F.col("a")).alias("a"))).alias("r"))
        round_ = taken.select(F.col("b").alias("node"), (-F.col("r.a")).alias("star")).union(centres.select("a", "a"))
        round_ = scratch.keep(round_)
        done = round_ if done is None else done.union(round_)
        gone = round_.select(F.col("node").alias("a"))
        rest = scratch.keep(both.join(gone, "a", "left_anti").join(gone.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b"))
        scratch.drop(both)
        both = rest
        if both.isEmpty():
            return done
    raise RuntimeError("star clustering did not end")


def entities(names: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(name, star) of ``names(name, node)`` after clustering the ``links(a, b)`` of nodes; a node without a link is a star of its
    own. The names of a star are the spellings of one entity."""
    stars = star_clusters(links, scratch) if not links.isEmpty() else links.select(F.col("a").alias("node"), F.col("b").alias("star"))
    placed = names.join(stars, "node", "left").select("name", F.coalesce("star", "node").alias("star")).distinct()
    return scratch.keep(placed)


def spelling_pairs(placed: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b, of all names of one star, each pair once."""
    a, b = placed.withColumnRenamed("name", "name_a"), placed.withColumnRenamed("name", "name_b")
    return a.join(b, "star").where("name_a < name_b").select("name_a", "name_b").distinct()
