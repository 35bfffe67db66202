"""Consolidating pairwise matches into groups: connected components on a two-dimensional grid.

Vertices are hashed into ``b`` blocks, so an edge belongs to the cell (block of one end, block of the other).
Each cell runs a local union-find over its edges and hands back one representative for every vertex it saw.
A vertex then exchanges the representatives of its row and its column of cells (at most ``2 b - 1``): the
smallest becomes its parent, the others are linked to it. Parents are followed until they stabilise, edges are
rewritten to parents, and the next round runs over what is left, until no edge is left.

Only representatives are carried on, so the graph shrinks every round. A hub's edges are spread over the
cells of its row; the exchange is an aggregation with map-side combine; the union-find of a task hands over and
starts again when it holds ``memory_vertices`` vertices, so no task holds an unbounded group. What awkward edges give is
said at ``connected_components``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.scratch import Scratch


class Forest:
    """Union-find over texts; the root of a tree is its smallest member."""

    def __init__(self):
        self.parent: dict[str, str] = {}

    def root(self, x: str) -> str:
        parent = self.parent
        top = parent.setdefault(x, x)
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, x: str, y: str) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def rows(self) -> pd.DataFrame:
        members = list(self.parent)
        return pd.DataFrame({"v": members, "rep": [self.root(x) for x in members]})


def _local_forests(memory_vertices: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest()
        for batch in batches:
            for u, v in zip(batch["u"], batch["v"]):
                forest.join(u, v)
            if len(forest.parent) > memory_vertices:
                yield forest.rows()
                forest = Forest()
        if forest.parent:
            yield forest.rows()

    return run


def _canonical(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges without order, direction, repetition, loops and NULL ends."""
    low, high = F.least(a, b), F.greatest(a, b)
    return edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(low.alias("u"), high.alias("v")).distinct()


def connected_components(
    edges: DataFrame, a: str, b: str, *, cell_edges: int = 500_000, memory_vertices: int = 2_000_000, max_rounds: int = 100
) -> DataFrame:
    """(id, group_id) of every text that has an edge to another; ``group_id`` is the smallest member by code point.

    NULL ends and loops are no edges; repeated and reversed edges count once; a table without edges gives no rows;
    other columns are ignored. ``cell_edges`` sets the number of blocks, ``memory_vertices`` when a task's forest is
    handed over. Raises if ``max_rounds`` do not suffice; it never returns unfinished groups.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark)
    left = scratch.keep(_canonical(edges.select(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)), a, b))
    parents: list[DataFrame] = []
    for _ in range(max_rounds):
        n = left.count()
        if not n:
            break
        blocks = max(1, math.ceil(math.sqrt(n / cell_edges)), min(4, math.ceil(math.sqrt(n / 20_000))))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
        cells = left.repartitionById(blocks * blocks, (block("u") * blocks + block("v")).cast("int"))  # a task a cell
        reps = cells.mapInPandas(_local_forests(memory_vertices), "v string, rep string")
        exchanged = scratch.keep(reps.groupBy("v").agg(F.min("rep").alias("parent"), F.collect_set("rep").alias("reps")))
        jump = _stable(scratch, exchanged.where("parent <> v").select("v", "parent"))
        parents.append(jump)
        rest = exchanged.where(F.size("reps") > 1).select("parent", F.explode("reps").alias("rep")).where("rep <> parent")
        moved = _follow(_follow(rest, "parent", jump), "rep", jump)
        after = scratch.keep(_canonical(moved, "parent", "rep"))
        scratch.drop(left)
        scratch.drop(exchanged)
        left = after
    else:
        raise RuntimeError(f"components are not stable after {max_rounds} rounds")
    if not parents:
        return left.select(F.col("u").alias("id"), F.col("v").alias("group_id"))
    labels = parents[-1]
    for jump in reversed(parents[:-1]):
        labels = _follow(jump, "parent", labels).unionByName(labels.join(jump.select("v"), "v", "left_anti"))
    labels = scratch.keep(labels)
    roots = labels.select(F.col("parent").alias("v")).distinct().withColumn("parent", F.col("v"))
    return labels.unionByName(roots).select(F.col("v").alias("id"), F.col("parent").alias("group_id"))


def _follow(df: DataFrame, column: str, jump: DataFrame) -> DataFrame:
    """``column`` replaced by its parent where it has one."""
    at = jump.select(F.col("v").alias("__at"), F.col("parent").alias("__to"))
    kept = [c for c in df.columns if c != column]
    return df.join(at, F.col(column) == F.col("__at"), "left").select(*kept, F.coalesce("__to", column).alias(column))


def _stable(scratch: Scratch, parents: DataFrame) -> DataFrame:
    """Parents of parents until nothing moves; a parent is smaller than its child, so this ends."""
    parents = scratch.keep(parents)
    while True:
        above = parents.select(F.col("v").alias("parent"), F.col("parent").alias("above"))
        if parents.join(above, "parent", "left_semi").isEmpty():
            return parents
        jumped = scratch.keep(parents.join(above, "parent", "left").select("v", F.coalesce("above", "parent").alias("parent")))
        scratch.drop(parents)
        parents = jumped
