"""Connected components of an edge table, by alternating large-star and small-star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


#: Nodes of most edges whose rows are joined by a broadcast, and the edges from which a node can be one.
HUBS, HUB_EDGES = 1000, 256


def _with_least(rows: DataFrame, neighbours: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``rows`` (a, b) with m, the least of a's ``neighbours``.

    The minima are found with a partial one in each task, and written, as several plans read them. Those of
    the HUBS largest nodes, a table of bounded size, are broadcast, so the edges of a hub are joined where they
    lie; a node among the others has less than one in HUBS of all edges. Without a hub there is one plain join.
    """
    least = scratch.table(neighbours.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), f"{name}-least", few=True)
    large = least.where(F.col("n") > HUB_EDGES)
    if large.isEmpty():
        return rows.join(least.select("a", "m"), "a").select("a", "b", "m")
    hubs = large.orderBy(F.col("n").desc(), "a").limit(HUBS).select(F.col("a").alias("_a"), F.col("m").alias("_m"))
    marked = rows.join(F.broadcast(hubs), F.col("a") == F.col("_a"), "left")
    own = marked.where(F.col("_a").isNotNull()).select("a", "b", F.col("_m").alias("m"))
    return own.union(marked.where(F.col("_a").isNull()).select("a", "b").join(least.select("a", "m"), "a"))


def _large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = _with_least(both.where(F.col("b") > F.col("a")), both, scratch, name)
    return moved.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where(F.col("a") != F.col("b")).distinct()


def _small_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    moved = _with_least(down, down, scratch, name)
    # the least neighbour itself would become a loop; its edge to the node stays
    return moved.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.shiftright(F.xxhash64("a", "b"), 20)), F.lit(0)).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node that has an edge; ``root`` is the least node of its component.

    ``edges``: two columns of one orderable type, nulls and loops ignored. Each star of a round writes its edges
    to scratch, so lineage stays short, a lost executor costs one star, and no plan holds another star's twice,
    which would multiply the exchanges and broadcasts that the driver keeps at once. Rounds grow with the
    logarithm of the graph's size. The driver sees a count and a checksum per round, never an edge.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()
    now = scratch.table(edges, f"{name}-0", few=True)
    state, step = _state(now), 0
    while state[0]:
        step += 1
        large = scratch.table(_large_star(now, scratch, f"{name}-large-{step}"), f"{name}-large-{step}", few=True)
        scratch.drop(f"{name}-{step - 1}", f"{name}-large-{step}-least")
        now = scratch.table(_small_star(large, scratch, f"{name}-small-{step}"), f"{name}-{step}", few=True)
        scratch.drop(f"{name}-large-{step}", f"{name}-small-{step}-least")
        last, state = state, _state(now)
        if state == last:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def local_roots(n: int, left, right) -> list[int]:
    """Least member of each of ``n`` nodes' component under the links left[i] - right[i]."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left, right, strict=True):
        a, b = find(int(a)), find(int(b))
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
