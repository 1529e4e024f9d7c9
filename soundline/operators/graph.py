"""Nodes, chains and local graph operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_nodes(made: DataFrame) -> DataFrame:
    """First creator of a place keeps it. made(lon_e5, lat_e5, node_type, stage, seq, kind)."""
    first = F.min_by(F.struct("node_type", "stage", "seq"), F.struct("stage", "seq")).alias("f")
    last = F.max_by("kind", F.struct("stage", "seq")).alias("kind")
    return made.groupBy("lon_e5", "lat_e5").agg(first, last).select("lon_e5", "lat_e5", "f.node_type", "f.stage", "kind")


def polyline_arcs(points: DataFrame, line: str = "line_id", seq: str = "seq", node: str = "node") -> DataFrame:
    """Both arcs of each step between consecutive points of a line; steps onto the same node fall away."""
    step = points.select(line, F.col(node).alias("u"), F.lead(node).over(Window.partitionBy(line).orderBy(seq)).alias("v")).filter("v is not null and u <> v")
    return step.select(line, "u", "v").union(step.select(line, F.col("v").alias("u"), F.col("u").alias("v")))


def ring_arcs(rings: DataFrame, ring: str = "ring_id") -> DataFrame:
    """rings(ring_id, seq, x, y): each corner with the next, the last with the first."""
    w = Window.partitionBy(ring).orderBy("seq")
    at = F.struct("x", "y")
    nxt = F.coalesce(F.lead(at).over(w), F.first(at).over(w))
    return rings.select(ring, "seq", "x", "y", nxt.alias("n")).select(ring, "seq", "x", "y", F.col("n.x").alias("nx"), F.col("n.y").alias("ny"))


def resample(steps: DataFrame, limit: float, chain: str = "chain_id", seq: str = "seq", length: str = "length") -> DataFrame:
    """Segment number of each step: a segment ends with the step that brings it to limit or more."""
    rows = steps.groupBy(chain).agg(F.array_sort(F.collect_list(F.struct(seq, length))).alias("s"))
    walk = F.aggregate(
        "s",
        F.struct(F.lit(0.0).alias("acc"), F.lit(0).alias("seg"), F.expr("cast(array() as array<int>)").alias("out")),
        lambda a, x: F.when(a["acc"] + x[length] >= limit, F.struct(F.lit(0.0).alias("acc"), (a["seg"] + 1).alias("seg"), F.array_append(a["out"], a["seg"]).alias("out"))).otherwise(F.struct((a["acc"] + x[length]).cast("double").alias("acc"), a["seg"].alias("seg"), F.array_append(a["out"], a["seg"]).alias("out"))),
        lambda a: a["out"],
    )
    return rows.select(chain, F.explode(F.arrays_zip(F.col("s"), walk.alias("segment"))).alias("z")).select(chain, F.col(f"z.s.{seq}").alias(seq), F.col("z.segment").alias("segment"))


def thin(hits: DataFrame, gap: float, line: str = "line_id", at: str = "at", x: str = "x", y: str = "y") -> DataFrame:
    """Along each line, in the order of at, keeps a hit if it lies gap or more from every hit kept before."""
    rows = hits.groupBy(line).agg(F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))).alias("s"))
    far = lambda p: lambda q: (p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]) >= gap * gap
    kept = F.aggregate("s", F.slice("s", 1, 0), lambda a, p: F.when(F.forall(a, far(p)), F.array_append(a, p)).otherwise(a))
    return rows.select(line, F.explode(kept).alias("p")).select(line, F.col("p.at").alias(at))


def first_n(df: DataFrame, n: int, group: str, *order) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rn") <= n).drop("rn")


def numbered(df: DataFrame, order: str, to: str) -> DataFrame:
    """df with numbers from 1 in the order of a column of distinct values; meant for catalogs, which are small."""
    return df.withColumn(to, F.row_number().over(Window.orderBy(order)).cast("long"))


def systematic_sample(df: DataFrame, most: int, group: str, order: str) -> DataFrame:
    """Every step-th row of each group, most rows over all groups."""
    w = Window.partitionBy(group)
    groups = df.select(group).distinct().agg(F.greatest(F.lit(1), F.floor(F.lit(most) / F.greatest(F.count("*"), F.lit(1)))).alias("cap"))
    d = df.crossJoin(F.broadcast(groups)).withColumn("n", F.count("*").over(w)).withColumn("rn", F.row_number().over(w.orderBy(order)))  # one row
    step = F.greatest(F.lit(1), F.floor(F.col("n") / F.col("cap")))
    return d.filter(((F.col("rn") - 1) % step == 0) & (F.floor((F.col("rn") - 1) / step) < F.col("cap"))).drop("n", "rn", "cap")


def degrees(edges: DataFrame) -> DataFrame:
    """Undirected degree of each node of edges(u, v)."""
    e = edges.filter("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    return e.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("degree"))


def dead_ends(edges: DataFrame) -> DataFrame:
    return degrees(edges).filter("degree = 1").select("k")


def prune_spurs_once(edges: DataFrame, shortest: float) -> DataFrame:
    """edges(u, v, length) without those shorter than `shortest` that end at a node of degree 1."""
    ends = dead_ends(edges)
    short = edges.filter(F.col("length") < shortest)
    spur = short.join(ends, short.u == ends.k, "left_semi").union(short.join(ends, short.v == ends.k, "left_semi"))
    return edges.join(spur.select("u", "v").distinct(), ["u", "v"], "left_anti")


def prune_spurs(edges: DataFrame, shortest: float) -> DataFrame:
    """prune_spurs_once until nothing changes."""
    from .components import written

    n = -1
    while (now := (edges := written(edges)).count()) != n:
        n, edges = now, prune_spurs_once(edges, shortest)
    return edges


def quadrant_nearest(pairs: DataFrame) -> DataFrame:
    """The nearest r of each l in each quadrant around it, of (l, r, d2) with points (k, x, y)."""
    q = F.when(F.col("r.x") >= F.col("l.x"), F.when(F.col("r.y") >= F.col("l.y"), 0).otherwise(3)).otherwise(F.when(F.col("r.y") >= F.col("l.y"), 1).otherwise(2))
    w = Window.partitionBy("l.k", "quadrant").orderBy("d2", "r.k")
    return pairs.filter("l.k <> r.k").withColumn("quadrant", q).withColumn("rn", F.row_number().over(w)).filter("rn = 1").select(F.col("l.k").alias("k"), "quadrant", F.col("r.k").alias("near"), "d2")


def capped_connectors(candidates: DataFrame, existing: DataFrame, cap: int) -> DataFrame:
    """Greedy links of candidates(a, b, d2), nearest first, with at most cap links at each node, existing(u, v) included.

    Rounds take the links that are among the nearest that both their nodes still have room for, which are those that
    one walk over all of them in order takes. Pairs that are linked already are no candidates.
    """
    from .components import written

    pair = lambda df, a, b: df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    links = written(pair(existing, "u", "v").distinct())
    c = candidates.select("a", "b", "d2", F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b")).filter("a <> b").distinct()
    c = written(c.join(links.toDF("_a", "_b"), ["_a", "_b"], "left_anti").select("a", "b", "d2"))
    used = links.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    found = c.limit(0)
    while not c.isEmpty():
        ends = c.select("a", "b", "d2", F.explode(F.array("a", "b")).alias("k")).join(used, "k", "left")
        ends = ends.withColumn("room", F.lit(cap) - F.coalesce("n", F.lit(0))).withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("d2", "a", "b")))
        state = written(ends.groupBy("a", "b", "d2").agg(F.min(F.col("rank") <= F.col("room")).alias("taken"), F.min("room").alias("room")).filter("room > 0"))
        new = state.filter("taken").select("a", "b", "d2")
        found = found.unionByName(new)
        used = written(used.unionByName(new.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("n"))).groupBy("k").agg(F.sum("n").alias("n")))
        c = state.filter("not taken").select("a", "b", "d2")
    return found


def stitch(candidates: DataFrame, pieces: DataFrame) -> DataFrame:
    """Links of candidates(a, b, d2), nearest first, that join two of pieces(k, component) each.

    In rounds each piece takes its nearest link, and pieces so joined become one. As (d2, a, b) orders all links, these
    are the links that one walk over all of them in order takes.
    """
    from .components import connected_components, written

    c = candidates.select("a", "b", "d2").distinct()
    c = c.join(pieces.select(F.col("k").alias("a"), F.col("component").alias("p")), "a").join(pieces.select(F.col("k").alias("b"), F.col("component").alias("q")), "b")
    c = written(c.filter("p <> q").select("a", "b", "d2", "p", "q"))
    found = c.limit(0).select("a", "b", "d2")
    while not c.isEmpty():
        best = c.select(F.explode(F.array("p", "q")).alias("piece"), F.struct("d2", "a", "b", "p", "q").alias("e")).groupBy("piece").agg(F.min("e").alias("e"))
        best = written(best.select("e.*").distinct())
        found = found.unionByName(best.select("a", "b", "d2"))
        joined = connected_components(best.select(F.col("p").alias("u"), F.col("q").alias("v")), best.select(F.explode(F.array("p", "q")).alias("k")).distinct())
        c = c.join(joined.toDF("p", "_p"), "p").join(joined.toDF("q", "_q"), "q").filter("_p <> _q")
        c = written(c.select("a", "b", "d2", F.col("_p").alias("p"), F.col("_q").alias("q")))
    return found
