"""Spatial joins as equi-joins on grid cells with an exact residual, so that no plan falls back to a nested loop.

A box is dealt to every cell it touches; a pair is kept in the one cell that holds the larger of the two lower-left
corners, so no distinct is needed. Boxes are columns minx, miny, maxx, maxy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOX = ("minx", "miny", "maxx", "maxy")


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def _deal(df: DataFrame, box: tuple, margin: float, size: float, name: str) -> DataFrame:
    x0, y0, x1, y1 = (F.col(c) for c in box)
    xs = F.sequence(_cell(x0 - margin, size), _cell(x1 + margin, size))
    ys = F.sequence(_cell(y0 - margin, size), _cell(y1 + margin, size))
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.select(row.alias(name), (x0 - margin).alias(f"{name}x"), (y0 - margin).alias(f"{name}y"), F.explode(xs).alias("cx"), ys.alias("ys")).select(name, f"{name}x", f"{name}y", "cx", F.explode("ys").alias("cy"))


def box_join(left: DataFrame, right: DataFrame, on: Column | None = None, margin: float = 0, size: float = 2000, left_box: tuple = BOX, right_box: tuple = BOX) -> DataFrame:
    """Pairs (l, r) of rows whose boxes, the left one grown by margin, overlap and for which `on` over l and r holds.

    Sides are never broadcast: plans know the size of the tables a side comes from, not of the boxes dealt from them.
    """
    l, r = _deal(left, left_box, margin, size, "l"), _deal(right, right_box, 0, size, "r")
    at_home = (F.col("cx") == _cell(F.greatest("lx", "rx"), size)) & (F.col("cy") == _cell(F.greatest("ly", "ry"), size))
    a, b = (lambda i: F.col(f"l.{left_box[i]}")), (lambda i: F.col(f"r.{right_box[i]}"))
    meet = (a(0) - margin <= b(2)) & (a(2) + margin >= b(0)) & (a(1) - margin <= b(3)) & (a(3) + margin >= b(1))
    pairs = l.join(r.hint("merge"), ["cx", "cy"]).filter(at_home & meet)
    return (pairs if on is None else pairs.filter(on)).select("l", "r")


def radius_join(left: DataFrame, right: DataFrame, radius: float, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs (l, r, d2) of points at most radius apart; d2 is the squared distance."""
    r = right.select(F.struct("*").alias("r"), _cell(F.col(x), radius).alias("cx"), _cell(F.col(y), radius).alias("cy"))
    near = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    l = left.select(F.struct("*").alias("l"), F.explode(near).alias("o"), _cell(F.col(x), radius).alias("cx"), _cell(F.col(y), radius).alias("cy"))
    l = l.select("l", (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"))
    dx, dy = F.col(f"l.{x}") - F.col(f"r.{x}"), F.col(f"l.{y}") - F.col(f"r.{y}")
    return l.join(r, ["cx", "cy"]).select("l", "r", (dx * dx + dy * dy).alias("d2")).filter(F.col("d2") <= radius * radius)


def knn_join(left: DataFrame, right: DataFrame, k: int, key: str = "k", x: str = "x", y: str = "y", reach: float = 2000, exclude: Column | None = None) -> DataFrame:
    """(l, r, d2, rank): the k nearest of right for each of left, ties by right's key.

    The reach doubles for those rows alone that haven't k within it, until it covers all of both sides; a row that still
    has fewer has met all of right. A pair found within the reach is exact, since every nearer point lies within it too.
    """
    from .components import written

    found, todo = None, left
    ends = left.select(x, y).union(right.select(x, y)).agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    extent = 0 if ends[0] is None else ((ends[1] - ends[0]) ** 2 + (ends[3] - ends[2]) ** 2) ** 0.5
    while True:
        pairs = radius_join(todo, right, reach, x, y)
        if exclude is not None:
            pairs = pairs.filter(~exclude)
        w = Window.partitionBy(F.col(f"l.{key}")).orderBy("d2", F.col(f"r.{key}"))
        top = written(pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
        if reach >= extent:
            return top if found is None else found.unionByName(top)
        have = top.groupBy(F.col(f"l.{key}").alias("_k")).agg(F.max("rank").alias("n")).filter(F.col("n") == k)
        done = top.join(have, F.col(f"l.{key}") == F.col("_k"), "left_semi")
        found = done if found is None else found.unionByName(done)
        todo = written(todo.join(have, F.col(key) == F.col("_k"), "left_anti"))
        if todo.isEmpty():
            return found
        reach *= 2
