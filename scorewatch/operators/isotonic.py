"""Isotonic regression on executors: neighbouring blocks that fall are pooled, cell by cell, until none falls."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from . import ordered

BLOCKS = "lo double, hi double, s double, w double"


def pool(lows, highs, sums, weights) -> tuple[list, list, list, list]:
    """Blocks in order, with every one that does not rise above the block before it pooled with that."""
    lo, hi, s, w = [], [], [], []
    for a, b, t, n in zip(lows, highs, sums, weights):
        while s and s[-1] * n >= t * w[-1]:
            a, t, n = lo.pop(), s.pop() + t, w.pop() + n
            hi.pop()
        lo.append(a)
        hi.append(b)
        s.append(t)
        w.append(n)
    return lo, hi, s, w


def _pool_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by cell and lo; a cell is pooled when it is complete."""
    held: list[pd.DataFrame] = []

    def done() -> pd.DataFrame:
        cell = pd.concat(held, ignore_index=True)
        columns = pool(*(cell[c].tolist() for c in ("lo", "hi", "s", "w")))
        return pd.DataFrame(dict(zip(("lo", "hi", "s", "w"), columns)))

    for frame in frames:
        for cell, rows in frame.groupby("cell", sort=False):
            if held and held[0]["cell"].iloc[0] != cell:
                yield done()
                held = []
            held.append(rows)
    if held:
        yield done()


def pooled(blocks: DataFrame, cuts: tuple[float, ...]) -> tuple[DataFrame, bool]:
    """Blocks pooled within cells, and whether any cell begins no higher than the one before it ends."""
    cells = ordered.with_cell(blocks, "lo", cuts)
    found = cells.repartition("cell").sortWithinPartitions("cell", "lo").mapInPandas(_pool_cells, BLOCKS)
    found = materialise(found, "blocks")
    if not cuts:
        return found, False
    value = F.col("s") / F.col("w")
    ends = ordered.with_cell(found, "lo", cuts).groupBy("cell").agg(F.min_by(value, "lo").alias("first"), F.max_by(value, "lo").alias("last"))
    before = F.lag("last").over(Window.partitionBy().orderBy("cell"))  # one row per cell
    falls = ends.select((before >= F.col("first")).alias("falls")).where("falls")
    return found, not falls.isEmpty()


def isotonic_steps(df: DataFrame, score: str, label: str, rows_per_cell: int | None = None) -> DataFrame:
    """The increasing fit of ``label`` on ``score`` as steps: lo, hi, value, weight; written, in no order.

    Equal scores are one point weighted by its rows. Points are cut into cells
    of balanced size, each pooled on its own; then cells are cut anew half a
    cell further, so that what was a border lies inside, until no block falls
    across a border. Pooling neighbours that fall in any order gives the same
    fit, so cells change nothing. A task holds the blocks of two cells at
    most, and the driver the cut points. Rows without score or label are left
    out; without any rows there are no steps.
    """
    given = df.select(F.col(score).cast("double").alias("lo"), F.col(label).cast("double").alias("y")).where("lo IS NOT NULL AND NOT isnan(lo) AND y IS NOT NULL")
    points = given.groupBy("lo").agg(F.sum("y").alias("s"), F.count(F.lit(1)).cast("double").alias("w"))
    blocks = materialise(points.select("lo", F.col("lo").alias("hi"), "s", "w"), "blocks")
    falls = True
    while falls:
        cuts = ordered.sketch_columns(blocks, ["lo"], rows_per_cell)["lo"].cuts
        blocks, falls = pooled(blocks, cuts)
        if falls:
            middle = sorted({(a + b) / 2 for a, b in zip(cuts, cuts[1:])})
            blocks, falls = pooled(blocks, tuple(middle))
    return blocks.select("lo", "hi", (F.col("s") / F.col("w")).alias("value"), F.col("w").alias("weight"))


def apply_steps(scores: DataFrame, score: str, steps: DataFrame, out: str, rows_per_cell: int | None = None) -> DataFrame:
    """Add the fitted value of each score: a step's own, between two steps the straight line, beyond them the nearest.

    Each distinct score is placed once, among the steps of its cell; the step
    before a cell and the one behind it come from one row per cell. Null
    scores have no value.
    """
    step = F.struct("lo", "hi", "value")
    marks = steps.select(F.col("lo").alias("x"), F.lit(0).alias("kind"), step.alias("step"))
    distinct = scores.select(F.col(score).cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)").distinct()
    both = materialise(marks.unionByName(distinct.select("x", F.lit(1).alias("kind")), allowMissingColumns=True), "marks")
    cuts = ordered.sketch_columns(both, ["x"], rows_per_cell)["x"].cuts
    cells = ordered.with_cell(both, "x", cuts)
    if cuts:
        of_step = F.when(F.col("kind") == 0, F.col("x"))
        ends = cells.groupBy("cell").agg(F.min_by("step", of_step).alias("first"), F.max_by("step", of_step).alias("last"))
        along = Window.partitionBy().orderBy("cell")  # one row per cell
        ends = ends.select(
            "cell", F.last("last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
            F.first("first", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("later"),
        )
        cells = cells.join(F.broadcast(ends), "cell")
    else:
        none = F.lit(None).cast(both.schema["step"].dataType)
        cells = cells.withColumns({"earlier": none, "later": none})
    within = Window.partitionBy("cell").orderBy("x", "kind")
    placed = cells.select(
        "x", "kind",
        F.coalesce(F.last("step", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0)), "earlier").alias("a"),
        F.coalesce(F.first("step", ignorenulls=True).over(within.rowsBetween(1, Window.unboundedFollowing)), "later").alias("b"),
    ).where("kind = 1")
    between = F.col("a.value") + (F.col("b.value") - F.col("a.value")) * (F.col("x") - F.col("a.hi")) / (F.col("b.lo") - F.col("a.hi"))
    value = F.when(F.col("a").isNull(), F.col("b.value")).when((F.col("x") <= F.col("a.hi")) | F.col("b").isNull(), F.col("a.value")).otherwise(between)
    placed = placed.select(F.col("x").alias("__x"), value.alias(out))
    return scores.join(placed, F.col(score).cast("double") == F.col("__x"), "left").drop("__x")
