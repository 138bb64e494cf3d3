"""Ordered work without one giant sort group.

Ranks, running sums and exact quantiles need rows in value order. A window over
a whole column would put that column into one task, so the value range is cut
into *cells* of about equal weight. Cells are sorted independently, each cell is
reduced to one row, and only those few rows (at most ``MAX_CELLS`` per group)
are combined in order.

Cut points come from mergeable KLL sketches and reach the plan as literals: they
balance the work and never influence a result, and a retried task sees the very
same cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import local_table, materialise

ROWS_PER_CELL = 1_000_000
MAX_CELLS = 4096
SKETCH_SIZE = 1024
MERGE_GROUPS = 64


@dataclass(frozen=True)
class ColumnSketch:
    """Row count, extremes and cut points of one numeric column."""

    rows: int
    low: float | None
    high: float | None
    cuts: tuple[float, ...]


def _clean(name: str) -> Column:
    """The column as double with NaN read as missing."""
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def _cut_points(spark, sketches: dict[str, bytes], parts: dict[str, int]) -> dict[str, tuple[float, ...]]:
    """Evenly spaced quantiles of each sketch."""
    names = list(sketches)
    held = spark.createDataFrame(
        [tuple(sketches[c] for c in names)], ", ".join(f"k{i} binary" for i in range(len(names)))
    )
    ranks = [",".join(repr(j / parts[c]) for j in range(1, parts[c])) for c in names]
    row = held.select(
        *[
            # A constant array, written as text to keep the plan small.
            F.kll_sketch_get_quantile_double(f"k{i}", F.split(F.lit(ranks[i]), ",").cast("array<double>"))
            for i in range(len(names))
        ]
    ).collect()[0]
    return {c: tuple(sorted(set(row[i]))) for i, c in enumerate(names)}


def sketch_columns(df: DataFrame, columns: Sequence[str], rows_per_cell: int | None = None) -> dict[str, ColumnSketch]:
    """Sketch several columns in one scan; at most ``MAX_CELLS`` numbers per column reach the driver."""
    if not columns:
        return {}
    per_cell = rows_per_cell or ROWS_PER_CELL
    slim = df.select(*[_clean(c).alias(f"v{i}") for i, c in enumerate(columns)])
    measures = (("n", F.count), ("lo", F.min), ("hi", F.max))
    row = slim.agg(*[f(f"v{i}").alias(f"{p}{i}") for p, f in measures for i in range(len(columns))]).collect()[0]
    parts = {c: min(MAX_CELLS, math.ceil(row[f"n{i}"] / per_cell)) for i, c in enumerate(columns)}
    large = {c: f"v{i}" for i, c in enumerate(columns) if parts[c] > 1 and row[f"lo{i}"] < row[f"hi{i}"]}
    cuts = _cut_points(df.sparkSession, _sketches(slim, large), parts) if large else {}
    return {
        c: ColumnSketch(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], cuts.get(c, ())) for i, c in enumerate(columns)
    }


def _sketches(slim: DataFrame, columns: dict[str, str]) -> dict[str, bytes]:
    """One KLL sketch per column; task sketches are merged in a few groups first, never all in one task."""
    partial = slim.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("g")).agg(
        *[F.kll_sketch_agg_double(v, SKETCH_SIZE).alias(v) for v in columns.values()]
    )
    row = partial.agg(*[F.kll_merge_agg_double(v).alias(v) for v in columns.values()]).collect()[0]
    return {c: bytes(row[v]) for c, v in columns.items()}


def with_cell(df: DataFrame, column: str, cuts: Sequence[float], out: str = "cell") -> DataFrame:
    """Add the number of the cell that holds ``column``; never decreasing in the column.

    Rows whose ``column`` is null must have been removed.
    """
    if not cuts:
        return df.withColumn(out, F.lit(0))
    raw = f"__{out}"
    splits = [-math.inf, *cuts, math.inf]
    bucketed = Bucketizer(splits=splits, inputCol=f"__in_{out}", outputCol=raw, handleInvalid="keep").transform(
        df.withColumn(f"__in_{out}", F.col(column).cast("double"))
    )
    return bucketed.withColumn(out, F.col(raw).cast("int")).drop(raw, f"__in_{out}")


def balanced_cells(
    df: DataFrame, column: str, cuts: Sequence[float] | None = None, rows_per_cell: int | None = None
) -> DataFrame:
    """``with_cell`` with cut points measured on ``df`` unless they are given."""
    if cuts is None:
        cuts = sketch_columns(df, [column], rows_per_cell)[column].cuts
    return with_cell(df, column, cuts)


def running_in_cell(by: Sequence[str], order: Sequence[str], include_current: bool):
    """Frame from the start of a cell up to (or just before) the current row."""
    return (
        Window.partitionBy(*by, "cell")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )


def cells_before(by: Sequence[str]):
    """Frame over the earlier cells of a group, applied to one row per cell."""
    return Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, order: Sequence[str], out: str) -> tuple[DataFrame, int]:
    """Add the place of each row from 0 in the order given, which must be total; and the number of rows.

    Rows are sorted in ranges and written; a range's rows are numbered on their
    own, from where the ranges before it end. The driver sees one number per range.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = materialise(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = sorted(tuple(r) for r in ranges.groupBy("__part").count().collect())
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    if not starts:
        return ranges.drop("__part").withColumn(out, F.lit(None).cast("bigint")), 0
    before = local_table(df.sparkSession, starts, "__part int, __start bigint")
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    joined = ranges.withColumn("__place", place).join(F.broadcast(before), "__part")
    return joined.withColumn(out, (F.col("__place") + F.col("__start")).cast("bigint")).drop("__part", "__place", "__start"), total


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row from several one-row tables with different columns; no join."""
    stacked = rows[0]
    for other in rows[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


# ---- exact order statistics --------------------------------------------------


@dataclass(frozen=True)
class Located:
    """An order statistic, the number of rows strictly below it and of those equal to it."""

    value: float
    below: int
    rows: int


@dataclass(frozen=True)
class _Span:
    """Open value interval that holds wanted ranks."""

    column: str
    low: float
    high: float
    below: int
    rows: int
    ranks: tuple[int, ...]

    def holds(self) -> Column:
        value = F.col(self.column)
        return (value > self.low) & (value < self.high)


def order_statistics(
    df: DataFrame,
    ranks: dict[str, Iterable[int]],
    sketches: dict[str, ColumnSketch] | None = None,
    rows_per_cell: int | None = None,
) -> dict[str, dict[int, Located]]:
    """Exact values at 0-based ranks of several numeric columns (missing values left out).

    Large columns are narrowed by counting rows per cell, which shuffles a few
    thousand rows however big the table is; only the cells that hold a wanted
    rank are read again. Frequent values become cells of their own.
    """
    per_cell = rows_per_cell or ROWS_PER_CELL
    found: dict[str, dict[int, Located]] = {c: {} for c in ranks}
    columns = [c for c in ranks if set(ranks[c])]
    sketches = sketches or sketch_columns(df, columns, per_cell)
    slim = df.select(*[_clean(c).alias(c) for c in columns])

    points = {c: sketches[c].cuts for c in columns}
    spans = [
        _Span(c, -math.inf, math.inf, 0, sketches[c].rows, tuple(sorted(set(ranks[c]))))
        for c in columns
        if sketches[c].rows
    ]
    while spans:
        small = [s for s in spans if s.rows <= per_cell or not points[s.column]]
        large = [s for s in spans if s not in small]
        if small:
            _pick(slim, small, found)
        if not large:
            break
        wider = {s.column: max(x.rows for x in large if x.column == s.column) for s in large}
        spans = _narrow(slim, large, points, found)
        if any(s.rows >= wider[s.column] for s in spans if s.rows > per_cell):
            raise RuntimeError("cut points inside a span left it as it was")
        points = _points_within(slim, [s for s in spans if s.rows > per_cell], per_cell)
        points = {s.column: points.get(s.column, ()) for s in spans}
    return found


def _pick(df: DataFrame, spans: Sequence[_Span], found: dict[str, dict[int, Located]]) -> None:
    """Sort each span on its own and read off its ranks; one scan."""
    pairs = []
    for column in dict.fromkeys(s.column for s in spans):
        span_id = F.lit(None).cast("int")
        for i, span in enumerate(spans):
            if span.column == column:
                test = F.col(column).isNotNull() if span.rows and math.isinf(span.low) and math.isinf(span.high) else span.holds()
                span_id = F.when(test, i).otherwise(span_id)
        pairs.append(F.struct(span_id.alias("span"), F.col(column).alias("value")))
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("span").isNotNull() & F.col("value").isNotNull())
        .groupBy("span", "value")
        .count()
    )
    upto = F.sum("count").over(Window.partitionBy("span").orderBy("value"))
    ranked = counts.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("count"))
    local = F.create_map(
        *[x for i, s in enumerate(spans) for x in (F.lit(i), F.array(*[F.lit(r - s.below) for r in s.ranks]))]
    )
    hit = F.exists(local[F.col("span")], lambda r: (F.col("below") <= r) & (r < F.col("upto")))
    for row in ranked.where(hit).collect():
        span = spans[row["span"]]
        for rank in span.ranks:
            if row["below"] <= rank - span.below < row["upto"]:
                found[span.column][rank] = Located(row["value"], span.below + row["below"], row["count"])


def _narrow(df: DataFrame, spans: Sequence[_Span], points, found) -> list[_Span]:
    """Count rows per cell in one scan and keep the cells that hold wanted ranks."""
    columns = list(dict.fromkeys(s.column for s in spans))
    pairs = []
    celled = df
    for i, column in enumerate(columns):
        # Bucketizer leaves null alone and keeps NaN apart; nulls are filtered below.
        celled = with_cell(celled, column, points[column], out=f"c{i}")
        cell = F.col(f"c{i}")
        marks = F.array(*[F.lit(p) for p in points[column]])
        on_mark = F.col(column) == F.element_at(marks, F.greatest(cell, F.lit(1)))
        # Cell 2k lies before mark k, cell 2k+1 is mark k itself.
        number = F.when((cell > 0) & on_mark, 2 * cell - 1).otherwise(2 * cell)
        pairs.append(F.struct(F.lit(i).alias("col"), F.when(F.col(column).isNotNull(), number).alias("cell")))
    counted = (
        celled.select(F.inline(F.array(*pairs))).where(F.col("cell").isNotNull()).groupBy("col", "cell").count()
    )
    sizes: dict[str, list[tuple[int, int]]] = {}
    for row in counted.collect():
        sizes.setdefault(columns[row["col"]], []).append((row["cell"], row["count"]))
    left = []
    for column in columns:
        marks = points[column]
        ranks = sorted(r for s in spans if s.column == column for r in s.ranks)
        below = 0
        for cell, rows in sorted(sizes[column]):
            inner = tuple(r for r in ranks if below <= r < below + rows)
            if inner and cell % 2 == 1:
                for rank in inner:
                    found[column][rank] = Located(marks[cell // 2], below, rows)
            elif inner:
                k = cell // 2
                low = marks[k - 1] if k > 0 else -math.inf
                high = marks[k] if k < len(marks) else math.inf
                left.append(_Span(column, low, high, below, rows, inner))
            below += rows
    return left


def _points_within(df: DataFrame, spans: Sequence[_Span], per_cell: int) -> dict[str, tuple[float, ...]]:
    """New cut points: the ends of each span, its lowest and highest value, and evenly spaced values inside it.

    The lowest and the highest value become cells of their own, so every round
    takes rows off a span, even if a sketch finds no cut between them.
    """
    if not spans:
        return {}
    named = df.select(*[F.when(s.holds(), F.col(s.column)).alias(f"s{i}") for i, s in enumerate(spans)])
    inside = sketch_columns(named, [f"s{i}" for i in range(len(spans))], per_cell)
    out: dict[str, set[float]] = {}
    for i, span in enumerate(spans):
        ends = {e for e in (span.low, span.high) if not math.isinf(e)}
        within = inside[f"s{i}"]
        out.setdefault(span.column, set()).update(within.cuts, ends, {v for v in (within.low, within.high) if v is not None})
    return {c: tuple(sorted(p)) for c, p in out.items()}


def interpolate(low: float, high: float, weight: float) -> float:
    """Linear interpolation, from the nearer end so that both ends are met exactly."""
    gap = high - low
    return high - gap * (1.0 - weight) if weight >= 0.5 else low + gap * weight


def exact_quantiles(
    df: DataFrame,
    probabilities: dict[str, Sequence[float]],
    sketches: dict[str, ColumnSketch] | None = None,
    rows_per_cell: int | None = None,
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of several columns; ``None`` for an empty column."""
    sketches = sketches or sketch_columns(df, list(probabilities), rows_per_cell)
    positions = {c: [(sketches[c].rows - 1) * float(p) for p in ps] for c, ps in probabilities.items()}
    ranks = {
        c: {r for h in hs for r in (math.floor(h), math.ceil(h))} if sketches[c].rows else set()
        for c, hs in positions.items()
    }
    located = order_statistics(df, ranks, sketches, rows_per_cell)
    out: dict[str, list[float | None]] = {}
    for c, hs in positions.items():
        if not sketches[c].rows:
            out[c] = [None for _ in hs]
            continue
        at = located[c]
        out[c] = [interpolate(at[math.floor(h)].value, at[math.ceil(h)].value, h - math.floor(h)) for h in hs]
    return out


def distinct_up_to(df: DataFrame, columns: Sequence[str], limit: int, sketches: dict[str, ColumnSketch]) -> dict[str, int]:
    """``min(limit, number of distinct values)`` for each column.

    Cut points are values of the column, so many different ones settle the
    question; the rest are counted exactly in one job.
    """
    known = {c: limit for c in columns if len(sketches[c].cuts) >= limit}
    open_columns = [c for c in columns if c not in known and sketches[c].rows]
    if open_columns:
        named = {f"d{i}": c for i, c in enumerate(open_columns)}
        pairs = [F.struct(F.lit(i).alias("col"), _clean(c).alias("value")) for i, c in enumerate(open_columns)]
        counted = (
            df.select(F.inline(F.array(*pairs)))
            .where(F.col("value").isNotNull())
            .distinct()
            .groupBy("col")
            .count()
            .collect()
        )
        for row in counted:
            known[named[f"d{row['col']}"]] = min(limit, row["count"])
    return {c: known.get(c, 0) for c in columns}


def quantile_edges(
    df: DataFrame, columns: Sequence[str], bins: int = 10, rows_per_cell: int | None = None
) -> dict[str, list[float]]:
    """Distinct exact quantile edges with ``min(bins, distinct)`` steps; empty for a constant or empty column."""
    columns = list(columns)
    if not columns:
        return {}
    per_cell = rows_per_cell or ROWS_PER_CELL
    sketches = sketch_columns(df, columns, per_cell)
    edges: dict[str, list[float]] = {c: [] for c in columns}
    small = [c for c in columns if 0 < sketches[c].rows <= per_cell]
    large = [c for c in columns if sketches[c].rows > per_cell]
    if small:
        edges.update(_edges_of_small(df, small, bins))
    if large:
        distinct = distinct_up_to(df, large, bins, sketches)
        grid = {c: _grid(distinct[c]) for c in large if distinct[c] > 1}
        values = exact_quantiles(df, grid, {c: sketches[c] for c in grid}, per_cell) if grid else {}
        edges.update({c: sorted(set(v)) for c, v in values.items()})
    return edges


def _grid(steps: int) -> list[float]:
    return [float(p) for p in np.linspace(0.0, 1.0, steps + 1)]


def _edges_of_small(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Edges of columns with at most a cell of rows: distinct count and order statistics in one job."""
    pairs = [F.struct(F.lit(i).alias("col"), _clean(c).alias("value")) for i, c in enumerate(columns)]
    counts = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).groupBy("col", "value").count()
    whole, ordered = Window.partitionBy("col"), Window.partitionBy("col").orderBy("value")
    ranked = counts.select(
        "col", "value", "count",
        F.sum("count").over(ordered).alias("upto"),
        F.sum("count").over(whole).alias("rows"),
        F.count(F.lit(1)).over(whole).alias("distinct"),
    )
    # Rows within one rank of a multiple of (rows - 1) / steps; the exact ranks are read off below.
    steps = F.least(F.lit(bins), F.col("distinct"))
    per_rank = steps / (F.col("rows") - 1)
    first, last = F.col("upto") - F.col("count"), F.col("upto") - 1
    near = (F.col("rows") < 2) | (F.ceil((first - 1) * per_rank) <= F.floor((last + 1) * per_rank))
    held: dict[str, list] = {c: [] for c in columns}
    for row in ranked.where(near).collect():
        held[columns[row["col"]]].append(row)
    out = {}
    for c, rows in held.items():
        steps_c = min(bins, rows[0]["distinct"])
        if steps_c < 2:
            out[c] = []
            continue

        def at(rank: int, rows=rows) -> float:
            return next(r["value"] for r in rows if r["upto"] - r["count"] <= rank < r["upto"])

        places = [(rows[0]["rows"] - 1) * p for p in _grid(steps_c)]
        out[c] = sorted({interpolate(at(math.floor(h)), at(math.ceil(h)), h - math.floor(h)) for h in places})
    return out
