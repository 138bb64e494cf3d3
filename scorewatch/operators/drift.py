"""Distribution drift: population stability index and two-sample KS.

All features and all days come from one frequency table
``(day, feature, bucket, category, n)``: rows are bucketed against literal
reference edges and counted map-side, so the shuffle carries at most
days x features x (bins + 2) rows per task for numeric features, however large
the tables are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed
from ..functions.buckets import right_closed_bucket
from ..session import local_table, materialise
from .ordered import quantile_edges, running_in_cell, side_by_side, sketch_columns, with_cell

MISSING, OUTSIDE = -1, 0


@dataclass(frozen=True)
class Features:
    """Which columns are compared, and how, in report order."""

    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    order: tuple[str, ...] = field(default=())

    @property
    def names(self) -> tuple[str, ...]:
        return self.order or (*self.numeric, *self.categorical)

    def position(self, column: Column) -> Column:
        """Place of a feature name in report order."""
        return F.array_position(F.array(*[F.lit(n) for n in self.names]), column)


def numeric_edges(reference: DataFrame, columns: Sequence[str], bins: int = fixed.PSI_BINS) -> dict[str, list[float]]:
    """Bucket edges of the reference side: at most ``bins + 1`` doubles per feature."""
    return quantile_edges(reference, columns, bins)


def frequency_table(
    df: DataFrame,
    features: Features,
    edges: dict[str, list[float]],
    by: Sequence[str | Column] = (),
    out_of_range: str = "drop",
) -> DataFrame:
    """Rows per (by, feature, bucket, category); works on batch and streaming frames.

    Numeric features have ``category`` null; categorical ones bucket 1.
    Missing values are bucket -1, values outside the edges bucket 0.
    """
    cells = [F.struct(*c) for c in _buckets(features, edges, out_of_range)]
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    names = [b if isinstance(b, str) else f"by{i}" for i, b in enumerate(by)]
    long = df.select(*[k.alias(n) for k, n in zip(keys, names)], F.inline(F.array(*cells)))
    return long.groupBy(*names, "feature", "bucket", "category").agg(F.count(F.lit(1)).alias("n"))


def _buckets(features: Features, edges: dict[str, list[float]], out_of_range: str) -> list[list[Column]]:
    """feature, bucket and category of each feature of a row, numeric ones first."""
    nothing = F.lit(None).cast("string")
    return [
        [F.lit(name).alias("feature"), right_closed_bucket(name, edges[name], out_of_range).alias("bucket"), nothing.alias("category")]
        for name in features.numeric
    ] + [
        [F.lit(name).alias("feature"), F.when(F.col(name).isNull(), MISSING).otherwise(1).alias("bucket"), F.col(name).cast("string").alias("category")]
        for name in features.categorical
    ]


def drift_cube(
    reference: DataFrame, current: DataFrame, features: Features, time_column: str, edges: dict[str, list[float]], cuts: dict[str, Sequence[float]],
) -> DataFrame:
    """All counts that a drift run needs, from one scan and one shuffle: rows r of the reference and c of the current side.

    Two groupings: (feature, cell) with the value cells of numeric features,
    and (day, feature, bucket, category) with the day of the current side.
    """
    def side(df: DataFrame, r: int, c: int, day: Column) -> DataFrame:
        wanted = [x for x in features.names if x != time_column]
        return df.select(*wanted, time_column, day.alias("day"), F.lit(r).alias("r"), F.lit(c).alias("c"))

    both = side(reference, 1, 0, F.lit(None).cast("date")).unionByName(side(current, 0, 1, day_of(time_column)))
    numbers = {}
    for i, x in enumerate(features.numeric):
        value = F.col(x).try_cast("double")
        both = both.withColumn(f"__v{i}", F.when(~F.isnan(value), value))
        both = with_cell(both, f"__v{i}", cuts.get(x, ()), out=f"__cell{i}")
        numbers[x] = F.when(F.col(f"__v{i}").isNotNull(), F.col(f"__cell{i}")).cast("int")
    none = F.lit(None).cast("int")
    named = zip((*features.numeric, *features.categorical), _buckets(features, edges, "drop"))
    long = both.select("day", F.inline(F.array(*(F.struct(*b, numbers.get(x, none).alias("cell")) for x, b in named))), "r", "c")
    sets = [["feature", "cell"], ["day", "feature", "bucket", "category"]]
    columns = ["day", "feature", "bucket", "category", "cell"]
    return long.groupingSets([[F.col(x) for x in s] for s in sets], *columns).agg(
        F.sum("r").alias("r"), F.sum("c").alias("c"), (F.grouping("cell") == 0).alias("by_cell"),
    )


def _gain(current: Column, reference: Column) -> Column:
    return (current - reference) * F.ln(current / reference)


def psi_from_frequencies(reference: DataFrame, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """PSI per (by, feature) from two frequency tables; 0 where a side has no usable rows.

    A bucket absent on one side counts as ``PSI_FLOOR``. Two rewritings keep the
    current side to one join and one aggregate:

    * reference buckets a group lacks are not spelled out per group: their sum is
      a constant per feature, from which the buckets present are taken back;
    * with ``c = n / N``, ``(c - r) ln(c / r)`` is split so that the group's total
      ``N`` stays outside the sums and need not be known beforehand.
    """
    by = list(by)
    usable = F.col("bucket") >= 1
    category = F.coalesce("category", F.lit("")).alias("category")
    floor = F.lit(fixed.PSI_FLOOR)
    ref = reference.where(usable).select("feature", "bucket", category, "n")
    ref_total = ref.groupBy("feature").agg(F.sum("n").alias("ref_n"))
    ref_share = ref.join(ref_total, "feature").select("feature", "bucket", "category", (F.col("n") / F.col("ref_n")).alias("r"))
    absent = ref_share.groupBy("feature").agg(F.sum(_gain(floor, F.col("r"))).alias("all_absent"))

    counted = current.select(*by, "feature", "bucket", category, F.when(usable, F.col("n")).alias("n"))
    known = F.col("r").isNotNull() & F.col("n").isNotNull()
    r = F.coalesce("r", floor)
    shift = F.ln(F.col("n") / r)
    sums = counted.join(ref_share, ["feature", "bucket", "category"], "left").groupBy(*by, "feature").agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n") * shift).alias("n_shift"),
        F.sum(F.when(F.col("n").isNotNull(), r)).alias("r_sum"),
        F.sum(r * shift).alias("r_shift"),
        F.sum(F.when(known, _gain(floor, F.col("r"))).otherwise(0.0)).alias("taken_back"),
    )
    total = F.col("total")
    present = F.col("n_shift") / total - F.ln(total) - F.col("r_shift") + F.ln(total) * F.col("r_sum")
    return sums.join(absent, "feature", "left").select(
        *by,
        "feature",
        # Null where a side has no usable rows, which compares as no drift.
        F.coalesce(present - F.col("taken_back") + F.col("all_absent"), F.lit(0.0)).alias("psi"),
    )


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: Features,
    by: Sequence[str] = (),
    bins: int = fixed.PSI_BINS,
    out_of_range: str = "drop",
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """PSI of each feature, and of each ``by`` group of the current side."""
    edges = edges if edges is not None else numeric_edges(reference, features.numeric, bins)
    ref = frequency_table(reference, features, edges, (), out_of_range)
    cur = frequency_table(current, features, edges, by, out_of_range)
    return psi_from_frequencies(ref, cur, by)


def day_of(column: str) -> Column:
    """Calendar day; text that is no date gives null."""
    return F.col(column).try_cast("date")


def _by_day(df: DataFrame, time_column: str) -> DataFrame:
    return df.withColumn("event_day", day_of(time_column)).where(F.col("event_day").isNotNull())


def psi_by_day(
    reference: DataFrame,
    current: DataFrame,
    features: Features,
    time_column: str,
    bins: int = fixed.PSI_BINS,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Largest PSI over the features for each day of the current side."""
    daily = psi(reference, _by_day(current, time_column), features, ["event_day"], bins, edges=edges)
    return daily.groupBy("event_day").agg(F.max("psi").alias("psi"))


def psi_trend(
    reference: DataFrame,
    current: DataFrame,
    features: Features,
    time_column: str,
    bins: int = fixed.PSI_BINS,
    min_rows: int = 0,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Per day: rows, largest PSI and its feature (earliest in report order on a tie)."""
    edges = edges if edges is not None else numeric_edges(reference, features.numeric, bins)
    ref = frequency_table(reference, features, edges)
    cur = frequency_table(_by_day(current, time_column), features, edges, ["event_day"])
    return trend_from_frequencies(ref, cur, features, min_rows)


def trend_from_frequencies(ref: DataFrame, cur: DataFrame, features: Features, min_rows: int = 0) -> DataFrame:
    """The same from frequency tables, the current one by event_day."""
    daily = psi_from_frequencies(ref, cur, ["event_day"])
    # Every row of a day appears once under each feature, missing values included.
    rows = (
        cur.where(F.col("feature") == features.names[0]).groupBy("event_day").agg(F.sum("n").alias("rows"))
    )
    best = daily.groupBy("event_day").agg(
        F.max("psi").alias("max_psi"),
        # Sums of many terms leave noise in the last digits; equal features must tie.
        F.max_by("feature", F.struct(F.round("psi", 9).alias("psi"), -features.position(F.col("feature")))).alias("max_psi_feature"),
    )
    return best.join(rows, "event_day").where(F.col("rows") >= min_rows).select(
        F.col("event_day").alias("event_time"), "rows", "max_psi", "max_psi_feature"
    )


def trend_head(trend: DataFrame, rows: int = fixed.TREND_HEAD) -> DataFrame:
    """The first days of a trend."""
    return trend.orderBy("event_time").limit(rows)


def ks_statistic(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], cuts: dict[str, Sequence[float]] | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per column; 0 when a side is empty.

    The rows of both sides are counted per value cell, which shuffles only
    counts. The differences of the distributions at the cells' ends are then
    known, and inside a cell the difference cannot stray further than the cell's
    own rows allow. Only cells that could beat the best end are read value by
    value; for clearly different samples those are few.
    """
    columns = list(columns)
    schema = "feature string, cell int, start double, nr double, nc double"
    both = _both_sides(reference, current, columns)
    if cuts is None:
        sketched = sketch_columns(both, columns)
        cuts = {x: sketched[x].cuts for x in columns}
    rows = _in_cells(both, columns, cuts)
    if sizes is None:
        sizes = rows.groupBy("feature", "cell").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    ends, open_cells = _bound_cells(sizes, columns)
    spark = reference.sparkSession
    known = local_table(spark, list(ends.items()), "feature string, ks double")
    if not open_cells:
        return known
    # At most MAX_CELLS rows per feature.
    cells = F.broadcast(local_table(spark, open_cells, schema))
    counts = (
        rows.join(cells.select("feature", "cell"), ["feature", "cell"], "left_semi")
        .groupBy("feature", "cell", "value")
        .agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
        .join(cells, ["feature", "cell"])
    )
    run = running_in_cell(["feature"], ["value"], True)
    gap = F.col("start") + F.sum("r").over(run) / F.col("nr") - F.sum("c").over(run) / F.col("nc")
    inside = counts.select("feature", F.abs(gap).alias("gap")).groupBy("feature").agg(F.max("gap").alias("inside"))
    return known.join(inside, "feature", "left").select("feature", F.greatest("ks", "inside").alias("ks"))


def _both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numbers of both sides, marked by counts ``r`` and ``c``; text that is no number is missing."""
    def side(df: DataFrame, r: int, c: int) -> DataFrame:
        values = [F.col(x).try_cast("double") for x in columns]
        return df.select(
            *[F.when(~F.isnan(v), v).alias(x) for x, v in zip(columns, values)], F.lit(r).alias("r"), F.lit(c).alias("c")
        )

    return side(reference, 1, 0).unionByName(side(current, 0, 1))


def _in_cells(both: DataFrame, columns: Sequence[str], cuts: dict[str, Sequence[float]]) -> DataFrame:
    """Long rows (feature, cell, value, r, c)."""
    for i, x in enumerate(columns):
        both = with_cell(both, x, cuts.get(x, ()), out=f"cell{i}")
    cells = [
        F.struct(F.lit(x).alias("feature"), F.col(f"cell{i}").alias("cell"), F.col(x).alias("value"))
        for i, x in enumerate(columns)
    ]
    return both.select(F.inline(F.array(*cells)), "r", "c").where(F.col("value").isNotNull())


def _bound_cells(counts: DataFrame, columns: Sequence[str]) -> tuple[dict[str, float], list[tuple]]:
    """Largest difference at the cells' ends, and the cells whose inside may exceed it."""
    sizes: dict[str, list] = {x: [] for x in columns}
    for row in counts.select("feature", "cell", "r", "c").collect():
        sizes[row["feature"]].append((row["cell"], row["r"], row["c"]))
    ends, open_cells = {}, []
    for x in columns:
        nr, nc = (float(sum(cell[i] for cell in sizes[x])) for i in (1, 2))
        ends[x] = 0.0
        if not nr or not nc:
            continue
        bounded, seen_r, seen_c = [], 0, 0
        for cell, r, c in sorted(sizes[x]):
            start = seen_r / nr - seen_c / nc
            reach = max(abs(start + r / nr), abs(start - c / nc))
            seen_r, seen_c = seen_r + r, seen_c + c
            ends[x] = max(ends[x], abs(seen_r / nr - seen_c / nc))
            bounded.append((reach, (x, cell, start, nr, nc)))
        open_cells += [entry for reach, entry in bounded if reach > ends[x]]
    return ends, open_cells


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: Features,
    time_column: str | None = None,
    include_time: bool = True,
    bins: int = fixed.PSI_BINS,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Per feature: PSI, KS (numeric features) and whether either passes its alert level.

    ``include_time`` compares the time column as one more category.
    """
    if time_column and include_time and time_column not in features.names:
        features = Features(
            features.numeric, (*features.categorical, time_column), (time_column, *features.names)
        )
    stability = psi(reference, current, features, bins=bins, edges=edges)
    return report_of(stability, ks_statistic(reference, current, features.numeric) if features.numeric else None, features)


def report_of(stability: DataFrame, distance: DataFrame | None, features: Features) -> DataFrame:
    """PSI and KS of each feature side by side, with the alert."""
    if distance is None:
        joined = stability.withColumn("ks", F.lit(None).cast("double"))
    else:
        joined = stability.join(distance, "feature", "left")
        numeric = F.col("feature").isin(list(features.numeric))
        joined = joined.withColumn("ks", F.when(numeric, F.coalesce("ks", F.lit(0.0))))
    alert = (F.col("psi") > fixed.PSI_ALERT) | F.coalesce(F.col("ks") > fixed.KS_ALERT, F.lit(False))
    return joined.select("feature", "psi", "ks", alert.alias("alert"))


def report_and_trend(
    reference: DataFrame, current: DataFrame, features: Features, time_column: str, include_time: bool = True, bins: int = fixed.PSI_BINS,
) -> tuple[DataFrame, DataFrame]:
    """``drift_report`` and ``psi_trend`` from one written cube of counts; only cells that decide a KS distance are read again."""
    timed = features
    if include_time and time_column not in features.names:
        timed = Features(features.numeric, (*features.categorical, time_column), (time_column, *features.names))
    edges = numeric_edges(reference, features.numeric, bins)
    numeric = list(features.numeric)
    sketched = sketch_columns(_both_sides(reference, current, numeric), numeric) if numeric else {}
    cuts = {x: sketched[x].cuts for x in numeric}
    cube = materialise(drift_cube(reference, current, timed, time_column, edges, cuts), "cube")
    buckets = cube.where("NOT by_cell").groupBy("day", "feature", "bucket", "category").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    ref = buckets.where("r > 0").groupBy("feature", "bucket", "category").agg(F.sum("r").alias("n"))
    cur = buckets.where("c > 0").select(F.col("day").alias("event_day"), "feature", "bucket", "category", F.col("c").alias("n"))
    whole = cur.groupBy("feature", "bucket", "category").agg(F.sum("n").alias("n"))
    distance = ks_statistic(reference, current, numeric, cuts, cube.where("by_cell AND cell IS NOT NULL")) if numeric else None
    report = report_of(psi_from_frequencies(ref, whole), distance, timed)
    own = F.col("feature").isin(list(features.names))
    trend = trend_from_frequencies(ref.where(own), cur.where(own & F.col("event_day").isNotNull()), features)
    return materialise(report, "drift-report"), materialise(trend, "drift-trend")


def headline(report: DataFrame, prediction_psi: DataFrame | None = None, threshold: float = fixed.PSI_ALERT) -> DataFrame:
    """One row: headline PSI, any feature alert, and whether the run counts as a breach."""
    base = report.agg(
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_feature_psi"),
        F.coalesce(F.bool_or("alert"), F.lit(False)).alias("alert"),
    )
    if prediction_psi is None:
        joined = base.withColumn("prediction_psi", F.lit(None).cast("double"))
    else:
        joined = side_by_side(base, prediction_psi.select(F.col("psi").alias("prediction_psi")))
    value = F.coalesce("prediction_psi", "max_feature_psi")
    return joined.select(
        "alert",
        F.lit(float(threshold)).alias("psi_threshold"),
        "prediction_psi",
        value.alias("headline_psi"),
        (F.col("alert") | (value > threshold)).alias("breach"),
    )


def alerts(daily: DataFrame, metric: str = "PSI", threshold: float = fixed.PSI_ALERT) -> DataFrame:
    """An alert and health row for each day whose PSI passes the threshold."""
    return daily.where(F.col("psi") > threshold).select(
        "event_day",
        F.lit(metric).alias("metric"),
        F.col("psi").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit("unhealthy").alias("status"),
        F.lit(f"{metric} breach").alias("reason"),
    )


def monitoring_events(run: DataFrame, trend: DataFrame | None = None) -> DataFrame:
    """Monitoring lines ``(seq, kind, message)`` of one drift run."""
    def text(template: str, *columns: str) -> Column:
        return F.format_string(template, *[F.col(c) for c in columns])

    metric = run.select(
        F.lit(0).alias("seq"), F.lit("METRIC").alias("kind"),
        text("psi=%.4f threshold=%.4f", "headline_psi", "psi_threshold").alias("message"),
    )
    breach = run.where("breach").select(
        F.lit(100).alias("seq"), F.lit("BREACH").alias("kind"),
        text("psi=%.4f > threshold=%.4f", "headline_psi", "psi_threshold").alias("message"),
    )
    alert = run.where("breach").select(
        F.lit(101).alias("seq"), F.lit("ALERT").alias("kind"), F.lit("drift threshold breached").alias("message")
    )
    out = metric.unionByName(breach).unionByName(alert)
    if trend is not None:
        # At most TREND_HEAD rows are numbered here.
        head = trend_head(trend).select(
            F.row_number().over(Window.orderBy("event_time")).alias("seq"),
            F.lit("TEMPORAL_PSI").alias("kind"),
            F.format_string(
                "event_time=%s max_psi=%.4f feature=%s rows=%d",
                F.col("event_time").cast("string"), F.col("max_psi"), F.col("max_psi_feature"), F.col("rows"),
            ).alias("message"),
        )
        out = out.unionByName(head)
    return out

