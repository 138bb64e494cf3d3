"""Leak-free splits in time and their reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed
from ..session import materialise
from .ordered import cells_before, side_by_side, sketch_columns, with_cell

TRAIN, CALIBRATION, TEST = "train", "calibration", "test"


class SplitError(RuntimeError):
    """The table cannot be split, or a split leaks."""


@dataclass(frozen=True)
class Cutoffs:
    """First calibration day and first test day."""

    t1: date
    t2: date | None = None


def coerced_date(column: str) -> Column:
    """Date, or null where the text is none."""
    return F.col(column).try_cast("date")


def cutoff_table(df: DataFrame, time_column: str, two_way: bool = False) -> DataFrame:
    """One row (days, t1, t2) of positions in the sorted distinct days.

    The numbered table has one row per calendar day, so its single ordered
    window stays small whatever the table holds.
    """
    days = df.select(coerced_date(time_column).alias("day")).where(F.col("day").isNotNull()).distinct()
    order = Window.orderBy("day")
    whole = Window.partitionBy()
    numbered = days.withColumn("pos", F.row_number().over(order) - 1).withColumn(
        "n", F.count(F.lit(1)).over(whole).cast("int")
    )
    first = F.floor(F.col("n") * F.lit(fixed.TRAIN_SHARE)).cast("int")
    if two_way:
        p1, p2 = first, F.lit(None).cast("int")
    else:
        second = F.floor(F.col("n") * F.lit(fixed.TRAIN_AND_CALIBRATION_SHARE)).cast("int")
        p1 = F.greatest(F.lit(1), F.least(first, F.col("n") - 2))
        p2 = F.greatest(p1 + 1, F.least(second, F.col("n") - 1))
    return numbered.agg(
        F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("days"),
        F.max(F.when(F.col("pos") == p1, F.col("day"))).alias("t1"),
        F.max(F.when(F.col("pos") == p2, F.col("day"))).alias("t2"),
    )


def temporal_cutoffs(df: DataFrame, time_column: str, two_way: bool = False) -> Cutoffs:
    """The cut days on the driver, where they become literals that prune scans."""
    row = cutoff_table(df, time_column, two_way).first()
    if not two_way and row["days"] < 3:
        raise SplitError("a temporal split needs at least three distinct days")
    if row["t1"] is None:
        raise SplitError("no usable days")
    return Cutoffs(row["t1"], row["t2"])


def split_label(time_column: str, cutoffs: Cutoffs) -> Column:
    """train before t1, calibration before t2, test from then on; null for an unusable day."""
    day = coerced_date(time_column)
    label = F.when(day < F.lit(cutoffs.t1), TRAIN)
    if cutoffs.t2 is None:
        return label.when(day >= F.lit(cutoffs.t1), TEST)
    return label.when(day < F.lit(cutoffs.t2), CALIBRATION).when(day >= F.lit(cutoffs.t2), TEST)


def with_split(df: DataFrame, time_column: str, cutoffs: Cutoffs | None = None, two_way: bool = False) -> DataFrame:
    """Add the ``split`` column."""
    cutoffs = cutoffs or temporal_cutoffs(df, time_column, two_way)
    return df.withColumn("split", split_label(time_column, cutoffs))


def require_dates(df: DataFrame, time_column: str) -> None:
    """Raise when a day cannot be read."""
    if df.where(coerced_date(time_column).isNull()).limit(1).collect():
        raise SplitError(f"{time_column} holds values that are no dates")


def split_report(df: DataFrame, time_column: str, split: str = "split") -> DataFrame:
    """First day, last day and rows of each split."""
    return df.groupBy(split).agg(
        F.min(coerced_date(time_column)).alias("start"),
        F.max(coerced_date(time_column)).alias("end"),
        F.count(F.lit(1)).alias("rows"),
    )


def leakage_check(
    df: DataFrame, time_column: str, order: Sequence[str] = (TRAIN, CALIBRATION, TEST), split: str = "split"
) -> DataFrame:
    """One row: bounds of each split and ``passed`` or ``failed``.

    Every split has to end strictly before the next begins; an empty split fails.
    """
    day = coerced_date(time_column)
    bounds = df.agg(
        *[F.min(F.when(F.col(split) == s, day)).alias(f"{s}_min") for s in order],
        *[F.max(F.when(F.col(split) == s, day)).alias(f"{s}_max") for s in order],
    )
    fine = F.lit(True)
    for a, b in zip(order, order[1:]):
        fine = fine & F.coalesce(F.col(f"{a}_max") < F.col(f"{b}_min"), F.lit(False))
    return bounds.withColumn("status", F.when(fine, "passed").otherwise("failed"))


def require_no_leakage(df: DataFrame, time_column: str, order: Sequence[str] = (TRAIN, CALIBRATION, TEST)) -> None:
    """Raise when ``leakage_check`` fails."""
    row = leakage_check(df, time_column, order).first()
    if row["status"] != "passed":
        raise SplitError(f"temporal leakage: {row.asDict()}")


def select_split(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed in ``keys``."""
    return df.join(keys.select(key), key, "left_semi")


def split_statistics(
    df: DataFrame, numeric: Sequence[str], first: str = TRAIN, second: str = TEST, split: str = "split"
) -> DataFrame:
    """Per numeric column: mean and sample deviation in two splits, and the shift in per cent."""
    def side(name: str, column: str) -> Column:
        return F.when(F.col(split) == name, F.col(column).cast("double"))

    wide = df.agg(
        *[f(side(s, c)).alias(f"{p}_{i}_{t}") for i, c in enumerate(numeric)
          for t, s in (("a", first), ("b", second)) for p, f in (("mean", F.avg), ("std", F.stddev_samp))]
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"mean_{i}_a").alias("train_mean"), F.col(f"std_{i}_a").alias("train_std"),
            F.col(f"mean_{i}_b").alias("test_mean"), F.col(f"std_{i}_b").alias("test_std"),
        )
        for i, c in enumerate(numeric)
    ]
    long = wide.select(F.inline(F.array(*rows)))
    shift = F.abs(F.col("test_mean") - F.col("train_mean")) / (F.col("train_std") + 1e-8) * 100
    both = (F.col("train_std") > 0) & (F.col("test_std") > 0)
    return long.withColumn("shift_pct", F.when(both, shift).otherwise(0.0))


def split_target_rates(
    df: DataFrame, label: str, first: str = TRAIN, second: str = TEST, split: str = "split"
) -> DataFrame:
    """One row: rows, share of the table and positive rate of both splits, and the warning flag."""
    def when(name: str, value: Column) -> Column:
        return F.when(F.col(split) == name, value)

    base = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(when(s, F.lit(1))).alias(f"{s}_rows") for s in (first, second)],
        *[F.avg(when(s, F.col(label).cast("double"))).alias(f"{s}_rate") for s in (first, second)],
    )
    return base.select(
        *[f"{s}_rows" for s in (first, second)],
        *[(F.col(f"{s}_rows") / F.col("rows") * 100).alias(f"{s}_pct") for s in (first, second)],
        *[f"{s}_rate" for s in (first, second)],
        (F.abs(F.col(f"{first}_rate") - F.col(f"{second}_rate")) > fixed.TARGET_RATE_WARNING).alias("target_shift"),
    )


def _with_key_cells(rows: DataFrame, cuts: Sequence[float] | None) -> tuple[DataFrame, bool]:
    """Rows with the cell of their ``key``, and whether there may be several cells.

    Numbers are cut by a sketch. Keys of other types go by range partitions,
    which writing the rows makes final.
    """
    kind = dict(rows.dtypes)["key"]
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        cuts = sketch_columns(rows, ["key"])["key"].cuts if cuts is None else cuts
        return with_cell(rows, "key", cuts), bool(cuts)
    return materialise(rows.repartitionByRange("key").withColumn("cell", F.spark_partition_id()), "key-ranges"), True


def infer_split_type(df: DataFrame, time_column: str, order_key: str, cuts: Sequence[float] | None = None) -> DataFrame:
    """One row: ``temporal`` if time never falls, or never rises, along the key; else ``random``.

    ``unknown`` when the column is absent. Each cell of the key is checked on
    its own, then the cells' ends are compared. The key may be of any type with
    an order; rows without a key have no place and are not judged.
    """
    if time_column not in df.columns:
        return df.agg(F.lit("unknown").alias("split_type"))
    rows = df.select(F.col(order_key).alias("key"), F.col(time_column).alias("t")).where(F.col("key").isNotNull())
    celled, _ = _with_key_cells(rows, cuts)
    before = F.lag("t").over(Window.partitionBy("cell").orderBy("key"))
    # A missing time is no order at all.
    steps = celled.withColumn("before", before)
    inside = steps.groupBy("cell").agg(
        F.bool_and(F.col("t").isNotNull() & (F.col("before").isNull() | (F.col("before") <= F.col("t")))).alias("up"),
        F.bool_and(F.col("t").isNotNull() & (F.col("before").isNull() | (F.col("before") >= F.col("t")))).alias("down"),
        F.min_by("t", "key").alias("first"),
        F.max_by("t", "key").alias("last"),
    )
    previous = F.lag("last").over(Window.orderBy("cell"))
    joined = inside.withColumn("previous", previous)
    up = F.bool_and(F.col("up") & (F.col("previous").isNull() | (F.col("previous") <= F.col("first"))))
    down = F.bool_and(F.col("down") & (F.col("previous").isNull() | (F.col("previous") >= F.col("first"))))
    return joined.agg(F.when(F.coalesce(up, F.lit(True)) | F.coalesce(down, F.lit(True)), "temporal").otherwise("random").alias("split_type"))


# ---- calendar ----------------------------------------------------------------


def missing_days(df: DataFrame, time_column: str) -> DataFrame:
    """Days between the first and the last one that no row has."""
    days = df.select(coerced_date(time_column).alias("day")).where(F.col("day").isNotNull()).distinct()
    span = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).where(F.col("a").isNotNull())
    calendar = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    return calendar.join(days, "day", "left_anti")


def late_rows(df: DataFrame, time_column: str, order_key: str, cuts: Sequence[float] | None = None) -> DataFrame:
    """One row: how many rows carry a day before the latest day seen so far in arrival order.

    Rows without a key have no place in that order and are not counted.
    """
    rows = df.select(F.col(order_key).alias("key"), coerced_date(time_column).alias("day")).where(F.col("key").isNotNull())
    celled, several = _with_key_cells(rows, cuts)
    inside = F.max("day").over(
        Window.partitionBy("cell").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = celled.withColumn("inside", inside)
    if several:
        # One row for each cell or range partition, so joining them back is cheap.
        peaks = celled.groupBy("cell").agg(F.max("day").alias("peak"))
        earlier = peaks.select("cell", F.max("peak").over(cells_before([])).alias("earlier"))
        seen = seen.join(F.broadcast(earlier), "cell")
    else:
        seen = seen.withColumn("earlier", F.lit(None).cast("date"))
    return seen.agg(
        F.count_if(F.col("day") < F.greatest("inside", "earlier")).alias("late_rows")
    )


def temporal_manifest(df: DataFrame, time_column: str, order_key: str) -> DataFrame:
    """One row: rows, calendar days, days present, days missing, late rows, first and last day."""
    day = coerced_date(time_column)
    # Days are collapsed first, so nothing but calendar days is shuffled.
    per_day = df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    base = per_day.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count("day").alias("days_present"),
    )
    late = late_rows(df, time_column, order_key)
    span = (F.datediff("last_day", "first_day") + 1).cast("bigint")
    return side_by_side(base, late).select(
        "rows", span.alias("calendar_days"), "days_present", (span - F.col("days_present")).alias("missing_days"),
        "late_rows", "first_day", "last_day",
    )
