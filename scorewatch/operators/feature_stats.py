"""Feature statistics of a table and the comparison of training with serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions import fixed

NUMERIC_TYPES = (T.NumericType,)


def numeric_by_type(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns whose data type is numeric."""
    return [c for c in columns if isinstance(df.schema[c].dataType, NUMERIC_TYPES)]


def feature_stats(
    df: DataFrame, columns: Sequence[str], numeric: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row per feature: mean, sample deviation, missing share, extremes (numbers or text).

    A single aggregate over all columns; ``by`` keeps groups apart. Without
    ``numeric`` the data type decides.
    """
    numeric = set(numeric_by_type(df, columns) if numeric is None else numeric)
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    for i, c in enumerate(columns):
        value = F.col(c)
        if c in numeric:
            value = F.when(~F.isnan(value.cast("double")), value.cast("double"))
            aggs += [F.avg(value).alias(f"mean{i}"), F.stddev_samp(value).alias(f"std{i}")]
        else:
            value = value.cast("string")
        aggs += [
            F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}"),
            F.avg(value.isNull().cast("double")).alias(f"missing{i}"),
        ]
        is_num = c in numeric
        rows.append(
            F.struct(
                F.lit(c).alias("feature"),
                (F.col(f"mean{i}") if is_num else none_d).alias("mean"),
                (F.col(f"std{i}") if is_num else none_d).alias("std"),
                F.col(f"missing{i}").alias("missing_pct"),
                (F.col(f"min{i}") if is_num else none_d).alias("min_num"),
                (F.col(f"max{i}") if is_num else none_d).alias("max_num"),
                (none_s if is_num else F.col(f"min{i}")).alias("min_str"),
                (none_s if is_num else F.col(f"max{i}")).alias("max_str"),
            )
        )
    return df.groupBy(*by).agg(*aggs).select(*by, "rows", F.inline(F.array(*rows)))


def compare_stats(
    training: DataFrame,
    inference: DataFrame,
    mean_tolerance: float = fixed.MEAN_SHIFT_STDS,
    relative_tolerance: float = fixed.MEAN_SHIFT_RELATIVE,
    missing_tolerance: float = fixed.MISSING_SHARE_CHANGE,
    failures_only: bool = True,
    min_rows: int = 0,
) -> DataFrame:
    """Failures of serving statistics against training statistics, one row per feature.

    Only training features are looked at. A feature without numbers on either
    side is compared by its share of missing values. Serving statistics of
    fewer than ``min_rows`` rows give nothing.
    """
    keep = ["mean", "std", "missing_pct"]
    t = training.select("feature", *[F.col(c).alias(f"train_{c}") for c in keep])
    rows = F.col("rows") if min_rows else F.lit(0)
    i = inference.select("feature", *[F.col(c).alias(f"inference_{c}") for c in keep], F.lit(True).alias("seen"), rows.alias("rows"))
    distance = F.abs(F.col("inference_mean") - F.col("train_mean"))
    # A deviation may be null next to a mean (a single training row): then only the relative test speaks.
    no_numbers = F.col("train_mean").isNull() | F.col("inference_mean").isNull()
    stds = distance / F.when(F.col("train_std") == 0, 1.0).otherwise(F.col("train_std"))
    relative = distance / F.when(F.col("train_mean") == 0, 1.0).otherwise(F.abs("train_mean"))
    missing_change = F.abs(F.coalesce("train_missing_pct", F.lit(0.0)) - F.coalesce("inference_missing_pct", F.lit(0.0)))
    joined = t.join(i, "feature", "left").withColumn("stds", F.when(~no_numbers, stds)).withColumn("rel", F.when(~no_numbers, relative))
    reason = (
        F.when(F.col("seen").isNull(), "missing_feature")
        .when(no_numbers & (missing_change > missing_tolerance), "missing_pct_change")
        .when(~no_numbers & ((F.col("stds") > mean_tolerance) | (F.col("rel") > relative_tolerance)), "mean_shift")
    )
    if min_rows:  # one row per feature
        joined = joined.withColumn("rows", F.max("rows").over(Window.partitionBy())).where(F.col("rows") >= min_rows)
    out = joined.withColumn("reason", reason).select(
        "feature", "reason", "train_mean", "inference_mean", "stds", "rel", "train_missing_pct", "inference_missing_pct"
    )
    return out.where(F.col("reason").isNotNull()) if failures_only else out


def feature_check(
    training: DataFrame, samples: DataFrame, columns: Sequence[str], min_samples: int = 1, **tolerances: float
) -> DataFrame:
    """``compare_stats`` of a sample table; no failures below ``min_samples`` rows."""
    return compare_stats(training, feature_stats(samples, columns), min_rows=min_samples, **tolerances)


def failure_messages(failures: DataFrame) -> DataFrame:
    """Message lines for shifted means and missing features."""
    base = F.when(F.col("train_mean") == 0, 1.0).otherwise(F.abs("train_mean"))
    percent = F.abs(F.col("inference_mean") - F.col("train_mean")) / base * 100.0
    message = F.when(
        F.col("reason") == "mean_shift",
        F.concat(
            F.lit("FEATURE_MISMATCH: "), F.col("feature"), F.lit(" mean deviation "),
            F.bround(percent, 0).cast("decimal(38,0)").cast("string"), F.lit("% REQUEST_REJECTED"),
        ),
    ).when(
        F.col("reason") == "missing_feature",
        F.concat(F.lit("FEATURE_MISMATCH: "), F.col("feature"), F.lit(" missing in inference batch REQUEST_REJECTED")),
    )
    return failures.select("feature", "reason", message.alias("message")).where(F.col("message").isNotNull())
