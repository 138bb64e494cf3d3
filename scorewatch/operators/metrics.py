"""Quality of scores: AUC, Brier, calibration, confusion counts, histograms.

Every metric takes ``by`` columns, so one job covers all models, months or
segments. Each reduces rows map-side before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.buckets import calibration_bucket, count_below
from ..functions.decisions import approved
from .ordered import cells_before, running_in_cell, side_by_side, sketch_columns, with_cell


def roc_auc(
    df: DataFrame,
    score: str,
    label: str,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
    out: str = "roc_auc",
) -> DataFrame:
    """Exact area under the ROC curve, ties counting one half; null unless both classes occur.

    Rows collapse to one per score value, values are ranked within balanced
    cells, and (positives, negatives, area) of the cells add up in order.
    """
    return ranked_sums(df, score, label, by, {}, cuts, out)


def ranked_sums(
    df: DataFrame, score: str, label: str, by: Sequence[str], sums: dict[str, Column], cuts: Sequence[float] | None = None, auc: str = "roc_auc",
) -> DataFrame:
    """AUC of each group beside ``sums``, all from one collapse of the rows to one per score value.

    ``sums`` are expressions over ``score``, ``n`` (rows), ``positive`` and
    ``negative`` (rows of each label) of a score value, added up over all of
    them, null scores included.
    """
    by = list(by)
    value = F.col(label).cast("bigint")
    counts = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(value == 1).alias("positive"), F.count_if(value != 1).alias("negative"),
    )
    known = F.col("score").isNotNull()
    kept = {"pos": F.when(known, F.col("positive")).otherwise(0), "neg": F.when(known, F.col("negative")).otherwise(0), **sums}
    counts = counts.select(*by, "score", *(F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in kept.items()))
    # Measured on the plain rows, which takes no shuffle; the collapsed table can only be smaller.
    if cuts is None:
        cuts = sketch_columns(df, [score])[score].cuts
    celled = with_cell(counts, "score", cuts)
    below = F.coalesce(F.sum("neg").over(running_in_cell(by, ["score"], False)), F.lit(0))
    parts = celled.select(*by, "cell", *kept, (F.col("pos") * (below + F.col("neg") / 2.0)).alias("area"))
    cells = parts.groupBy(*by, "cell").agg(*[F.sum(c).alias(c) for c in (*kept, "area")])
    earlier = F.coalesce(F.sum("neg").over(cells_before(by)), F.lit(0))
    total = cells.withColumn("area", F.col("area") + F.col("pos") * earlier.cast("double"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return total.groupBy(*by).agg(F.when(pairs > 0, F.sum("area") / pairs).alias(auc), *(F.sum(k).alias(k) for k in sums))


def evaluate_scores(
    df: DataFrame,
    score: str,
    label: str,
    by: Sequence[str] = (),
    threshold: float = fixed.DECISION_THRESHOLD,
) -> DataFrame:
    """AUC, approval rate and the threshold it was taken at."""
    known = F.col("score").isNotNull()
    sums = {"scored": F.when(known, F.col("n")), "approved": F.when(approved(F.col("score"), threshold), F.col("n"))}
    found = ranked_sums(df, score, label, by, sums)
    return found.select(
        *by, "roc_auc", F.when(F.col("scored") > 0, F.col("approved") / F.col("scored")).alias("approval_rate"),
        F.lit(float(threshold)).alias("decision_threshold"),
    )


def summarise_batch(
    df: DataFrame, score: str, by: Sequence[str] = (), threshold: float = fixed.DECISION_THRESHOLD
) -> DataFrame:
    """Batch size, approval rate and mean score; zeros for an empty batch."""
    return df.groupBy(*by).agg(
        F.count(score).cast("double").alias("batch_size"),
        F.coalesce(F.avg(approved(F.col(score), threshold).cast("double")), F.lit(0.0)).alias("approval_rate"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("mean_risk_score"),
    )


def brier_score(df: DataFrame, scores: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared distance of each score column to the label."""
    return df.groupBy(*by).agg(
        *[F.avg(F.pow(F.col(s) - F.col(label), 2)).alias(f"brier_{s}") for s in scores]
    )


def calibration_bins(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), bins: int = fixed.CALIBRATION_BINS
) -> DataFrame:
    """Rows, mean label and mean score per equal-width bin."""
    return (
        df.withColumn("bin", calibration_bucket(F.col(score), bins))
        .where(F.col("bin").isNotNull())
        .groupBy(*by, "bin")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(label).alias("observed"),
            F.avg(score).alias("expected"),
        )
    )


def calibration_gap(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), bins: int = fixed.CALIBRATION_BINS
) -> DataFrame:
    """Largest distance of mean label and mean score over the non-empty bins; 0 without rows."""
    table = calibration_bins(df, score, label, by, bins)
    gap = F.coalesce(F.max(F.abs(F.col("observed") - F.col("expected"))), F.lit(0.0))
    return table.groupBy(*by).agg(gap.alias("calibration_gap"))


def calibration_report(
    df: DataFrame, before: str, after: str, label: str, method: str = "isotonic_regression"
) -> DataFrame:
    """One row: method, rows, Brier score before and after, gap after."""
    sizes = df.agg(
        F.lit(method).alias("method"),
        F.count(F.lit(1)).alias("calibration_size"),
        F.avg(F.pow(F.col(before) - F.col(label), 2)).alias("brier_score_before"),
        F.avg(F.pow(F.col(after) - F.col(label), 2)).alias("brier_score_after"),
    )
    gap = calibration_gap(df, after, label).withColumnRenamed("calibration_gap", "calibration_gap_after")
    return side_by_side(sizes, gap)


def classification_metrics(df: DataFrame, scores: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall (0 when undefined) and AUC of each score column, unrounded, long form."""
    by = list(by)
    pairs = [F.struct(F.lit(s).alias("model"), F.col(s).alias("score")) for s in scores]
    long = df.select(*by, F.col(label).alias("label"), F.inline(F.array(*pairs)))
    keys = [*by, "model"]
    guess = F.col("score") > fixed.CLASSIFY_ABOVE
    sums = {
        "rows": F.col("n"), "right": F.when(guess, F.col("positive")).when(~guess, F.col("negative")), "hits": F.when(guess, F.col("positive")),
        "guessed": F.when(guess, F.col("n")), "actual": F.col("positive"),
    }
    return ranked_sums(long, "score", "label", keys, sums, auc="auc").select(
        *keys,
        (F.col("right") / F.col("rows")).alias("accuracy"),
        F.when(F.col("guessed") > 0, F.col("hits") / F.col("guessed")).otherwise(0.0).alias("precision"),
        F.when(F.col("actual") > 0, F.col("hits") / F.col("actual")).otherwise(0.0).alias("recall"),
        "auc",
    )


def compare_scores(df: DataFrame, clean: str, noisy: str, label: str) -> DataFrame:
    """Metrics of two score columns and their differences (taken before rounding to 4 places)."""
    names = ("accuracy", "auc", "precision", "recall")
    wide = classification_metrics(df, [clean, noisy], label).agg(
        *[F.max(F.when(F.col("model") == m, F.col(n))).alias(f"{side}_{n}")
          for side, m in (("clean", clean), ("noisy", noisy)) for n in names]
    )
    return wide.select(
        *[F.round(f"{side}_{n}", 4).alias(f"{side}_{n}") for side in ("clean", "noisy") for n in names],
        *[(F.round(F.col(f"clean_{n}") - F.col(f"noisy_{n}"), 4) + 0.0).alias(f"delta_{n}") for n in names],
    )


def histogram_cells(column: str, bounds: Sequence[float]) -> Column:
    """Index of the first bound not below the column; ``len(bounds)`` beyond the last."""
    return count_below(column, bounds)


def cumulative_histogram(
    df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Rows at or below each bound, and below infinity, with sum and count per group.

    Each row falls in one cell and is counted once; the at most ``len(bounds)+1``
    cells of a group are then summed up.
    """
    by = list(by)
    cells = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, histogram_cells(value, bounds).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    )
    return unfold_histogram(cells, bounds, by)


def unfold_histogram(cells: DataFrame, bounds: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(group, cell, n, s) counts to one row per group and bound, empty cells included."""
    labels = [repr(float(b)) for b in bounds] + ["+Inf"]
    at = [F.coalesce(F.sum(F.when(F.col("cell") <= i, F.col("n"))), F.lit(0)) for i in range(len(labels))]
    rows = F.array(
        *[F.struct(F.lit(i).alias("cell"), F.lit(name).alias("le"), at[i].alias("cumulative")) for i, name in enumerate(labels)]
    )
    folded = cells.groupBy(*by).agg(rows.alias("h"), F.sum("s").alias("total"), F.sum("n").alias("count"))
    return folded.select(*by, F.inline("h"), "total", "count")


def histogram_quantiles(
    df: DataFrame, value: str, bounds: Sequence[float], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles read from a cumulative histogram, linear inside the bucket.

    Beyond the last finite bound that bound is returned. The lowest bucket
    starts at 0, or at its bound when that is not positive.
    """
    by = list(by)
    cells = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, histogram_cells(value, bounds).alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return quantiles_from_cells(cells, bounds, probabilities, by)


def quantiles_from_cells(
    cells: DataFrame, bounds: Sequence[float], probabilities: Sequence[float], by: Sequence[str]
) -> DataFrame:
    bounds = [float(b) for b in bounds]
    upto = [F.coalesce(F.sum(F.when(F.col("cell") <= i, F.col("n"))), F.lit(0)) for i in range(len(bounds) + 1)]
    wide = cells.groupBy(*by).agg(*[u.alias(f"u{i}") for i, u in enumerate(upto)])

    def at(probability: float) -> Column:
        rank = F.col(f"u{len(bounds)}") * float(probability)
        answer = F.lit(bounds[-1])
        for i in range(len(bounds) - 1, -1, -1):
            low = bounds[i - 1] if i else min(0.0, bounds[0])
            prior = F.col(f"u{i - 1}") if i else F.lit(0)
            step = F.lit(low) + (bounds[i] - low) * (rank - prior) / (F.col(f"u{i}") - prior)
            if i == 0 and bounds[0] <= 0:
                step = F.lit(bounds[0])
            answer = F.when(F.col(f"u{i}") >= rank, step).otherwise(answer)
        return answer

    return wide.select(*by, *[at(p).alias(f"p{round(p * 100):02d}") for p in probabilities])
