"""Score sets: averaging, blending, comparison of key sets, ROC area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.functions.columns import logit, ratio, sigmoid
from tallybuy.functions.ordering import running_totals

PAIR = ("user_id", "seller_id")


def mean_per_pair(scores: DataFrame) -> DataFrame:
    return scores.groupBy(*PAIR).agg(F.avg("prob").alias("prob"))


def stack_sources(sets: dict[str | int, DataFrame]) -> DataFrame:
    """Score sets of an explicit list below each other, with their name."""
    out: DataFrame | None = None
    for name, scores in sets.items():
        part = scores.select(F.lit(name).alias("source"), *PAIR, "prob")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no score sets given")
    return out


def blend(stacked: DataFrame, on_logits: bool = True) -> DataFrame:
    """Blend the sources per pair: sigmoid of the mean logit, or the plain mean."""
    if on_logits:
        return stacked.groupBy(*PAIR).agg(sigmoid(F.avg(logit(F.col("prob")))).alias("prob"))
    return mean_per_pair(stacked)


def aligned(stacked: DataFrame) -> DataFrame:
    """Per pair: how many scores it has, lowest and highest."""
    return stacked.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n_scores"),
        F.min("prob").alias("lowest"),
        F.max("prob").alias("highest"),
    )


def mismatched_pairs(stacked: DataFrame, n_sources: int) -> DataFrame:
    """Pairs that are not scored exactly once by every source."""
    return aligned(stacked).where(F.col("n_scores") != n_sources)


def roc_area(scored: DataFrame, score: str = "prob", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve, equal scores sharing their rank.

    One row ``(n_pos, n_neg, auc)``. Equal scores are merged before the sort,
    and the ranks come from running totals over range slices.
    """
    positive = F.col(label) == 1
    groups = (
        scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    ranked = running_totals(groups, [], ["score"], {"neg_upto": F.col("neg")})
    below = F.col("neg_upto") - F.col("neg") / 2.0
    return ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"),
        F.sum(F.col("pos") * below).alias("_wins"),
    ).select(
        "n_pos",
        "n_neg",
        ratio(F.col("_wins"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double")).alias("auc"),
    )
