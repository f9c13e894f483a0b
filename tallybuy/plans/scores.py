"""Blending, alignment and quality of score sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybuy.functions.columns import logit, sigmoid
from tallybuy.operators import blend
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.sources.files import rounded_matrix

_PAIR = ["user_id", "seller_id"]


@query(
    "pair_mean_prob",
    over("scores", body="SELECT user_id, seller_id, round(avg(prob), 4) AS prob FROM scores GROUP BY ALL"),
)
def _pair_mean_prob(fx):
    return rounded_matrix(blend.mean_per_pair(fx.score_sets()), _PAIR)


@query(
    "blend_logit",
    over(
        "scores",
        body="""SELECT user_id, seller_id, round(1 / (1 + exp(-avg(ln(prob / (1 - prob))))), 4) AS prob
                FROM scores GROUP BY ALL""",
    ),
)
def _blend_logit(fx):
    stacked = blend.stack_sources({k: fx.scores(k) for k in (1, 2, 3)})
    return rounded_matrix(blend.blend(stacked), _PAIR)


@query(
    "blend_mean",
    over("scores", body="SELECT user_id, seller_id, round(avg(prob), 4) AS prob FROM scores GROUP BY ALL"),
)
def _blend_mean(fx):
    return rounded_matrix(blend.blend(fx.score_sets(), on_logits=False), _PAIR)


@query(
    "logit_sigmoid",
    over(
        "scores",
        body="""SELECT source, user_id, seller_id, round(ln(prob / (1 - prob)), 4) AS log_odds,
                round(1 / (1 + exp(-prob)), 4) AS squashed FROM scores""",
    ),
)
def _logit_sigmoid(fx):
    p = F.col("prob")
    scored = fx.score_sets().select(
        "source", *_PAIR, logit(p).alias("log_odds"), sigmoid(p).alias("squashed")
    )
    return rounded_matrix(scored, ["source", *_PAIR])


@query(
    "aligned_scores",
    over(
        "scores",
        body="""SELECT user_id, seller_id, count(*) AS n_scores, round(min(prob), 4) AS lowest,
                round(max(prob), 4) AS highest FROM scores GROUP BY ALL""",
    ),
)
def _aligned_scores(fx):
    return rounded_matrix(blend.aligned(fx.score_sets()), _PAIR)


@query(
    "mismatched_pairs",
    over(
        "scores",
        uneven="SELECT * FROM scores WHERE source <> 2 OR user_id % 5 <> 0",
        body="""SELECT user_id, seller_id, count(*) AS n_scores, min(prob) AS lowest, max(prob) AS highest
                FROM uneven GROUP BY ALL HAVING count(*) <> 3""",
    ),
)
def _mismatched_pairs(fx):
    uneven = fx.score_sets().where((F.col("source") != 2) | (F.col("user_id") % 5 != 0))
    return blend.mismatched_pairs(uneven, 3)


@query(
    "auc_rank_sum",
    over(
        "labelled",
        scored="""SELECT label, ((user_id * 31 + seller_id * 17) % 97 + 1) / 99.0::DOUBLE AS prob FROM labelled""",
        ranked="""SELECT label, avg(place) OVER (PARTITION BY prob) AS place FROM (
                    SELECT label, prob, row_number() OVER (ORDER BY prob) AS place FROM scored)""",
        sizes="SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM ranked",
        body="""SELECT any_value(p) AS n_pos, any_value(n) AS n_neg,
                round((sum(place) FILTER (WHERE label = 1) - any_value(p) * (any_value(p) + 1) / 2.0)
                      / (any_value(p) * any_value(n)), 4) AS auc FROM ranked, sizes""",
    ),
)
def _auc_rank_sum(fx):
    mixed = (F.col("user_id") * 31 + F.col("seller_id") * 17) % 97 + 1
    scored = fx.labelled().select("label", (mixed.cast("double") / 99.0).alias("prob"))
    return rounded_matrix(blend.roc_area(scored), [])
