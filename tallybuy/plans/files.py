"""Files written and read back: features, id mappings, scores, edges, snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.operators.assembly import outer_align
from tallybuy.operators.blend import blend, mean_per_pair
from tallybuy.operators.keys import dense_ids, with_action
from tallybuy.operators.profiles import rows_per
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.session import workspace
from tallybuy.sources import files


def _folder(fx) -> str:
    return f"{workspace(fx.spark)}/files-{uuid.uuid4().hex}"


@query(
    "feature_file",
    over(
        "acts",
        body="""SELECT seller_id, count(*) AS rows_seller_stats,
                round(avg(time_stamp), 4) AS mean_stamp_seller_stats FROM acts GROUP BY seller_id""",
    ),
)
def _feature_file(fx):
    stats = fx.log().groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("time_stamp").alias("mean_stamp")
    )
    path = f"{_folder(fx)}/seller_stats"
    files.write_features(stats, path, ["seller_id"])
    return files.read_many_features(fx.spark, [path], ["seller_id"])[0]


@query(
    "pruned_files",
    over(
        "acts",
        a="SELECT seller_id, count(*) AS a_rows_a FROM acts GROUP BY seller_id",
        b="""SELECT seller_id, round(avg(time_stamp), 4) AS b_stamp_b, count(*) FILTER (action_type = 2) AS b_buys_b
             FROM acts WHERE action_type <> 1 GROUP BY seller_id""",
        c="""SELECT seller_id, sum(brand_id)::BIGINT AS c_brand_c FROM acts WHERE action_type = 0 GROUP BY seller_id""",
        body="SELECT * FROM a FULL JOIN b USING (seller_id) FULL JOIN c USING (seller_id)",
    ),
)
def _pruned_files(fx):
    """Three files, one with an empty column, one with a constant and a nearly empty one, joined after pruning each."""
    log, folder = fx.log(), _folder(fx)

    def stats(rows, *columns):
        return rows.groupBy("seller_id").agg(*columns)

    empty, constant = F.lit(None).cast("double").alias("empty"), F.lit(3).alias("constant")
    rare = F.max(F.when(F.col("seller_id") == 1, 1.5)).alias("rare")
    frames = {
        "a": stats(log, F.count(F.lit(1)).alias("rows")).withColumn("empty", empty),
        "b": stats(log.where("action_type <> 1"), F.avg("time_stamp").alias("stamp"), F.count_if(F.col("action_type") == 2).alias("buys"), rare),
        "c": stats(log.where("action_type = 0"), F.sum("brand_id").alias("brand")).withColumn("constant", constant),
    }
    for name, frame in frames.items():
        files.write_features(frame, f"{folder}/{name}", ["seller_id"])
    pruned = files.read_pruned_features(fx.spark, [f"{folder}/{n}" for n in frames], ["seller_id"])
    return outer_align(dict(zip(frames, pruned)), ["seller_id"])


@query(
    "id_mapping_file",
    over(
        "acts",
        body="""SELECT brand_id::BIGINT AS raw_id, row_number() OVER (ORDER BY brand_id) - 1 AS dense_id
                FROM (SELECT DISTINCT brand_id FROM acts)""",
    ),
)
def _id_mapping_file(fx):
    path = f"{_folder(fx)}/brand_ids"
    files.write_id_mapping(dense_ids(fx.log(), "brand_id"), path)
    return files.read_id_mapping(fx.spark, path)


def _written_scores(fx) -> str:
    path = f"{_folder(fx)}/scores"
    files.write_scores(fx.score_sets().withColumnRenamed("source", "run_id"), path)
    return path


@query(
    "score_files",
    over(
        "scores",
        body="""SELECT 'run_id=' || source AS source, user_id, seller_id, prob FROM scores WHERE source <> 2""",
    ),
)
def _score_files(fx):
    path = _written_scores(fx)
    return files.read_score_files(fx.spark, [f"{path}/run_id={k}" for k in (1, 3)])


@query(
    "score_directory",
    over("scores", body="SELECT 'run_id=' || source AS source, count(*) AS n_rows FROM scores GROUP BY ALL"),
)
def _score_directory(fx):
    return files.list_score_files(fx.spark, f"{_written_scores(fx)}/run_id=*")


@query(
    "blend_file",
    over(
        "scores",
        body="""SELECT user_id, seller_id, round(1 / (1 + exp(-avg(ln(prob / (1 - prob))))), 4) AS prob
                FROM scores GROUP BY ALL""",
    ),
)
def _blend_file(fx):
    written = _written_scores(fx)
    sets = files.read_score_files(fx.spark, [f"{written}/run_id={k}" for k in (1, 2, 3)])
    path = f"{_folder(fx)}/blend"
    files.write_blend(blend(sets), path)
    back = fx.spark.read.schema(schemas.SCORES).option("header", True).csv(path)
    return files.rounded_matrix(mean_per_pair(back), ["user_id", "seller_id"])


@query(
    "edge_file",
    over(
        "acts",
        body="""SELECT concat('u', brand_id, chr(9), 'i', seller_id, chr(9), count(*)) AS value
                FROM acts WHERE action_type = 0 GROUP BY brand_id, seller_id""",
    ),
)
def _edge_file(fx):
    edges = rows_per(with_action(fx.log(), schemas.CLICK), ["brand_id", "seller_id"], "weight")
    path = f"{_folder(fx)}/edges"
    files.write_edges(edges, "brand_id", "seller_id", path)
    return fx.spark.read.text(path)


@query("snapshot", over("acts", body="SELECT * FROM acts WHERE action_type = 2"))
def _snapshot(fx):
    path = f"{_folder(fx)}/buys"
    files.write_snapshot(with_action(fx.log(), schemas.BUY), path)
    return fx.spark.read.parquet(path)
