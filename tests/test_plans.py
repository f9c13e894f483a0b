"""What the physical plans look like, and how hot keys fare."""

import io
import re
from contextlib import contextmanager, redirect_stdout

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallybuy import schemas
from tallybuy.functions.columns import PromoCalendar
from tallybuy.operators import assembly, population, profiles, ratios
from tallybuy.operators import synthesis as syn

DIRECTORY = "/root/testdata/sf0.001"
CAL = PromoCalendar()


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed_log(spark):
    """A third of all rows belong to user 0, another third to seller 0."""
    i = F.col("id")
    return spark.range(60_000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 401).alias("user_id"),
        (i % 5003).alias("item_id"),
        (i % 11).alias("cat_id"),
        F.when(i % 3 == 1, 0).otherwise(i % 97).alias("seller_id"),
        (i % 23).cast("int").alias("brand_id"),
        F.when(i % 7 == 0, 1111).otherwise(1001 + i % 28).cast("int").alias("time_stamp"),
        F.floor(i / 3).cast("int").alias("n"),
    ).select("*", (F.col("n") % 4).alias("action_type")).select(*schemas.LOG.fieldNames())


def test_counts_need_one_exchange(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([(1, 1, 1, 1, 1, 1111, 2)], schemas.LOG).write.parquet(path)
    plan = plan_of(ratios.action_counts(spark.read.parquet(path), ["user_id"], CAL))
    assert plan.count("Exchange") == 1
    assert "cat_id" not in plan


def test_restriction_is_a_semi_join(spark):
    plan = plan_of(entry.queries()["log_semi_pair"](spark, DIRECTORY))
    assert "LeftSemi" in plan


def test_scan_reads_only_what_is_used(spark):
    plan = plan_of(entry.queries()["user_ratio"](spark, DIRECTORY), "formatted")
    schemas_read = re.findall(r"ReadSchema: (struct<.*>)", plan)
    assert any("l_suppkey" in s for s in schemas_read)
    assert not any("l_extendedprice" in s or "o_totalprice" in s for s in schemas_read)
    assert "PushedFilters" in plan and "LessThan(o_orderdate" in plan


@pytest.mark.parametrize(
    "name",
    ["user_ratio", "population", "key_profile_user", "feature_outer_join", "blend_logit", "count_kde",
     "promo_loyalty", "implicit_matrix", "buy_matrix_pivot"],
)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, DIRECTORY))
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_outer_align_shuffles_once(spark):
    frames = {
        n: spark.range(100).select(F.col("id"), (F.col("id") * 2).alias("x")) for n in ("a", "b", "c", "d")
    }
    assert plan_of(assembly.outer_align(frames, ["id"])).count("Exchange") == 1


TIGHT = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "10KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__shuffle__partitions": "8",
}


def _ratios(log, pairs):
    return ratios.entity_ratios(
        population.restrict_to(log, pairs, "user_id"), "user_id", "seller_id", CAL
    )


def _with_features(log, _pairs):
    frames = [
        ("m", ["seller_id"], profiles.rows_per(log, ["seller_id"], "n")),
        ("u", ["user_id"], profiles.rows_per(log, ["user_id"], "n")),
    ]
    joined = assembly.attach_features(log.select("user_id", "seller_id"), frames)
    return joined.groupBy("n_m", "n_u").agg(F.count(F.lit(1)).alias("n"))


def _labelled(log, _pairs):
    # one pair with a third of all rows
    log = log.withColumn("seller_id", F.when(F.col("user_id") == 0, 0).otherwise(F.col("seller_id")))
    pairs = log.where("time_stamp = 1111").select("user_id", "seller_id").distinct()
    known = population.with_labels(log, pairs.withColumn("label", F.lit(1)))
    return known.groupBy("label", "action_type").agg(F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("build", [_ratios, _with_features, _labelled])
def test_hot_keys_are_split_in_joins(spark, skewed_log, build):
    pairs = skewed_log.where("time_stamp = 1111").select("user_id", "seller_id").distinct()
    want = sorted(map(str, build(skewed_log, pairs).collect()))
    with settings(spark, **TIGHT):
        df = build(skewed_log.repartition(8), pairs)
        got = sorted(map(str, df.collect()))
        assert "skew=true" in plan_of(df)
    assert got == want


def test_results_do_not_depend_on_partitioning(spark, skewed_log):
    users = spark.range(401).select(
        F.col("id").alias("user_id"), (F.col("id") % 9).cast("int").alias("age_range"),
        (F.col("id") % 3).cast("int").alias("gender"),
    )
    spec = syn.SPECS["user_fav_count"]

    def results(log):
        dated = log.withColumn("d", F.make_date(F.lit(2016), F.floor(F.col("time_stamp") / 100).cast("int"),
                                                (F.col("time_stamp") % 100).cast("int")))
        kept = syn.synthesize(spec, syn.prepare(spec, log, None, users, CAL))
        rounded = kept.select(*[F.round(c, 6).alias(c) if c != "user_id" else c for c in kept.columns])
        return (
            sorted(map(tuple, profiles.time_profile(dated, ["user_id"], "d").select("user_id", "rows", "daily_median", "monthly_max").collect())),
            sorted(map(str, rounded.collect())),
            sorted(map(tuple, profiles.ordered_buys(log.where("action_type = 2")).collect())),
        )

    assert results(skewed_log) == results(skewed_log.repartition(13, "item_id"))


def test_hot_user_sequence_positions(spark, skewed_log):
    buys = skewed_log.where("action_type = 2")
    got = profiles.ordered_buys(buys)
    last = got.groupBy("user_id").agg(F.max("last_position").alias("n"))
    want = profiles.rows_per(buys, ["user_id"], "n")
    assert last.exceptAll(want).count() == 0 and want.exceptAll(last).count() == 0


def test_batch_joins_profile_and_pairs_once(spark, skewed_log):
    """All named specs start from one log: one join for the profile, one for each kind of entity."""
    users = spark.createDataFrame([(1, 2, 1)], schemas.USER_INFO)
    pairs = skewed_log.where("time_stamp = 1111").select("user_id", "seller_id").distinct()
    specs = list(syn.SPECS.values())
    rows = syn.prepare_all(specs, skewed_log, pairs, users, CAL, unrestricted=("user_seller_buy",))
    logical = rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bJoin (Inner|LeftOuter|LeftSemi)", logical)) == 1 + len({s.target for s in specs})


def test_bucketed_stores_are_not_shuffled(spark, skewed_log):
    """Only the rows move, once for each key of a store; the result is that of the plain join."""
    stores, names = [], []
    for suffix, keys in (("u", ["user_id"]), ("m", ["seller_id"]), ("mu", ["user_id", "seller_id"])):
        counts = profiles.rows_per(skewed_log, keys, "n")
        names.append(f"bucketed_test_{suffix}")
        stores.append((suffix, keys, assembly.write_bucketed(counts, keys, names[-1], 5)))
    try:
        rows = skewed_log.limit(2_000)
        want = assembly.attach_features(rows, stores)
        with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
            got = assembly.attach_bucketed(spark.createDataFrame(rows.collect(), rows.schema), stores)
            plan = plan_of(got)
            store_sides = re.findall(r"Exchange[^\n]*\n[^\n]*\n?[^\n]*FileScan parquet[^\n]*bucketed_test", plan)
            assert not store_sides and plan.count("Exchange hashpartitioning") == 3 and plan.count("Bucketed: true") == 3
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_pruned_files_read_only_what_is_left(spark, tmp_path):
    from tallybuy.sources import files

    one = spark.createDataFrame([(k, float(k), 3, None, 1.5 if k == 7 else None) for k in range(300)], "id int, x double, same int, `no ne` double, rare double")
    one.write.parquet(f"{tmp_path}/one")
    two = spark.createDataFrame([(k, float("nan"), k % 2) for k in range(50)], "id int, nan double, bit int")
    two.write.parquet(f"{tmp_path}/two")
    one.limit(0).write.parquet(f"{tmp_path}/three")
    one.select("id", "x", "same").write.option("header", True).csv(f"{tmp_path}/four.csv")
    paths = [f"{tmp_path}/{n}" for n in ("one", "two", "three", "four.csv")]
    got = files.read_pruned_features(spark, paths, ["id"])
    assert [df.columns for df in got] == [
        ["id", "x_one"], ["id", "bit_two"], ["id", "x_three", "same_three", "no ne_three", "rare_three"], ["id", "x_four"],
    ]
    assert "ReadSchema: struct<id:int,x:double>" in plan_of(got[0], "formatted")
    assert got[0].count() == 300 and files.read_pruned_features(spark, [], ["id"]) == []


def test_running_shares_need_no_single_partition(spark):
    from tallybuy.operators import selection

    table = spark.range(1000).select(F.concat(F.lit("f"), "id").alias("feature"), (F.col("id") % 97).cast("double").alias("importance"))
    got = selection.cumulative_importance(table)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # What comes to one task is a row for each slice.
    assert re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*HashAggregate\(keys=\[_slice", plan)
    assert plan.count("SinglePartition") == 1
    rows = sorted(got.collect(), key=lambda r: (-r.importance, r.feature))
    total, upto = sum(r.importance for r in rows), 0.0
    for r in rows:
        upto += r.importance / total
        assert abs(r.cumulative_importance - upto) < 1e-9


def test_sketches_merge_and_typed_counts(spark):
    from tallybuy.operators import selection

    df = spark.range(30_000).select(
        (F.col("id") % 3).alias("day"), (F.col("id") % 5000).alias("a"), (F.col("id") % 7).cast("string").alias("s"),
        (F.col("id") / 2).alias("x"), F.lit(None).cast("double").alias("none"), F.when(F.col("id") % 2 == 0, 1).alias("one"),
    )
    names = ["a", "s", "x", "none", "one"]
    exact = {r.feature: r.nunique for r in selection.distinct_counts(df, names).collect()}
    assert exact == {"a": 5000, "s": 7, "x": 30_000, "none": 0, "one": 1}
    stored = selection.distinct_sketches(df, names, ["day"])
    assert stored.where("feature <> 'none'").count() == 12
    for r in selection.merged_distinct(stored).collect():
        assert abs(r.estimate - exact[r.feature]) <= max(0.04 * exact[r.feature], 0)


def test_profile_tasks_hold_a_bounded_number_of_rows(spark, skewed_log, monkeypatch):
    """A large log is dealt out for the cells of its ids, whatever the cuts of its files; the profile stays."""
    log = skewed_log.withColumn("event_date", F.date_add(F.lit("1999-01-01").cast("date"), F.col("time_stamp") % 100))
    want = sorted(map(str, profiles.key_profile(log, ["cat_id"]).collect()))
    monkeypatch.setattr(profiles, "_PROFILE_ROWS", 10_000)
    dealt = profiles.key_profile(log, ["cat_id"])
    assert re.search(r"RoundRobinPartitioning\(6\)", plan_of(dealt))
    assert sorted(map(str, dealt.collect())) == want
