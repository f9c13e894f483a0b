"""Hand-made frames: empty input, zero denominators, ties, collinear columns."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from tallybuy import schemas
from tallybuy.functions.columns import PromoCalendar, date_of, month_of
from tallybuy.functions.ordering import exact_quantiles, positions, previous_value, running_totals
from tallybuy.operators import assembly, blend, keys, population, profiles, ratios, scaling, selection
from tallybuy.operators import synthesis as syn
from tallybuy.sources.fixtures import Fixtures

CAL = PromoCalendar()


def log_of(spark, rows):
    return spark.createDataFrame(rows, schemas.LOG)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def loyal(spark):
    # user 1: seller 1 on and off promotion, seller 2 on promotion only
    return log_of(
        spark,
        [
            (1, 10, 1, 1, 1, 1111, 2),
            (1, 11, 1, 1, 1, 1001, 2),
            (1, 12, 1, 2, 1, 1111, 2),
            (2, 13, 1, 1, 1, 1111, 2),
        ],
    )


def test_empty_log(spark):
    empty = log_of(spark, [])
    assert ratios.entity_ratios(empty, "user_id", "seller_id", CAL).count() == 0
    assert keys.dense_ids(empty, "user_id").count() == 0
    assert population.first_per_pair(empty).count() == 0
    assert profiles.count_summary(profiles.rows_per(empty, ["user_id"])).first()["n"] == 0
    dated = keys.add_calendar(empty, CAL)
    assert profiles.key_profile(dated, ["user_id"], "date").count() == 0
    assert selection.correlation_pairs(empty, ["item_id", "cat_id"]).where("r is not null").count() == 0


def test_promo_only_user_has_no_off_promo_ratio(spark):
    log = log_of(spark, [(1, 10, 1, 1, 1, 1111, 2), (1, 11, 1, 1, 1, 1111, 0)])
    row = ratios.entity_ratios(log, "user_id", "seller_id", CAL).first()
    assert row["0_un_de_ratio"] is None and row["2_un_de_ratio"] is None
    assert row["buy_ratio"] == 0.5 and row["un_de_all_count"] == 0


def test_loyalty(spark, loyal):
    got = ratios.promo_loyalty(loyal, "user_id", "seller_id", CAL)
    assert rows_of(got) == [(1, 1, 2), (2, 0, 1)]
    fused = ratios.entity_ratios(loyal, "user_id", "seller_id", CAL)
    kept = fused.select("user_id", "old_buy_count_on_de", "all_x_on_de")
    assert rows_of(kept) == rows_of(got)
    assert rows_of(ratios.repeat_counts(loyal, "user_id", "seller_id")) == [(1, 1, 2), (2, 0, 1)]


def test_literal_counts_include_promo_rows(spark, loyal):
    strict = ratios.action_counts(loyal, ["user_id"], CAL).where("user_id = 1").first()
    literal = ratios.action_counts(loyal, ["user_id"], CAL, strict_names=False)
    assert strict["2_un_de_count"] == 1
    assert literal.where("user_id = 1").first()["2_un_de_count"] == 3


def test_mode_takes_the_lowest_of_equals(spark):
    log = log_of(spark, [(1, 10, c, 7, 1, 1001, 2) for c in (1, 1, 2, 2)])
    profile = spark.createDataFrame([(1, 3, 0)], schemas.USER_INFO)
    spec = syn.FeatureSpec("m", "user_id", (2,), ("mode",), 1, columns=("cat_id",))
    rows = syn.prepare(spec, log, None, profile, CAL)
    assert syn.synthesize(spec, rows).first()["mode_cat_id"] == 1


def test_collinear_drops_every_later_column(spark):
    df = spark.createDataFrame([(float(i), float(i), float(i)) for i in range(5)], ["a", "b", "c"])
    selector = selection.FeatureSelector(df)
    assert selector.identify_collinear(0.9) == ["b", "c"]
    assert selector.remove(["collinear"]).columns == ["a"]


def test_pair_constant_after_pairwise_deletion_has_no_r(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (5.0, None)], "a double, b double")
    assert selection.correlation_pairs(df, ["a", "b"]).first()["r"] is None


def test_all_null_column_is_missing_but_not_single_valued(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 5)], "a int, empty double, same int")
    selector = selection.FeatureSelector(df)
    assert selector.identify_missing(0.9) == ["empty"]
    assert selector.identify_single_unique() == ["same"]
    assert selector.remove(["missing", "single_unique"]).columns == ["a"]
    with pytest.raises(NotImplementedError):
        selector.remove(["collinear"])


def test_missing_threshold_is_exclusive(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    assert selection.FeatureSelector(df).identify_missing(0.5) == []


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "a double")
    assert selection.FeatureSelector(df).identify_missing(0.4) == ["a"]


def test_uneven_scores_are_reported(spark):
    one = spark.createDataFrame([(1, 1, 0.2), (1, 2, 0.4)], schemas.SCORES)
    two = spark.createDataFrame([(1, 1, 0.6)], schemas.SCORES)
    stacked = blend.stack_sources({"one": one, "two": two})
    assert [r["seller_id"] for r in blend.mismatched_pairs(stacked, 2).collect()] == [2]


def test_extreme_scores_stay_finite(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 1.0)], schemas.SCORES)
    got = blend.blend(blend.stack_sources({"a": df})).collect()
    assert all(0.0 <= r["prob"] <= 1.0 and math.isfinite(r["prob"]) for r in got)


def test_blend_of_one_set_is_that_set(spark):
    df = spark.createDataFrame([(1, i, i / 11.0) for i in range(1, 11)], schemas.SCORES)
    got = {r["seller_id"]: r["prob"] for r in blend.blend(blend.stack_sources({"a": df})).collect()}
    assert all(abs(got[i] - i / 11.0) < 1e-12 for i in range(1, 11))


def test_blend_lies_between_its_inputs(spark):
    rows = [(1, i, ((i * k * 37) % 97 + 1) / 99.0) for i in range(1, 30) for k in (1,)]
    other = [(1, i, ((i * 53) % 97 + 1) / 99.0) for i in range(1, 30)]
    stacked = blend.stack_sources(
        {"a": spark.createDataFrame(rows, schemas.SCORES), "b": spark.createDataFrame(other, schemas.SCORES)}
    )
    joined = blend.blend(stacked).join(blend.aligned(stacked), ["user_id", "seller_id"])
    assert joined.where("prob < lowest - 1e-12 or prob > highest + 1e-12").count() == 0


def test_zero_quantile_range_divides_by_one(spark):
    df = spark.createDataFrame([(i, 0.0) for i in range(2000)] + [(2000, 1.0)], "id int, x double")
    got = scaling.robust_scale(df, kept=["id"])
    assert got.agg(F.max("x")).first()[0] == 1.0


def test_scaled_median_is_zero(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(101)], "id int, x double")
    got = scaling.robust_scale(df, kept=["id"])
    assert got.agg(F.percentile("x", F.lit(0.5))).first()[0] == 0.0


def test_month_and_date(spark):
    df = spark.createDataFrame([(101,), (229,), (1111,), (1231,)], "t int")
    got = df.select(month_of(F.col("t")), date_of(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        (1, datetime.date(2016, 1, 1)),
        (2, datetime.date(2016, 2, 29)),
        (11, datetime.date(2016, 11, 11)),
        (12, datetime.date(2016, 12, 31)),
    ]


def test_auc_is_the_share_of_won_comparisons(spark):
    rng = np.random.default_rng(5)
    rows = [(int(y), float(rng.integers(0, 20))) for y in rng.integers(0, 2, 200)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, prob double")
    assert abs(blend.roc_area(df).first()["auc"] - want) < 1e-12
    moved = df.withColumn("prob", F.exp(F.col("prob") / 7.0))
    assert abs(blend.roc_area(moved).first()["auc"] - want) < 1e-12


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.5)], "label int, prob double")
    assert blend.roc_area(df).first()["auc"] is None


def test_running_totals_cross_slices(spark):
    rows = [(k, i, i % 3) for k in (0, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i int, v int").repartition(7)
    got = running_totals(df, ["k"], ["i"], {"upto": F.col("v")})
    want = {}
    for k in (0, 1):
        total = 0
        for i in range(500):
            total += i % 3
            want[(k, i)] = total
    assert {(r["k"], r["i"]): r["upto"] for r in got.collect()} == want


def test_positions_are_consecutive(spark):
    df = spark.createDataFrame([(i * 7 % 1009,) for i in range(1009)], "x int").repartition(9)
    got = sorted(positions(df, ["x"]).collect())
    assert [r["position"] for r in got] == list(range(1009))


def test_previous_value_crosses_slices(spark):
    df = spark.createDataFrame([(1, i * 3) for i in range(300)] + [(2, 5)], "k int, v int").repartition(8)
    got = previous_value(df, ["k"], "v", "before").collect()
    for r in got:
        want = None if (r["k"] == 2 or r["v"] == 0) else r["v"] - 3
        assert r["before"] == want


def test_exact_quantiles_interpolate_like_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=333), rng.integers(0, 5, 333).astype(float)
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a double, b double").repartition(5)
    got = exact_quantiles(df, ["a", "b"], [0.001, 0.5, 0.99])
    assert np.allclose(got["a"], np.quantile(a, [0.001, 0.5, 0.99]))
    assert np.allclose(got["b"], np.quantile(b, [0.001, 0.5, 0.99]))


def test_outer_align_keeps_keys_of_every_frame(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "id int, x int")
    b = spark.createDataFrame([(2, 7), (3, 8)], "id int, x int")
    got = assembly.outer_align({"a": a, "b": b}, ["id"])
    assert rows_of(got.na.fill(-1)) == [(1, 5, -1), (2, 6, 7), (3, -1, 8)]


def test_first_row_per_pair(spark):
    rows = [(1, 9, 1, 1, 1, 1111, 2), (1, 3, 2, 1, 5, 1111, 2), (1, 3, 1, 1, 2, 1111, 2)]
    got = population.first_per_pair(log_of(spark, rows).repartition(3)).collect()
    assert len(got) == 1 and (got[0]["item_id"], got[0]["brand_id"]) == (3, 2)


def test_split_is_complete_disjoint_and_stable(spark):
    pairs = spark.range(4000).select((F.col("id") % 97).alias("user_id"), F.col("id").alias("seller_id"))
    one = population.mark_split(pairs, 0.85, salt=3, keep=0.5)
    two = population.mark_split(pairs.repartition(13), 0.85, salt=3, keep=0.5)
    assert one.exceptAll(two).count() == 0 and one.count() == 4000
    sizes = {r["part"]: r["count"] for r in one.groupBy("part").count().collect()}
    assert 0.82 < sizes["train"] / 4000 < 0.88
    assert abs(sizes["valid"] - sizes["test"]) < 100
    assert one.exceptAll(population.mark_split(pairs, 0.85, salt=4, keep=0.5)).count() > 0


@pytest.mark.parametrize("width", [6, 7])
def test_rotation_keeps_lengths_and_angles(spark, width):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(size=width).tolist()) for i in range(20)]
    df = spark.createDataFrame([*vectors, (20, None)], "id int, v array<double>")
    turned = {r["id"]: r["v"] for r in scaling.rotate_vectors(df, "v", scaling.plane_angles(width, seed=1)).collect()}
    assert turned.pop(20) is None
    before, after = np.array([v for _, v in vectors]), np.array([turned[i] for i in range(20)])
    assert np.allclose(before @ before.T, after @ after.T) and not np.allclose(before, after)


def test_row_cap_counts_copies(spark):
    from tallybuy.sources import tables

    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "x int")
    assert [r[0] for r in tables.row_cap(df, 2).collect()] == [1, 1]
    assert tables.row_cap(df, 4).count() == 4 and tables.row_cap(df, None).count() == 4


def test_many_one_hot_values(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1200)], "s string")
    assert len(keys.string_domains(df)["s"]) == 1200


def test_csv_columns_go_by_name(spark, tmp_path):
    from tallybuy.sources import tables

    path = str(tmp_path / "format2.csv")
    raw = [(1, 3, 0, 77, 1, "log"), (2, None, 1, 78, -1, "log")]
    spark.createDataFrame(raw, "user_id long, age_range int, gender int, merchant_id long, label int, activity_log string").write.option("header", True).csv(path)
    assert sorted(tables.read_format2(spark, path).collect()) == [(1, 77, 1), (2, 78, -1)]
    assert sorted(tables.read_labelled_pairs(spark, path).collect()) == [(1, 77, 1), (2, 78, -1)]
    assert sorted(tables.read_unlabelled_pairs(spark, path).collect()) == [(1, 77), (2, 78)]
    assert sorted(tables.read_user_info(spark, path).collect()) == [(1, 3, 0), (2, 0, 1)]
    with pytest.raises(ValueError):
        tables.read_log(spark, path)
    log = str(tmp_path / "log.csv")
    rows = [(5, 1112, 4, None, 3, 2, 1)]
    spark.createDataFrame(rows, "seller_id long, time_stamp int, item_id long, brand_id int, cat_id long, action_type int, user_id long").write.option("header", True).csv(log)
    got = tables.read_log(spark, log).first()
    assert got.asDict() == dict(user_id=1, item_id=4, cat_id=3, seller_id=5, brand_id=1, time_stamp=1112, action_type=2)


def test_vector_text_files(spark, tmp_path):
    from tallybuy.sources import vectors

    path = tmp_path / "vectors.txt"
    path.write_text("s7 0.5 -1.25 \ns8 2.0 3.0 \n")
    got = {r["id"]: r["vector"] for r in vectors.read_vector_text(spark, str(path)).collect()}
    assert got == {7: [0.5, -1.25], 8: [2.0, 3.0]}


def test_repeated_keys_are_refused(spark):
    from tallybuy.operators import assembly

    one = spark.createDataFrame([(1, 2.0), (1, 3.0)], "seller_id long, x double")
    with pytest.raises(Exception, match="a key twice"):
        assembly.outer_align({"a": one, "b": one.dropDuplicates(["seller_id"])}, ["seller_id"]).collect()


def test_sketch_scaling_on_heavy_tails(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.lognormal(0, 2, 20_000))], "user_id long, x double")
    exact = scaling.robust_scale(df).agg(F.max("x")).first()[0]
    sketch = scaling.robust_scale_sketch(df).agg(F.max("x")).first()[0]
    assert abs(sketch / exact - 1) < 0.1


def test_plan_lists_the_computed_columns(spark, loyal):
    profile = spark.createDataFrame([(1, 3, 0), (2, 1, 1)], schemas.USER_INFO)
    for name in ("user_buy_pro_count", "seller_buy_mode"):
        spec = syn.SPECS[name]
        got = syn.synthesize(spec, syn.prepare(spec, loyal, None, profile, CAL))
        assert got.columns == [*spec.keys, *syn.plan_features(spec)]


def test_batch_and_own_primitive(spark, loyal):
    profile = spark.createDataFrame([(1, 3, 0), (2, 1, 1)], schemas.USER_INFO)
    syn.register_fold("largest", lambda value, n, seen: F.max(F.when(seen, value)))
    try:
        spec = syn.FeatureSpec("own", "user_id", (2,), ("largest",), 1, columns=("item_id",))
        got = syn.synthesize_all([spec], loyal, None, profile, CAL)["own"]
        assert rows_of(got) == [(1, 12), (2, 13)]
    finally:
        syn.VALUE_FOLDS.pop("largest")
    with pytest.raises(ValueError):
        syn.register_fold("mean", None, stacked=True)


def test_density_integrates_to_one(spark):
    counts = spark.createDataFrame([(i, 200 + (i * 37) % 100) for i in range(400)], "u int, count bigint")
    grid = profiles.count_density(counts, start=0, stop=600, step=1)
    assert abs(grid.agg(F.sum("density")).first()[0] - 1.0) < 1e-6


def test_batch_equals_its_specs(spark, loyal):
    """All named specs in one plan give the rows that each gives by itself, also where a scope has no row of a target."""
    profile = spark.createDataFrame([(1, 3, 0), (2, 1, 1)], schemas.USER_INFO)
    pairs = spark.createDataFrame([(1, 1), (2, 1)], "user_id bigint, seller_id bigint")
    specs = list(syn.SPECS.values())
    together = syn.synthesize_all(specs, loyal, pairs, profile, CAL, unrestricted=("user_seller_buy",))
    assert list(together) == [s.name for s in specs]
    for spec in specs:
        own = None if spec.name == "user_seller_buy" else pairs
        alone = syn.synthesize(spec, syn.prepare(spec, loyal, own, profile, CAL))
        assert together[spec.name].columns == alone.columns
        assert rows_of(together[spec.name]) == rows_of(alone), spec.name
    assert syn.synthesize_all([], loyal, pairs, profile, CAL) == {}
    with pytest.raises(ValueError, match="different names"):
        syn.synthesize_all([specs[0], specs[0]], loyal, pairs, profile, CAL)


def test_batch_frames_hold_the_rows_of_each_spec(spark, loyal, monkeypatch):
    """No written frame has targets that one of its specs doesn't look at, and no count is there twice."""
    clicks = log_of(spark, [(1, 10, 1, 1, 1, 601, 0), (1, 11, 2, 3, 1, 901, 0), (2, 10, 1, 1, 1, 1111, 1), (2, 12, 1, 4, 1, 1001, 2)])
    log = loyal.unionByName(clicks)
    profile = spark.createDataFrame([(1, 3, 0), (2, 1, 1)], schemas.USER_INFO)
    pairs = spark.createDataFrame([(1, 1), (2, 1)], "user_id bigint, seller_id bigint")
    specs = [s for s in syn.SPECS.values() if s.target == "user_seller" and s.name in (
        "user_seller_fav_count", "user_seller_click_pro_count", "user_seller_click_unique_count", "user_seller_buy"
    )]
    written, write = [], syn.write_out

    def watched(df, name):
        frame = write(df, name)
        if name == "synthesized":
            written.append(frame)
        return frame

    monkeypatch.setattr(syn, "write_out", watched)
    together = syn.synthesize_all(specs, log, pairs, profile, CAL, unrestricted=("user_seller_buy",))
    held = sorted((sorted({c.split("__")[0] for c in f.columns if "__" in c}), f.count()) for f in written)
    assert held == [
        (["user_seller_buy"], 4), (["user_seller_click_pro_count", "user_seller_click_unique_count"], 1), (["user_seller_fav_count"], 1),
    ]
    for spec in specs:
        own = None if spec.name == "user_seller_buy" else pairs
        alone = syn.synthesize(spec, syn.prepare(spec, log, own, profile, CAL))
        assert rows_of(together[spec.name]) == rows_of(alone), spec.name


def test_quantiles_of_heavy_tails_by_narrowing(spark):
    """Ties on bounds, heavy tails, nulls, one value, and a sketch so coarse that bands must open."""
    rng = np.random.default_rng(11)
    n = 6_000
    tail, ties = rng.lognormal(0, 5, n), rng.integers(0, 3, n).astype(float)
    mixed = np.where(rng.random(n) < 0.999, 0.0, rng.pareto(0.5, n))
    frame = [(float(a), float(b), float(c) if k % 3 else None, 7.0, None) for k, (a, b, c) in enumerate(zip(tail, ties, mixed))]
    df = spark.createDataFrame(frame, "t double, i double, m double, one double, `no ne` double").repartition(6)
    asked = [0.0, 0.001, 0.25, 0.5, 0.999, 1.0]
    for accuracy in (4_000, 50, 1):
        got = exact_quantiles(df, ["t", "i", "m", "one", "no ne"], asked, accuracy)
        some = np.array([r[2] for r in frame if r[2] is not None])
        for name, want in (("t", tail), ("i", ties), ("m", some), ("one", np.full(n, 7.0))):
            assert np.allclose(got[name], np.quantile(want, asked), rtol=1e-12), (name, accuracy)
        assert got["no ne"] == [None] * len(asked)


def test_stacked_features_of_all_parents_in_one_aggregate(spark, loyal):
    """Parents meet the rows and are folded once; a null parent or target key and folds of one's own count as in a frame for each parent."""
    odd = [(1, 10, None, 1, 1, 1003, 2), (1, 10, None, 1, 1, 1004, 2), (2, 12, 1, None, 2, 1003, 2), (2, None, 2, 5, None, 1111, 2)]
    profile = spark.createDataFrame([(1, 3, 0), (2, 1, 1)], schemas.USER_INFO)
    spec = syn.FeatureSpec(
        "odd", "user_seller", (2,), ("count", "mean", "std", "max", "median", "trend"), 3, {"before_pro": (True, False)},
        extra_parents=("item_id", "cat_id"),
    )
    rows = syn.prepare(spec, loyal.unionByName(log_of(spark, odd)), None, profile, CAL)
    got = syn._stacked_by_rows([syn.Part(spec)], rows)
    logical = got._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Aggregate [") == 1
    want = [rows.groupBy(*spec.keys).agg(*syn._case_counts([syn.Part(spec)]))]
    want += [syn._stacked([syn.Part(spec)], rows, p) for p in spec.parents]
    joined = want[0].join(want[1], spec.keys, "left").join(want[2], spec.keys, "left")
    names = [c for c in syn.plan_features(spec) if c.split("_")[0] != "daily" and not c.startswith("count")]
    ordered = [sorted(map(str, df.select(*spec.keys, *names).collect())) for df in (got, joined)]
    assert ordered[0] == ordered[1]
    syn.register_fold("met", lambda value, n, seen: F.count_if(seen), stacked=True)
    try:
        own = syn.FeatureSpec("own", "user_id", (2,), ("count", "met"), 3)
        users = syn.synthesize(own, syn.prepare(own, loyal, None, profile, CAL)).select("user_id", "met_seller_id_count")
        sellers = loyal.where("action_type = 2").groupBy("user_id").agg(F.countDistinct("seller_id"))
        assert rows_of(users) == rows_of(sellers)
    finally:
        syn.STACKED_FOLDS.pop("met")


def test_quantiles_take_all_columns_by_one_small_aggregate(spark, monkeypatch):
    """Aggregates don't grow with the columns: no row runs through an expression for each column."""
    df = spark.createDataFrame([(float(i), float(-i), float(i % 7)) for i in range(500)], "a double, b double, c double")
    plans, agg = [], GroupedData.agg
    monkeypatch.setattr(GroupedData, "agg", lambda self, *e: (plans.append(len(e)), agg(self, *e))[1])
    got = exact_quantiles(df, ["a", "b", "c"], [0.0, 0.5])
    assert got == {"a": [0.0, 249.5], "b": [-499.0, -249.5], "c": [0.0, 3.0]}
    assert len(plans) >= 3 and max(plans) <= 4


def test_only_buys_are_counted_by_counterparty(spark):
    """An entity's other actions are one row before they are shuffled, however many counterparties they have."""
    rows = [(1, 10 + i, 1, i, 1, 1001 if i % 2 else 1111, i % 2) for i in range(20)]
    rows += [(1, 5, 1, 3, 1, 1111, 2), (1, 5, 1, 3, 1, 1001, 2), (1, None, 1, 4, 1, 1111, 2), (1, 6, 1, None, 1, 1001, 2), (1, 7, 1, 9, 1, None, None)]
    log = log_of(spark, rows + [(2, *r[1:]) for r in rows[:3]])
    met = ratios.counts_met(log, "user_id", "seller_id", CAL)
    assert rows_of(met.groupBy("user_id").agg(F.count_if("_buy"), F.count_if(~F.coalesce("_buy", F.lit(False))))) == [(1, 3, 2), (2, 0, 1)]
    got = ratios.entity_ratios(log, "user_id", "seller_id", CAL)
    assert rows_of(got.select("user_id", *ratios.COUNTS)) == rows_of(ratios.action_counts(log, ["user_id"], CAL).select("user_id", *ratios.COUNTS))
    assert rows_of(got.select("user_id", "old_buy_count_on_de", "all_x_on_de", "more_than_once_number", "all_x_count")) == [(1, 1, 2, 1, 3), (2, 0, 0, 0, 0)]


def test_pairs_group_only_rows_that_tell_of_a_pair(spark):
    """Past actions other than promotion buys are most of a log; they are left out before the groups, not after."""
    past, later = datetime.date(1999, 11, 11), datetime.date(2001, 1, 1)
    rows = [
        (1, 1, 1111, 2, past), (1, 1, 1111, 0, later), (1, 2, 1111, 2, past), (1, 2, 1001, 2, past), (1, 2, None, 2, None),
        (2, 1, 1111, 0, past), (2, 1, 1111, 2, later), (2, 2, 1111, None, past), (3, 3, None, 2, None),
    ]
    fx = Fixtures(spark, "nowhere")
    fx._log_all = spark.createDataFrame(rows, "user_id bigint, seller_id bigint, time_stamp int, action_type int, event_date date")
    pairs = fx.pairs()
    assert rows_of(pairs.select("user_id", "seller_id", "label")) == [(1, 1, 1), (1, 2, 0)]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Filter") > plan.rindex("Aggregate")
