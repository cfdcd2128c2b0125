"""Operators on hand-made rows: edge values, brute force, tampering."""

import math
import random

import numpy as np
import pandas as pd

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions import columns as K
from concord.operators import center, checks, digest, measure, neighbours, normalise, outliers, profile, ranks, reconcile, sky, splits, states, tension

NAN, INF = math.nan, math.inf


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


# ---- columns -----------------------------------------------------------------
@pytest.mark.parametrize(("value", "want"), [(-999.0, None), (-999.005, None), (-998.0, -998.0), (None, None), (INF, INF), (-99.9, None)])
def test_float_sentinels_have_a_tolerance(spark, value, want):
    assert one(spark, value, "double", K.null_sentinels(F.col("x"), [-999.0, -99.9])) == want


def test_nan_is_no_sentinel(spark):
    assert math.isnan(one(spark, NAN, "double", K.null_sentinels(F.col("x"), [-999.0])))


# The reason codes and their boundaries.
@pytest.mark.parametrize(("value", "want"), [(None, "z_missing"), (NAN, "z_non_finite"), (-INF, "z_non_finite"), (0.0, "z_non_positive"), (-0.0, "z_non_positive"), (-1.0, "z_non_positive"), (1e-9, None)])
def test_numeric_reasons(spark, value, want):
    assert one(spark, value, "double", K.numeric_reason(F.col("x"))) == want


@pytest.mark.parametrize(("value", "want"), [(99.0, True), (-999.0, True), (9.0, False), (99.9, False), (1e30, False), (1e300, False), (NAN, False), (INF, False), (None, False), (0.0, False)])
def test_sentinel_shape(spark, value, want):
    assert one(spark, value, "double", K.sentinel_shaped(F.col("x"))) is want


@pytest.mark.parametrize(("value", "want"), [(-5.0, "[underflow,0)"), (0.0, "[0,1)"), (1.0, "[1,overflow)"), (INF, "[1,overflow)"), (NAN, "unbinned"), (None, "unbinned")])
def test_bins_are_half_open(spark, value, want):
    edges = (-INF, 0.0, 1.0, INF)
    assert one(spark, value, "double", K.binned(F.col("x"), edges, K.edge_names(edges))) == want


def test_guarded_ratio(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in rows.select(K.guarded_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, None]


# ---- ranks, tension ----------------------------------------------------------
def test_percent_rank_equals_the_window(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, 1.0, 2.5, 2.5, -3.0, float(rnd.randrange(20))])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v double")
    for ranges in (1, 4, 9):
        got = dict(ranks.percent_rank(df, "v", "r", ranges).select("id", "r").collect())
        order = sorted((v is None, v or 0.0) for _, v in rows)
        assert all(abs(got[i] - order.index((v is None, v or 0.0)) / 299) < 1e-12 for i, v in rows)
    assert ranks.percent_rank(df.limit(1), "v", "r").first()["r"] == 0.0
    assert ranks.percent_rank(df.limit(0), "v", "r").count() == 0


def percentile(values, share):
    at = (len(values) - 1) * share
    low = values[int(at)]
    return low if at == int(at) else low + (at - int(at)) * (values[int(at) + 1] - low)


SHARES = {"lo": 0.0, "p1": 0.01, "q": 0.25, "median": 0.5, "p99": 0.99, "hi": 1.0}


@pytest.mark.parametrize("most", [ranks.MOST, 50])
def test_percentiles_are_exact(spark, most):
    rnd = random.Random(3)
    values = {
        "wide": [rnd.gauss(0, 1) for _ in range(40_000)], "constant": [7.0] * 5000, "two": [rnd.choice([1.0, 2.0]) for _ in range(5001)],
        "few": [3.0, 1.0], "one": [-2.5], None: [float(i % 10) for i in range(3000)], "infinite": [-INF, INF, 0.0] * 700, "spiked": [rnd.choice([0.0, rnd.random()]) for _ in range(20_000)],
    }
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("empty", None), ("wide", None)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r["g"]: r for r in ranks.exact_percentiles(df, F.col("v"), SHARES, ["g"], most).collect()}
    assert got.keys() == values.keys()
    for g, vs in values.items():
        vs = sorted(vs)
        for name, share in SHARES.items():
            want = percentile(vs, share)
            assert got[g][name] == pytest.approx(want, rel=1e-12) or math.isnan(want) and math.isnan(got[g][name]), (g, name)
    every = sorted(v for vs in values.values() for v in vs)
    whole = ranks.exact_percentiles(df, F.col("v"), {"a": 0.37, "b": 0.9}, most=most).collect()
    assert [tuple(r) for r in whole] == [(pytest.approx(percentile(every, 0.37), rel=1e-12), pytest.approx(percentile(every, 0.9), rel=1e-12))]
    assert [tuple(r) for r in ranks.exact_percentiles(df.limit(0), F.col("v"), {"a": 0.5}, most=most).collect()] == [(None,)]
    assert ranks.exact_percentiles(df.limit(0), F.col("v"), {"a": 0.5}, ["g"], most).count() == 0
    nan = spark.createDataFrame([(NAN,), (1.0,), (NAN,)], "v double")
    assert [str(x) for x in ranks.exact_percentiles(nan, F.col("v"), {"a": 0.0, "b": 0.5}, most=most).first()] == ["1.0", "nan"]


@pytest.mark.parametrize(("low", "high"), [(10.0, 10.0), (5000.0, 5100.0), (-5.0, -1.0), (1e6, 2e6)])
def test_percentiles_that_a_sketch_misses_are_found(spark, monkeypatch, low, high):
    df = spark.range(6000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    monkeypatch.setattr(ranks, "_bracket", lambda *_: (F.lit(low), F.lit(high)))
    assert ranks.exact_percentiles(df, F.col("v"), {"a": 0.25, "b": 0.5, "c": 1.0}, ["g"]).orderBy("g").collect() == [(0, 1499.5, 2999.0, 5998.0), (1, 1500.5, 3000.0, 5999.0)]


def test_rows_of_a_large_group_stay_where_they_are(spark, monkeypatch):
    """All rows of a group went to one task, to be sorted beside its bounds; now none moves, or of many groups only those of small ones."""
    df = spark.range(0, 8000, 1, 4).select(F.when(F.col("id") % 8 > 0, "large").when(F.col("id") % 16 > 0, F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), F.col("id").cast("double").alias("__v"))
    bounds = ranks.cut(df.groupBy("g").agg(F.count("__v").alias("__n")))
    monkeypatch.setattr(ranks, "MOST", 1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for few in ((), (False,)):
            out = ranks._beside(df, bounds, ["g"], *few)
            assert out.exceptAll(df.join(bounds.withColumnRenamed("g", "h"), F.col("g").eqNullSafe(F.col("h"))).drop("h")).isEmpty() and out.count() == 8000
            assert out.filter("g = 'large'").groupBy(F.spark_partition_id()).count().count() == 4
        monkeypatch.setattr(ranks, "GROUPS", 2)
        got = {r["g"]: r["a"] for r in ranks.exact_percentiles(df, F.col("__v"), {"a": 0.5}, ["g"]).collect()}
        assert got == {r["g"]: r["a"] for r in df.groupBy("g").agg(F.percentile("__v", 0.5).alias("a")).collect()} and len(got) == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_percent_rank_of_a_hot_value(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 3 == 1, (F.col("id") % 1000) / 100.0).when(F.col("id") % 2 == 0, NAN).alias("v"), F.create_map(F.lit("a"), "id").alias("m"))
    got = ranks.percent_rank(df, "v", "r", 16)
    want = df.selectExpr("id", "percent_rank() OVER (ORDER BY v NULLS LAST) AS w")
    assert got.join(want, "id").filter("abs(r - w) > 1e-12 or r is null").count() == 0 and got.columns == ["id", "v", "m", "r"]
    # rows of one value are dealt out by their hash, and no part is much larger than a sixteenth
    sizes = got.groupBy(F.spark_partition_id()).count()
    assert sizes.count() > 1
    with pytest.raises(TypeError):
        ranks.percent_rank(df.select(F.col("id").cast("string").alias("v")), "v", "r")


def test_tension_is_null_without_an_error(spark):
    rows = [(9.0, 8.9, 9.1, 1e9, 1e8), (9.0, 8.9, 9.1, 1e9, 0.0), (9.0, 8.9, 9.1, 1e9, None), (9.0, 8.9, 9.1, 0.0, 1e8)]
    df = spark.createDataFrame(rows, "a double, lo double, hi double, b double, e double")
    got = tension.with_tension(df, [tension.Pair("m", "a", "lo", "hi", "b", "e", 0.1)]).collect()
    assert [r["t_m"] for r in got] == [0.0, None, None, None]
    assert got[0]["sigma_b_m"] == pytest.approx(0.1 / 2.302585)
    assert got[3]["delta_m"] is None


def test_attrition_is_cumulative(spark):
    df = spark.range(10)
    got = tension.attrition(df, {"even": F.col("id") % 2 == 0, "small": F.col("id") < 5}).orderBy("stage_no").collect()
    assert [(r["stage"], r["n"], r["pct"]) for r in got] == [("total", 10, 100.0), ("even", 5, 50.0), ("small", 3, 30.0)]
    assert tension.attrition(df.limit(0), {}).first()["pct"] == 0.0


# ---- states ------------------------------------------------------------------
POINT = states.point_machine("m", "a.mass", "b.mass")
RATE = states.point_machine("s", "a.rate", "b.rate", "b.rate_err")
SCALE = states.scale_machine("m_scale", "m", "point_valid", "a.low", "a.high", "b.mass", "b.mass_err", True)
FIELDS = ["a.mass", "a.low", "a.high", "b.mass", "b.mass_err", "a.rate", "b.rate", "b.rate_err"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ({"a.mass": 10.0, "b.mass": 1e9}, {"m_state": "point_valid", "delta_m": 1.0, "m_scale_state": "missing", "score_m": None}),
        ({"a.mass": 8.0, "b.mass": 1e9}, {"delta_m": -1.0}),
        ({"a.mass": None, "b.mass": 1e9}, {"m_state": "missing", "m_reason": "missing_input", "delta_m": None, "m_scale_reason": "parent_state_not_permitted"}),
        ({"a.mass": -99.9, "b.mass": 1e9}, {"m_state": "invalid_or_unsupported", "m_reason": "lephare_value_out_of_domain", "delta_m": None}),
        ({"a.mass": 9.0, "b.mass": 0.0}, {"m_state": "nonpositive_log_undefined", "m_reason": "exact_zero_native_value"}),
        ({"a.mass": 9.0, "b.mass": -2.0}, {"m_reason": "negative_native_value"}),
        ({"a.mass": 9.1, "a.low": 9.0, "a.high": 9.2, "b.mass": 1e9, "b.mass_err": 1e8}, {"m_scale_state": "point_valid", "score_m_state": "point_valid", "residual_m": 0.05}),
        ({"a.mass": 9.0, "a.low": 9.2, "a.high": 9.0, "b.mass": 1e9, "b.mass_err": 1e8}, {"m_scale_reason": "quantile_order_violation", "score_m": None}),
        ({"a.mass": 9.0, "a.low": 8.9, "a.high": 9.1, "b.mass": 1e9, "b.mass_err": -1.0}, {"m_scale_reason": "error_negative"}),
        ({"a.mass": 9.0, "a.low": 8.9, "a.high": 9.1, "b.mass": 1e9, "b.mass_err": 4e8}, {"m_scale_state": "approximation_out_of_domain", "score_m_state": "approximation_out_of_domain"}),
        ({"a.rate": 1.0, "b.rate": 10.0, "b.rate_err": 1.0}, {"s_state": "point_comparable"}),
        ({"a.rate": 1.0, "b.rate": 10.0}, {"s_reason": "error_missing"}),
        ({"a.rate": 1.0, "b.rate": 1.0, "b.rate_err": 1.0}, {"s_state": "floor_or_censoring_suspected"}),
        ({"a.rate": 1.0, "b.rate": 1.0, "b.rate_err": -1.0}, {"s_reason": "error_negative"}),
    ],
)
def test_state_machines(spark, given, want):
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in FIELDS])
    df = spark.createDataFrame([tuple(given.get(c) for c in FIELDS)], schema)
    out = states.scored(states.run_machines(df, [POINT, SCALE, RATE]), "m", "`a.mass`", "`a.low`", "`a.high`", "`b.mass`", "`b.mass_err`", F.lit(0.05), 0.1, "point_valid").first()
    for k, v in want.items():
        assert out[k] == (pytest.approx(v) if isinstance(v, float) else v), k


def test_rule_texts_are_limited(spark):
    df = spark.createDataFrame([(3.0, 4.0)], "`p.x` double, `p.y` double")
    assert df.select(states.expression("sqrt(p.x^2 + p.y^2)")).first()[0] == 5.0
    assert df.select(states.expression("max(p.x, p.y) == 4 AND NOT is_null(p.x)")).first()[0] is True
    with pytest.raises(ValueError, match="not allowed"):
        states.expression("sleep(p.x)")
    with pytest.raises(ValueError, match="unknown name"):
        states.expression("p.z + 1", ["p.x"])


# ---- centers -----------------------------------------------------------------
def test_center_falls_back(spark):
    rows = [(float(x), float(y), x + y / 10) for x in range(4) for y in range(4) for _ in range(3 if x else 1)]
    df = spark.createDataFrame(rows, "x double, y double, d double")
    edges = center.Edges((0.0, 1.0, 4.0), (0.0, 2.0, 4.0))
    fit = center.fit_center(df, "d", "x", "y", edges)
    probe = spark.createDataFrame([(0.5, 0.5), (2.0, 2.0), (9.0, 1.0), (None, 1.0), (1.0, 4.0)], "x double, y double")
    got = center.apply_center(probe, fit, "x", "y", edges, support=4).collect()
    assert sorted((r["center_support"] for r in got)) == ["cell", "out_of_hull", "out_of_hull", "out_of_hull", "z_fallback"]
    tight = center.apply_center(probe, fit, "x", "y", edges, support=10).collect()
    assert "global_fallback" in {r["center_support"] for r in tight}


def test_fitted_floor_makes_the_spread_one(spark):
    rnd = random.Random(2)
    rows = [(rnd.gauss(0, 0.3), 0.1, 0.1) for _ in range(2000)]
    df = spark.createDataFrame(rows, "r double, a double, b double")
    floor = center.fit_floor(df, "r", "a", "b")
    spread = center.spread_by_floor(df, "r", "a", "b", [floor]).first()["spread"]
    assert spread == pytest.approx(1, abs=1e-3) and floor == pytest.approx(math.sqrt(0.09 - 0.02), abs=0.03)


def test_floor_is_fitted_by_counts_on_rows_computed_once(spark, monkeypatch):
    """Every round computed the rows again, and the spread at every floor of its grid in full."""
    rnd = random.Random(5)
    for n in (1, 2, 7, 400):
        df = spark.createDataFrame([(rnd.gauss(0, 2), rnd.choice([0.0, 0.1]), 0.2) for _ in range(n)] + [(None, 0.1, 0.1)], "r double, a double, b double")
        grid = [0.0, 0.5, 1.0, 1.5, 2.0]
        want = {r["floor"] for r in center.spread_by_floor(df, "r", "a", "b", grid).collect() if r["spread"] > 1}
        assert center._above_one(center._pulls(df, "r", "a", "b"), grid) == want
    written, looked = [], []
    pulls, above = center._pulls, center._above_one
    monkeypatch.setattr(center, "_pulls", lambda *a: written.append(a) or pulls(*a))
    monkeypatch.setattr(center, "_above_one", lambda p, c: looked.extend(c) or above(p, c))
    floor = center.fit_floor(df, "r", "a", "b", rounds=2)
    assert len(written) == 1 and len(looked) <= 2 + 2 * 6
    around = sorted(map(tuple, center.spread_by_floor(df, "r", "a", "b", [floor - 1 / 256, floor + 1 / 256]).collect()))
    assert around[0][1] > 1 >= around[1][1]
    assert center.fit_floor(df.filter("abs(r) < 0.05"), "r", "a", "b") == 0.0 and center.fit_floor(df.withColumn("r", F.col("r") * 1e3), "r", "a", "b") == 2.0


def test_forbidden_fits_are_named(spark):
    train = spark.createDataFrame([(1, 1), (1, 2), (2, 5), (3, 6), (3, 6), (4, 7)], "request int, id int")
    split = spark.createDataFrame([(1, 1, "development"), (1, 2, "holdout"), (2, 5, "development"), (2, 5, "other"), (3, 6, "development"), (4, 7, "development")], "request int, id int, split string")
    got = {tuple(r) for r in center.refused_fits(train, split).collect()}
    assert got == {(1, 2, "held_out_row"), (2, 5, "in_two_partitions"), (3, 6, "duplicate_training_row")}


# ---- measurements ------------------------------------------------------------
MEAS = "id long, ent long, z double, flag long, conf long, prio long"


def measurements(spark, rows):
    return spark.createDataFrame(rows, MEAS)


def test_secure_needs_everything(spark):
    rows = [(1, 1, 1.0, 3, 95, 1), (2, 1, 1.0, 13, 95, 1), (3, 1, 1.0, 4, 95, 1), (4, 1, None, 3, 95, 1), (5, 1, 1.0, 9, 85, 1), (6, 1, 1.0, None, None, 1)]
    df = measurements(spark, rows).select("id", measure.secure().alias("s"), measure.block_reasons().alias("b")).orderBy("id").collect()
    assert [r["s"] for r in df] == [True, True, False, False, False, False]
    assert [r["b"] for r in df] == [[], [], ["preferred_flag_confidence_mapping_inconsistent"], ["preferred_z_not_numeric_valid"], ["preferred_flag_not_in_secure_domain", "preferred_confidence_below_95"], ["preferred_flag_not_in_secure_domain", "preferred_confidence_out_of_domain"]]


def test_preferred_and_its_ties(spark):
    rows = [(5, 1, 1.0, 3, 95, 1), (2, 1, 1.1, 3, 95, 1), (1, 1, 1.2, 3, 80, 1), (7, 2, 1.0, 3, None, 1), (8, 2, 1.0, 3, -99, 1), (9, 2, 1.0, 3, None, 1), (3, 3, NAN, 3, 99, 1), (4, 4, 2.0, 3, 0, 1), (6, 4, 2.0, 3, 101, 1)]
    got = {r["ent"]: (r["p_id"], r["tied_ids"], r["tied"]) for r in measure.preferred(measurements(spark, rows)).collect()}
    assert got == {1: (2, [2, 5], True), 2: (7, [7, 9], True), 4: (4, [4], False)}


def test_conflicts_equal_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(60), rnd.choice([None, NAN, -1.0, 1.0, 1.005, 1.0051, 1.01, 1 + rnd.random() / 50]), rnd.choice([3, 4, 2]), rnd.choice([95, 97, 80, None]), 1) for i in range(400)]
    df = measurements(spark, rows)
    ok = lambda r: r[2] is not None and r[2] == r[2] and r[2] > 0
    sec = lambda r: ok(r) and (r[3], r[4]) in ((3, 95), (4, 97))
    want = {}
    for e in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == e and ok(r)]
        pairs = [(a, b) for i, a in enumerate(mine) for b in mine[i + 1 :] if abs(a[2] - b[2]) > 0.005]
        want[e] = (bool(pairs), any(sec(a) and sec(b) for a, b in pairs), any(not (sec(a) and sec(b)) for a, b in pairs), len(pairs))
    got = {r["ent"]: (r["any_conflict"], r["secure_conflict"], r["other_conflict"]) for r in measure.conflicts(df).collect()}
    assert got == {e: w[:3] for e, w in want.items()}
    assert measure.witnesses(df).count() == sum(w[3] for w in want.values())
    assert measure.witnesses(df, both_secure=True).count() + measure.witnesses(df, both_secure=False).count() == sum(w[3] for w in want.values())


def test_every_entity_has_a_summary(spark):
    cat = spark.createDataFrame([(1, "t", 0), (2, None, 2), (3, "t", None)], "id long, tile string, class int")
    meas = measurements(spark, [(1, 1, 1.0, 3, 95, 1), (2, 1, 1.001, 4, 97, 0), (3, 99, 5.0, 3, 95, 1), (4, -999, 1.0, 3, 95, 1), (5, None, 1.0, 3, 95, 1), (6, 2, 1.0, 13, 95, 1)])
    split = splits.hash_split(cat.select("tile"), "tile", "s", 0, 0)
    out = {r["ent"]: r for r in measure.with_split(measure.source_summary(cat, meas, meas.filter("prio = 1")), split).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1]["eligible_primary"] and not out[1]["eligible_validation"] and out[1]["corroboration"] == "multiply_supported"
    assert out[2]["basis_validation"] and not out[2]["eligible_validation"] and "split_unassigned" in out[2]["exclusion"]
    assert out[3]["exclusion"] == ["no_association", "no_broad_line_or_photometric_qso_evidence", "photometric_type_unknown_or_missing"] and out[3]["n_all"] == 0


def test_witnesses_of_a_large_entity_are_formed_in_units(spark):
    rnd = random.Random(12)
    rows = [(i, 1, rnd.choice([0.5, 0.504, 0.5049999, 0.505, 0.51, 1e-9, 1e30, 1.0000000000000002e30, round(rnd.uniform(0.4, 0.6), 4)]), rnd.choice([3, 2]), rnd.choice([97, 50])) for i in range(700)]
    rows += [(1000 + i, 2, 0.5 + 0.01 * i, 3, 97) for i in range(5)] + [(2000, 3, 0.5, 3, 97), (2001, 3, NAN, 3, 97), (2002, 1, -1.0, 3, 97), (2003, None, 0.1, 3, 97), (2004, None, 0.9, 3, 97)]
    df = spark.createDataFrame(rows, "id long, ent long, z double, flag int, conf int").repartition(5)
    valid = [r for r in rows if r[2] == r[2] and r[2] > 0]
    want = {(a[0], b[0]) for e in (1, 2) for a in valid if a[1] == e for b in valid if b[1] == e and a[0] < b[0] and abs(a[2] - b[2]) > 0.005}
    for unit in (50, 10_000):
        got = measure.witnesses(df.filter("ent is not null"), unit=unit)
        pairs = [(r["left_id"], r["right_id"]) for r in got.collect()]
        assert len(pairs) == len(want) and set(pairs) == want, unit
        assert all(r["difference"] == abs(r["left_z"] - r["right_z"]) and r["left_id"] < r["right_id"] for r in got.limit(200).collect())


# ---- splits ------------------------------------------------------------------
def test_splits_do_not_depend_on_order(spark):
    tiles = [f"T{i}" for i in range(20)]
    got = None
    for order in (tiles, tiles[::-1], tiles * 2 + [None]):
        rows = {tuple(r) for r in splits.hash_split(spark.createDataFrame([(t,) for t in order], "tile string"), "tile", "salt", 4, 4).collect()}
        assert got is None or rows == got
        got = rows
    assert sorted(r[2] for r in got) == ["development"] * 12 + ["holdout"] * 4 + ["validation"] * 4
    assert len({s["sample_hash"] for s in splits.ranked_sample(spark.range(1000), "id", 50, "x").collect()}) == 50


def test_large_samples_are_taken_by_a_threshold(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 29_000, F.col("id")).otherwise(7).alias("id"), F.col("id").alias("x")).unionByName(spark.createDataFrame([(None, 1)], "id long, x long"))
    for n in (0, 1, 5000, 29_500, 50_000):
        want = sorted(r["id"] for r in splits.ranked_sample(df, "id", n, "s").collect())
        for few in (3, 40):
            assert sorted(r["id"] for r in splits.ranked_sample(df, "id", n, "s", few).collect()) == want and len(want) == min(n, 30_000)


# ---- reconciliation ----------------------------------------------------------
BOOK = "k long, a double, b string, v array<double>"
BOOK_ROWS = [(1, 0.0, "x", [1.0, 2.0]), (2, NAN, None, [NAN, 1.0]), (3, None, "z", None), (4, 1.5, "w", [0.0])]


@pytest.mark.parametrize(
    ("tamper", "kind", "column"),
    [
        (lambda r: (r[0], -0.0, *r[2:]) if r[0] == 1 else r, "mismatch", "a"),
        (lambda r: (r[0], 0.0, *r[2:]) if r[0] == 3 else r, "mismatch", "a"),
        (lambda r: (*r[:3], [1.0, 2.5]) if r[0] == 1 else r, "mismatch", "v"),
        (lambda r: (*r[:2], "", r[3]) if r[0] == 2 else r, "mismatch", "b"),
        (lambda r: (9, *r[1:]) if r[0] == 4 else r, "absent_in_target", None),
        (lambda r: (1, *r[1:]) if r[0] == 4 else r, "multiplicity", None),
    ],
)
def test_tampering_is_found(spark, tamper, kind, column):
    a = spark.createDataFrame(BOOK_ROWS, BOOK)
    assert reconcile.reconcile(a, spark.createDataFrame(BOOK_ROWS, BOOK), "k", ["a", "b", "v"]).count() == 0
    found = reconcile.reconcile(a, spark.createDataFrame([tamper(r) for r in BOOK_ROWS], BOOK), "k", ["a", "b", "v"]).collect()
    more = {"absent_in_target": 2, "multiplicity": 2}.get(kind, 1)  # the changed key is also absent elsewhere
    assert len(found) == more
    assert (kind, column) in {(r["kind"], r["column"]) for r in found}


def test_multisets_count_repeats(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, s string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (4, "y")], "k int, s string")
    r = reconcile.multiset_difference(a, b, ["k", "s"]).first()
    assert tuple(r) == (4, 0, 2, 2, 2, 2)


def test_digests_ignore_order_and_see_changes(spark):
    a = spark.createDataFrame(BOOK_ROWS, BOOK)
    first = digest.content_digest(a).first()
    assert digest.content_digest(a.repartition(3).orderBy("b")).first() == first
    assert digest.content_digest(a.filter("k <> 4")).first() != first
    assert digest.content_digest(a.withColumn("b", F.when(F.col("k") == 1, "y").otherwise(F.col("b")))).first()["sha256"] != first["sha256"]
    assert digest.content_digest(a.limit(0)).first()["n_rows"] == 0
    assert digest.run_id({"a": "1", "b": "2"}) == digest.run_id({"b": "2", "a": "1"}) != digest.run_id({"a": "1", "b": "3"})


def test_schema_changes(spark):
    a, b = spark.createDataFrame([], "x int, y string, z double"), spark.createDataFrame([], "y string, x long, w int")
    got = {r["column"]: r["status"] for r in reconcile.schema_diff(reconcile.schema_frame(a), reconcile.schema_frame(b)).collect()}
    assert got == {"x": "type_changed", "y": "moved", "z": "removed", "w": "added"}


# ---- profiles, checks --------------------------------------------------------
def test_numeric_profile(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (None,), (NAN,), (INF,), (2.0,), (2.0,), (-1.0,)], "x double")
    r = profile.profile_numeric(df, ["x"]).first()
    assert (r["n_rows"], r["n_null"], r["n_nan"], r["n_valid"], r["lo"], r["hi"]) == (8, 1, 1, 6, -1.0, 2.0)
    assert (r["top_1"], r["n_1"], r["top_2"], r["n_2"], r["top_3"]) == (0.0, 2, 2.0, 2, -1.0)
    p = profile.profile_numeric(df, ["x"])
    assert set(profile.profile_failures(p).first()) == {0}
    assert profile.profile_failures(p.withColumn("n_nan", F.lit(5))).first()["bad_counts"] == 1
    assert profile.profile_failures(p.withColumn("n_2", F.lit(7))).first()["bad_order"] == 1


def test_checks(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (None,)], "i long")
    r = checks.ordinal_check(df, "i").first()
    assert not r["ok"] and r["n_null"] == 1
    assert checks.ordinal_check(spark.range(5), "id").first()["ok"]
    with pytest.raises(checks.Violation):
        checks.resolve(df, spark.range(2).withColumnRenamed("id", "i").withColumn("v", F.lit(1)), "i", ["v"])
    assert checks.resolve(df, spark.range(2).withColumnRenamed("id", "i").withColumn("v", F.lit(1)), "i", ["v"], halt=False).count() == 4


def test_names_and_types(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Mag-AUTO (f444w)` int, `select` int, `1st` int")
    assert normalise.sanitise(df).columns == ["mag_auto_f444w", "c_select", "c_1st"]
    with pytest.raises(ValueError, match="collide"):
        normalise.sanitise(spark.createDataFrame([(1, 2)], "`a-b` int, `a b` int"))
    assert normalise.column_type("3D").simpleString() == "array<double>"
    assert normalise.column_type("8A").simpleString() == "string"
    for bad in ("3J", "Q", ""):
        with pytest.raises(ValueError):
            normalise.column_type(bad)
    text = spark.createDataFrame([("1", "1.5", "x", None), ("-2", "3", "4", None)], "a string, b string, c string, d string")
    assert {r["column"]: r["type"] for r in normalise.infer_text_types(text).collect()} == {"a": "integer", "b": "decimal", "c": "string", "d": "string"}
    with pytest.raises(ValueError, match="missing"):
        normalise.conform(text, T.StructType().add("zz", "string"))
    assert normalise.conform(text, T.StructType().add("b", "string").add("a", "string")).columns == ["b", "a"]


# ---- sky ---------------------------------------------------------------------
def test_nearest_equals_brute_force_everywhere(spark):
    rnd = random.Random(6)
    spot = lambda: (rnd.choice([rnd.uniform(0, 360), 0.001, 359.999]), rnd.choice([rnd.uniform(-90, 90), 89.9, -89.99, 90.0]))
    targets = [(i, *spot()) for i in range(120)] + [(500, 10.0, 10.0), (501, 10.0, 10.0), (900, NAN, 0.0), (901, -999.0, -999.0)]
    entries = [(i, *spot()) for i in range(60)] + [(200, 10.0, 10.0), (201, None, 1.0)]
    got = {r["e_id"]: (r["t_id"], r["sep"]) for r in sky.nearest(spark.createDataFrame(entries, "e_id long, e_ra double, e_dec double"), spark.createDataFrame(targets, "t_id long, t_ra double, t_dec double"), leaf=4).collect()}

    def sep(a, b):
        r1, d1, r2, d2 = map(math.radians, (*a, *b))
        h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
        return math.degrees(2 * math.asin(min(1.0, math.sqrt(h)))) * 3600

    for i, ra, dec in entries:
        if ra is None:
            assert got[i] == (None, None)
            continue
        best = min((sep((ra, dec), (t[1], t[2])), t[0]) for t in targets if t[0] < 900)
        assert got[i][1] == pytest.approx(best[0], abs=1e-5)
    assert got[200][0] == 500


def test_a_dense_field_and_far_entries(spark, leaf=64):
    """100,000 targets within an arcminute at a pole, none elsewhere; entries among them, beside them and on the other side of the sky."""
    rng = np.random.default_rng(8)
    ra, dec = rng.uniform(0, 360, 100_000), 90 - rng.uniform(0, 1 / 60, 100_000) ** 1.0
    entries = [(i, float(a), float(d)) for i, (a, d) in enumerate([*zip(rng.uniform(0, 360, 150), 90 - rng.uniform(0, 0.02, 150), strict=True), (0.0, 90.0), (180.0, -90.0), (359.9999, 0.0), (0.0, 0.0), (77.0, 89.0)])]
    t = spark.createDataFrame(pd.DataFrame({"t_id": np.arange(100_000), "t_ra": ra, "t_dec": dec})).repartition(4)
    got = {r["e_id"]: (r["t_id"], r["sep"]) for r in sky.nearest(spark.createDataFrame(entries, "e_id long, e_ra double, e_dec double"), t, leaf).collect()}
    assert len(got) == len(entries)
    for i, a, d in entries:
        h = np.sin(np.radians(dec - d) / 2) ** 2 + np.cos(np.radians(d)) * np.cos(np.radians(dec)) * np.sin(np.radians(ra - a) / 2) ** 2
        all_ = np.degrees(2 * np.arcsin(np.minimum(1, np.sqrt(h)))) * 3600
        assert got[i][1] == pytest.approx(all_.min(), abs=1e-5) and all_[got[i][0]] == pytest.approx(all_.min(), abs=1e-5)
    plan = sky.nearest(spark.createDataFrame(entries[:5], "e_id long, e_ra double, e_dec double"), t, leaf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    same = spark.createDataFrame([(i, 10.0, 20.0) for i in range(2000)], "t_id long, t_ra double, t_dec double")  # no cut parts them
    assert sky.nearest(spark.createDataFrame([(1, 10.0, 20.0), (1, 10.0, 21.0)], "e_id long, e_ra double, e_dec double"), same, 2).select("t_id").collect() == [(0,), (0,)]
    assert sky.nearest(spark.createDataFrame([(1, 10.0, 20.0)], "e_id long, e_ra double, e_dec double"), same.limit(0)).collect() == [(1, None, None)]


def test_nearest_in_features_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(17)
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    vectors = [unit([rnd.gauss(0, 1) for _ in range(32)]) for _ in range(150)]
    vectors += [vectors[0]] * 40 + [[0.0] * 32]
    df = spark.createDataFrame([*((i * 7, v) for i, v in enumerate(vectors)), (None, vectors[1]), (9999, None)], "id long, v array<float>").repartition(3)
    held = {r["id"]: r["v"] for r in df.collect() if r["id"] is not None and r["v"] is not None}
    want = {(i, n + 1): j for i, v in held.items() for n, (_, j) in enumerate(sorted((sum((x - y) ** 2 for x, y in zip(v, w, strict=True)), j) for j, w in held.items() if j != i)[:5])}
    for pivots, unit in ((1, 16 << 20), (7, 60 * 256), (64, 16 << 20)):
        monkeypatch.setattr(neighbours, "UNIT_BYTES", unit)
        got = neighbours.nearest_in_features(df, "id", "v", pivots=pivots).collect()
        assert len(got) == len(want) and {(r["id"], r["rank"]): r["neighbour"] for r in got} == want
        assert all(r["distance"] == pytest.approx(math.dist(held[r["id"]], held[r["neighbour"]]), abs=1e-9) for r in got)


def test_cells_that_hold_nothing_nearer_are_left_out(spark, monkeypatch):
    """Clusters far apart, one of them with most rows: queries of a cluster are compared with its cells alone."""
    rnd = random.Random(5)
    rows = [(i, [100.0 * (0 if i < 800 else i % 13) + rnd.random(), rnd.random(), rnd.random()]) for i in range(1400)]
    df = spark.createDataFrame([*rows, (5000, [NAN, 0.0, 0.0]), (5001, [1.0]), (5002, [0.0, None, 0.0]), (5003, None)], "id long, v array<double>").repartition(5)
    compared = spark.sparkContext.accumulator(0)
    plain = neighbours._nearest

    def counting(a, ids, b, others, k):
        compared.add(len(a) * len(b))
        return plain(a, ids, b, others, k)

    monkeypatch.setattr(neighbours, "_nearest", counting)
    got = neighbours.nearest_in_features(df, "id", "v", k=3, queries=F.col("id") % 50 == 0, pivots=40).collect()
    for i in range(0, 1400, 50):
        want = sorted((math.dist(rows[i][1], w), j) for j, w in rows if j != i)[:3]
        assert [(r["neighbour"], pytest.approx(r["distance"], abs=1e-9)) for r in sorted((r for r in got if r["id"] == i), key=lambda r: r["rank"])] == [(j, d) for d, j in want]
    assert len(got) == 28 * 3 and 0 < compared.value < 28 * 1400 / 2
    assert neighbours.nearest_in_features(df.limit(0), "id", "v").count() == 0


def brute_force(ids, x, k):
    """(id, rank): (neighbour, distance), over rows of other ids, equal ones once; of an id that repeats, the least row asks."""
    out = {}
    for i in dict.fromkeys(ids):
        own = min(tuple(v) for j, v in zip(ids, x, strict=True) if j == i)
        near = sorted({(math.sqrt(((np.array(own) - v) ** 2).sum()), int(j)) for j, v in zip(ids, x, strict=True) if j != i})
        out |= {(int(i), n + 1): (j, d) for n, (d, j) in enumerate(near[:k])}
    return out


def test_every_row_asks_among_copies_and_near_copies(spark, monkeypatch):
    """No cell falls away; copies, copies but for the sign of zero, rows that single precision can't tell apart, a key with three vectors, large numbers."""
    monkeypatch.setattr(neighbours, "LEAST", 40)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24))
    x[100:180] = x[0]
    x[180:240] = x[1] + rng.normal(size=(60, 24)) * 1e-7
    x[240:250], x[245:250] = 0.0, -0.0
    for scale in (1.0, 1e25):
        ids = np.r_[rng.permutation(398) * 3, 0, 0]
        df = spark.createDataFrame(list(zip(ids.tolist(), (x * scale).tolist(), strict=True)), "id long, v array<double>").repartition(3)
        got = {(r["id"], r["rank"]): (r["neighbour"], r["distance"]) for r in neighbours.nearest_in_features(df, "id", "v").collect()}
        want = brute_force(ids, x * scale, 5)
        assert got.keys() == want.keys() and {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(got[k][1] == pytest.approx(want[k][1], rel=1e-9) for k in want)
    assert not neighbours.nearest_in_features(df, "id", "v", queries=F.col("id") < 0).count()


def test_few_copies_stand_for_all():
    rows, ids = np.array([[1.0, 0.0]] * 5 + [[1.0, -0.0]] * 3 + [[2.0, 0.0]]), np.array([9, 8, 7, 7, 1, 2, 9, 3, 4])
    few = neighbours._few_copies(rows, ids, 2)
    assert sorted(ids[few]) == [1, 2, 3, 4]


def test_a_round_that_leaves_most_pairs_is_followed_by_the_last(spark, monkeypatch):
    """Without structure two rounds do; a query's vector goes to a bundle of cells once, not to each cell."""
    monkeypatch.setattr(neighbours, "LEAST", 40)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(list(enumerate(rng.normal(size=(320, 48)).tolist())), "id long, v array<double>")
    steps, plain = [], neighbours.cut
    monkeypatch.setattr(neighbours, "cut", lambda frame: steps.append(frame.columns) or plain(frame))
    assert neighbours.nearest_in_features(df, "id", "v", k=2).count() == 640 and len(steps) == 3  # cells and two rounds
    points = rng.normal(size=(9, 3))
    bundles = neighbours._bundles(points, np.array([0, 2, 3, 5, 8]), np.array([5, 5, 5, 30, 5]), 10)
    assert [bundles[c] for c in (1, 4, 6, 7)] == [-1] * 4 and sorted(bundles[c] for c in (0, 2, 3, 5, 8))[-1] <= 4
    rows = dict(zip((0, 2, 3, 5, 8), (5, 5, 5, 30, 5), strict=True))
    assert all(sum(n for c, n in rows.items() if bundles[c] == b) <= 10 or sum(bundles[c] == b for c in rows) == 1 for b in set(bundles) - {-1})


def entries(ledger):
    return sorted((tuple(r) for r in ledger.collect()), key=str)


def test_repeated_keys_are_one_fault_each(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (2, 1.0), (3, 1.0), (3, 1.0), (None, 1.0), (None, 2.0), (5, 1.0)], "k long, a double")
    assert entries(reconcile.reconcile(a, a, "k", ["a"])) == sorted([(k, None, None, "multiplicity") for k in (1, 3, None)], key=str)
    b = spark.createDataFrame([(1, 9.0), (2, 1.0), (2, 2.0), (3, 1.0), (5, 2.0), (6, 1.0), (6, 1.0)], "k long, a double")
    want = [*[(k, None, None, "multiplicity") for k in (1, 2, 3)], (None, None, None, "absent_in_target"), (5, "a", None, "mismatch"), (6, None, None, "absent_in_source")]
    assert entries(reconcile.reconcile(a, b, "k", ["a"])) == sorted(want, key=str)
    # a key that holds most rows shrinks before the shuffle
    hot = spark.range(50_000).select(F.lit(7).cast("long").alias("k"), F.col("id").cast("double").alias("a"))
    assert entries(reconcile.reconcile(hot, hot, "k", ["a"])) == [(7, None, None, "multiplicity")]


WIDE = [(i * 3 - 3000, None if i % 7 == 0 else i * 0.5, f"s{i % 11}", [float(i), None if i % 5 else -0.0]) for i in range(4000)]
TAMPERED = {
    "nothing": lambda rows: rows, "cell": lambda rows: [(k, 0.25 if k == 300 else a, b, v) for k, a, b, v in rows], "null": lambda rows: [(k, None if k == 303 else a, b, v) for k, a, b, v in rows],
    "sign of zero": lambda rows: [(k, -0.0 if k == -3000 else a, b, v) for k, a, b, v in rows], "element": lambda rows: [(k, a, b, [v[1], v[0]] if k == 600 else v) for k, a, b, v in rows], "row": lambda rows: rows[:77] + rows[78:],
    "key": lambda rows: [(10**15 if k == 0 else k, *r) for k, *r in rows], "range": lambda rows: [(k, a, "x" if 1000 <= k < 4000 else b, v) for k, a, b, v in rows], "all": lambda rows: [(k, a, b + "!", v) for k, a, b, v in rows],
    "repeat": lambda rows: [*rows, rows[5]], "no key": lambda rows: [*rows, (None, 1.0, "n", None)], "least and most": lambda rows: [(-(2**63), 1.0, "a", None), *rows, (2**63 - 1, 1.0, "z", None)], "empty": lambda rows: [],
}


@pytest.mark.parametrize(("name", "place"), [*((n, "long") for n in TAMPERED), *((n, "string") for n in ("nothing", "row", "no key"))])
def test_tree_finds_what_the_full_comparison_finds(spark, name, place):
    columns, base = ["a", "b", "v"], [*WIDE, WIDE[40]]  # a key that repeats on both sides alike
    frame = lambda rows: spark.createDataFrame(rows, BOOK).withColumn("k", F.col("k").cast(place)).repartition(3)
    source, target = frame(base), frame(TAMPERED[name](base))
    want = entries(reconcile.reconcile(source, target, "k", columns))
    assert entries(reconcile.tree_reconcile(source, target, "k", columns, fanout=16, few=20)) == want
    found = reconcile.differences(source, target, "k", columns, fanout=16, few=20)
    if name == "nothing":
        assert found == ([], False) and want == [(str(WIDE[40][0]) if place == "string" else WIDE[40][0], None, None, "multiplicity")]
    if name in ("cell", "null", "element", "sign of zero") and place == "long":
        assert sum(high - low for low, high in found.ranges) <= 12_000 / 16**2 + 1  # one leaf of the second level
    if name == "no key":
        assert found.nulls and not found.ranges


def test_tree_with_declared_types(spark):
    source = spark.createDataFrame([(i, i * 20) for i in range(3000)], "k int, n long")
    target = source.select("k", F.when(F.col("n") <= 32767, F.col("n")).cast("short").alias("n"))
    args = ("k", ["n"], {"n": "smallint"})
    want = entries(reconcile.reconcile(source, target, *args))
    assert len(want) == 1361 and {w[3] for w in want} == {"cast"} and entries(reconcile.tree_reconcile(source, target, *args, fanout=8, few=100)) == want
    assert reconcile.differences(source, target, "k", ["n"]) is None  # unlike types
    assert len(entries(reconcile.tree_reconcile(source, target, "k", ["n"]))) == 1361


# ---- arrays, declared types, contracts ---------------------------------------
@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (None, [1.0], [(None, "mismatch")]), ([1.0], None, [(None, "mismatch")]), ([1.0], [1.0, None], [(None, "mismatch")]), ([1.0, 2.0], [1.0], [(None, "mismatch")]), ([], None, [(None, "mismatch")]),
        ([1.0, 2.0, 3.0], [1.5, 2.0, 3.5], [(0, "mismatch"), (2, "mismatch")]), ([None, NAN], [NAN, None], [(0, "mismatch"), (1, "mismatch")]), ([0.0], [-0.0], [(0, "mismatch")]),
        (None, None, []), ([], [], []), ([NAN, None, INF], [NAN, None, INF], []),
    ],
)
def test_arrays_differ_whole_or_by_element(spark, a, b, want):
    frame = lambda v: spark.createDataFrame([(1, v), (2, [9.0])], "k long, v array<double>")
    got = reconcile.reconcile(frame(a), frame(b), "k", ["v"]).collect()
    assert sorted(((r["index"], r["kind"]) for r in got), key=str) == sorted(want, key=str)
    assert all((r["k"], r["column"]) == (1, "v") for r in got)


def test_exact_casts(spark):
    source = spark.createDataFrame([(1, 5, 1.1, bytearray("é".encode()), [1, 70000]), (2, 40000, NAN, None, [1]), (3, None, -0.0, bytearray(b"x"), None), (4, -32768, 1e300, bytearray(b""), [3, None])], "k int, i long, f double, s binary, v array<long>")
    target = spark.createDataFrame([(1, 5, 1.1, "é", None), (2, None, None, None, [1]), (3, None, 0.0, "x", None), (4, -32768, INF, "", [3, None])], "k int, i short, f float, s string, v array<int>")
    declared = {"i": "smallint", "f": "real", "s": "text", "v": "smallint[]"}
    got = {(r["k"], r["column"], r["index"], r["kind"]) for r in reconcile.reconcile(source, target, "k", list(declared), declared).collect()}
    assert got == {(2, "i", None, "cast"), (3, "f", None, "mismatch"), (1, "v", None, "cast")}
    for kind, wrong in ((T.DoubleType(), "integer"), (T.BooleanType(), "real"), (T.LongType(), "text"), (T.StringType(), "boolean"), (T.LongType(), "bigint[]"), (T.LongType(), "uuid")):
        with pytest.raises(TypeError):
            reconcile.exact_cast(F.col("x"), kind, wrong)
    sized = source.select("k", reconcile.exact_cast(F.col("v"), source.schema["v"].dataType, "bigint[]", 2)[1].alias("bad"))
    assert {r["k"]: r["bad"] for r in sized.collect()} == {1: False, 2: True, 3: False, 4: False}


def test_array_profile_counts_absent_arrays_and_top_values(spark):
    df = spark.createDataFrame([([1.0, NAN],), ([1.0, 2.0],), (None,), ([3.0, None],), ([-0.0, 2.0],)], "v array<double>")
    first, second = profile.profile_array(df, "v").orderBy("index").collect()
    assert (first["n_rows"], first["n_null"], first["n_valid"], first["n_absent"], first["top_1"], first["n_1"], first["top_2"], first["n_2"]) == (5, 1, 4, 1, 1.0, 2, 0.0, 1)
    assert (second["n_rows"], second["n_null"], second["n_nan"], second["top_1"], second["n_1"], second["top_2"]) == (5, 2, 1, 2.0, 2, None)
    assert profile.profile_array(df.limit(0), "v").count() == 0


def test_manifests(spark):
    import datetime

    at = datetime.datetime(2024, 1, 1, 12, 0, 0, 400000)
    kind = "path string, bytes long, sha256 string, modified timestamp"
    seen = [("a", 1, "x", at), ("b", 1, "x", at), ("c", 1, "x", at), ("d", 1, "x", at)]
    said = [("a", 1, "x", at.replace(microsecond=0)), ("b", 2, "y", at), ("c", 1, "x", at.replace(second=1)), ("e", 1, "x", at), ("e", 1, "x", at)]
    got = {tuple(r) for r in reconcile.manifest_diff(spark.createDataFrame(said, kind), spark.createDataFrame(seen, kind)).collect()}
    assert got == {("b", "size_differs"), ("b", "hash_differs"), ("c", "time_differs"), ("d", "extra"), ("e", "missing"), ("e", "duplicate_declared")}


def test_conformance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "x"), (2, [1.0], None), (3, None, "y")], "k long, v array<double>, s string")
    contract = reconcile.schema_frame(df).withColumn("array_length", F.when(F.col("column") == "v", 2))
    assert {tuple(r) for r in reconcile.conformance(df, contract).collect()} == {("v", "wrong_length", 1)}
    assert reconcile.conformance(df.filter("k <> 2"), contract).count() == 0
    got = {tuple(r) for r in reconcile.conformance(df.select("v", F.col("k").cast("int").alias("k")), contract).collect()}
    assert got == {("v", "wrong_length", 1), ("v", "moved", 1), ("k", "moved", 1), ("k", "type_differs", 1), ("s", "missing", 1)}


def test_splits_need_enough_units(spark):
    tiles = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "tile string")
    assert splits.hash_split(tiles, "tile", "s", 1, 1).count() == 2
    with pytest.raises(Exception, match="fewer than 3 units"):
        splits.hash_split(tiles, "tile", "s", 2, 1).collect()
    assert [r["k"] for r in splits.modulus_sample(spark.range(-4, 20).withColumnRenamed("id", "k"), "k", 8, 3).orderBy("k").collect()] == [3, 11, 19]


def test_group_rules_of_a_hot_entity(spark):
    rows = [(1, 1.0, 95)] * 50 + [(1, 2.0, 95), (1, 3.0, 0), (1, 4.0, None), (2, 1.0, None), (2, 2.0, 0), (3, 1.0, -1), (3, 2.0, -1), (4, 5.0, 1)]
    got = {(r["rule"], r["label"]): r["n"] for r in measure.group_rules(spark.createDataFrame(rows, "ent long, z double, conf long")).collect()}
    assert got == {("finite_gt_-90", "disagreeing"): 3, ("positive", "disagreeing"): 3, ("either", "disagreeing_tied_top"): 2}


def test_digest_levels_restated(spark):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    df = spark.range(300).select("id", F.col("id").cast("string").alias("s"))
    level = sorted((h, h) for h in (sha(f'seed{{"id":{i},"s":"{i}"}}') for i in range(300)))
    for digits in (6, 3, 0):
        groups = {}
        for p, d in level:
            groups.setdefault(p[:digits], []).append(d)
        level = sorted((p, sha("\n".join(d))) for p, d in groups.items())
    r = digest.content_digest(df, "seed").first()
    assert (r["n_rows"], r["sha256"]) == (300, level[0][1])


def test_isolation_forest_of_odd_rows(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(40)] + [(100, None), (101, [1.0, None, 2.0]), (102, [NAN, 1.0, 1.0]), (103, [1.0]), (104, []), (105, [50.0, 50.0, 1.0]), (105, [50.0, 50.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    got = sorted(map(tuple, outliers.isolation_scores(df, "id", "v", trees=20).collect()))
    assert [i for i, _ in got] == sorted(i for i, _ in rows)
    assert {i for i, s in got if s is None} == {100, 101, 102, 103, 104} and got[-1][1] == got[-2][1] == max(s for _, s in got if s is not None)
    assert "Python" not in outliers.isolation_scores(df, "id", "v", trees=3)._jdf.queryExecution().toString()
    nothing = df.filter("id between 100 and 102")
    assert [r["score"] for r in outliers.isolation_scores(nothing, "id", "v").collect()] == [None] * 3 and outliers.isolation_scores(df.limit(0), "id", "v").count() == 0
    same = spark.createDataFrame([(i, [2.0, 2.0]) for i in range(9)], "id long, v array<double>")
    assert len({r["score"] for r in outliers.isolation_scores(same, "id", "v", trees=2).collect()}) == 1


def test_isolation_forest_sets_outliers_apart(spark):
    rnd = random.Random(23)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(600)] + [(9000 + i, [8.0 + i, -9.0, 7.0, 10.0 * (-1) ** i]) for i in range(6)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {r["id"]: r["score"] for r in outliers.isolation_scores(df, "id", "v").collect()}
    assert len(got) == len(rows) and all(0 < s < 1 for s in got.values())
    assert set(sorted(got, key=got.get)[-6:]) == {9000 + i for i in range(6)}
    assert {r["id"]: r["score"] for r in outliers.isolation_scores(df.repartition(7), "id", "v").collect()} == pytest.approx(got)


def test_bytes_and_codes(spark):
    df = spark.createDataFrame([(bytearray(b" ab  "), "7", " x ", 1.5)], "b binary, i string, a string, o double")
    assert df.select(K.ascii_text(F.col("b"))).first()[0] == "ab"
    out = normalise.cast_by(df, {"i": "J", "a": "4A"})
    assert out.schema["i"].dataType == T.IntegerType() and tuple(out.first())[1:] == (7, "x", 1.5)
    with pytest.raises(Exception, match="CAST|OVERFLOW"):
        normalise.cast_by(spark.createDataFrame([(1 << 40,)], "i long"), {"i": "J"}).collect()
