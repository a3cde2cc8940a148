"""Row formulas on hand-made rows (zero demand, zero cost, bin edges, ties,
null classes)."""

from pyspark.sql import functions as F

from packflow import config as C
from packflow.functions.exprs import bin_right_closed, class_factor, class_lookup, clip, round_half_even
from packflow.operators import dispatch as DP
from packflow.operators import packs as PK
from packflow.operators import production as P


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_eoq_branches(spark):
    rows = [(0.0, 10.0), (100.0, 0.0), (100.0, 10.0), (0.001, 50.0), (None, 10.0)]
    got = one(spark, rows, "d double, c double", P.batch_size_eoq("d", "c"))
    # sqrt(2*100*365*500/(0.22*10)) = 4073.4... -> 4073; tiny demand -> floor 50
    assert got == [100, 100, 4073, 50, 100]


def test_lead_time_and_target(spark):
    rows = [(500.0, 0.0), (500.0, 10.0), (10000.0, 1.0), (10.0, 100.0)]
    got = one(spark, rows, "b double, t double", P.lead_time_days(F.col("b"), F.col("t")))
    assert got == [14, 30, 30, 1]
    t = one(spark, [(100.0, 1000.0, 4)], "d double, cap double, n long",
            P.target_production(F.col("d"), F.col("cap"), F.col("n")))
    assert t == [min(100 * 1.05, 1000 / 4 * 0.82)]


def test_bins_right_closed(spark):
    rows = [(0.0,), (100.0,), (100.01,), (500.0,), (500.01,), (-1.0,), (None,)]
    got = one(spark, rows, "v double", bin_right_closed("v", C.SCHEDULE_LABELS))
    assert got == [None, "Low", "Medium", "Medium", "High", None, None]


def test_half_even_rounding(spark):
    rows = [(2.5,), (3.5,), (0.25,), (0.35,), (-2.5,)]
    assert one(spark, rows, "v double", round_half_even("v", 0)) == [2.0, 4.0, 0.0, 0.0, -2.0]
    assert one(spark, rows, "v double", round_half_even("v", 1)) == [2.5, 3.5, 0.2, 0.4, -2.5]


def test_clip_keeps_null(spark):
    assert one(spark, [(-1.0,), (0.5,), (3.0,), (None,)], "v double", clip("v", 0.0, 1.0)) == [0.0, 0.5, 1.0, None]


def test_class_defaults(spark):
    rows = [("fast_mover",), ("medium_mover",), ("slow_mover",), (None,), ("other",)]
    up = one(spark, rows, "c string", class_factor("c", C.REVENUE_UPLIFT, C.REVENUE_UPLIFT_ELSE))
    assert up == [1.12, 1.08, 1.05, 1.05, 1.05]
    debt = one(spark, rows, "c string", class_lookup("c", C.DEBTOR_IMPROVEMENT, C.DEBTOR_IMPROVEMENT_DEFAULT))
    assert debt == [0.30, 0.27, 0.25, 0.27, 0.27]
    inv = one(spark, rows, "c string", PK.inventory_reduction(F.col("c")))
    assert inv == [30.0, 23.0, 15.0, 20.0, 20.0]


def test_unknown_class_gets_medium_pack(spark):
    df = spark.createDataFrame([("A", "weird"), ("B", None), ("C", "fast_mover")], "SkuId string, velocity_class string")
    got = {r.SkuId: r.PackMultiplier for r in PK.join_pack_config(df).collect()}
    assert got == {"A": 12, "B": 12, "C": 24}


def test_scores_and_pack_qty(spark):
    # share 1 -> 60; cv 0.25 -> 30 ; 90.0
    s = one(spark, [(1.0, 0.25), (0.5, 2.0)], "s double, cv double",
            PK.justification_score(F.col("s"), F.col("cv")))
    assert s == [90.0, 30.0]
    q = one(spark, [(0.0, 12), (12.5, 12), (1.25, 24)], "f double, m long",
            PK.recommended_pack_qty(F.col("f"), F.col("m")))
    assert q == [1, 5, 1]   # 12.5*12/30 = 5.0 ; 1.25*24/30 = 1.0


def test_dispatch_lead_times(spark):
    lt = one(spark, [(15.0,), (5.0,), (10.0,)], "lt double", DP.optimised_lead_time(F.col("lt")))
    import numpy as np

    def ref(x):  # the reference's expression order, NumPy rounding
        red = 29.0 - min(max((x - 5.0) / 10.0, 0.0), 1.0) * 8.0
        return float(np.round(max(x * (1.0 - red / 100.0), 1.0), 1))
    assert lt == [ref(15.0), ref(5.0), ref(10.0)]
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in DP.min_max_scale(df, "v", "n").collect()] == [0.5, 0.5]


def test_downgrade_keeps_qty_and_factor(spark):
    reco = spark.createDataFrame(
        [("A", "fast_mover", "Bulk Logistics Case", 24, 10, 80.0, 0.85, 30.0),
         ("B", "medium_mover", "Standard Consumer Pack", 12, 5, 50.0, 1.0, 23.0)],
        "SkuId string, VelocityClass string, PackConfig string, PackMultiplier long, "
        "RecommendedPackQty long, JustificationScore double, CostFactor double, EstInventoryReductionPct double")
    flagged = spark.createDataFrame([("A",)], "SkuId string")
    got = {r.SkuId: r for r in PK.downgrade_unprofitable(reco, flagged).collect()}
    a = got["A"]
    assert (a.VelocityClass, a.PackMultiplier, a.RecommendedPackQty, a.CostFactor) == ("slow_mover", 6, 10, 0.85)
    assert abs(a.JustificationScore - 56.0) < 1e-9 and a.EstInventoryReductionPct == 30.0
    assert got["B"].VelocityClass == "medium_mover"
