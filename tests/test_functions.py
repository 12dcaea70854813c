"""Row expressions, quantiles and joins, against plain Python."""

from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from groundburn.functions import clock, intermediate, joins
from groundburn.functions import quantiles as Q
from groundburn.functions.calendar import DAY_SHORT, day_name, period
from groundburn.functions.numeric import mean, rnd, share, tally
from groundburn.functions.weather import main_condition, overlapping_conditions
from groundburn.params import Params

quick = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

TIMES = [None, -2400, -1, 0, 1, 59, 60, 99, 100, 650, 750, 1260, 2300, 2350, 2359, 2360, 2399, 2400, 2401, 10000]


def _hour(t):
    if t == 2400:
        return 0
    return t // 100 if t is not None and 0 <= t <= 2359 else None


def test_clock(spark):
    t = F.col("t")
    rows = spark.createDataFrame([(x,) for x in TIMES], "t long").select(
        "t", clock.hour(t).alias("h"), clock.strict_hour(t).alias("s"), clock.rounded_hour(t).alias("r"),
        clock.floor_hour(t).alias("f"), clock.time_class(t).alias("c"), clock.off_clock(t).alias("off"),
    ).collect()
    for row in rows:
        x = row.t
        assert row.h == _hour(x)
        assert row.s == (_hour(x) if x is not None and (x % 100 <= 59 or x == 2400) else None)
        assert row.r == (None if x is None else round(x / 100))
        assert row.f == (None if x is None else float(math.floor(x / 100)))
    assert {r.t: r.c for r in rows} == {
        None: "nulo", -2400: "negativo", -1: "negativo", 0: "hhmm_valido", 1: "hhmm_valido", 59: "hhmm_valido",
        60: "minuto_invalido_0_2359", 99: "minuto_invalido_0_2359", 100: "hhmm_valido", 650: "hhmm_valido",
        750: "hhmm_valido", 1260: "minuto_invalido_0_2359", 2300: "hhmm_valido", 2350: "hhmm_valido",
        2359: "hhmm_valido", 2360: "2360_a_2399", 2399: "2360_a_2399", 2400: "2400_medianoche",
        2401: "mayor_2400", 10000: "mayor_2400"}
    assert {r.t for r in rows if r.off} == {-2400, -1, 60, 99, 1260, 2360, 2399, 2401, 10000}


def test_rounding_scales_before_it_rounds(spark):
    x = F.col("x")
    row = spark.createDataFrame([(1.005,)], "x double").select(
        rnd(x, 2).alias("a"), rnd(F.lit(2.5)).alias("b"), rnd(F.lit(-2.5)).alias("c"), rnd(F.lit(0.125), 2).alias("d"),
    ).first()
    assert tuple(row) == (1.0, 3.0, -3.0, 0.13)


def test_counting(spark):
    df = spark.createDataFrame([("a", True), ("a", None), ("a", False), ("b", None)], "k string, c boolean")
    got = {r.k: r.n for r in df.groupBy("k").agg(tally(F.col("c")).alias("n")).collect()}
    assert got == {"a": 1, "b": None}


def test_shares_of_nothing(spark):
    row = spark.range(1).select(share(F.lit(0), F.lit(0)).alias("s"), mean(F.lit(3.0), F.lit(0)).alias("m")).first()
    assert tuple(row) == (None, None)


def test_days_and_periods(spark):
    df = spark.createDataFrame([(d,) for d in (None, 0, 1, 7, 8)], "d long")
    assert [r[0] for r in df.select(day_name(F.col("d"), DAY_SHORT)).collect()] == [None, None, "Lun", "Dom", None]
    assert str(spark.range(1).select(period(F.lit(2024), F.lit(2))).first()[0]) == "2024-02-01"


def test_weather_labels(spark):
    days = [(0.0, 0.0, 10.0), (9.0, 1.0, 99.0), (9.0, 0.0, 99.0), (5.0, 0.0, 40.0), (5.0, 0.0, 39.9),
            (None, None, None), (None, None, 40.0), (0.1, None, None)]
    df = spark.createDataFrame(days, "precipitacion_mm double, nieve_cm double, viento_max_kmh double")
    p = Params()
    labels = [r[0] for r in df.select(main_condition(p)).collect()]
    assert labels == ["normal", "nieve", "lluvia_fuerte", "viento_fuerte", "lluvia_leve", "normal", "viento_fuerte",
                      "lluvia_leve"]
    met = df.select(*[c.alias(n) for n, c in overlapping_conditions(p).items()]).collect()
    assert [n for n in met[5].asDict() if met[5][n]] == []
    assert [n for n in met[0].asDict() if met[0][n]] == ["sin_lluvia", "sin_nieve", "viento_normal"]


@quick
@given(st.lists(st.one_of(st.none(), st.integers(-5, 30)), min_size=1, max_size=60))
def test_histogram_statistics(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    row = Q.histogram(df, [], ["x"]).groupBy(Q.VARIABLE).agg(
        Q.present().alias("n"), Q.average().alias("m"), Q.deviation().alias("s"),
        *[Q.quantile(q).alias(f"q{i}") for i, q in enumerate((0.5, 0.9, 0.99))]).first()
    known = [v for v in values if v is not None]
    assert row.n == len(known)
    if not known:
        assert (row.m, row.q0) == (None, None)
        return
    assert row.m == pytest.approx(statistics.fmean(known))
    assert [row.q0, row.q1, row.q2] == pytest.approx(list(np.quantile(known, [0.5, 0.9, 0.99])))
    if len(known) > 1:
        assert row.s == pytest.approx(statistics.stdev(known), abs=1e-9)
    else:
        assert row.s is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("max_rows", [0, 1000])
def test_join_is_the_same_broadcast_or_not(spark, how, max_rows):
    # Two thirds of the rows share one key, and NULL keys never match.
    large = spark.range(600).select(F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 5 == 0, None)
                                    .otherwise(F.col("id") % 40).cast("int").alias("k"), "id")
    small = spark.createDataFrame([(7, "hot"), (3, "x"), (3, "y"), (None, "n")], "k int, v string")
    got = joins.join_sized(large, small, ["k"], how, max_rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (max_rows > 0)
    assert sorted(map(str, got.collect())) == sorted(map(str, large.join(small, ["k"], how).collect()))


def test_join_refuses_sides_it_cannot_split(spark):
    with pytest.raises(ValueError):
        joins.join_sized(spark.range(1), spark.range(1), ["id"], "full_outer")


def test_materialised_table_equals_its_source(spark):
    df = spark.range(10).select("id", (F.col("id") % 3).cast("int").alias("k"), F.lit(None).cast("string").alias("n"))
    kept = intermediate.materialise(df)
    assert kept.schema.simpleString() == df.schema.simpleString()
    assert sorted(kept.collect()) == sorted(df.collect())
    assert kept.inputFiles()


def test_params_know_their_scenarios():
    assert (Params().rate("bajo"), Params().rate("alto")) == (6.0, 12.0)
    with pytest.raises(ValueError):
        Params().rate("medio")


def _numpy_quantiles(rows, shares):
    """Of (key, value, weight), by spelling every repetition out."""
    out = {}
    for key in {r[0] for r in rows}:
        values = np.repeat([r[1] for r in rows if r[0] == key and r[1] is not None], [r[2] for r in rows if r[0] == key and r[1] is not None])
        out[key] = tuple(float(np.quantile(values, q)) if len(values) else None for q in shares)
    return out


SHARES = {"least": 0.0, "median": 0.5, "p90": 0.9, "p99": 0.99, "most": 1.0}


@pytest.mark.parametrize("ranked", [False, True])
def test_quantiles_by_ranks_and_by_one_task(spark, monkeypatch, ranked):
    rng = np.random.default_rng(5)
    rows = [(k, float(v), int(w)) for k, n in (("a", 3000), ("b", 700), (None, 41)) for v, w in zip(rng.normal(size=n), rng.integers(1, 9, n))]
    rows += [("one", 2.5, 1), ("same", 1.25, 1000), ("pair", 1.0, 1), ("pair", 4.0, 3), ("none", None, 7), ("a", None, 9), ("hot", 0.5, 10**7), ("hot", 0.75, 2)]
    counted = spark.createDataFrame(rows, "k string, v double, w long")
    if ranked:
        monkeypatch.setattr(Q, "MOST_VALUES", 10)
    found = Q.summarised(counted, ["k"], [F.sum("w").alias("n")], SHARES, "v", "w")
    got = {r.k: tuple(r[name] for name in SHARES) for r in found.collect()}
    assert {r.k: r.n for r in found.collect()} == {k: sum(r[2] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    for key, want in _numpy_quantiles([r for r in rows if r[0] != "hot"], SHARES.values()).items():
        assert got[key] == pytest.approx(want) if want[0] is not None else got[key] == want, key
    assert got["hot"] == pytest.approx((0.5, 0.5, 0.5, 0.5, 0.75))
    everything = [(0, v, w) for k, v, w in rows if k not in ("hot", "none")]
    whole = Q.summarised(counted.where("k IS NULL OR k NOT IN ('hot', 'none')"), [], [F.sum("w").alias("n")], SHARES, "v", "w").first()
    assert tuple(whole[name] for name in SHARES) == pytest.approx(_numpy_quantiles(everything, SHARES.values())[0])


def test_no_task_gets_many_of_the_values(spark, monkeypatch):
    """A group of very many fractional values is dealt to ranges; only a few of them are looked into."""
    n = 300_000
    monkeypatch.setattr(Q, "MOST_VALUES", 10_000)
    stored = []
    kept = Q.materialise
    monkeypatch.setattr(Q, "materialise", lambda df: (stored.append(kept(df)), stored[-1])[1])
    counted = spark.range(n).selectExpr("1 AS k", "sin(id) * 1000 AS v", "1L AS w")
    row = Q.summarised(counted, ["k"], [], SHARES, "v", "w").first()
    values = np.sort([r.v for r in stored[0].select("v").collect()])
    assert [row[name] for name in SHARES] == pytest.approx([np.quantile(values, q) for q in SHARES.values()])
    sizes = [r["count"] for r in stored[-1].groupBy("_part").count().collect()]
    assert len(sizes) > 200 and max(sizes) * 2 * len(SHARES) < n / 20 and max(sizes) < n / 50


def test_quantiles_of_no_rows(spark):
    none = spark.createDataFrame([], "k string, v double, w long")
    assert Q.summarised(none, ["k"], [], SHARES, "v", "w").isEmpty()
    assert tuple(Q.summarised(none, [], [F.sum("w").alias("n")], {"m": 0.5}, "v", "w").first()) == (None, None)
