"""Invariants: chunking, skew and order of input never change a result."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from causalgrid.operators import asof, chunks, intervals, metrics, quantiles, regular, rollup, split, validate
from causalgrid.operators.asof import Series
from causalgrid.operators.chunks import Grid
from causalgrid.operators.rolling import Rolling, build_order, min_periods, pieces, rolling, rolling_frames
from causalgrid.plans import gold

T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)


def frame(spark, rows, schema):
    rows = list(rows)
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, schema).repartition(5)


def series(spark, values, zone="SE1", start=T0):
    return frame(spark, [(zone, start + i * HOUR, v) for i, v in enumerate(values)], "zone string, timestamp_utc timestamp, x double")


def column(df, name="x"):
    return [r[name] for r in df.orderBy("zone", "timestamp_utc").collect()]


@pytest.mark.parametrize("chunk", [3, 4_096])
def test_bounded_filling_literal(spark, chunk):
    n = None
    raw = [n, 1.0, n, n, n, 5.0, n, n, n]
    grid = Grid(chunk_steps=chunk)
    assert column(regular.fill_gaps(series(spark, raw), grid, linear={"x": 2})) == [n, 1.0, 2.0, 3.0, n, 5.0, 5.0, 5.0, n]
    assert column(regular.fill_gaps(series(spark, raw), grid, ffill={"x": 2})) == [n, 1.0, 1.0, 1.0, n, 5.0, 5.0, 5.0, n]
    assert column(regular.fill_gaps(series(spark, raw), grid, ffill={"x": None})) == [n, 1.0, 1.0, 1.0, 1.0, 5.0, 5.0, 5.0, 5.0]
    held = regular.fill_gaps(series(spark, raw), grid, linear={"x": 2}, hold=["x"])
    assert column(held) == [n, 1.0, 2.0, 3.0, 3.0, 5.0, 5.0, 5.0, 5.0]


@pytest.mark.parametrize("chunk", [5, 64, 4_096])
def test_regularize_matches_pandas(spark, chunk):
    """One zone holds most rows; gaps are longer than chunks."""
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for zone, n in (("SE1", 700), ("SE2", 40), ("SE3", 1)):
        at = sorted(rng.choice(n * 2, n, replace=False).tolist())
        vals = [None if rng.random() < 0.3 else float(rng.integers(0, 100)) for _ in at]
        rows += [(zone, T0 + a * HOUR, v, v) for a, v in zip(at, vals)]
        s = pd.Series(vals, index=[T0 + a * HOUR for a in at], dtype=float)
        s = s.reindex(pd.date_range(s.index.min(), s.index.max(), freq="h"))
        want[zone] = (s.interpolate(limit=6, limit_direction="forward"), s.ffill(limit=6), s.isna())
    df = frame(spark, rows, "zone string, timestamp_utc timestamp, a double, b double")
    out = regular.regularize(df, Grid(chunk_steps=chunk), linear={"a": 6}, ffill={"b": 6}, imputed_from="a").toPandas()
    for zone, (a, b, gap) in want.items():
        got = out[out.zone == zone].sort_values("timestamp_utc").set_index("timestamp_utc")
        assert list(got.index) == list(a.index)
        np.testing.assert_allclose(got.a, a, rtol=1e-12)
        np.testing.assert_allclose(got.b, b, rtol=1e-12)
        assert got.has_imputed_grid.tolist() == gap.tolist()


def test_off_grid_rows_disappear_and_phase_is_kept(spark):
    half = dt.timedelta(minutes=30)
    rows = [("SE1", T0 + half + i * HOUR, float(i)) for i in range(4)] + [("SE1", T0 + 2 * HOUR, 99.0)]
    rows += [("SE2", T0 + i * HOUR, float(i)) for i in (0, 3)]
    out = regular.regularize(frame(spark, rows, "zone string, timestamp_utc timestamp, x double"), Grid(chunk_steps=2))
    assert column(out.where("zone = 'SE1'")) == [0.0, 1.0, 2.0, 3.0]
    assert column(out.where("zone = 'SE1'"), "timestamp_utc")[0] == T0 + half
    assert column(out.where("zone = 'SE2'")) == [0.0, None, None, 3.0]


def test_keep_first_and_last(spark):
    df = frame(spark, [("a", i % 3, i) for i in range(30)] + [("b", 1, 5)], "k string, o int, v int")
    last = {r.k: (r.o, r.v) for r in regular.keep_last(df, ["k"], ["o", "v"]).collect()}
    first = {r.k: (r.o, r.v) for r in regular.keep_first(df, ["k"], ["o", "v"]).collect()}
    assert last == {"a": (2, 29), "b": (1, 5)} and first == {"a": (0, 0), "b": (1, 5)}


@pytest.mark.parametrize("width", [1, 5, 24, 25, 47, 48, 49, 168, 720, 2_016, 9_999])
def test_pieces_tile_every_width(width):
    built = []
    for w in build_order({width}):
        parts = pieces(w, built)
        covered = sorted(x for unit, at in parts for x in range(at, at + unit))
        assert covered == list(range(w)) and len(parts) <= 40
        assert all(unit in built or (not built) or unit < built[0] for unit, _ in parts)
        built.append(w)
    assert width in built


@pytest.mark.parametrize("chunk", [2_000, 40_000])
def test_rolling_matches_frames_and_pandas(spark, chunk):
    rng = np.random.default_rng(5)
    values = [None if rng.random() < 0.2 else float(v) for v in rng.normal(1e6, 1, 1_500)]
    df = series(spark, values)
    specs = [
        Rolling("x", n, s, f"{s}_{n}", min_periods(n)) for n in (1, 7, 24, 100, 168, 720) for s in ("mean", "std", "min", "max", "sum", "count")
    ]
    grid = Grid(chunk_steps=chunk)
    halo = chunks.with_halo(df, grid, 719)
    lifted = chunks.home_rows(rolling(halo, grid, specs)).toPandas().sort_values("timestamp_utc").reset_index(drop=True)
    plain = rolling_frames(df, Window.partitionBy("zone").orderBy("timestamp_utc"), specs).toPandas().sort_values("timestamp_utc").reset_index(drop=True)
    s = pd.Series(values, dtype=float)
    for spec in specs:
        np.testing.assert_allclose(lifted[spec.name].astype(float), plain[spec.name].astype(float), rtol=1e-7, err_msg=spec.name)
        if spec.stat != "count":
            want = getattr(s.rolling(spec.width, min_periods=spec.min_count), spec.stat)()
            np.testing.assert_allclose(lifted[spec.name].astype(float), want, rtol=1e-6, err_msg=spec.name)


def test_rolling_of_a_constant_has_no_spread(spark):
    grid = Grid().sized_for(719)
    out = rolling(chunks.with_halo(series(spark, [0.1] * 800), grid, 719), grid, [Rolling("x", 720, "std", "s", 1)])
    assert set(column(chunks.home_rows(out), "s")[1:]) == {0.0}


@pytest.mark.parametrize("direction,tolerance", [("backward", None), ("backward", 3_600), ("nearest", None), ("nearest", 1_800)])
@pytest.mark.parametrize("chunk,rows", [(7_200, 1_000_000), (90 * 86_400, 1_000_000), (90 * 86_400, 30)])
def test_asof_matches_pandas(spark, direction, tolerance, chunk, rows):
    rng = random.Random(9)
    hot = ["SE1"] * 8 + ["SE2", "SE3"]
    left = [(rng.choice(hot), T0 + dt.timedelta(seconds=rng.randrange(400_000)), i) for i in range(400)]
    right = {(rng.choice(hot), T0 + dt.timedelta(seconds=60 * rng.randrange(5_000))): float(i) if i % 5 else None for i in range(60)}
    right = [(z, t, v) for (z, t), v in right.items()]
    ldf = frame(spark, left, "zone string, timestamp_utc timestamp, i int")
    rdf = frame(spark, right, "zone string, t timestamp, v double")
    got = asof.asof_join(ldf, Series(rdf, "t", ("v",)), direction=direction, tolerance_seconds=tolerance, chunk_seconds=chunk, rows_per_task=rows)
    got = {r.i: r.v for r in got.collect()}
    lp = pd.DataFrame(left, columns=["zone", "ts", "i"]).sort_values("ts")
    rp = pd.DataFrame(right, columns=["zone", "ts", "v"]).sort_values("ts")
    tol = None if tolerance is None else pd.Timedelta(seconds=tolerance)
    want = pd.merge_asof(lp, rp, on="ts", by="zone", direction=direction, tolerance=tol)
    want = {i: None if pd.isna(v) else v for i, v in zip(want.i, want.v)}
    assert got == want and len(got) == len(left)


def test_asof_settles_equal_times_and_keeps_null_matches(spark):
    left = frame(spark, [("SE1", T0 + i * HOUR) for i in range(4)], "zone string, timestamp_utc timestamp")
    right = frame(spark, [("SE1", T0 + HOUR, 1, 5.0), ("SE1", T0 + HOUR, 2, 4.0), ("SE1", T0 + 2 * HOUR, 1, None)], "zone string, t timestamp, o int, v double")
    assert column(asof.asof_join(left, Series(right, "t", ("v",), tiebreak=("o",))), "v") == [None, 4.0, None, None]


def test_calendar_and_stream_agree_at_the_step(spark):
    hours = frame(spark, [("SE1", dt.datetime(2024, 3, 20) + i * HOUR) for i in range(24 * 14)], "zone string, timestamp_utc timestamp")
    rates = frame(spark, [(dt.datetime(2024, 3, 22), 4.0), (dt.datetime(2024, 3, 27), 3.75), (dt.datetime(2024, 4, 30), 9.0), (dt.datetime(2024, 3, 28), None)], "d timestamp, r double")
    a = asof.asof_calendar(hours, rates, "d", ["r"])
    b = asof.asof_join(hours, Series(rates.where("r is not null"), "d", ("r",)), by=())
    got = {r.timestamp_utc: r.r for r in a.collect()}
    assert got == {r.timestamp_utc: r.r for r in b.collect()}
    assert got[dt.datetime(2024, 3, 26, 23)] == 4.0 and got[dt.datetime(2024, 3, 27, 0)] == 3.75
    assert got[dt.datetime(2024, 3, 21, 23)] is None and got[max(got)] == 3.75


def test_calendar_refuses_times_of_day(spark):
    hours = frame(spark, [("SE1", T0)], "zone string, timestamp_utc timestamp")
    noon = frame(spark, [(T0 + 12 * HOUR, 1.0)], "d timestamp, r double")
    with pytest.raises(PySparkException, match="not a midnight"):
        asof.asof_calendar(hours, noon, "d", ["r"]).collect()


def test_last_row_by_order_wins(spark):
    from causalgrid.plans import silver

    rows = [("SE1", T0, 9.0, 1.0, 1), ("SE1", T0, 5.0, 2.0, 2), ("SE1", T0 + 2 * HOUR, 7.0, 3.0, 1)]
    df = frame(spark, rows, "zone string, timestamp_utc timestamp, load_mw double, imbalance_mwh double, version int")
    out = silver.hourly_base(df, order=["version"])
    assert column(out, "load_mw") == [5.0, 6.0, 7.0] and "version" not in out.columns
    assert column(silver.hourly_base(df, order=["version"], load_method="ffill"), "load_mw") == [5.0, 5.0, 7.0]


def test_nearest_within_takes_the_earlier_on_a_tie(spark):
    left = frame(spark, [("SE1", T0 + HOUR)], "zone string, timestamp_utc timestamp")
    half = dt.timedelta(minutes=30)
    right = frame(spark, [("SE1", T0 + half, 1.0), ("SE1", T0 + HOUR + half, 2.0)], "zone string, timestamp_utc timestamp, v double")
    assert asof.nearest_within(left, right, ["v"]).first().v == 1.0
    with pytest.raises(ValueError):
        asof.nearest_within(left, right, ["v"], tolerance_seconds=1_801)


def test_causal_operators_ignore_the_future(spark):
    """Cutting the input at a time leaves every earlier row as it was."""
    rng = np.random.default_rng(11)
    rows = [("SE1", T0 + i * HOUR, float(rng.normal()), bool(i % 7 == 0)) for i in range(400)]
    schema = "zone string, timestamp_utc timestamp, imbalance_mwh double, is_anomaly boolean"
    cut = T0 + 300 * HOUR
    cfg = gold.FeatureConfig(quarter=30, year=60, rate_lookbacks=(10, 20, 30), windows=(24, 48, 96))

    def features(rows):
        base = frame(spark, rows, schema).withColumn("load_mw", F.abs("imbalance_mwh") * 100).withColumn("price_eur_mwh", F.col("imbalance_mwh"))
        base = base.withColumn("riksbank_policy_rate_pct", F.floor(F.hour("timestamp_utc") / 5).cast("double"))
        out = gold.build_gold(validate.quarantine(base), cfg, Grid(chunk_steps=200))
        return {r.timestamp_utc: r for r in out.collect()}

    whole, early = features(rows), features([r for r in rows if r[1] < cut])
    assert len(early) == 300
    assert all(whole[t] == r for t, r in early.items())


def test_run_length_literal(spark):
    n = None
    rates = [n, n, 4.0, 4.0, 4.0, 3.5, 3.5, n, 3.5, 3.5]
    df = series(spark, rates).withColumnRenamed("x", "riksbank_policy_rate_pct")
    for chunk in (1, 2, 3, 100):
        grid = Grid(chunk_steps=chunk)
        edges = gold.zone_edges(grid.placed(df), grid, "riksbank_policy_rate_pct")
        out = gold.with_run_start(chunks.with_halo(df, grid, 1), edges, grid, "riksbank_policy_rate_pct").where(chunks.HOME)
        out = out.withColumn("p", F.when(F.col("riksbank_policy_rate_pct").isNotNull(), F.col(chunks.POS) - F.col("_run_start")))
        assert column(out, "p") == [n, n, 0, 1, 2, 0, 1, n, 0, 1], chunk


def test_feature_names(spark):
    grid = [("SE1", T0 + i * HOUR, 1.0, 2.0, 3.0, 4.0, 5.0, 2.0, False) for i in range(3)]
    names = "load_mw imbalance_mwh price_eur_mwh smahus_construction_index smahus_price_index riksbank_policy_rate_pct".split()
    df = frame(spark, grid, "zone string, timestamp_utc timestamp, " + ", ".join(f"{n} double" for n in names) + ", is_quarantined boolean")
    plain = gold.build_gold(df)
    assert len(gold.feature_columns(plain)) == 98
    market = {"outage_mw": 1.0, "scheduled_net_position_mw": 1.0, "reservoir_fill_ratio": 0.5, "wind_speed_ms": 2.0}
    full = gold.build_gold(df.withColumns({k: F.lit(v) for k, v in market.items()}))
    added = set(gold.feature_columns(full)) - set(gold.feature_columns(plain))
    assert added == set(gold.expected_market_features("SE1")) and len(added) == 24
    assert len(gold.expected_market_features("SE3")) == 21


def test_exact_quantiles_with_a_hot_zone(spark):
    rng = np.random.default_rng(2)
    data = {"SE1": np.round(rng.exponential(10, 20_000), 2), "SE2": np.array([7.0] * 500), "SE3": np.array([1.0, 2.0])}
    rows = [(z, float(v)) for z, vs in data.items() for v in vs]
    df = frame(spark, rows, "zone string, v double")
    qs = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q999": 0.999, "q1": 1.0}
    got = {r.zone: r for r in quantiles.exact_quantiles(df, "v", qs).collect()}
    for zone, vs in data.items():
        for n, q in qs.items():
            assert got[zone][n] == pytest.approx(np.percentile(vs, q * 100), rel=1e-12), (zone, n)


def test_metrics_literal(spark):
    y, p = [1.0, 2.0, 3.0, 0.5], [1.0, 3.0, 1.0, 0.5]
    df = frame(spark, [("SE1", a, b) for a, b in zip(y, p)], "zone string, y double, y_pred double")
    for bounded in (True, False):
        m = metrics.regression_metrics(df, bounded=bounded).first()
        assert (m.n_test, m.mae, m.max_error, m.bias) == (4, 0.75, 2.0, -0.25)
        assert m.mape_pct == pytest.approx((0.5 + 2 / 3) / 2 * 100)
        assert m.r2 == pytest.approx(1 - 5 / sum((v - 1.625) ** 2 for v in y))
        assert m.p90_error == pytest.approx(np.percentile([0, 1, 2, 0], 90))


def test_qq_points_follow_exact_quantiles(spark):
    vs = np.random.default_rng(4).normal(0, 3, 5_000)
    df = frame(spark, [("SE1", float(v)) for v in vs], "zone string, error double")
    pts = metrics.qq_points(df, 99).orderBy("rank").collect()
    p = [(i - 0.3175) / 99.365 for i in range(1, 100)]
    np.testing.assert_allclose([r.observed for r in pts], np.quantile(vs, p), atol=0.05)
    assert pts[49].theoretical == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize("n,folds,gap", [(1_248, 5, 168), (100, 5, 3), (61, 3, 0)])
def test_folds_by_arithmetic(spark, n, folds, gap):
    df = frame(spark, [("SE1", T0 + i * HOUR) for i in range(n)], "zone string, timestamp_utc timestamp")
    got = split.walk_forward(split.with_row_index(df, Grid(chunk_steps=50)), folds, gap).collect()
    size = n // (folds + 1)
    for k in range(1, folds + 1):
        start = n - (folds + 1 - k) * size
        rows = {(r.row_index, r.role) for r in got if r.fold == k}
        assert {i for i, role in rows if role == "test"} == set(range(start, start + size))
        assert {i for i, role in rows if role == "train"} == set(range(0, max(0, start - gap)))


def test_split_refuses_short_zones(spark):
    df = frame(spark, [("SE1", T0 + i * HOUR, True) for i in range(10)], "zone string, timestamp_utc timestamp, feature_ready boolean")
    assert split.temporal_split(df, 5).where("split = 'test'").count() == 5
    with pytest.raises(PySparkException, match="too few rows"):
        split.temporal_split(df, 6).collect()
    kept = split.temporal_split(df, 6, strict=False)
    assert kept.count() == 10 and kept.where("split is null").count() == 10


def test_row_index_has_null_keys_and_leaves_out_null_times(spark):
    rows = [(z, T0 + i * HOUR) for z in ("SE1", None) for i in range(7)] + [("SE1", None), (None, None)]
    df = frame(spark, rows, "zone string, timestamp_utc timestamp")
    got = split.with_row_index(df, Grid(chunk_steps=3)).collect()
    assert sorted((r.zone or "", r.row_index, r.n_rows) for r in got) == sorted((z, i, 7) for z in ("SE1", "") for i in range(7))
    lost = {(r.zone, r.unplaced_reason): r.n for r in regular.unplaced_counts(df, Grid()).collect()}
    assert lost == {(None, "no_key"): 8, ("SE1", "no_time"): 1}


def test_rows_without_a_place_are_counted(spark):
    off = dt.timedelta(minutes=7)
    rows = [("SE1", T0 + off), ("SE1", T0 + HOUR), ("SE1", T0 + HOUR + off), ("SE2", T0 + HOUR), (None, T0), ("SE1", None), (None, None)]
    df = frame(spark, rows, "zone string, timestamp_utc timestamp").withColumn("v", F.lit(1.0))
    bad = regular.unplaced(df, Grid()).collect()
    assert sorted((r.zone or "", r.unplaced_reason) for r in bad) == [("", "no_key"), ("", "no_key"), ("SE1", "no_time"), ("SE1", "off_phase")]
    counted = {(r.zone, r.unplaced_reason): r.n for r in regular.unplaced_counts(df, Grid()).collect()}
    assert counted == {(None, "no_key"): 2, ("SE1", "no_time"): 1, ("SE1", "off_phase"): 1}
    assert regular.regularize(df, Grid()).where("v is not null").count() + len(bad) == len(rows)


def test_asof_join_splits_right_rows_of_one_chunk(spark):
    """Many right rows of one key and chunk are dealt to ranges; no range holds many more than asked for."""
    n = 20_000
    left = spark.range(500).select(F.lit("SE1").alias("zone"), F.timestamp_seconds(F.col("id") * 5_000 + 17).alias("timestamp_utc"))
    right = spark.range(n).select(F.lit("SE1").alias("zone"), F.timestamp_seconds(F.col("id") * 130).alias("t"), F.col("id").alias("v"))
    for direction in ("backward", "nearest"):
        got = asof.asof_join(left, Series(right, "t", ("v",)), direction=direction, rows_per_task=1_000).collect()
        near = (lambda s: s // 130) if direction == "backward" else (lambda s: s // 130 + (s % 130 > 65))
        assert len(got) == 500
        for r in got:
            s = int(r.timestamp_utc.replace(tzinfo=dt.timezone.utc).timestamp())
            assert r.v == min(n - 1, near(s))
    both = asof._chunked(left.select("zone", F.col("timestamp_utc").alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast("int").alias("_r0")).unionByName(
        right.select("zone", F.col("t").alias("_ts"), F.lit(0).alias("_side"), F.col("v").cast("int").alias("_r0"))), 90 * 86_400)
    ranges = asof._range_facts(both, ["zone"], ["_r0"], False, 1_000).select(F.explode("_ranges")).count()
    assert ranges >= 18


def test_gap_audit_of_data_finer_than_the_grid(spark):
    minutes = [0, 1, 2, 59, 60, 200, 200, 201, 620]
    df = frame(spark, [("SE1", T0 + dt.timedelta(minutes=m)) for m in minutes], "zone string, timestamp_utc timestamp")
    from causalgrid.operators import audits

    r = audits.gap_audit(df, Grid(chunk_steps=2)).first()
    assert (r.n_rows, r.n_gaps, round(r.largest_gap_h, 6), r.implicit_gap_hours) == (9, 2, round(419 / 60, 6), 10 + 1 - 8)


def test_quantiles_of_a_null_key(spark):
    rows = [(z, float(v)) for z in ("SE1", None) for v in range(101)]
    from causalgrid.operators.quantiles import exact_quantiles

    got = {r.zone: (r.a, r.b) for r in exact_quantiles(frame(spark, rows, "zone string, x double"), "x", {"a": 0.5, "b": 0.9}).collect()}
    assert got == {"SE1": (50.0, 90.0), None: (50.0, 90.0)}


def test_composition_asks_python_only_for_what_may_change(spark):
    from causalgrid.functions import text

    every = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    import re
    import unicodedata

    asked = re.compile(text.MAY_COMPOSE.replace("\\x{", "\\u").replace("}", ""))
    assert all(asked.search(c) for c in every if unicodedata.normalize("NFC", c) != c or unicodedata.combining(c))
    want = {"e\u0301": "\u00e9", "caf\u00e9 \u2013": "caf\u00e9 \u2013", "\u212b": "\u00c5", None: None, "": ""}
    df = frame(spark, [(t,) for t in want], "t string")
    assert dict(map(tuple, df.select("t", text.compose_any(F.col("t"))).collect())) == want


def test_composition_batches_are_bounded_by_bytes(spark, monkeypatch):
    import pyarrow as pa

    from causalgrid.functions import text

    @F.arrow_udf("string")
    def batch_bytes(x):
        return pa.array([str(x.nbytes)] * len(x))

    monkeypatch.setattr(text, "_composed", batch_bytes)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    df = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("e\u0301"), 50_000).alias("t"))  # 60 MB
    most = df.select(text.compose_any(F.col("t")).cast("long").alias("n")).agg(F.max("n")).first()[0]
    assert 150_000 <= most < 12 << 20


def test_settled_station_follows_an_order(spark):
    rows = [("SE1", T0, 1.0, 2.0, False, 9, 1), ("SE1", T0, 3.0, None, None, 4, 2), ("SE1", T0, None, None, True, 1, None)]
    df = frame(spark, rows, "zone string, timestamp_utc timestamp, temperature_c double, wind_speed_ms double, is_anomaly boolean, station_id int, seen int")
    assert rollup.settle_weather(df).first().station_id == 1
    r = rollup.settle_weather(df, order=["seen"]).first()
    assert (r.station_id, r.temperature_c, r.wind_speed_ms, r.is_anomaly) == (9, 2.0, 2.0, True)


def test_outage_expansion_clips(spark):
    rows = [
        (1, "U1", "SE1", T0 - 2 * HOUR, T0 + 2 * HOUR, 10.0),
        (2, "U1", "SE1", T0 + HOUR, T0 + dt.timedelta(hours=2, minutes=30), 5.0),
        (3, "U2", "SE1", T0 + HOUR, T0 + 2 * HOUR, 7.0),
        (4, "U3", "SE1", T0 + 50 * HOUR, T0 + 60 * HOUR, 1.0),
    ]
    ev = frame(spark, rows, "event_id int, unit string, zone string, event_start timestamp, event_stop timestamp, unavailable_mw double")
    out = intervals.hourly_outages(intervals.expand_hours(ev, T0, T0 + 24 * HOUR))
    got = {r.timestamp_utc: (r.outage_mw, r.active_unit_count) for r in out.collect()}
    assert got == {T0: (10.0, 1), T0 + HOUR: (22.0, 2), T0 + 2 * HOUR: (5.0, 1)}


def test_merge_metrics_keeps_every_key(spark):
    load = frame(spark, [("SE1", T0, 1.0, True)], "zone string, timestamp_utc timestamp, load_mw double, is_anomaly boolean")
    price = frame(spark, [("SE1", T0, 2.0), ("SE2", T0, 3.0)], "zone string, timestamp_utc timestamp, price_eur_mwh double")
    got = {r.zone: (r.load_mw, r.price_eur_mwh, r.is_anomaly) for r in rollup.merge_metrics({"load_mw": load, "price_eur_mwh": price}).collect()}
    assert got == {"SE1": (1.0, 2.0, True), "SE2": (None, 3.0, False)}


def test_validation_names_every_failure(spark):
    rows = [("SE1", T0, 5.0, 60), ("SE5", None, -50.0, 0), ("SE2", T0, None, 60)]
    df = frame(spark, rows, "zone string, timestamp_utc timestamp, load_mw double, resolution_minutes int")
    valid, rejects = validate.split_valid(validate.validate(df, validate.load_rules()))
    assert [r.zone for r in valid.collect()] == ["SE1"]
    got = {r.zone: list(r.failed_rules) for r in rejects.collect()}
    assert got == {"SE5": ["zone", "timestamp_utc", "load_mw", "resolution_minutes"], "SE2": ["load_mw"]}


def test_missing_columns_are_named(spark):
    df = frame(spark, [(1, 2)], "a int, b int")
    validate.require_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match=r"feature table lacks \['c', 'd'\]; it has \['a', 'b'\]"):
        validate.require_columns(df, ["d", "a", "c"], "feature table")


def test_anomaly_bounds(spark):
    df = frame(spark, [(99_999.0, 9_999.0, -650.0), (5_000.0, 10.0, 50.0)], "load_mw double, imbalance_mwh double, price_eur_mwh double")
    checks = {**validate.load_anomaly(), **validate.imbalance_anomaly(), **validate.price_anomaly()}
    got = {r.load_mw: list(r.anomaly_reasons) for r in validate.flag_anomalies(df, checks).collect()}
    assert got == {99_999.0: ["load_above_maximum", "imbalance_beyond_limit", "price_below_minimum"], 5_000.0: []}


def test_strict_station_guard(spark):
    from causalgrid.operators import dims

    good = frame(spark, [("SE1", 140480)], "zone string, station_id int")
    bad = frame(spark, [("SE1", 62040)], "zone string, station_id int")
    assert dims.strict_stations(good, dims.stations(spark)).count() == 1
    with pytest.raises(PySparkException, match="does not belong"):
        dims.strict_stations(bad, dims.stations(spark)).collect()
