"""Readers and writers on small files of their own."""

import datetime as dt
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from causalgrid.operators import validate
from causalgrid.sources import json_documents as docs
from causalgrid.sources import market_xml as mx
from causalgrid.sources import payloads, sinks, tables
from causalgrid.streaming import landing

T0 = dt.datetime(2024, 1, 15)

POINTS = "".join(f"<Point><position>{i}</position><quantity>{q}</quantity></Point>" for i, q in ((1, "100"), (2, "200.5"), (3, "x"), (4, "400")))


def document(body="", start="2024-01-15T00:00Z", resolution="<resolution>PT60M</resolution>", points=POINTS):
    period = f"<Period><timeInterval><start>{start}</start><end>e</end></timeInterval>{resolution}{points}</Period>"
    return f'<?xml version="1.0"?><Doc xmlns="urn:x"><TimeSeries>{body}{period}{period}</TimeSeries></Doc>'


def parsed(spark, xml, kind=mx.LOAD):
    df = spark.createDataFrame([("SE3", xml)], "zone string, payload string")
    return mx.points(mx.parse_series(df, kind), kind).orderBy("timestamp_utc").collect()


def test_load_points_of_the_first_period(spark):
    rows = parsed(spark, document())
    assert [(r.timestamp_utc, r.load_mw) for r in rows] == [(T0, 100.0), (T0.replace(hour=1), 200.5), (T0.replace(hour=3), 400.0)]


@pytest.mark.parametrize("code,minutes", [("PT15M", 15), ("pt30m", 30), ("PT1H", 60), ("P1D", 60), (None, 60)])
def test_resolutions(spark, code, minutes):
    rows = parsed(spark, document(resolution=f"<resolution>{code}</resolution>" if code else ""))
    assert rows[1].timestamp_utc == T0 + dt.timedelta(minutes=minutes) and rows[0].resolution_minutes == minutes


def test_unreadable_start_drops_the_period(spark):
    assert parsed(spark, document(start="soon")) == []
    assert parsed(spark, "<broken") == []
    assert parsed(spark, document(start="2024-01-15T01:00:00+01:00"))[0].timestamp_utc == T0


def test_imbalance_sign(spark):
    down = parsed(spark, document("<flowDirection.direction>A02</flowDirection.direction>"), mx.IMBALANCE)
    up = parsed(spark, document("<flowDirection.direction>A01</flowDirection.direction>"), mx.IMBALANCE)
    assert [r.imbalance_mwh for r in down] == [-100.0, -200.5, -400.0] and [r.imbalance_mwh for r in up] == [100.0, 200.5, 400.0]


def test_zipped_files_with_the_zone_in_their_name(spark, tmp_path):
    for zone in ("SE1", "SE4"):
        with gzip.open(tmp_path / f"A65_{zone}_20240115T0000Z_20240116T0000Z_20240116T0100Z.xml.gz", "wt") as f:
            f.write(document())
    rows = mx.points(mx.read_series(spark, str(tmp_path), mx.LOAD), mx.LOAD).collect()
    assert sorted({r.zone for r in rows}) == ["SE1", "SE4"] and len(rows) == 6
    names = payloads.read_payloads(spark, str(tmp_path)).select(payloads.name_parts(F.col("file_name"))["document"].alias("d"), "payload")
    assert {r.d for r in names.collect()} == {"A65"}


def test_error_documents(spark):
    df = spark.createDataFrame([("<Ack><Reason><code>999</code></Reason></Ack>",), (document(),)], "payload string")
    good, bad = payloads.split_errors(df)
    assert (good.count(), bad.count()) == (1, 1)


def test_cube_with_bad_rows(spark):
    cells = [
        (["0180", "2024K1"], ["12,5"]), (["0380", "2024K2"], ["7"]), (["1480", "2024k3"], ["3"]),
        (["0114", "2024K1"], [".."]), (["riket", "2024K1"], ["1"]), (["0115", "2024M1"], ["1"]), (["0117"], []),
    ]
    payload = json.dumps({"data": [{"key": k, "values": v} for k, v in cells]})
    rows = docs.cube_rows(spark.createDataFrame([(payload,)], "payload string"), "x").collect()
    assert sorted(r.x for r in rows if r.reject_reason is None) == [3.0, 7.0, 12.5]
    assert sorted(r.reject_reason for r in rows if r.reject_reason) == ["bad_code", "bad_quarter", "short_row", "suppressed"]


def test_rate_shapes(spark):
    obs = [{"date": "2024-01-02", "value": "4.00"}, {"date": "2024-01-03", "value": "3,75"}, {"date": "2024-01-04", "value": "N/A"}, {"date": "", "value": "1"}]
    shapes = [{"groups": [{"seriesId": "a", "observations": obs[:1]}, {"observations": obs[1:]}]}, {"observations": obs}, obs, {"groups": [], "observations": obs}]
    for shape in shapes:
        rows = docs.rate_rows(spark.createDataFrame([(json.dumps(shape),)], "payload string")).collect()
        assert sorted((r.raw_date_str, r.policy_rate_pct) for r in rows) == [("2024-01-02", 4.0), ("2024-01-03", 3.75)]


def test_weather_document(spark):
    payload = json.dumps({"station": {"latitude": 65.5, "longitude": 22.1}, "value": [
        {"date": 1704067200000, "value": "-51,0", "quality": "G"}, {"date": 1704070800000, "value": "x", "quality": "Y"}, {"date": 0, "value": "1"}]})
    df = spark.createDataFrame([("SE1", 140480, 1, payload)], "zone string, station_id int, parameter_id int, payload string")
    rows = docs.weather_rows(df)
    got = sorted(((r.temperature_c, r.wind_speed_ms, r.is_anomaly, r.reject_reason) for r in rows.collect()), key=str)
    assert got == sorted([(-51.0, None, True, None), (None, None, False, "bad_value"), (1.0, None, False, "bad_time")], key=str)
    s = docs.station_summary(df, rows).first()
    assert (s.latitude, s.total_records, s.failed_records) == (65.5, 3, 2)


def test_backfill_plan_is_contiguous(spark):
    plan = tables.backfill_plan(spark, dt.datetime(2023, 1, 1), dt.datetime(2025, 6, 1)).orderBy("window_start").collect()
    assert plan[0].window_start == dt.datetime(2023, 1, 1) and plan[-1].window_end == dt.datetime(2025, 6, 1)
    assert all(a.window_end == b.window_start for a, b in zip(plan, plan[1:])) and len(plan) == 3
    assert all(r.window_end - r.window_start <= dt.timedelta(days=365) for r in plan)


def grid_rows(spark, n=60, zone="SE1"):
    rows = [(zone, dt.datetime(2024, 1, 30) + dt.timedelta(hours=i), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "zone string, timestamp_utc timestamp, x double")


def test_silver_write_replaces_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "silver")
    sinks.write_silver(grid_rows(spark), path)
    sinks.write_silver(grid_rows(spark).where("month(timestamp_utc) = 2").withColumn("x", -F.col("x")), path)
    out = spark.read.parquet(path)
    assert out.count() == 60 and out.where("x < 0").count() == out.where("month = 2").count() > 0
    assert (tmp_path / "silver/zone=SE1/year=2024/month=1").is_dir()
    sinks.write_silver(grid_rows(spark), str(tmp_path / "yearly"), sinks.YEARLY)
    assert (tmp_path / "yearly/zone=SE1/year=2024").is_dir()


def test_manifest_counts(spark):
    df = grid_rows(spark).withColumn("is_anomaly", F.col("x") > 50)
    checked = validate.validate(df, {"x": F.col("x") < 55})
    m = sinks.manifest(checked, ["zone"], {"x_max": F.max("x")}).first()
    assert (m.records_total, m.records_validation_failed, m.records_anomalous, m.x_max) == (60, 5, 9, 59.0)


def test_landing_merges_restated_hours_of_any_age(spark, tmp_path):
    drop, path, log = (str(tmp_path / n) for n in ("drop", "silver", "log"))
    first = grid_rows(spark).withColumn("version", F.lit(1))
    first.repartition(4).write.parquet(drop)

    def run():
        points = landing.read_points(spark, drop, first.schema, files_per_batch=1)
        landing.land(points, path, log, ["version"]).awaitTermination()

    run()
    late = first.where("x in (3, 59)").withColumn("version", F.lit(2)).withColumn("x", F.col("x") + 1000)
    late.unionByName(first.where("x = 59")).write.mode("append").parquet(drop)
    run()
    run()
    out = spark.read.parquet(path)
    assert out.count() == 60
    assert sorted(r.x for r in out.where("version = 2").collect()) == [1003.0, 1059.0]


# --- what cannot be read ---------------------------------------------------------------------------


def test_every_point_is_accounted_for(spark):
    whole = document()
    rows = [
        ("a", whole),
        ("b", document(start="soon")),
        ("c", whole[: len(whole) // 2]),
        ("d", None),
        ("e", "<Ack><Reason><code>999</code></Reason></Ack>"),
        ("f", "<Doc><TimeSeries><mRID>1</mRID></TimeSeries></Doc>"),
        ("g", document(points="")),
        ("h", document(points="<Point><position>x</position><quantity>1</quantity></Point><Point><position>2</position></Point>")),
        ("i", ""),
    ]
    df = spark.createDataFrame([("SE3", i, x) for i, x in rows], "zone string, name string, payload string")
    out, seen = mx.counted(mx.point_rows(mx.parse_series(df, mx.LOAD), mx.LOAD), "points")
    got = sorted((r.name, r.reject_level or "", r.reject_reason or "") for r in out.collect())
    assert got == [
        ("a", "", ""), ("a", "", ""), ("a", "", ""), ("a", "point", "bad_value"),
        ("b", "point", "no_start"), ("b", "point", "no_start"), ("b", "point", "no_start"), ("b", "point", "no_start"),
        ("c", "document", "unreadable"), ("d", "document", "no_payload"), ("e", "document", "error_document"),
        ("f", "series", "no_period"), ("g", "series", "no_points"), ("h", "point", "bad_position"), ("h", "point", "bad_value"), ("i", "document", "unreadable"),
    ]
    assert seen.get == {"accepted": 3, "rejected_point": 7, "rejected_series": 2, "rejected_document": 4}
    assert mx.points(mx.parse_series(df, mx.LOAD), mx.LOAD).count() == 3
    assert mx.rejects(mx.parse_series(df, mx.LOAD), mx.LOAD).count() == 13


def test_rate_records_say_why(spark):
    rows = [json.dumps([{"date": "2024-01-02", "value": "4,00"}, {"date": "", "value": "1"}, {"value": "2"}, {"date": "2024-01-03", "value": "x"}, {"date": "2024-01-04"}]), "{", None, "[]"]
    got = docs.rate_records(spark.createDataFrame([(x,) for x in rows], "payload string")).collect()
    assert sorted((r.reject_reason or "", r.policy_rate_pct or 0.0) for r in got)[0] == ("", 4.0)
    assert sorted(r.reject_reason or "" for r in got) == ["", "bad_value", "missing", "no_date", "no_date", "unreadable", "unreadable", "unreadable"]


def test_raw_documents_landed_twice_are_landed_once(spark, tmp_path):
    drop, path, rejects = (str(tmp_path / x) for x in ("drop", "landed", "rejects"))

    def put(folder, name, text):
        (tmp_path / "drop" / folder).mkdir(parents=True, exist_ok=True)
        with (gzip.open if name.endswith("gz") else open)(tmp_path / "drop" / folder / name, "wt") as f:
            f.write(text)

    def run(checkpoint):
        raw = landing.read_documents(spark, drop, "*.xml*", files_per_batch=2)
        landing.land_documents(raw, mx.LOAD, path, rejects, str(tmp_path / checkpoint)).awaitTermination()
        points = spark.read.parquet(path).select("zone", "timestamp_utc", "load_mw").collect()
        bad = spark.read.parquet(rejects).select("zone", "file_name", "reject_level", "reject_reason").collect()
        return sorted(map(tuple, points)), sorted((tuple(r) for r in bad), key=str)

    put("a", "A65_SE1_2024-01-15T0000Z_2024-01-16T0000Z_2024-01-20T0000Z.xml", document())
    put("a", "A65_SE2_2024-01-15T0000Z_2024-01-16T0000Z_2024-01-20T0000Z.xml.gz", document())
    put("a", "other.xml", document())
    put("a", "A65_SE3_2024-01-15T0000Z_2024-01-16T0000Z_2024-01-20T0000Z.xml", "<Doc")
    first = run("one")
    assert len(first[0]) == 6 and len(first[1]) == 1 + 1 + 4 + 1
    assert [r[3] for r in first[1]].count("no_zone") == 3
    assert run("one") == first
    # the same files once more, from another folder and to a stream of its own
    put("b", "A65_SE1_2024-01-15T0000Z_2024-01-16T0000Z_2024-01-20T0000Z.xml", document())
    assert run("two") == first
    # a later document restates an hour
    put("c", "A65_SE1_2024-01-15T0000Z_2024-01-16T0000Z_2024-01-21T0000Z.xml", document(points="<Point><position>1</position><quantity>7</quantity></Point>"))
    again = run("one")
    assert ("SE1", T0, 7.0) in again[0] and len(again[0]) == 6 and again[1] == first[1]


def test_long_files_land_in_parts_and_give_their_lines_back(spark, tmp_path, monkeypatch):
    held = {"a": "ett\ntvå åäö 日本 långa rader\n\nslut", "c": "\n\n", "d": "en rad utan slut, längre än en del", "e": "x\r\ny\n", "f": "1234567\n"}
    (tmp_path / "drop").mkdir()
    for name, content in held.items():
        (tmp_path / "drop" / name).write_bytes(content.encode())
    monkeypatch.setattr(sinks, "PART_BYTES", 7)
    path = str(tmp_path / "raw")
    for day in ("2024-01-01", "2024-01-02"):
        sinks.land_raw(spark, str(tmp_path / "drop"), path, "drop", day)
    landed = spark.read.parquet(path)
    rows = sorted(landed.select("file_name", "part", "content", "content_sha256").collect())
    assert max(len(r.content) for r in rows) == 7
    for name, content in held.items():
        own = [r for r in rows if r.file_name == name]
        assert [r.part for r in own] == list(range(max(1, -(-len(content.encode()) // 7))))
        assert b"".join(r.content for r in own) == content.encode()
        assert {r.content_sha256 for r in own} == {hashlib.sha256(content.encode()).hexdigest()}
    lines = sorted((r.file_name, r.line.decode()) for r in sinks.raw_lines(landed).collect())
    want = {name: content.split("\n") for name, content in held.items()}
    assert lines == sorted((name, line) for name, own in want.items() for line in (own if own[-1] else own[:-1]))
