"""Queries for sources: documents are made from the tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from causalgrid.functions import text
from causalgrid.operators import audits
from causalgrid.session import materialize, scratch_path
from causalgrid.sources import json_documents, market_xml, payloads, tables
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.registry import query


def market_documents(spark, sf_dir, value, tag, direction=None):
    """One document per zone and day, points in the order of hours, some of them unreadable."""
    g = fx.grid_hourly(spark, sf_dir).where(F.col(value).isNotNull())
    hour = F.hour("timestamp_utc") + 1
    shown = F.abs(F.round(value, 2)).cast("decimal(18,2)").cast("string")
    broken = F.when(hour == 5, F.lit("n/a")).otherwise(shown)
    point = F.concat(
        F.lit("<Point><position>"), hour.cast("string"), F.lit(f"</position><{tag}>"), broken, F.lit(f"</{tag}></Point>")
    )
    keys = ["zone", F.date_trunc("day", "timestamp_utc").alias("day")]
    if direction is not None:
        keys.append(direction.alias("direction"))
    days = g.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(hour.alias("h"), point.alias("p")))), lambda s: s["p"]), "").alias("points"))
    flow = F.concat(F.lit("<flowDirection.direction>"), F.col("direction"), F.lit("</flowDirection.direction>")) if direction is not None else F.lit("")
    series = F.concat(
        F.lit("<TimeSeries>"), flow, F.lit("<Period><timeInterval><start>"), F.date_format("day", "yyyy-MM-dd'T'HH:mm'Z'"),
        F.lit("</start><end>x</end></timeInterval><resolution>PT60M</resolution>"), "points", F.lit("</Period></TimeSeries>"),
    )
    return days.select("zone", series.alias("series"))


def _documents(days):
    whole = F.concat(F.lit('<?xml version="1.0"?><MarketDocument xmlns="urn:market"><type>x</type>'), F.col("series"), F.lit("</MarketDocument>"))
    return days.select("zone", whole.alias("payload"))


@query(
    with_views(
        "select zone, timestamp_utc, abs(round(load_mw, 2)) as load_mw, 60 as resolution_minutes from grid_hourly where load_mw is not null and hour(timestamp_utc) <> 4",
        "grid_hourly",
    ),
    doubles="load_mw",
    digits=2,
)
def load_documents(spark, sf_dir):
    """S-01, S-04 and S-05 on documents in a column; unreadable points are left out."""
    docs = _documents(market_documents(spark, sf_dir, "load_mw", "quantity"))
    return market_xml.points(market_xml.parse_series(docs, market_xml.LOAD), market_xml.LOAD)


@query(
    with_views(
        """select zone, timestamp_utc, round(imbalance_mwh, 2) as imbalance_mwh, case when imbalance_mwh < 0 then 'A02' else 'A01' end as direction
           from grid_hourly where imbalance_mwh is not null and hour(timestamp_utc) <> 4""",
        "grid_hourly",
    ),
    doubles="imbalance_mwh",
    digits=2,
)
def imbalance_documents(spark, sf_dir):
    """S-02: the direction gives the sign."""
    direction = F.when(F.col("imbalance_mwh") < 0, "A02").otherwise("A01")
    docs = _documents(market_documents(spark, sf_dir, "imbalance_mwh", "quantity", direction))
    return market_xml.points(market_xml.parse_series(docs, market_xml.IMBALANCE), market_xml.IMBALANCE)


@query(
    with_views(
        "select zone, timestamp_utc, round(price_eur_mwh, 5) as price_eur_mwh from grid_hourly where hour(timestamp_utc) <> 4",
        "grid_hourly",
    ),
    doubles="price_eur_mwh",
    digits=5,
)
def price_files(spark, sf_dir):
    """S-03 and S-06: files per zone, written to the shared folder and read by tag."""
    path = scratch_path(spark, "price-documents")
    g = fx.grid_hourly(spark, sf_dir)
    hour = F.hour("timestamp_utc") + 1
    shown = F.when(hour == 5, F.lit("n/a")).otherwise(F.round("price_eur_mwh", 5).cast("decimal(18,5)").cast("string"))
    point = F.struct(hour.alias("position"), shown.alias("price.amount"))
    days = g.groupBy("zone", F.date_trunc("day", "timestamp_utc").alias("day")).agg(F.collect_list(point).alias("Point"))
    start = F.struct(F.date_format("day", "yyyy-MM-dd'T'HH:mm'Z'").alias("start"), F.lit("x").alias("end"))
    period = F.struct(start.alias("timeInterval"), F.lit("PT60M").alias("resolution"), "Point").alias("Period")
    out = days.select("zone", period).write.format("xml").option("rootTag", "MarketDocument").option("rowTag", "TimeSeries")
    out.option("compression", "gzip").partitionBy("zone").save(path)
    return market_xml.points(market_xml.read_series(spark, path, market_xml.PRICE), market_xml.PRICE)


def damaged_documents(spark, sf_dir):
    """Load documents of which every tenth day is damaged in some way: no start, cut short, an error, no period, no points."""
    day = F.dayofmonth("day") % 10
    hour = F.hour("timestamp_utc") + 1
    g = fx.grid_hourly(spark, sf_dir).where("load_mw is not null")
    position = F.when(hour == 7, F.lit("x")).otherwise(hour.cast("string"))
    value = F.when(hour == 5, F.lit("n/a")).otherwise(F.round("load_mw", 2).cast("decimal(18,2)").cast("string"))
    point = F.concat(F.lit("<Point><position>"), position, F.lit("</position><quantity>"), value, F.lit("</quantity></Point>"))
    days = g.groupBy("zone", F.date_trunc("day", "timestamp_utc").alias("day")).agg(F.array_join(F.array_sort(F.collect_list(point)), "").alias("points"))
    start = F.when(day == 3, F.lit("soon")).otherwise(F.date_format("day", "yyyy-MM-dd'T'HH:mm'Z'"))
    inside = F.when(day == 7, F.lit("")).otherwise(F.col("points"))
    period = F.concat(F.lit("<Period><timeInterval><start>"), start, F.lit("</start></timeInterval><resolution>PT60M</resolution>"), inside, F.lit("</Period>"))
    later = F.when(day == 8, F.replace(period, F.lit("<position>"), F.lit("<position>9"))).otherwise(F.lit(""))
    series = F.concat(F.lit("<TimeSeries>"), F.when(day == 6, F.lit("<mRID>1</mRID>")).otherwise(F.concat(period, later)), F.lit("</TimeSeries>"))
    whole = F.concat(F.lit('<?xml version="1.0"?><MarketDocument>'), series, F.lit("</MarketDocument>"))
    error = F.lit('<?xml version="1.0"?><Ack><Reason><code>999</code><text>none</text></Reason></Ack>')
    payload = F.when(day == 4, F.expr("left(payload, length(payload) div 2)")).when(day == 5, error).otherwise(F.col("payload"))
    return days.withColumn("payload", whole).select("zone", "day", payload.alias("payload"))


DAMAGED = """
    select zone, timestamp_utc, load_mw, day(timestamp_utc) % 10 as d, hour(timestamp_utc) as h, date_trunc('day', timestamp_utc) as day
    from grid_hourly where load_mw is not null"""
READABLE = "select zone, timestamp_utc, load_mw from damaged where d not in (3, 4, 5, 6, 7) and h not in (4, 6)"
_UNREADABLE = """
    select 'point' as level, case when d = 3 then 'no_start' when h = 6 then 'bad_position' else 'bad_value' end as reason, zone, day
    from damaged where d = 3 or (d not in (4, 5, 6, 7) and h in (4, 6))
    union all select case when d in (6, 7) then 'series' else 'document' end, case d when 4 then 'unreadable' when 5 then 'error_document' when 6 then 'no_period' else 'no_points' end, zone, day
    from (select distinct d, zone, day from damaged where d in (4, 5, 6, 7))"""


@query(
    with_views(
        f"select 'load' as source, level, reason, count(*) as n from ({_UNREADABLE}) group by all union all select 'load', 'accepted', null, count(*) from ({READABLE})",
        "grid_hourly",
        damaged=DAMAGED,
    )
)
def reject_counts(spark, sf_dir):
    """S-01, S-04 and S-07: accepted and rejected points, series and documents add up; the counts are observed while rows are written."""
    series = market_xml.parse_series(damaged_documents(spark, sf_dir), market_xml.LOAD)
    rows, seen = market_xml.counted(market_xml.point_rows(series, market_xml.LOAD), "load")
    stored = materialize(rows, "load-points")
    told = [("load", "accepted", None, seen.get["accepted"])]
    counts = stored.where("reject_reason is not null").groupBy(F.lit("load").alias("source"), F.col("reject_level").alias("level"), F.col("reject_reason").alias("reason"))
    return counts.agg(F.count("*").alias("n")).unionByName(spark.createDataFrame(told, "source string, level string, reason string, n long"))


@query(
    with_views(
        "select zone, timestamp_utc, round(load_mw, 2) as load_mw, 60 as resolution_minutes from damaged where d = 8 and h not in (4, 6)",
        "grid_hourly",
        damaged=DAMAGED,
    ),
    doubles="load_mw",
    digits=2,
)
def first_period_only(spark, sf_dir):
    """S-05: documents with two periods give the points of the first."""
    two = damaged_documents(spark, sf_dir).where(F.dayofmonth("day") % 10 == 8).drop("day")
    return market_xml.points(market_xml.parse_series(two, market_xml.LOAD), market_xml.LOAD)


@query(
    """select event_id, case when event_id % 3 < 2 then 'A65' else '' end as document, case when event_id % 3 < 2 then 'SE' || (user_id % 4 + 1) else '' end as zone,
              case when event_id % 3 < 2 then strftime(ts, '%Y-%m-%dT%H:%M') else '' end as period_from, case when event_id % 3 < 2 then '2024-02-01' else '' end as period_to,
              case when event_id % 3 < 2 then '2024-03-01T00:00:00Z' else '' end as ingested from events"""
)
def file_name_parts(spark, sf_dir):
    """S-06: document, zone and periods from file names, zipped or not; other names give nothing."""
    e = table(spark, sf_dir, "events")
    zone = F.concat(F.lit("SE"), (F.col("user_id") % 4 + 1).cast("string"))
    ending = F.element_at(F.array(F.lit(".xml"), F.lit(".xml.gz"), F.lit(".csv")), (F.col("event_id") % 3 + 1).cast("int"))
    name = F.concat(F.lit("A65_"), zone, F.lit("_"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm"), F.lit("_2024-02-01_2024-03-01T00:00:00Z"), ending)
    return e.select("event_id", *[c.alias(n) for n, c in payloads.name_parts(name).items()])


@query("select doc_id, doc_id % 3 = 0 as is_error from documents")
def error_documents(spark, sf_dir):
    """S-07: every third document gives a reason with a code behind its whole text; the others hold both words apart."""
    header = F.regexp_replace("text", "[<>]", " ")
    reason = F.concat(F.lit("<Ack><note>"), header, F.lit("</note><ns:Reason><text>none</text><code>999</code></ns:Reason></Ack>"))
    other = F.concat(F.lit("<Doc><code>A01</code><Reason>none</Reason><note>"), header, F.lit("</note><code>B02</code></Doc>"))
    marked = F.when(F.col("doc_id") % 3 == 0, reason).otherwise(other)
    return table(spark, sf_dir, "documents").select("doc_id", payloads.is_error_document(marked).alias("is_error"))


def cube_documents(spark, sf_dir):
    """One cube per quarter with suppressed cells, bad codes, bad quarters and short rows."""
    h = fx.housing_kommun(spark, sf_dir).withColumn("k", F.col("kommunkod"))
    cell = F.when(F.col("k") == 3, "..").when(F.col("k") == 4, "x").otherwise(F.replace(F.col("smahus_construction_index").cast("string"), F.lit("."), F.lit(",")))
    code = F.when(F.col("k") == 5, "riket").otherwise(F.lpad(F.col("k").cast("string"), 4, "0"))
    quarter = F.when(F.col("k") == 6, F.replace("raw_quarter_str", F.lit("K"), F.lit("M"))).otherwise(F.col("raw_quarter_str"))
    key = F.when(F.col("k") == 7, F.array(code)).otherwise(F.array(code, quarter))
    cells = h.groupBy("raw_quarter_str").agg(F.collect_list(F.struct(key.alias("key"), F.array(cell).alias("values"))).alias("data"))
    return cells.select(F.to_json(F.struct("data")).alias("payload"))


@query(
    with_views(
        """select kommunkod, period_utc, smahus_construction_index, reject_reason, coalesce(n_name, case when kommunkod is null then 'Okänd (riket)' else 'Okänd' end) as region_name
           from (select case when k <> 5 then k end as kommunkod, case when k not in (6, 7) then
                        make_date(left(raw_quarter_str, 4)::int, (right(raw_quarter_str, 1)::int - 1) * 3 + 1, 1)::timestamp end as period_utc,
                        case when k not in (3, 4) then smahus_construction_index end as smahus_construction_index,
                        case k when 3 then 'suppressed' when 4 then 'bad_value' when 5 then 'bad_code' when 6 then 'bad_quarter' when 7 then 'short_row' end as reject_reason,
                        case when k % 2 = 0 then k end as named
                 from (select *, kommunkod as k from housing_kommun))
           left join nation on n_nationkey = named""",
        "housing_kommun",
    ),
    doubles="smahus_construction_index",
)
def cube_cells(spark, sf_dir):
    """S-08: statistics cubes to typed rows; every rejected cell keeps its reason."""
    names = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0")
    labels = names.select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("region_code"), F.concat("n_name", F.lit(" (0180)")).alias("region_name"))
    rows = json_documents.cube_rows(cube_documents(spark, sf_dir), "smahus_construction_index")
    return json_documents.with_region_name(rows, labels).select("kommunkod", "period_utc", "smahus_construction_index", "reject_reason", "region_name")


@query(
    with_views(
        """select coalesce(reject_reason, 'accepted') as outcome, count(*) as n, count(distinct kommunkod) as n_kommunkod, count(distinct quarter) as n_raw_quarter_str
           from (select case when k <> 5 then k end as kommunkod, case k when 7 then null when 6 then replace(raw_quarter_str, 'K', 'M') else raw_quarter_str end as quarter,
                        case k when 3 then 'suppressed' when 4 then 'bad_value' when 5 then 'bad_code' when 6 then 'bad_quarter' when 7 then 'short_row' end as reject_reason
                 from (select *, kommunkod as k from housing_kommun)) group by 1""",
        "housing_kommun",
    )
)
def cube_ingest_report(spark, sf_dir):
    """G-09 on parsed cubes: cells by the reason they were rejected for, with the municipalities and quarters they are about."""
    rows = json_documents.cube_rows(cube_documents(spark, sf_dir), "smahus_construction_index")
    return audits.ingest_report(rows, different=["kommunkod", "raw_quarter_str"])


@query(
    """select 'Region' as variable, lpad(n_nationkey::varchar, 4, '0') as code, n_name as label from nation
       union all select distinct 'Tid', year(o_orderdate) || 'K' || quarter(o_orderdate), null from orders"""
)
def cube_metadata(spark, sf_dir):
    """S-09: quarters on offer and region names."""
    quarter = F.concat(F.year("o_orderdate").cast("string"), F.lit("K"), F.quarter("o_orderdate").cast("string"))
    tid = table(spark, sf_dir, "orders").select(quarter.alias("q")).distinct().agg(F.sort_array(F.collect_list("q")).alias("qs"))
    tid = tid.select(F.lit("Tid").alias("id"), F.concat("qs", F.array(F.lit("1999"))).alias("values"), F.array().cast("array<string>").alias("valueTexts"))
    pair = F.struct(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("code"), F.concat("n_name", F.lit(" (01)")).alias("label"))
    region = table(spark, sf_dir, "nation").agg(F.collect_list(pair).alias("pairs"))
    region = region.select(F.lit("Region").alias("id"), F.col("pairs.code").alias("values"), F.col("pairs.label").alias("valueTexts"))
    docs = tid.unionByName(region).select(F.to_json(F.struct(F.array(F.struct("id", "values", "valueTexts")).alias("variables"))).alias("payload"))
    regions = json_documents.cube_regions(docs).select(F.lit("Region").alias("variable"), F.col("region_code").alias("code"), F.col("region_name").alias("label"))
    quarters = json_documents.cube_quarters(docs).select(F.lit("Tid").alias("variable"), F.col("raw_quarter_str").alias("code"), F.lit(None).cast("string").alias("label"))
    return regions.unionByName(quarters)


@query(
    with_views(
        """select effective_date_utc, strftime(effective_date_utc, '%Y-%m-%d') as raw_date_str, policy_rate_pct from policy_rate
           where month(effective_date_utc) <> 6""",
        "policy_rate",
    ),
    doubles="policy_rate_pct",
)
def rate_documents(spark, sf_dir):
    """S-10: three shapes of answer, missing marks and decimal commas."""
    return json_documents.rate_rows(rate_payloads(spark, sf_dir))


@query(
    with_views(
        """select case when month(effective_date_utc) = 6 then 'missing' when month(effective_date_utc) = 7 then 'bad_value' when month(effective_date_utc) = 8 then 'no_date' end as reason,
                  count(*) as n from policy_rate group by 1 union all select 'unreadable', 2""",
        "policy_rate",
    )
)
def rate_rejects(spark, sf_dir):
    """S-10: observations that cannot be read, by reason, beside those that can."""
    odd = spark.createDataFrame([("{broken",), (None,)], "payload string")
    rows = json_documents.rate_records(rate_payloads(spark, sf_dir, damaged=True).unionByName(odd))
    return rows.groupBy(F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))


def rate_payloads(spark, sf_dir, damaged=False):
    r = fx.policy_rate(spark, sf_dir)
    missing = F.when(F.year("effective_date_utc") % 2 == 0, " n/a ").otherwise("..")
    shown = F.when(F.month("effective_date_utc") == 6, missing).otherwise(F.replace(F.col("policy_rate_pct").cast("string"), F.lit("."), F.lit(",")))
    date = F.date_format("effective_date_utc", "yyyy-MM-dd")
    if damaged:
        shown = F.when(F.month("effective_date_utc") == 7, F.lit("1,2,3x")).otherwise(shown)
        date = F.when(F.month("effective_date_utc") == 8, F.lit("")).otherwise(date)
    obs = F.struct(date.alias("date"), shown.alias("value"))
    years = r.groupBy((F.year("effective_date_utc") % 3).alias("shape"), F.year("effective_date_utc").alias("y")).agg(F.collect_list(obs).alias("observations"))
    grouped = F.to_json(F.struct(F.array(F.struct(F.lit("x").alias("seriesId"), "observations")).alias("groups")))
    payload = F.when(F.col("shape") == 0, grouped).when(F.col("shape") == 1, F.to_json(F.struct("observations"))).otherwise(F.to_json("observations"))
    return years.select(payload.alias("payload"))


@query(
    with_views(
        """select zone, date_trunc('millisecond', timestamp_utc) as timestamp_utc, case when event_id % 2 = 0 then round(temperature_c, 3) end as temperature_c,
                  case when event_id % 2 = 1 then round(wind_speed_ms, 3) end as wind_speed_ms, 'G' as quality_flag,
                  case when event_id % 2 = 0 then round(temperature_c, 3) > 40 else false end as is_anomaly
           from weather_obs""",
        "weather_obs",
    ),
    doubles="temperature_c wind_speed_ms",
    digits=3,
)
def weather_documents(spark, sf_dir):
    """S-11: one document per station, parameter and day."""
    obs = fx.weather_obs(spark, sf_dir)
    even = F.col("event_id") % 2 == 0
    value = F.round(F.when(even, F.col("temperature_c")).otherwise(F.col("wind_speed_ms")), 3).cast("decimal(18,3)").cast("string")
    point = F.struct(F.unix_millis("timestamp_utc").alias("date"), F.replace(value, F.lit("."), F.lit(",")).alias("value"), F.lit("G").alias("quality"))
    parameter = F.when(even, 1).otherwise(4).alias("parameter_id")
    docs = obs.groupBy("zone", F.to_date("timestamp_utc").alias("d"), parameter).agg(F.collect_list(point).alias("value"))
    docs = docs.select("zone", "parameter_id", F.lit(1).alias("station_id"), F.to_json(F.struct("value")).alias("payload"))
    rows = json_documents.weather_rows(docs).where("reject_reason is null")
    return rows.select("zone", "timestamp_utc", "temperature_c", "wind_speed_ms", "quality_flag", "is_anomaly")


@query(
    """select doc_id, case when doc_id % 4 = 1 then null else md5(text || 'å') end as digest, case when doc_id % 4 = 1 then null else (length(text) + 1)::int end as n
       from documents where doc_id % 4 <> 2
       union all select doc_id, md5('räksmörgås ' || doc_id), (length('räksmörgås ' || doc_id))::int from documents where doc_id % 4 = 2"""
)
def decoded_bytes(spark, sf_dir):
    """S-12: UTF-8 where it is valid, Latin-1 where it is not, NULL where damage was stored."""
    k = F.col("doc_id") % 4
    content = (
        F.when(k == 1, F.encode(F.concat("text", F.lit("�")), "UTF-8"))
        .when(k == 2, F.encode(F.concat(F.lit("räksmörgås "), F.col("doc_id").cast("string")), "ISO-8859-1"))
        .otherwise(F.encode(F.concat("text", F.lit("å")), "UTF-8"))
    )
    decoded = table(spark, sf_dir, "documents").select("doc_id", text.decode_bytes(content).alias("t"))
    return decoded.select("doc_id", F.md5("t").alias("digest"), F.length("t").alias("n"))


@query(
    with_views("select kommunkod, case when kommunkod % 3 = 0 then 'SE4' else bidding_zone end as bidding_zone from kommun_zone", "kommun_zone")
)
def mapping_file(spark, sf_dir):
    """S-13: a CSV mapping over the default one; rows with unknown zones are ignored."""
    path = scratch_path(spark, "mapping")
    rows = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("kommunkod"), F.when(F.col("n_nationkey") % 3 == 0, " SE4").otherwise("SE7").alias("bidding_zone")
    )
    rows.write.option("header", True).csv(path)
    return tables.read_mapping(spark, path, fx.kommun_zone(spark, sf_dir).select("kommunkod", "bidding_zone"))


@query(
    """select c_custkey, first + (i * 365) * interval 1 day as window_start, least(first + ((i + 1) * 365) * interval 1 day, last) as window_end
       from (select *, unnest(generate_series(0, 20)) as i from (
         select c_custkey, min(o_orderdate) as first, max(o_orderdate) as last from customer join orders on o_custkey = c_custkey group by 1))
       where first + (i * 365) * interval 1 day < last"""
)
def fetch_windows(spark, sf_dir):
    """S-17: periods cut into stretches of at most a year."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = customer.join(orders, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey")
    spans = joined.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return tables.stretches(spans, F.col("first"), F.col("last")).drop("first", "last")
