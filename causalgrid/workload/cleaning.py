"""Queries for text, number and period cleaning."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from causalgrid.functions import labels, numeric, periods, text
from causalgrid.workload import fixtures as fx
from causalgrid.workload.fixtures import table, with_views
from causalgrid.workload.registry import query

REPAIRS = "{c}"
for _bad, _good in text.MOJIBAKE.items():
    REPAIRS = f"replace({REPAIRS}, '{_bad}', '{_good}')"

DAMAGES = "{c}"
for _bad, _good in text.MOJIBAKE.items():
    DAMAGES = f"replace({DAMAGES}, '{_good}', '{_bad}')"


def _damaged(c):
    for bad, good in text.MOJIBAKE.items():
        c = F.replace(c, F.lit(good), F.lit(bad))
    return c


@query(
    f"""select doc_id, md5({REPAIRS.format(c='damaged')}) as cleaned, length(damaged) <> length(text) as was_damaged
        from (select doc_id, text, {DAMAGES.format(c="text || 'åäö'")} as damaged from documents)"""
)
def clean_mojibake(spark, sf_dir):
    """P-01: letters broken by a wrong encoding, over whole documents."""
    docs = table(spark, sf_dir, "documents")
    damaged = docs.withColumn("damaged", _damaged(F.concat("text", F.lit("åäö"))))
    return damaged.select(
        "doc_id",
        F.md5(text.repair_mojibake(F.col("damaged"))).alias("cleaned"),
        (F.length("damaged") != F.length("text")).alias("was_damaged"),
    )


@query("select doc_id, md5(text) as cleaned, length(text)::int as n_chars from documents")
def clean_latin1(spark, sf_dir):
    """P-02: a whole text read as Latin-1 comes back unchanged; a clean text is left alone."""
    docs = table(spark, sf_dir, "documents")
    misread = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    repaired = docs.withColumn("cleaned", text.repair_latin1(misread))
    return repaired.select("doc_id", F.md5("cleaned").alias("cleaned"), F.length("cleaned").alias("n_chars"))


MARKED = unicodedata.normalize("NFD", " Å å ä ö é ü ñ")


@query(f"select doc_id, md5(nfc_normalize(text || '{MARKED}')) as composed from documents")
def clean_composed(spark, sf_dir):
    """P-03: base letter plus combining mark to one letter, any script."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(text.compose_any(F.concat("text", F.lit(MARKED)))).alias("composed"))


@query(
    "select n_nationkey, n_name || ' Åre é' as n_name, null::varchar as region_note, 'Ã¥' as plain from nation"
)
def clean_name_columns(spark, sf_dir):
    """P-04: columns named like places are cleaned, NULL stays, other columns are left alone."""
    nation = table(spark, sf_dir, "nation")
    broken = nation.select(
        "n_nationkey",
        F.concat("n_name", F.lit(" Ã…re é")).alias("n_name"),
        F.lit(None).cast("string").alias("region_note"),
        F.lit("Ã¥").alias("plain"),
    )
    return text.clean_names(broken)


@query(
    "select 'n_name' as \"column\", count_if(n_name is null) as nulls_before, count_if(n_name is null) as nulls_after from nation "
    "union all select 'region_note', count_if(n_regionkey = 2), count_if(n_regionkey = 2) from nation"
)
def clean_null_audit(spark, sf_dir):
    """P-04: cleaning must not change the number of NULLs."""
    note = F.when(F.col("n_regionkey") != 2, F.concat("n_name", F.lit("Ã¶")))
    nation = table(spark, sf_dir, "nation").withColumn("region_note", note)
    return text.null_audit(nation, text.clean_names(nation), ["n_name", "region_note"])


_QUARTERS = """
    select o_orderkey, case o_orderkey % 7
        when 0 then ' ' || year(o_orderdate) || 'k' || quarter(o_orderdate) || ' '
        when 1 then year(o_orderdate) || 'K5' when 2 then '1889K1' when 3 then null
        else year(o_orderdate) || 'K' || quarter(o_orderdate) end as raw, o_orderdate
    from orders"""


def _raw_quarters(spark, sf_dir):
    year, quarter = F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string")
    kind = F.col("o_orderkey") % 7
    raw = (
        F.when(kind == 0, F.concat(F.lit(" "), year, F.lit("k"), quarter, F.lit(" ")))
        .when(kind == 1, F.concat(year, F.lit("K5")))
        .when(kind == 2, F.lit("1889K1"))
        .when(kind == 3, F.lit(None))
        .otherwise(F.concat(year, F.lit("K"), quarter))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"), "o_orderdate")


@query(
    f"""select o_orderkey, raw, case when o_orderkey % 7 in (0, 4, 5, 6) then date_trunc('quarter', o_orderdate)::timestamp end as period_utc,
               case when o_orderkey % 7 = 2 then timestamp '1889-01-01'
                    when o_orderkey % 7 in (0, 4, 5, 6) then date_trunc('quarter', o_orderdate)::timestamp end as any_year
        from ({_QUARTERS})"""
)
def quarter_strings(spark, sf_dir):
    """P-05: quarter strings to quarter starts, with and without the check of the year."""
    raw = F.col("raw")
    return _raw_quarters(spark, sf_dir).select(
        "o_orderkey", "raw", periods.quarter_start(raw).alias("period_utc"), periods.quarter_start(raw, False).alias("any_year")
    )


@query(
    f"""select raw as ignored, case when o_orderkey % 7 in (0, 4, 5, 6) then date_trunc('quarter', o_orderdate)::timestamp end as coerced,
               count(*) as n from ({_QUARTERS}) group by 1, 2"""
)
def quarter_error_modes(spark, sf_dir):
    """P-06: unreadable quarters become NULL or are kept as they are."""
    raw = F.col("raw")
    both = _raw_quarters(spark, sf_dir).select(
        periods.quarter_column(raw, "ignore").alias("ignored"), periods.quarter_column(raw, "coerce").alias("coerced")
    )
    return both.groupBy("ignored", "coerced").agg(F.count("*").alias("n"))


@query(
    """select c_custkey, c_name as region_name, case when c_custkey % 9 <> 0 then c_nationkey end as code,
              case when c_custkey % 5 <> 0 then c_acctbal end as amount from customer""",
    doubles="amount",
)
def region_names_and_codes(spark, sf_dir):
    """P-07 to P-09: code suffix off the name, zero-padded codes, decimal commas."""
    c = table(spark, sf_dir, "customer")
    padded = F.lpad(F.col("c_nationkey").cast("string"), 4, "0")
    raw = c.select(
        "c_custkey",
        F.concat("c_name", F.lit("  ("), padded, F.lit(") ")).alias("name"),
        F.when(F.col("c_custkey") % 9 == 0, F.lit("n/a")).otherwise(padded).alias("code"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(".."))
        .otherwise(F.concat(F.lit(" "), F.replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))))
        .alias("amount"),
    )
    return raw.select(
        "c_custkey",
        text.strip_code_suffix(F.col("name")).alias("region_name"),
        text.plain_code(F.col("code")).alias("code"),
        text.locale_double(F.col("amount")).alias("amount"),
    )


@query(
    """select event_id, date_trunc('second', ts) as from_z, date_trunc('second', ts) - interval 2 hour as from_offset, ts as naive from events"""
)
def utc_times(spark, sf_dir):
    """P-10: zone-less times are UTC, others are converted."""
    e = table(spark, sf_dir, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select(
        "event_id",
        periods.utc(F.concat(stamp, F.lit("Z"))).alias("from_z"),
        periods.utc(F.concat(stamp, F.lit("+02:00"))).alias("from_offset"),
        F.col("ts").alias("naive"),
    )


@query(
    """select o_orderkey, case when o_orderkey % 10 > 0 then date_trunc('day', o_orderdate)::timestamp end as effective_date_utc from orders"""
)
def date_strings(spark, sf_dir):
    """P-11: dates to midnight UTC, NULL if unreadable."""
    raw = F.when(F.col("o_orderkey") % 10 == 0, F.lit("2024-13-45")).otherwise(F.date_format("o_orderdate", "' 'yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", periods.day_start(raw).alias("effective_date_utc"))


@query(
    with_views(
        """select year, week_of_year, min(monday)::timestamp as monday, (min(monday) + interval 7 day)::timestamp as published_utc,
                  (select count(*) from (select unnest(generate_series(make_date(year, 1, 1), make_date(year, 12, 31), interval 1 day)) as d)
                   where isodow(d) = 4) = 53 as has_53_weeks
           from (select year, week_of_year, d as monday from hydro_weekly,
                 (select unnest(generate_series(date '1990-01-01', date '2010-12-31', interval 1 day)) as d) days
                 where isodow(d) = 1 and isoyear(d) = year and weekofyear(d) = week_of_year)
           group by 1, 2""",
        "hydro_weekly",
    )
)
def iso_weeks(spark, sf_dir):
    """P-12 to P-14: ISO weeks to Mondays, long years, publication a week later."""
    monday = periods.iso_monday(F.col("year"), F.col("week_of_year"))
    return fx.hydro_weekly(spark, sf_dir).select(
        "year",
        "week_of_year",
        monday.alias("monday"),
        periods.published(monday).alias("published_utc"),
        periods.has_53_weeks(F.col("year")).alias("has_53_weeks"),
    )


@query("select event_id, ts, date_trunc('day', ts)::timestamp - interval 12 hour as gate_utc from events")
def gate_closures(spark, sf_dir):
    """P-15: noon of the day before delivery."""
    return table(spark, sf_dir, "events").select("event_id", "ts", periods.gate_closure(F.col("ts")).alias("gate_utc"))


@query(
    with_views(
        """select zone, timestamp_utc, case when not is_anomaly then load_mw end as load_mw_clean,
                  case when not is_anomaly then imbalance_mwh end as imbalance_mwh_clean, price_eur_mwh from grid_hourly""",
        "grid_hourly",
    ),
    doubles="load_mw_clean imbalance_mwh_clean price_eur_mwh",
)
def quarantine_mask(spark, sf_dir):
    """P-16: quarantined load and imbalance are hidden, the price is not."""
    from causalgrid.plans.gold import mask_quarantined

    g = fx.grid_hourly(spark, sf_dir).withColumn("is_quarantined", F.col("is_anomaly"))
    return mask_quarantined(g).select("zone", "timestamp_utc", "load_mw_clean", "imbalance_mwh_clean", "price_eur_mwh")


_WILD = """select event_id, case when event_id % 11 = 0 then 'inf'::double when event_id % 11 = 1 then '-inf'::double
        when event_id % 11 = 2 then 'nan'::double when event_id % 11 = 3 then null else (value - 50) * 2e7 end as x from events"""


def _wild(spark, sf_dir):
    k = F.col("event_id") % 11
    x = F.when(k == 0, F.lit(float("inf"))).when(k == 1, F.lit(float("-inf"))).when(k == 2, F.lit(float("nan")))
    x = x.when(k == 3, F.lit(None)).otherwise((F.col("value") - 50) * 2e7)
    return table(spark, sf_dir, "events").select("event_id", x.alias("x"))


@query(
    f"""select event_id, case when not isnan(x) and not isinf(x) then greatest(least(x, 1e9), -1e9) end as x,
               coalesce(case when not isnan(x) and not isinf(x) then greatest(least(x, 1e9), -1e9) end, -1) as x_filled from ({_WILD})""",
    doubles="x x_filled",
    digits=3,
)
def sanitise_values(spark, sf_dir):
    """P-17: infinite to NULL, clip, fill."""
    wild = _wild(spark, sf_dir).withColumn("x_filled", F.col("x"))
    return numeric.sanitise(numeric.sanitise(wild, ["x"]), ["x_filled"], fill=-1.0)


@query(
    f"""select count_if(isinf(x)) as infinite, count_if(not isinf(x) and not isnan(x) and abs(x) > 1e9) as clipped,
               count_if(x is null or isnan(x) or isinf(x)) as missing from ({_WILD})"""
)
def sanitise_report(spark, sf_dir):
    """P-17: how many values each step touches."""
    return numeric.sanitise_counts(_wild(spark, sf_dir), ["x"])


@query(
    "select l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) as per_discount from lineitem",
    doubles="per_discount",
    digits=3,
)
def safe_ratio(spark, sf_dir):
    """P-18: no value where the denominator is zero."""
    per = numeric.ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("per_discount")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", per)


@query(
    with_views(
        """select event_id, unavailable_mw, case when unavailable_mw >= 1000 then 'CRITICAL' when unavailable_mw >= 500 then 'WARNING'
           else 'NORMAL' end as level from outage_events""",
        "outage_events",
    ),
    doubles="unavailable_mw",
)
def alert_levels(spark, sf_dir):
    """P-23."""
    level = labels.alert_level(F.col("unavailable_mw")).alias("level")
    return fx.outage_events(spark, sf_dir).select("event_id", "unavailable_mw", level)


@query(
    with_views(
        """select year, week_of_year, case when reservoir_fill_ratio >= 0.6 then 'Adequate' when reservoir_fill_ratio >= 0.3 then 'Moderate'
           else 'Low' end as level from (select * replace (reservoir_fill_ratio + 0.01 * (week_of_year % 20) - 0.1 as reservoir_fill_ratio)
           from hydro_weekly)""",
        "hydro_weekly",
    )
)
def reservoir_levels(spark, sf_dir):
    """P-24."""
    fill = F.col("reservoir_fill_ratio") + 0.01 * (F.col("week_of_year") % 20) - 0.1
    return fx.hydro_weekly(spark, sf_dir).select("year", "week_of_year", labels.reservoir_level(fill).alias("level"))


@query(
    with_views(
        """select zone, timestamp_utc, scheduled_net_position_mw * imbalance_mwh < 0 as diverges
           from net_positions join grid_hourly using (zone, timestamp_utc)""",
        "net_positions",
        "grid_hourly",
    )
)
def divergence_flags(spark, sf_dir):
    """P-25."""
    both = fx.net_positions(spark, sf_dir).join(fx.grid_hourly(spark, sf_dir), ["zone", "timestamp_utc"])
    flag = labels.diverges(F.col("scheduled_net_position_mw"), F.col("imbalance_mwh")).alias("diverges")
    return both.select("zone", "timestamp_utc", flag)
