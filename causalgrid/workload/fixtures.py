"""Grid-shaped views over the given tables, once for Spark and once as SQL for the oracle.

The tables hold no grid data; every view is a plain query over whole tables. ``CTE[name]`` is
the same view in DuckDB's dialect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causalgrid.session import pin_utc

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its zone-less timestamps read as UTC."""
    pin_utc(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def _zone(key: str) -> Column:
    return F.concat(F.lit("SE"), (F.col(key) % 4 + 1).cast("string")).alias("zone")



def _hour() -> Column:
    return F.date_trunc("hour", "ts").alias("timestamp_utc")


def grid_hourly(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    return table(spark, sf_dir, "events").groupBy(_zone("user_id"), _hour()).agg(
        F.sum(F.when(kind.isin("view", "click"), value * 100)).alias("load_mw"),
        F.sum(F.when(kind == "purchase", value).when(kind == "error", -value)).alias("imbalance_mwh"),
        F.avg("value").alias("price_eur_mwh"),
        (F.max("value") > 200).alias("is_anomaly"),
    )


def kommun_zone(spark, sf_dir):
    zone = F.when(F.col("n_regionkey") < 4, F.concat(F.lit("SE"), (F.col("n_regionkey") + 1).cast("string")))
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("kommunkod"), F.col("n_name").alias("region_name"), zone.alias("bidding_zone")
    )


def housing_kommun(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    quarter = F.concat(F.year("o_orderdate").cast("string"), F.lit("K"), F.quarter("o_orderdate").cast("string"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(quarter.alias("raw_quarter_str"), F.col("c_nationkey").alias("kommunkod")).agg(
        F.count("*").cast("double").alias("smahus_construction_index"),
        F.avg("o_totalprice").alias("smahus_price_index"),
    )


def policy_rate(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.date_trunc("month", "o_orderdate").alias("effective_date_utc")).agg(
        (F.round(F.avg("o_totalprice") / 25000) / 4).alias("policy_rate_pct")
    )


def outage_events(spark, sf_dir):
    faults = table(spark, sf_dir, "events")
    start = F.date_trunc("hour", "ts")
    hours = (F.col("event_id") % 48 + 1).cast("int")
    return faults.select(
        "event_id",
        F.concat(F.lit("U"), (F.col("user_id") % 9).cast("string")).alias("unit"),
        _zone("user_id"),
        start.alias("event_start"),
        F.timestamp_add("HOUR", hours, start).alias("event_stop"),
        (F.col("value") * 10).alias("unavailable_mw"),
    )


def net_positions(spark, sf_dir):
    signed = F.when(F.col("event_type") == "purchase", F.col("value") * 20).otherwise(-F.col("value"))
    return table(spark, sf_dir, "events").groupBy(_zone("user_id"), _hour()).agg(
        F.sum(signed).alias("scheduled_net_position_mw")
    )


def hydro_weekly(spark, sf_dir):
    ship = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").groupBy(
        F.extract(F.lit("yearofweek"), ship).cast("int").alias("year"), F.weekofyear(ship).alias("week_of_year")
    ).agg((F.avg("l_discount") * 10).alias("reservoir_fill_ratio"))


def weather_obs(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        _zone("user_id"),
        F.col("ts").alias("timestamp_utc"),
        (F.col("value") / 10 - 5).alias("temperature_c"),
        (F.col("value") / 15).alias("wind_speed_ms"),
        (F.col("value") > 300).alias("is_anomaly"),
        F.col("event_id"),
    )


def grid_daily(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    zone = F.concat(F.lit("SE"), (F.col("n_regionkey") % 4 + 1).cast("string")).alias("zone")
    return joined.groupBy(zone, F.col("l_shipdate").alias("timestamp_utc")).agg(
        F.sum("l_quantity").alias("load_mw"),
        F.sum(F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("imbalance_mwh"),
        (F.avg("l_extendedprice") / 500).alias("price_eur_mwh"),
    )


CTE: dict[str, str] = {
    "grid_hourly": """
        select 'SE' || (user_id % 4 + 1)::varchar as zone, date_trunc('hour', ts) as timestamp_utc,
               sum(case when event_type in ('view', 'click') then value * 100 end) as load_mw,
               sum(case when event_type = 'purchase' then value when event_type = 'error' then -value end) as imbalance_mwh,
               avg(value) as price_eur_mwh, max(value) > 200 as is_anomaly
        from events group by 1, 2""",
    "kommun_zone": """
        select n_nationkey as kommunkod, n_name as region_name,
               case when n_regionkey < 4 then 'SE' || (n_regionkey + 1)::varchar end as bidding_zone
        from nation""",
    "housing_kommun": """
        select year(o_orderdate)::varchar || 'K' || quarter(o_orderdate)::varchar as raw_quarter_str,
               c_nationkey as kommunkod, count(*)::double as smahus_construction_index,
               avg(o_totalprice) as smahus_price_index
        from orders join customer on o_custkey = c_custkey group by 1, 2""",
    "policy_rate": """
        select date_trunc('month', o_orderdate)::timestamp as effective_date_utc,
               round(avg(o_totalprice) / 25000) / 4 as policy_rate_pct
        from orders group by 1""",
    "outage_events": """
        select event_id, 'U' || (user_id % 9)::varchar as unit, 'SE' || (user_id % 4 + 1)::varchar as zone,
               date_trunc('hour', ts) as event_start,
               date_trunc('hour', ts) + (event_id % 48 + 1) * interval 1 hour as event_stop,
               value * 10 as unavailable_mw
        from events""",
    "net_positions": """
        select 'SE' || (user_id % 4 + 1)::varchar as zone, date_trunc('hour', ts) as timestamp_utc,
               sum(case when event_type = 'purchase' then value * 20 else -value end) as scheduled_net_position_mw
        from events group by 1, 2""",
    "hydro_weekly": """
        select isoyear(l_shipdate)::int as year, weekofyear(l_shipdate)::int as week_of_year,
               avg(l_discount) * 10 as reservoir_fill_ratio
        from lineitem group by 1, 2""",
    "weather_obs": """
        select 'SE' || (user_id % 4 + 1)::varchar as zone, ts as timestamp_utc, value / 10 - 5 as temperature_c,
               value / 15 as wind_speed_ms, value > 300 as is_anomaly, event_id
        from events""",
    "grid_daily": """
        select 'SE' || (n_regionkey % 4 + 1)::varchar as zone, l_shipdate as timestamp_utc, sum(l_quantity) as load_mw,
               sum(l_extendedprice * (l_discount - 0.05)) as imbalance_mwh, avg(l_extendedprice) / 500 as price_eur_mwh
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
        group by 1, 2""",
}


def with_views(body: str, *names: str, **extra: str) -> str:
    """``with name as (...), ... body``; ``extra`` views may use the named ones and come after."""
    views = [f"{n} as ({CTE[n]})" for n in names] + [f"{n} as ({q})" for n, q in extra.items()]
    return f"with {', '.join(views)} {body}" if views else body
