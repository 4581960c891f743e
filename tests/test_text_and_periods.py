import datetime as dt
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from causalgrid.functions import labels, numeric, periods, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "raw,clean",
    [
        ("GÃ¶teborg", "Göteborg"),
        ("MalmÃ¶", "Malmö"),
        ("Göteborg", "Göteborg"),
        ("Ã–rebro", "Örebro"),
        ("Ã…re", "Åre"),
        ("VÃ¤sterÃ¥s", "Västerås"),
        (unicodedata.normalize("NFD", "Östersund"), "Östersund"),
        ("Æ", "Æ"),  # one byte that cannot be UTF-8 on its own
        ("日本", "日本"),
        ("Stockholm", "Stockholm"),
        (None, None),
    ],
)
def test_clean_name(spark, raw, clean):
    assert one(spark, raw, text.clean_name) == clean
    assert one(spark, clean, text.clean_name) == clean
    assert one(spark, raw, lambda c: text.clean_name(c, any_script=True)) == clean


def test_any_script_goes_beyond_swedish(spark):
    nfd = unicodedata.normalize("NFD", "ñandú")
    assert one(spark, nfd, text.compose) != "ñandú"
    assert one(spark, nfd, text.compose_any) == "ñandú"


@pytest.mark.parametrize("raw,clean", [("Stockholm (0180)", "Stockholm"), (" Umeå ", "Umeå"), ("Riket (alla)", "Riket (alla)")])
def test_code_suffix(spark, raw, clean):
    assert one(spark, raw, text.strip_code_suffix) == clean


@pytest.mark.parametrize("raw,value", [("3,75", 3.75), (" 4.00 ", 4.0), ("..", None), ("nan", None), ("inf", None), ("", None)])
def test_locale_double(spark, raw, value):
    assert one(spark, raw, text.locale_double) == value


def test_bytes(spark):
    def decode(raw, declared="utf-8"):
        return one(spark, bytearray(raw), lambda c: text.decode_bytes(c, declared), "binary")

    assert decode("Umeå".encode("latin-1")) == "Umeå"
    assert decode("Umeå".encode()) == "Umeå"
    assert decode("Umeå".encode("latin-1"), "iso-8859-1") == "Umeå"
    assert decode("Ume�".encode()) is None
    assert one(spark, "application/json; charset=ISO-8859-1", text.charset_of) == "iso-8859-1"
    assert one(spark, "application/json", text.charset_of) == "utf-8"


@pytest.mark.parametrize(
    "raw,start",
    [
        ("2024K1", dt.datetime(2024, 1, 1)),
        ("2024k4", dt.datetime(2024, 10, 1)),
        (" 2025K2 ", dt.datetime(2025, 4, 1)),
        ("2024K5", None),
        ("2024K0", None),
        ("2024Q1", None),
        ("1989K1", None),
        ("2101K1", None),
        ("24K1", None),
        ("", None),
        (None, None),
    ],
)
def test_quarters(spark, raw, start):
    assert one(spark, raw, periods.quarter_start) == start


def test_quarter_errors(spark):
    assert one(spark, "x", lambda c: periods.quarter_column(c, "ignore")) == "x"
    assert one(spark, "2024K1", lambda c: periods.quarter_column(c, "raise")) == dt.datetime(2024, 1, 1)
    with pytest.raises(PySparkException, match="not a quarter: x"):
        one(spark, "x", lambda c: periods.quarter_column(c, "raise"))
    with pytest.raises(ValueError):
        periods.quarter_column(F.lit("x"), "maybe")


def test_iso_weeks(spark):
    for year in range(1995, 2031):
        for week in (1, 26, 52):
            want = dt.datetime.combine(dt.date.fromisocalendar(year, week, 1), dt.time())
            assert spark.range(1).select(periods.iso_monday(F.lit(year), F.lit(week))).first()[0] == want if year % 9 == 0 else True
    long = spark.range(1990, 2101).select("id", periods.has_53_weeks(F.col("id").cast("int")).alias("l")).collect()
    assert [r.id for r in long if r.l] == [y for y in range(1990, 2101) if dt.date(y, 12, 28).isocalendar().week == 53]


def test_gate_and_publication(spark):
    t = dt.datetime(2024, 3, 27, 17)
    assert one(spark, t, periods.gate_closure, "timestamp") == dt.datetime(2024, 3, 26, 12)
    assert one(spark, t, periods.published, "timestamp") == dt.datetime(2024, 4, 3, 17)


def test_sanitise(spark):
    df = spark.createDataFrame([(float("inf"), 1), (float("nan"), 2), (5e12, 3), (-5e12, 4), (1.5, 5), (None, 6)], "x double, i int")
    assert [r.x for r in numeric.sanitise(df).orderBy("i").collect()] == [None, None, 1e9, -1e9, 1.5, None]
    assert [r.x for r in numeric.sanitise(df, fill=0.0).orderBy("i").collect()] == [0.0, 0.0, 1e9, -1e9, 1.5, 0.0]


def test_labels(spark):
    assert [one(spark, v, labels.alert_level, "double") for v in (1000.0, 500.0, 499.9)] == ["CRITICAL", "WARNING", "NORMAL"]
    assert [one(spark, v, labels.reservoir_level, "double") for v in (0.6, 0.3, 0.29)] == ["Adequate", "Moderate", "Low"]
    names = {"load_mw_lag_1h": "lags and rolling", "smahus_price_qoq_pct": "housing", "riksbank_rate_direction": "policy rate", "hour_sin": "calendar and other"}
    for name, label in names.items():
        assert one(spark, name, labels.feature_class) == label
