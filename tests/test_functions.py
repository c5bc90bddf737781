"""Scalars, calendar and payloads."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pitlake.functions import calendar, payloads, scalars


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [("1.5", 1.5), (" 2 ", 2.0), ("", None), ("x", None), (None, None)])
def test_to_double(spark, text, want):
    assert one(spark, scalars.to_double(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("text", "want"), [("3.9", 3), ("-3.9", -3), ("x", None)])
def test_to_long_truncates(spark, text, want):
    assert one(spark, scalars.to_long(F.lit(text))) == want


@pytest.mark.parametrize(("text", "want"), [("1700000000", datetime(2023, 11, 14, 22, 13, 20)), ("1700000000000", datetime(2023, 11, 14, 22, 13, 20)), ("2024-01-02T03:04:05", datetime(2024, 1, 2, 3, 4, 5)), ("soon", None)])
def test_to_timestamp(spark, text, want):
    assert one(spark, scalars.to_timestamp(F.lit(text))) == want


@pytest.mark.parametrize(
    ("kind", "key", "want"),
    [("equity", "equity:BRK.B", True), ("equity", "equity:brk", False), ("crypto", "crypto:BTC-USD", True), ("forex", "forex:EUR-USD", True), ("option", "option:OCC:AAPL260116C00200000", True), ("macro", "macro:treasury_yield:2year", True), ("bond", "bond:X", False)],
)
def test_key_grammar(spark, kind, key, want):
    assert one(spark, scalars.valid_key(F.lit(key), F.lit(kind))) is want


def test_versions_order():
    assert sorted(["v10", "v9", "1.2.0", "v1.10.0"], key=scalars.version_order) == ["v10", "v9", "1.2.0", "v1.10.0"]


@pytest.mark.parametrize(("text", "want"), [("5d", 432000), ("1h", 3600), ("2M", 5184000), ("30m", 1800)])
def test_durations(text, want):
    assert scalars.parse_duration(text) == want


def test_bad_duration():
    with pytest.raises(ValueError):
        scalars.parse_duration("five days")


def test_flag_is_added_once(spark):
    flags = F.array(F.lit("a"))
    assert one(spark, scalars.add_flag(scalars.add_flag(flags, "b", F.lit(True)), "b", F.lit(True))) == ["a", "b"]


def test_holidays_of_2024():
    assert calendar.holidays(2024) == {date(2024, 1, 1), date(2024, 1, 15), date(2024, 2, 19), date(2024, 3, 29), date(2024, 5, 27), date(2024, 6, 19), date(2024, 7, 4), date(2024, 9, 2), date(2024, 11, 28), date(2024, 12, 25)}
    assert calendar.early_closes(2024) == {date(2024, 7, 3), date(2024, 11, 29), date(2024, 12, 24)}


def test_market_clock(spark):
    days = calendar.sessions(spark, "2024-07-01", "2024-07-08")
    rows = [(1, datetime(2024, 7, 3, 17, 0)), (2, datetime(2024, 7, 2, 14, 30)), (3, datetime(2024, 7, 4, 15, 0)), (4, datetime(2024, 7, 2, 20, 0))]
    df = spark.createDataFrame(rows, "i int, ts timestamp_ntz")
    got = {r["i"]: r for r in calendar.with_market_clock(df, "ts", days).collect()}
    assert [got[i]["is_open"] for i in (1, 2, 3, 4)] == [False, True, False, False]  # closed early, open, holiday, just closed
    assert got[2]["market_minutes"] == 390 + 60 and got[3]["market_minutes"] == 390 * 2 + 210
    assert got[3]["next_open"] == datetime(2024, 7, 5, 13, 30)
    due = calendar.after_market_minutes(spark.createDataFrame([(390,)], "m long"), "m", days).first()["due"]
    assert due == datetime(2024, 7, 2, 13, 30)  # a whole session ends at the next open


def test_publish_and_label_times(spark):
    days = calendar.sessions(spark, "2024-07-01", "2024-07-12")
    df = spark.createDataFrame([(1, date(2024, 7, 3)), (2, date(2024, 7, 6))], "i int, day date")
    out = {r["i"]: r["ts_available"] for r in calendar.publish_time(df, "day", days).collect()}
    assert out == {1: datetime(2024, 7, 5, 16), 2: datetime(2024, 7, 8, 16)}
    seen = {r["i"]: r["ts_available"] for r in calendar.label_availability(df, "day", days, 2, 60).collect()}
    assert seen == {1: datetime(2024, 7, 8, 20, 1), 2: datetime(2024, 7, 9, 20, 1)}


def test_chain_and_items(spark):
    df = spark.createDataFrame([("a", '[{"occ_symbol":"X1","strike":1.0}]'), ("b", '{"data":{"contracts":[{"occ_symbol":"X2"},{"occ_symbol":"X3"}]}}'), ("c", "oops")], "k string, chain_json string")
    assert sorted(r["occ_symbol"] for r in payloads.explode_chain(df).collect()) == ["X1", "X2", "X3"]
    items = spark.createDataFrame([("e1", '{"bars":[{"c":1.0},{"c":2.0}]}'), ("e2", '{"bars":[]}')], "event_id string, payload string")
    assert sorted((r["event_id"], r["c"]) for r in payloads.explode_items(items, "payload", "bars", "struct<c:double>").collect()) == [("e1:0", 1.0), ("e1:1", 2.0)]


def test_event_id_is_blake2b(spark):
    import hashlib

    assert one(spark, payloads.event_id(F.lit("a|b"))) == hashlib.blake2b(b"a|b", digest_size=16).hexdigest()
