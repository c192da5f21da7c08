"""Raw messages: which are accepted, which become dead letters and why."""

import json

import pytest
from pyspark.sql import functions as F

from candlewick.operators import ingest
from candlewick.operators.bars import ohlcv
from candlewick.operators.health import component_health, last_trade, latency_histogram, with_ingest_time
from candlewick.operators.signals import trading_signals
from candlewick.sources import samples
from candlewick.sources.topic import decode_trades, read_raw_messages

GOOD = {"e": "trade", "E": 1704067200240, "s": "btcusdt", "t": 123, "p": "100.5", "q": "0.25", "T": 1704067200239, "m": True}
INGEST = 1704067200300


def message(**changes):
    return json.dumps({**GOOD, **changes})


def without(*keys):
    return json.dumps({key: value for key, value in GOOD.items() if key not in keys})


def check(spark, values):
    raw = spark.createDataFrame([(value,) for value in values], "value string")
    return ingest.check(raw, F.lit(INGEST))


def reason(spark, value):
    return check(spark, [value]).first().error_reason


def test_good_message_becomes_a_trade(spark):
    row = ingest.accepted(check(spark, [message()])).first().asDict()
    assert row == {
        "trade_id": "123", "symbol": "BTCUSDT", "price": 100.5, "quantity": 0.25, "is_buyer_maker": True,
        "trade_time_ms": 1704067200239, "event_time_ms": 1704067200240, "ingest_time_ms": INGEST,
        "notional_usd": 25.125, "latency_ms": 61, "date_partition": "2024/01/01",
    }


@pytest.mark.parametrize("key", ["e", "E", "s", "t", "p", "q", "T", "m"])
def test_each_required_key(spark, key):
    assert reason(spark, without(key)) == f"Missing required fields: ['{key}']"


def test_missing_keys_are_listed_sorted(spark):
    assert reason(spark, without("t", "E", "m")) == "Missing required fields: ['E', 'm', 't']"
    assert reason(spark, "{}") == "Missing required fields: ['E', 'T', 'e', 'm', 'p', 'q', 's', 't']"


@pytest.mark.parametrize(
    "text",
    ["", "text", "[]", "[1]", "1", '"x"', "null", "{", message()[:-1], message() + " x", message() + message(),
     message() + "," + message(), "[" + message() + "]", message().replace('"', "'"), None],
)
def test_anything_but_one_json_object_is_a_parse_error(spark, text):
    assert reason(spark, text) == "JSON parse error"


@pytest.mark.parametrize("value", ["abc", "", "1_", "_1", "1__0", "1.5d", "1.5f", "0x1p3", None, [], {}])
@pytest.mark.parametrize("key", ["p", "q"])
def test_not_a_number(spark, key, value):
    assert reason(spark, message(**{key: value})).startswith(f"Type cast error: {key}=")


@pytest.mark.parametrize(
    "value, number",
    [(" 1.5 ", 1.5), ("1e3", 1000.0), ("1_0", 10.0), ("+2", 2.0), (".5", 0.5), ("5.", 5.0), (7, 7.0), (0.25, 0.25), (True, 1.0)],
)
def test_accepted_number_spellings(spark, value, number):
    row = check(spark, [message(p=value)]).first()
    assert (row.error_reason, row.price) == (None, number)


@pytest.mark.parametrize("value", ["nan", "NaN", "inf", "-Infinity", "1e999"])
def test_non_finite_values_are_rejected(spark, value):
    """Deliberately stricter than a plain `<= 0` test, which NaN and infinity pass."""
    assert reason(spark, message(p=value)).startswith("Non-finite values: ")


def test_very_long_numbers_are_read_once(spark):
    long_values = ["1" * 300_000 + "x", "1_" * 150_000, "1_" * 150_000 + "1", "." * 300_000, "0" * 300_000 + "1", " " * 300_000 + "2"]
    reasons = [row.error_reason and row.error_reason[:15] for row in check(spark, [message(p=v) for v in long_values]).collect()]
    assert reasons == ["Type cast error", "Type cast error", "Non-finite valu", "Type cast error", None, None]


def test_bare_nan_literal_is_rejected(spark):
    assert reason(spark, message(p="@").replace('"@"', "NaN")).startswith(("Non-finite", "Type cast"))


@pytest.mark.parametrize("value", ["0", "-1", "-0.0", "0e5"])
@pytest.mark.parametrize("key", ["p", "q"])
def test_non_positive(spark, key, value):
    assert reason(spark, message(**{key: value})).startswith("Non-positive values: price=")


def test_reason_text_names_both_values(spark):
    assert reason(spark, message(p="100.5", q="0")) == "Non-positive values: price=100.5, qty=0.0"


def test_checks_run_in_order(spark):
    assert reason(spark, without("m").replace('"100.5"', '"abc"')).startswith("Missing")
    assert reason(spark, message(p="abc", q="-1")) == "Type cast error: p=abc"
    assert reason(spark, message(p="abc", q="abc")) == "Type cast error: p=abc"
    assert reason(spark, message(q="-1", T="soon")).startswith("Non-positive")


@pytest.mark.parametrize("key", ["s", "t"])
def test_null_key_fields_are_rejected(spark, key):
    """A null symbol or id must not become the text 'NONE' or 'None'."""
    assert reason(spark, message(**{key: None})) == f"Null key field: {key}"


@pytest.mark.parametrize("value", ["soon", "1.5", "", None, []])
@pytest.mark.parametrize("key", ["T", "E"])
def test_times_that_are_no_integers_are_dead_letters(spark, key, value):
    assert reason(spark, message(**{key: value})).startswith(f"Type cast error: {key}=")


@pytest.mark.parametrize("value, number", [("17", 17), (" 17 ", 17), ("1_7", 17), (17.9, 17), (-17.9, -17), (1.7e3, 1700)])
def test_accepted_time_spellings(spark, value, number):
    row = check(spark, [message(T=value)]).first()
    assert (row.error_reason, row.trade_time_ms) == (None, number)


@pytest.mark.parametrize(
    "value, flag",
    [(True, True), (False, False), (None, False), ("false", False), ("true", True), ("", False), (0, False), (1, True), ("maybe", True), (0.0, False), (2, True), ([], False), ({}, False), ([0], True)],
)
def test_maker_flag(spark, value, flag):
    row = check(spark, [message(m=value)]).first()
    assert (row.error_reason, row.is_buyer_maker) == (None, flag)


def test_last_of_repeated_keys_counts(spark):
    row = check(spark, [message()[:-1] + ', "p": "7"}']).first()
    assert (row.error_reason, row.price) == (None, 7.0)


def test_extra_keys_and_long_ids_are_kept(spark):
    row = check(spark, [message(t=12345678901234567890123, extra={"a": [1]})]).first()
    assert (row.error_reason, row.trade_id) == (None, "12345678901234567890123")


def test_notional_rounds_half_up(spark):
    row = ingest.accepted(check(spark, [message(p="1.00005", q="1")])).first()
    assert row.notional_usd == 1.0001


def test_latency_may_be_negative(spark):
    assert ingest.accepted(check(spark, [message(T=INGEST + 40)])).first().latency_ms == -40


def test_out_of_range_time_has_no_event_time(spark):
    trades = ingest.with_event_time(ingest.accepted(check(spark, [message(T=9 * 10**18)])))
    assert trades.first().trade_timestamp is None


@pytest.mark.parametrize("changes", [{"T": -(2**63)}, {"T": 2**63 - 1, "E": -(2**63)}, {"p": "1e308", "q": "1e308"}, {"t": -5}])
def test_extreme_values_do_not_stop_the_job(spark, changes):
    checked = check(spark, [message(**changes), message()])
    trades = ingest.with_event_time(ingest.accepted(checked))
    assert trades.count() == 2
    assert ohlcv(trades).agg(F.sum("trade_count")).first()[0] >= 1
    assert trading_signals(trades).count() >= 1
    assert component_health(with_ingest_time(checked)).count() == 1
    assert last_trade(trades).count() == 1 and latency_histogram(trades).count() == 9


def test_routing_loses_and_doubles_nothing(spark, medium):
    raw = samples.raw_messages(samples.events(spark, medium), faulty=True)
    good, bad = ingest.route(raw, F.col("ingest_time_ms"))
    assert good.count() + bad.count() == raw.count() == 10_000
    assert {row.topic: row["count"] for row in ingest.topic_rows(
        ingest.check(raw, F.col("ingest_time_ms"))).groupBy("topic").count().collect()
    } == {"trades": good.count(), "trades_dlq": bad.count()}


def test_clean_feed_rejects_only_non_positive(spark, medium):
    bad = ingest.rejected(samples.checked_messages(samples.events(spark, medium)))
    assert bad.count() == 93
    assert bad.filter(~F.col("error_reason").startswith("Non-positive")).isEmpty()


def test_parsed_and_direct_trades_agree(spark, small):
    source = samples.events(spark, small)
    parsed = ingest.with_event_time(ingest.accepted(samples.checked_messages(source)))
    direct = samples.trades(source)
    assert parsed.exceptAll(direct).isEmpty() and direct.exceptAll(parsed).isEmpty()


def test_decode_keeps_unreadable_rows(spark):
    values = ["text", "[]", None, '{"price":"1.5","symbol":"A"}', '{"trade_id":7,"trade_time_ms":1.5}']
    rows = decode_trades(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    assert len(rows) == 5
    assert all(value is None for row in rows[:3] for value in row)
    assert (rows[3].price, rows[3].symbol) == (None, "A")
    assert (rows[4].trade_id, rows[4].trade_time_ms) == ("7", None)


def test_raw_feed_reads_json_lines(spark, tmp_path):
    (tmp_path / "feed.txt").write_text(message() + "\n" + "broken\n")
    checked = ingest.check(read_raw_messages(spark, str(tmp_path)), F.lit(INGEST))
    assert sorted(str(row.error_reason) for row in checked.collect()) == ["JSON parse error", "None"]


def test_repeats_are_dropped_only_on_request(spark, small):
    trades = samples.trades(samples.events(spark, small))
    doubled = trades.unionByName(trades)
    assert doubled.count() == 2 * trades.count()
    assert ingest.without_repeats(doubled).count() == trades.count()
