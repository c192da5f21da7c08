import pytest
from pyspark.sql import functions as F

from candlewick.operators import signals
from candlewick.operators.health import high_risk_count
from candlewick.sources import samples
from helpers import frame, trade

BASE = "symbol string, close double, sma_15min double, buy_volume double, sell_volume double, trade_count long"


def graded(spark, close, mean, buy, sell):
    base = spark.createDataFrame([("A", close, mean, buy, sell, 4)], BASE)
    return signals.grade(base, "sma_15min").first()


@pytest.mark.parametrize(
    "buy, sell, spike", [(2.0, 3.0, False), (2.0, 3.0001, True), (0.0, 0.0, False), (0.0, 0.1, True), (5.0, 0.0, False)]
)
def test_volume_spike_is_strict(spark, buy, sell, spike):
    assert graded(spark, 100.0, 100.0, buy, sell).volume_spike is spike


@pytest.mark.parametrize(
    "close, spike_sell, level",
    [
        (100.0, 0.0, "LOW"), (101.0, 0.0, "LOW"), (101.0001, 0.0, "MEDIUM"), (102.0, 0.0, "MEDIUM"),
        (102.00004, 0.0, "MEDIUM"), (102.0001, 0.0, "HIGH"), (100.0, 9.0, "HIGH"), (102.0, 9.0, "HIGH"),
        (102.0001, 9.0, "CRITICAL"), (97.9, 9.0, "CRITICAL"),
    ],
)
def test_risk_levels_use_the_rounded_deviation(spark, close, spike_sell, level):
    assert graded(spark, close, 100.0, 1.0, spike_sell).risk_level == level


def test_buy_pressure(spark):
    assert graded(spark, 1.0, 1.0, 1.0, 2.0).buy_pressure == 0.3333
    assert graded(spark, 1.0, 1.0, 0.0, 0.0).buy_pressure is None


@pytest.mark.parametrize("mean", [0.0, None])
def test_unknown_deviation_leaves_the_spike_to_decide(spark, mean):
    calm, spiked = graded(spark, 1.0, mean, 1.0, 1.0), graded(spark, 1.0, mean, 1.0, 9.0)
    assert (calm.price_deviation_pct, calm.risk_level, calm.alert_message) == (None, "LOW", None)
    assert (spiked.price_deviation_pct, spiked.risk_level, spiked.alert_message) == (None, "HIGH", None)


def test_messages(spark):
    assert graded(spark, 103.0, 100.0, 1.0, 9.0).alert_message == (
        "⚠️ CRITICAL RISK | Price dev: 3.0% | Volume dump detected"
    )
    assert graded(spark, 103.0, 100.0, 9.0, 1.0).alert_message == (
        "🔴 HIGH risk - Monitor closely. Deviation: 3.0%"
    )
    assert graded(spark, 101.5, 100.0, 9.0, 1.0).alert_message is None
    assert graded(spark, 100.0005, 100.0, 1.0, 9.0).alert_message.endswith("Deviation: 5.0E-4%")


def test_unknown_side_counts_in_neither_volume(spark):
    trades = frame(spark, [trade(1, 1.0, 2.0, maker=None), trade(2, 1.0, 3.0, maker=True), trade(3, 1.0, 4.0, maker=False)])
    row = signals.trading_signals(trades).first()
    assert (row.volume_15min, row.buy_volume, row.sell_volume, row.trade_count) == (9.0, 4.0, 3.0, 3)


def test_columns_of_the_signal_table(spark, small):
    from candlewick import schemas

    rows = signals.trading_signals(samples.trades(samples.events(spark, small)))
    assert rows.columns == schemas.SIGNAL.names
    assert [field.dataType for field in rows.schema] == [field.dataType for field in schemas.SIGNAL]


def test_every_level_occurs(spark, medium):
    rows = signals.trading_signals(samples.trades(samples.events(spark, medium)))
    levels = {row.risk_level: row["count"] for row in rows.groupBy("risk_level").count().collect()}
    assert levels == {"LOW": 2497, "MEDIUM": 17, "HIGH": 3753, "CRITICAL": 884}
    counts = high_risk_count(rows).first()
    assert (counts.signals, counts.high_risk) == (7151, 4637)


def test_alerts_are_the_high_risk_signals(spark, small):
    rows = signals.trading_signals(samples.trades(samples.events(spark, small)))
    alerts = signals.alert_history(rows)
    assert alerts.count() == signals.high_risk(rows).count()
    assert alerts.filter(F.col("notified")).isEmpty()
    assert alerts.filter(F.unix_seconds("alert_time") - F.unix_seconds("window_start") != 900).isEmpty()


@pytest.mark.parametrize("times", [1, 2, 5])
def test_repeating_every_trade_changes_no_level(spark, times):
    """A deviation just above 2.0 rounds to it, however many trades the mean is made of."""
    prices = [97.9999500001, 102.0000499999] * times
    (row,) = signals.trading_signals(frame(spark, [trade(n, p) for n, p in enumerate(prices)])).collect()
    assert (row["price_deviation_pct"], row["risk_level"]) == (2.0, "MEDIUM")
