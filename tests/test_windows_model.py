"""Bars and signals against a plain Python model, over random trades with ties, unknown sides and missing prices."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from candlewick.operators.bars import ohlcv
from candlewick.operators.signals import trading_signals
from helpers import START, frame, trade


def rounded(value, digits, terms, keep=9):
    if value is None:
        return None
    number = Decimal(repr(value))
    if terms > 2:
        number = number.quantize(Decimal(1).scaleb(-keep), ROUND_HALF_UP)
    return float(number.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def random_trades(seed, count=600):
    chance = random.Random(seed)
    rows = []
    for number in range(count):
        price = None if chance.random() < 0.03 else round(chance.choice([100, 100.01, 101, 103, 250.55]) + chance.randrange(5) / 100, 2)
        rows.append(
            trade(
                number, price, chance.choice([0.5, 1.0, 2.25, 7.0]), chance.choice([True, False, None]),
                minute=chance.randrange(40) + chance.choice([0, 0.5]), symbol=chance.choice("ABBB"), ingest_delay=chance.randrange(-20, 900),
            )
        )
    chance.shuffle(rows)
    return rows


def grouped(rows, minutes):
    groups = defaultdict(list)
    for row in rows:
        groups[row["symbol"], (row["trade_time_ms"] - START) // (minutes * 60_000)].append(row)
    return {key: sorted(group, key=lambda row: (row["trade_time_ms"], int(row["trade_id"]))) for key, group in groups.items()}


def found(rows, minutes):
    return {(row.symbol, round((row.window_start.timestamp() * 1000 - START) / 60_000) // minutes): row for row in rows.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bars(spark, seed):
    rows = random_trades(seed)
    expected, got = grouped(rows, 5), found(ohlcv(frame(spark, rows).repartition(5)), 5)
    assert set(got) == set(expected)
    for key, group in expected.items():
        bar, prices = got[key], [row["price"] for row in group if row["price"] is not None]
        volume = sum(row["quantity"] for row in group)
        turnover = [row["price"] * row["quantity"] for row in group if row["price"] is not None]
        notional = [row["notional_usd"] for row in group if row["notional_usd"] is not None]
        assert (bar.open, bar.close) == (group[0]["price"], group[-1]["price"])
        assert (bar.high, bar.low) == (max(prices, default=None), min(prices, default=None))
        assert (bar.trade_count, bar.total_volume) == (len(group), rounded(volume, 6, len(group)))
        assert bar.sma_5min == (rounded(sum(prices) / len(prices), 2, len(prices)) if prices else None)
        assert bar.vwap == (rounded(sum(turnover) / volume, 2, len(group)) if turnover else None)
        assert bar.total_notional_usd == (rounded(sum(notional), 2, len(group), keep=4) if notional else None)
        assert bar.avg_latency_ms == rounded(sum(row["latency_ms"] for row in group) / len(group), 1, 0)


@pytest.mark.parametrize("seed", [4, 5])
def test_signals(spark, seed):
    rows = random_trades(seed)
    expected, got = grouped(rows, 15), found(trading_signals(frame(spark, rows).repartition(5)), 15)
    assert set(got) == set(expected)
    for key, group in expected.items():
        signal, prices = got[key], [row["price"] for row in group if row["price"] is not None]
        buy = sum(row["quantity"] for row in group if row["is_buyer_maker"] is False)
        sell = sum(row["quantity"] for row in group if row["is_buyer_maker"] is True)
        mean, close = sum(prices) / len(prices), group[-1]["price"]
        deviation = None if close is None else rounded(abs(close - mean) / mean * 100, 4, len(group))
        spike, far = sell > buy * 1.5, deviation is not None and deviation > 2
        level = "CRITICAL" if spike and far else "HIGH" if spike or far else "MEDIUM" if deviation is not None and deviation > 1 else "LOW"
        assert (signal.buy_volume, signal.sell_volume, signal.volume_spike) == (buy, sell, spike)
        assert (signal.price_deviation_pct, signal.risk_level) == (deviation, level)
        assert signal.buy_pressure == (rounded(buy / (buy + sell), 4, len(group)) if buy + sell else None)
        assert abs(signal.sma_15min - mean) < 1e-9
