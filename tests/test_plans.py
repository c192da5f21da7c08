"""The physical plans that make the operators hold at scale."""

import pytest

from candlewick.plans.registry import registered
from candlewick.operators import ingest
from candlewick.operators.bars import ohlcv
from candlewick.operators.health import latency_histogram
from candlewick.operators.indicators import rsi
from candlewick.operators.signals import trading_signals
from candlewick.sources import samples
from helpers import plan

WRITING = ("stream", "roundtrip", "from_bronze", "after_upserts", "rsi", "backtest", "backfill")


@pytest.fixture
def trades(spark, small):
    return samples.trades(samples.events(spark, small))


@pytest.mark.parametrize("build", [ohlcv, trading_signals, lambda t: ohlcv(t, slide="2 minutes")])
def test_windows_combine_before_one_shuffle(trades, build):
    text = plan(build(trades), "simple")
    assert text.count("Exchange") == 1
    assert "partial_max_by" in text and "SortAggregate" not in text and "Sort [" not in text
    before, after = text.split("Exchange")
    assert "HashAggregate" in before and "HashAggregate" in after


def test_sliding_copies_summaries_not_trades(trades):
    text = plan(ohlcv(trades, slide="1 minute"), "simple")
    assert text.count("Exchange") == 2 and "SortAggregate" not in text
    assert "Expand" not in text.split("Exchange")[-1]


def test_unused_measures_are_not_computed(trades):
    assert "close_at" not in plan(ohlcv(trades), "simple")
    assert "min_by" not in plan(trading_signals(trades), "simple")


def test_filter_and_columns_reach_the_scan(trades):
    text = plan(ohlcv(trades))
    assert "GreaterThan(value,0.0)" in text
    scan = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "user_id" not in scan and "value:double" in scan


def test_each_branch_parses_json_once(spark, small):
    checked = samples.checked_messages(samples.events(spark, small))
    for branch in (ingest.accepted(checked), ingest.rejected(checked), ingest.topic_rows(checked)):
        assert plan(branch, "simple").count("from_json(") == 1


def test_histogram_is_one_pass(trades):
    text = plan(latency_histogram(trades), "simple")
    assert text.count("FileScan") == 1 and "SinglePartition" in text and "partial_count" in text


def test_momentum_never_sorts_a_whole_symbol(spark, trades):
    text = plan(rsi(ohlcv(trades)), "simple")
    rows = [line for line in text.splitlines() if "Window [" in line]
    assert rows and all(", part#" in line or ", block#" in line or "sum(size" in line for line in rows)


@pytest.mark.parametrize("name", [name for name in registered() if not any(part in name for part in WRITING)])
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(registered()[name](spark, small), "simple")
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapPartitions"):
        assert word not in text
