"""Tick analytics on Spark: validated trades, bars, risk signals and their streaming jobs."""

__version__ = "0.1.0"
