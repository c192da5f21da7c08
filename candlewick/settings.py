"""Fixed values and defaults shared by the batch and streaming code."""

# They decide results, so they are not tunable per cluster.
REQUIRED_KEYS = ("e", "E", "s", "t", "p", "q", "T", "m")
SILVER_WINDOW = "5 minutes"
SILVER_SLIDE = "1 minute"
GOLD_WINDOW = "15 minutes"
LATENESS = "10 minutes"
SPIKE_RATIO = 1.5
DEVIATION_HIGH_PCT = 2.0
DEVIATION_MEDIUM_PCT = 1.0
HIGH_RISK = ("HIGH", "CRITICAL")
CRITICAL_HEADLINE = "⚠️ CRITICAL RISK"
HIGH_HEADLINE = "🔴 HIGH risk - Monitor closely. Deviation: "
DUMP_NOTE = "Volume dump detected"
LATENCY_BUCKETS_MS = (1, 5, 10, 25, 50, 100, 250, 500)
RSI_PERIOD = 14
BARS_PER_DAY = 288

# Retention in days, per table.
RETENTION_DAYS = {"bars": 30, "signals": 90, "alerts": 90, "health": 7}

# Topic names and the key every dead letter carries.
TRADES_TOPIC = "trades"
DEAD_LETTER_TOPIC = "trades_dlq"
DEAD_LETTER_KEY = "dlq"

# Operational defaults: safe to change, results stay the same.
BRONZE_TRIGGER = "30 seconds"
SILVER_TRIGGER = "60 seconds"
GOLD_TRIGGER = "60 seconds"
BRONZE_TASKS_PER_FOLDER = 4

# How far the clock of a feed may run ahead before its messages become dead letters.
MAX_AHEAD_MS = 3_600_000
