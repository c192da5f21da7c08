"""The checks against a plain Python model, over many random messages."""

import json
import math
import random
import re

from pyspark.sql import functions as F

from candlewick.operators import ingest

KEYS = ("e", "E", "s", "t", "p", "q", "T", "m")
LIMIT = 2**63
NUMBER_LIKE = [
    "1", "0", "-1", "1.5", "-0.5", "1e3", "1E-3", ".5", "5.", "+2", " 3 ", "1_000", "1__0", "_1", "1_", "1e", "e1", "", " ",
    "abc", "1.5d", "2f", "0x10", "nan", "NaN", "inf", "-Infinity", "infinit", "1,5", "1 2", "--1", "1e400", "9" * 25, "true",
]
VALUES = [*NUMBER_LIKE, 0, 1, -1, 2.5, 0.0, 1e3, 1.7e12, 10**25, True, False, None, [], {}, [1], {"a": 1}, "BTC", "x y", "Ä\"\\"]


def as_real(value):
    """(number, known): what the value is as a float."""
    if isinstance(value, (bool, int, float)):
        return float(value), True
    if isinstance(value, str) and value.isascii():
        try:
            return float(value), True
        except ValueError:
            pass
    return None, False


def as_whole(value):
    if isinstance(value, str):
        try:
            number = int(value)
        except ValueError:
            return None
    elif isinstance(value, (bool, int, float)):
        number = int(value)
    else:
        return None
    return number if -LIMIT <= number < LIMIT else None


def kind_of(text):
    """The class of the reason, or None for an accepted message."""
    try:
        message = json.loads(text)
    except json.JSONDecodeError:
        return "JSON parse error"
    if not isinstance(message, dict):
        return "JSON parse error"
    if any(key not in message for key in KEYS):
        return "Missing required fields"
    (price, known_p), (quantity, known_q) = as_real(message["p"]), as_real(message["q"])
    if not (known_p and known_q):
        return "Type cast error"
    if not (math.isfinite(price) and math.isfinite(quantity)):
        return "Non-finite values"
    if price <= 0 or quantity <= 0:
        return "Non-positive values"
    if message["t"] is None or message["s"] is None:
        return "Null key field"
    if as_whole(message["T"]) is None or as_whole(message["E"]) is None:
        return "Type cast error"
    return None


def random_message(chance):
    message = {"e": "trade", "E": 17, "s": "btc", "t": 5, "p": "2.5", "q": "4", "T": 19, "m": True}
    for _ in range(chance.choice([0, 1, 1, 2, 3])):
        key = chance.choice(KEYS)
        if chance.random() < 0.15:
            message.pop(key, None)
        else:
            message[key] = chance.choice(VALUES)
    items = list(message.items())
    chance.shuffle(items)
    text = json.dumps(dict(items), ensure_ascii=chance.random() < 0.5)
    damage = chance.random()
    if damage < 0.04:
        text = text[: chance.randrange(len(text))]
    elif damage < 0.08:
        text += chance.choice([" ", "\n", "x", "{}", ",1", text, "}"])
    elif damage < 0.1:
        text = "[" + text + "]"
    return text


def test_random_messages(spark):
    chance = random.Random(2024)
    texts = [random_message(chance) for _ in range(6000)]
    raw = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "ingest long, value string")
    rows = ingest.check(raw, F.col("ingest")).collect()
    assert len(rows) == len(texts)
    wrong, accepted = [], 0
    for row in rows:
        text = texts[row.ingest_time_ms]
        expected = kind_of(text)
        found = None if row.error_reason is None else re.match(r"[^:]*", row.error_reason).group()
        if found != expected:
            wrong.append((text, found, expected))
        elif expected is None:
            accepted += 1
            message = json.loads(text)
            values = (row.price, row.quantity, row.trade_time_ms, row.event_time_ms)
            known = (as_real(message["p"])[0], as_real(message["q"])[0], as_whole(message["T"]), as_whole(message["E"]))
            assert values == known, text
    assert accepted > 1000
    assert not wrong, (len(wrong), wrong[:8])
