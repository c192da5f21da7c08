"""Severity of toxic texts by cumulative-link ordinal regression on sparse text features.

Features count how often a text has a word, or words that begin with certain 4, 5 or 6 letters, so inflected forms
count too; counts are divided by the root of the text's length, by which chance alone would grow. Labels only say toxic or not; the grades are 0 (not toxic), 1 and 2 (toxic with a share of telling words
below or from the median). One weight vector serves all thresholds: P(grade > k) = sigmoid(score - threshold k).
The expected severity is the sum of these probabilities.

The model is fitted in one task on at most SAMPLE labelled documents, chosen by hash of the id; it keeps at most
MOST_FEATURES features. Every document is scored on its whole text.
"""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

SAMPLE = 8_000
MOST_FEATURES = 400
PREFIXES = (4, 5, 6)
# A feature needs so many toxic documents in which it is at least this share of the words, and so large a ratio.
LEAST_TOXIC, LEAST_SHARE, LEAST_RATIO = 4, 0.003, 15.0
SHRINK = 1e-6
STEPS, RATE = 2_000, 0.1
# Weight of a toxic document in the fit: they are few.
TOXIC_WEIGHT = 8.0
_WORD = re.compile(r"[^\W\d_]+")
_MODEL = "feature string, weight double"
_THRESHOLDS = ("<threshold 0>", "<threshold 1>")


def features(text: str | None) -> tuple[Counter, Counter]:
    """The words, and how many of them have each feature."""
    words = Counter(_WORD.findall((text or "").lower()))
    found: Counter = Counter()
    for word, count in words.items():
        found[word] += count
        for size in PREFIXES:
            if len(word) > size:
                found[word[:size] + "*"] += count
    return words, found


def _told(word: str, weights: dict[str, float]) -> set[str]:
    return {name for name in (word, *[word[:size] + "*" for size in PREFIXES if len(word) > size]) if name in weights}


def value(count: int, n_words: int) -> float:
    return count / math.sqrt(n_words + 25)


def _marked(words: Counter, found: Counter) -> list[str]:
    least = LEAST_SHARE * sum(words.values())
    return [name for name, count in found.items() if count >= least]


def telling(toxic: list[tuple[Counter, Counter]], clean: list[tuple[Counter, Counter]]) -> list[str]:
    """Features that say toxic, the strongest first."""
    first = Counter(name for text in toxic for name in _marked(*text))
    first = {name: count for name, count in first.items() if count >= LEAST_TOXIC}
    other = Counter(name for text in clean for name in _marked(*text) if name in first)
    n, m = len(toxic), len(clean)

    def ratio(a: int, b: int) -> float:
        """Log-likelihood ratio of one rate for each side against one for both."""
        def part(k, total, rate):
            return (k * math.log(rate) if k else 0.0) + ((total - k) * math.log(1 - rate) if total > k else 0.0)

        both = (a + b) / (n + m)
        return 2 * (part(a, n, a / n) + part(b, m, b / m) - part(a, n, both) - part(b, m, both))

    scored = [(ratio(a, other[name]), name) for name, a in first.items() if m and a / n > 2 * other[name] / m]
    return [name for score, name in sorted(scored, reverse=True) if score >= LEAST_RATIO][:MOST_FEATURES]


def fit(rows: list[tuple[Counter, Counter]], grades: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and the two thresholds, by gradient ascent with momentum on the likelihood."""
    place = {name: i for i, name in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for row, (words, found) in enumerate(rows):
        total = sum(words.values())
        for name in found.keys() & place.keys():
            x[row, place[name]] = value(found[name], total)
    n_bounds = 2
    share = np.where(grades > 0, TOXIC_WEIGHT, 1.0)
    at = np.concatenate([np.zeros(len(names)), [2.0, 0.0]])  # weights, lower threshold, log of the distance
    mean, square = np.zeros_like(at), np.zeros_like(at)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, STEPS + 1):
        weights, lower, apart = at[:-n_bounds], at[-2], np.exp(at[-1])
        score = x @ weights
        low, high = sigmoid(lower - score), sigmoid(lower + apart - score)
        middle = np.maximum(high - low, 1e-9)
        by_score = share * np.select([grades == 0, grades == 1], [low - 1, low + high - 1], high)
        by_low = share * np.select([grades == 0, grades == 1], [1 - low, -low * (1 - low) / middle], 0.0)
        by_high = share * np.select([grades == 2, grades == 1], [-high, high * (1 - high) / middle], 0.0)
        slope = np.concatenate([
            x.T @ by_score / len(rows) - SHRINK * weights, [(by_low + by_high).mean(), by_high.mean() * apart]
        ])
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        at = at + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        at[:-n_bounds] = np.maximum(at[:-n_bounds], 0.0)
    return at[:-n_bounds], np.array([at[-2], at[-2] + np.exp(at[-1])])


def _fitted(batches):
    texts, labels, seen = [], [], set()
    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            # The same text again teaches nothing.
            if (key := (xxh3_128_digest(text or ""), toxic)) not in seen:
                seen.add(key)
                texts.append(features(text))
                labels.append(int(toxic))
    sides = [[text for text, label in zip(texts, labels, strict=True) if bool(label) == side] for side in (True, False)]
    names = telling(*sides) if sides[0] else []
    toxic = np.array(labels, np.int64)
    known = dict.fromkeys(names, 1.0)
    share = np.array([
        sum(n for word, n in words.items() if _told(word, known)) / max(1, sum(words.values())) for words, _ in texts
    ])
    grades = toxic.copy()
    if names:
        grades[(toxic == 1) & (share >= np.median(share[toxic == 1]))] = 2
        weights, bounds = fit(texts, grades, names)
    else:
        weights, bounds = np.zeros(0), np.array([4.0, 5.0])  # nothing learned: everything is clean
    kept = [(name, float(weight)) for name, weight in zip(names, weights, strict=True) if weight > 0]
    kept += zip(_THRESHOLDS, map(float, bounds), strict=True)
    yield pa.RecordBatch.from_arrays(
        [pa.array([row[0] for row in kept]), pa.array([row[1] for row in kept], pa.float64())], names=["feature", "weight"]
    )


def model(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights by feature, with the thresholds. Labels that are NULL or of no document are left out; of several for
    one id the highest counts."""
    votes = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    rows = rows.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "toxic")
    return {row["feature"]: row["weight"] for row in rows.mapInArrow(_fitted, _MODEL).collect()}


def severity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`doc_id, severity, grade, toxic` of every document row.

    `grade` is the most likely one, `toxic` whether a grade over 0 is more likely than not. NULL and empty texts have
    no features and are clean, as is everything where there is nothing to learn from. Repeated rows are scored alike.
    """
    weights = model(documents, labels, sample)
    low, high = (weights.pop(name, bound) for name, bound in zip(_THRESHOLDS, (4.0, 5.0), strict=True))
    sent = documents.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        table = sent.value
        found = []
        for text in texts:
            words = Counter(_WORD.findall((text.as_py() or "").lower()))
            told = Counter()
            for word, count in words.items():
                for name in _told(word, table):
                    told[name] += count
            total = sum(words.values())
            found.append(sum(table[name] * value(told[name], total) for name in sorted(told)))
        return pa.array(found, pa.float64())

    over = lambda bound: 1 / (1 + F.exp(F.lit(bound) - F.col("score")))
    scored = documents.select("doc_id", score("text").alias("score"))
    scored = scored.select("doc_id", over(low).alias("over0"), over(high).alias("over1"))
    likely = F.when(F.col("over0") < 1 - F.col("over0"), 0)
    middle, top = F.col("over0") - F.col("over1"), F.col("over1")
    return scored.select(
        "doc_id", F.round(F.col("over0") + F.col("over1"), 6).alias("severity"),
        likely.when(top >= middle, 2).otherwise(1).alias("grade"), (F.col("over0") >= 0.5).alias("toxic"),
    )
