"""Quality rules whose cutoffs come from labelled holdouts.

Every rule compares one signal with a cutoff. For each stratum and rule the cutoffs are tested from lenient to
strict on the labelled good documents: a cutoff is certified if the exact binomial test shows, at its share of
`risk`, that it rejects less than its share of `limit` of all good documents. Testing stops at the first failure
(a fixed sequence needs no correction of its own); the risk is divided by the number of strata and rules, and the
limit by the number of rules, so with probability 1 - risk no stratum loses more than `limit` of its good
documents. Among the certified cutoffs the one that rejects most of the labelled bad documents is taken, the most
lenient of equals; a rule that rejects none of them is left out.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.llm.text import (
    BLANK, between, carried, covered, fenced, own_columns, with_windows, word_hashes,
)
from candlewick.session import stored

SYMBOLS = r"[#*$%&|<>]"
LIMIT = 0.05
RISK = 0.05
# signal of the rule -> its cutoffs, lenient first; a document is rejected if the signal is above the cutoff.
RULES = {
    "symbols_per_100_words": (200, 150, 100, 75, 50, 30, 20, 10),
    "marks_per_100_words": (200, 150, 100, 75, 50, 30, 20),
    "upper_per_100_chars": (80, 70, 60, 50, 40, 30),
    "dup_lines_per_100": (90, 80, 70, 60, 50, 40),
    "echoes_per_100_words": (90, 80, 70, 60, 50, 40, 30),
}
_WORK = "quality_work_"


def measured(documents: DataFrame) -> DataFrame:
    """The documents with a struct `quality_work_signals` of counts and ratios; one row in, one row out.

    NULL and empty texts have no words; their counts and ratios are 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    w = _WORK
    words = fenced(documents, w + "words", between(text, BLANK))
    hashed = fenced(words, w + "hashes", word_hashes(F.col(w + "words"))).withColumn(w + "n", F.size(w + "words"))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = with_windows(hashed, w + "hashes", [5], w + "run").withColumn(w + "lines", lines)
    # Most texts repeat no run; only the others sort theirs.
    repeats = fenced(
        counted,
        w + "sorted",
        F.when(
            F.size(F.array_distinct(w + "run5")) < F.size(w + "run5"),
            F.sort_array(F.transform(w + "run5", lambda run, at: F.struct(run.alias("run"), (at + 1).alias("pos")))),
        ),
    )
    placed = repeats.withColumn(w + "spans", F.expr(
        f"array_sort(transform(filter({w}sorted, (e, j) -> coalesce(get({w}sorted, j - 1).run = e.run, false)"
        f" OR coalesce(get({w}sorted, j + 1).run = e.run, false)), e -> struct(e.pos as pos, 5 as len)))"
    ).cast("array<struct<pos:int,len:int>>"))
    n = F.col(w + "n").cast("long")
    n_lines = F.size(w + "lines").cast("long")
    n_dup = (F.size(w + "lines") - F.size(F.array_distinct(w + "lines"))).cast("long")
    echoes = F.expr(f"size(filter({w}hashes, (h, i) -> coalesce(get({w}hashes, i - 1) = h, false)))").cast("long")
    per = lambda part, whole: F.coalesce(F.try_divide(100 * part, whole), F.lit(0.0))
    counts = fenced(placed, w + "counts", F.struct(
        n.alias("n_words"),
        F.length(F.array_join(w + "words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        n_dup.alias("n_dup_lines"),
        F.coalesce(F.expr(covered(w + "spans")), F.lit(0)).cast("long").alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_marks"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        echoes.alias("n_echoes"),
    ))
    c = lambda name: F.col(w + "counts").getField(name)
    failed = (c("n_words") < 10) | (100 * c("n_repeat_words") > 20 * c("n_words"))
    signals = F.struct(
        *[c(name).alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        per(c("n_symbols"), c("n_words")).alias("symbols_per_100_words"),
        per(c("n_marks"), c("n_words")).alias("marks_per_100_words"),
        per(c("n_upper"), c("word_chars")).alias("upper_per_100_chars"),
        per(c("n_dup_lines"), c("n_lines")).alias("dup_lines_per_100"),
        per(c("n_echoes"), c("n_words")).alias("echoes_per_100_words"),
    )
    return fenced(counts, w + "signals", signals).select(*documents.columns, w + "signals")


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series, after shifting x up by 8."""
    shifted = x + 8.0
    series = (shifted - 0.5) * F.log(shifted) - shifted + 0.9189385332046727
    series = series + 1 / (12 * shifted) - 1 / (360 * shifted**3) + 1 / (1260 * shifted**5) - 1 / (1680 * shifted**7)
    for step in range(8):
        series = series - F.log(x + float(step))
    return series


def binomial_tail(rejected: Column, good: Column, rate: float) -> Column:
    """P(at most `rejected` of `good`) where each is rejected with probability `rate`.

    The largest term is exact to double precision; the others follow from it by their ratios, downwards. For
    `rejected` above the mean the answer is over 0.4 in any case and given as 1. Terms more than 40 standard
    deviations below the first cannot be seen in the sum.
    """
    k, n = rejected.cast("double"), good.cast("double")
    first = F.exp(
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
        + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate))
    )
    steps = F.least(rejected.cast("long"), (50 + 40 * F.sqrt(n)).cast("long"))
    odds = (1 - rate) / rate
    state = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1).cast("long"), steps)).otherwise(F.array().cast("array<bigint>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda a, i: F.struct(
            (a["term"] * (k - i + 1) / (n - k + i) * odds).alias("term"),
            (a["total"] + a["term"] * (k - i + 1) / (n - k + i) * odds).alias("total"),
        ),
        lambda a: a["total"],
    )
    return F.when(k > n * rate, F.lit(1.0)).otherwise(first * state)


def cutoffs(labelled: DataFrame, limit: float = LIMIT, risk: float = RISK, rules: dict = RULES) -> DataFrame:
    """`stratum, rule, cutoff` of the rules that hold, from rows `stratum, quality, signals`.

    A stratum needs enough good documents for any cutoff to be certified: at least
    ln(risk / strata / rules) / ln(1 - limit / rules). Others get no rule and lose nothing.
    """
    grid = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(order).alias("step"), F.lit(float(cutoff)).alias("cutoff"),
                 (F.col("signals")[name] > cutoff).alias("rejects"))
        for name, steps in rules.items() for order, cutoff in enumerate(steps)
    ])
    tested = (
        labelled.select("stratum", "quality", F.explode(grid).alias("t"))
        .groupBy("stratum", "t.rule", "t.step", "t.cutoff")
        .agg(
            F.count_if(F.col("quality") == 1).alias("good"),
            F.count_if((F.col("quality") == 1) & F.col("t.rejects")).alias("good_rejected"),
            F.count_if((F.col("quality") == 0) & F.col("t.rejects")).alias("bad_rejected"),
        )
    )
    strata = labelled.agg(F.greatest(F.count_distinct("stratum"), F.lit(1)).alias("strata"))
    level = F.lit(risk / len(rules)) / F.lit(strata.first()["strata"])
    tail = binomial_tail(F.col("good_rejected"), F.col("good"), limit / len(rules))
    passing = tested.withColumn("fails", F.when((F.col("good") > 0) & (tail <= level), 0).otherwise(1))
    sequence = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    certified = passing.withColumn("failed", F.sum("fails").over(sequence)).where("failed = 0 AND bad_rejected > 0")
    best = F.max_by("cutoff", F.struct("bad_rejected", (-F.col("step")).alias("lenient")))
    return certified.groupBy("stratum", "rule").agg(best.alias("cutoff"))


def _stratum(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _signals(documents: DataFrame, stratum: str) -> DataFrame:
    """`doc_id, stratum, signals` of every row, stored: the texts are measured once."""
    rows = measured(documents.select("doc_id", "text", stratum))
    return stored(rows.select("doc_id", _stratum(stratum).alias("stratum"), F.col(_WORK + "signals").alias("signals")), "signals")


def _chosen(signals: DataFrame, labels: DataFrame, limit: float, risk: float, rules: dict) -> DataFrame:
    """One row for each stratum with a rule: its cutoffs in a column for each rule."""
    votes = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    labelled = signals.join(votes, "doc_id").where(~F.col("signals.base_failed")).drop("doc_id")
    chosen = cutoffs(stored(labelled, "labelled"), limit, risk, rules).groupBy("stratum").agg(
        *[F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(_WORK + name) for name in rules]
    )
    # A stored table has a known size: Spark broadcasts it if it is small and joins by shuffle if not.
    return stored(chosen.withColumnRenamed("stratum", _WORK + "stratum"), "cutoffs")


def _kept(signals: str, rules: dict) -> Column:
    rejected = F.lit(False)
    for name in rules:
        rejected = rejected | F.coalesce(F.col(signals)[name] > F.col(_WORK + name), F.lit(False))
    return ~F.col(signals)["base_failed"] & ~rejected


def quality(
    documents: DataFrame, labels: DataFrame, stratum: str = "lang",
    limit: float = LIMIT, risk: float = RISK, rules: dict = RULES,
) -> DataFrame:
    """`doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept` of every row.

    Labels: several for one id count once, as good if any says so; NULL ids or labels are ignored. A document
    that fails the base rules takes no part in the tests and is not kept. Documents with a NULL stratum form a
    stratum of their own. Rows that repeat an id count once each. Without labels only the base rules hold.
    """
    signals = _signals(documents, stratum)
    chosen = _chosen(signals, labels, limit, risk, rules)
    joined = signals.join(chosen, F.col("stratum") == F.col(_WORK + "stratum"), "left")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return joined.select(
        "doc_id", *[F.col("signals")[name].alias(name) for name in names], _kept("signals", rules).alias("kept")
    )


def keep_good(
    documents: DataFrame, labels: DataFrame, stratum: str = "lang",
    limit: float = LIMIT, risk: float = RISK, rules: dict = RULES,
) -> DataFrame:
    """The documents that `quality` keeps, with their own columns, whatever these are called.

    They are measured once and stored with what was measured: to choose the cutoffs takes all of them, and texts are
    not shuffled to meet their verdict.
    """
    rows = measured(carried(documents, "doc_id", "text", stratum)).withColumn(_WORK + "own", _stratum(stratum))
    ready = stored(rows.drop("text"), "measured")
    signals = ready.select("doc_id", F.col(_WORK + "own").alias("stratum"), F.col(_WORK + "signals").alias("signals"))
    chosen = _chosen(signals, labels, limit, risk, rules)
    joined = ready.join(chosen, F.col(_WORK + "own") == F.col(_WORK + "stratum"), "left")
    return joined.where(_kept(_WORK + "signals", rules)).select(*own_columns(documents))
