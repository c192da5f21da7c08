"""Conversation repair, substring dedup and periodic runs against brute force: NULLs, empties, ties, repeats, odd columns."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm import periodic, repair, repeats
from candlewick.llm.queries import registered
from candlewick.llm.sql import oracle
from oracle_check import compare, database

DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text):
    return re.findall(WORD, text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_substrings"])
def test_query_equals_its_sql(spark, small, name):
    assert name in oracle() and compare(spark, database(small), small, name) == []


# -- conversation repair ---------------------------------------------------------------------------------


def every_audit(rows, most_inserts=3):
    """The cheapest, then least audit, by trying all edits."""
    best = None

    def go(i, cost, audit, state, inserts):
        nonlocal best
        if i == len(rows) and state in "-a" and (best is None or (cost, audit) < best):
            best = cost, audit
        after = "a" if state == "u" else "u"
        if inserts < most_inserts:
            go(i, cost + 5, audit + "I", after, inserts + 1)
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            go(i + 1, cost + 2, audit + "D", state, inserts)
            if not must_go:
                extra = 5 if truncated else 0
                if initial == after or (initial == "s" and state == "-"):
                    go(i + 1, cost + extra, audit + "K", initial, inserts)
                go(i + 1, cost + 1 + extra, audit + "R", after, inserts)

    go(0, 0, "", "-", 0)
    return best


@pytest.mark.parametrize("modulus", [(1 << 61) - 1, 7, 2])
def test_audits_are_the_cheapest_and_least_even_where_hashes_collide(modulus):
    rng = random.Random(modulus)
    for _ in range(150):
        rows = [(rng.choice("uuaast"), rng.random() < 0.15, rng.random() < 0.3) for _ in range(rng.randint(0, 6))]
        found = repair.Repair(modulus)
        for row in rows:
            found.turn(*row)
        assert found.result() == every_audit(rows), rows


def test_long_audits_agree_for_good_and_bad_hashes():
    rng = random.Random(5)
    rows = [(rng.choice("uuaast"), rng.random() < 0.1, rng.random() < 0.3) for _ in range(3000)]
    results = []
    for modulus in ((1 << 61) - 1, 1_000_003, 101):
        found = repair.Repair(modulus)
        for row in rows:
            found.turn(*row)
        results.append(found.result())
    assert results[0] == results[1] == results[2] and len(results[0][1]) >= 3000


def test_ancestors_reach_every_depth():
    nodes = [repair.Audit(None, "", 97)]
    for _ in range(300):
        nodes.append(repair.Audit(nodes[-1], "K", 97))
    for node in nodes:
        assert [node.at(depth) for depth in range(node.depth + 1)] == nodes[: node.depth + 1]


def test_repair_of_hand_made_conversations(spark):
    rows = [
        (1, 0, "system", "S."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Ho."),  # nothing to mend
        (2, 0, "user", "One."), (2, 1, "user", "Two."), (2, 2, "assistant", "Three"),  # illegal pair, truncated
        (3, None, "user", "A."), (3, 5, "assistant", " \t"), (3, 9, "user", "A."),  # NULL turn, blank, duplicate
        (4, 0, None, None), (4, 0, None, None),  # NULLs are one space: blank
        (None, 1, "assistant", "B."), (None, 0, "user", "A."),  # NULL ids form one conversation
        (5, 0, "tool", "X."), (5, 0, "tool", "X."), (5, 1, "", "Y."),  # equal turns are in order, empty role
    ]
    given = spark.createDataFrame(rows, TURNS)
    found = {row["conv_id"]: tuple(row)[1:] for row in repair.repair_digests(given.withColumn("audit", F.lit("mine"))).collect()}
    told = lambda *lines: sha("\n".join(lines))
    assert found[1] == (0, 0, 0, 0, 0, 0, "KKK", told("system:S.", "user:Hi.", "assistant:Ho."))
    assert found[2][:5] == (0, 0, 0, 1, 1) and found[2][5:7] == every_audit(
        [("u", False, False), ("u", False, False), ("a", False, True)]
    )
    assert found[3][:5] == (3, 1, 1, 0, 0) and found[3][5:7] == (6, "DDD")
    assert found[4] == (0, 2, 0, 0, 1, 4, "DD", told())
    assert found[None] == (0, 0, 0, 0, 0, 0, "KK", told("user:A.", "assistant:B."))
    assert found[5][:5] == (0, 0, 1, 0, 2) and found[5][5:7] == (4, "RDR") and found[5][7] == told("user:X.", "assistant:Y.")
    assert len(found) == 6


def test_repaired_turns_are_what_the_digest_says(spark, small):
    given = spark.read.parquet(f"{small}/conversations.parquet")
    broken = repair.damaged(given, F.crc32(F.concat("conv_id", F.lit("#"), "turn").cast("binary")) % 7)
    turns = repair.repaired_turns(broken)
    lines = {}
    for row in turns.orderBy("conv_id", "place").collect():
        lines.setdefault(row["conv_id"], []).append((row["role"], f"{row['role']}:{row['text']}"))
    for row in repair.repair_digests(broken).collect():
        mended = lines.get(row["conv_id"], [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in mended))
        assert row["repaired_sha256"] == sha("\n".join(line for _, line in mended))
        assert len(mended) == len(row["audit"].replace("D", ""))


def test_repair_of_no_rows(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair.repair_digests(none).isEmpty() and repair.repaired_turns(none).isEmpty()


def test_one_very_long_conversation(spark):
    """Far over a batch of rows; a task holds numbers for its turns, never their texts."""
    given = spark.range(12_001).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    row = repair.repair_digests(given).first()
    assert (row["cost"], row["illegal"], row["gaps"], row["audit"]) == (2, 0, 0, "K" * 12_000 + "D")


# -- substring dedup -------------------------------------------------------------------------------------


def brute_repeats(rows, length=20):
    """{row number: (words, removed, digest)} of rows (id, text), NULL the smallest id."""
    rank = lambda key: (key is not None, key or 0)
    first = {}
    for key, text in rows:
        words = words_of(text)
        for start in range(len(words) - length + 1):
            window, at = tuple(words[start : start + length]), (rank(key), start)
            first[window] = min(first.get(window, at), at)
    found = []
    for key, text in rows:
        words, gone = words_of(text), set()
        for start in range(len(words) - length + 1):
            if first[tuple(words[start : start + length])] < (rank(key), start):
                gone.update(range(start, start + length))
        kept = " ".join(word for i, word in enumerate(words) if i not in gone)
        found.append((key, len(words), len(gone), sha(kept)))
    return sorted(found, key=str)


def digests(frame, **options):
    return sorted(map(tuple, repeats.repeat_digests(frame, **options).collect()), key=str)


def some_documents(rng):
    """Shared passages, copies, periodic texts, NULLs, repeated ids and rows."""
    stock = [[rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randint(15, 60))] for _ in range(6)]
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, "x " * 70), (None, " ".join(stock[0])), (4, "é\x1cü " * 30)]
    for number in range(5, 60):
        parts = [rng.choice(stock) if rng.random() < 0.6 else [f"w{rng.randrange(999)}" for _ in range(20)] for _ in range(3)]
        rows.append((rng.choice([number, number, 7]), rng.choice([" ", "\n", "  "]).join(sum(parts, []))))
    return rows + rows[-4:]


@pytest.mark.parametrize("options", [{}, {"most_windows": 40, "bits": 3}, {"length": 7, "prefix": 3}, {"length": 5, "prefix": 9}])
def test_repeats_against_brute_force(spark, options):
    rows = some_documents(random.Random(1))
    frame = spark.createDataFrame(rows, DOCS).repartition(7)
    assert digests(frame, **options) == brute_repeats(rows, options.get("length", 20))


def test_repeats_of_many_small_pieces(spark):
    """One passage in every document, a few documents in a piece: a group gets a row a piece, and all agree on the first."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"own{i} {passage} tail{i}") for i in range(300)]
    assert digests(spark.createDataFrame(rows, DOCS).repartition(60), most_windows=20) == brute_repeats(rows)


def test_pieces_hold_all_rows_and_little_text(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 100)
    texts = ["x" * (i * 17 % 90) for i in range(50)] + ["y" * 500, None, ""]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts), 0, -1)), pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text_key", "text"]
    )
    pieces = list(repeats._pieces([batch, batch.slice(0, 0)]))
    assert sorted(text or "" for piece in pieces for text in piece["text"].to_pylist()) == sorted(text or "" for text in texts)
    for piece in pieces:
        assert piece.num_rows == 1 or sum(len(text or "") for text in piece["text"].to_pylist()) <= 100
        assert piece["doc_id"].to_pylist() == sorted(piece["doc_id"].to_pylist())


def test_texts_without_repeats_stay_as_they_are(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, f"a\n{passage}", 7, "x"), (2, f"b  {passage}\n c", 7, "y"), (3, None, 7, "z"), (4, " two  blanks ", 7, "w")]
    frame = spark.createDataFrame(rows, DOCS + ", n_chars long, spans string")
    found = repeats.without_repeats(frame)
    assert found.columns == frame.columns
    assert sorted(map(tuple, found.collect())) == [
        (1, f"a\n{passage}", len(passage) + 2, "x"), (2, "b c", 3, "y"), (3, None, None, "z"), (4, " two  blanks ", 13, "w"),
    ]
    assert [tuple(span) for span in repeats.repeated_spans(frame).first()["spans"]] == [(1, 26)]


def test_repeats_of_no_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert repeats.repeat_digests(none).isEmpty() and repeats.without_repeats(none).isEmpty()


def test_a_very_long_text(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 5000, 300_000)]
    text = " ".join(words + words[1000:1100])
    row = repeats.repeat_digests(spark.createDataFrame([(1, text), (2, "short")], DOCS)).orderBy("doc_id").first()
    assert (row["n_words"], row["n_removed"], row["kept_sha256"]) == (300_100, 100, sha(" ".join(words)))


# -- periodic runs ---------------------------------------------------------------------------------------


def brute_runs(words, least=6, turns=4):
    found, n = {}, len(words)
    for period in range(1, n // turns + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            if i > start and i + period - start >= max(least, turns * period):
                found.setdefault((start, i + period), period)
            i += i == start
    return sorted((start, end - start, period) for (start, end), period in found.items())


def periodic_words(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(0, 150))]
    for _ in range(rng.randint(0, 3)):
        if len(words) > 3:
            at, period = rng.randrange(len(words)), rng.randint(1, 12)
            for i in range(at, min(len(words), at + rng.randint(1, 80))):
                words[i] = words[at + (i - at) % period]
    return words


@pytest.mark.parametrize("least, turns", [(6, 4), (2, 4), (12, 5)])
def test_runs_against_brute_force(least, turns):
    rng = random.Random(least)
    for _ in range(150):
        texts = [periodic_words(rng) for _ in range(rng.randint(1, 6))]
        ends = np.cumsum([len(words) for words in texts]).astype(np.int64)
        found = periodic.find_runs(np.array(sum(texts, []), np.int64), ends, least, turns)
        expected = [(i, *run) for i, words in enumerate(texts) for run in brute_runs(words, least, turns)]
        assert list(map(tuple, found.tolist())) == expected, texts


def test_runs_where_hashes_collide(monkeypatch):
    """With sums that find everything equal, only the word by word comparison is left."""
    monkeypatch.setattr(periodic._Text, "equal", lambda self, at, ahead, size: np.ones(len(at), bool))
    words = [1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 9, 4, 4, 4, 4, 4, 4, 4]
    found = {tuple(run) for run in periodic.find_runs(np.array(words), np.array([len(words)])).tolist()}
    assert found >= {(0, 0, 12, 3)} and all(run[1:] in brute_runs(words) for run in found)


def test_grammar_rules_are_what_their_places_say():
    rng = random.Random(2)
    texts = [periodic_words(rng) for _ in range(30)]
    ids, ends = np.array(sum(texts, [])), np.cumsum([len(words) for words in texts])
    repeated = 0
    for left, middle, right, places, rule in periodic._grammar(ids, ends):
        assert (left < middle).all() and (middle < right).all()
        for place, number in zip(places, rule, strict=True):
            size = right[number] - left[number]
            assert np.array_equal(ids[place : place + size], ids[left[number] : right[number]])
        repeated += len(places) > len(left)
    assert repeated > 2


def test_periodic_texts(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "x " * 5), (6, "x " * 6), (7, "so " + "la li lu " * 4 + "end"),
        (7, "x " * 6), (None, "a b " * 4), (8, "a b " * 3 + "a"),
    ]
    frame = spark.createDataFrame(rows, DOCS).withColumn("runs", F.lit("mine"))
    found = frame.select("doc_id", "runs", periodic.periodic_runs(F.col("text")).alias("found")).select("*", "found.n_words")
    got = sorted(
        ((row["doc_id"] or 0, row["n_words"], [tuple(run) for run in row["found"]["runs"]], row["found"]["collapsed"])
         for row in found.collect())
    )
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 2, [], "a b"), (5, 5, [], "x x x x x"), (6, 6, [(0, 6, 1)], "x"),
        (7, 14, [(1, 12, 3)], "so la li lu end"), (7, 6, [(0, 6, 1)], "x"), (0, 8, [(0, 8, 2)], "a b"),
        (8, 7, [], "a b a b a b a"),
    ])
    with pytest.raises(ValueError):
        periodic.periodic_runs(F.col("text"), turns=3)


def test_slices_hold_all_texts(monkeypatch):
    monkeypatch.setattr(periodic, "TEXT_BYTES", 100)
    texts = pa.array(["x" * (i * 17 % 90) for i in range(50)] + ["y" * 500, None, ""])
    slices = list(periodic._sliced(texts))
    assert pa.concat_arrays(slices) == texts and len(slices) > 10
    assert list(map(len, periodic._sliced(texts.slice(0, 0)))) == [0]


def test_long_periodic_texts(spark):
    frame = spark.createDataFrame([(i, "start " + "a b c d e " * (i * 4000) + "end") for i in range(4)], DOCS)
    rows = frame.select("doc_id", periodic.periodic_runs(F.col("text")).alias("f")).orderBy("doc_id").collect()
    assert [[tuple(run) for run in row["f"]["runs"]] for row in rows] == [[], *[[(1, 20_000 * i, 5)] for i in (1, 2, 3)]]


def test_query_of_periodic_runs_against_brute_force(spark, small):
    from zlib import crc32

    found = {row["doc_id"]: tuple(row)[1:] for row in registered()["op13_periodic_runs"](spark, small).collect()}
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(documents)
    checked = 0
    for key, text in documents:
        words = words_of(text)
        h, n = crc32(str(key).encode()), len(words)
        if n > 700:
            continue
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]
        runs = brute_runs(words)
        gone = {i for start, length, period in runs for i in range(start + period, start + length)}
        most = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None,) * 3
        assert found[key] == (
            len(runs), *most, 1000 * most[1] // most[2] if runs else None,
            sha("".join(f"{start},{length},{period}\n" for start, length, period in runs)),
            sha(" ".join(word for i, word in enumerate(words) if i not in gone)),
        )
        checked += bool(runs)
    assert checked > 5
