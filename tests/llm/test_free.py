"""Near duplicates, token files, packing, pages, severity and the pipeline against plain versions."""

import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from candlewick.llm import ans, near, packing, pages, severity, token_files, tokens
from candlewick.llm.phash import PerfectHash
from candlewick.llm.tokens import Encoder

DOCS = "doc_id long, text string"
ODD = ["", None, " a", "a ", "a  b", "x\n\ny", "x\ny z.\nW", "tab\tno\xa0break  wide", "don't 12,5 <|endoftext|> É é", "\x00 \x1c", "é ́x"]


@pytest.mark.parametrize("name, drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_pieces_give_the_ids_of_whole_texts(name, drops):
    own, whole = Encoder(public_tokenizers.path(name), drops), Tokenizer.from_file(public_tokenizers.path(name))
    for _ in range(2):
        got = [ids.tolist() for ids in own.encode(ODD)]
        assert got == [item.ids for item in whole.encode_batch([text or "" for text in ODD], add_special_tokens=False)]


@pytest.mark.parametrize("name, drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_plain_letters_go_straight_to_the_model(name, drops):
    own, whole = Encoder(public_tokenizers.path(name), drops), Tokenizer.from_file(public_tokenizers.path(name))
    rng = np.random.default_rng(3)
    parts = ["a", "B", "éßÿØ", "×", "'", "s", "don't", ",", ".", "!?", " ", " ", "\n", "1", "İ", "\u0301", "中", "-", "_", "<|endoftext|>"]
    odd = ["".join(rng.choice(parts, rng.integers(0, 20))) for _ in range(3_000)]
    texts = ["Invented wordlings, Überall; and élan.\nMore of THEM", "only wordlings again!", *odd]
    expected = [item.ids for item in whole.encode_batch(texts, add_special_tokens=False)]
    passed = []

    class Watched:
        def encode_batch_fast(self, pieces, **options):
            passed.extend(pieces)
            return whole.encode_batch_fast(pieces, **options)

    own.tokenizer = Watched()
    assert [ids.tolist() for ids in own.encode(texts)] == expected
    assert not [piece for piece in passed if re.fullmatch("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+[,.;:!?]*", piece)]


def test_texts_are_encoded_in_runs_of_bounded_size():
    texts = pa.array(["x" * (3 << 20), None, "", "y" * (3 << 20), "z" * (9 << 20), *["a"] * 3_000])
    found = list(tokens.runs(texts))
    assert [start for start, _ in found] == np.cumsum([0, *[count for _, count in found]])[:-1].tolist()
    assert sum(count for _, count in found) == len(texts) and found[:3] == [(0, 3), (3, 1), (4, 1)]
    assert max(count for _, count in found) <= tokens.TEXTS_AT_ONCE
    assert list(tokens.runs(pa.array([], pa.string()))) == [] and list(tokens.runs(texts.slice(1, 2))) == [(0, 2)]


def test_runs_of_other_sizes():
    texts = pa.array(["x" * (3 << 20), None, "y" * (3 << 20), "z" * (9 << 20), *["a"] * 3_000])
    assert list(tokens.runs(texts, token_files.RUN_BYTES, token_files.RUN_TEXTS)) == [(0, 3), (3, 1), (4, 3000)]
    assert list(tokens.runs(texts, 4 << 20, 2)) == [(0, 2), (2, 1), (3, 1), *[(at, 2) for at in range(4, 3004, 2)]]


def test_blocks_round_trip_and_show_damage():
    rng = np.random.default_rng(1)
    tokens = np.minimum(rng.geometric(0.01, 300_000), 40_000)
    values, counts = np.unique(tokens, return_counts=True)
    table = ans.Table.from_counts(values, counts)
    for n in (1, 1023, 1024, 1025, 131_073, 300_000):
        lengths = np.array([n - n // 2, n // 2])
        block = ans.encode_block(table, np.array([5, ans.NO_ID]), lengths, tokens[:n], 77)
        ids, sizes, back, first = ans.decode_block(table, block)
        assert (ids.tolist(), sizes.tolist(), first) == ([5, ans.NO_ID], lengths.tolist(), 77)
        assert (back == tokens[:n]).all()
    entropy = -(counts / 3e5 * np.log2(counts / 3e5)).sum()
    assert len(block) * 8 / 3e5 < entropy * 1.1
    with pytest.raises(ValueError):
        ans.decode_block(table, block[:1000] + bytes([block[1000] ^ 1]) + block[1001:])


def test_tokens_of_many_rows_are_counted_together(monkeypatch):
    rows = [np.array([at % 7, 2], "<u2" if at % 3 else "<u4") for at in range(600)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([ids.tobytes() for ids in rows], pa.binary()), pa.array([2] * len(rows), pa.int64())], names=["ids", "n_tokens"]
    )
    calls, plain = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *given, **named: calls.append(1) or plain(*given, **named))
    found = [row for part in token_files._counted(iter([batch, batch.slice(0, 0)])) for row in zip(*part.to_pydict().values())]
    assert dict(found) == dict(Counter(token for ids in rows for token in ids.tolist()))
    assert len(calls) <= 3


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(2)
    first, second = (rng.integers(0, 2**64, 5000, dtype=np.uint64) for _ in range(2))
    table = PerfectHash.build(first, second)
    assert sorted(table.slots(first, second)) == list(range(5000))
    again = PerfectHash.unpack(table.sizes, table.pack())
    assert (again.slots(first, second) == table.slots(first, second)).all()


def test_token_files_against_the_tokenizer(spark, small, tmp_path):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = [(10_000 + i, text) for i, text in enumerate(ODD)] + [(None, "null id"), (10_000, "again")]
    documents = documents.unionByName(spark.createDataFrame(odd, DOCS))
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write(documents, str(tmp_path / "t"), path)
    got = sorted(((row[0] is not None, row[0] or 0), *row[1:3], bytes(row[3])) for row in token_files.read(spark, str(tmp_path / "t")).collect())
    rows = sorted(((row[0] is not None, row[0] or 0), row[1] or "") for row in documents.collect())
    encoded, at, expected = Tokenizer.from_file(path).encode_batch([row[1] for row in rows], add_special_tokens=False), 0, []
    for (key, _), item in zip(rows, encoded, strict=True):
        ids = np.array([*item.ids, 2], "<u4")
        expected.append((key, at, len(ids), ids.tobytes()))
        at += len(ids)
    assert got == sorted(expected)


def test_tokens_are_checked_without_a_second_worker(spark, tmp_path):
    documents = spark.createDataFrame([(1, "some words"), (2, None), (2, "é")], DOCS)
    token_files.write(documents, str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"))
    found = token_files.read(spark, str(tmp_path / "t")).select("doc_id", "ids", token_files.crc32_of("ids").alias("crc"))
    rows = found.collect()
    assert len(rows) == 3 and all(row.crc == zlib.crc32(row.ids) for row in rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "EvalPython" not in plan


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_components(rows, size=4):
    sets = {i: shingles(text, size) for i, text in rows}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return {i: (len(sets[i]), root[i]) for i in sets}


def test_near_duplicates_against_brute_force(spark, small, monkeypatch):
    rows = [tuple(row) for row in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    # A chain whose ends differ, copies in other case, short, empty and NULL texts.
    words = [f"w{i}" for i in range(60)]
    rows += [(1000 + k, " ".join(words[:5 * 0] + [f"n{k}{j}" if j < k else w for j, w in enumerate(words)])) for k in range(12)]
    rows += [(2000, "A b"), (2001, "a  B"), (2002, ""), (2003, None), (2004, " \n")]
    expected = brute_components(rows)
    frame = spark.createDataFrame(rows + [(None, "A b"), (2000, "A b")], DOCS)
    for each in (near.PAIRS_EACH, 0):
        monkeypatch.setattr(near, "PAIRS_EACH", each)
        got = near.near_duplicates(frame, size=4).collect()
        assert {r[0]: (r[1], r[2]) for r in got if r[0] is not None} == expected
        assert all(r[3] == (r[0] == r[2]) for r in got if r[0] is not None) and len(got) == len(rows) + 2
        assert [tuple(r)[2:] for r in got if r[0] is None] == [(None, True)]


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {row[0]: row[1] for row in near.components(links).collect()} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def first_fit(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        best = min((g for g in gaps if g >= length), default=None)
        if best is not None:
            gaps.remove(best)
        gaps.append((capacity if best is None else best) - length)
    return len(gaps)


def test_packing_is_best_fit_decreasing(spark):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in np.concatenate([rng.integers(1, 101, 300), np.full(200, 7), [100, 1]])]
    frame = spark.createDataFrame([(i // 2, i % 2, n, "x") for i, n in enumerate(lengths)], "doc_id long, piece int, length long, pack_note string")
    rows = packing.packed(frame, 100).toPandas().sort_values(["sequence_id", "offset"])
    assert len(rows) == len(lengths) and rows.sequence_id.nunique() == first_fit(lengths, 100)
    for _, own in rows.groupby("sequence_id"):
        ends = (own.offset + own.length).tolist()
        assert own.offset.tolist() == [0, *ends[:-1]] and ends[-1] <= 100


def test_packed_sequences_hold_the_ids(spark):
    frame = spark.createDataFrame([(1, "alpha beta " * 30), (2, None), (3, "")], DOCS)
    parts = packing.pieces(frame, public_tokenizers.path("word_bpe_49k.json"), capacity=16)
    placed = packing.packed(parts, 16)
    by_sequence = {row[0]: bytes(row[1]) for row in packing.sequences(placed).collect()}
    for row in placed.collect():
        own = by_sequence[row["sequence_id"]][4 * row["offset"] :][: 4 * row["length"]]
        assert own == bytes(row["ids"]) and zlib.crc32(own) == row["ids_crc32"]


PAGE = """<html><head><title>T</title><script>var a="</p><p>no";</script></head><body><header class="top">Site name</header>
<nav><ul><li><a>Home</a><li><a>News</a></ul></nav><div class="cookie-notice"><p>We use cookies, as you know, for good reasons, always.</p></div>
<main><article><h1>Head &amp; title</h1><p>First,  long <b>bold</b> paragraph.<br>It goes on, and on, with more words.<p>Second&nbsp;one, quite
long as well; it has marks.</p><!-- <p>no</p> --><form><p>Mail, please.</p></form></article>
<section id="comments"><p>Nice post, thanks a lot, really, I mean it, very nice post.</p></section></main>
<aside><p>Read more, much more, of this and that, right here, right now.</p></aside><footer>&copy; me</footer><p"""


def test_pages():
    assert pages.main_text(PAGE) == (
        "Head & title\n\nFirst, long bold paragraph. It goes on, and on, with more words.\n\n"
        "Second one, quite long as well; it has marks."
    )
    assert pages.main_text(None) == pages.main_text("") == "" and pages.main_text("bare text") == "bare text"


LONG = "A long sentence, with some marks; it goes on, and on, until the end of the line. " * 12
SHORT = "A last word, and a short one."


@pytest.mark.parametrize("page, blocks", [
    (f"<article><h1>Title</h1><div class=body><p>{LONG}</p></div></article>", ["Title", LONG]),
    (f"<article><div><p>{LONG}</p></div><section><p>{SHORT}</p></section></article>", [LONG, SHORT]),
    (f"<main><article><div><p>{LONG}</p></div></article><section><h2>End</h2><p>{SHORT}</p></section></main>", [LONG, "End", SHORT]),
    (f"<div><h1>Title</h1><section><p>{LONG}</p><p>{LONG}</p></section><p>{SHORT}</p></div>", ["Title", LONG, LONG, SHORT]),
    (f"<div><div><p>{LONG}</p></div><section><p>{SHORT * 4}</p></section></div><footer>No</footer>", [LONG, SHORT * 4]),
    (f"<h1>Title</h1><article><p>{LONG}</p></article><div>All rights reserved.</div>", ["Title", LONG]),
    (f"<h1>Site</h1><article><h1>Title</h1><p>{LONG}</p></article><div>All rights reserved.</div>", ["Title", LONG]),
    (f"<article><p>{LONG}</p></article><section><div><p>{LONG}</p></div></section>", [LONG, LONG]),
])
def test_an_article_comes_out_whole(page, blocks):
    assert pages.main_text(f"<html><body><nav><a>Home</a></nav>{page}</body></html>") == "\n\n".join(block.strip() for block in blocks)


BODY = f"<h1>Title</h1><p>{LONG}</p><p>{SHORT}</p>"
WHOLE = ["Title", LONG, SHORT]
MENU = "<nav><a>Home</a></nav><div class=cookie-notice><p>We use cookies, as you know, for good reasons.</p></div>"
COMMENTS = f"<section id=comments><p>{LONG}</p><p>{LONG}</p></section>"


@pytest.mark.parametrize("page, blocks", [
    (f"<form id=aspnetForm>{MENU}<div>{BODY}</div>{COMMENTS}</form>", WHOLE),
    (f"<form id=aspnetForm><article>{BODY}</article><div class=related><article><p>{SHORT}</p></article></div></form>", WHOLE),
    (f"<div class=top>Site name</div><form><div><p>{LONG}</p></div></form>", ["Site name", LONG]),
    (f"<h1>Title</h1><div class='content left-sidebar'><p>{LONG}</p><p>{SHORT}</p></div>", WHOLE),
    *[(f"{MENU}<div class='{name}'>{BODY}</div>", WHOLE) for name in ("content with-sidebar", "has-sidebar", "no-comments", "sidebar-wrap")],
    *[(f"{MENU}<div class='{name}'><p>{LONG}</p></div><div><p>{LONG}</p></div>", [LONG, LONG]) for name in ("content with-sidebar", "page-no-comments")],
    (f"<div class=entry-header><h1>Title</h1></div><div class=text><p>{LONG}</p><p>{SHORT}</p></div>", WHOLE),
    (f"<article><div class=masthead><h1>Title</h1></div><p>{LONG}</p><p>{SHORT}</p></article>{COMMENTS}", WHOLE),
    # What is beside an article stays out, however long.
    (f"<header class=top><h1>Site</h1></header><article><h2>Title</h2><p>{LONG}</p><p>{SHORT}</p></article>{COMMENTS}", WHOLE),
    (f"{MENU}<div>{BODY}</div>{COMMENTS}<form><p>{SHORT}</p></form>", WHOLE),
    (f"{MENU}<div>{BODY}</div><div class=related><article><p>{SHORT}</p></article></div>", WHOLE),
    (f"<div>{BODY}</div><div style='display:none'><h1>No</h1><p>{LONG * 5}</p></div>", WHOLE),
    ("<nav>Home</nav><footer>&copy; me</footer>", []),
])
def test_furniture_that_holds_the_article_is_none(page, blocks):
    assert pages.main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == "\n\n".join(block.strip() for block in blocks)


def test_a_head_without_an_end():
    head = "<html><head><meta charset=utf-8><title>T</title><script>var a='<p>no'</script><style>p{}</style>"
    assert pages.main_text(f"{head}<article>{BODY}</article>") == "\n\n".join(block.strip() for block in WHOLE)


def test_pages_of_the_table(spark, small):
    from html import unescape

    for row in pages.extracted(spark.read.parquet(f"{small}/pages.parquet")).join(
        spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        article = re.search(r"<article>(.*?)(?:</article>|<[^>]*\Z|\Z)", row["html"], re.DOTALL)[1]
        plain = re.sub(r"</?b>", "", article).replace("<br>", " ")
        blocks = [" ".join(unescape(part).split()) for part in re.split(r"</?(?:p|h1)>", plain)]
        assert row["text"] == "\n\n".join(filter(None, blocks)) and row["n_chars"] == len(row["text"])


def test_severity_on_held_out_labels(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    train, test = (labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0), labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0))
    scored = severity.severity(documents, train)
    rows = scored.withColumnRenamed("toxic", "said").join(test, "doc_id").toPandas()
    toxic = rows[rows.toxic == 1]
    assert (toxic.said).mean() > 0.7 and (rows[rows.toxic == 0].said).mean() < 0.01
    assert toxic.severity.mean() > 5 * rows[rows.toxic == 0].severity.mean() and set(rows.grade) <= {0, 1, 2}


def test_texts_of_the_same_rare_words_are_no_copies(monkeypatch):
    """Different texts count each, one text only once for each label."""
    frequent = "the of and to in a is it that for was on as with be by at this have from " * 3
    texts = [f"{frequent} word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(300)]
    taken = []
    monkeypatch.setattr(severity, "features", lambda text: taken.append(text) or (Counter(), Counter()))
    batch = pa.RecordBatch.from_pydict({"text": [*texts, *texts, None, ""], "toxic": [0] * 602})
    list(severity._fitted([batch]))
    assert sorted(text or "" for text in taken) == sorted([*texts, ""])


def test_severity_without_anything_to_learn(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (None, "idiot")], DOCS)
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {tuple(row)[2:] for row in severity.severity(frame, none).collect()} == {(0, False)}


def test_pipeline_against_its_stages_in_plain_python(spark, small, tmp_path):
    rows, last = spark.read.parquet(f"{small}/documents.parquet"), None
    columns = rows.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {row["doc_id"]: row["text"] for row in rows.collect()} if number < 4 else None
        out = stage(spark, rows, small)
        out.write.parquet(str(tmp_path / str(number)))
        rows, last = spark.read.parquet(str(tmp_path / str(number))), rows
        if number < 4:
            assert rows.columns == columns, name
        if number == 1:
            assert {row["doc_id"] for row in rows.collect()} == set(before)
        if number == 2:
            kept = {i for i, (_, root) in brute_components(list(before.items()), 5).items() if i == root}
            assert {row["doc_id"] for row in rows.collect()} == kept
    assert {row[0] for row in rows.select("doc_id").distinct().collect()} == {row[0] for row in last.select("doc_id").collect()}
    fits = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fits.where("n <> end OR n > 2048").isEmpty()
    total = rows.agg(F.sum("length")).first()[0]
    assert fits.count() <= -(-total // 2048) + 2
    assert corpus_pipeline.run(spark, small).count() == rows.count()


def test_repeated_ids_lose_neither_rows_nor_links(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near_copy, other, third = base.replace("w59", "x"), " ".join(f"o{i}" for i in range(60)), " ".join(f"t{i}" for i in range(60))
    rows = [
        (1, base), (2, near_copy), (3, other), (3, base), (7, third), (7, "Unlike any other text " * 9), (8, third.upper()),
        (9, "alone"), (9, "alone"), (None, "copied twice"), (None, "copied  twice"), (None, base), (10, None), (10, ""), (10, ""),
        (11, other + " more"), (12, "alone now"), (12, "alone  now"),
    ]
    frame = spark.createDataFrame(rows, DOCS).withColumn("doc", F.lit("mine"))
    found = sorted({(row["doc_id"] or 0, row["component_id"] or 0) for row in near.near_duplicates(frame).collect()})
    # 3 has the texts of two groups, so they are one component; 11 is near the other text of 3.
    assert found == [(0, 0), (1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 9), (10, 10), (11, 1), (12, 12)]
    kept = near.keep_one(frame)
    assert kept.columns == frame.columns
    texts = sorted((row["doc_id"] or 0, (row["text"] or "").split()[:1]) for row in kept.collect())
    assert texts == sorted([
        (1, ["w0"]), (3, ["o0"]), (7, ["t0"]), (7, ["Unlike"]), (9, ["alone"]), (0, ["copied"]), (10, []), (10, []), (10, []),
        (12, ["alone"]),
    ])


_SENTENCE = "<p>This is a paragraph, with some text. It goes on; and on, as paragraphs do.</p>"
_NAMES = ("related", "social", "search", "comments", "share", "ads", "menu", "footer", "newsletter", "hidden")
_HARMLESS = (
    '<h2 id="{0}-work">KEPT</h2>', '<h3 class="{0}">KEPT</h3>', '<p title="a {0} gem">KEPT</p>', '<div data-{0}="false">KEPT</div>',
    '<div data-id="{0}-12">KEPT</div>', '<p><a href="/{0}-valley">KEPT</a></p>', '<p><a href="/p?id={0}-12">KEPT</a></p>',
    '<p><a title="{0} class=ad id=menu">KEPT</a></p>', "<p><em id='{0}'>KEPT</em></p>", '<p>see <span class="{0}">KEPT</span></p>',
)


@pytest.mark.parametrize("name", _NAMES)
@pytest.mark.parametrize("piece", [*_HARMLESS, "<p><math><mi>KEPT</mi></math></p>"])
def test_words_in_names_values_and_headings_rule_nothing_out(piece, name):
    page = f"<nav><a href='/'>Home</a></nav><article><h1>Title</h1>{_SENTENCE}{piece.format(name)}{_SENTENCE}</article>"
    assert "KEPT" in pages.main_text(page) and "Home" not in pages.main_text(page)


@pytest.mark.parametrize("piece", [
    '<div class="ad">GONE</div>', "<div hidden>GONE</div>", '<section id="comments">GONE</section>', "<div CLASS=sidebar>GONE</div>",
    '<div style="display: none">GONE</div>', "<div aria-hidden=true>GONE</div>", '<div data-x="1" class="related">GONE</div>',
    "<ul role='menu'><li>GONE</ul>", "<section data-a='>' id=newsletter>GONE</section>",
])
def test_furniture_inside_an_article_still_goes(piece):
    page = f"<article><h1>Title</h1>{_SENTENCE}{piece}{_SENTENCE}</article>"
    assert "GONE" not in pages.main_text(page) and pages.main_text(page).count("paragraph,") == 2


def test_deep_pages_take_time_in_proportion():
    began = time.perf_counter()
    assert "paragraph" in pages.main_text("<div>" * 20_000 + _SENTENCE + "</div>" * 20_000)
    assert pages.main_text("".join(f"<div>part {i}, of it." for i in range(20_000))).count("part") == 20_000
    assert time.perf_counter() - began < 10
