"""One registered query for each operator, over its whole table with production parameters."""

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm import chat, contamination, lines, near, packing, pages, periodic, quality, repair, repeats, secrets, severity, token_files
from candlewick.llm.text import BLANK, between, fenced, read_table
from candlewick.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
# Conversation -7 holds the template's own marks.
TRICKY = r"\### Assistant: </turn> ok"


def op1_decontaminate(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    judged = contamination.contamination(documents, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op2_quality(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return quality.quality(documents, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def op3_near_duplicates(spark, sf_dir):
    return near.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), size=4)


def op4_token_files(spark, sf_dir):
    path = scratch_folder(spark, "token-files")
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    token_files.write(documents, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path).select(
        "doc_id", "start", "n_tokens", token_files.crc32_of("ids").alias("ids_crc32")
    )


def op5_secrets(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return secrets.secrets(documents, scratch_folder(spark, "ledger"))


def op6_packing(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    parts = packing.pieces(documents, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return packing.packed(parts.drop("ids"))


def op7_pages(spark, sf_dir):
    return pages.extracted(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_chat(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    own = [(-7, turn, role, TRICKY) for turn, role in enumerate(("user", "assistant"))]
    return chat.digests(chat.formatted(turns.unionByName(spark.createDataFrame(own, turns.schema))))


def op9_toxicity(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return severity.severity(documents, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op10_lines(spark, sf_dir):
    return lines.line_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_conversation_repair(spark, sf_dir):
    """Turns are damaged by a hash of their place, then every conversation is repaired; one may have lost all its turns."""
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    place = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fault = F.crc32(F.concat(place[0], F.lit(":"), place[1]).cast("binary")) % 20
    found = repair.repair_digests(repair.damaged(turns, fault)).withColumnRenamed("conv_id", "found_id")
    every = turns.select("conv_id").distinct()
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    return rows.fillna(0).fillna({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}).select(
        "conv_id", *[name for name in rows.columns if name != "conv_id"]
    )


def op12_substrings(spark, sf_dir):
    return repeats.repeat_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_periodic_runs(spark, sf_dir):
    """Every tenth text, by a hash of its id, is made periodic from some word on; then the runs are looked for."""
    documents = read_table(spark, sf_dir, "documents", "doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, between(F.col("text"), BLANK))
    rows = fenced(documents, "words", words).withColumns({"n": F.size("words"), "g": F.floor(h / 10)})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)"))
    turned = F.expr("array_join(transform(words, (word, i) -> if(i >= a, words[a + (i - a) % p], word)), ' ')")
    made = fenced(rows, "made", F.when(F.col("n") > 0, turned).otherwise(F.col("text")))
    found = fenced(made, "found", periodic.periodic_runs(F.col("made")))
    return found.select("doc_id", *periodic.run_digests(F.col("found")))


def registered() -> dict[str, Query]:
    found = (
        op1_decontaminate, op2_quality, op3_near_duplicates, op4_token_files, op5_secrets, op6_packing,
        op7_pages, op8_chat, op9_toxicity, op10_lines, op11_conversation_repair,
        op12_substrings, op13_periodic_runs,
    )
    return {query.__name__: query for query in found}
