"""Benchmark decontamination: windows of benchmark words, looked up in every window of a document.

A window is 13 consecutive words of an item, or the whole of a shorter item. The hash table of the
windows is sent to all executors (only while their counted number is within a limit; beyond it
Spark joins by a shuffle). It is keyed by the longest word of a window, which is looked up at every
word of a document; the document's window around a word that is found is compared word by word.
Everything runs inside the engine, without Python.

Null and empty texts have no words and no hits. Rows that share an id are told apart by their
text; rows equal in both get the same answer each. An empty benchmark hits nothing. Items without
words have no window. Other columns are ignored, and carried along by ``clean_documents``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.llm.common import same_row, small_side, stored, text_of

WINDOW = 13
#: ASCII digits and lower-case letters, and everything that is not ASCII.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Windows of the benchmark up to which their table is broadcast.
WINDOW_LIMIT = 2_000_000


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower``, which is much faster, does just that where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(lower_ascii(text), F.lit(WORD)).cast("long")


def benchmark_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per different window: len, window (its words), items (the ids as text), seed (its longest word) and offset (where that is)."""
    words = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), words_of(text_of(text_column)).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    at = words.select("item", "words", length.alias("len"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
    cut = at.select("item", "len", F.slice("words", F.col("at"), F.col("len")).alias("window"))
    longest = F.array_max(F.transform("window", lambda w, i: F.struct(F.length(w).alias("length"), (-i).alias("i"), w.alias("word"))))
    return cut.groupBy("len", "window").agg(F.collect_set("item").alias("items")).withColumns({"seed": longest["word"], "offset": -longest["i"]})


def hits(docs: DataFrame, windows: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents with hits: doc_id, _fp, n_hit, items (sorted), spans (pos and len of every hit window)."""
    known = stored(windows)
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    rows = rows.select("doc_id", F.xxhash64("_text").alias("_fp"), words_of(F.col("_text")).alias("words"))
    each = rows.select("doc_id", "_fp", "words", F.posexplode("words").alias("at", "word"))
    side = small_side(known, known.count(), WINDOW_LIMIT)
    pos = F.col("at") - F.col("offset")
    inside = (pos >= 0) & (pos + F.col("len") <= F.size("words"))
    # Written so that Spark looks up by the seed alone and compares the words only where it is found.
    same = F.array_contains(F.array("window"), F.slice("words", F.greatest(pos, F.lit(0)) + 1, F.col("len")))
    found = each.join(side, (F.col("word") == F.col("seed")) & inside & same).select("doc_id", "_fp", pos.alias("pos"), "len", "items")
    spans = found.groupBy("doc_id", "_fp").agg(
        F.collect_set(F.struct("pos", "len")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    return spans.withColumn("n_hit", F.size(covered).cast("long"))


def judge(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, spans, contaminated."""
    found = hits(docs, benchmark_windows(items, text_column="text", window=window), id_column, text_column)
    text = text_of(text_column)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("_fp"), word_count(text).alias("n_words"))
    out = rows.join(found, same_row(rows, found), "left").select(
        rows["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans"
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words")))


def clean_documents(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = hits(docs, benchmark_windows(items, window=window), id_column, text_column)
    text = text_of(text_column)
    # n_words is asked only of documents with a hit.
    bad = found.select(F.col("doc_id").alias("__id"), F.col("_fp").alias("__fp"), F.col("n_hit").alias("__hit"))
    match = docs[id_column].eqNullSafe(bad["__id"]) & (F.xxhash64(text) == bad["__fp"]) & (bad["__hit"] * ONE_IN >= word_count(text))
    return docs.join(bad, match, "left_anti")
