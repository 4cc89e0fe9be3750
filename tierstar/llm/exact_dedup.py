"""Exact dedup by progressive refinement: length, then a hash of the head, then a hash of the whole.

Each step keeps only the groups of two rows or more that the step before left, so the whole text
is hashed only for texts that agree in length and head. Groups are counted with partial sums, so
a text that a third of all rows hold costs one row for each task.

Null texts count as empty, and empty texts are equal to each other. Rows that repeat both id and
text count as copies of the same row: all of them are marked kept, and ``keep_one`` leaves one.
An empty table gives an empty result; other columns are ignored here and carried by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.llm.common import small_side, stored, text_of

HEAD_CHARS = 256


def _measured(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = text_of(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"), F.octet_length(text).alias("_len"), F.xxhash64(F.substring(text, 1, HEAD_CHARS)).alias("_head"), text.alias("_text")
    )


def whole_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def copy_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, int]:
    """Texts held by two rows or more: (_len, _head, text_sha256, keep_id, group_size), and their number."""
    rows = _measured(docs, id_column, text_column)
    many = F.col("_n") > 1
    lengths = stored(rows.groupBy("_len").agg(F.count(F.lit(1)).alias("_n")).filter(many).select("_len"))
    same_length = rows.join(small_side(lengths, lengths.count()), "_len")
    heads = stored(same_length.groupBy("_len", "_head").agg(F.count(F.lit(1)).alias("_n")).filter(many).select("_len", "_head"))
    same_head = rows.join(small_side(heads, heads.count()), ["_len", "_head"])
    whole = same_head.groupBy("_len", "_head", whole_hash(F.col("_text")).alias("text_sha256"))
    groups = stored(whole.agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).filter(F.col("group_size") > 1))
    return groups, groups.count()


def mark_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    groups, n = copy_groups(docs, id_column, text_column)
    rows = _measured(docs, id_column, text_column).select("doc_id", "_len", "_head", whole_hash(F.col("_text")).alias("text_sha256"))
    found = rows.join(small_side(groups, n), ["_len", "_head", "text_sha256"], "left")
    # A group without any id keeps all its rows: none of them is the largest.
    keep_id = F.coalesce("keep_id", "doc_id")
    return found.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all columns as they came, with one row left of each group of equal texts."""
    groups, n = copy_groups(docs, id_column, text_column)
    text, names = text_of(text_column), docs.columns
    keyed = docs.withColumns({"__len": F.octet_length(text), "__head": F.xxhash64(F.substring(text, 1, HEAD_CHARS))})
    side = small_side(groups.select(F.col("_len").alias("__len"), F.col("_head").alias("__head"), F.col("text_sha256").alias("__sha"), F.col("keep_id").alias("__keep")), n)
    match = (keyed["__len"] == side["__len"]) & (keyed["__head"] == side["__head"]) & (whole_hash(text) == side["__sha"])
    found = keyed.join(side, match, "left").select(*[docs[c] for c in names], side["__sha"], side["__keep"])
    left = found.filter(F.col("__sha").isNull() | F.col(id_column).eqNullSafe(F.col("__keep")))
    # Only rows kept of a group can repeat; the others do not pass through the shuffle below.
    once = left.filter(F.col("__sha").isNull()).select(*names)
    return once.unionByName(left.filter(F.col("__sha").isNotNull()).dropDuplicates(["__sha"]).select(*names))
