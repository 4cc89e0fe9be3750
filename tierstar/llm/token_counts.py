"""Token counts of a byte-pair vocabulary by merging with a heap and a linked list.

Symbols are characters in a doubly linked list; a heap holds the adjacent pairs that form a piece,
lowest rank first (highest score, then leftmost). Each merge takes one symbol away, so the count
is the initial symbols less the merges; no identifiers are made. A character outside the
vocabulary counts as its UTF-8 bytes.

No piece holds a word mark after another character, so a run of marks and the characters that
follow never merge with what comes before or after; such runs are counted once and remembered in a bounded
table. Where a vocabulary has such pieces, whole texts are merged instead.

Null and empty texts have no tokens. Counting looks at one row at a time, so ids, repeated rows and
other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.llm.common import text_of

MARK = "▁"
#: Runs remembered in one worker at a time, and the longest that is remembered.
REMEMBERED, LONGEST = 300_000, 48


def read_pieces(path: str) -> dict[str, float]:
    """Pieces that can come from merging, with their scores, of a sentencepiece model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    special = lambda i: model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i)
    return {model.IdToPiece(i): model.GetScore(i) for i in range(model.GetPieceSize()) if not special(i)}


class MergeCounter(dict):
    """Run of characters -> number of its tokens, filled as runs are asked for."""

    def __init__(self, pieces: dict[str, float]):
        super().__init__()
        order = {score: rank for rank, score in enumerate(sorted(set(pieces.values()), reverse=True))}
        self.ranks = {piece: order[score] for piece, score in pieces.items()}
        self.single = {p for p in pieces if len(p) == 1}
        in_pieces = set("".join(pieces))
        # A line feed outside every piece is a boundary as well.
        stop = "" if "\n" in in_pieces else "\n"
        whole = any(MARK in p.lstrip(MARK) for p in pieces)
        self.runs = re.compile(r"(?s).+" if whole else f"{MARK}*[^{MARK}{stop}]+|{MARK}+" + ("|\n" if stop else ""))

    def __missing__(self, run: str) -> int:
        n = self.merged(run)
        if len(run) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[run] = n
        return n

    def merged(self, run: str) -> int:
        n, ranks, single = len(run), self.ranks, self.single
        count = sum(1 if c in single else len(c.encode("utf-8", "surrogatepass")) for c in run)
        symbols: list[str] = list(run)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(run[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = right[i] if symbols[i] else n
            if j >= n or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one of the two has been merged since
            symbols[i] += symbols[j]
            symbols[j] = ""
            count -= 1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (r := ranks.get(symbols[i] + symbols[k])) is not None:
                    heappush(heap, (r, i, size + len(symbols[k])))
            h = left[i]
            if h >= 0 and (r := ranks.get(symbols[h] + symbols[i])) is not None:
                heappush(heap, (r, h, size + len(symbols[h])))
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.runs.findall(MARK + text.replace(" ", MARK))))


#: The vocabulary a worker counted with last, and its counter.
_LAST: list = [None, None]


def token_count(docs: DataFrame, pieces: dict[str, float], text_column: str = "text") -> Column:
    """The number of tokens of a text column, as a column of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # What a worker has counted stays with it from task to task.
        if _LAST[0] is not shared.value:
            _LAST[:] = shared.value, MergeCounter(shared.value)
        counter = _LAST[1]
        for batch in batches:
            yield pa.array([counter.count(x.as_py()) for x in batch], pa.int64())

    return count(text_of(text_column))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    text = text_of(text_column)
    counted = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), token_count(docs, read_pieces(model_path), text_column).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
