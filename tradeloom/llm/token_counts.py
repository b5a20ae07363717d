"""Token counts of a byte-pair vocabulary by heap and linked list, without making any ids.

A segment's characters form a linked list. A heap holds the adjacent pairs that the vocabulary joins, best
rank and leftmost first; the top pair is merged and its new neighbours enter the heap. The number of tokens
is the number of first symbols minus the merges; a character outside the vocabulary counts as its UTF-8
bytes. Segments are cut where no piece of the vocabulary can reach across, and their counts are kept.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import small_batches, text_of

#: The sign that stands for a blank in the pieces.
BLANK = "▁"
#: Segments whose counts a Python worker keeps in each of two generations; what is used again moves to the younger.
CACHE_SEGMENTS = 200_000
_SEGMENT = re.compile(r" *[^ \n]+|\n| +")


class PieceCounter:
    """Counts tokens as the library's byte-pair model of this file gives them, without added tokens."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [
            (-model.get_score(i), model.id_to_piece(i))
            for i in range(len(model))
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        order = sorted({score for score, _ in pieces})
        rank = {score: i for i, score in enumerate(order)}
        self.ranks = {piece: rank[score] for score, piece in pieces}
        self.counts: dict[str, int] = {}
        self.old_counts: dict[str, int] = {}
        # Blanks open a piece or fill it, and no piece holds a line end: segments are independent.
        self.separable = not any("\n" in p or BLANK in p.lstrip(BLANK) for p in self.ranks)

    def count(self, text: str) -> int:
        if not text:
            return 0
        # The model puts one blank before every text.
        text = " " + text.replace(BLANK, " ")
        segments = _SEGMENT.findall(text) if self.separable else [text]
        counts = self.counts
        try:
            return sum([counts[s] for s in segments])
        except KeyError:
            pass
        total = 0
        for segment in segments:
            n = counts.get(segment)
            if n is None:
                n = self.old_counts.get(segment)
                if n is None:
                    n = self.merged(segment.replace(" ", BLANK))
                if len(segment) <= 64:
                    if len(counts) >= CACHE_SEGMENTS:
                        self.old_counts, counts = counts, {}
                        self.counts = counts
                    counts[segment] = n
            total += n
        return total

    def merged(self, text: str) -> int:
        """First symbols minus merges."""
        ranks = self.ranks
        symbols: list[str | None] = list(text)
        n = len(symbols)
        total = n
        for symbol in symbols:
            if symbol not in ranks:
                total += len(symbol.encode("utf-8", "replace")) - 1
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i] + symbols[i + 1])
            if rank is not None:
                heap.append((rank, i, symbols[i] + symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, left, piece = heapq.heappop(heap)
            first = symbols[left]
            if first is None:
                continue
            right = after[left]
            # An entry is stale once one of its two symbols has been merged away or has grown.
            if right >= n or first + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, None
            total -= 1
            far = after[right]
            after[left] = far
            if far < n:
                before[far] = left
                rank = ranks.get(piece + symbols[far])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, piece + symbols[far]))
            near = before[left]
            if near >= 0:
                rank = ranks.get(symbols[near] + piece)
                if rank is not None:
                    heapq.heappush(heap, (rank, near, symbols[near] + piece))
        return total


_counters: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """One per Python worker, kept between tasks."""
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path]


def _count(path: str):
    def run(batches):
        count = counter(path).count
        for batch in small_batches(batches):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64()),
                    pa.array([count(t) for t in texts], pa.int64()),
                ],
                names=["id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame, model_path: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Null and empty texts have no bytes and no tokens. Rows are independent of each other, so repeated rows,
    null ids and an empty table need no rule. A text of any length is counted whole.
    """
    source = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    counted = source.mapInArrow(_count(model_path), f"id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
