"""Best-fit packing of token pieces by exact complements.

Only the number of pieces per length counts for the plan, at most 4096 numbers at any scale. Longest
length first, the gap it leaves is looked up among single lengths, then sums of two, then of three; the
combination found is used as often as its lengths last. What finds no exact complement is packed best fit,
longest first. A piece then takes the place that its rank among pieces of its length has in the plan.
"""

from __future__ import annotations

import os
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import small_batches, text_of, written

SEQUENCE = 4096
#: Pieces of one length that are ranked in one task.
RANKED = 100_000
#: Words whose ids a Python worker keeps in each of two generations; what is used again moves to the younger.
CACHE_WORDS = 200_000


# --- tokens ---------------------------------------------------------------------------------


#: A word of plain letters, then maybe ASCII signs other than the apostrophe, which may start a token of its own.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordTokenizer:
    """Ids of texts by a tokenizer that never joins across blanks or line ends, word by word from a cache.

    The tokenizer splits a plain word into its letters and its signs and lower-cases it; these parts go
    straight to its merge model, whose ids are kept per part. All other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        known = self.words
        split = text.replace("\n", " ").split(" ")
        missing = {w for w in split if w not in known}
        if missing:
            if len(known) + len(missing) > CACHE_WORDS:
                self.old_words, self.words, known = known, {}, None
                missing = set(split)
            self._learn(missing)
            known = self.words
        return b"".join([known[w] for w in split])

    def _learn(self, words: set[str]) -> None:
        rest, known, old = [], self.words, self.old_words
        for word in words:
            ids = old.get(word)
            if ids is None:
                plain = _PLAIN.fullmatch(word)
                if plain is None:
                    rest.append(word)
                    continue
                letters, signs = plain.groups()
                ids = self._part(letters.lower())
                if signs:
                    ids += self._part(signs)
            known[word] = ids
        for start in range(0, len(rest), 4096):
            part = rest[start : start + 4096]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.words[word] = np.array(found.ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is not None:
            return ids
        ids = self.old_parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        if len(self.parts) >= CACHE_WORDS:
            self.old_parts, self.parts = self.parts, {}
        self.parts[part] = ids
        return ids


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, kept between tasks."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _pieces(path: str, end_id: int, length: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        tokenizer = word_tokenizer(path)
        for batch in small_batches(batches):
            at, numbers, starts, lengths, crcs = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = tokenizer.ids(text) + end
                for number, start in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[start : start + 4 * length]
                    at.append(i)
                    numbers.append(number)
                    starts.append(start // 4)
                    lengths.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(at, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    return run


# --- the plan -------------------------------------------------------------------------------


@dataclass
class Plan:
    """``patterns``: (lengths in one sequence, number of such sequences)."""

    patterns: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    def slots(self) -> tuple[np.ndarray, ...]:
        """Per slot: length, first rank, first sequence, offset; sorted by length and rank."""
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        for lengths, times in self.patterns:
            offset = 0
            for length in lengths:
                rows.append((length, taken.get(length, 0), sequence, offset))
                taken[length] = taken.get(length, 0) + times
                offset += length
            sequence += times
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
        return tuple(table.T)


def _exact(counts: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One to three available lengths that add up to the gap; repeats need as many pieces."""
    if gap <= 0:
        return None
    if counts[gap]:
        return (gap,)
    pair = _pair(counts, gap)
    if pair:
        return pair
    for third in np.flatnonzero(counts[: gap - 1])[::-1].tolist():
        counts[third] -= 1
        rest = _pair(counts, gap - third)
        counts[third] += 1
        if rest:
            return (third, *rest)
    return None


def _pair(counts: np.ndarray, gap: int) -> tuple[int, int] | None:
    """The available pair with this sum that lasts longest."""
    half = gap // 2
    if half < 1:
        return None
    low = counts[1 : half + 1]
    high = counts[gap - half : gap][::-1]
    lasts = np.minimum(low, high)
    if gap % 2 == 0:
        lasts[-1] = low[-1] // 2
    best = int(lasts.argmax())
    return (gap - best - 1, best + 1) if lasts[best] else None


def plan(lengths: dict[int, int], size: int = SEQUENCE) -> Plan:
    """Patterns that place every piece. ``lengths``: number of pieces per length."""
    counts = np.zeros(size + 1, dtype=np.int64)
    for length, n in lengths.items():
        counts[length] = n
    result = Plan()
    residual: list[tuple[int, int]] = []
    for length in range(size, 0, -1):
        while counts[length]:
            counts[length] -= 1
            fill = _exact(counts, size - length) if length < size else ()
            counts[length] += 1
            if fill is None:
                residual.append((length, int(counts[length])))
                counts[length] = 0
                break
            used = (length, *fill)
            times = min(int(counts[u]) // used.count(u) for u in used)
            for u in used:
                counts[u] -= times
            result.patterns.append((used, times))

    # Best fit, longest first: per gap the groups of sequences that have it.
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length, left in residual:
        for gap in sorted(g for g in gaps if g >= length):
            while left and gaps.get(gap):
                used, n = gaps[gap].pop()
                fits = gap // length
                whole, rest = min(n, left // fits), 0
                if whole:
                    gaps.setdefault(gap - fits * length, []).append((used + (length,) * fits, whole))
                left -= whole * fits
                if whole < n and left:
                    rest = left
                    gaps.setdefault(gap - rest * length, []).append((used + (length,) * rest, 1))
                    left = 0
                if n - whole - bool(rest):
                    gaps.setdefault(gap, []).append((used, n - whole - bool(rest)))
            if not left:
                break
        fits = size // length
        if left // fits:
            gaps.setdefault(size - fits * length, []).append(((length,) * fits, left // fits))
        if left % fits:
            gaps.setdefault(size - left % fits * length, []).append(((length,) * (left % fits), 1))
    result.patterns += [group for gap in sorted(gaps) for group in gaps[gap]]
    return result


# --- the operator ---------------------------------------------------------------------------


def _place(slots, offsets):
    length, rank, sequence, offset = slots
    keys = length << 44 | rank

    def run(batches):
        for batch in batches:
            mine = batch.column("length").to_numpy()
            salt, local = batch.column("salt").to_numpy(), batch.column("local").to_numpy()
            base = np.array([offsets[k] for k in zip(mine.tolist(), salt.tolist())], dtype=np.int64)
            at = base + local - 1
            slot = np.searchsorted(keys, mine << 44 | at, side="right") - 1
            placed = batch.select(["id", "piece", "start", "length", "ids_crc32"])
            yield placed.append_column(
                "sequence_id", pa.array(sequence[slot] + at - rank[slot])
            ).append_column("offset", pa.array(offset[slot]))

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its tokens and ``end_id``; one longer than a sequence is cut into whole sequences and a
    rest. A null or empty text is the end id alone. Repeated rows are packed as often as they come. Reruns
    place pieces alike, up to equal ones. An empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    columns = f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = written(source.mapInArrow(_pieces(tokenizer_path, end_id, SEQUENCE), columns), "pieces")

    # At most 4096 rows, whatever the input.
    lengths = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not lengths:
        nowhere = F.lit(0).cast("bigint")
        return pieces.select(
            F.col("id").alias(id_column),
            *pieces.columns[1:],
            nowhere.alias("sequence_id"),
            nowhere.alias("offset"),
        )
    salts = {length: -(-n // RANKED) for length, n in lengths.items() if n > RANKED}
    parts = F.lit(1)
    if salts:
        parts = F.coalesce(F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])[F.col("length")], F.lit(1))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), parts).cast("bigint"))
    # One row per length and 100,000 pieces.
    offsets, taken = {}, {}
    for row in salted.groupBy("length", "salt").agg(F.count("*").alias("n")).sort("length", "salt").collect():
        offsets[row.length, row.salt] = taken.get(row.length, 0)
        taken[row.length] = taken.get(row.length, 0) + row.n
    place = spark.sparkContext.broadcast((plan(lengths).slots(), offsets))

    def run(batches):
        return _place(*place.value)(batches)

    order = Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32")
    ranked = salted.withColumn("local", F.row_number().over(order).cast("bigint"))
    placed = ranked.mapInArrow(run, f"{columns}, sequence_id bigint, offset bigint")
    return placed.withColumnRenamed("id", id_column)
