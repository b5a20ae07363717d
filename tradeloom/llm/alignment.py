"""Alignment of the tokens of two vocabularies by interval coalescing.

Both tokenizers cut the same bytes. The tokens of both are intervals of bytes, sorted together by start; the
running maximum of their ends tells how far the tokens so far reach, and where a start has come to it a new
group begins. Within a group every pair of overlapping tokens is a link. How many documents hold a pair of ids
linked is counted over the whole corpus, and each document's links are then rated by these counts.

Long texts are cut before single blanks that neither tokenizer reaches across, so a task holds a part at a time.
Pairs that many documents hold, a bounded number, are sent to all tasks; all others meet their counts in a join,
so no common pair ever makes a large group.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import small_batches, text_of, written

#: The sign that stands for a blank in the pieces.
BLANK = "▁"
#: Characters of a text that are encoded at once; longer texts are cut where neither tokenizer reaches across.
PART = 1 << 20
#: Tokens of A gathered before they are aligned together.
FLUSH_TOKENS = 1 << 18
#: Pairs whose counts are sent to all tasks, at 13 bytes each; the others are joined.
HOT_PAIRS = 1 << 20
#: Pairs gathered before a task hands on its counts.
FLUSH_PAIRS = 4 << 20

#: Segments whose ids a Python worker keeps in each of two generations; what is used again moves to the younger.
CACHE_SEGMENTS = 100_000
#: Segments that are encoded as one text.
LEARNED = 2048

#: A place before a single blank and a sign that is surely no white space, and what lies between such places.
_SEGMENT = re.compile(r" +[^ ]*(?:(?: {2,}| (?![!-~\w]))[^ ]*)*")
_CUT = re.compile(r"(?<=[^ ])(?= [!-~\w])")


# --- tokens ---------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the bytes: the printable ones, then those from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return {chr(b) if b in shown else chr(next(hidden)): b for b in range(256)}


#: Ids of both tokenizers, as little-endian 32-bit numbers.
Ids = tuple[bytes, bytes]


class TokenPair:
    """Ids of both tokenizers for segments of a text, and how many bytes each id stands for."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters, a_bytes = byte_letters(), {}
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            plain = all(c in letters for c in token)
            a_bytes[number] = bytes(letters[c] for c in token) if plain else token.encode()
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        self.b_bytes = [self._piece(i) for i in range(len(self.b))]
        self.a_length = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        # Neither cuts differently at a blank before a word if blanks only ever lead a piece or a word.
        pre = (json.loads(self.a.to_str()).get("pre_tokenizer") or {}).get("type")
        joined = any(BLANK in self.b.id_to_piece(i).lstrip(BLANK) for i in range(len(self.b)))
        self.separable = pre == "ByteLevel" and not joined
        self.known: dict[str, Ids | None] = {}
        self.old: dict[str, Ids | None] = {}

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(BLANK, " ").encode()

    def parts(self, text: str):
        """A blank and the text, in parts that neither tokenizer reaches across."""
        text, at = " " + text, 0
        while self.separable and len(text) - at > PART and (cut := _CUT.search(text, at + PART)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def ids(self, part: str) -> list[Ids | None]:
        """Per segment of a part, which starts with a blank, the ids of both; None where the bytes differ."""
        segments = _SEGMENT.findall(part) if self.separable else [part]
        known = self.known
        missing = {s for s in segments if s not in known}
        if not missing:
            return [known[s] for s in segments]
        if len(known) + len(missing) > CACHE_SEGMENTS:
            self.old, self.known, known = known, {}, {}
            missing = set(segments)
        found = {s: self.old[s] for s in missing if s in self.old}
        new = [s for s in missing if s not in found]
        for start in range(0, len(new), LEARNED):
            self._learn(new[start : start + LEARNED], found)
        self.known.update((s, ids) for s, ids in found.items() if len(s) <= 64)
        return [found[s] if s in found else known[s] for s in segments]

    def _learn(self, segments: list[str], found: dict[str, Ids | None]) -> None:
        """Encode segments as one text, and apart where that does not cut between them.

        The next segment's blanks would join those at the end of a segment, so these are left to themselves.
        """
        together = [s for s in segments if self.separable and s[-1] != " " and BLANK not in s]
        a, b = self._encoded("".join(together)) if together else ([], [])
        if together and self._spell("".join(together).encode(), a, b):
            ends = np.cumsum([len(s.encode()) for s in together])
            a_at, b_at = (
                np.searchsorted(np.cumsum(lengths[ids]), ends) + 1
                for lengths, ids in ((self.a_length, a), (self.b_length, b))
            )
            a, b = np.array(a, "<u4"), np.array(b, "<u4")
            meet = (np.cumsum(self.a_length[a])[a_at - 1] == ends) & (np.cumsum(self.b_length[b])[b_at - 1] == ends)
            if meet.all():
                a, b, a_from, b_from = a.tobytes(), b.tobytes(), 0, 0
                for segment, a_to, b_to in zip(together, (4 * a_at).tolist(), (4 * b_at).tolist()):
                    found[segment] = a[a_from:a_to], b[b_from:b_to]
                    a_from, b_from = a_to, b_to
        for segment in segments:
            if segment not in found:
                a, b = self._encoded(segment)
                same = self._spell(segment.encode(), a, b)
                found[segment] = (np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()) if same else None

    def _encoded(self, text: str) -> tuple[list[int], list[int]]:
        # The second tokenizer puts the first blank itself.
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])

    def _spell(self, body: bytes, a: list[int], b: list[int]) -> bool:
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        return b"".join([a_bytes[i] for i in a]) == body and b"".join([b_bytes[i] for i in b]) == body


_pairs: dict[tuple[str, str], TokenPair] = {}


def token_pair(byte_level: str, pieces: str) -> TokenPair:
    """One per Python worker, kept between tasks."""
    if (byte_level, pieces) not in _pairs:
        _pairs[byte_level, pieces] = TokenPair(byte_level, pieces)
    return _pairs[byte_level, pieces]


# --- groups and links -----------------------------------------------------------------------


def coalesce(a_length: np.ndarray, b_length: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups of A's and of B's tokens, and the links as places in A and in B. Both tile the same bytes."""
    a_end, b_end = np.cumsum(a_length), np.cumsum(b_length)
    a_start, b_start = a_end - a_length, b_end - b_length
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((np.arange(len(start)) >= len(a_start), start))
    reached = np.maximum.accumulate(end[order])
    number = np.zeros(len(start), dtype=np.int64)
    number[order[1:]] = np.cumsum(start[order][1:] >= reached[:-1])
    a_group, b_group = number[: len(a_start)], number[len(a_start) :]
    # Tokens of B that end after a token of A starts and start before it ends lie in its group.
    first = np.searchsorted(b_end, a_start, side="right")
    n = np.searchsorted(b_start, a_end, side="left") - first
    a_place = np.repeat(np.arange(len(a_start)), n)
    within = np.arange(len(a_place)) - np.repeat(np.cumsum(n) - n, n)
    return a_group, b_group, a_place, np.repeat(first, n) + within


class GroupText:
    """Groups written as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a_size: int, b_size: int):
        self.a_size, self.b_size = a_size, b_size
        signs = [(a_size, b","), (a_size, b"|"), (b_size, b","), (b_size, b";")]
        self.words = [b"%d%s" % (i, sign) for size, sign in signs for i in range(size)]

    def codes(self, a, b, a_group, b_group) -> np.ndarray:
        """The words of all groups in order, each token with the sign that follows it."""
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        a_last, b_last = (np.append(g[1:] != g[:-1], True) for g in (a_group, b_group))
        codes[np.arange(len(a)) + np.searchsorted(b_group, a_group, side="left")] = a + self.a_size * a_last
        at = np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")
        codes[at] = 2 * self.a_size + b + self.b_size * b_last
        return codes

    def text(self, codes: np.ndarray) -> bytes:
        words = self.words
        return b"".join([words[c] for c in codes.tolist()])[:-1]


_texts: dict[tuple[int, int], GroupText] = {}


class Aligned:
    """Results of the documents of one batch, gathered part by part."""

    def __init__(self, tokens: TokenPair, size: int):
        self.tokens = tokens
        shape = len(tokens.a_bytes), len(tokens.b_bytes)
        if shape not in _texts:
            _texts[shape] = GroupText(*shape)
        self.writer = _texts[shape]
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(size, dtype=np.int64) for _ in range(4))
        self.hashes: list = [None] * size
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self._clear()

    def _clear(self):
        self.docs, self.a, self.b, self.held = [], [], [], 0

    def add(self, doc: int, segments: list[Ids]) -> None:
        self.docs.append(doc)
        self.a.append(b"".join([s[0] for s in segments]))
        self.b.append(b"".join([s[1] for s in segments]))
        self.held += len(self.a[-1]) // 4
        if self.held >= FLUSH_TOKENS:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        docs = np.array(self.docs)
        a_count, b_count = (np.array([len(x) // 4 for x in side]) for side in (self.a, self.b))
        a, b = (np.frombuffer(b"".join(side), dtype="<u4").astype(np.int64) for side in (self.a, self.b))
        a_group, b_group, a_place, b_place = coalesce(self.tokens.a_length[a], self.tokens.b_length[b])
        owner = np.repeat(docs, a_count)
        size = len(self.n_a)
        opens = np.append(True, a_group[1:] != a_group[:-1])
        np.add.at(self.n_a, docs, a_count)
        np.add.at(self.n_b, docs, b_count)
        self.n_groups += np.bincount(owner[opens], minlength=size)
        self.n_links += np.bincount(owner[a_place], minlength=size)
        codes, at = self.writer.codes(a, b, a_group, b_group), 0
        for doc, n in zip(self.docs, (a_count + b_count).tolist()):
            text = self.writer.text(codes[at : at + n])
            at += n
            if self.hashes[doc] is None:
                self.hashes[doc] = hashlib.sha256(text)
            else:
                self.hashes[doc].update(b";" + text)
        key = (owner[a_place] << 40) | (a[a_place] << 20) | b[b_place]
        keys, times = np.unique(key, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self._clear()

    def columns(self) -> list[pa.Array]:
        self.flush()
        size = len(self.n_a)
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        times = np.concatenate([np.zeros(0, np.int64), *self.times])
        if len(self.keys) > 1:
            keys, place = np.unique(keys, return_inverse=True)
            times = np.bincount(place, weights=times).astype(np.int64)
        ends = np.searchsorted(keys, np.arange(1, size + 1) << 40)
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        pairs = (keys & ((1 << 40) - 1)).astype(np.int64)
        digests = [h.hexdigest() if h is not None else "" for h in self.hashes]
        return [
            *[pa.array(n) for n in (self.n_a, self.n_b, self.n_groups, self.n_links)],
            pa.array(digests),
            pa.ListArray.from_arrays(offsets, pa.array((pairs >> 20).astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array((pairs & 0xFFFFF).astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
        ]


_ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a_ids", "b_ids", "times"]


def _align(byte_level: str, pieces: str):
    def run(batches):
        tokens = token_pair(byte_level, pieces)
        for batch in small_batches(batches, 256):
            done = Aligned(tokens, batch.num_rows)
            for i, text in enumerate(batch.column("text").to_pylist()):
                if 0 < len(text) <= PART:
                    segments = tokens.ids(" " + text)
                    if None not in segments:
                        done.add(i, segments)
                # A long text is read twice, as its last part may show that the tokenizers see other bytes.
                elif text and all(None not in tokens.ids(part) for part in tokens.parts(text)):
                    for part in tokens.parts(text):
                        done.add(i, tokens.ids(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), *done.columns()], names=["row", "id", *_ALIGNED]
            )

    return run


# --- counts over the corpus -----------------------------------------------------------------


def _flat(batch, *names) -> list[np.ndarray]:
    """Elements of list columns, whose rows may start anywhere in their buffers."""
    return [batch.column(name).flatten().to_numpy() for name in names]


def _pair_counts(batches):
    """(pair, n): in how many documents a pair is linked; a row holds each of its pairs once."""
    held, size = [], 0

    def counted():
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    for batch in small_batches(batches):
        a, b = _flat(batch, "a_ids", "b_ids")
        held.append((a.astype(np.int64) << 20) | b)
        size += len(a)
        if size >= FLUSH_PAIRS:
            yield counted()
            held, size = [], 0
    if held:
        yield counted()


def _rated(hot):
    """n_best and count_sum from the common pairs."""

    def run(batches):
        pairs, counts, best = hot.value
        for batch in small_batches(batches):
            at, there, owner, times = _found(batch, pairs)
            size = batch.num_rows
            weight = np.where(there, times, 0)
            n_best = np.bincount(owner, weights=weight * best[at], minlength=size) if len(pairs) else np.zeros(size)
            # Whole numbers: sums of counts may be larger than doubles can tell apart.
            total = np.zeros(size, dtype=np.int64)
            if len(pairs):
                np.add.at(total, owner, weight * counts[at])
            kept = batch.select(["row", "id", *_ALIGNED[:5]])
            kept = kept.append_column("n_best", pa.array(n_best.astype(np.int64)))
            yield kept.append_column("count_sum", pa.array(total))

    return run


def _uncommon(hot):
    """(row, pair, times) of all pairs that were not sent along."""

    def run(batches):
        pairs = hot.value[0]
        for batch in small_batches(batches):
            _, there, owner, times = _found(batch, pairs)
            a, b = _flat(batch, "a_ids", "b_ids")
            rows = batch.column("row").to_numpy()[owner][~there]
            pair = ((a.astype(np.int64) << 20) | b)[~there]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(pair), pa.array(times[~there])], names=["row", "pair", "times"]
            )

    return run


def _found(batch, pairs: np.ndarray):
    """Places of a batch's pairs among the common ones, whether they are there, their rows and how often they occur."""
    a, b, times = _flat(batch, "a_ids", "b_ids", "times")
    mine = (a.astype(np.int64) << 20) | b
    lengths = np.diff(batch.column("times").offsets.to_numpy())
    owner = np.repeat(np.arange(batch.num_rows), lengths)
    at = np.searchsorted(pairs, mine)
    at[at == len(pairs)] = 0
    there = pairs[at] == mine if len(pairs) else np.zeros(len(mine), dtype=bool)
    return at, there, owner, times.astype(np.int64)


def align(
    docs: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A null or empty text, and one whose tokens do not spell a blank and the text in both vocabularies, has no
    tokens: zeros and an empty digest. Rows are documents: repeated rows count as often as they come, and null
    ids stay null. Ties for the highest count of an id of A are all best. An empty table gives no rows. Texts of
    any length are aligned whole, part by part.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), text_of(text_column).alias("text")
    )
    id_type = source.schema["id"].dataType.simpleString()
    numbers = f"row bigint, id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    lists = "a_ids array<int>, b_ids array<int>, times array<int>"
    aligned = written(source.mapInArrow(_align(byte_level_path, pieces_path), f"{numbers}, {lists}"), "aligned")

    counted = aligned.select("a_ids", "b_ids").mapInArrow(_pair_counts, "pair bigint, n bigint")
    counted = written(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    # As many rows as A has ids, whatever the corpus.
    a_id = F.shiftright("pair", 20).alias("a_id")
    highest = counted.groupBy(a_id).agg(F.max("n").alias("highest"))
    rated = counted.withColumn("a_id", a_id).join(F.broadcast(highest), "a_id")
    rated = rated.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))

    # Steps of a fourth of a doubling: a few hundred rows.
    step = F.floor(F.log2("n") * 4)
    steps = rated.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    least, taken = None, 0
    for row in sorted(steps, key=lambda r: -r.step):
        taken += row.pairs
        if taken > hot_pairs:
            break
        least = row.least
    common = rated.filter(F.col("n") >= (least if least is not None else F.lit(None))).toArrow()
    pairs = common.column("pair").to_numpy()
    order = np.argsort(pairs)
    hot = spark.sparkContext.broadcast(
        (pairs[order], common.column("n").to_numpy()[order], common.column("best").to_numpy()[order])
    )
    result = aligned.mapInArrow(_rated(hot), f"{numbers}, n_best bigint, count_sum bigint")
    if taken > len(pairs):
        rest = aligned.select("row", "a_ids", "b_ids", "times")
        rest = rest.mapInArrow(_uncommon(hot), "row bigint, pair bigint, times bigint")
        rest = rest.join(rated.filter(F.col("n") < least) if least is not None else rated, "pair")
        rest = rest.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
        result = result.join(rest, "row", "left").withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
            }
        )
    return result.select(
        F.col("id").alias(id_column),
        *[c for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")],
    )
