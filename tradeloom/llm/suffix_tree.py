"""Language-model scores by a probabilistic suffix tree over words.

A node of the tree is a context, a suffix of the words before a word, of variable length. Candidates are all
contexts that occur at least ``MIN_COUNT`` times, at every size of the input; so are the (context, word) pairs a
node keeps. All words below that count share one class. A node's distribution is smoothed by absolute
discounting towards its parent, the context without its first word, down to the root, the discounted counts of all
words with one place for unknown ones. A candidate is retained if the divergence of its counts from its
parent's prediction, weighted by its count, is worth the pairs it keeps. A word is predicted by the longest
suffix of what precedes it that is in the tree.

The tree grows with the corpus and is held nowhere. Documents lie in written blocks of some 800,000 tokens, and a
block knows the nodes that its own text meets. What it can't know by itself are sums over all blocks: how often a
run of words occurs, how much of a context's count its kept words hold, and the divergence of a context from its parent.
For each it sends sorted 64-bit hashes with its own share, dealt out to buckets by their top bits, and is told the
sums in the same order, so answers need no keys. Runs are asked for length by length; a longer run only if its context and
its last words without the first are kept: of a run seen twice both are.
``train`` builds the same tree in memory, for corpora that fit there.
"""

from __future__ import annotations

import functools
import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradeloom.llm.common import ascii_words, small_batches, text_of, written
from tradeloom.session import scratch_dir

#: A word, a pair or a longer run is kept by itself from this count on.
MIN_COUNT = 2
#: Words of the longest context.
DEPTH = 2
#: Log-likelihood that each entry of a retained node must bring on average.
MIN_GAIN = 1.0
DISCOUNT = 0.5
#: Tokens gathered before a task hands on its counts.
FLUSH_TOKENS = 2 << 20
#: Tokens of a block of documents that is counted and scored at once; a longer document is a block of its own.
BLOCK_TOKENS = 3 << 18
#: Blocks per bucket of keys: few buckets keep the parts of a block large, and a bucket holds some million keys.
BLOCKS_A_BUCKET = 8
CACHE_WORDS = 250_000
#: Added to every count in the base score.
BASE_SMOOTHING = 0.1

#: Hashes of the two signs that are no words: blanks never occur in one.
END, START = (np.uint64(xxhash.xxh64_intdigest(sign)) for sign in (b"\n", b" "))
#: The class of all words that are not kept by themselves, and its hash.
RARE = -1
RARE_HASH = np.uint64(xxhash.xxh64_intdigest(b"\n "))


# --- tokens ---------------------------------------------------------------------------------


class WordHashes(dict):
    """64-bit hashes of words, kept between texts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = digest = xxhash.xxh64_intdigest(word)
        return digest


_hashes = WordHashes()


def tokens(text: str) -> np.ndarray:
    """Hashes of a text's words and the end."""
    words = ascii_words(text)
    found = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    return np.append(found, END)


def held_out(id_: object) -> bool:
    return zlib.crc32(str("" if id_ is None else id_).encode()) % 10 == 0


def _training_blocks(batches):
    """Arrays of tokens of training documents and where documents start, a bounded number at a time."""
    held, size = [], 0
    for batch in small_batches(batches):
        for id_, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            if not held_out(id_):
                held.append(tokens(text))
                size += len(held[-1])
            if size >= FLUSH_TOKENS:
                yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])
                held, size = [], 0
    if held:
        yield np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])


def _word_counts(batches):
    for words, _ in _training_blocks(batches):
        found, counts = np.unique(words, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["word", "n"])


# --- the tree -------------------------------------------------------------------------------


@dataclass
class Level:
    """Contexts of one length: sorted keys, and how often each occurs; ``pairs``: sorted keys of (context, symbol)."""

    contexts: np.ndarray
    totals: np.ndarray
    retained: np.ndarray
    backoff: np.ndarray
    pairs: np.ndarray
    shares: np.ndarray


@dataclass
class Tree:
    """``words`` are the hashes of the words kept by themselves, sorted."""

    words: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    root_discount: float
    levels: list[Level] = field(default_factory=list)

    def root(self, counts: np.ndarray) -> np.ndarray:
        """P(word) from training counts; a count of 0 gives the place of all unknown words."""
        if not self.total:
            return np.ones(len(counts))
        unknown = self.root_discount * self.distinct / self.total
        return np.where(counts > 0, (counts - self.root_discount) / self.total, unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        mass = self.total + BASE_SMOOTHING * (self.distinct + 1)
        return np.log10((counts + BASE_SMOOTHING) / mass)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Places of kept words, RARE for others."""
        if not len(self.words):
            return np.full(len(words), RARE, dtype=np.int64)
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == words, at, RARE).astype(np.int64)

    def rare_mass(self) -> float:
        return max(1.0 - float(self.root(self.counts).sum()), 1e-12) if self.total else 1.0


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys, -1 for those that are absent."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, dtype=np.int64)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == keys, at, -1)


def context_places(tree: Tree, symbols: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Per level, the place of each token's context among the candidates, -1 if it is none.

    A context of length one is the word before, or the start; a longer one is the longer context that the
    word before had, extended by that word. So contexts are numbers, exact and short.
    """
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    # The start of a text is a symbol after all kept words.
    before[starts] = len(tree.words)
    places, key = [], np.where(before >= 0, before, -1)
    for depth, level in enumerate(tree.levels):
        if depth:
            # The previous token's context of one word less, and that token.
            earlier = np.full(len(symbols), -1, dtype=np.int64)
            earlier[1:] = places[-1][:-1]
            earlier[starts] = -1
            key = np.where((earlier >= 0) & (before >= 0), earlier * _width(tree) + before, -1)
        places.append(np.where(key >= 0, _lookup(level.contexts, key), -1))
    return places


def _width(tree: Tree) -> int:
    """Symbols: kept words and the start; RARE is stored as one more."""
    return len(tree.words) + 2


def _pair_keys(tree: Tree, contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return contexts * _width(tree) + np.where(symbols >= 0, symbols, len(tree.words) + 1)


def predict(tree: Tree, symbols: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """P(symbol | longest suffix in the tree); for RARE the factor by which its root probability is multiplied."""
    known = symbols >= 0
    rare = tree.rare_mass()
    prediction = np.ones(len(symbols))
    prediction[known] = tree.root(tree.counts)[symbols[known]]
    for level, place in zip(tree.levels, places):
        inside = np.flatnonzero(place >= 0)
        inside = inside[level.retained[place[inside]]]
        at = _lookup(level.pairs, _pair_keys(tree, place[inside], symbols[inside]))
        share = np.where(at >= 0, level.shares[at] if len(level.shares) else 0.0, 0.0)
        share = np.where(known[inside], share, share / rare)
        prediction[inside] = share + level.backoff[place[inside]] * prediction[inside]
    return prediction


def _context_counts(tree_of):
    """(key of context and symbol, count) for the candidates of the deepest level."""

    def run(batches):
        tree = tree_of()
        for words, starts in _training_blocks(batches):
            symbols = tree.symbols(words)
            place = context_places(tree, symbols, starts)[-1]
            inside = np.flatnonzero(place >= 0)
            keys, counts = np.unique(_pair_keys(tree, place[inside], symbols[inside]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

    return run


def _grow(tree: Tree, entries: pa.Table, min_gain: float) -> np.ndarray:
    """Fill the deepest level from its frequent (key, n), and test each candidate against its parent.

    Returns how often each entry occurs, in the order of ``pairs``.
    """
    level, width = tree.levels[-1], _width(tree)
    keys, n = entries.column("key").to_numpy(), entries.column("n").to_numpy()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    context, symbol = keys // width, keys % width
    symbol = np.where(symbol > len(tree.words), RARE, symbol)
    share = (n - DISCOUNT) / level.totals[context]
    size = len(level.contexts)
    level.pairs, level.shares = keys, share
    level.backoff = np.clip(1.0 - np.bincount(context, weights=share, minlength=size).astype(float), 1e-12, 1.0)

    # The parent is the context without its first word.
    shorter = Tree(tree.words, tree.counts, tree.total, tree.distinct, tree.root_discount, tree.levels[:-1])
    parents = [_suffix_places(tree, level.contexts[context], depth) for depth in range(len(tree.levels) - 1)]
    below = predict(shorter, symbol, parents)
    mine = np.where(symbol >= 0, share, share / tree.rare_mass()) + level.backoff[context] * below
    # The gain in log-likelihood on the context's own counts: its divergence from the parent times its count.
    gain = np.bincount(context, weights=n * np.log(mine / below), minlength=size).astype(float)
    gain += (level.totals - np.bincount(context, weights=n, minlength=size)) * np.log(level.backoff)
    entries_of = np.bincount(context, minlength=size)
    level.retained = (entries_of > 0) & (gain >= min_gain * (entries_of + 1))
    return n


def _suffix_places(tree: Tree, keys: np.ndarray, depth: int) -> np.ndarray:
    """Places at a level of the last depth + 1 words of the deepest level's contexts."""
    width, words, key = _width(tree), [], keys
    for level in reversed(tree.levels[:-1]):
        words.append(key % width)
        key = level.contexts[key // width]
    place = np.full(len(keys), -1, dtype=np.int64)
    for step in range(depth + 1):
        word = words[depth - step]
        key = word if step == 0 else np.where(place >= 0, place * width + word, -1)
        place = _lookup(tree.levels[step].contexts, key)
    return place


def _candidates(contexts: np.ndarray, totals: np.ndarray) -> Level:
    size = len(contexts)
    return Level(contexts, totals, np.zeros(size, bool), np.ones(size), np.zeros(0, np.int64), np.zeros(0))


def train(texts: DataFrame, depth: int = DEPTH) -> tuple[Tree, DataFrame]:
    """The tree in memory, and the counts (word, n) of all training words. ``texts``: (id, text).

    All its nodes come to the driver: this is for looking into a tree of a small corpus. ``score`` does not use it.
    """
    spark = texts.sparkSession
    counts = written(
        texts.mapInArrow(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    row = counts.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    total, distinct, once, twice = row[0] or 0, row[1], row[2], row[3]
    kept = counts.filter(F.col("n") >= MIN_COUNT).toArrow()
    words, n = kept.column("word").to_numpy().view(np.uint64), kept.column("n").to_numpy()
    order = np.argsort(words)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    tree = Tree(words[order], n[order], total, distinct, discount)
    # Every word but the end has a successor, and the start has one in each text.
    ends = int(n[words == END].sum()) if len(n) else 0
    contexts, totals = np.arange(len(words) + 1, dtype=np.int64), np.append(tree.counts, ends)
    end = int(tree.symbols(np.array([END]))[0])
    for _ in range(depth):
        tree.levels.append(_candidates(contexts, totals))
        sent = spark.sparkContext.broadcast(tree)
        counted = texts.mapInArrow(_context_counts(lambda sent=sent: sent.value), "key bigint, n bigint")
        entries = counted.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT).toArrow()
        found = _grow(tree, entries, MIN_GAIN)
        # A longer context is a frequent pair of a context and a kept word that has a successor.
        symbol = tree.levels[-1].pairs % _width(tree)
        extends = (symbol < len(tree.words)) & (symbol != end)
        contexts, totals = tree.levels[-1].pairs[extends], found[extends]
    return tree, counts


# --- written steps --------------------------------------------------------------------------


class Steps:
    """Written steps of one scoring; the files of a step's shuffles end with its write."""

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark):
        self.spark = spark

    def write(self, frame: DataFrame, label: str) -> DataFrame:
        folder = scratch_dir(self.spark, label)
        before = self.spark.conf.get(self.CLEANUP)
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            frame.write.option("compression", "zstd").parquet(folder)
        finally:
            self.spark.conf.set(self.CLEANUP, before)
        return self.spark.read.schema(frame.schema).parquet(folder)


@functools.cache
def _coders():
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Numbers with their bytes of equal weight side by side, so that leading zeros take no room."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return _coders()[0].compress(planes.tobytes())


def unpack(blob: bytes, kind=np.uint64) -> np.ndarray:
    planes = np.frombuffer(_coders()[1].decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


# --- blocks of documents --------------------------------------------------------------------


def _mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit hashes of contexts followed by a word."""
    x = (context * np.uint64(0x9E3779B97F4A7C15)) ^ word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BLOCK = "block bigint, ids array<{id}>, held_out array<boolean>, lengths array<bigint>, words binary, counts binary, codes binary"


def _block_row(block: int, ids: list, texts: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    """Sorted distinct words, how often each occurs, and the tokens as ranks by that count."""
    words, _, inverse = distinct(np.concatenate(texts))
    counts = np.bincount(inverse)
    rank = np.empty(len(words), dtype=np.uint32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(words), dtype=np.uint32)
    row = {
        "block": block,
        "ids": ids,
        "held_out": [held_out(i) for i in ids],
        "lengths": [len(t) for t in texts],
        "words": pack_sorted(words),
        "counts": pack(counts.astype(np.uint32)),
        "codes": pack(rank[inverse]),
    }
    return pa.RecordBatch.from_pylist([row], schema=schema)


def _blocks():
    def run(batches):
        from pyspark import TaskContext

        block, size, ids, texts, schema = TaskContext.get().partitionId() << 24, 0, [], [], None
        for batch in small_batches(batches, 256):
            if schema is None:
                listed, number = pa.list_(batch.schema.field("id").type), pa.list_(pa.int64())
                kinds = [pa.int64(), listed, pa.list_(pa.bool_()), number, pa.binary(), pa.binary(), pa.binary()]
                names = ["block", "ids", "held_out", "lengths", "words", "counts", "codes"]
                schema = pa.schema(list(zip(names, kinds)))
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(id_)
                texts.append(tokens(text))
                size += len(texts[-1])
                if size >= BLOCK_TOKENS:
                    yield _block_row(block, ids, texts, schema)
                    block, size, ids, texts = block + 1, 0, [], []
        if ids:
            yield _block_row(block, ids, texts, schema)
        _hashes.clear()

    return run


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the first place of each, and which of them each key is."""
    order = np.argsort(keys).astype(np.int32 if len(keys) < 2**31 else np.int64)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty_like(order)
    inverse[order] = np.cumsum(new, dtype=order.dtype) - 1
    starts = np.flatnonzero(new)
    return ordered[new], np.minimum.reduceat(order, starts) if len(starts) else order, inverse


@dataclass
class Contexts:
    """Contexts of one length in a block, and the runs of one more word that may be or are kept."""

    #: Sorted keys of the contexts, and how often each occurs.
    contexts: np.ndarray
    totals: np.ndarray
    #: The number of each token's context, -1 where it has none.
    place: np.ndarray
    #: Tokens whose run may be kept, the sorted distinct runs, which of them each token's run is, and a token of each.
    at: np.ndarray
    keys: np.ndarray
    inverse: np.ndarray
    first: np.ndarray
    #: Contexts this block tells of.
    mine: np.ndarray
    #: From the counts on: kept runs, those this block tells of, their counts, a token and the context of each.
    kept: np.ndarray = None
    own: np.ndarray = None
    n: np.ndarray = None
    token: np.ndarray = None
    context: np.ndarray = None
    #: From the held counts on: what contexts leave to their parents, and which keep any run.
    held: np.ndarray = None
    entries: np.ndarray = None
    backoff: np.ndarray = None
    gain: np.ndarray = None
    #: From the divergence on.
    retained: np.ndarray = None
    value: np.ndarray = None


COUNT, HELD, GAIN = range(3)


class Block:
    """The tokens of a block and what it has been told before a round.

    In round r the counts of runs of r + 1 words are asked for, the held counts of contexts of r - 1 words, and the
    divergence of contexts of r - 2 words.
    """

    def __init__(self, row: dict, round_: int, depth: int, root: Root | None):
        self.row, self.root, self.round = row, root, round_
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.vocabulary = unpack_sorted(row["words"])
        order = np.argsort(-unpack(row["counts"], np.uint32).astype(np.int64), kind="stable")
        self.places = order[unpack(row["codes"], np.uint32)]
        self.train = np.repeat(~np.array(row["held_out"], dtype=bool), self.lengths)
        self.told = {}
        for part in row.get("told") or []:
            self.told.setdefault(part["step"], []).append(part)
        self.levels = []
        if round_:
            self._grow(depth)

    def _told(self, depth: int, kind: int, name: str = "first", dtype=np.uint64) -> np.ndarray:
        parts = self.told.get(3 * depth + kind, [])
        return np.concatenate([unpack(p[name], dtype) for p in parts]) if parts else np.zeros(0, dtype=dtype)

    def _before(self, values: np.ndarray, at_start) -> np.ndarray:
        moved = np.empty_like(values)
        moved[1:] = values[:-1]
        moved[self.starts] = at_start
        return moved

    def _grow(self, depth: int) -> None:
        words, root = self.vocabulary[self.places], self.root
        told = self._told(0, COUNT)
        counts, own = (told >> np.uint64(1)).astype(np.int64), (told & np.uint64(1)).astype(bool)
        self.n = counts[self.places]
        self.rare = rare = self.n < MIN_COUNT
        symbol = np.where(rare, RARE_HASH, words)
        # Contexts of one word are the kept words and the start of a text.
        often = counts >= MIN_COUNT
        contexts, totals = self.vocabulary[often], counts[often]
        start = int(np.searchsorted(contexts, START))
        contexts, totals = np.insert(contexts, start, START), np.insert(totals, start, root.ends)
        # The block that tells of the end tells of the start, too.
        own = np.insert(own[often], start, own[np.searchsorted(self.vocabulary, END)])
        number = np.cumsum(often, dtype=np.int32) - 1
        number[number >= start] += 1
        number[~often] = -1
        context, place = self._before(words, START), self._before(number[self.places], start)
        below, held = np.where(rare, 1.0, root.root(self.n)), np.ones(len(words), dtype=bool)
        del words
        for d in range(1, min(depth, self.round) + 1):
            at = np.flatnonzero((place >= 0) & held)
            keys, first, inverse = distinct(_mix(context[at], symbol[at]))
            level = Contexts(contexts, totals, place, at, keys, inverse, at[first], own)
            self.levels.append(level)
            if d == self.round:
                return
            self._fill(level, d, below)
            # The runs are the contexts of one word more, and the parents of longer runs.
            run, number = np.zeros_like(symbol), np.full(len(symbol), -1, dtype=np.int32)
            inside = level.kept[inverse]
            which = (np.cumsum(level.kept) - 1)[inverse[inside]]
            extends = ~rare[level.token]
            run[at[inside]] = keys[inverse[inside]]
            number[at[inside]] = np.where(extends, np.cumsum(extends) - 1, -1)[which]
            held = np.zeros(len(symbol), dtype=bool)
            held[at[inside]] = True
            if level.value is not None:
                below = np.zeros(len(symbol))
                below[at[inside]] = level.value[which]
            contexts, totals, own = keys[level.kept][extends], level.n[extends], level.own[extends]
            context, place = self._before(run, 0), self._before(number, -1)

    def _fill(self, level: Contexts, d: int, below: np.ndarray) -> None:
        answer = self._told(d, COUNT)
        level.kept = answer > 0
        answer = answer[level.kept]
        level.own, level.n = (answer & np.uint64(1)).astype(bool), (answer >> np.uint64(1)).astype(np.int64)
        level.token = level.first[level.kept]
        level.context = level.place[level.token]
        if self.round < d + 2:
            return
        level.held = self._told(d, HELD).astype(np.int64)
        level.entries = self._told(d, HELD, "second").astype(np.int64)
        left = 1 - (level.held - DISCOUNT * level.entries) / np.maximum(level.totals, 1)
        level.backoff = np.clip(left, 1e-12, 1.0)
        share = (level.n - DISCOUNT) / level.totals[level.context]
        share /= np.where(self.rare[level.token], self.root.rare_mass, 1.0)
        below = below[level.token]
        mine = share + level.backoff[level.context] * below
        # The gain in log-likelihood on the context's own counts: its divergence from the parent times its count.
        # What a retained context must bring is taken off by the block that tells of it.
        level.gain = self._sums(level, level.n * np.log(mine / below))
        rest = (level.totals - level.held) * np.log(level.backoff) - MIN_GAIN * (level.entries + 1)
        level.gain += np.where(level.mine, rest, 0.0)
        if self.round < d + 3:
            return
        level.retained = np.zeros(len(level.contexts), dtype=bool)
        level.retained[level.entries > 0] = self._told(d, GAIN, dtype=np.uint8) > 0
        level.value = np.where(level.retained[level.context], mine, below)

    def _sums(self, level: Contexts, weights: np.ndarray) -> np.ndarray:
        """Sums by context over the runs that this block tells of."""
        sums = np.bincount(level.context[level.own], weights=weights[level.own], minlength=len(level.contexts))
        return sums.astype(float)

    def asked(self, depth: int):
        """(step, sorted keys, columns of numbers to add up) of this round."""
        if self.round == 0:
            n = np.bincount(self.places, weights=self.train, minlength=len(self.vocabulary))
            yield COUNT, self.vocabulary, [n.astype(np.uint64)]
        elif self.round <= depth:
            level = self.levels[-1]
            n = np.bincount(level.inverse, weights=self.train[level.at], minlength=len(level.keys))
            yield 3 * self.round + COUNT, level.keys, [n.astype(np.uint64)]
        if 1 <= (d := self.round - 1) <= depth:
            level = self.levels[d - 1]
            sums = [self._sums(level, level.n), self._sums(level, np.ones(len(level.n)))]
            yield 3 * d + HELD, level.contexts, [s.astype(np.uint64) for s in sums]
        if 1 <= (d := self.round - 2) <= depth:
            level = self.levels[d - 1]
            live = level.entries > 0
            yield 3 * d + GAIN, level.contexts[live], [level.gain[live]]

    def scores(self) -> list[np.ndarray]:
        """Per document n_tokens, n_known, base_score, score."""
        first = np.log10(self.root.root(self.n))
        prediction = np.where(self.rare, 0.0, first)
        for level in self.levels:
            # What the context leaves to its parent, unless the run has a value of its own.
            left = np.where(level.retained, np.log10(level.backoff), 0.0)
            there = level.place >= 0
            prediction[there] += left[level.place[there]]
            inside = level.kept[level.inverse]
            value = np.log10(level.value)[(np.cumsum(level.kept) - 1)[level.inverse[inside]]]
            prediction[level.at[inside]] = value
        prediction += np.where(self.rare, first, 0.0)
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)

        def per_document(values):
            return np.bincount(owner, weights=values, minlength=len(self.lengths))

        known = per_document(self.n > 0).astype(np.int64)
        return [self.lengths, known, per_document(self.root.base(self.n)), per_document(prediction)]


def _each_block(work, round_: int, depth: int, root: Root | None):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work(Block(batch.slice(i, 1).to_pylist()[0], round_, depth, root))

    return run


# --- rounds ---------------------------------------------------------------------------------

_ASKED = "step int, bucket bigint, block bigint, keys binary, first binary, second binary"
_TOLD = "block bigint, step int, bucket bigint, first binary, second binary, stats array<bigint>"


def _ask(depth: int, bits: int):
    def work(block: Block):
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        names = ["step", "bucket", "block", "keys", "first", "second"]
        for step, keys, columns in block.asked(depth):
            rows = []
            buckets, first = np.unique(keys >> np.uint64(64 - bits), return_index=True)
            for bucket, a, b in zip(buckets.tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]):
                numbers = [pack(c[a:b]) for c in columns] + [None] * (2 - len(columns))
                rows.append([step, bucket, block.row["block"], pack_sorted(keys[a:b]), *numbers])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    return work


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """One bucket of a step: the sums by key over all blocks, in the order in which each block asked.

    A count is told as 2 n, and to the first block that has the run as 2 n + 1; runs that are not kept as 0. Of a gain only
    whether the context is retained.
    """
    asked = asked.sort_values("block")
    step = int(asked["step"].iloc[0])
    keys = [unpack_sorted(k) for k in asked["keys"]]
    ends = np.cumsum([len(k) for k in keys])[:-1]
    known, first, inverse = distinct(np.concatenate(keys))

    def sums(name, dtype):
        return np.bincount(inverse, weights=np.concatenate([unpack(v, dtype) for v in asked[name]])).astype(dtype)

    def told(values):
        return [pack(np.ascontiguousarray(v)) for v in np.split(values[inverse], ends)]

    out = {"block": asked["block"], "step": asked["step"], "bucket": asked["bucket"]}
    stats = [None] * len(asked)
    second = [None] * len(asked)
    if step % 3 == COUNT:
        n = sums("first", np.uint64)
        answer = np.where(n >= (MIN_COUNT if step else 1), n << np.uint64(1), np.uint64(0))[inverse]
        answer[first] += answer[first] > 0
        numbers = [pack(np.ascontiguousarray(v)) for v in np.split(answer, ends)]
        if not step:
            kept, end = n >= MIN_COUNT, known == END
            found = [n.sum(), (n > 0).sum(), (n == 1).sum(), (n == 2).sum(), n[kept].sum(), kept.sum(), n[end].sum()]
            stats[0] = [int(v) for v in found]
    elif step % 3 == HELD:
        numbers, second = told(sums("first", np.uint64)), told(sums("second", np.uint64))
    else:
        numbers = told((sums("first", np.float64) >= 0).astype(np.uint8))
    return pd.DataFrame(out | {"first": numbers, "second": second, "stats": stats})


@dataclass
class Root(Tree):
    """The numbers of the root alone. ``ends``: texts, which is how often the start occurs."""

    ends: int = 0
    rare_mass: float = 1.0


def _root(told: DataFrame) -> Root:
    numbers = told.agg(*[F.sum(F.col("stats")[i]) for i in range(7)]).first()
    total, distinct, once, twice, kept_total, kept, ends = (v or 0 for v in numbers)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    rare_mass = max(1.0 - (kept_total - discount * kept) / total, 1e-12) if total else 1.0
    return Root(np.zeros(0, np.uint64), np.zeros(0, np.int64), total, distinct, discount, [], ends, rare_mass)


def _with_told(blocks: DataFrame, told: list[DataFrame]) -> DataFrame:
    """Blocks with all that they have been told, in the order in which they asked."""
    if not told:
        return blocks
    every = told[0]
    for more in told[1:]:
        every = every.union(more)
    parts = F.array_sort(F.collect_list(F.struct("step", "bucket", "first", "second"))).alias("told")
    return blocks.join(every.groupBy("block").agg(parts), "block", "left")


def _finish(id_type: pa.DataType):
    def work(block: Block):
        ids, held = pa.array(block.row["ids"], id_type), pa.array(block.row["held_out"], pa.bool_())
        names = ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        yield pa.RecordBatch.from_arrays([ids, held, *map(pa.array, block.scores())], names=names)

    return work


def score(
    docs: DataFrame,
    depth: int = DEPTH,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the probability).

    Rows whose id has a CRC-32 divisible by 10 are held out, all others train; a null id counts as the empty
    text there. A null or empty text is the end token alone. Repeated rows train as often as they come. Without
    training rows every probability is 1. An empty table gives no rows. Words and runs of words
    are told apart by 64-bit hashes. Contexts have up to ``depth`` words, of any count from ``MIN_COUNT`` on.
    """
    texts = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    id_field, steps = texts.schema["id"].dataType, Steps(docs.sparkSession)
    blocks = steps.write(texts.mapInArrow(_blocks(), _BLOCK.format(id=id_field.simpleString())), "blocks")
    # The buckets grow in number with the blocks, so both are of a bounded size at any size of the corpus.
    bits = max(3, (blocks.count() // BLOCKS_A_BUCKET).bit_length())
    told, root = [], None
    for round_ in range(depth + 3):
        asked = _with_told(blocks, told).mapInArrow(_each_block(_ask(depth, bits), round_, depth, root), _ASKED)
        told.append(steps.write(asked.groupBy("step", "bucket").applyInPandas(_answer, _TOLD), f"told{round_}"))
        root = root or _root(told[0])
    numbers = f"id {id_field.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    finish = _each_block(_finish(to_arrow_type(id_field)), depth + 3, depth, root)
    return _with_told(blocks, told).mapInArrow(finish, numbers).select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(root.total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
