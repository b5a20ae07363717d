"""Periodic runs of words: maximal stretches that repeat with their smallest period, found by scale.

A run of period q is a maximal stretch of places i whose word equals the word q places on. Periods are taken by
octaves, from D up to 2D, with a boundary every D words: since a run matches over q places or more, some boundary
lies in it. A document is exploded into overlapping tiles per octave, each a row with a few boundaries and the words
that their answer can depend on. A tile is solved by itself, wherever it lands: the Z-function of the words after a
boundary says for all shifts at once how far they match to the right, that of the words before it how far to the
left, both up to the next boundary. These fragments meet by document and period and are stitched to runs.

Tiles are made only where a boundary has, within its octave's reach, the same D / 2 words again on one side at least;
without them no run passes there. Grams of doubled length are numbered from pairs of shorter ones, and only grams that
repeat in their document are followed, so ordinary text ends after the shortest ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import small_batches, text_of, written

#: Words of the shortest run, whatever its period.
LEAST = 12
#: Boundaries of one tile at most.
BOUNDARIES = 16
#: Tiles that a task solves.
TILES = 4096
#: Words that a task gathers before it looks for tiles.
FLUSH_WORDS = 1 << 20


def octaves(longest: int, least: int = LEAST):
    """(boundary distance, first period, end of periods) for stretches of up to ``longest`` words.

    The first octave holds all short periods: their runs have ``least`` words and match over half of them.
    """
    spacing, low = (least + 1) // 2, 1
    high = 8
    while high < spacing:
        high *= 2
    while 2 * low <= longest:
        yield spacing, low, high
        spacing, low, high = high, high, 2 * high


# --- tiles ----------------------------------------------------------------------------------


def _numbered(grams: np.ndarray, ahead: np.ndarray, size: int) -> np.ndarray:
    """Numbers of longer grams out of those of their two parts, ``size`` places apart; -1 where none repeats."""
    found = np.full(len(grams), -1, dtype=np.int64)
    at = np.flatnonzero((grams[: len(grams) - size] >= 0) & (ahead[size:] >= 0)) if len(grams) > size else []
    if not len(at):
        return found
    key = grams[at] * (int(ahead.max()) + 1) + ahead[at + size]
    _, number, n = np.unique(key, return_inverse=True, return_counts=True)
    found[at] = np.where(n[number] > 1, number, -1)
    return found


def _again(grams: np.ndarray, low: int, high: int) -> np.ndarray:
    """Places whose gram stands again from ``low`` to before ``high`` places on."""
    at = np.flatnonzero(grams >= 0)
    width = len(grams) + 2 * high
    keys = np.sort(grams[at] * width + at)
    mine = grams[at] * width + at
    place = np.searchsorted(keys, mine + low)
    place[place == len(keys)] = 0
    return at[(keys[place] >= mine + low) & (keys[place] < mine + high)] if len(keys) else at


def boundaries(words: np.ndarray, starts: np.ndarray, least: int = LEAST):
    """Per octave the places of boundaries through which a run may pass. ``starts``: where documents start."""
    lengths = np.diff(np.append(starts, len(words)))
    doc = np.repeat(np.arange(len(starts)), lengths)
    key = doc * (int(words.max(initial=0)) + 1) + words
    _, number, n = np.unique(key, return_inverse=True, return_counts=True)
    grams = {1: np.where(n[number] > 1, number, -1)}

    def of(size: int) -> np.ndarray:
        if size not in grams:
            part = 1 << (size.bit_length() - 1)
            part = part // 2 if part == size else part
            grams[size] = _numbered(of(part), of(size - part), part)
        return grams[size]

    for spacing, low, high in octaves(int(lengths.max(initial=0)), least):
        half = (spacing + 1) // 2
        gram = of(half)
        if not (gram >= 0).any():
            # Longer grams are made of shorter ones.
            return
        for old in [size for size in grams if 4 * size < half]:
            del grams[old]
        near = _again(gram, low, high)
        rest = (near - starts[doc[near]]) % spacing
        after, before = near[rest == 0], near[(rest + half) % spacing == 0] + half
        yield (spacing, low, high), np.unique(np.concatenate([after, before]))


def tiles(words: np.ndarray, starts: np.ndarray, least: int = LEAST):
    """(document, spacing, place of the tile, words before its first boundary, which boundaries, words)."""
    ends = np.append(starts[1:], len(words))
    for (spacing, _, high), at in boundaries(words, starts, least):
        doc = np.searchsorted(starts, at, side="right") - 1
        number = (at - starts[doc]) // spacing
        tile, inside = number // BOUNDARIES, number % BOUNDARIES
        first = np.flatnonzero(np.append(True, (tile[1:] != tile[:-1]) | (doc[1:] != doc[:-1]))) if len(at) else []
        for start, end in zip(first, np.append(first[1:], len(at))):
            which = inside[start:end]
            d, begin = doc[start], at[start]
            left = min(spacing, begin - starts[d])
            stop = min(ends[d], at[end - 1] + high + spacing)
            mask = int((1 << (which - which[0])).sum())
            yield d, spacing, begin - starts[d], left, mask, words[begin - left : stop]


# --- one tile -------------------------------------------------------------------------------


def z_function(s: list[int]) -> list[int]:
    """Per place the length of the longest common start of the rest and the whole; 0 for the first place."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


_primes: dict[int, np.ndarray] = {}


def _shorter(low: int, high: int) -> np.ndarray:
    """Row q - low: q divided by each of its prime factors, 0 where there are no more."""
    if low not in _primes:
        rest, rows = np.arange(low, high), np.zeros((high - low, 8), dtype=np.int64)
        filled, whole = np.zeros(high - low, dtype=np.int64), np.arange(low, high)
        for p in range(2, int(high**0.5) + 1):
            hit = np.flatnonzero(rest % p == 0)
            rows[hit, filled[hit]] = whole[hit] // p
            filled[hit] += 1
            while len(hit):
                rest[hit] //= p
                hit = hit[rest[hit] % p == 0]
        hit = np.flatnonzero(rest > 1)
        rows[hit, filled[hit]] = whole[hit] // rest[hit]
        _primes[low] = rows
    return _primes[low]


def fragments(words: list[int], at: int, spacing: int, low: int, high: int):
    """(periods, matched places before the boundary, and from it on), up to ``spacing`` each way.

    Shifts that a part of theirs explains are left out: the stretch then has a smaller period, and so has the run.
    """
    right = words[at : at + high + spacing]
    z = np.array(z_function(right), dtype=np.int64)
    begin = max(at - spacing, 0)
    stop = min(at + high, len(words))
    before, back = words[begin:at][::-1], words[begin:stop][::-1]
    zr = np.array(z_function([*before, -1, *back])[len(before) + 1 :], dtype=np.int64)
    # By shift: how far the words match to the right and to the left of the boundary.
    reach = np.arange(1, min(high, stop - at + 1))
    lp, ls = np.zeros(high, dtype=np.int64), np.zeros(high, dtype=np.int64)
    inside = reach[reach < len(z)]
    lp[inside] = z[inside]
    ls[reach] = zr[stop - at - reach]
    capped = np.minimum(lp[low:], spacing)
    periods = low + np.flatnonzero(ls[low:] + capped >= spacing)
    if not len(periods):
        return periods, ls[:0], lp[:0]
    l, r = ls[periods], np.minimum(lp[periods], spacing)
    parts = _shorter(low, high)[periods - low]
    explained = (parts > 0) & (ls[parts] >= l[:, None]) & (parts + lp[parts] >= (periods + r)[:, None])
    prime = ~explained.any(axis=1)
    return periods[prime], l[prime], r[prime]


def _solve(least: int):
    """(row, period, start, stop): stretches of places that match; fragments of neighbours are joined already."""
    known = {spacing: (low, high) for spacing, low, high in octaves(1 << 40, least)}

    def run(batches):
        for batch in small_batches(batches, 256):
            rows, found = [], []
            columns = [batch.column(c).to_pylist() for c in ("row", "spacing", "at", "before", "boundaries", "words")]
            for row, spacing, at, before, mask, words in zip(*columns):
                words = np.frombuffer(words, dtype="<i4").tolist()
                low, high = known[spacing]
                open_: dict[int, list[int]] = {}
                place = 0
                while mask >> place:
                    if mask >> place & 1:
                        shift = place * spacing
                        for q, l, r in zip(*(x.tolist() for x in fragments(words, before + shift, spacing, low, high))):
                            start, stop = at + shift - l, at + shift + r
                            last = open_.get(q)
                            if last and last[2] >= start:
                                last[2] = max(last[2], stop)
                            else:
                                open_[q] = last = [q, start, stop]
                                found.append(last)
                                rows.append(row)
                    place += 1
            numbers = np.array(found, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), *[pa.array(numbers[:, i]) for i in range(3)]],
                names=["row", "period", "start", "stop"],
            )

    return run


# --- documents ------------------------------------------------------------------------------

Rewrite = Callable[[object, list[bytes]], list[bytes]]
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_RESULT = [
    "n_runs bigint", "start bigint", "length bigint", "period bigint", "exponent_milli bigint", "runs_sha256 string",
    "collapsed_sha256 string", "runs array<struct<start: bigint, length: bigint, period: bigint>>", "collapsed string",
]


def _result(words: list[bytes], runs: list[tuple[int, int, int]], texts: bool) -> tuple:
    """``runs``: (start, period, length), in order."""
    kept = words
    if runs:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for start, period, length in runs:
            change[start + period] += 1
            change[start + length] -= 1
        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    collapsed = b" ".join(kept)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    lines = "".join(f"{start},{length},{period}\n" for start, period, length in runs)
    return (
        len(runs),
        *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(collapsed).hexdigest(),
        [{"start": s, "length": n, "period": q} for s, q, n in runs],
        collapsed.decode("utf-8", "replace") if texts else None,
    )


_TYPES = [pa.int64()] * 5 + [pa.string()] * 2 + [_RUNS, pa.string()]


def _columns(results: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[i] for r in results], kind) for i, kind in enumerate(_TYPES)]


def _explode(rewrite: Rewrite | None, least: int, texts: bool):
    """Documents and their tiles, in one table. A document without tiles has its result, another one its words."""

    def run(batches):
        for batch in small_batches(batches, 256):
            ids, bodies = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            rows = batch.column("row").to_pylist()
            begin = 0
            while begin < len(rows):
                numbers: dict[bytes, int] = {}
                words, held, starts, size = [], [], [], 0
                end = begin
                while end < len(rows) and size < FLUSH_WORDS:
                    split = bodies[end].encode("utf-8", "surrogatepass").split()
                    split = rewrite(ids[end], split) if rewrite else split
                    starts.append(size)
                    held.append(split)
                    words += [numbers.setdefault(w, len(numbers)) for w in split]
                    size += len(split)
                    end += 1
                found = list(tiles(np.array(words, dtype=np.int64), np.array(starts), least))
                tiled = {t[0] for t in found}
                results, carried = [], []
                for i, split in enumerate(held):
                    if i in tiled:
                        results.append((None,) * len(_TYPES))
                        carried.append(b" ".join(split))
                    else:
                        results.append(_result(split, [], texts))
                        carried.append(None)
                n = len(held)
                none = pa.nulls(n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(begin, n), batch.column("id").slice(begin, n), none]
                    + [none.cast(pa.int64()), none, none, pa.array(carried, pa.binary()), *_columns(results)],
                    names=_NAMES,
                )
                # A tile's row has the column of the words for its own.
                for start in range(0, len(found), 1024):
                    part = found[start : start + 1024]
                    n = len(part)
                    ints = [pa.array([int(t[c]) for t in part], k) for c, k in ((1, pa.int32()), (2, pa.int64()))]
                    ints += [pa.array([int(t[c]) for t in part], pa.int32()) for c in (3, 4)]
                    body = pa.array([t[5].astype("<i4").tobytes() for t in part], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rows[begin + t[0]] for t in part], pa.int64())]
                        + [pa.nulls(n, batch.column("id").type), *ints, body]
                        + [pa.nulls(n, kind) for kind in _TYPES],
                        names=_NAMES,
                    )
                begin = end

    return run


_NAMES = ["row", "id", "spacing", "at", "before", "boundaries", "words", *[c.split()[0] for c in _RESULT]]


def _collapse(texts: bool):
    def run(batches):
        for batch in small_batches(batches, 256):
            results = []
            for body, runs in zip(batch.column("words").to_pylist(), batch.column("found").to_pylist()):
                ordered = [(r["start"], r["period"], r["length"]) for r in runs or ()]
                results.append(_result(body.split(b" ") if body else [], ordered, texts))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *_columns(results)], names=["id", *_NAMES[7:]])

    return run


def stitched(pieces: DataFrame, least: int = LEAST) -> DataFrame:
    """(row, start, period, length) of the runs out of the fragments (row, period, start, stop) of all tiles."""
    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached >= F.col("start"), 0).otherwise(1)
    island = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = pieces.withColumn("opens", opens).withColumn("island", island)
    whole = joined.groupBy("row", "period", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    matched = F.col("stop") - F.col("start")
    whole = whole.filter((matched >= F.col("period")) & (matched + F.col("period") >= least))
    return whole.select("row", "start", "period", (matched + F.col("period")).alias("length"))


def periodic_runs(
    docs: DataFrame,
    rewrite: Rewrite | None = None,
    least: int = LEAST,
    texts: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, n_runs; start, length, period and exponent_milli of the longest run; runs_sha256, collapsed_sha256,
    runs (by start, then period), and with ``texts`` the collapsed text.

    Words lie between ASCII white space and are told apart by their bytes; ``rewrite`` may replace a document's words
    (of its id) beforehand. A run is a maximal stretch with smallest period q, at least ``least`` and 2q words long. The
    longest one is the first among equals, then the one of the smaller period. The collapsed text leaves out each word
    that some run holds after its first q words. A null, empty or blank text has no runs and no words: nulls and the
    digests of nothing. Rows are told apart by a number, so repeated rows and null ids each get their own result. An
    empty table gives no rows. A document's words and the list of its runs have to fit a task, its tiles need not.
    """
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), text_of(text_column).alias("text")
    )
    id_type = source.schema["id"].dataType.simpleString()
    result = ", ".join(_RESULT)
    layout = f"row bigint, id {id_type}, spacing int, at bigint, before int, boundaries int, words binary, {result}"
    exploded = written(source.mapInArrow(_explode(rewrite, least, texts), layout), "tiles")
    cut = exploded.filter("spacing IS NOT NULL").select("row", "spacing", "at", "before", "boundaries", "words")
    # A long document's tiles lie together; they are dealt out one by one, by their number and not by their few bytes.
    cut = cut.repartition(-(-cut.count() // TILES) or 1, "row", "spacing", "at")
    pieces = cut.mapInArrow(_solve(least), "row bigint, period bigint, start bigint, stop bigint")
    runs = stitched(pieces, least).groupBy("row")
    runs = runs.agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    whole = exploded.filter("spacing IS NULL")
    names = [c.split()[0] for c in _RESULT]
    plain = whole.filter("n_runs IS NOT NULL").select("id", *names)
    tiled = whole.filter("n_runs IS NULL").select("row", "id", "words").join(runs, "row", "left")
    tiled = tiled.mapInArrow(_collapse(texts), f"id {id_type}, {result}")
    every = plain.unionByName(tiled).withColumnRenamed("id", id_column)
    return every if texts else every.drop("collapsed")
