"""Packing of documents as a cutting-stock problem, solved by column generation.

Documents longer than a sequence are cut into whole sequences and a rest. What is left to place is a histogram of
lengths, rounded up to a few classes: its size does not depend on the corpus. A linear program asks how often each
pattern of classes should fill a sequence; patterns are not listed beforehand, but priced one by one by a knapsack
over the program's dual values, until none is worth adding. Its whole parts become sequences, what rounding leaves
is packed best fit, and a piece takes the place that its rank in its class has in them.

Rounding up leaves gaps, and documents may be cut freely. So a small, random share of the pieces, as many tokens as the
gaps are expected to have, is kept aside and laid end to end on a line; the gaps are laid end to end as well, and
each piece is cut where it passes from gap to gap. What is left of the line fills whole sequences and, as a sequence
of a power of two needs no padding, a last one for each binary digit of the rest.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import small_batches, text_of, written
from tradeloom.llm.packing import word_tokenizer

SEQUENCE = 4096
#: Lengths up to this one are classes of their own; each doubling beyond is cut into as many steps.
EXACT, STEPS = 32, 16
#: The program ends this close to its lower bound.
GAP = 0.0005
#: Weight of the best prices so far against the program's own.
STEADY = 0.8
#: Sequences that rounding may leave open, added to the share that is kept aside.
SPARE = 4
#: Pieces of one class, or sequences with a gap, that are numbered in one task.
RANKED = 20_000
#: Parts that the share kept aside is a number of.
SHARES = 1 << 20


# --- classes and the program ----------------------------------------------------------------


def class_sizes(size: int = SEQUENCE) -> np.ndarray:
    """Class sizes up to ``size``; steps grow with the length, so a piece falls short by a small share of it."""
    found, low = list(range(1, EXACT + 1)), EXACT
    while low < size:
        step = max(1, low // STEPS)
        found += range(low + step, 2 * low + 1, step)
        low *= 2
    return np.array([s for s in found if s < size] + [size], dtype=np.int64)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern and how often it takes each class."""
    best, after = np.zeros(capacity + 1), []
    for value, size in zip(values.tolist(), sizes.tolist()):
        after.append(best)
        if value <= 1e-12:
            continue
        # By remainder of the size, the best number of pieces is a running maximum of value at a fixed price.
        steps = -(-(capacity + 1) // size)
        table = np.full(steps * size, -np.inf)
        table[: capacity + 1] = best
        price = np.arange(steps)[:, None] * value
        best = (np.maximum.accumulate(table.reshape(steps, size) - price, axis=0) + price).ravel()[: capacity + 1]
    pattern, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for i in range(len(sizes) - 1, -1, -1):
        if values[i] > 1e-12 and sizes[i] <= room:
            n = np.arange(room // sizes[i] + 1)
            pattern[i] = n[np.argmax(after[i][room - n * sizes[i]] + n * values[i])]
            room -= int(pattern[i] * sizes[i])
    return float(values @ pattern), pattern


def solve(demand: np.ndarray, sizes: np.ndarray, capacity: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used, in fractions: the fewest sequences that hold the demand.

    Dual values swing widely in early rounds, so prices are taken between them and the best ones so far, which at first
    are the classes' shares of a sequence. A class may have more places than pieces: its surplus is a column, too.
    """
    m = len(sizes)
    demand = demand.astype(float)
    columns, cost = np.diag(capacity // sizes).astype(float), np.ones(m)
    inverse, steady = np.linalg.inv(columns), sizes / capacity
    bound, trust = float(demand @ sizes) / capacity, STEADY
    for step in range(40 * m):
        if step % 50 == 49:
            inverse = np.linalg.inv(columns)
        used = np.maximum(inverse @ demand, 0.0)
        dual = cost @ inverse
        if cost @ used <= bound * (1 + GAP):
            break
        if dual.min() < -1e-9:
            enters, price = np.zeros(m), 0.0
            enters[int(dual.argmin())] = -1.0
        else:
            asked = np.maximum(trust * steady + (1 - trust) * dual, 0.0)
            worth, pattern = knapsack(asked, sizes, capacity)
            # No pattern is worth more, so the prices divided by its worth are a lower bound.
            lower = float(asked @ demand) / max(worth, 1.0)
            if lower > bound:
                bound, steady = lower, asked / max(worth, 1.0)
            if dual @ pattern <= 1 + 1e-9:
                if trust <= 1e-3:
                    break
                trust /= 2
                continue
            trust, price, enters = max(trust, STEADY), 1.0, pattern.astype(float)
        change = inverse @ enters
        rows = np.flatnonzero(change > 1e-9)
        ratio = used[rows] / change[rows]
        ties = rows[ratio <= ratio.min() + 1e-12]
        leaves = ties[np.argmax(change[ties])]
        columns[:, leaves], cost[leaves] = enters, price
        pivot = inverse[leaves] / change[leaves]
        inverse = inverse - np.outer(change, pivot)
        inverse[leaves] = pivot
    uses = np.maximum(np.linalg.solve(columns, demand), 0.0)
    return columns.T[cost > 0].astype(np.int64), uses[cost > 0]


def best_fit(counts: np.ndarray, sizes: np.ndarray, capacity: int = SEQUENCE) -> list[np.ndarray]:
    """Patterns for single sequences, largest pieces first, each into the smallest gap that holds it."""
    patterns: list[np.ndarray] = []
    gaps: list[tuple[int, int]] = []
    for i in range(len(sizes) - 1, -1, -1):
        left, size = int(counts[i]), int(sizes[i])
        while left:
            at = bisect_left(gaps, (size, -1))
            gap, number = gaps.pop(at) if at < len(gaps) else (capacity, len(patterns))
            if number == len(patterns):
                patterns.append(np.zeros(len(sizes), dtype=np.int64))
            n = min(left, gap // size)
            patterns[number][i] += n
            left -= n
            if gap > n * size:
                insort(gaps, (gap - n * size, number))
    return patterns


def slots(patterns: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, int]:
    """(class, first rank, sequence, pieces of that class per sequence), by class and rank; and the sequences."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in patterns:
        for c in np.flatnonzero(pattern).tolist():
            n = int(pattern[c])
            rows.append((c, taken.get(c, 0), sequence, n))
            taken[c] = taken.get(c, 0) + n * times
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4), sequence


def aside(lengths: dict[int, int], size: int = SEQUENCE) -> tuple[float, list[tuple[np.ndarray, float]], np.ndarray]:
    """The share of pieces to keep aside, the program's patterns with their uses, and the classes' sizes.

    ``lengths``: number of pieces per length. The share is what the patterns leave open of each sequence.
    """
    sizes = class_sizes(size)
    demand = np.zeros(len(sizes))
    # A piece that fills its sequence needs no plan; one of the largest class has a sequence for itself.
    part = {length: n for length, n in lengths.items() if length < size}
    for length, n in part.items():
        demand[np.searchsorted(sizes, length)] += n
    total, alone, demand[-1] = sum(length * n for length, n in part.items()), demand[-1], 0
    there = np.flatnonzero(demand)
    patterns, uses = solve(demand[there], sizes[there], size) if len(there) else (np.zeros((0, 0)), np.zeros(0))
    if not total:
        return 0.0, [], sizes
    open_share = 1.0 - total / (size * (uses.sum() + alone))
    share = min(1.0, 1.05 * max(open_share, 0.0) + SPARE * size / total)
    whole = []
    for pattern, use in zip(patterns, uses):
        full = np.zeros(len(sizes), dtype=np.int64)
        full[there] = pattern
        whole.append((full, float(use)))
    return share, whole, sizes


# --- pieces ---------------------------------------------------------------------------------


def _pieces(path: str, end_id: int, length: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        tokenizer = word_tokenizer(path)
        narrow = max(tokenizer.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        for batch in small_batches(batches, 256):
            at, starts, lengths, totals, crcs, bodies = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = tokenizer.ids(text) + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start : 4 * (start + length)]
                    at.append(i)
                    starts.append(start)
                    lengths.append(len(part) // 4)
                    totals.append(total)
                    crcs.append(zlib.crc32(part))
                    # A whole sequence is never cut again.
                    whole = len(part) == 4 * length
                    bodies.append(None if whole else np.frombuffer(part, "<u4").astype("<u2").tobytes() if narrow else part)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(rows),
                    batch.column("id").take(rows),
                    *[pa.array(column, pa.int64()) for column in (starts, lengths, crcs, totals)],
                    pa.array(bodies, pa.binary()),
                ],
                names=["row", "id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    return run


def _cut(batches):
    """Checksums of the parts between ``low`` and ``high`` of a piece's ids."""
    for batch in small_batches(batches):
        crcs = []
        columns = [batch.column(c).to_pylist() for c in ("ids", "of", "low", "high")]
        for body, of, low, high in zip(*columns):
            ids = np.frombuffer(body, "<u2" if len(body) == 2 * of else "<u4")
            crcs.append(zlib.crc32(ids[low:high].astype("<u4").tobytes()))
        names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        yield batch.select(names).append_column("ids_crc32", pa.array(crcs, pa.int64()))


# --- places ---------------------------------------------------------------------------------


def on_a_line(frame: DataFrame, width: str, order: list[str], place: str, rows: int) -> tuple[DataFrame, int]:
    """Rows laid end to end: where each starts, and how long the line is. Parts of the rows are summed on their own."""
    parts = max(1, -(-rows // RANKED))
    dealt = frame.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    firsts = _firsts(dealt.groupBy("part").agg(F.sum(width).alias("n")), [], "part")
    before = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("within", F.coalesce(F.sum(width).over(before), F.lit(0)))
    laid = within.join(firsts, "part").withColumn(place, F.col("first") + F.col("within"))
    total = frame.agg(F.sum(width)).first()[0] or 0
    return laid.drop("part", "first", "within"), total


def _firsts(sums: DataFrame, by: list[str], part: str) -> DataFrame:
    """For each part of ``RANKED`` rows the sum of the parts before it."""
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")


def _seated(sent):
    """Sequence and seat of each ranked piece; a rank beyond the last slot cannot be."""

    def run(batches):
        table = sent.value
        keys = table[:, 0] << 40 | table[:, 1]
        for batch in batches:
            kind, rank = batch.column("class").to_numpy(), batch.column("rank").to_numpy()
            slot = np.searchsorted(keys, kind.astype(np.int64) << 40 | rank, side="right") - 1
            within = rank - table[slot, 1]
            names = ["row", "id", "start", "length", "ids_crc32", "doc_tokens", "class"]
            yield batch.select(names).append_column(
                "sequence_id", pa.array(table[slot, 2] + within // table[slot, 3])
            ).append_column("seat", pa.array(within % table[slot, 3]))

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    size: int = SEQUENCE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its tokens and ``end_id``; a null or empty text is the end id alone. ``size`` is a power of two. Most
    documents stay whole; some are cut to fill gaps, each id being in one piece. Where the line has fewer tokens than the
    gaps, the last gaps stay open. Repeated rows are packed as often as they come, null ids are values, and an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), text_of(text_column).alias("text")
    )
    id_type = source.schema["id"].dataType.simpleString()
    columns = f"row bigint, id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    pieces = written(source.mapInArrow(_pieces(tokenizer_path, end_id, size), f"{columns}, ids binary"), "pieces")

    # At most 4096 rows, whatever the input.
    lengths = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    share, patterns, sizes = aside(lengths, size)
    kept_aside = F.pmod(F.xxhash64("row", "start"), F.lit(SHARES)) < round(share * SHARES)
    on_line = (F.col("length") < size) & kept_aside
    seated = pieces.filter(~on_line).drop("ids").withColumn("class", _class_of(sizes))
    found = {r["class"]: r.n for r in seated.groupBy("class").agg(F.count("*").alias("n")).collect()}

    counts = np.array([found.get(c, 0) for c in range(len(sizes))], dtype=np.int64)
    plan, left = [], counts.copy()
    for pattern, use in patterns:
        times = int(use * (1 - share))
        if times:
            plan.append((pattern, times))
            left -= pattern * times
    left = np.maximum(left, 0)
    whole = np.zeros(len(sizes), dtype=np.int64)
    whole[-1], left[-1] = 1, 0
    plan += [(whole, int(counts[-1]))] if counts[-1] else []
    plan += [(pattern, 1) for pattern in best_fit(left, sizes, size)]
    table, sequences = slots(plan)

    ranked = _ranked(seated, found)
    sent = spark.sparkContext.broadcast(table)
    layout = f"{columns}, class int, sequence_id bigint, seat bigint"
    placed = ranked.mapInArrow(_seated(sent), layout) if found else ranked.selectExpr("*", "0L sequence_id", "0L seat")
    seats = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "seat")
    offset = F.coalesce(F.sum("length").over(seats.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = F.sum("length").over(Window.partitionBy("sequence_id"))
    placed = placed.withColumn("offset", offset).withColumn("used", used)
    result = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    placed = written(placed.select(*result, "used"), "seated")

    whole_power = F.expr("used & (used - 1)") == 0
    gaps = placed.filter((F.col("offset") == 0) & ~whole_power)
    gaps = gaps.select("sequence_id", "used", (size - F.col("used")).alias("gap"))
    gaps, room = on_a_line(gaps, "gap", ["sequence_id"], "from", sequences)
    line = pieces.filter(on_line)
    line, tokens = on_a_line(line, "length", ["row", "start"], "at", round(share * sum(lengths.values())))
    gaps = gaps.unionByName(_new_sequences(spark, sequences, room, max(tokens - room, 0), size))

    # Two intervals that overlap do so in the block where the later one starts.
    def in_blocks(frame, first, width):
        blocks = F.sequence(F.expr(f"{first} div {size}"), F.expr(f"({first} + {width} - 1) div {size}"))
        return frame.withColumn("block", F.explode(blocks))

    met = in_blocks(line, "at", "length").join(in_blocks(gaps, "from", "gap"), "block")
    low = F.greatest("at", "from")
    high = F.least(F.col("at") + F.col("length"), F.col("from") + F.col("gap"))
    met = met.filter((low < high) & (F.col("block") == F.floor(low / size)))
    met = met.select(
        "id",
        (F.col("start") + low - F.col("at")).alias("start"),
        (high - low).alias("length"),
        "doc_tokens",
        "sequence_id",
        (F.col("used") + low - F.col("from")).alias("offset"),
        "ids",
        F.col("length").alias("of"),
        (low - F.col("at")).alias("low"),
        (high - F.col("at")).alias("high"),
    )
    cut_layout = f"id {id_type}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids_crc32 bigint"
    cut = met.mapInArrow(_cut, cut_layout)
    return placed.select(*result).unionByName(cut.select(*result)).withColumnRenamed("id", id_column)


def _class_of(sizes: np.ndarray) -> Column:
    """Place of the smallest class that holds a length: by the length's doubling, then by steps within it."""
    starts, low = [], EXACT
    top = int(sizes[-1])
    while low < top:
        starts.append((low, int(np.searchsorted(sizes, low)), max(1, low // STEPS)))
        low *= 2
    length = F.col("length")
    found = length - 1
    for low, first, step in starts:
        found = F.when(length > low, F.lit(first) + F.ceil((length - low) / step)).otherwise(found)
    return found.cast("int")


def _ranked(seated: DataFrame, found: dict[int, int]) -> DataFrame:
    """Ranks from 0 within each class. Large classes are ranked in parts; equal rows differ in their number."""
    # As many entries as there are classes.
    large = [F.lit(x) for c, n in found.items() if n > RANKED for x in (c, -(-n // RANKED))]
    parts = F.coalesce(F.create_map(*large)[F.col("class")], F.lit(1)) if large else F.lit(1)
    salted = seated.withColumn("salt", F.pmod(F.xxhash64("row", "start"), parts).cast("int"))
    firsts = _firsts(salted.groupBy("class", "salt").agg(F.count("*").alias("n")), ["class"], "salt")
    local = F.row_number().over(Window.partitionBy("class", "salt").orderBy("row", "start")) - 1
    ranked = salted.withColumn("within", local).join(firsts, ["class", "salt"])
    return ranked.withColumn("rank", F.col("first") + F.col("within")).drop("salt", "first", "within")


def _new_sequences(spark, first: int, place: int, tokens: int, size: int) -> DataFrame:
    """Whole sequences on the rest of the line, and one for each binary digit of what is left then."""
    whole, rest = divmod(tokens, size)
    rows = spark.range(whole).select(
        (F.col("id") + first).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("used"),
        F.lit(size).cast("bigint").alias("gap"),
        (F.col("id") * size + place).alias("from"),
    )
    first, place, last = first + whole, place + whole * size, []
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            last.append((first, 0, 1 << bit, place))
            first, place = first + 1, place + (1 << bit)
    if not last:
        return rows
    return rows.union(spark.createDataFrame(last, "sequence_id bigint, used bigint, gap bigint, from bigint"))
