"""Mixing sources to target weights by the cube method of balanced sampling.

A source's target over its size is the number of copies each of its documents should get. The whole part
is given to all; the fractional part is an inclusion probability. The flight moves the probabilities of
three documents at a time along the vector that keeps both the token and the document total of the source,
until one of them is 0 or 1. Blocks fly on their own and hand on the two or three documents
they cannot decide; these fly again, until a source fits one block and the last few documents land where
the totals stay nearest.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import numbered, text_of, with_rows, written

#: Documents of a block, that is of one flight in one task.
BLOCK = 4096
#: Documents that wait for the landing of a source, besides the two or three that the flight leaves.
LANDING = 12
WORDS = r"[^\x20\x09-\x0D]+"
_TINY = 1e-9


# --- targets --------------------------------------------------------------------------------


def targets(sources: DataFrame, share: float, limit: float) -> DataFrame:
    """Add ``target`` to (source, weight, source_size): ``share`` of all sizes dealt by weight, capped.

    A target stops at ``limit`` times its source's size; what it leaves is dealt among the others by
    weight, until none is above. Only the level, target over weight, meets the driver.
    """
    cap = F.col("source_size") * F.lit(limit)
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = None
    while True:
        full = F.lit(False) if level is None else cap < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)
        ).first()
        if not row[1]:
            return sources.withColumn("target", cap.cast("double"))
        new = (total - row[0]) / row[1]
        if level is not None and row[2] == before:
            break
        level, before = new, row[2]
        if row[2] == 0 and total == 0:
            break
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(float(new))).cast("double"))


# --- the cube -------------------------------------------------------------------------------


def flight(sizes: list[float], chances: list[float], rng: random.Random) -> list[float]:
    """Move chances to 0 or 1, keeping sum(chance) and sum(size * chance); at most three stay between."""
    chances = list(chances)
    active: list[int] = []
    for unit in range(len(chances)):
        if _TINY < chances[unit] < 1 - _TINY:
            active.append(unit)
        if len(active) == 3:
            a, b, c = active
            _move(chances, active, (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b]), rng)
            active = [u for u in active if _TINY < chances[u] < 1 - _TINY]
    if len(active) == 2 and sizes[active[0]] == sizes[active[1]]:
        _move(chances, active, (1.0, -1.0), rng)
    return chances


def _move(chances: list[float], units: list[int], direction: tuple, rng: random.Random) -> None:
    if not any(direction):
        direction = (1.0, -1.0, 0.0)
    up, down = float("inf"), float("inf")
    for unit, step in zip(units, direction):
        if step:
            room, back = (1 - chances[unit], chances[unit]) if step > 0 else (chances[unit], 1 - chances[unit])
            up, down = min(up, room / abs(step)), min(down, back / abs(step))
    # The two ends are taken with the odds that keep the expectation of every chance.
    move = up if rng.random() * (up + down) < down else -down
    for unit, step in zip(units, direction):
        chance = chances[unit] + move * step
        chances[unit] = 0.0 if chance < _TINY else 1.0 if chance > 1 - _TINY else chance


def landing(sizes: list[float], chances: list[float]) -> list[float]:
    """Round the few chances that are left so that the token and the document total move least."""
    units = [i for i, c in enumerate(chances) if _TINY < c < 1 - _TINY]
    size, chance = np.array([sizes[i] for i in units]), np.array([chances[i] for i in units])
    ends = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
    tokens = np.abs((ends - chance) @ size) / max(size.mean(), 1.0) if units else np.zeros(1)
    documents = np.abs((ends - chance).sum(axis=1))
    chances = list(chances)
    # A hundredth of a mean document in tokens weighs as much as a whole document in the count.
    for i, x in zip(units, ends[int((100 * tokens + documents).argmin())]):
        chances[i] = float(x)
    return chances


def reserve(n: int) -> list[int]:
    """Places, in order of falling size, that wait for the landing: the largest documents and some of all sizes.

    The flight would carry the largest ones to its end, where they cost most; these can make up for them.
    """
    largest = min(n, LANDING // 2)
    spread = np.linspace(largest, n - 1, min(n - largest, LANDING - largest)).astype(int)
    return [*range(largest), *np.unique(spread).tolist()]


def _fly(seed: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # Large documents first: those that stay open are then small, and so is the landing's error.
        frame = frame.sort_values(["size", "spread", "row"], ascending=[False, True, True], kind="stable")
        sizes, chances = frame["size"].astype(float).tolist(), frame["chance"].tolist()
        rng = random.Random(seed ^ int(np.bitwise_xor.reduce(frame["spread"].to_numpy())))
        last = bool(frame["last"].iloc[0])
        held = set(reserve(len(chances)) if last else ())
        flying = [i for i in range(len(chances)) if i not in held]
        moved = flight([sizes[i] for i in flying], [chances[i] for i in flying], rng)
        for i, chance in zip(flying, moved):
            chances[i] = chance
        if last:
            chances = landing(sizes, chances)
        return pd.DataFrame({"row": frame["row"], "chance": np.array(chances)})

    return run


def balanced_sample(units: DataFrame, seed: int) -> DataFrame:
    """(row, chance) with every chance 0 or 1, from (row, stratum, size, spread, chance), balanced per stratum."""
    decided, left = None, units.filter("chance > 0 AND chance < 1")
    while True:
        strata = left.groupBy("stratum").agg(F.ceil(F.count("*") / BLOCK).cast("bigint").alias("blocks"))
        # One key for a block: the blocks of a source that the join has brought together are dealt out again.
        block = F.concat_ws(":", F.col("stratum"), F.pmod(F.col("spread"), F.col("blocks")))
        dealt = left.join(strata, "stratum").select("*", block.alias("block"), (F.col("blocks") == 1).alias("last"))
        flown = dealt.groupBy("block").applyInPandas(_fly(seed), "row bigint, chance double")
        done = written(left.drop("chance").join(flown, "row"), "cube")
        final = done.filter("chance IN (0, 1)").select("row", "chance")
        decided = final if decided is None else decided.union(final)
        left = done.filter("chance > 0 AND chance < 1")
        if left.isEmpty():
            return decided


def _default_weight() -> Column:
    return F.element_at(F.array(F.lit(5), F.lit(2), F.lit(1)), (F.col("number") % 3 + 1).cast("int"))


def plan(sized: DataFrame, weights: Column | None, share: float, limit: float, seed: int) -> DataFrame:
    """(row, id, size, source_size, target, copies) from written (row, id, source, size, digest)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = numbered(sums, [F.col("source").asc_nulls_last()], "number", "mix-sources")
    weight = (_default_weight() if weights is None else weights).cast("double")
    planned = written(targets(ordered.withColumn("weight", weight), share, limit), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    planned = planned.select(
        F.col("source").alias("from"), "number", "source_size", "target", ratio.alias("ratio")
    ).withColumn("whole", F.floor(F.col("ratio") + _TINY))
    spread = F.shiftrightunsigned(F.xxhash64("id", "digest", "size", F.lit(seed)), 1)
    units = written(
        sized.join(planned, F.col("source").eqNullSafe(F.col("from"))).select(
            "row",
            "id",
            "size",
            "source_size",
            "target",
            "whole",
            F.col("number").alias("stratum"),
            spread.alias("spread"),
            F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0)).alias("chance"),
        ),
        "mix-units",
    )
    chosen = balanced_sample(units.select("row", "stratum", "size", "spread", "chance"), seed)
    copies = (F.col("whole") + F.coalesce(F.col("picked"), F.lit(0.0))).cast("bigint")
    return units.join(chosen.withColumnRenamed("chance", "picked"), "row", "left").select(
        "row", "id", "size", "source_size", "target", copies.alias("copies")
    )


def _sized(numbered_docs: DataFrame) -> DataFrame:
    """(row, id, source, size, digest) from (row, id, source, text)."""
    size = F.regexp_count("text", F.lit(WORDS)).cast("bigint")
    return written(
        numbered_docs.select("row", "id", "source", size.alias("size"), F.xxhash64("text").alias("digest")), "mix-sizes"
    )


def mix(
    docs: DataFrame,
    weights: Column | None = None,
    share: float = 1.5,
    limit: float = 2.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 7,
) -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target, copies, taken.

    Size counts the words of a text, a null text has none. ``weights`` is an expression over ``number``, a
    source's place in code-point order from 0, null last; by default 5, 2, 1, repeating. ``copies`` times
    the size is ``taken``, the words the mix takes; a document gets the whole part of its source's ratio or
    one more. A source without words has target 0 and its documents one copy each. The choice depends on
    ids, texts and the seed only; rows that are equal in all of them are interchangeable. An empty table
    gives no rows.
    """
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        text_of(text_column).alias("text"),
    )
    planned = plan(_sized(source), weights, share, limit, seed)
    return planned.select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Column | None = None,
    share: float = 1.5,
    limit: float = 2.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 7,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it has copies, with all its columns, whatever their names.

    Null ids, sources and texts are values like others, and empty texts have no words, as in ``mix``. Repeated rows have
    copies each for itself. An empty table stays empty.
    """
    held, name = with_rows(docs, "mix-documents")
    source = held.select(
        F.col(name).alias("row"),
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        text_of(text_column).alias("text"),
    )
    planned = plan(_sized(source), weights, share, limit, seed)
    times = f"{name}_copies"
    while times in held.columns:
        times = f"_{times}"
    copies = planned.filter("copies > 0").select(F.col("row").alias(name), F.col("copies").alias(times))
    repeated = held.join(copies, name).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(*docs.columns)
