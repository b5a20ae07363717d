"""Near duplicates by SimHash: Golay codes turn close fingerprints into equal keys.

A 64-bit fingerprint has two segments of 23 bits and one of 18 (filled up with zeros). The perfect Golay
code [23, 12, 7] decodes a segment to codewords; the indices of all codewords within four bits are its
keys: one for 277 of 2048 cosets, six for the others. Two segments that differ in at most two bits always share a
key, namely the codeword nearest to a word between them.

Pigeonhole for at most four differing bits over the segments (x, y, z):

* at most two in x and two in y: they share a key of x and a key of y;
* three or more in x, so at most one in y and z together: y is equal and z shares a key, or z is equal
  and y shares one;
* three or more in y: likewise with x and z.

So rows are joined on five kinds of keys, and every pair found is verified by its bit distance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import ascii_words, small_batches, text_of, with_rows, written
from tradeloom.llm.components import components

SEED = 42
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
#: Fingerprints of one key that a task compares on its own; larger keys are dealt out in cells.
GROUP_ROWS = 4096
#: Up to this size groups are compared side by side, without a loop over groups.
SMALL_GROUP = 32


# --- fingerprints ---------------------------------------------------------------------------


def simhash(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes, repeats included."""
    words = ascii_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[: -shingle_words]])
    ends = ends[shingle_words - 1 :] - 1
    total, counts = len(starts), np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words: int):
    def run(batches):
        for batch in small_batches(batches):
            prints = [simhash(t, shingle_words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))],
                names=["row", "id", "print"],
            )

    return run


# --- Golay keys -----------------------------------------------------------------------------


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def _errors() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome the error patterns of weight up to four, padded to six, and how many they are."""
    patterns = np.array([sum(1 << b for b in c) for w in range(5) for c in combinations(range(23), w)], dtype=np.int64)
    table, sizes = np.zeros((2048, 6), dtype=np.int64), np.zeros(2048, dtype=np.int64)
    for pattern, syndrome in zip(patterns.tolist(), syndromes(patterns).tolist()):
        table[syndrome, sizes[syndrome]] = pattern
        sizes[syndrome] += 1
    return table, sizes


ERRORS, ERROR_COUNTS = _errors()


def codeword_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """12-bit indices of the codewords within four bits of each word: (n, 6) and which of them count."""
    syndrome = syndromes(words)
    keys = (words.astype(np.int64)[:, None] ^ ERRORS[syndrome]) >> 11
    return keys, np.arange(6)[None, :] < ERROR_COUNTS[syndrome][:, None]


def linking_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, index into ``prints``): fingerprints within four bits share at least one key."""
    x = (prints & np.uint64((1 << 23) - 1)).astype(np.int64)
    y = ((prints >> np.uint64(23)) & np.uint64((1 << 23) - 1)).astype(np.int64)
    z = (prints >> np.uint64(46)).astype(np.int64)
    (kx, mx), (ky, my), (kz, mz) = (codeword_keys(s) for s in (x, y, z))
    found = []
    rows, i, j = np.nonzero(mx[:, :, None] & my[:, None, :])
    found.append((kx[rows, i] << 12 | ky[rows, j], rows))
    for kind, (exact, keys, mask) in enumerate([(y, kz, mz), (z, ky, my), (x, kz, mz), (z, kx, mx)], start=1):
        rows, i = np.nonzero(mask)
        found.append((np.int64(kind) << 40 | exact[rows] << 12 | keys[rows, i], rows))
    return np.concatenate([k for k, _ in found]), np.concatenate([r for _, r in found])


def _keyed(batches):
    for batch in small_batches(batches, 8192):
        prints = batch.column("print").to_numpy()
        keys, rows = linking_keys(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], names=["key", "print"])


# --- links ----------------------------------------------------------------------------------


def _close(left: np.ndarray, right: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(left ^ right) <= distance


def spanning_links(prints: np.ndarray, distance: int = MAX_DISTANCE) -> list[tuple[int, int]]:
    """Links that connect what is connected within the group: at most one per fingerprint."""
    links, rest = [], prints
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = _close(rest, at, distance)
            if near.any():
                reached = rest[near]
                links += [(at, other) for other in reached]
                queue += list(reached)
                rest = rest[~near]
    return links


def _group_links(keys: np.ndarray, prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning links of many groups; ``keys`` is sorted."""
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
    sizes = np.diff(bounds)
    linked = sizes > SMALL_GROUP
    group = np.repeat(np.arange(len(sizes)), sizes)
    small = sizes[~linked]
    for shift in range(1, int(small.max(initial=1))):
        same = np.flatnonzero(keys[:-shift] == keys[shift:])
        same = same[~linked[group[same]]]
        hits = same[_close(prints[same], prints[same + shift], distance)]
        linked[group[hits]] = True
    links = []
    for g in np.flatnonzero(linked):
        links += spanning_links(prints[bounds[g] : bounds[g + 1]], distance)
    return links


def _link_rows(links, hot_keys=(), hot_prints=()):
    a = np.array([p[0] for p in links], dtype=np.uint64).view(np.int64)
    b = np.array([p[1] for p in links], dtype=np.uint64).view(np.int64)
    hot_keys, hot_prints = np.asarray(hot_keys, np.int64), np.asarray(hot_prints, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([a, hot_keys])),
            pa.array(np.concatenate([b, hot_prints])),
            pa.array(np.concatenate([np.zeros(len(a), bool), np.ones(len(hot_keys), bool)])),
        ],
        names=["a", "b", "hot"],
    )


def _sorted_links(distance: int):
    """Over rows sorted by key: links of the groups that end here; groups that are too large pass on whole.

    A passed-on row is (key, print, hot); at no time are more than ``GROUP_ROWS`` of a group held.
    """

    def run(batches):
        keys, prints, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            new_keys, new_prints = batch.column("key").to_numpy(), batch.column("print").to_numpy().view(np.uint64)
            if hot is not None:
                more = int(np.searchsorted(new_keys, hot, side="right"))
                if more:
                    yield _link_rows([], new_keys[:more], new_prints[:more])
                new_keys, new_prints = new_keys[more:], new_prints[more:]
                if not len(new_keys):
                    continue
                hot = None
            keys, prints = np.concatenate([keys, new_keys]), np.concatenate([prints, new_prints])
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            yield from _whole_groups(keys[:last], prints[:last], distance)
            keys, prints = keys[last:], prints[last:]
            if len(keys) > GROUP_ROWS:
                hot = keys[0]
                yield _link_rows([], keys, prints)
                keys, prints = keys[:0], prints[:0]
        yield from _whole_groups(keys, prints, distance)

    return run


def _whole_groups(keys, prints, distance):
    if len(keys):
        _, at, sizes = np.unique(keys, return_inverse=True, return_counts=True)
        large = sizes[at] > GROUP_ROWS
        links = _group_links(keys[~large], prints[~large], distance) if not large.all() else []
        yield _link_rows(links, keys[large], prints[large])


def _cell_links(distance: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        prints = frame["print"].to_numpy().view(np.uint64)
        links = spanning_links(np.unique(prints), distance)
        return pd.DataFrame(np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return run


def links_between(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b) over distinct fingerprints ``print``: connects exactly those that chains of close pairs connect.

    Large keys are split in chunks, and each pair of chunks is a cell of its own, so no task ever holds
    more than two chunks.
    """
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError("the keys reach up to four differing bits")
    spark = prints.sparkSession
    keyed = prints.mapInArrow(_keyed, "key bigint, print bigint")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = written(
        keyed.repartition(parts, "key")
        .sortWithinPartitions("key")
        .mapInArrow(_sorted_links(distance), "a bigint, b bigint, hot boolean"),
        "simhash-links",
    )
    hot = found.filter("hot").select(F.col("a").alias("key"), F.col("b").alias("print"))
    chunks = hot.groupBy("key").agg(F.ceil(F.count("*") / (GROUP_ROWS // 2)).cast("int").alias("chunks"))
    cells = (
        hot.join(chunks, "key")
        .withColumn("mine", F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int"))
        .select("key", "print", "mine", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .filter("mine <> other")
        .select("key", "print", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )
    dealt = cells.groupBy("key", "i", "j").applyInPandas(_cell_links(distance), "a bigint, b bigint")
    return found.filter("NOT hot").select("a", "b").union(dealt)


def groups(numbered: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """(row, id, print, root) from (row, id, text); rows with equal roots are one group."""
    id_type = numbered.schema["id"].dataType.simpleString()
    rows = written(
        numbered.select("row", "id", "text").mapInArrow(
            _fingerprints(shingle_words), f"row bigint, id {id_type}, print bigint"
        ),
        "simhash",
    )
    roots = components(links_between(rows.select("print").distinct(), distance))
    return rows.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "row", "id", "print", F.coalesce("root", "print").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id reachable over links).

    Texts of fewer words than a shingle hash as a whole; empty and null texts have fingerprint zero and are
    linked like any other. A null id is a component's id only if all its ids are null. Repeated rows are in
    one component. An empty table gives no rows.
    """
    numbered = docs.select(
        F.lit(0).cast("bigint").alias("row"), F.col(id_column).alias("id"), text_of(text_column).alias("text")
    )
    found = groups(numbered, shingle_words, distance)
    least = found.groupBy("root").agg(F.min("id").alias("component"))
    return found.join(least, "root").select(
        F.col("id").alias(id_column),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row of each group, that with the smallest id (a null id only if there is no other), with all its columns."""
    numbered, name = with_rows(docs, "simhash-documents")
    found = groups(
        numbered.select(F.col(name).alias("row"), F.col(id_column).alias("id"), text_of(text_column).alias("text")),
        shingle_words,
        distance,
    )
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "row")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.row").alias(name))
    return numbered.join(kept, name, "left_semi").select(*docs.columns)
