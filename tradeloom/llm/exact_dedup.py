"""Exact duplicates: counting quotient filters find repeated fingerprints, bytes decide.

Each partition puts the 64-bit fingerprints of its normalised texts into counting quotient filters, one
per block of the hash space: a quotient (the bits after the block's) leads to its run of sorted
remainders, each with a count. Filters of one block merge without loss: their fingerprints are read back, sorted
together, and the counts of equal remainders added. Only texts whose fingerprint has a count above one are compared byte for byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import (
    FLUSH_BYTES,
    hash_bitmap,
    in_bitmap,
    small_batches,
    text_of,
    with_rows,
    written,
)

#: Bits of the quotient within a block.
QUOTIENT_BITS = 16
#: Fingerprints expected in one block; the number of blocks follows the number of rows.
BLOCK_ROWS = 1 << 19


class QuotientFilter:
    """Runs of sorted remainders with counts. ``runs[q]`` is the length of the run of quotient ``q``."""

    def __init__(self, block_bits: int, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.block_bits, self.runs, self.remainders, self.counts = block_bits, runs, remainders, counts

    @classmethod
    def build(cls, block_bits: int, fingerprints: np.ndarray, counts: np.ndarray | None = None) -> QuotientFilter:
        """From unsigned fingerprints of one block, in any order, repeats included."""
        order = np.argsort(fingerprints, kind="stable")
        ordered = fingerprints[order]
        first = np.ones(len(ordered), dtype=bool)
        first[1:] = ordered[1:] != ordered[:-1]
        weights = np.ones(len(ordered), dtype=np.int64) if counts is None else counts[order]
        sums = np.add.reduceat(weights, np.flatnonzero(first)) if len(ordered) else weights
        unique = ordered[first]
        rest = 64 - block_bits - QUOTIENT_BITS
        quotients = (unique >> np.uint64(rest)) & np.uint64((1 << QUOTIENT_BITS) - 1)
        runs = np.bincount(quotients.astype(np.int64), minlength=1 << QUOTIENT_BITS).astype(np.uint32)
        return cls(block_bits, runs, unique & np.uint64((1 << rest) - 1), sums.astype(np.int64))

    def fingerprints(self, block: int) -> np.ndarray:
        rest = 64 - self.block_bits - QUOTIENT_BITS
        quotients = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        head = np.uint64((block << (64 - self.block_bits)) if self.block_bits else 0)
        return head | (quotients << np.uint64(rest)) | self.remainders

    def dump(self) -> tuple[bytes, bytes, bytes]:
        """Occupied quotients with run lengths, remainders, counts; empty runs take no space."""
        used = np.flatnonzero(self.runs)
        runs = np.concatenate([used.astype(np.uint32), self.runs[used]])
        return runs.tobytes(), self.remainders.tobytes(), self.counts.astype(np.uint32).tobytes()

    @classmethod
    def load(cls, block_bits: int, runs: bytes, remainders: bytes, counts: bytes) -> QuotientFilter:
        pairs = np.frombuffer(runs, dtype=np.uint32).reshape(2, -1)
        lengths = np.zeros(1 << QUOTIENT_BITS, dtype=np.uint32)
        lengths[pairs[0]] = pairs[1]
        values = np.frombuffer(remainders, dtype=np.uint64)
        return cls(block_bits, lengths, values, np.frombuffer(counts, dtype=np.uint32).astype(np.int64))

    @staticmethod
    def merge(block: int, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter with the summed counts; nothing is lost or estimated."""
        fingerprints = np.concatenate([f.fingerprints(block) for f in filters])
        return QuotientFilter.build(filters[0].block_bits, fingerprints, np.concatenate([f.counts for f in filters]))


def normalised(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def _describe(batches):
    """One row per document: its number, id, fingerprint and digest, without the text."""
    for batch in batches:
        texts = [normalised(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("id"),
                pa.array(np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64).view(np.int64)),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ],
            names=["row", "id", "fingerprint", "sha256"],
        )


def _filters(block_bits: int):
    def build(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch.column("fingerprint").to_numpy().view(np.uint64))
            size += len(held[-1])
            if size >= 1 << 20:
                yield from _blocks(np.concatenate(held), block_bits)
                held, size = [], 0
        if size:
            yield from _blocks(np.concatenate(held), block_bits)

    return build


def _blocks(fingerprints: np.ndarray, block_bits: int):
    blocks = np.zeros(len(fingerprints), dtype=np.int64)
    if block_bits:
        blocks = (fingerprints >> np.uint64(64 - block_bits)).astype(np.int64)
    order = np.argsort(blocks, kind="stable")
    bounds = np.flatnonzero(np.diff(blocks[order])) + 1
    rows = []
    for part in np.split(order, bounds):
        rows.append((int(blocks[part[0]]), *QuotientFilter.build(block_bits, fingerprints[part]).dump()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)]],
        names=["block", "runs", "remainders", "counts"],
    )


def _merge(block_bits: int):
    def merge(key, frame):
        block = int(key[0])
        parts = [QuotientFilter.load(block_bits, *r) for r in zip(frame["runs"], frame["remainders"], frame["counts"])]
        whole = QuotientFilter.merge(block, parts)
        repeated = whole.counts > 1
        return pd.DataFrame(
            {"fingerprint": whole.fingerprints(block)[repeated].view(np.int64), "copies": whole.counts[repeated]}
        )

    return merge


def repeated_fingerprints(described: DataFrame) -> DataFrame:
    """(fingerprint, copies) of the fingerprints that more than one row has."""
    rows = described.count()
    block_bits = max(0, (rows // BLOCK_ROWS).bit_length())
    filters = described.select("fingerprint").mapInArrow(
        _filters(block_bits), "block int, runs binary, remainders binary, counts binary"
    )
    return filters.groupBy("block").applyInPandas(_merge(block_bits), "fingerprint bigint, copies bigint")


def _suspects(bitmap):
    """Normalised texts whose fingerprint may be repeated, repeats within a task already counted."""

    def pick(batches):
        held: dict[tuple[int, bytes], int] = {}
        size = 0
        for batch in small_batches(batches):
            texts = [normalised(t) for t in batch.column("text").to_pylist()]
            prints = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64)
            for i in np.flatnonzero(in_bitmap(bitmap, prints)):
                key = (int(prints[i].view(np.int64)), texts[i])
                if key not in held:
                    held[key] = 0
                    size += len(texts[i]) + 100
                held[key] += 1
            if size >= FLUSH_BYTES:
                yield rows(held)
                held, size = {}, 0
        if held:
            yield rows(held)

    def rows(held):
        keys = list(held)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.int64()),
                pa.array([hashlib.sha256(k[1]).hexdigest() for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.binary()),
            ],
            names=["fingerprint", "sha256", "body"],
        )

    return pick


def decisions(numbered: DataFrame) -> DataFrame:
    """(row, id, keep_id, group_size, kept, text_sha256) from (row, id, text), row numbers being unique."""
    spark = numbered.sparkSession
    id_type = numbered.schema["id"].dataType.simpleString()
    described = written(
        numbered.select("row", "id", "text").mapInArrow(
            _describe, f"row bigint, id {id_type}, fingerprint bigint, sha256 string"
        ),
        "dedup-rows",
    )
    repeated = written(repeated_fingerprints(described), "dedup-repeated")

    # The bitmap only spares unique texts the way; the join and the comparison of bytes are exact.
    bitmap = spark.sparkContext.broadcast(hash_bitmap(repeated, "fingerprint"))

    def pick(batches):
        return _suspects(bitmap.value)(batches)

    suspects = numbered.select("text").mapInArrow(pick, "fingerprint bigint, sha256 string, body binary")
    compared = (
        suspects.groupBy("fingerprint", "sha256", "body")
        .agg(F.lit(1).alias("one"))
        .groupBy("fingerprint", "sha256")
        .agg(F.count("one").alias("bodies"))
    )
    # Two different texts with the same SHA-256 have never been seen; if they are, say so and stop.
    proven = compared.select(
        "fingerprint",
        F.when(F.col("bodies") == 1, F.col("sha256"))
        .otherwise(F.raise_error(F.lit("two texts share a fingerprint and a SHA-256")).cast("string"))
        .alias("sha256"),
    )
    candidates = described.join(repeated.select("fingerprint"), "fingerprint", "left_semi")
    groups = (
        candidates.groupBy("fingerprint", "sha256")
        .agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("size"))
        .filter("size > 1")
        .join(proven, ["fingerprint", "sha256"], "left_semi")
    )
    joined = described.join(groups, ["fingerprint", "sha256"], "left")
    return joined.select(
        "row",
        "id",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("last.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest id
    stays; a null id is the smallest, and of rows that are equal in id and text exactly one stays. A null
    text is empty, and all empty texts are one group. An empty table gives no rows.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), text_of(text_column).alias("text")
    )
    return decisions(numbered).drop("row").withColumnRenamed("id", id_column)


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    Of equal texts, a null one being empty, the row with the largest id stays, a null id being the least; of equal ids one
    row stays. An empty table stays empty.
    """
    numbered, name = with_rows(docs, "dedup-documents")
    found = decisions(
        numbered.select(F.col(name).alias("row"), F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    )
    kept = found.filter("kept").select(F.col("row").alias(name))
    return numbered.join(kept, name, "left_semi").select(*docs.columns)
