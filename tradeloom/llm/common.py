"""What the operators share: written intermediates, ASCII words, fixed-size bitmaps, ordered blocks.

Conventions of all operators: a null text counts as empty, a null id is a value like any other, extra
columns are ignored (operators read the columns they are told to), and an empty table gives an empty
result with the same columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import configure, scratch_dir, ship_package

#: Bytes of text after which a task hands on what it has gathered; bounds a task's memory.
FLUSH_BYTES = 16 << 20
#: Bytes of one Arrow batch between Spark and a Python worker.
ARROW_BYTES = 8 << 20
#: 2^24 bits, 2 MB: the size of every bitmap that is sent to all tasks, whatever it describes.
BITMAP_BITS = 24


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, the package on its executors, and Arrow batches of a bounded size."""
    ship_package(configure(spark))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def written(frame: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back: it is computed once and outlives executors."""
    folder = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def with_rows(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows with a number each, written so that every later step sees the same numbers; and its column."""
    name = "row"
    while name in docs.columns:
        name = f"_{name}"
    return written(docs.withColumn(name, F.monotonically_increasing_id()), label), name


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_words(text: str) -> list[bytes]:
    """Lower-cased (A-Z only) words between the six ASCII white-space characters, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in slices, so that one Arrow batch of long texts is not unpacked at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def hash_bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the top 24 bits of 64-bit hashes: 2 MB at the driver for any number of hashes.

    It may say yes to a hash that is not there, never no to one that is; exact steps follow it.
    """
    # Spark's bitmap functions count positions from 1.
    position = F.shiftrightunsigned(F.col(column), 64 - BITMAP_BITS) + 1
    rows = (
        hashes.select(position.alias("at"))
        .groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
        .collect()
    )
    bitmap = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    for row in rows:
        bitmap[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(bytes(row.bits), dtype=np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned hashes the bitmap may hold."""
    top = (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
    return ((bitmap[top >> 3] >> (top & 7).astype(np.uint8)) & 1).astype(bool)


def numbered(frame: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Rows with consecutive numbers from 0 in a total order, without gathering them in one task.

    The sorted rows are written with Spark's per-partition numbers; only one count per partition meets
    at the driver.
    """
    local = written(frame.sort(*order).withColumn(name, F.monotonically_increasing_id()), label)
    part = F.shiftright(F.col(name), 33)
    counts = {r.part: r.n for r in local.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    shift, total = [], 0
    for p in sorted(counts):
        shift += [F.lit(p), F.lit((p << 33) - total)]
        total += counts[p]
    if not shift:
        return local
    return local.withColumn(name, F.col(name) - F.create_map(*shift)[part])
