"""Which parts may hold an id: a Bloom filter per part, kept beside it as rows and met by a join.

An id falls into one block of eight 64-bit words and sets one bit in each. The blocks of a part follow its number of
ids, so a filter takes three to six bytes an id at any size, is built by one aggregation with partial ``bit_or`` and is
never gathered anywhere. It says yes to fewer than one absent id in a thousand and never no to a present one; an
exact join on the ids it lets through follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 8
#: Most ids a block is meant for on average; as blocks come in powers of two, it is half of this at least.
IDS_A_BLOCK = 24

_NAMES = [f"word{i}" for i in range(WORDS)]
_SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in ["block", *_NAMES]] + [T.StructField("part", T.StringType())]
)


def blocks_for(ids: int) -> int:
    """A power of two, or 0 for no ids."""
    return 1 << (-(-ids // IDS_A_BLOCK) - 1).bit_length() if ids else 0


def _block(key: str, blocks: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 1).bitwiseAND(blocks - 1)


def _bits(key: str) -> Column:
    return F.xxhash64(key, F.lit("bits"))


def _masks(bits: Column) -> list[Column]:
    """One bit of each word, from a second hash."""
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]


class IdFilters:
    def __init__(self, path: str, key: str = "event_id"):
        self.path, self.key = path, key

    def write(self, ids: DataFrame, part: str) -> int:
        """Keep the filter of a part's ids; returns its blocks. Repeated ids change nothing, NULLs are not kept.

        Ids of a part hardly ever share a block within a task, so two numbers an id are shuffled and words are made after it.
        """
        ids = ids.select(self.key).filter(F.col(self.key).isNotNull())
        blocks = blocks_for(ids.count())
        if blocks:
            placed = ids.select(_block(self.key, F.lit(blocks).cast("bigint")).alias("block"), _bits(self.key).alias("bits"))
            folds = [F.bit_or(mask).alias(name) for name, mask in zip(_NAMES, _masks(F.col("bits")))]
            words = placed.repartition("block").groupBy("block").agg(*folds)
            words.write.parquet(f"{self.path}/part={part}")
        return blocks

    def candidates(self, spark: SparkSession, ids: DataFrame, blocks: dict[str, int]) -> DataFrame:
        """(part, id) wherever a part may hold one of these ids. ``blocks``: what ``write`` returned per part.

        The list of parts grows with the logarithm of the batches; the join is on the part and the block.
        """
        held = {part: n for part, n in blocks.items() if n}
        if not held:
            return ids.select(F.lit("").alias("part"), self.key).limit(0)
        parts = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(n).cast("bigint").alias("n")) for p, n in held.items()])
        asked = ids.select(self.key, F.inline(parts)).select(
            "part", self.key, _block(self.key, F.col("n")).alias("block")
        )
        folders = [f"{self.path}/part={part}" for part in held]
        filters = spark.read.schema(_SCHEMA).option("basePath", self.path).parquet(*folders)
        # The masks follow from the id, so they are made after the shuffle.
        found = asked.join(filters, ["part", "block"])
        for name, mask in zip(_NAMES, _masks(_bits(self.key))):
            found = found.filter(F.col(name).bitwiseAND(mask) != 0)
        return found.select("part", self.key)
