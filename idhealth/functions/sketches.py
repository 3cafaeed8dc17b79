"""FNV-1a hashes and 16-register distinct-count sketches; mergeable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGISTERS, ALPHA, LINEAR_BELOW = 16, 0.673, 40.0


def fnv64(text: Column) -> Column:
    """FNV-1a of the UTF-8 bytes as struct<hi, lo> of 32 bits each; in two limbs, as 64-bit products would overflow."""
    bytes_ = F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit("(..)"), F.lit(1))
    mask = F.lit(0xFFFFFFFF)

    def step(h: Column, b: Column) -> Column:
        lo = h["lo"].bitwiseXOR(F.conv(b, 16, 10).cast("long"))
        p = lo * 435
        hi = (h["hi"] * 435 + F.shiftright(p, 32) + F.shiftleft(lo, 8).bitwiseAND(mask)).bitwiseAND(mask)
        return F.struct(hi.alias("hi"), p.bitwiseAND(mask).alias("lo"))

    start = F.struct(F.lit(0xCBF29CE4).alias("hi"), F.lit(0x84222325).alias("lo"))
    return F.aggregate(bytes_, start, step)


def trailing_zeroes(x: Column) -> Column:
    return F.bit_count(x.bitwiseAND(-x) - 1)


def register_of(h: Column) -> Column:
    """Register (from the high half, folded) and rank (trailing zeroes plus 1) of a hash."""
    b = h["hi"]
    for s in (8, 16, 24):
        b = b.bitwiseXOR(F.shiftright(h["hi"], s))
    bucket = b.bitwiseXOR(F.shiftright(b, 4)).bitwiseAND(F.lit(15)).cast("int")
    rank = F.when(h["lo"] != 0, trailing_zeroes(h["lo"]) + 1).when(h["hi"] != 0, trailing_zeroes(h["hi"]) + 33).otherwise(65)
    return F.struct(bucket.alias("bucket"), rank.cast("int").alias("rank"))


def registers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, registers array<int>): the greatest rank of each register."""
    r = df.select(*keys, F.explode(F.array(register_of(fnv64(F.col(value).cast("string"))))).alias("r"))
    cols = [F.coalesce(F.max(F.when(F.col("r.bucket") == i, F.col("r.rank"))), F.lit(0)).alias(f"r{i}") for i in range(REGISTERS)]
    return r.groupBy(*keys).agg(*cols).select(*keys, F.array(*[F.col(f"r{i}") for i in range(REGISTERS)]).alias("registers"))


def merge_registers(df: DataFrame, keys: Sequence[str], column: str = "registers") -> DataFrame:
    cols = [F.max(F.get(F.col(column), F.lit(i))).alias(f"r{i}") for i in range(REGISTERS)]
    return df.groupBy(*keys).agg(*cols).select(*keys, F.array(*[F.col(f"r{i}") for i in range(REGISTERS)]).alias(column))


def estimate(column: Column) -> Column:
    """Distinct count of a sketch: harmonic mean, or linear counting while it is small and registers are empty."""
    total = F.aggregate(column, F.lit(0.0), lambda a, x: a + F.pow(F.lit(2.0), -x.cast("double")))
    raw = F.lit(ALPHA * REGISTERS * REGISTERS) / total
    empty = F.size(F.filter(column, lambda x: x == 0))
    return F.when((raw < LINEAR_BELOW) & (empty > 0), REGISTERS * F.log(F.lit(float(REGISTERS)) / empty)).otherwise(raw)


#: Base-2 logarithm of a binary sketch's buckets, and its relative standard error, of single sketches and of unions.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / (1 << SKETCH_BITS) ** 0.5


def sketch_levels(df: DataFrame, levels: Sequence[Sequence[str]], value: str) -> list[DataFrame]:
    """Binary HLL sketches of distinct values at each level, finest first; every coarser one is the union of the level below, so the rows are read once.

    Each table has the level's keys, `sketch` (mergeable later on too) and `estimate`. Null values don't count.
    """
    out = []
    for keys in levels:
        agg = F.hll_sketch_agg(value, F.lit(SKETCH_BITS)) if not out else F.hll_union_agg("sketch")
        at = (out[-1] if out else df).groupBy(*keys).agg(agg.alias("sketch"))
        out.append(at.withColumn("estimate", F.hll_sketch_estimate("sketch")))
    return out


def estimated_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, both): how many values two sketched sets have in common, estimated as the sum less the union; 0 at least. Its error is that of the union, not of the overlap."""
    pair = a.select(*keys, F.col("sketch").alias("a_"), F.col("estimate").alias("ea_")).join(b.select(*keys, F.col("sketch").alias("b_"), F.col("estimate").alias("eb_")), list(keys))
    return pair.select(*keys, F.greatest(F.lit(0), F.col("ea_") + F.col("eb_") - F.hll_sketch_estimate(F.hll_union("a_", "b_"))).alias("both"))
