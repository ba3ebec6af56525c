"""Array expressions shared by the operators that use built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 512


def running_sums(inner: Column) -> Column:
    """Running sums of all elements from their running sums within blocks.

    ``inner`` must be a column already computed, as it is read twice.
    """
    zero = F.lit(0).cast("long")
    offsets = F.aggregate(
        inner,
        F.array(zero),
        lambda acc, block: F.concat(
            acc, F.array(F.element_at(acc, -1) + F.coalesce(F.try_element_at(block, F.lit(-1)), zero))
        ),
    )
    pairs = F.arrays_zip(inner.alias("block"), F.slice(offsets, 1, F.size(inner)).alias("offset"))
    return F.flatten(
        F.transform(pairs, lambda p: F.transform(p["block"], lambda x: x + p["offset"]))
    )


def block_sums(values: Column) -> Column:
    """Running sums of an array of longs within blocks: array of arrays.

    A fold that appends copies what it has, so it is kept to short blocks;
    ``running_sums`` puts the blocks together.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), (F.size(values) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(values, b * _BLOCK + 1, _BLOCK),
    )
    empty = F.array().cast("array<long>")
    zero = F.lit(0).cast("long")
    return F.transform(
        blocks,
        lambda block: F.aggregate(
            block,
            empty,
            lambda acc, x: F.concat(
                acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), zero) + x)
            ),
        ),
    )
