"""Group-bys over every subset of a dimension list.

The state of every cuboid is computed from the base cuboid (the group-by on
all dimensions), never from the rows: the rows are read and shuffled once,
already reduced by map-side aggregation. The base cuboid is rolled up in two
steps, half of the dimensions at a time. Six dimensions then expand each row
8 + 8 times instead of 64 times.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import measure_state, merge_state
from ..functions.naming import cuboid_names, mask_dimensions, power_set
from .columns import filter_equal

MASK = "cuboid_mask"


def cuboid(df: DataFrame, dims: Sequence[str], measure: str) -> DataFrame:
    """State of one subset of dimensions; no rows for empty input, also without dimensions."""
    if dims:
        return df.groupBy(*dims).agg(*measure_state(measure))
    return df.agg(*measure_state(measure)).where(F.col("count") > 0)


def kept_bits(dims: Sequence[str], grouped: Sequence[str]) -> Column:
    """Mask bits of the ``grouped`` dimensions that are not rolled up in a grouping-sets row."""
    bits = [(F.lit(1) - F.grouping(d)).cast("int") * F.lit(1 << dims.index(d)) for d in grouped]
    return reduce(lambda a, b: a + b, bits)


def roll_up(state: DataFrame, dims: Sequence[str], rolled: Sequence[str]) -> DataFrame:
    """Add the rows in which any of the ``rolled`` dimensions is aggregated away."""
    fixed = [MASK, *[d for d in dims if d not in rolled]]
    sets = [[*fixed, *subset] for subset in power_set(rolled)]
    grouped = state.groupingSets(sets, *fixed, *rolled).agg(
        *merge_state(), kept_bits(dims, rolled).alias("_bits")
    )
    mask = (F.col(MASK) + F.col("_bits")).alias(MASK)
    return grouped.select(mask, *dims, *[c for c in state.columns if c not in (MASK, *dims)])


def cube_of_base(base: DataFrame, dims: Sequence[str]) -> DataFrame:
    """All cuboids from the state of the full group-by."""
    state = base.select(F.lit(0).alias(MASK), *base.columns)
    half = (len(dims) + 1) // 2
    for rolled in (dims[:half], dims[half:]):
        if rolled:
            state = roll_up(state, dims, rolled)
    return state


def full_cube(df: DataFrame, dims: Sequence[str], measure: str) -> DataFrame:
    """State of all 2^n cuboids: ``cuboid_mask``, the dimensions, the state columns.

    A rolled-up dimension is NULL; the mask tells it from a NULL value.
    """
    return cube_of_base(cuboid(df, dims, measure), list(dims))


def grouping_sets_cube(
    df: DataFrame, dims: Sequence[str], subsets: Sequence[Sequence[str]], measure: str
) -> DataFrame:
    """Only the listed cuboids, from the same base."""
    dims = list(dims)
    base = cuboid(df, dims, measure)
    grouped = base.groupingSets([list(s) for s in subsets], *dims).agg(
        kept_bits(dims, dims).alias(MASK), *merge_state()
    )
    return grouped.select(MASK, *dims, *[c for c in base.columns if c not in dims])


def with_names(cube: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Add ``cuboid_name``. The lookup has 2^n rows, so it is broadcast."""
    names = list(enumerate(cuboid_names(dims)))
    lookup = cube.sparkSession.createDataFrame(names, f"{MASK} int, cuboid_name string")
    return cube.join(F.broadcast(lookup), MASK)


def one_cuboid(cube: DataFrame, dims: Sequence[str], mask: int) -> DataFrame:
    """The rows and dimensions of one cuboid of a cube."""
    kept = mask_dimensions(dims, mask)
    rest = [c for c in cube.columns if c not in (MASK, *dims)]
    return cube.where(F.col(MASK) == mask).select(*kept, *rest)


def key_order(dims: Sequence[str]) -> Column:
    """Sort key of exported groups: the bytes of the values joined by a bar."""
    return F.concat_ws("|", *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dims])


def lookup(cube: DataFrame, dims: Sequence[str], key: dict[str, object]) -> DataFrame:
    """The row of one group; ``key`` names the cuboid by the dimensions it gives."""
    mask = sum(1 << i for i, d in enumerate(dims) if d in key)
    return filter_equal(cube.where(F.col(MASK) == mask), key).limit(1)


def merge_states(states: DataFrame, dims: Sequence[str]) -> DataFrame:
    """One row per group, with the states of rows of the same group merged."""
    return states.groupBy(MASK, *dims).agg(*merge_state())


def merge_cubes(old: DataFrame, delta: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Groups of both cubes, with the states of common groups merged."""
    return merge_states(old.unionByName(delta), dims)
