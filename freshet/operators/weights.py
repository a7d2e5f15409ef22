"""Area-weighted aggregation of cells to catchments, with an explicit policy for missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("propagate", "skip", "renormalize", "zero")


def weighted(value: str, weight: str, policy: str) -> Column:
    """An aggregate over (value, weight).

    propagate: a missing value makes the result missing. skip: plain mean of present values, weights unused. renormalize: weights of present
    values add up to 1. zero: missing counts as zero.
    """
    product = F.sum(F.col(value) * F.col(weight))
    if policy == "propagate":
        return F.when(F.count(value) == F.count(F.lit(1)), product)
    if policy == "skip":
        return F.avg(value)
    if policy == "renormalize":
        return F.try_divide(product, F.sum(F.when(F.col(value).isNotNull(), F.col(weight))))
    if policy == "zero":
        return F.coalesce(product, F.lit(0.0))
    raise ValueError(f"policy must be one of {POLICIES}")


def catchment_means(obs: DataFrame, index: DataFrame, variables: Sequence[str], policy: str, keys: Sequence[str] = ("ts",), cell: str = "cell_id", unit: str = "divide_id", weight: str = "weight") -> DataFrame:
    """Joins observations to a cell index and aggregates all variables in one pass. Spark broadcasts the index if it is small."""
    if policy == "skip" and weight not in index.columns:
        index = index.withColumn(weight, F.lit(1.0))
    joined = obs.join(index.select(unit, cell, weight), cell)
    return joined.groupBy(unit, *keys).agg(*(weighted(v, weight, policy).alias(v) for v in variables))


def normalised(index: DataFrame, unit: str = "divide_id", fraction: str = "fraction", name: str = "weight") -> DataFrame:
    """Weights that add up to 1 in each catchment; rows without overlap go first."""
    own = index.where(F.col(fraction) > 0)
    total = own.groupBy(unit).agg(F.sum(fraction).alias("_total"))
    return own.join(total, unit).withColumn(name, F.col(fraction) / F.col("_total")).drop("_total")


def weight_sums(index: DataFrame, unit: str = "divide_id", weight: str = "weight") -> DataFrame:
    return index.groupBy(unit).agg(F.sum(weight).alias("weight_sum"), F.count("*").alias("n_cells"))


def centroids(index: DataFrame, unit: str = "divide_id", weight: str | None = "weight") -> DataFrame:
    """Mean position of a catchment's cells, weighted or plain."""
    if weight is None:
        return index.groupBy(unit).agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))
    return index.groupBy(unit).agg(*((F.sum(F.col(weight) * F.col(c)) / F.sum(weight)).alias(c) for c in ("lon", "lat")))


def overlap_profile(index: DataFrame, unit: str = "divide_id", fraction: str = "fraction", whole: float = 0.999) -> DataFrame:
    """Overlapping, whole and fractional cells of each catchment."""
    inside = F.col(fraction) >= whole
    return index.groupBy(unit).agg(F.count("*").alias("n_cells"), F.count_if(inside).alias("n_whole"), F.count_if(~inside).alias("n_fractional"), F.sum(fraction).alias("fraction_sum"))


def crosswalk_summary(index: DataFrame, catchments: DataFrame, unit: str = "divide_id", cell: str = "cell_id") -> DataFrame:
    """One row of counts for a sanity check."""
    own = index.agg(F.count("*").alias("n_rows"), F.countDistinct(cell).alias("n_cells"), F.countDistinct(unit).alias("n_units"), F.count_if(F.col(unit).isNull()).alias("n_null"))
    bare = catchments.select(unit).distinct().join(index.select(unit), unit, "left_anti").agg(F.count("*").alias("n_uncovered"))
    return own.crossJoin(F.broadcast(bare)).withColumn("cells_a_unit", F.try_divide(F.col("n_rows").cast("double"), F.col("n_units")))  # one row by one row
