"""Join of rows whose values lie near each other, without a key that is equal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.session import partitions_for

# How far off a bin's share of the rows may be, as a part of one bin, and the ways that rows of one heavy value are dealt.
ACCURACY, WAYS = 0.25, 16
# Bins for each shuffle partition.
BINS_PER_PARTITION = 4


def bin_edges(sides: list[DataFrame], bins: int) -> list[float]:
    """Upper edges of bins that hold about equally many rows of ``sides`` (one column each), from a mergeable quantile sketch."""
    values = sides[0].toDF("v")
    for side in sides[1:]:
        values = values.union(side.toDF("v"))
    shares = [n / bins for n in range(1, bins)]
    found = values.where(F.col("v").isNotNull()).approxQuantile("v", shares, ACCURACY / bins)
    return sorted(set(found))


def _bin(value: Column, edges: list[float]) -> Column:
    """How many edges lie below ``value``."""
    if not edges:
        return F.lit(0)
    array = F.array(*[F.lit(edge) for edge in edges])
    place = F.array_size(F.filter(array, lambda edge: edge < value)) if len(edges) < 8 else _searched(value, edges, 0, len(edges))
    return place.cast("int")


def _searched(value: Column, edges: list[float], low: int, high: int) -> Column:
    """The same by halving, as nested conditions: a few comparisons for each row, however many edges there are."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(F.lit(edges[middle]) < value, _searched(value, edges, middle + 1, high)).otherwise(_searched(value, edges, low, middle))


def band_join(left: DataFrame, right: DataFrame, left_value: str, right_value: str, below: float, above: float, bins: int | None = None) -> DataFrame:
    """Pairs with ``left_value - below <= right_value <= left_value + above``; all columns of both, which must differ in name.

    Values are numbers. Bins come from a quantile sketch of both sides, so a dense stretch has more of them. A left row goes
    to the bin of its value, a right row to every bin that its band reaches, and bins are joined by equality. A value that
    alone fills a bin or more cannot be cut by its value: left rows of such bins are dealt to ``WAYS`` ways by their
    content and right rows go to each, so no task has a whole heavy value of the left. Null and NaN values pair with nothing. Repeated rows
    pair each. What reaches the driver is the edges.
    """
    bins = bins or BINS_PER_PARTITION * partitions_for(left)
    left, right = (side.where(F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))) for side, name in ((left, left_value), (right, right_value)))
    left, right = left.withColumn("_at", F.col(left_value).cast("double")), right.withColumn("_near", F.col(right_value).cast("double"))
    edges = bin_edges([left.select("_at"), right.select("_near")], bins)
    # Equal quantiles are one edge: as many bins as they stand for fall together in the bin that ends there.
    heavy = _heavy(left, edges, bins)
    own = left.withColumn("_bin", _bin(F.col("_at"), edges))
    ways = F.when(F.col("_bin").isin(heavy), WAYS).otherwise(1) if heavy else F.lit(1)
    own = own.withColumn("_way", F.pmod(F.xxhash64(*[c for c in left.columns if c != "_at"], F.monotonically_increasing_id()), ways).cast("int"))
    first, last = _bin(F.col("_near") - above, edges), _bin(F.col("_near") + below, edges)
    spread = right.withColumn("_bin", F.explode(F.sequence(first, last)))
    spread = spread.withColumn("_way", F.explode(F.sequence(F.lit(0), ways.cast("int") - 1)))
    near = F.col("_near").between(F.col("_at") - below, F.col("_at") + above)
    return own.join(spread, ["_bin", "_way"]).where(near).drop("_bin", "_way", "_at", "_near")


def _heavy(left: DataFrame, edges: list[float], bins: int) -> list[int]:
    """Bins with more than twice their share of the left rows; at most ``bins / 2``."""
    counts = left.groupBy(_bin(F.col("_at"), edges).alias("bin")).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return sorted(row.bin for row in counts.where(F.col("count") > 2 * total / bins).collect())
