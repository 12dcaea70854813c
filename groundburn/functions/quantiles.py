"""Exact quantiles from value histograms.

Minutes and miles are whole numbers over a narrow range, so (group, value)
counts are tiny next to the rows they summarise. Counting first spreads the
work over (group, value) pairs and combines on the map side: a group with a
third of all rows costs no more than any other. Count, mean, deviation,
extremes and quantiles then all come from the same histogram.

Where a group turns out to have very many values, as fractional ones would,
its histogram is not put together in one task: values are dealt to ranges,
weights are added up range by range, and only the ranges that hold the ranks
sought are looked into.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundburn.functions.intermediate import materialise
from groundburn.functions.joins import join_sized

#: Values of one group up to which a task puts its histogram together.
MOST_VALUES = 200_000
#: Ranges that values are dealt to beyond that.
RANGES = 400

VARIABLE, VALUE, WEIGHT = "variable", "valor", "repeticiones"


def histogram(df: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Rows per key, variable and value (NULL is a value), in one scan."""
    long_form = df.select(*keys, *variables).unpivot(keys, variables, VARIABLE, VALUE)
    return long_form.groupBy(*keys, VARIABLE, VALUE).agg(F.count(F.lit(1)).alias(WEIGHT))


def present() -> Column:
    """Rows with a value."""
    return F.sum(F.when(F.col(VALUE).isNotNull(), F.col(WEIGHT)).otherwise(0))


def total() -> Column:
    return F.sum(F.col(VALUE) * F.col(WEIGHT))


def average() -> Column:
    return F.try_divide(total(), present().cast("double"))


def deviation() -> Column:
    """Sample standard deviation; NULL below two values."""
    n = present().cast("double")
    squares = F.sum(F.col(VALUE) * F.col(VALUE) * F.col(WEIGHT))
    variance = F.try_divide(squares - F.try_divide(total() * total(), n), n - 1)
    return F.sqrt(F.when(variance < 0, 0.0).otherwise(variance))


def quantile(share: float, only: Column | None = None) -> Column:
    """Linear-interpolation quantile, optionally of the rows matching ``only``."""
    value = F.col(VALUE) if only is None else F.when(only, F.col(VALUE))
    return F.percentile(value, F.lit(share), F.col(WEIGHT))


def summarised(
    counted: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], quantiles: Mapping[str, float],
    value: str = VALUE, weight: str = WEIGHT, stored: bool = False,
) -> DataFrame:
    """Aggregates and quantiles (name: share) per key of a histogram.

    The histogram is stored and its values per group are counted first, which
    decides between one grouping and :func:`rank_quantiles`. Runs jobs.
    ``stored``: the histogram is stored already.
    """
    counted = counted if stored else materialise(counted)
    largest = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= MOST_VALUES:
        own = [F.percentile(value, F.lit(share), F.col(weight)).alias(name) for name, share in quantiles.items()]
        return counted.groupBy(*keys).agg(*aggregates, *own)
    ranked = rank_quantiles(counted, keys, quantiles, value, weight)
    groups = counted.groupBy(*keys).agg(*aggregates, F.count(F.lit(1)).alias("_n")).drop("_n")
    if not keys:
        row = ranked.first()  # one row
        return groups.withColumns({name: F.lit(row[name] if row else None).cast("double") for name in quantiles})
    # Keys may be NULL, so both sides meet by grouping.
    names = [c for c in groups.columns if c not in keys]
    both = groups.unionByName(ranked, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in (*names, *quantiles)])


def rank_quantiles(
    counted: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float], value: str = VALUE, weight: str = WEIGHT,
) -> DataFrame:
    """Linear-interpolation quantiles per key by selecting ranks.

    Each quantile lies between two ranks. Values are ordered by ranges; sums
    of weights, one per key and range, tell which range holds a rank, and a
    running sum inside it finds the value. No task gets more than a few ranges.
    """
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("_v").asc()]
    rows = counted.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(
        *keys, F.col(value).cast("double").alias("_v"), F.col(weight).cast("long").alias("_w"))
    ranged = materialise(rows.repartitionByRange(RANGES, *order).withColumn("_part", F.spark_partition_id()))
    of_key = Window.partitionBy(*(keys or [F.lit(0)]))  # one row per range
    placed = ranged.groupBy(*keys, "_part").agg(F.sum("_w").alias("_n")).select(
        *keys, "_part", "_n", F.sum("_n").over(of_key).alias("_all"),
        (F.sum("_n").over(of_key.orderBy("_part")) - F.col("_n")).alias("_before"))
    position = {name: (F.col("_all") - 1) * F.lit(float(share)) for name, share in quantiles.items()}
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), at.alias("position"), side(at).cast("long").alias("rank"))
        for name, at in position.items() for side in (F.floor, F.ceil)])
    targets = placed.select(*keys, "_part", "_before", "_n", F.explode(wanted).alias("w")).where(
        (F.col("w.rank") >= F.col("_before")) & (F.col("w.rank") < F.col("_before") + F.col("_n"))).distinct()
    sought = targets.groupBy(*keys, "_part", "_before").agg(F.collect_list("w").alias("_w_all"))  # twice the quantiles at most
    # NULL keys are marked, so that an equi-join meets them.
    marks = [F.struct(F.col(k).isNull(), k).alias(f"_k{i}") for i, k in enumerate(keys)]
    on = [*[f"_k{i}" for i in range(len(keys))], "_part"]
    found = join_sized(ranged.select(*marks, "_part", "_v", "_w"), sought.select(*marks, "_part", "_before", "_w_all"), on)
    upto = F.col("_before") + F.sum("_w").over(Window.partitionBy(*on).orderBy("_v"))
    values = found.withColumn("_upto", upto).select(
        *[c for c in on if c != "_part"], "_v", "_upto", "_w", F.explode("_w_all").alias("w"),
    ).where((F.col("w.rank") < F.col("_upto")) & (F.col("w.rank") >= F.col("_upto") - F.col("_w")))
    each = []
    for name in quantiles:
        own = F.col("w.name") == name
        low, high = F.min(F.when(own, F.col("_v"))), F.max(F.when(own, F.col("_v")))
        at = F.max(F.when(own, F.col("w.position")))
        each.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high).alias(name))
    marked = [c for c in on if c != "_part"]
    out = values.groupBy(*marked).agg(*each)
    return out.select(*[F.col(c)[k].alias(k) for c, k in zip(marked, keys, strict=True)], *quantiles)
