"""Exact quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one task's memory. Here a first pass takes
a bounded sketch of each group, whose rank error is known, and so a bracket of values that must
hold the quantile. A second pass counts what is below the bracket and, value by value, what is in
it: some thousandths of a large group's values. Rows stay wide until then, and every pass
aggregates before the shuffle, so only the values within brackets are moved; they are ranked by a
running count over sorted rows, which spills, not in a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: One over the sketch's rank error; groups of no more values are counted whole.
ACCURACY = 10_000
#: Brackets of so many groups are broadcast, a few numbers each; those of more meet their rows by a shuffle.
FEW_GROUPS = 50_000


def _few(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether there are few groups; counting stops once there are not."""
    return not keys or df.select(*keys).distinct().limit(FEW_GROUPS + 1).count() <= FEW_GROUPS


def exact_quantiles(df: DataFrame, keys: Sequence[str], values: Sequence[str], quantiles: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """keys and an array ``{value}_q`` of the quantiles (linear interpolation), for each value column.

    Missing values are skipped; a group without any has nulls. Without keys the whole is one group. The groups
    are counted at once, to know whether their brackets may be broadcast.
    """
    m, places = len(quantiles), [(k, i) for k in range(len(values)) for i in range(len(quantiles))]
    known = [F.col(v).cast("double") for v in values]
    rows = df.select(*[F.col(c).alias(f"_g{j}") for j, c in enumerate(keys)], *[F.when(~F.isnan(v), v).alias(f"_v{k}") for k, v in enumerate(known)])
    groups = [f"_g{j}" for j in range(len(keys))]
    edges = [max(0.0, q - 5 / accuracy) for q in quantiles] + [min(1.0, q + 5 / accuracy) for q in quantiles]
    sizes = [f"_n{k}" for k in range(len(values))]
    sketch = rows.groupBy(*groups).agg(
        *[F.count(f"_v{k}").alias(n) for k, n in enumerate(sizes)],
        *[F.percentile_approx(f"_v{k}", edges, accuracy).alias(f"_e{k}") for k in range(len(values))],
    )
    infinite = F.lit(float("inf"))
    brackets = sketch.select(
        *[F.col(g).alias(f"{g}s") for g in groups],
        *sizes,
        *[F.when(F.col(f"_n{k}") > accuracy, F.col(f"_e{k}")[i]).otherwise(-infinite).alias(f"_lo{k}_{i}") for k, i in places],
        *[F.when(F.col(f"_n{k}") > accuracy, F.col(f"_e{k}")[m + i]).otherwise(infinite).alias(f"_hi{k}_{i}") for k, i in places],
    )
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}s"))
    asked = rows.join(F.broadcast(brackets) if _few(df, keys) else brackets, same)

    def entry(k: int, i: int, **more) -> F.Column:
        return F.struct(F.lit(k).alias("_k"), F.lit(i).alias("_i"), F.col(f"_n{k}").alias("_n"), *[c.alias(name) for name, c in more.items()])

    below = asked.groupBy(*groups, *sizes).agg(*[F.count_if(F.col(f"_v{k}") < F.col(f"_lo{k}_{i}")).alias(f"_b{k}_{i}") for k, i in places])
    below = below.select(*groups, F.inline(F.array(*[entry(k, i, _v=F.lit(None).cast("double"), _c=F.col(f"_b{k}_{i}")) for k, i in places])))
    # A row gives a value only to the brackets it lies in.
    within = [F.when(F.col(f"_v{k}").between(F.col(f"_lo{k}_{i}"), F.col(f"_hi{k}_{i}")), entry(k, i, _v=F.col(f"_v{k}"))) for k, i in places]
    inside = asked.select(*groups, F.inline(F.array_compact(F.array(*within))))
    inside = inside.groupBy(*groups, "_k", "_i", "_n", "_v").agg(F.count(F.lit(1)).alias("_c"))
    # What is below the bracket comes first.
    upward = Window.partitionBy(*groups, "_k", "_i").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = below.unionByName(inside).withColumn("_run", F.sum("_c").over(upward))
    q = F.element_at(F.array(*[F.lit(float(x)) for x in quantiles]), F.col("_i") + 1)
    position = q * (F.col("_n") - 1)
    # The value of a 0-based rank is the least whose running count goes beyond it.
    low, high = (F.min(F.when(F.col("_run") > rank, F.col("_v"))).alias(name) for name, rank in (("_lo", F.floor(position)), ("_hi", F.ceil(position))))
    found = ranked.groupBy(*groups, "_k", "_i").agg(low, high, F.max(position - F.floor(position)).alias("_f"))
    result = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise((1 - F.col("_f")) * F.col("_lo") + F.col("_f") * F.col("_hi"))
    found = found.withColumn("_q", result)
    columns = []
    for k, v in enumerate(values):
        picks = [F.max(F.when((F.col("_k") == k) & (F.col("_i") == i), F.col("_q"))) for i in range(m)]
        columns.append(F.array(*picks).alias(f"{v}_q"))
    return found.groupBy(*[F.col(g).alias(c) for g, c in zip(groups, keys)]).agg(*columns)
