"""Exact and approximate quantiles per group."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import saved

#: Ranges that a group is cut into, and the values of a group or range that are ranked in one task.
RANGES = 64
LARGEST = 1 << 16


def group_summary(
    df: DataFrame,
    keys: list[str],
    value: str,
    at: str | None = None,
    exact: bool = True,
) -> DataFrame:
    """Per group: ``median``, ``lowest`` and, ordered by ``at``, the ``first`` value."""
    rows = df.where(f"{value} IS NOT NULL").selectExpr(
        *keys, f"CAST({value} AS DOUBLE) AS _v", f"{at or 0} AS _t"
    )
    others = {"lowest": "min(_v)", "first": "min(struct(_t, _v))._v"}
    if not exact:
        approximate = F.expr("percentile_approx(_v, 0.5) AS median")
        return rows.groupBy(*keys).agg(approximate, *[F.expr(f"{e} AS {n}") for n, e in others.items()])
    summary = _exact(rows, keys, [0.5], others)
    return summary.withColumn("_q", F.expr("_q[0]")).withColumnRenamed("_q", "median")


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, points: list[float], out: str = "quantiles"
) -> DataFrame:
    """Interpolated quantiles per group (or of all rows, for no keys) as an array."""
    group = keys or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(0))
    rows = source.where(f"{value} IS NOT NULL").selectExpr(*group, f"CAST({value} AS DOUBLE) AS _v", "0 AS _t")
    return _exact(rows, group, points, {}).select(*keys, F.col("_q").alias(out))


def exact_median(
    df: DataFrame, keys: list[str], value: str, out: str = "median"
) -> DataFrame:
    """Interpolated median per group (or of all rows, for no keys)."""
    found = exact_quantiles(df, keys, value, [0.5], "_q")
    return found.select(*keys, F.expr("_q[0]").alias(out))


def approximate_median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """Median by bounded sketch; on small groups it is the lower middle value."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.percentile_approx(value, 0.5).alias(out)
    )


def _same(left: str, right: str, keys: list[str]) -> Column:
    """Equality of keys that may be null."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _exact(rows: DataFrame, keys: list[str], points: list[float], others: dict[str, str]) -> DataFrame:
    """Quantiles ``_q`` and other aggregates of (keys, _v, _t); one method for a group of any size.

    Equal values are counted before anything meets per group, keyed by (group, value).  While a group has more than
    ``LARGEST`` values, a sketch cuts it into ranges, and only the ranges that hold wanted ranks go on, as
    groups of the next round; what is left is ranked by a window.  Keys may be null.  The counts of each
    round are read several times, so they are written to the shared folder.
    """
    counted = saved(rows.groupBy(*keys, "_v").agg(F.expr("count(*) AS _n"), F.expr("min(_t) AS _t")), "counted")
    wanted = ", ".join(f"floor((_total - 1) * {p}D), ceil((_total - 1) * {p}D)" for p in points)
    totals = counted.groupBy(*keys).agg(
        F.expr("sum(_n) AS _total"), F.expr("count(*) AS _values"), *[F.expr(f"{e} AS {n}") for n, e in others.items()]
    )
    totals = saved(totals.withColumn("_wanted", F.expr(f"array_distinct(array({wanted}))")), "totals")
    most = totals.agg(F.max("_values")).first()[0] or 0
    groups, placed = list(keys), counted.select(*keys, "_v", "_n")
    starts = totals.selectExpr(*keys, "0L AS _before", "_wanted AS _ranks")
    while most > LARGEST:
        placed, starts, most = _narrowed(placed, starts, groups, f"_range{len(groups) - len(keys)}")
        groups = groups + [f"_range{len(groups) - len(keys)}"]
    before = Window.partitionBy(*[F.col(f"v.{k}") for k in groups]).orderBy("_v")
    found = (
        placed.alias("v")
        .join(starts.alias("h"), _same("v", "h", groups))
        .select(*[f"v.{k}" for k in keys], "_v", "_n", "_ranks", (F.col("_before") + F.sum("_n").over(before)).alias("_end"))
        .selectExpr(*keys, "_v", "explode(filter(_ranks, r -> r >= _end - _n AND r < _end)) AS _rank")
    )
    # two ranks per wanted quantile
    ranks = found.groupBy(*keys).agg(F.expr("map_from_entries(collect_list(struct(_rank, _v))) AS _at"))

    def interpolated(p: float) -> str:
        position = f"((_total - 1) * {p}D)"
        low, high = f"_at[floor({position})]", f"_at[ceil({position})]"
        between = f"(ceil({position}) - {position}) * {low} + ({position} - floor({position})) * {high}"
        return f"CASE WHEN {low} = {high} THEN {low} ELSE {between} END"

    return (
        totals.alias("c")
        .join(ranks.alias("r"), _same("c", "r", keys))
        .selectExpr(
            *[f"c.{k}" for k in keys], f"array({', '.join(interpolated(p) for p in points)}) AS _q", *others
        )
    )


def _narrowed(placed: DataFrame, starts: DataFrame, groups: list[str], out: str) -> tuple[DataFrame, DataFrame, int]:
    """Values and starts of the ranges of each group that hold wanted ranks, and the most values of one of them.

    ``placed`` has (groups, _v, _n), ``starts`` (groups, _before, _ranks): the rows before a group and the
    ranks looked for in it.  Ranges follow from a sketch of a group's distinct values, so each has about 1/``RANGES`` of them.
    """
    points = ", ".join(f"{i / RANGES}D" for i in range(1, RANGES))
    cuts = placed.groupBy(*groups).agg(F.expr(f"percentile_approx(_v, array({points}), 1000) AS _cuts"))
    ranged = placed.alias("v").join(cuts.alias("c"), _same("v", "c", groups))
    ranged = ranged.selectExpr(*[f"v.{k}" for k in groups], "_v", "_n", f"size(filter(_cuts, c -> c < _v)) AS {out}")
    sizes = ranged.groupBy(*groups, out).agg(F.expr("sum(_n) AS _size"), F.expr("count(*) AS _values"))
    # at most RANGES rows per group reach this window
    ahead = Window.partitionBy(*[F.col(f"s.{k}") for k in groups]).orderBy(out)
    holding = (
        sizes.alias("s")
        .join(starts.alias("h"), _same("s", "h", groups))
        .select(*[f"s.{k}" for k in groups], out, "_values", "_size", (F.col("_before") + F.sum("_size").over(ahead) - F.col("_size")).alias("_before"), "_ranks")
        .withColumn("_ranks", F.expr("filter(_ranks, r -> r >= _before AND r < _before + _size)"))
        .where("size(_ranks) > 0")
    )
    holding = saved(holding, "ranges")
    next_groups = [*groups, out]
    inside = ranged.alias("v").join(holding.alias("h"), _same("v", "h", next_groups)).select(*[f"v.{k}" for k in next_groups], "_v", "_n")
    most = holding.agg(F.max("_values")).first()[0] or 0
    return saved(inside, "inside"), holding.select(*next_groups, "_before", "_ranks"), most


def quantile_bins(df: DataFrame, value: str, bins: int, out: str = "bin") -> DataFrame:
    """Bin number 1..n by equal-frequency edges; repeated edges are merged, nulls stay null.

    There are at most as many bins as distinct values.
    """
    kinds = df.agg(F.least(F.countDistinct(value), F.lit(bins)).alias("_kinds"))
    points = sorted({i / n for n in range(1, bins + 1) for i in range(n + 1)})
    found = exact_quantiles(df, [], value, points, "_all_edges").select(F.struct("_all_edges").alias("_found"))
    listed = ", ".join(
        f"array({', '.join(f'_found._all_edges[{points.index(i / n)}]' for i in range(n + 1))})" for n in range(1, bins + 1)
    )
    placed = df.withColumns({"_found": found.scalar(), "_kinds": kinds.scalar()})
    placed = placed.withColumn("_edges", F.expr(f"array_distinct(array({listed})[_kinds - 1])"))
    inner = "filter(_edges, (e, i) -> i > 0 AND i < size(_edges) - 1)"
    number = f"CASE WHEN {value} IS NOT NULL THEN size(filter({inner}, e -> e < {value})) + 1 END"
    return placed.withColumn(out, F.expr(number)).drop("_found", "_kinds", "_edges")
