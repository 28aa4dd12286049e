"""Metrics of nested groups from one histogram: markets of growing radius, snapshots of growing age.

A car within 25 miles is also within 50, 100 and 250, and one seen within 45 days also within 60 and
90. Such groups share one row per key and value: classes (narrowest band, narrowest
snapshot) are added up into one count per cell, a cell being a condition on the classes. Ranks,
medians and trims of all cells then come from the same few shuffles, as running sums side by side,
and no row is repeated per cell.

As in `histogram`, values fall into buckets, so that a hot key stays spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import LOG_SLACK, between
from forecourt.operators.histogram import CHUNK, bucket
from forecourt.operators.metrics import LISTED, SOLD, SUPPLY_MIN_N, TRIM_MIN_N, TRIM_SIGMA, days_supply

Cells = Mapping[str, str]  # name of a cell, and SQL text over the class columns

STATES = {"sold": SOLD, "lstd": LISTED}


def narrowest(value: Column, bounds: Sequence[float]) -> Column:
    """Number of the first bound that is not below the value; NULL beyond the last one."""
    found = F.lit(None).cast("int")
    for i in reversed(range(len(bounds))):
        found = F.when(value <= bounds[i], i).otherwise(found)
    return found


def nested_cells(name: str, column: str, size: int) -> dict[str, str]:
    """One cell per class of a column, which holds that class and all narrower ones."""
    return {f"{name}{i}": f"{column} <= {i}" for i in range(size)}


def crossed(one: Cells, other: Cells) -> dict[str, str]:
    """All pairs of cells, as the cells where both hold."""
    return {f"{a}_{b}": f"({x}) and ({y})" for a, x in one.items() for b, y in other.items()}


def cell_histogram(
    rows: DataFrame, group: Sequence[str], cells: Cells, copies: str = "1L", moved: str | None = None
) -> DataFrame:
    """One row per group and value `x`, with the copies `n_<cell>` and, of these, moved on `m_<cell>`.

    `moved` is SQL text over the rows: 1 for those moved on. Rows without value or group drop out.
    """
    sums = {f"n_{c}": f"sum(if({sql}, {copies}, 0L))" for c, sql in cells.items()}
    if moved:
        sums |= {f"m_{c}": f"sum(if(({sql}) and ({moved}) = 1, {copies}, 0L))" for c, sql in cells.items()}
    known = " and ".join(f"{c} is not null" for c in [*group, "bucket"])
    return (
        rows.withColumn("bucket", bucket())
        .filter(known)
        .groupBy(*group, "bucket", "x")
        .agg(*X.named(sums))
    )


def _profile(hist: DataFrame, group: Sequence[str], cells: Cells) -> DataFrame:
    """Per group and bucket, of each cell: rows in lower buckets, rows of the group, and the mean
    and deviation of the logarithms in the group.

    Logarithms are added up relative to the bucket's middle and merged by the buckets' means.
    """
    middle = f"((bucket + 0.5D) * {CHUNK})"
    log = f"log1p((x - {middle}) / {middle})"
    sums, parts, whole, means, spreads, kept = {}, {}, {}, {}, {}, {}
    over = f"over (partition by {', '.join(group)} order by bucket rows between unbounded preceding"
    every, lower = f"{over} and unbounded following)", f"{over} and 1 preceding)"
    for c in cells:
        sums |= {
            f"nb_{c}": f"sum(n_{c})",
            f"low_{c}": f"min(if(n_{c} > 0, x, null))",
            f"high_{c}": f"max(if(n_{c} > 0, x, null))",
            f"e_{c}": f"sum(n_{c} * log)",
            f"ee_{c}": f"sum(n_{c} * log * log)",
        }
        parts |= {
            f"pl_{c}": f"ln({middle} / 100D) + e_{c} / nullif(nb_{c}, 0)",
            f"pm_{c}": f"greatest(ee_{c} - e_{c} * e_{c} / nullif(nb_{c}, 0), 0D)",
        }
        whole |= {
            f"ng_{c}": f"sum(nb_{c}) {every}",
            f"below_{c}": f"coalesce(sum(nb_{c}) {lower}, 0L)",
            f"low_{c}": f"min(low_{c}) {every}",
            f"high_{c}": f"max(high_{c}) {every}",
            f"sl_{c}": f"sum(nb_{c} * pl_{c}) {every}",
        }
        means[f"ml_{c}"] = f"sl_{c} / nullif(ng_{c}, 0)"
        spreads[f"m2_{c}"] = f"sum(pm_{c} + nb_{c} * pow(pl_{c} - ml_{c}, 2)) {every}"
        kept |= {
            f"ng_{c}": f"ng_{c}",
            f"below_{c}": f"below_{c}",
            f"ml_{c}": f"ml_{c}",
            f"sd_{c}": f"case when ng_{c} > 1 then if(low_{c} < high_{c}, sqrt(m2_{c} / (ng_{c} - 1)), 0D) end",
        }
    by_bucket = (
        hist.withColumn("log", F.expr(log)).groupBy(*group, "bucket").agg(*X.named(sums))
    ).select("*", *X.named(parts))
    carried = [f"{p}_{c}" for c in cells for p in ("nb", "pl", "pm")]
    return (
        by_bucket.select(*group, "bucket", *carried, *X.named(whole))
        .select("*", *X.named(means))
        .select("*", *X.named(spreads))
        .select(*group, "bucket", *X.named(kept))
    )


def cell_rows(hist: DataFrame, group: Sequence[str], cells: Cells) -> DataFrame:
    """Histogram rows with each cell's statistics, trim (`keep_`) and first and last rank."""
    upto = f"over (partition by {', '.join(group)}, bucket order by x rows unbounded preceding)"
    running = {f"upto_{c}": f"sum(n_{c}) {upto}" for c in cells}
    ranks, firsts = {}, {}
    for c in cells:
        near = between(
            "ln(x / 100D)", f"ml_{c} - {TRIM_SIGMA} * sd_{c}", f"ml_{c} + {TRIM_SIGMA} * sd_{c}", LOG_SLACK
        )
        ranks |= {
            f"last_{c}": f"below_{c} + upto_{c}",
            f"keep_{c}": f"(n_{c} > 0 and (ng_{c} < {TRIM_MIN_N} or {near}))",
        }
        firsts[f"first_{c}"] = f"last_{c} - n_{c} + 1"
    # Counted up before the join, rows are sorted while they are narrow, and the join needs no other order.
    counted = hist.select("*", *X.named(running))
    joined = counted.join(_profile(hist, group, cells), [*group, "bucket"], "inner")
    return joined.select("*", *X.named(ranks)).select("*", *X.named(firsts))


def trimmed_and_medians(cell: str, condition: str = "true") -> dict[str, str]:
    """Trimmed average, maximum, minimum and untrimmed median of a cell, sold and listed."""
    found = {}
    for state, number in STATES.items():
        here = f"({condition}) and sold = {number}"
        kept = f"{here} and keep_{cell}"
        total, n = f"sum(if({kept}, x * n_{cell}, 0L))", f"sum(if({kept}, n_{cell}, 0L))"
        middle = " + ".join(
            f"sum(case when {here} and n_{cell} > 0"
            f" and {rank} between first_{cell} and last_{cell} then x end)"
            for rank in (f"floor((ng_{cell} + 1) / 2)", f"floor(ng_{cell} / 2) + 1")
        )
        found |= {
            f"avg_{state}": X.whole(X.mean_of(total, n)),
            f"max_{state}": X.whole(f"max(case when {kept} then x end) / 100D"),
            f"min_{state}": X.whole(f"min(case when {kept} then x end) / 100D"),
            f"median_{state}": X.whole(f"({middle}) / 200D"),
        }
    return found


def cell_counts(cell: str, days: int) -> dict[str, str]:
    """Cars sold, listed and moved on in a cell, and days of supply."""
    n = {s: f"sum(if(sold = {number}, n_{cell}, 0L))" for s, number in STATES.items()}
    selling = f"sum(if(sold = {SOLD} and ng_{cell} >= {SUPPLY_MIN_N}, n_{cell}, 0L))"
    return {
        "cars_sold": n["sold"],
        "cars_lstd": n["lstd"],
        "cars_moved_on": f"sum(m_{cell})",
        "days_supply": days_supply(n["lstd"], selling, days),
    }


def cell_summary(hist: DataFrame, keys: Sequence[str], cells: Cells, days: int) -> DataFrame:
    """All metrics, one row per keys, measure and cell that has cars, `cell` being its name.

    `hist` has the group (keys, measure, sold); stage it where it is costly to make.
    """
    rows = cell_rows(hist, [*keys, "measure", "sold"], cells)
    wide = {}
    for c in cells:
        metrics = {**cell_counts(c, days), **trimmed_and_medians(c), "n": f"sum(n_{c})"}
        wide |= {f"{m}_{c}": sql for m, sql in metrics.items()}
    names = [*cell_counts("", days), *trimmed_and_medians("")]
    summed = rows.groupBy(*keys, "measure").agg(*X.named(wide))
    per_cell = ", ".join(
        f"struct('{c}' as cell, n_{c} as n, {', '.join(f'{m}_{c} as {m}' for m in names)})" for c in cells
    )
    stacked = summed.select(*keys, "measure", F.expr(f"inline(array({per_cell}))"))
    return stacked.filter("n > 0").drop("n")
