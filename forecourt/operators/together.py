"""Metrics of groups whose rows fit into one task.

Rows of one style, or of one dealer, are few as a rule, and so are those of all groups that share it, such as its
markets. They are shuffled once, by that column, and each group becomes one row with all its cars; measures,
trims and medians are read off there. Values of the column with more rows are found before, see `apart`, and go
through the histograms of `metrics`, which have no such bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.functions.rules import LOG_SLACK, between
from forecourt.operators.metrics import LISTED, SOLD, SUPPLY_MIN_N, TRIM_MIN_N, TRIM_SIGMA, days_supply

# Fixed value: cars of one style or dealer that a task may hold, with all of their markets and measures.
TOGETHER = 10_000

# Fixed value: rows to which these cars may come when each is repeated for all zips of its style.
REPEATED = 100_000


def crowded(rows: DataFrame, column: str, most: int, copies: str = "1L") -> DataFrame:
    """Values of a column with more than `most` rows: at most one for as many rows, so always few."""
    counted = rows.groupBy(column).agg(F.expr(f"sum(abs({copies}))").alias("rows"))
    return counted.filter(F.col("rows") > most).select(column)


def crowded_markets(rows: DataFrame, column: str, place: str, most: int, repeated: int) -> DataFrame:
    """As `crowded`, and also values of the column with more than `repeated` rows times places."""
    counted = rows.groupBy(column, place).agg(F.count(F.lit(1)).alias("rows"))
    whole = counted.groupBy(column).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("places"))
    return whole.filter((F.col("rows") > most) | (F.col("rows") * F.col("places") > repeated)).select(column)


def apart(rows: DataFrame, column: str, many: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows without the `many` crowded values of a column, and those with them if there are any.

    Stage `many`: it is then known to be small, and the rows stay where they are.
    """
    if many.isEmpty():
        return rows, None
    return rows.join(many, column, "left_anti"), rows.join(many, column, "left_semi")


def crowded_groups(rows: DataFrame, keys: Sequence[str], most: int = TOGETHER) -> DataFrame:
    """Groups of several columns with more than `most` rows; rows without a key are a group, too."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > most).select(*keys)


def apart_groups(rows: DataFrame, keys: Sequence[str], many: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """As `apart`, for groups of several columns, any of which may be unknown."""
    if many.isEmpty():
        return rows, None
    crowd = many.select(*[F.col(k).alias(f"crowded_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"crowded_{k}")) for k in keys]
    return rows.join(crowd, same, "left_anti"), rows.join(crowd, same, "left_semi")


def together(rows: DataFrame, *columns: str) -> DataFrame:
    """Shuffle rows by a column, or by several.

    Partitions are not merged by their size: rows have yet to be repeated for markets and measures.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, *[F.col(c) for c in columns])


def gathered(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per keys, with all of its rows as `cars`; nothing moves if the rows lie together by a key."""
    return rows.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("cars"))


def per_measure(cars: DataFrame, keys: Sequence[str], measures: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per keys and measure, with values `xs`, `states` and `moves`; `names` is SQL text per measure."""
    each = ", ".join(f"struct({n} as measure, cars.{m} as xs)" for m, n in zip(measures, names, strict=True))
    states = {"states": "cars.sold", "moves": "cars.moved"}
    return cars.select(*keys, *X.named(states), F.expr(f"inline(array({each}))"))


def _steps(suffix: str = "") -> tuple[list[dict[str, str]], dict[str, str]]:
    """SQL text of numbers that are computed one step after the other from the values `xs` of a row, and of its metrics.

    Values above zero count. One or two values need no array functions: their median is their mean, and
    they are never trimmed.
    """
    xs = f"xs{suffix}"
    few = f"size({xs}) <= 2"
    one, two = (f"coalesce(get({xs}, {i}) > 0, false)" for i in range(2))
    moved = (
        f"if({few}, int({one} and get(moves, 0) = 1) + int({two} and get(moves, 1) = 1),"
        f" size(filter({xs}, (x, i) -> x > 0 and moves[i] = 1)))"
    )
    values = {f"cars_moved_on{suffix}": f"bigint({moved})"}
    numbers, means, spreads, kept, metrics = {}, {}, {}, {}, {}
    for name, number in (("sold", SOLD), ("lstd", LISTED)):
        state = f"{name}{suffix}"
        n, k = f"cars_{state}", f"kept_{state}"
        values |= {
            f"one_{state}": f"if({few} and {one} and get(states, 0) = {number}, get({xs}, 0), null)",
            f"two_{state}": f"if({few} and {two} and get(states, 1) = {number}, get({xs}, 1), null)",
            state: f"if({few}, null, sort_array(filter({xs}, (x, i) -> x > 0 and states[i] = {number})))",
        }
        one_is, two_is = f"one_{state} is not null", f"two_{state} is not null"
        numbers[n] = f"bigint(if({few}, int({one_is}) + int({two_is}), size({state})))"
        trims = f"{n} >= {TRIM_MIN_N}"
        means[f"ml_{state}"] = f"if({trims}, aggregate({state}, 0D, (s, x) -> s + ln(x / 100D)) / {n}, null)"
        squares = f"aggregate({state}, 0D, (s, x) -> s + pow(ln(x / 100D) - ml_{state}, 2))"
        differ = f"{state}[0] < {state}[int({n}) - 1]"
        spreads[f"sd_{state}"] = f"if({trims}, if({differ}, sqrt({squares} / ({n} - 1)), 0D), null)"
        bounds = (f"ml_{state} {sign} {TRIM_SIGMA} * sd_{state}" for sign in "-+")
        kept[k] = f"if({trims}, filter({state}, x -> {between('ln(x / 100D)', *bounds, LOG_SLACK)}), {state})"
        total = f"if({few}, coalesce(one_{state}, 0L) + coalesce(two_{state}, 0L), aggregate({k}, 0L, (s, x) -> s + x))"
        least, greatest = (f"{end}(one_{state}, two_{state})" for end in ("least", "greatest"))
        middle = f"get({state}, int(({n} + 1) div 2) - 1) + get({state}, int({n} div 2))"
        metrics |= {
            f"avg_{name}": X.whole(X.mean_of(total, f"if({few}, {n}, size({k}))")),
            f"max_{name}": X.whole(f"if({few}, {greatest}, get({k}, size({k}) - 1)) / 100D"),
            f"min_{name}": X.whole(f"if({few}, {least}, get({k}, 0)) / 100D"),
            f"median_{name}": X.whole(f"if({few}, {least} + {greatest}, {middle}) / 200D"),
        }
    return [values, numbers, means, spreads, kept], metrics


def summary_of_values(rows: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """All metrics, as in `metric_summary`, of rows that hold all values of their keys and measure."""
    steps, metrics = _steps()
    selling = f"if(cars_sold >= {SUPPLY_MIN_N}, cars_sold, 0L)"
    metrics["days_supply"] = days_supply("cars_lstd", selling, days)
    one, two = (f"coalesce(get(xs, {i}) > 0, false)" for i in range(2))
    counted = rows.filter(f"if(size(xs) <= 2, {one} or {two}, exists(xs, x -> x > 0))")
    for step in steps:
        counted = counted.select("*", *X.named(step))
    # Names and order as `metric_summary` has them.
    order = ["cars_sold", "cars_lstd", "cars_moved_on"]
    found = counted.select(*keys, "measure", *order, *X.named(metrics))
    statistics = [f"{s}_{state}" for state in ("sold", "lstd") for s in ("avg", "max", "min")]
    return found.select(*keys, "measure", *order, *statistics, "median_sold", "median_lstd", "days_supply")


def statistics_of_cars(cars: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Averages, maxima, minima and medians of rows that hold all cars of their keys, as a struct per measure."""
    found = cars.selectExpr(*keys, "cars.sold as states", *[f"cars.{m} as xs_{m}" for m in measures])
    found = found.selectExpr("*", "cast(null as array<int>) as moves")
    steps, metrics = zip(*[_steps(f"_{m}") for m in measures], strict=True)
    for together in zip(*steps, strict=True):
        found = found.select("*", *X.named({name: sql for step in together for name, sql in step.items()}))
    structs = {
        m: f"struct({', '.join(f'{sql} as {name}' for name, sql in of.items())})"
        for m, of in zip(measures, metrics, strict=True)
    }
    return found.select(*keys, *X.named(structs))
