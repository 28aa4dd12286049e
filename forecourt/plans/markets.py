"""All metrics per distance band and nationwide, and the wide daily table with all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions import expressions as X
from forecourt.operators.histogram import value_histogram
from forecourt.operators.listing import MEASURES
from forecourt.operators.market import BANDS, NATIONWIDE, band_counts, market_pairs, market_reach
from forecourt.operators.metrics import (
    LISTED,
    SOLD,
    SUPPLY_MIN_N,
    days_supply,
    measured_rows,
    metric_summary,
    recent_cars,
    sold_state,
)
from forecourt.operators.nested import (
    cell_histogram,
    cell_rows,
    cell_summary,
    crossed,
    narrowest,
    nested_cells,
    trimmed_and_medians,
)
from forecourt.operators import together as T
from forecourt.plans.daily import daily_facts, stage_market_columns
from forecourt.sources.schemas import Inputs
from forecourt.staging import stage

# Snapshots and how many days before `as_of` they reach; today is the day before.
WINDOWS = {"today": 1, "45_day": 45, "60_day": 60, "90_day": 90}
STATES = ("sold", "lstd")
KINDS = ("sold", "lstd", "moved_on")
STATISTICS = tuple(f"{s}_{state}" for s in ("avg", "max", "min", "median") for state in STATES)

# Room for a number of cars of a group in `_wide_of_styles`, of which it puts three into a bigint.
_COUNT_BITS = 21


def metric_matrix_bands(
    inputs: Inputs,
    as_of: date | str,
    days: int = 90,
    bands: Sequence[int] = BANDS,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Long metric table per band, dimension (zip or zip_style), key and measure.

    The key of a band is the market's centre, that of the nation is `nationwide`, each with the style where the
    dimension has one. Keys without cars in a band have no row there. Values are counted per own
    zip, and only the counts are sent to the markets around, once for all bands. Cars of a style that is not crowded
    meet by a single shuffle instead, for all its markets and bands.
    """
    facts = stage_market_columns(daily_facts(inputs, as_of, max(days + 1, 121)))
    near = market_pairs(inputs.zipdist, facts, max(bands)).select(
        "zip2", F.col("zip1").alias("centre"), narrowest(F.col("distance"), bands).alias("band")
    )
    seen = facts.filter(X.seen_since(F.col("vin_last_dt"), as_of, days))
    many = stage(T.crowded(seen, "style_id", T.TOGETHER), "crowded")
    few, rest = T.apart(facts, "style_id", many)
    found = _bands_of_styles(few, near, as_of, days, len(bands), measures)

    # Whole zips, and what is left of the styles.
    others = ("zip", "vin_last_dt", "vin_frst_dt", "sold_flg", *measures)
    located = facts.select(*others, F.lit("zip").alias("dim"), F.lit("").alias("style"))
    if rest is not None:
        style = F.col("style_id").cast("string")
        located = located.unionByName(rest.select(*others, F.lit("zip_style").alias("dim"), style.alias("style")))
    rows = measured_rows(located, ["dim", "zip", "style"], measures, as_of, days)
    keys = ["dim", "style", "measure", "sold"]
    own = stage(value_histogram(rows, ["zip"], [*keys, "moved"], null_groups=True), "own-values")

    cells = nested_cells("b", "band", len(bands))
    spread = own.filter("zip is not null").drop("bucket").join(near.withColumnRenamed("zip2", "zip"), "zip", "inner")
    hist = cell_histogram(spread, ["centre", *keys], cells, copies="n", moved="moved")
    banded = cell_summary(stage(hist, "band-values"), ["centre", "dim", "style"], cells, days)
    banded = banded.withColumn("cell", F.substring("cell", 2, 9).cast("int"))

    national = value_histogram(own, keys, ["moved"], copies="n")
    nation = metric_summary(stage(national, "nation-values"), ["dim", "style"], days).withColumns(
        {"cell": F.lit(len(bands)), "centre": F.lit(NATIONWIDE)}
    )
    found = banded.unionByName(nation).unionByName(found)
    names = F.array(*[F.lit(str(b)) for b in (*bands, NATIONWIDE)])[F.col("cell")]
    key = F.when(F.col("style") == "", F.col("centre")).otherwise(X.pair_key(F.col("centre"), F.col("style")))
    return found.withColumns({"band": names, "key": key}).drop("centre", "style", "cell")


def _bands_of_styles(
    facts: DataFrame, near: DataFrame, as_of: date | str, days: int, bands: int, measures: Sequence[str]
) -> DataFrame:
    """Metrics per market and style, of cars of which a task can hold all that share the style.

    Cars of a market are gathered once for all bands. A band that adds none to the narrower one has the same metrics:
    they are computed for the narrowest such band and repeated from `cell` up to `upto`. The nation is the last cell.
    """
    columns = ["sold", "moved", *measures]
    known = facts.filter(F.col("style_id").isNotNull()).withColumnRenamed("zip", "zip2")
    cars = T.together(recent_cars(known, ["style_id", "zip2"], measures, as_of, days), "style_id")
    market = T.gathered(cars.join(near, "zip2"), ["style_id", "centre"], ["band", *columns])
    within = ", ".join(
        f"struct({i} as cell, if(exists(cars, c -> c.band = {i}), filter(cars, c -> c.band <= {i}), null) as cars)"
        for i in range(bands)
    )
    cells = market.selectExpr("style_id", "centre", f"array({within}) as within").selectExpr(
        "style_id", "centre", "filter(within, w -> w.cars is not null) as within"
    )
    apart = cells.selectExpr("style_id", "centre", "within.cell as firsts", "posexplode(within) as (at, w)").selectExpr(
        "style_id", "centre", "w.cell as cell", f"coalesce(get(firsts, at + 1), {bands}) - 1 as upto", "w.cars as cars"
    )
    keys = ["style_id", "centre", "cell", "upto"]
    names = [f"'{m}'" for m in measures]
    banded = T.summary_of_values(T.per_measure(apart, keys, measures, names), keys, days)
    banded = banded.withColumn("cell", F.explode(F.sequence("cell", "upto"))).drop("upto")
    whole = T.per_measure(T.gathered(cars, ["style_id"], columns), ["style_id"], measures, names)
    nation = T.summary_of_values(whole, ["style_id"], days).withColumns(
        {"centre": F.lit(NATIONWIDE), "cell": F.lit(bands)}
    )
    found = banded.unionByName(nation).withColumn("style", F.col("style_id").cast("string"))
    return found.withColumn("dim", F.lit("zip_style")).drop("style_id")


def _age(day: Column, as_of: date | str) -> Column:
    """Number of the narrowest snapshot that a day lies in; NULL outside all."""
    ago = F.datediff(X.as_date(as_of), day)
    found = narrowest(ago, list(WINDOWS.values()))
    # The snapshot of today holds the day before only; the day itself is in the others.
    return F.when(ago == 0, 1).otherwise(found)


def wide_metrics(inputs: Inputs, as_of: date | str, bands: Sequence[int] = BANDS) -> DataFrame:
    """One row per day, dealer and style: all metrics of the dealer itself, its market at each
    distance and the nation, for each snapshot, as columns `<metric>_<scope>_<window>`.

    Cars moved on were first seen within the snapshot too. Statistics of a measure count values above
    zero and are trimmed within scope, snapshot and sold state; days of supply divide
    by the snapshot's days. Everything is NULL, and counts too, where a dealer has no market.
    Cars of a style meet by a single shuffle for all scopes and snapshots, where few enough are repeated for its
    markets; other styles are counted by value.
    """
    facts = stage(
        daily_facts(inputs, as_of, max(WINDOWS.values()) + 1)
        .select(
            "dealer_id",
            "style_id",
            "zip",
            sold_state(F.col("sold_flg")).alias("sold"),
            _age(F.col("vin_last_dt"), as_of).alias("age"),
            _age(F.col("vin_frst_dt"), as_of).alias("first_age"),
            *X.named({m: X.hundredths(m) for m in MEASURES}),
        )
        .filter("age is not null"),
        "wide-facts",
    )
    many = stage(T.crowded_markets(facts, "style_id", "zip", T.TOGETHER, T.REPEATED), "crowded")
    few, rest = T.apart(facts, "style_id", many)
    wide = _wide_of_styles(few, inputs.zipdist, bands)
    if rest is not None:
        wide = wide.unionByName(_wide_of_values(rest, inputs.zipdist, bands))
    return wide.withColumn("calendar_date", X.as_date(as_of))


def _supplies(bands: Sequence[int], counts: Mapping[str, str]) -> dict[str, str]:
    """Days of supply per scope and snapshot, from SQL text of the counts."""
    found = {}
    for s in ("dealer", *[f"{b}_mile_market" for b in bands], NATIONWIDE):
        for w, days in WINDOWS.items():
            lstd, sold = (counts[f"cars_{state}_{s}_{w}"] for state in ("lstd", "sold"))
            found[f"days_supply_{s}_{w}"] = days_supply(lstd, f"if({sold} >= {SUPPLY_MIN_N}, {sold}, 0L)", days)
    return found


def _flags() -> dict[str, str]:
    """Conditions of the counts of each snapshot, as SQL text over a car's classes."""
    flags = {}
    for i, w in enumerate(WINDOWS):
        flags[f"cars_sold_{w}"] = f"age <= {i} and sold = {SOLD}"
        flags[f"cars_lstd_{w}"] = f"age <= {i} and sold = {LISTED}"
        flags[f"cars_moved_on_{w}"] = f"age <= {i} and first_age <= {i}"
    return flags


def _wide_of_styles(facts: DataFrame, zipdist: DataFrame, bands: Sequence[int]) -> DataFrame:
    """The wide row's counts and statistics, of cars of which a task can hold all that share the style.

    Each car is repeated for the nation, its dealer and the style's zips that it is near. A group of any of these scopes
    has cells, by age and band. Those with the same oldest and farthest car hold the same cars, so `at` names a
    cell by these two, and statistics are computed once per name. `market` and `nation` come to the dealer's rows by a
    window, as all rows of a style are in the same task.
    """
    windows, size = list(WINDOWS), len(bands)
    columns = ["style_id", "dealer_id", "zip", "sold", "age", "first_age", *MEASURES]
    cars = T.together(facts.select(*columns), "style_id").selectExpr(
        "*", "collect_set(zip) over (partition by style_id) as zips"
    )
    scopes = "array(struct(0 as scope, string(null) as centre), struct(1 as scope, string(null) as centre))"
    repeated = cars.selectExpr(*columns, f"inline(concat({scopes}, transform(zips, z -> struct(2 as scope, z as centre))))")
    near = zipdist.filter(F.col("distance") <= max(bands)).select(
        F.col("zip1").alias("centre"), F.col("zip2").alias("zip"), narrowest(F.col("distance"), bands).alias("near")
    )
    located = repeated.join(near, ["centre", "zip"], "left").withColumn("band", F.expr("if(scope = 2, near, 0)"))
    group = ["style_id", "scope", "dealer", "place"]
    own = {"dealer": "if(scope = 1, dealer_id, null)", "place": "if(scope = 2, centre, if(scope = 1, zip, null))"}
    placed = located.filter("band is not null").select(
        "style_id", "scope", *X.named(own), "sold", "age", "first_age", "band", *MEASURES
    )

    # Counts of sold, listed and moved-on cars of a cell travel as one number.
    if T.TOGETHER >> _COUNT_BITS:
        raise ValueError(f"a task may hold fewer than {1 << _COUNT_BITS} cars")
    cells = [(i, j) for i in range(len(windows)) for j in range(size)]
    states = f"if(sold = {SOLD}, 1L, 0L) + if(sold = {LISTED}, {1 << _COUNT_BITS}L, 0L)"
    counted = {
        f"n_{i}_{j}": f"sum(if(age <= {i} and band <= {j}, {states} + if(first_age <= {i}, {1 << 2 * _COUNT_BITS}L, 0L), 0L))"
        for i, j in cells
    }
    counted |= {f"band_{i}": f"min(if(age = {i}, band, null))" for i in range(len(windows))}
    counted |= {f"age_{j}": f"min(if(band = {j}, age, null))" for j in range(size)}
    groups = placed.groupBy(*group).agg(
        F.collect_list(F.struct("sold", "age", "band", *MEASURES)).alias("cars"), *X.named(counted)
    )

    def last(column: str, upto: int, within: int) -> str:
        return f"case {' '.join(f'when {column}_{k} <= {within} then {k}' for k in reversed(range(upto + 1)))} end"

    names = [f"({last('band', i, j)}) * {size} + ({last('age', j, i)})" for i, j in cells]
    arrays = {"counts": f"array({', '.join(f'n_{i}_{j}' for i, j in cells)})", "at": f"array({', '.join(names)})"}
    listed = groups.select(*group, "cars", *X.named(arrays))
    apart = listed.selectExpr("*", "posexplode(array_distinct(array_compact(at))) as (i, cell)")
    inside = f"filter(cars, c -> c.age <= cell div {size} and c.band <= cell % {size})"
    once = {c: f"if(i = 0, {c}, null)" for c in ("counts", "at")}
    held = apart.select(*group, "cell", *X.named(once | {"cars": f"if(cell = at[size(at) - 1], cars, {inside})"}))
    found = T.statistics_of_cars(held, [*group, "cell", "counts", "at"], MEASURES)
    entry = f"struct(cell, struct({', '.join(MEASURES)}) as statistics)"
    whole = found.groupBy(*group).agg(
        F.expr(f"map_from_entries(collect_list({entry})) as statistics"),
        *X.named({c: f"first({c}, true)" for c in once}),
    )
    # One after the other, so that the rows' order by style and place serves both.
    joined = whole
    for scope, name, by in ((2, "market", "style_id, place"), (0, "nation", "style_id")):
        there = f"if(scope = {scope}, struct(counts, at, statistics), null)"
        joined = joined.selectExpr("*", f"first({there}, true) over (partition by {by}) as {name}")
    joined = joined.filter("scope = 1")

    def of(part: str, scope: str, j: int = 0) -> dict[str, str]:
        n, statistics, room = {}, {}, (1 << _COUNT_BITS) - 1
        for i, w in enumerate(windows):
            cell = i * size + j
            for k, kind in enumerate(KINDS):
                shift = k * _COUNT_BITS
                n[f"cars_{kind}_{scope}_{w}"] = f"(shiftright({part}counts[{cell}], {shift}) & {room}L)"
            for m in MEASURES:
                for s in STATISTICS:
                    name, state = s.split("_")
                    statistics[f"{name}_{m}_{state}_{scope}_{w}"] = f"{part}statistics[{part}at[{cell}]].{m}.{s}"
        return n | statistics

    wide = of("", "dealer") | of("nation.", NATIONWIDE)
    for j, b in enumerate(bands):
        wide |= of("market.", f"{b}_mile_market", j)
    # All columns in one projection: a row of hundreds is costly to write twice.
    return joined.select("style_id", F.col("dealer").alias("dealer_id"), *X.named(wide | _supplies(bands, wide)))


def _wide_of_values(facts: DataFrame, zipdist: DataFrame, bands: Sequence[int]) -> DataFrame:
    """As `_wide_of_styles`, of any number of cars: values are counted, and the counts sent to the markets."""
    windows = list(WINDOWS)
    flags = _flags()
    counted = stage(
        facts.groupBy("dealer_id", "style_id", "zip").agg(
            *[F.sum(X.snapshot_flag(F.expr(c))).alias(name) for name, c in flags.items()]
        ),
        "wide-counts",
    )
    dealer = counted.select("dealer_id", "style_id", "zip", *_scoped(flags, "dealer"))
    near = band_counts(counted, zipdist, ["style_id"], list(flags), bands)
    for b in bands:
        near = near.withColumnsRenamed({f"{f}_{b}": _in_scope(f, f"{b}_mile_market") for f in flags})
    nation = counted.groupBy("style_id").agg(
        *[F.sum(f).alias(_in_scope(f, NATIONWIDE)) for f in flags]
    )

    ages = nested_cells("a", "age", len(windows))
    values = stage(_own_values(facts), "wide-values")
    parts = {
        "dealer": cell_histogram(values, ["dealer_id", "style_id", "measure", "sold"], ages, "n"),
        NATIONWIDE: cell_histogram(values, ["style_id", "measure", "sold"], ages, "n"),
    }
    reach = market_reach(zipdist, counted, ["style_id"], max(bands)).select(
        "zip", "style_id", "zip2", narrowest(F.col("distance"), bands).alias("band")
    )
    zipped = value_histogram(values, ["zip"], ["style_id", "measure", "sold", "age"], copies="n")
    spread = zipped.drop("bucket").withColumnRenamed("zip", "zip2").join(reach, ["zip2", "style_id"])
    both = crossed(ages, nested_cells("b", "band", len(bands)))
    parts["market"] = cell_histogram(spread, ["zip", "style_id", "measure", "sold"], both, "n")

    # What shares a key meets first, so that the wide row moves once for each further key.
    found = {"dealer": dealer, NATIONWIDE: nation, "market": near}
    for scope, hist in parts.items():
        keys = [k for k in hist.columns[:3] if k not in ("measure", "sold")]
        cells = both if scope == "market" else ages
        named = {}
        for c in cells:
            age, _, band = c.partition("_")
            place = f"{bands[int(band[1:])]}_mile_market" if band else scope
            named[c] = f"{place}_{windows[int(age[1:])]}"
        statistics = _statistics(stage(hist, "wide-cells"), keys, cells, named)
        found[scope] = found[scope].join(statistics, keys, "left")
    wide = found["dealer"].join(found[NATIONWIDE], "style_id")
    wide = wide.join(found["market"], ["zip", "style_id"], "left")
    return wide.select("*", *X.named(_supplies(bands, {c: c for c in wide.columns}))).drop("zip")


def _own_values(facts: DataFrame) -> DataFrame:
    """Copies of each value above zero per dealer, style, zip, measure, sold state and age."""
    keys = ["dealer_id", "style_id", "zip", "sold", "age"]
    long = facts.unpivot(keys, list(MEASURES), "measure", "x").filter("x > 0")
    return long.groupBy(*keys, "measure", "x").agg(F.count(F.lit(1)).alias("n"))


def _statistics(hist: DataFrame, keys: list[str], cells: dict[str, str], named: dict[str, str]) -> DataFrame:
    """One row per keys, with the statistics of all measures and cells as columns."""
    rows = cell_rows(hist, [*keys, "measure", "sold"], cells)
    wide = {
        f"{statistic}_{c}": sql for c in cells for statistic, sql in trimmed_and_medians(c).items()
    }
    per_measure = rows.groupBy(*keys, "measure").agg(*X.named(wide))
    # The few measures of a key meet as a map, so the pivot is one aggregate and not hundreds.
    entry = F.struct("measure", F.struct(*wide).alias("statistics"))
    together = per_measure.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    columns = [
        F.col("m")[m][f"{s}_{c}"].alias(f"{s.split('_')[0]}_{m}_{s.split('_')[1]}_{named[c]}")
        for m in MEASURES
        for c in cells
        for s in STATISTICS
    ]
    return stage(together.select(*keys, *columns), "wide-statistics")


def _in_scope(flag: str, scope: str) -> str:
    """cars_sold_45_day and 25_mile_market give cars_sold_25_mile_market_45_day."""
    for w in WINDOWS:
        if flag.endswith(f"_{w}"):
            return f"{flag.removesuffix(f'_{w}')}_{scope}_{w}"
    raise ValueError(flag)


def _scoped(flags: Sequence[str], scope: str) -> list[Column]:
    return [F.col(f).alias(_in_scope(f, scope)) for f in flags]
