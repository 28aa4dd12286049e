"""DuckDB SQL for every registered query, written row by row with windows.

Nothing here uses histograms or buckets: medians, ranks and deviations are taken
over the rows of a group, so the SQL checks the library's shortcuts.
"""

from __future__ import annotations

from datetime import date, timedelta

from forecourt.functions.rules import MIN_NS
from verification.queries import (
    AS_OF,
    CORRECTION,
    CORRECTION_DAYS,
    DAYS,
    DIMENSIONS,
    FIT_END,
    LATE_DAYS,
    RECONCILE_DAYS,
    SHORT_MEASURES,
    STUDY_DAYS,
    STUDY_START,
    VALIDATION_START,
    days_of,
)

TODAY = f"DATE '{AS_OF}'"

# What values exactly on a bound may miss it by, for prices and for logarithms.
SLACK = "1e-7"
LOG_SLACK = "1e-12"

INPUTS = """
z as (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey, l_suppkey, l_extendedprice, l_quantity) as rn
  from lineitem),
hist as (
  select cast(l_orderkey * 10 + l_linenumber as varchar) as vin, l_suppkey as dealer_id,
    cast(l_shipdate as date) - cast(l_quantity as integer) as vin_frst_dt,
    cast(l_shipdate as date) as vin_last_dt, l_linestatus = 'F' as sold_flg,
    rn = 1 as latest_record_flg,
    case when l_partkey % 10 = 0 and l_orderkey % 3 <> 0
      then cast(900 + l_partkey % 1000 as decimal(12,2))
      else cast(l_extendedprice as decimal(12,2)) end as price,
    cast(cast(l_quantity as integer) * 1000 + l_linenumber * 137 as decimal(12,2)) as mileage
  from z),
dealers as (
  select s_suppkey as dealer_id, cast(s_nationkey as varchar) as zip from supplier),
divisions as (
  select distinct cast(substr(p_brand, 7) as bigint) as division_id,
    p_brand as division_name from part),
models as (
  select cast(row_number() over (order by p_type) as bigint) as model_id, p_type as model_name
  from (select distinct p_type from part)),
vins as (
  select cast(l_orderkey * 10 + l_linenumber as varchar) as vin,
    case when p_size = 50 then null else p_partkey end as style_id,
    case when p_size = 49 then 'N/A' else cast(1992 + p_size % 12 as varchar) end as model_year,
    cast(substr(p_brand, 7) as bigint) as make_id, model_id
  from z join part on l_partkey = p_partkey join models on p_type = model_name
  where rn = 1),
zipdist as (
  select cast(a.n_nationkey as varchar) as zip1, cast(b.n_nationkey as varchar) as zip2,
    cast(abs(a.n_nationkey - b.n_nationkey) * 40 as double) as distance
  from nation a cross join nation b
  where abs(a.n_nationkey - b.n_nationkey) * 40 <= 1000)"""


def facts(days: int = 121) -> str:
    """Listing fact, with keys and snapshot flags."""
    year = f"year({TODAY})"
    return f"""
facts as (
  select h.vin, vin_last_dt, vin_frst_dt, style_id, model_year, make_id, model_id,
    h.dealer_id, zip, sold_flg, price, mileage,
    cast(case when not regexp_matches(model_year, '^[0-9]*$') then null
      when try_cast(model_year as integer) >= {year} then round(mileage)
      else round(cast(round(mileage) as double) / ({year} - try_cast(model_year as integer)), 2)
      end as decimal(10,2)) as mileage_per_year,
    vin_last_dt - vin_frst_dt + 1 as days_on_lot,
    cast(h.dealer_id as varchar) || '*' || cast(style_id as varchar) as dealer_style,
    zip || '*' || cast(style_id as varchar) as zip_style,
    case when vin_last_dt = {TODAY} - 1 then 1 else 0 end as today_snapshot,
    case when vin_last_dt > {TODAY} - 46 then 1 else 0 end as snapshot_45,
    case when vin_last_dt > {TODAY} - 61 then 1 else 0 end as snapshot_60,
    case when vin_last_dt > {TODAY} - 91 then 1 else 0 end as snapshot_90
  from hist h join dealers d on h.dealer_id = d.dealer_id join vins v on h.vin = v.vin
  where latest_record_flg and model_year is not null and style_id is not null
    and vin_last_dt > {TODAY} - {days} and vin_last_dt <= {TODAY}),
markets as (
  select f.* exclude (zip, zip_style), zip1 as zip, f.zip as zip2, distance,
    zip1 || '*' || cast(style_id as varchar) as zip_style
  from facts f join zipdist on zip2 = f.zip
  where zip1 in (select zip from facts))"""


def with_ctes(*ctes: str) -> str:
    return "with " + ",".join([INPUTS, *ctes])


def from_facts(columns: str, days: int = 121) -> str:
    return f"{with_ctes(facts(days))} select {columns} from facts"


# --- metric tables ---------------------------------------------------------------

# Market radii in miles.
BANDS = (25, 50, 100, 250)

SOLD_STATE = "case when sold_flg then 1 when not sold_flg then 0 else -1 end"


def measured(keys: dict[str, str], measure: str, source: str, days: int) -> str:
    """Select of key columns, sold state, moved flag and value."""
    named = ", ".join(f"{sql} as {name}" for name, sql in keys.items())
    near = " and distance <= 100" if source == "markets" else ""
    return f"""
  select {named}, {SOLD_STATE} as sold, cast({measure} as decimal(12,2)) as x,
    case when vin_frst_dt > {TODAY} - {days} then 1 else 0 end as moved
  from {source}
  where {measure} > 0 and vin_last_dt > {TODAY} - {days}{near}"""


def judged_ctes(rows: str, keys: list[str]) -> str:
    group = ", ".join([*keys, "sold"])
    return f"""
rows_ as ({rows}),
profiled as (
  select *, count(*) over g as n_group, avg(ln(x)) over g as mu, stddev_samp(ln(x)) over g as sd
  from rows_ window g as (partition by {group})),
judged as (
  select *, n_group < 6 or ln(x) between mu - 2 * sd - {LOG_SLACK} and mu + 2 * sd + {LOG_SLACK} as keep
  from profiled)"""


def _trimmed(state: int, suffix: str) -> dict[str, str]:
    kept = f"filter (where sold = {state} and keep)"
    return {
        f"avg_{suffix}": f"cast(round(cast(sum(x) {kept} as double) / nullif(count(*) {kept}, 0)) as bigint)",
        f"max_{suffix}": f"cast(round(max(x) {kept}) as bigint)",
        f"min_{suffix}": f"cast(round(min(x) {kept}) as bigint)",
    }


COUNTS = {
    "cars_sold": "count(*) filter (where sold = 1)",
    "cars_lstd": "count(*) filter (where sold = 0)",
    "cars_moved_on": "count(*) filter (where moved = 1)",
}
TRIMMED = {**_trimmed(1, "sold"), **_trimmed(0, "lstd")}
MEDIANS = {
    f"median_{suffix}": "cast(round(round(median(cast(x as double))"
    f" filter (where sold = {state}), 4)) as bigint)"
    for state, suffix in ((1, "sold"), (0, "lstd"))
}


def supply(days: int) -> dict[str, str]:
    selling = f"count(*) filter (where sold = 1 and n_group > 2) / {float(days)}"
    return {
        "days_supply": "cast(ceil(count(*) filter (where sold = 0)"
        f" / nullif({selling}, 0)) as bigint)"
    }


def all_metrics(days: int) -> dict[str, str]:
    return {**COUNTS, **TRIMMED, **MEDIANS, **supply(days)}


def named(columns: dict[str, str]) -> str:
    return ", ".join(f'{sql} as "{name}"' for name, sql in columns.items())


def metric(dimension: str, measure: str, columns: dict[str, str] | None = None) -> str:
    days = days_of(dimension)
    source = "markets" if dimension in ("zip", "zip_style") else "facts"
    rows = measured({dimension: dimension}, measure, source, days)
    ctes = with_ctes(facts(max(days + 1, 121)), judged_ctes(rows, [dimension]))
    columns = all_metrics(days) if columns is None else columns
    return f"{ctes} select {dimension}, {named(columns)} from judged group by {dimension}"


def matrix(dimensions: list[str]) -> str:
    parts = [
        measured(
            {"dim": f"'{d}'", '"key"': f"cast({d} as varchar)", "measure": f"'{m}'"},
            m,
            "markets" if d in ("zip", "zip_style") else "facts",
            DAYS,
        )
        for d in dimensions
        for m in SHORT_MEASURES.values()
    ]
    keys = ["dim", '"key"', "measure"]
    ctes = with_ctes(facts(), judged_ctes(" union all ".join(parts), keys))
    by = ", ".join(keys)
    return f"{ctes} select {by}, {named(all_metrics(DAYS))} from judged group by {by}"


def published() -> str:
    names = {c: c for c in COUNTS} | {
        c: f"{c.split('_')[0]}_price_dealer_id_{c.split('_')[1]}" for c in TRIMMED
    }
    names |= {c: f"median_price_{c.split('_')[1]}" for c in MEDIANS}
    names["days_supply"] = "dealer_id_days_supply"
    renamed = ", ".join(f"{a} as {b}" for a, b in names.items())
    return f"select dealer_id, {renamed} from ({metric('dealer_id', 'price')})"


def market_bands() -> str:
    bands = " union all ".join(
        f"""select '{b}' as band, zip, count(*) filter (where sold_flg) as cars_sold,
          count(*) filter (where not sold_flg) as cars_lstd
        from markets where distance <= {b} group by zip"""
        for b in (25, 50, 100, 250)
    )
    return f"""{with_ctes(facts())} {bands} union all
      select 'nationwide', null, count(*) filter (where sold_flg),
        count(*) filter (where not sold_flg) from facts"""


def wide_daily() -> str:
    windows = {
        "today": "today_snapshot",
        "45_day": "snapshot_45",
        "60_day": "snapshot_60",
        "90_day": "snapshot_90",
    }
    states = {"sold": "sold_flg", "lstd": "not sold_flg"}

    def counted(scope: str, near: str = "") -> str:
        return ", ".join(
            f'count(*) filter (where {flag} and {snapshot} = 1{near}) as "cars_{s}_{scope}_{w}"'
            for w, snapshot in windows.items()
            for s, flag in states.items()
        )

    bands = ", ".join(
        counted(f"{b}_mile_market", f" and distance <= {b}") for b in (25, 50, 100, 250)
    )
    return f"""{with_ctes(facts())},
      own as (select dealer_id, style_id, zip, {counted("dealer")} from facts group by all),
      near as (select zip, style_id, {bands} from markets where distance <= 250 group by all),
      nation_ as (select style_id, {counted("nationwide")} from facts group by all)
      select {TODAY} as calendar_date, own.* exclude (zip), near.* exclude (zip, style_id),
        nation_.* exclude (style_id)
      from own left join near on own.zip = near.zip and own.style_id = near.style_id
        join nation_ on own.style_id = nation_.style_id"""


def metric_matrix_bands() -> str:
    parts = []
    for b in (*BANDS, "nationwide"):
        source = "facts" if b == "nationwide" else f"(select * from markets where distance <= {b})"
        centre = "'nationwide'" if b == "nationwide" else "zip"
        for dim, key in (("zip", centre), ("zip_style", f"{centre} || '*' || style_id::varchar")):
            for m in SHORT_MEASURES.values():
                keys = {"band": f"'{b}'", "dim": f"'{dim}'", '"key"': key, "measure": f"'{m}'"}
                parts.append(measured(keys, m, source, DAYS))
    keys = ["band", "dim", '"key"', "measure"]
    ctes = with_ctes(facts(), judged_ctes(" union all ".join(parts), keys))
    by = ", ".join(keys)
    return f"{ctes} select {by}, {named(all_metrics(DAYS))} from judged group by {by}"


def wide_metrics() -> str:
    windows = {
        "today": ("today_snapshot", 1),
        "45_day": ("snapshot_45", 45),
        "60_day": ("snapshot_60", 60),
        "90_day": ("snapshot_90", 90),
    }
    kinds = {"own": ("dealer",), "near": tuple(f"{b}_mile_market" for b in BANDS), "nation_": ("nationwide",)}
    states = {"sold": "sold_flg", "lstd": "not sold_flg"}
    sources = {"dealer": ("facts", "dealer_id::varchar"), "nationwide": ("facts", "''")} | {
        f"{b}_mile_market": (f"(select * from markets where distance <= {b})", "zip") for b in BANDS
    }
    counted = {}
    for kind, scopes in kinds.items():
        columns = []
        for scope in scopes:
            near = f" and distance <= {scope.split('_')[0]}" if kind == "near" else ""
            for w, (snapshot, days) in windows.items():
                inside = f"{snapshot} = 1{near}"
                since = f"vin_frst_dt > {TODAY} - {days + 1}"
                if w == "today":
                    since += f" and vin_frst_dt < {TODAY}"
                flags = {**states, "moved_on": since}
                columns += [
                    f'count(*) filter (where {inside} and {f}) as "cars_{n}_{scope}_{w}"'
                    for n, f in flags.items()
                ]
                sold, lstd = (f"count(*) filter (where {inside} and {f})" for f in states.values())
                columns.append(
                    f"cast(ceil({lstd} / nullif(case when {sold} >= 3 then {sold} else 0 end"
                    f' / {float(days)}, 0)) as bigint) as "days_supply_{scope}_{w}"'
                )
        counted[kind] = ", ".join(columns)
    rows = " union all ".join(
        f"""select '{scope}' as scope, '{w}' as win, {key} as place, style_id, '{m}' as measure,
          {SOLD_STATE} as sold, cast({m} as decimal(12,2)) as x
        from {source} where {m} > 0 and {snapshot} = 1"""
        for scope, (source, key) in sources.items()
        for w, (snapshot, _) in windows.items()
        for m in SHORT_MEASURES.values()
    )
    picked = {
        kind: ", ".join(
            f"max({statistic}) filter (where scope = '{scope}' and win = '{w}' and measure = '{m}')"
            f' as "{statistic.split("_")[0]}_{m}_{statistic.split("_")[1]}_{scope}_{w}"'
            for scope in scopes
            for w in windows
            for m in SHORT_MEASURES.values()
            for statistic in {**TRIMMED, **MEDIANS}
        )
        for kind, scopes in kinds.items()
    }
    by = ["scope", "win", "place", "style_id", "measure"]
    pivots = ", ".join(
        f"""{kind}_stats as (select place, style_id, {columns} from stats
          where scope in ({", ".join(f"'{s}'" for s in kinds[kind])}) group by all)"""
        for kind, columns in picked.items()
    )
    return f"""{with_ctes(facts(), judged_ctes(rows, by))},
      stats as (select {", ".join(by)}, {named({**TRIMMED, **MEDIANS})} from judged group by all),
      {pivots},
      own as (select dealer_id, style_id, zip, {counted["own"]} from facts
        where snapshot_90 = 1 group by all),
      near as (select zip, style_id, {counted["near"]} from markets
        where snapshot_90 = 1 and distance <= 250 group by all),
      nation_ as (select style_id, {counted["nation_"]} from facts where snapshot_90 = 1 group by all)
      select {TODAY} as calendar_date, own.* exclude (zip), near.* exclude (zip, style_id),
        nation_.* exclude (style_id), own_stats.* exclude (place, style_id),
        near_stats.* exclude (place, style_id), nation__stats.* exclude (place, style_id)
      from own left join near on own.zip = near.zip and own.style_id = near.style_id
        join nation_ on own.style_id = nation_.style_id
        left join own_stats on own.dealer_id::varchar = own_stats.place and own.style_id = own_stats.style_id
        left join near_stats on own.zip = near_stats.place and own.style_id = near_stats.style_id
        left join nation__stats on own.style_id = nation__stats.style_id"""


def published_tables() -> str:
    metrics = ", ".join(all_metrics(DAYS))
    return f"""select measure || '_' || dim || '_{DAYS}' as table_name, "key", {metrics}
      from ({matrix(list(DIMENSIONS.values()))})"""


def matrix_refreshed() -> str:
    """The full build from the records that are known at the end."""
    late = f"case when vin::bigint % 7 = 0 then {LATE_DAYS} else 0 end"
    known = f"""
posted as (
  select * replace (true as latest_record_flg), vin_last_dt + {late} as posted from hist
  union all
  select * replace (true as latest_record_flg, cast(price + {CORRECTION} as decimal(12,2)) as price),
    vin_last_dt + {late} + {CORRECTION_DAYS} from hist where vin::bigint % 11 = 0),
known as (
  select * from posted where posted <= {TODAY} and vin::bigint % 13 <> 0
  qualify row_number() over (partition by vin order by vin_last_dt desc, posted desc, dealer_id desc,
    vin_frst_dt desc, sold_flg desc, price desc, mileage desc) = 1)"""
    whole = matrix(list(DIMENSIONS.values()))
    return whole.replace("\nfacts as (", f"{known},\nfacts as (", 1).replace("from hist h", "from known h", 1)


def reconcile_buckets() -> str:
    shift = timedelta(days=RECONCILE_DAYS)

    def build(start: date, end: date) -> str:
        rows = study_select(STYLE["known"], start, end)
        return f"select style_id, cast(sum(price * 100) as bigint) as x from ({rows}) group by style_id"

    first, second = build(STUDY_START, AS_OF - shift), build(STUDY_START + shift, AS_OF)
    return f"""{with_ctes(f"a as ({first})", f"b as ({second})")}
      select count(*) filter (where a.style_id is not null and b.style_id is not null) as in_both,
        count(*) filter (where b.style_id is null) as only_in_a,
        count(*) filter (where a.style_id is null) as only_in_b,
        count(*) filter (where a.style_id is not null and b.style_id is not null and a.x <> b.x) as n_differ,
        min(a.x - b.x) as min_diff, max(a.x - b.x) as max_diff
      from a full join b on a.style_id = b.style_id"""


# --- outlier study ---------------------------------------------------------------

STYLE = {
    "key": ["style_id"],
    "carry": {"model_year": "min(model_year)", "make": "min(make)"},
    "known": "style_id is not null and model_year is not null",
}
YMM = {
    "key": ["model_year", "make_id", "model_id"],
    "carry": {"make": "min(make)", "model": "min(model)"},
    "known": "model_year is not null",
}


def study_select(known: str, start: date | str | None, end: date | str) -> str:
    since = f" and vin_last_dt >= DATE '{start}'" if start else ""
    return f"""
  select h.vin, h.dealer_id, vin_last_dt, price, style_id, model_year, make_id, model_id,
    division_name as make, model_name as model
  from hist h join dealers d on h.dealer_id = d.dealer_id join vins v on h.vin = v.vin
    join divisions on make_id = division_id join models m using (model_id)
  where latest_record_flg and price > 0 and {known}
    and vin_last_dt <= DATE '{end}'{since}"""


def near(value: str, low: str, high: str, slack: str = SLACK) -> str:
    return f"{value} between ({low}) - {slack} and ({high}) + {slack}"


GAP = "cast(price - med as double)"
# The rules' names and multiples.
MEAN_OR_MAD = "case when mad = 0 then {m} * meanad else {k} * mad end"
KEPT = {
    "med": near(GAP, "-5.189 * mad", "5.189 * mad"),
    "med_nob": near(GAP, "-3.5 * mad", "3.5 * mad"),
    "med_dl": near(GAP, "-3.7 * mad", "5.189 * mad"),
    "med_nob_dl": near(GAP, "-2.5 * mad", "3.5 * mad"),
    "med_ibm": near(
        GAP, MEAN_OR_MAD.format(m=-4.3866, k=-5.189), MEAN_OR_MAD.format(m=4.3866, k=5.189)
    ),
    "med_nob_ibm": near(
        GAP, MEAN_OR_MAD.format(m=-3.5, k=-3.5), MEAN_OR_MAD.format(m=3.5, k=3.5)
    ),
    "med_dl_ibm": near(
        GAP, MEAN_OR_MAD.format(m=-3.13, k=-3.7), MEAN_OR_MAD.format(m=4.3866, k=5.189)
    ),
    "med_nob_dl_ibm": near(
        GAP, MEAN_OR_MAD.format(m=-2.5, k=-2.5), MEAN_OR_MAD.format(m=3.5, k=3.5)
    ),
    "ntiles": "centile between 2 and 99",
    "emp": near("cast(price as double)", "mean_ - 3 * std_", "mean_ + 3 * std_"),
    "chb": near("cast(price as double)", "mean_ - 4.5 * std_", "mean_ + 4.5 * std_"),
    "3std_log": near("ln(price)", "mean_log - 3 * std_log", "mean_log + 3 * std_log", LOG_SLACK),
    "2std_log": near("ln(price)", "mean_log - 2 * std_log", "mean_log + 2 * std_log", LOG_SLACK),
}


def fit_ctes(grain: dict, start: date | str, end: date | str) -> str:
    """Study rows with group statistics and the tests of every rule."""
    by = ", ".join(grain["key"])
    carry = named(grain["carry"])
    tests = ", ".join(f'{sql} as "in_{name}"' for name, sql in KEPT.items())
    return f"""
study as ({study_select(grain["known"], start, end)}),
base as (
  select {by}, {carry}, count(*) as n,
    cast(sum(price) as double) / count(*) as mean_, stddev_samp(cast(price as double)) as std_,
    cast(round(round(median(cast(price as double)), 4)) as bigint) as med,
    min(price) as min_, max(price) as max_,
    avg(ln(price)) as mean_log, stddev_samp(ln(price)) as std_log
  from study group by {by}),
deviations as (
  select {by}, round(median(cast(abs(price - med) as double)), 4) as mad,
    cast(sum(abs(price - med)) as double) / count(*) as meanad
  from study join base using ({by}) group by {by}),
ranked as (
  select s.price, s.vin_last_dt, b.*, mad, meanad,
    ntile(100) over (partition by {", ".join("b." + k for k in grain["key"])}
      order by s.price desc) as centile
  from study s join base b using ({by}) join deviations using ({by})),
tested as (select *, {tests} from ranked)"""


def kept(name: str, t: int) -> str:
    return f'(n < {t} or "in_{name}")'


def rule_columns(name: str, t: int) -> dict[str, str]:
    inside = f"filter (where {kept(name, t)})"
    outside = f"count(*) filter (where not {kept(name, t)})"
    return {
        f"avg_price_{name}_{t}": f"cast(round(cast(sum(price) {inside} as double)"
        f" / nullif(count(*) {inside}, 0)) as bigint)",
        f"outlier_{name}_{t}": outside,
        f"outlier_{name}_pct_{t}": f"round(cast({outside} as double) / count(*), 6)",
    }


def rule_table(name: str, t: int) -> str:
    return f"""{with_ctes(fit_ctes(STYLE, STUDY_START, AS_OF))}
      select style_id, {named(rule_columns(name, t))} from tested group by style_id"""


BASE_COLUMNS = """n, cast(round(mean_) as bigint) as mean, cast(round(std_) as bigint) as std,
    med as median, cast(round(min_) as bigint) as min, cast(round(max_) as bigint) as max"""


def comparison_ctes(grain: dict, start: date | str, end: date | str, min_ns=MIN_NS) -> str:
    by = ", ".join(grain["key"])
    columns = {}
    for name in KEPT:
        for t in min_ns:
            columns |= rule_columns(name, t)
    return f"""{fit_ctes(grain, start, end)},
estimates as (select {by}, {named(columns)} from tested group by {by}),
comparison as (
  select {by}, {", ".join(grain["carry"])}, {BASE_COLUMNS}, mad, meanad, e.* exclude ({by})
  from base join deviations using ({by}) join estimates e using ({by}))"""


def compare(grain: dict, start: date | str) -> str:
    ctes = with_ctes(comparison_ctes(grain, start, AS_OF))
    return f"{ctes} select * from comparison"


def base(grain: dict, extra: str = "") -> str:
    by = ", ".join(grain["key"])
    return f"""{with_ctes(fit_ctes(grain, STUDY_START, AS_OF))}
      select {by}, {", ".join(grain["carry"])}, {BASE_COLUMNS}{extra} from base"""


def mad(grain: dict) -> str:
    by = ", ".join(grain["key"])
    return f"""{with_ctes(fit_ctes(grain, STUDY_START, AS_OF))}
      select {by}, mad, meanad from deviations"""


def mae_pair(label: str, condition: str, estimate: str) -> dict[str, str]:
    where = f"filter (where {condition})"
    total = f"cast(sum(abs(price - {estimate})) {where} as double)"
    return {
        f"mae_{label}": f"round({total} / count(*), 4)",
        f"mae_kept_{label}": f"round({total} / nullif(count(*) {where}, 0), 4)",
    }


def mae_own(grain: dict, start: date | str) -> str:
    by = ", ".join(grain["key"])
    columns = {}
    for name in KEPT:
        for t in MIN_NS:
            columns |= mae_pair(f"{name}_{t}", kept(name, t), f'"avg_price_{name}_{t}"')
    return f"""{with_ctes(comparison_ctes(grain, start, AS_OF))}
      select {named(columns)} from tested join estimates using ({by})"""


COMMON = f"coalesce(n < 11 or {near('cast(price - median as double)', '-3.5 * mad', '3.5 * mad')}, false)"


def common_columns() -> dict[str, str]:
    where = f"filter (where {COMMON})"
    columns = {
        "price": f"round(cast(sum(price) {where} as double) / nullif(count(*) {where}, 0), 4)",
        "price_rough": "round(cast(sum(price) as double) / count(*), 4)",
        **mae_pair("mean", COMMON, "mean"),
    }
    for name in KEPT:
        columns |= mae_pair(name, COMMON, f'"avg_price_{name}_11"')
    return columns


def mae_common(grain: dict) -> str:
    by = ", ".join(grain["key"])
    return f"""{with_ctes(comparison_ctes(grain, STUDY_START, AS_OF, (11,)))}
      select {named(common_columns())} from study s
      left join (select * exclude ({", ".join(grain["carry"])}) from comparison) using ({by})"""


def backtest() -> str:
    start = FIT_END - timedelta(days=STUDY_DAYS - 1)
    later = study_select(STYLE["known"], FIT_END + timedelta(days=1), AS_OF)
    return f"""{with_ctes(comparison_ctes(STYLE, start, FIT_END, (11,)))},
      later as (select style_id, price from ({later}))
      select {named(common_columns())} from later left join comparison using (style_id)"""


def mae_by_window() -> str:
    by = ", ".join(YMM["key"])
    everything = study_select(YMM["known"], None, AS_OF)
    lows = {"curr": 1, "45": 45, "90": 90, "120": 120, "all": 100000}
    windows = ", ".join(f"('{name}', {days})" for name, days in lows.items())
    return f"""{with_ctes(comparison_ctes(YMM, STUDY_START, AS_OF, (11,)))},
      scored as (select {by}, price, vin_last_dt from ({everything})),
      windows(dim, days) as (values {windows})
      select dim, {named(common_columns())}
      from windows left join scored on {TODAY} - vin_last_dt < days
        left join (select * exclude (make, model) from comparison) using ({by})
      group by dim"""


def outlier_report(by: str) -> str:
    columns = {}
    for name in KEPT:
        columns[f"outlier_{name}"] = f'avg("outlier_{name}_11")'
        share = f'"outlier_{name}_pct_11"'
        columns[f"outlier_{name}_pct"] = (
            f"cast(sum(cast(round({share} * 1e6) as bigint)) as double) / (count({share}) * 1e6)"
        )
    return f"""{with_ctes(comparison_ctes(STYLE, STUDY_START, AS_OF))}
      select {by}, {named(columns)} from comparison group by {by}"""


def coverage_report(by: str, t: int) -> str:
    columns = {
        "keys_lt_6": "count(*) filter (where n < 6)",
        "keys_lt_11": "count(*) filter (where n < 11)",
        "keys_ge_11": "count(*) filter (where n >= 11)",
        "keys": "count(*)",
        "cars": "cast(sum(n) as bigint)",
    }
    for name in KEPT:
        o, e = f'"outlier_{name}_{t}"', f'"avg_price_{name}_{t}"'
        columns[f"keys_with_outlier_{name}"] = f"count(*) filter (where {o} > 0)"
        columns[f"outlier_{name}"] = f"cast(sum({o}) as bigint)"
        columns[f"cars_left_{name}"] = f"cast(sum(n - {o}) as bigint)"
        columns[f"avg_price_{name}"] = f"round(cast(sum({e}) as double) / count({e}), 4)"
    return f"""{with_ctes(comparison_ctes(STYLE, STUDY_START, AS_OF))}
      select {by}, {named(columns)} from comparison group by {by}"""


def from_base(columns: str, tail: str = "") -> str:
    return f"{with_ctes(fit_ctes(STYLE, STUDY_START, AS_OF))} select {columns} from base {tail}"


def reconcile() -> str:
    def build(start: date) -> str:
        rows = study_select(STYLE["known"], start, AS_OF)
        return f"select style_id, count(*) as n from ({rows}) group by style_id"

    return f"""{with_ctes(f"a as ({build(STUDY_START)})",
                          f"b as ({build(STUDY_START + timedelta(days=90))})")}
      select min(a.n - b.n) as min_diff, max(a.n - b.n) as max_diff from a join b using (style_id)"""


FACT_COLUMNS = """vin, vin_last_dt, vin_frst_dt, style_id, model_year, make_id, model_id, dealer_id,
  zip, sold_flg, cast(price as double) as price, cast(mileage as double) as mileage,
  cast(mileage_per_year as double) as mileage_per_year, days_on_lot"""
MARKET_COLUMNS = """vin, vin_last_dt, vin_frst_dt, zip_style, zip, zip2, distance, style_id, sold_flg,
  cast(price as double) as price, cast(mileage as double) as mileage,
  cast(mileage_per_year as double) as mileage_per_year, days_on_lot"""


def all_oracles() -> dict[str, str]:
    log_rows = measured({"dealer_id": "dealer_id"}, "mileage", "facts", DAYS)
    trim_rows = measured({"vin": "vin", "dealer_id": "dealer_id"}, "price", "facts", DAYS)
    found = {
        "listing_fact": from_facts(FACT_COLUMNS),
        "composite_keys": from_facts("vin, dealer_style, zip_style"),
        "snapshot_flags": from_facts(
            "vin, today_snapshot, snapshot_45, snapshot_60, snapshot_90"
        ),
        "miles_per_year": from_facts(
            "vin, cast(mileage as double) as mileage, model_year,"
            " cast(mileage_per_year as double) as mileage_per_year"
        ),
        "days_on_lot": from_facts("vin, days_on_lot"),
        "ymm_key": from_facts(
            "vin, try_cast(model_year || cast(make_id as varchar) || cast(model_id as varchar)"
            " as bigint) as ymm_key"
        ),
        "market_fact_100": f"{with_ctes(facts())} select {MARKET_COLUMNS}"
        " from markets where distance <= 100",
        "market_bands": market_bands(),
        "make_model_names": f"""{with_ctes(facts())}
          select vin, make_id, division_name as make, facts.model_id, model_name as model
          from facts join divisions on make_id = division_id
            join models on facts.model_id = models.model_id""",
        "study_rows": f"""{with_ctes(f"s as ({study_select(STYLE['known'], STUDY_START, AS_OF)})")}
          select vin, dealer_id, vin_last_dt, cast(price as double) as price, style_id, model_year,
            make_id, model_id from s""",
        "cars_sold_lstd": metric(
            "dealer_id", "price", {k: COUNTS[k] for k in ("cars_sold", "cars_lstd")}
        ),
        "cars_moved_on": metric("dealer_id", "price", {"cars_moved_on": COUNTS["cars_moved_on"]}),
        "count_by_key_sold": f"""{with_ctes(facts())}, r as (
            {measured({"dealer_id": "dealer_id"}, "price", "facts", DAYS)})
          select dealer_id, sold, count(*) as n from r group by dealer_id, sold""",
        "log_profile": f"""{with_ctes(facts(), judged_ctes(log_rows, ["dealer_id"]))}
          select distinct dealer_id, sold, n_group as n, round(mu, 6) as mean_log,
            round(sd, 6) as std_log from judged""",
        "log2s_trim": f"""{with_ctes(facts(), judged_ctes(trim_rows, ["dealer_id"]))}
          select vin, dealer_id, sold, keep from judged""",
        "trimmed_stats": metric("dealer_id", "price", TRIMMED),
        "group_median": metric("dealer_id", "price", MEDIANS),
        "days_supply": metric("dealer_id", "price", supply(DAYS)),
    }
    for short, dimension in DIMENSIONS.items():
        for name, measure in SHORT_MEASURES.items():
            found[f"metric_{name}_{short}"] = metric(dimension, measure)
    for short in ("style", "dealer", "zip", "zip_style", "dealer_style"):
        found[f"dim_{short}"] = matrix([DIMENSIONS[short]])
    found["dim_snapshots"] = matrix(
        ["today_snapshot", "snapshot_45", "snapshot_60", "snapshot_90"]
    )
    found["metric_matrix_long"] = matrix(list(DIMENSIONS.values()))
    found["wide_daily"] = wide_daily()
    found["metric_matrix_bands"] = metric_matrix_bands()
    found["wide_daily_metrics"] = wide_metrics()
    found["publish"] = published()
    found |= {
        "published_tables": published_tables(),
        "market_ensured": f"""{with_ctes(facts())} select {MARKET_COLUMNS}, 3::int as n_builds
          from markets where distance <= 100""",
        "metric_statement": metric("dealer_id", "mileage"),
        "matrix_refreshed": matrix_refreshed(),
        "bucketed_listing_fact": from_facts(FACT_COLUMNS),
        "footer_freshness": f"{with_ctes()} select max(vin_last_dt) as latest from hist",
        "reconcile_buckets": reconcile_buckets(),
    }
    for name in KEPT:
        for t in MIN_NS:
            found[f"out_{name}_{t}"] = rule_table(name, t)
    label = (
        ", try_cast(model_year || cast(make_id as varchar) || cast(model_id as varchar)"
        " as bigint) as ymm_key"
    )
    found |= {
        "base_stats_style": base(STYLE),
        "base_stats_ymm": base(YMM, label),
        "mad_style": mad(STYLE),
        "mad_ymm": mad(YMM),
        "compare_methods": compare(STYLE, STUDY_START),
        "compare_methods_ymm": compare(YMM, STUDY_START),
        "compare_methods_val": compare(STYLE, VALIDATION_START),
        "mae_common": mae_common(STYLE),
        "mae_common_ymm": mae_common(YMM),
        "mae_own": mae_own(STYLE, STUDY_START),
        "mae_own_val": mae_own(STYLE, VALIDATION_START),
        "backtest_oot": backtest(),
        "mae_by_window": mae_by_window(),
        "rpt_outliers_year_make": outlier_report("model_year, make"),
        "rpt_outliers_make": outlier_report("make"),
        "rpt_cov_year_11": coverage_report("model_year", 11),
        "rpt_cov_make_11": coverage_report("make", 11),
        "rpt_cov_year_6": coverage_report("model_year", 6),
        "rpt_cov_make_6": coverage_report("make", 6),
        "size_buckets": from_base(
            "case when n < 6 then 1 else 0 end as lt_6, case when n < 11 then 1 else 0 end as lt_11,"
            " case when n >= 11 then 1 else 0 end as ge_11, count(*) as keys",
            "group by 1, 2, 3",
        ),
        "size_totals": from_base(
            "count(*) filter (where n < 6) as lt_6, count(*) filter (where n < 11) as lt_11,"
            " count(*) filter (where n >= 11) as ge_11"
        ),
        "key_check": from_base("count(*) as n_rows, count(distinct style_id) as n_keys"),
        "input_key_checks": f"""{with_ctes()}
          select 'vins' as input, count(*) as n_rows, count(distinct vin) as n_keys from vins
          union all select 'hist', count(*), count(distinct vin) from hist
          union all select 'zipdist', count(*), count(distinct zip1 || '-' || zip2) from zipdist
          union all select 'styles', count(*), count(distinct style_id) from vins""",
        "freshness": f"{with_ctes()} select max(vin_last_dt) as latest from hist",
        "reconcile_versions": reconcile(),
    }
    return found
