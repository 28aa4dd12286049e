"""The metric table as one SQL statement with parameters, and how to run such statements.

Names of tables and columns go in through IDENTIFIER and values through markers, so nothing that a
caller passes is ever read as SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession

#: Parameters: source, key and measure (names), as_of (date), days, sigma, min_n and supply_min_n.
METRIC_TABLE = """
with rows as (
  select identifier(:key) as key, cast(identifier(:measure) as decimal(12,2)) as x,
    case when sold_flg then 1 when not sold_flg then 0 else -1 end as sold,
    if(vin_frst_dt > date_sub(:as_of, :days), 1, 0) as moved
  from identifier(:source)
  where identifier(:measure) > 0 and vin_last_dt > date_sub(:as_of, :days) and vin_last_dt <= :as_of
), counted as (
  select key, sold, moved, x, count(*) as n from rows where key is not null group by all
), profiled as (
  select *, sum(n) over g as n_group, min(x) over g < max(x) over g as varies,
    sum(n * ln(x)) over g / sum(n) over g as mean_log
  from counted window g as (partition by key, sold)
), ranked as (
  select *, if(varies, sqrt(sum(n * pow(ln(x) - mean_log, 2)) over g / nullif(n_group - 1, 0)), 0) as std_log,
    sum(n) over (partition by key, sold order by x, moved rows unbounded preceding) as last_rank
  from profiled window g as (partition by key, sold)
), judged as (
  select *, last_rank - n + 1 as first_rank,
    n_group < :min_n or abs(ln(x) - mean_log) <= :sigma * std_log + 1e-12 as keep,
    floor((n_group + 1) / 2) as low_middle, floor(n_group / 2) + 1 as high_middle
  from ranked
)
select key, sum(if(sold = 1, n, 0)) as cars_sold, sum(if(sold = 0, n, 0)) as cars_lstd,
  sum(if(moved = 1, n, 0)) as cars_moved_on,
  bigint(round(sum(x * n) filter (where sold = 1 and keep) / sum(n) filter (where sold = 1 and keep))) as avg_sold,
  bigint(round(max(x) filter (where sold = 1 and keep))) as max_sold,
  bigint(round(min(x) filter (where sold = 1 and keep))) as min_sold,
  bigint(round(sum(x * n) filter (where sold = 0 and keep) / sum(n) filter (where sold = 0 and keep))) as avg_lstd,
  bigint(round(max(x) filter (where sold = 0 and keep))) as max_lstd,
  bigint(round(min(x) filter (where sold = 0 and keep))) as min_lstd,
  bigint(round((sum(x) filter (where sold = 1 and low_middle between first_rank and last_rank)
    + sum(x) filter (where sold = 1 and high_middle between first_rank and last_rank)) / 2)) as median_sold,
  bigint(round((sum(x) filter (where sold = 0 and low_middle between first_rank and last_rank)
    + sum(x) filter (where sold = 0 and high_middle between first_rank and last_rank)) / 2)) as median_lstd,
  bigint(ceil(sum(if(sold = 0, n, 0))
    / nullif(sum(if(sold = 1 and n_group >= :supply_min_n, n, 0)) / double(:days), 0))) as days_supply
from judged group by key
"""


def select(spark: SparkSession, statement: str, parameters: Mapping[str, Any] | None = None) -> DataFrame:
    """The rows of a statement; each `:name` in it takes the parameter of that name."""
    return spark.sql(statement, dict(parameters or {}))


def select_one(
    spark: SparkSession, statement: str, parameters: Mapping[str, Any] | None = None
) -> Row | None:
    """The first row of a statement, or None."""
    return select(spark, statement, parameters).first()


def run(spark: SparkSession, statement: str, parameters: Mapping[str, Any] | None = None) -> None:
    """Carry out a statement that returns nothing, such as the creation of a table."""
    select(spark, statement, parameters).collect()


def metric_table(
    spark: SparkSession,
    source: str,
    key: str,
    measure: str,
    as_of: date,
    days: int = 90,
    sigma: float = 2,
    min_n: int = 6,
    supply_min_n: int = 3,
) -> DataFrame:
    """All metrics of one measure by one key, from the catalog table `source` of listing facts.

    The statement ranks the values of a group in one task, each value once; for groups of very many
    different values use `daily.dimension_table`.
    """
    parameters = {
        "source": source,
        "key": key,
        "measure": measure,
        "as_of": as_of,
        "days": days,
        "sigma": float(sigma),
        "min_n": min_n,
        "supply_min_n": supply_min_n,
    }
    return select(spark, METRIC_TABLE, parameters)
