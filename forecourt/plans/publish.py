"""Publication of the daily tables under their names: all tables of a day at once, or none of them.

A run writes the long matrix once, fanned out into a folder per measure and dimension. Nothing reads
these files until the run is committed, which is one small file more in the list of runs. The
36 named tables are views that read the newest committed run of the latest day, so they all change
together, and an aborted run leaves them as they were.

    <root>/tables/as_of=<day>/run=<run>/measure=<measure>/dim=<dimension>/*.parquet
    <root>/runs/*.parquet      (as_of, run, at)
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.listing import MEASURES
from forecourt.plans.daily import DIMENSIONS

# Types of the keys in the named tables; in the matrix all keys are text.
KEY_TYPES = {
    "style_id": "bigint",
    "dealer_id": "bigint",
    "dealer_style": "string",
    "zip": "string",
    "zip_style": "string",
    "today_snapshot": "int",
    "snapshot_45": "int",
    "snapshot_60": "int",
    "snapshot_90": "int",
}
METRICS = (
    "cars_sold",
    "cars_lstd",
    "cars_moved_on",
    *[f"{s}_{state}" for state in ("sold", "lstd") for s in ("avg", "max", "min")],
    "median_sold",
    "median_lstd",
    "days_supply",
)
RUNS = "as_of date, run string, at timestamp"

# Published tables are read many times, and runs stay on disk.
CODEC = "zstd"


def tables(days: int = 90) -> Iterator[tuple[str, str, str]]:
    """Name, measure and dimension of every table."""
    for dim in DIMENSIONS:
        for measure in MEASURES:
            yield f"{measure}_{dim}_{days}", measure, dim


def _day(as_of: date | str) -> date:
    return as_of if isinstance(as_of, date) else date.fromisoformat(as_of)


def laid_out(matrix: DataFrame) -> DataFrame:
    """A matrix (dim, key, measure and metrics) as the tables have it: rows of a table lie together.

    Large tables get several partitions, small ones one. A matrix that is published more than once is laid out
    once, and staged.
    """
    slim = matrix.select("key", *METRICS, "measure", "dim")
    return slim.hint("rebalance", F.col("measure"), F.col("dim"))


def write_run(matrix: DataFrame, root: str, as_of: date | str, lies: bool = False) -> str:
    """Write a day's matrix (dim, key, measure and metrics); returns the run, not yet committed.

    Large tables get several files, small ones one. A matrix that `lies` as `laid_out` left it is not moved again.
    """
    run = f"r{uuid.uuid4().hex}"  # never read as a number
    folder = f"{root}/tables/as_of={_day(as_of)}/run={run}"
    ready = matrix if lies else laid_out(matrix)
    ready.write.partitionBy("measure", "dim").parquet(folder, compression=CODEC)
    return run


def commit_run(spark: SparkSession, root: str, as_of: date | str, run: str) -> None:
    """From now on the tables show this run, unless they show a later day."""
    row = (_day(as_of), run, datetime.now(UTC).replace(tzinfo=None))
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")


def create_tables(spark: SparkSession, root: str, days: int = 90, database: str | None = None) -> list[str]:
    """Create or replace the views of all named tables; returns their names.

    They need no refresh when a day is published. Before the first day they are empty.
    """
    nothing = spark.createDataFrame([], f"key string, {', '.join(f'{m} bigint' for m in METRICS)}")
    anchor = f"{root}/tables/as_of=1970-01-01/run=none/measure=none/dim=none"
    nothing.write.mode("overwrite").parquet(anchor)  # gives the files a schema
    spark.createDataFrame([], RUNS).write.mode("append").parquet(f"{root}/runs")
    created = []
    for name, measure, dim in tables(days):
        full = f"`{database}`.`{name}`" if database else f"`{name}`"
        spark.sql(f"create or replace view {full} as {_statement(root, measure, dim)}")
        created.append(full)
    return created


def _statement(root: str, measure: str, dim: str) -> str:
    """The select behind one named table; all names in it are our own but the folder's."""
    folder = root.replace("`", "``")
    columns = {m: published_name(m, dim, measure) for m in METRICS}
    named = ", ".join(f"{m} as {name}" for m, name in columns.items())
    return f"""select cast(key as {KEY_TYPES[dim]}) as {dim}, {named} from parquet.`{folder}/tables`
      where measure = '{measure}' and dim = '{dim}'
        and run = (select max_by(run, struct(as_of, at)) from parquet.`{folder}/runs`)"""


def published_name(metric: str, dim: str, measure: str) -> str:
    """A metric's name in its table."""
    statistic, _, state = metric.partition("_")
    if statistic == "median":
        return f"median_{measure}_{state}"
    if metric == "days_supply":
        return f"{dim}_days_supply"
    return metric if statistic == "cars" else f"{statistic}_{measure}_{dim}_{state}"


def publish_tables(matrix: DataFrame, root: str, as_of: date | str, lies: bool = False) -> str:
    """Write and commit one day, see `write_run`; returns its run."""
    run = write_run(matrix, root, as_of, lies)
    commit_run(matrix.sparkSession, root, as_of, run)
    return run


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """All committed runs, with `current` for the one that the tables show."""
    runs = spark.read.schema(RUNS).parquet(f"{root}/runs")
    latest = runs.agg(F.max(F.struct("as_of", "at", "run")).alias("latest"))
    return runs.join(latest, F.struct("as_of", "at", "run") == F.col("latest"), "left").select(
        "as_of", "run", "at", F.col("latest").isNotNull().alias("current")
    )


# --- tables that are built when they are absent or out of date -----------------------------------

AS_OF, INPUTS = "forecourt.as_of", "forecourt.inputs"


def input_version(*frames: DataFrame) -> str:
    """A checksum of the files that frames are read from: their paths, sizes and times.

    Frames that read no files have no version that could be compared.
    """
    files = sorted({f for df in frames for f in df.inputFiles()})
    if not files:
        raise ValueError("no files are read")
    spark = frames[0].sparkSession
    listed = spark.read.format("binaryFile").load(files).select(
        F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)").alias("h")
    )
    total, n = listed.agg(F.sum("h"), F.count("h")).first()
    return f"{n}:{total}"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    rows = spark.sql("show tblproperties identifier(:name)", {"name": name}).collect()
    return {r[0]: r[1] for r in rows}


def ensure_current(
    spark: SparkSession,
    name: str,
    folder: str,
    builder: Callable[[], DataFrame],
    as_of: date | str,
    version: str,
) -> tuple[DataFrame, bool]:
    """The catalog table `name` for a day and a version of the inputs, and whether it was built now.

    It is reused only if its properties name the same day and version. Otherwise `builder`'s rows are written to a
    new folder, and the name changes over to them in one step; a build that fails leaves it as it was.
    """
    wanted = {AS_OF: _day(as_of).isoformat(), INPUTS: version}
    held = _properties(spark, name)
    if all(held.get(k) == v for k, v in wanted.items()):
        return spark.table(name), False
    path = f"{folder}/{uuid.uuid4().hex}"
    builder().write.parquet(path)
    quoted = path.replace("`", "``")
    # Names go in as identifiers; properties take no parameters, so their values are quoted.
    literal = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    properties = ", ".join(f"'{k}' = {literal(v)}" for k, v in wanted.items())
    spark.sql(
        f"create or replace view identifier(:name) tblproperties ({properties})"
        f" as select * from parquet.`{quoted}`",
        {"name": name},
    )
    return spark.table(name), True
