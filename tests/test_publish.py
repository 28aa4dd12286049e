"""Publication of all tables, tables ensured by day and inputs, and statements with parameters."""

import pytest
from conftest import AS_OF, ago, rows_of
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from forecourt.operators.listing import listing_fact
from forecourt.plans import daily, publish, statements


@pytest.fixture
def matrix(listings):
    cars = [{"price": 100 + i, "sold": i % 2 == 0} for i in range(8)]
    return daily.metric_matrix(listings(cars), AS_OF)


def test_all_tables_change_at_once_and_only_with_a_commit(spark, tmp_path, matrix):
    root = str(tmp_path / "a `quoted` folder")
    names = publish.create_tables(spark, root)
    assert len(names) == 36 and all(spark.table(n).isEmpty() for n in names)
    publish.publish_tables(matrix, root, ago(1))
    table = spark.table("price_dealer_id_90")
    assert table.columns[:3] == ["dealer_id", "cars_sold", "cars_lstd"]
    assert "avg_price_dealer_id_sold" in table.columns and "dealer_id_days_supply" in table.columns
    assert dict(table.dtypes)["dealer_id"] == "bigint"
    assert table.first().median_price_sold == 103

    def shown():
        return {n: spark.table(n).agg(F.sum("cars_sold")).first()[0] for n in names}

    before = shown()
    doubled = matrix.withColumn("cars_sold", F.col("cars_sold") * 2)
    publish.write_run(doubled, root, AS_OF)  # aborted before its commit
    assert shown() == before
    publish.publish_tables(doubled, root, AS_OF)
    after = shown()
    assert all(after[n] == 2 * before[n] for n in names) and any(before.values())
    publish.publish_tables(matrix, root, ago(5))  # an older day comes late
    assert shown() == after
    runs = publish.published_runs(spark, root).collect()
    assert [r.as_of for r in runs if r.current] == [AS_OF] and len(runs) == 3
    publish.publish_tables(matrix.limit(0), root, AS_OF)  # a day without cars replaces it
    assert set(shown().values()) == {None}


def test_a_table_is_built_again_for_another_day_or_other_inputs(spark, tmp_path):
    files = str(tmp_path / "in")
    spark.range(3).write.parquet(files)
    built = []

    def ensured(day):
        version = publish.input_version(spark.read.parquet(files))

        def build():
            built.append(day)
            return spark.read.parquet(files)

        return publish.ensure_current(spark, "ensured_cars", str(tmp_path / "out"), build, day, version)

    for day, n, new in ((AS_OF, 3, True), (AS_OF, 3, False), (ago(1), 3, True), (ago(1), 3, False)):
        table, was_built = ensured(day)
        assert (table.count(), was_built) == (n, new)
    spark.range(2).write.mode("append").parquet(files)
    assert ensured(ago(1))[0].count() == 5 and len(built) == 3

    def broken():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        publish.ensure_current(spark, "ensured_cars", str(tmp_path / "out"), broken, AS_OF, "it's")
    assert spark.table("ensured_cars").count() == 5
    table, new = publish.ensure_current(
        spark, "ensured_cars", str(tmp_path / "out"), lambda: spark.range(1), AS_OF, "it's \\ odd"
    )
    assert new and table.count() == 1
    assert not publish.ensure_current(spark, "ensured_cars", "", broken, AS_OF, "it's \\ odd")[1]
    with pytest.raises(ValueError):
        publish.input_version(spark.range(2))


def test_statement_agrees_with_the_pipeline(spark, listings):
    cars = [{"dealer": 1 + i % 2, "price": 10**3 + i * i, "sold": i % 3 == 0} for i in range(40)]
    cars += [{"dealer": 3, "price": None}, {"dealer": 4, "price": 0}, {"dealer": 5, "price": 1.5}]
    inputs = listings(cars, {i: "10" for i in range(1, 6)})
    facts = listing_fact(inputs.hist, inputs.dealers, inputs.vins, AS_OF)
    facts.createOrReplaceTempView("some_facts")
    found = statements.metric_table(spark, "some_facts", "dealer_id", "price", AS_OF)
    got = rows_of(found.withColumnRenamed("key", "dealer_id"), "dealer_id")
    want = rows_of(daily.dimension_table(inputs, "dealer_id", "price", AS_OF), "dealer_id")
    assert got == want


def test_hostile_names_and_values_do_not_run(spark, listings):
    inputs = listings([{}])
    listing_fact(inputs.hist, inputs.dealers, inputs.vins, AS_OF).createOrReplaceTempView("some_facts")
    spark.range(1).write.mode("overwrite").saveAsTable("victim")
    try:
        for name in ("price; drop table victim", "1 or true --", "(select 1)", "max(price)"):
            for key, measure in ((name, "price"), ("dealer_id", name)):
                with pytest.raises((AnalysisException, ParseException)):
                    statements.metric_table(spark, "some_facts", key, measure, AS_OF).collect()
        text = "x' or '1'='1"
        spark.sql("select 'x' as v").createOrReplaceTempView("values_")
        found = statements.select(spark, "select * from values_ where v = :v", {"v": text})
        assert found.collect() == [] and spark.table("victim").count() == 1
    finally:
        spark.sql("drop table victim")
    assert statements.select_one(spark, "select :a + 1 as b", {"a": 2}).b == 3
    assert statements.select_one(spark, "select 1 where false") is None
    statements.run(spark, "create or replace temporary view made as select 5 as n")
    assert spark.table("made").first().n == 5
