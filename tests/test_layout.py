"""The movement table by month and bucket: same reports, fewer files, no exchange by part."""

from datetime import datetime

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stockledger import Catalog
from stockledger.plans import planning, stock
from stockledger.sources import write_by_month
from stockledger.sources.demo import demo_catalog

NAME = "InventoryMovement"


@pytest.fixture
def laid_out(spark, sf, tmp_path_factory, request):
    """The demo catalog with its movements laid out, and its plain form."""
    plain = demo_catalog(spark, sf)
    table = "movement_by_month"
    spark.sql(f"drop table if exists {table}")
    folder = str(tmp_path_factory.mktemp("layout"))
    assert write_by_month(plain.table(NAME), table, "DeliveryDate", "PartId", 4, path=f"{folder}/t") == 4
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    yield Catalog(spark, lambda n: spark.table(table) if n == NAME else plain.table(n), fill_missing=True), plain
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", before)
    spark.sql(f"drop table if exists {table}")


def scans(spark, df):
    """(partitions read, partitions of the table) of each scan of the laid-out table that ran."""
    df.collect()
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            return walk(node.plan())
        if kind == "FileSourceScanExec" and "movement_by_month" in node.toString():
            found.append(int(node.metrics().apply("numPartitions").value()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("variant", ["cte", "join", "apply"])
def test_rollforward_is_the_same(spark, laid_out, variant):
    laid, plain = laid_out
    got = stock.stock_rollforward(laid, "2024-01-10", "2024-01-20", variant=variant)
    assert rows(got) == rows(stock.stock_rollforward(plain, "2024-01-10", "2024-01-20", variant=variant))


def test_other_reports_are_the_same(spark, laid_out):
    laid, plain = laid_out
    for report in (lambda c: stock.stock_value_month(c, 2024), lambda c: planning.order_plan(c, "2024-01-10", "2024-01-12")):
        assert rows(report(laid)) == rows(report(plain))


def test_rollforward_prunes_months_and_does_not_exchange_movements(spark, laid_out, no_broadcast):
    laid, _ = laid_out
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = stock.stock_rollforward(laid, "2024-01-10", "2024-01-20")
        plan = plan_of(df)
        read = scans(spark, df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    months = spark.table("movement_by_month").select("DeliveryDateMonth").distinct().count()
    # All but the back-dated movements, whose effective date has no lower bound, read the month in question.
    assert sorted(read) == [1] * (len(read) - 1) + [months] and len(read) >= 5 and months > 12
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert exchanges and not any("LocationName" in x for x in exchanges)


def test_null_times_hot_keys_and_zones(spark, tmp_path):
    at = [None, datetime(2023, 12, 31, 23, 30), datetime(2024, 1, 1), datetime(2024, 1, 31, 20), datetime(2024, 2, 1, 0, 0)]
    df = spark.createDataFrame([(i, 7 if i % 3 else i, at[i % 5]) for i in range(200)], "Id long, PartId long, DeliveryDate timestamp")
    spark.sql("drop table if exists movement_hot")
    assert write_by_month(df, "movement_hot", "DeliveryDate", "PartId", 16, path=str(tmp_path / "hot")) == 0
    assert rows(spark.table("movement_hot").drop("DeliveryDateMonth"), "Id", "PartId", "DeliveryDate") == rows(df)
    cat = Catalog(spark, lambda n: spark.table("movement_hot"), fill_missing=True)
    for low, high in [(at[1], at[1]), (at[2], at[3]), (at[4], None), (None, at[2]), (None, None)]:
        bounds = [None if x is None else F.lit(x) for x in (low, high)]
        want = [i for i in range(200) if (low is None or (at[i % 5] or datetime.min) >= low and at[i % 5]) and (high is None or at[i % 5] and at[i % 5] <= high)]
        assert [r.Id for r in cat.between(NAME, "DeliveryDate", *bounds).select("Id").orderBy("Id").collect()] == want
    with pytest.raises(ValueError):
        write_by_month(df.withColumn("deliverydatemonth", F.lit(1)), "x", "DeliveryDate", "PartId", 4)
    with pytest.raises(KeyError):
        cat.between("Nothing", "DeliveryDate")
    spark.sql("drop table movement_hot")


def test_empty_table(spark, sf, tmp_path):
    empty = demo_catalog(spark, sf).table(NAME).limit(0)
    spark.sql("drop table if exists movement_none")
    write_by_month(empty, "movement_none", "DeliveryDate", "PartId", 4, path=str(tmp_path / "none"))
    assert spark.table("movement_none").count() == 0
    spark.sql("drop table movement_none")
