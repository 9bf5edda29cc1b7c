"""Order within a day, ties, many values, exact decimals and missing times."""

from datetime import date, datetime, timedelta
from decimal import Decimal as D, localcontext

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_reports import _part, at, frames

from stockledger import Catalog
from stockledger.functions import numbers
from stockledger.operators import joins, scan, temporal
from stockledger.plans import documents, ledger, materials, planning

# Ids that fall and rise within a day, on both sides of the width of a slice.
TIMES = [(5_000_000, "2024-01-02T09:00:00"), (1, "2024-01-02T10:00:00"), (6_000_000, "2024-01-02T11:00:00")]


def test_shortfalls_add_up_in_order_of_time(spark):
    made = dict(zip((x for x, _ in TIMES), (10, 1, 100), strict=True))
    base = {"ToOperationNo": 10, "QuantityPerUnit": D(1), "ReportedQuantity": D(0), "PartId": 1}
    cat = frames(
        spark,
        ManufacturingOrder=[{"Id": i, "OrderNumber": f"M{i}", "Status": 5} for i, _ in TIMES],
        ManufacturingOrderNode=[{"Id": i, "ManufacturingOrderId": i, "PartId": 9} for i, _ in TIMES],
        ManufacturingOrderReporting=[{"Id": i, "OrderId": i, "ReportedWhen": at(t)} for i, t in TIMES],
        ManufacturingOrderOperation=[
            {"ManufacturingOrderId": i, "ManufacturingOrderNodeId": i, "OperationNumber": 10, "ReportedQuantity": D(n), "RejectedQuantity": D(0)}
            for i, n in made.items()
        ],
        ManufacturingOrderMaterial=[{**base, "Id": i, "ManufacturingOrderId": i, "ManufacturingOrderNodeId": i} for i in made],
        Part=[{**_part(1), "ExtraDescription": "R-raw"}, {**_part(9), "ExtraDescription": "F-main"}],
    )
    got = materials.reported_below_estimate(cat, "2024-01-01", "2024-02-01").collect()
    assert [r["CumulativeTotalDifferenceReportedQuantityPerMaterialPart"] for r in got] == [-10, -11, -111]
    late = materials.reported_below_estimate(cat, "2024-01-02T09:30:00", "2024-01-02T10:30:00").collect()
    assert [r["OrderNumber"] for r in late] == ["M1"]


def test_vouchers_add_up_in_order_of_time(spark):
    amount = dict(zip((x for x, _ in TIMES), (10, 1, 100), strict=True))
    cat = frames(
        spark,
        Voucher=[{"Id": i, "VoucherDate": at(t), "Number": str(i), "SeriesId": 1, "AccountingYearId": 1, "IsPreliminary": 0} for i, t in TIMES],
        VoucherSeries=[{"Id": 1, "Series": "A"}],
        AccountingYear=[{"Id": 1, "Description": "2024", "Status": 0}],
        VoucherRow=[{"VoucherId": i, "BalanceId": 1, "Debit": D(n), "Credit": D(0), "DebitInCompanyCurrency": D(n), "CreditInCompanyCurrency": D(0)} for i, n in amount.items()],
        Balance=[{"Id": 1, "AccountId": 1, "AccountingYearId": 1}],
        Account=[{"Id": 1, "Number": "1000"}],
    )
    got = ledger.general_ledger(cat, 2024).orderBy("VoucherDate").collect()
    assert [r["CumulativeTotalDifference"] for r in got] == [10, 11, 111]


def test_document_numbers_of_one_time_are_peers(spark):
    base = {"BusinessTransactionContextType": 3, "DeliveryDate": at("2024-01-01")}
    times = ["09:00:00", "10:00:00", "10:00:00", "11:00:00"]
    moves = [{**base, "Id": i, "QuantityChangeId": i, "UserName": f"u{i}", "LoggingTimeStamp": at(f"2024-01-01T{t}")} for i, t in enumerate(times)]
    cat = frames(
        spark,
        InventoryMovement=moves,
        CustomerOrderDeliveryRow=[{"QuantityChangeId": 0, "InvoiceId": 100}],
        CustomerOrderInvoice=[{"Id": 100, "DeliveryNoteNumber": "500"}],
    )
    got = documents.gap_fill_number(cat, "2024-01-01", "2024-02-01").orderBy("LoggingTimeStamp", "UserName").collect()
    assert [(r["GroupId"], r["AscSumCount"], r["DescSumCount"], r["StringPredictDeliveryNoteNumber"]) for r in got] == [
        (1, None, None, "500"), (1, 2, 3, "502"), (1, 2, 3, "502"), (1, 3, 1, "503"),
    ]


def test_document_numbers_that_are_no_digits_stay(spark):
    base = {"BusinessTransactionContextType": 3, "DeliveryDate": at("2024-01-01"), "UserName": "u"}
    cat = frames(
        spark,
        InventoryMovement=[{**base, "Id": i, "QuantityChangeId": i, "LoggingTimeStamp": at(f"2024-01-01T0{i}:00:00")} for i in range(2)],
        CustomerOrderDeliveryRow=[{"QuantityChangeId": 0, "InvoiceId": 100}],
        CustomerOrderInvoice=[{"Id": 100, "DeliveryNoteNumber": "DN-7"}],
    )
    got = documents.gap_fill_number(cat, "2024-01-01", "2024-02-01").orderBy("LoggingTimeStamp").collect()
    assert [r["StringPredictDeliveryNoteNumber"] for r in got] == ["DN-7", None]


def test_rates_keep_their_digits(spark):
    source = spark.createDataFrame([(1, D("0.00006130"))], "Id long, ExchangeRate decimal(20,10)")
    cat = Catalog.from_frames(spark, {"CustomerOrder": source}, fill_missing=True)
    assert cat.table("CustomerOrder").first()["ExchangeRate"] == D("0.00006130")


def test_digits_that_do_not_fit_are_an_error(spark):
    source = spark.createDataFrame([(1, D("1.50000")), (2, D("1.00001"))], "Id long, Price decimal(20,5)")
    table = Catalog.from_frames(spark, {"CustomerOrderRow": source}, fill_missing=True).table("CustomerOrderRow")
    assert table.filter("Id = 1").first()["Price"] == D("1.5")
    with pytest.raises(Exception, match="1.00001"):
        table.select("Price").collect()


def test_doubles_are_not_rounded(spark):
    source = spark.createDataFrame([(1, 0.1 + 0.2), (2, 1.2345e-13), (3, float("nan")), (4, None), (5, 1e200)], "Id long, ExchangeRate double")
    table = Catalog.from_frames(spark, {"CustomerOrder": source}, fill_missing=True).table("CustomerOrder")
    assert table.filter("Id in (1, 4)").orderBy("Id").select("ExchangeRate").collect() == [(D("0.3"),), (None,)]
    for odd in (2, 3, 5):
        with pytest.raises(Exception, match="not a decimal"):
            table.filter(f"Id = {odd}").select("ExchangeRate").collect()
    single = spark.createDataFrame([(1, 0.1)], "Id long, ExchangeRate float")
    assert Catalog.from_frames(spark, {"CustomerOrder": single}, fill_missing=True).table("CustomerOrder").first()["ExchangeRate"] == D("0.1")


def test_prices_and_totals_keep_all_digits(spark):
    data = [(D("12.3456"), D("0.0000613"), D("1000000")), (D("-12.3456"), D("1234567.890123456789"), D("-99999999.9999")), (D("0"), D("1"), D("5")), (None, D("1"), D("5"))]
    df = spark.createDataFrame(data, "price decimal(18,4), rate decimal(24,12), quantity decimal(28,4)")
    each = df.withColumn("each", numbers.exact_price(F.col("price"), F.col("rate")))
    got = each.withColumn("total", numbers.exact_total(F.col("each"), F.col("quantity"))).select("each", "total").collect()
    with localcontext() as exact:
        exact.prec = 60
        want = [(p * r, p * r * q) if p is not None else (None, None) for p, r, q in data]
    assert [tuple(r) for r in got] == want and want[0] == (D("0.00075678528"), D("756.78528"))
    wide = spark.createDataFrame([(D("10000000"),)], "rate decimal(24,12)").select(numbers.exact_price(F.lit(D("1.0000")), F.col("rate")))
    with pytest.raises(Exception, match="not a decimal"):
        wide.collect()


def test_parquet_without_a_column_is_an_error(spark, tmp_path):
    spark.createDataFrame([(1,)], "Id long").write.parquet(str(tmp_path / "Account"))
    with pytest.raises(ValueError, match="Number"):
        Catalog.from_parquet(spark, str(tmp_path)).table("Account")


def test_days_without_a_mark_need_the_time_of_effect_alone(spark):
    """Marked days leave out facts without either time; other days take whatever is in effect on them."""
    t = datetime(2024, 1, 5)
    points = spark.createDataFrame([("a", date(2024, 1, 5), t), ("a", date(2024, 1, 6), None)], "k string, day date, since timestamp")
    facts = [(1, "a", None, t, 7), (2, "a", t, None, 50), (3, "a", t + timedelta(hours=1), t, 1), (4, "a", None, t + timedelta(days=1), 9)]
    got = temporal.sum_since_mark(
        points, spark.createDataFrame(facts, "id long, k string, rec timestamp, eff timestamp, n long"), ["k"], "day", "since", "id", "rec", "eff", "n", "total"
    )
    assert rows(got, "day", "total") == [(date(2024, 1, 5), 1), (date(2024, 1, 6), 9)]


def test_facts_before_the_least_mark_are_not_shuffled(spark, no_broadcast, tmp_path):
    t = datetime(2024, 1, 5)
    facts = [(i, "ab"[i % 2], t - timedelta(days=i), t - timedelta(days=i), 1) for i in range(1, 301)] + [(0, "a", t + timedelta(hours=1), t, 5)]
    spark.createDataFrame(facts, "id long, k string, rec timestamp, eff timestamp, n long").write.parquet(str(tmp_path / "facts"))
    table = spark.read.parquet(str(tmp_path / "facts"))
    points = spark.createDataFrame([("a", date(2024, 1, 5), t), ("b", date(2024, 1, 5), None)], "k string, day date, since timestamp")
    got = temporal.sum_since_mark(points, table, ["k"], "day", "since", "id", "rec", "eff", "n", "total")
    assert rows(got, "k", "total") == [("a", 5), ("b", 0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Every scan of the facts filters by a bound found at run time, below its exchange.
    below = [line for line in plan.split("== Initial Plan ==")[-1].split("\n") if "FileScan" in line and "rec" in line or "eff#" in line and "FileScan" in line]
    assert below and all("subquery" in line for line in below)
    asked = [line for line in plan.split("\n") if "Filter" in line and "Subquery" in line.title()]
    assert len(asked) >= 2


def test_every_value_of_a_field_gives_a_row(spark):
    parts = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    fields = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "x"), (2, 11, "y")], "parent long, template long, value string")
    got = joins.attribute_lookup(parts, fields, "id", "parent", "template", "value", {"one": 10, "two": 11})
    assert rows(got, "id", "one", "two") == [(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (3, None, None)]


def test_rows_without_a_key_are_spread(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).cast("string").alias("key"), F.lit(1).alias("type"))
        table = spark.range(4000).select(F.col("id").cast("string").alias("t_key"), (F.col("id") * 2).alias("found"))
        got = joins.typed_lookup(df, "key", "type", [(table, "t_key", [1])])
        assert rows(got.filter("found is not null"), "id") == rows(df.filter("key is not null"), "id") and got.count() == 4000
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 4000 / len(sizes) and len(sizes) == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_cells_of_an_order_never_decrease(spark):
    data = [(datetime(2024, 1, 1) + timedelta(hours=7 * i % 50), (i * 7919 * 10**14) % (1 << 62)) for i in range(300)]
    cells = scan.order_cells(["t", "id"], "day")
    df = spark.createDataFrame(data, "t timestamp, id long").orderBy("t", "id").select(*[c.alias(n) for n, c in cells.items()])
    found = [tuple(tuple(v) if isinstance(v, tuple) else v for v in r) for r in df.collect()]
    assert found == sorted(found)


def test_part_list_as_a_table(spark, sf):
    from stockledger.sources.demo import demo_catalog

    demo = demo_catalog(spark, sf)
    numbers = [r[0] for r in demo.table("Part").select("PartNumber").orderBy("PartNumber").limit(2).collect()]
    listed = planning.order_plan(demo, "2024-01-03", "2024-01-05", numbers)
    tabled = planning.order_plan(demo, "2024-01-03", "2024-01-05", spark.createDataFrame([(x,) for x in numbers], "n string"))
    assert rows(listed) == rows(tabled)
