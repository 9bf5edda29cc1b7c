"""Reports: identities on the test data, and edge rows on small hand-made tables."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stockledger import Catalog
from stockledger.plans import documents, forecast, ledger, materials, movements, orders, planning, stock
from stockledger.sources.demo import demo_catalog
from stockledger.sources.schema import table_schema


@pytest.fixture(scope="module")
def demo(spark, sf):
    return demo_catalog(spark, sf)


def frames(spark, **tables):
    """A catalog of hand-made tables; every row is a dict, absent columns are NULL."""
    built = {}
    for name, data in tables.items():
        schema = table_schema(name)
        built[name] = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in data], schema)
    empty = lambda name: built.get(name, spark.createDataFrame([], table_schema(name)))
    return Catalog(spark, empty)


def at(text):
    return datetime.fromisoformat(text)


D = Decimal


def test_closing_is_opening_plus_running(demo):
    df = ledger.general_ledger(demo, 1998).filter("AccountNumber is not null")
    wrong = df.filter(F.col("ClosingBalance") != F.col("OpeningBalance") + F.col("CumulativeTotalDifference"))
    assert wrong.count() == 0
    last = df.groupBy("AccountNumber").agg(F.sum("DifferenceInCompanyCurrency").alias("s"))
    ends = df.join(last, "AccountNumber").filter(F.col("CumulativeTotalDifference") == F.col("s"))
    assert ends.select("AccountNumber").distinct().count() == last.count()


def test_ledger_without_year_takes_the_current_one(demo):
    years = ledger.general_ledger(demo).select(F.year("VoucherDate")).distinct().collect()
    assert [r[0] for r in years] == [2001]
    assert ledger.general_ledger(demo, "").count() == ledger.general_ledger(demo).count()


def test_ledger_voucher_without_rows_stays(spark):
    cat = frames(
        spark,
        Voucher=[{"Id": 1, "VoucherDate": at("2024-01-01"), "Number": "7", "SeriesId": 1, "AccountingYearId": 1, "IsPreliminary": 0}],
        VoucherSeries=[{"Id": 1, "Series": "A"}],
        AccountingYear=[{"Id": 1, "Description": "2024", "Status": 0}],
    )
    row = ledger.general_ledger(cat, 2024).first()
    assert (row["VoucherDescriptionNumber"], row["AccountNumber"], row["OpeningBalance"]) == ("A-7", None, 0)


def test_end_stock_adds_up(demo):
    df = stock.stock_rollforward(demo, "2024-01-10", "2024-01-20", variant="join").filter("OpeningStock is not null")
    parts = ["OpeningStock", "BackDateReceiptBalance", "BackDateIssueBalance", "ReceiptBalance", "IssueBalance"]
    assert df.count() > 0
    assert df.filter(F.col("EndStock") != sum((F.col(c) for c in parts), F.lit(0))).count() == 0


def _movements():
    part = {"PartId": 1, "LocationName": "L", "WarehouseId": 1}
    return [
        {**part, "Id": 1, "BusinessTransactionContextType": 4, "PhysicalInventoryBalance": D(100), "LoggingTimeStamp": at("2024-01-09T12:00"), "DeliveryDate": at("2024-01-09")},
        # recorded after the count, effective before the period
        {**part, "Id": 2, "BusinessTransactionContextType": 1, "BalanceChange": D(5), "LoggingTimeStamp": at("2024-01-11T08:00"), "DeliveryDate": at("2024-01-08")},
        # recorded before the count
        {**part, "Id": 3, "BusinessTransactionContextType": 1, "BalanceChange": D(50), "LoggingTimeStamp": at("2024-01-09T11:00"), "DeliveryDate": at("2024-01-08")},
        {**part, "Id": 4, "BusinessTransactionContextType": 3, "BalanceChange": D(-7), "LoggingTimeStamp": at("2024-01-12T08:00"), "DeliveryDate": at("2024-01-12")},
        # recorded after the end count
        {**part, "Id": 5, "BusinessTransactionContextType": 3, "BalanceChange": D(-2), "LoggingTimeStamp": at("2024-01-20T18:00"), "DeliveryDate": at("2024-01-19")},
        {**part, "Id": 6, "BusinessTransactionContextType": 4, "PhysicalInventoryBalance": D(97), "LoggingTimeStamp": at("2024-01-20T12:00"), "DeliveryDate": at("2024-01-20")},
        # a second part with movements but no counts
        {**part, "PartId": 2, "Id": 7, "BusinessTransactionContextType": 1, "BalanceChange": D(9), "LoggingTimeStamp": at("2024-01-15T08:00"), "DeliveryDate": at("2024-01-15")},
    ]


def _part(i):
    return {"Id": i, "PartNumber": f"P{i}", "Status": 1, "CategoryString": "X", "Type": 0, "StandardPartUnitUsageId": i, "ProductGroupId": 1}


@pytest.mark.parametrize(
    "variant, first, second",
    [
        ("cte", (100.0, 5.0, -7.0, 98.0, 97.0, -1.0), (None, None, 0.0, 9.0, 0.0, -9.0)),
        ("join", (100, 5, -7, 98, 97, -1), (None, 0, 0, None, 0, None)),
        ("apply", (100, 5, -7, 98, 97, -1), (None, 0, 0, None, None, None)),
    ],
)
def test_rollforward_variants(spark, variant, first, second):
    cat = frames(spark, InventoryMovement=_movements(), Part=[_part(1), _part(2)])
    columns = ["OpeningStock", "BackDateReceiptBalance", "IssueBalance", "EndStock", "ActualEndStock", "AdjustmentBalance"]
    got = stock.stock_rollforward(cat, "2024-01-10", "2024-01-20", variant=variant).orderBy("PartNumber").select(*columns).collect()
    assert [tuple(r) for r in got] == [first, second]


def test_rollforward_apply_counts_no_movement_without_an_end_count(spark):
    cat = frames(spark, InventoryMovement=_movements(), Part=[_part(2)])
    receipts = {v: stock.stock_rollforward(cat, "2024-01-10", "2024-01-20", variant=v).first()["ReceiptBalance"] for v in ("join", "apply")}
    assert receipts == {"join": 9, "apply": 0}


def test_rollforward_rejects_unknown_variant(demo):
    with pytest.raises(ValueError):
        stock.stock_rollforward(demo, "2024-01-10", "2024-01-20", variant="other")


def test_pivot_total_is_the_unpivoted_total(demo):
    wide = stock.stock_value_month(demo, 1997)
    total = sum((F.col(f"{m}_amounts") for m in stock.MONTHS), F.lit(0))
    parts = stock._valued_parts(demo, "024")
    counts = stock._month_end_counts(demo, 1997, 1).join(parts, F.col("PartId") == F.col("P_Id"), "left_semi")
    assert wide.agg(F.sum(total)).first()[0] == counts.agg(F.sum("amount")).first()[0]


def test_stock_value_uses_the_last_count_and_the_price_of_its_day(spark):
    place = {"PartId": 1, "LocationName": "L", "WarehouseId": 1, "BusinessTransactionContextType": 4}
    cat = frames(
        spark,
        InventoryMovement=[
            {**place, "Id": 1, "PhysicalInventoryBalance": D(1), "DeliveryDate": at("2024-03-05"), "LoggingTimeStamp": at("2024-03-05T10:00")},
            {**place, "Id": 2, "PhysicalInventoryBalance": D(2), "DeliveryDate": at("2024-03-30"), "LoggingTimeStamp": at("2024-03-30T10:00")},
            {**place, "Id": 3, "PhysicalInventoryBalance": D(3), "DeliveryDate": at("2024-03-30"), "LoggingTimeStamp": at("2024-03-30T11:00")},
            {**place, "Id": 4, "PhysicalInventoryBalance": D(4), "DeliveryDate": at("2024-05-01"), "LoggingTimeStamp": at("2024-05-01T11:00"), "WarehouseId": 2},
        ],
        PriceChangeLog=[
            {"PartId": 1, "PriceType": 0, "NewPrice": D(10), "Timestamp": at("2024-01-01")},
            {"PartId": 1, "PriceType": 0, "NewPrice": D(12), "Timestamp": at("2024-03-30T23:59:59.999999")},
            {"PartId": 1, "PriceType": 0, "NewPrice": D(99), "Timestamp": at("2024-03-31")},
            {"PartId": 1, "PriceType": 3, "NewPrice": D(77), "Timestamp": at("2024-03-30")},
        ],
        Part=[_part(1)],
        ProductGroup=[{"Id": 1, "Number": None}],
    )
    row = stock.stock_value_month(cat, 2024).first()
    assert (row["Mar_stocks"], row["Mar_amounts"], row["May_stocks"], row["Jan_amounts"]) == (3, 36, 0, 0)


def test_month_without_price_is_worth_nothing(spark):
    place = {"PartId": 1, "LocationName": "L", "WarehouseId": 1, "BusinessTransactionContextType": 4, "Id": 1}
    cat = frames(
        spark,
        InventoryMovement=[{**place, "PhysicalInventoryBalance": D(8), "DeliveryDate": at("2024-02-05"), "LoggingTimeStamp": at("2024-02-05")}],
        Part=[_part(1)],
        PartUnitUsage=[{"Id": 1, "PartId": 1, "ConversionFactor": D(4)}],
        ProductGroup=[{"Id": 1, "Number": "001"}],
    )
    row = stock.stock_value_month_case(cat, 2024).first()
    assert (row["FebStocks"], row["FebStandardPrice"], row["FebAmounts"]) == (2.0, 0.0, 0.0)


def test_gap_fill_numbers_at_start_middle_and_end(spark):
    base = {"BusinessTransactionContextType": 3, "UserName": "u", "DeliveryDate": at("2024-01-01")}
    moves = [
        {**base, "Id": i, "QuantityChangeId": i, "LoggingTimeStamp": at(f"2024-01-0{1 + i // 3}T0{i}:00:00")} for i in range(6)
    ]
    cat = frames(
        spark,
        InventoryMovement=moves,
        CustomerOrderDeliveryRow=[{"QuantityChangeId": i, "InvoiceId": 100 + i} for i in (1, 4)],
        CustomerOrderInvoice=[{"Id": 101, "DeliveryNoteNumber": "501"}, {"Id": 104, "DeliveryNoteNumber": "504"}],
    )
    got = documents.gap_fill_number(cat, "2024-01-01", "2024-02-01")
    assert [r[0] for r in got.orderBy("LoggingTimeStamp").select("StringPredictDeliveryNoteNumber").collect()] == [
        "500", "501", "502", "503", "504", "505",
    ]
    assert [r[0] for r in got.orderBy("LoggingTimeStamp").select("Status").collect()] == [
        "Cancelled", "Created", "Cancelled", "Cancelled", "Created", "Cancelled",
    ]


def test_transferred_quantity_comes_from_the_comment(spark):
    comment = '{"ManufacturingOrderNumber":"M1","NodePartNumber":"P9"}'
    cat = frames(
        spark,
        InventoryMovement=[
            {"Id": 1, "PartId": 1, "BusinessTransactionContextType": 7, "BalanceChange": D(6), "CommentId": 1},
            {"Id": 2, "PartId": 1, "BusinessTransactionContextType": 7, "BalanceChange": D(4), "CommentId": 1},
            {"Id": 3, "PartId": 1, "BusinessTransactionContextType": 7, "BalanceChange": D(50), "CommentId": 2},
            {"Id": 4, "PartId": 1, "BusinessTransactionContextType": 1, "BalanceChange": D(70), "CommentId": 1},
        ],
        CommentText=[{"Id": 1, "RawText": comment}, {"Id": 2, "RawText": "x " + comment}],
        Part=[{**_part(1), "ExtraDescription": "R-a"}, {**_part(9), "ExtraDescription": "F-a"}],
        ManufacturingOrder=[{"Id": 1, "OrderNumber": "M1"}],
        ManufacturingOrderNode=[{"Id": 1, "ManufacturingOrderId": 1, "PartId": 9, "Status": 3}],
        ManufacturingOrderOperation=[{"ManufacturingOrderId": 1, "ManufacturingOrderNodeId": 1, "OperationNumber": 10}],
        ManufacturingOrderMaterial=[
            {"Id": 1, "ManufacturingOrderId": 1, "ManufacturingOrderNodeId": 1, "PartId": 1, "ToOperationNo": 10, "PlannedQuantity": D(20), "ReportedQuantity": D(3)}
        ],
    )
    row = materials.order_material(cat).first()
    assert (row["MaterialTransferredQuantity"], row["MaterialRestQuantity"], row["MaterialOutstandingQuantity"]) == (10, 7, 17)
    assert row["ManufacturingOrderStatus"] == "Started"


def test_crushed_material_counts_as_reported(spark):
    base = {"ManufacturingOrderId": 1, "ManufacturingOrderNodeId": 1, "ToOperationNo": 10}
    cat = frames(
        spark,
        ManufacturingOrder=[{"Id": 1, "OrderNumber": "M1", "Status": 5}],
        ManufacturingOrderNode=[{"Id": 1, "ManufacturingOrderId": 1, "PartId": 9}],
        ManufacturingOrderReporting=[
            {"Id": 1, "OrderId": 1, "ReportedWhen": at("2024-11-02")},
            {"Id": 2, "OrderId": 1, "ReportedWhen": at("2024-11-05")},
        ],
        ManufacturingOrderOperation=[
            {"ManufacturingOrderId": 1, "ManufacturingOrderNodeId": 1, "OperationNumber": 10, "ReportedQuantity": D(9), "RejectedQuantity": D(1)}
        ],
        ManufacturingOrderMaterial=[
            {**base, "Id": 1, "PartId": 1, "QuantityPerUnit": D(2), "ReportedQuantity": D(12)},
            {**base, "Id": 2, "PartId": 2, "QuantityPerUnit": D(2), "ReportedQuantity": D(5)},
            {**base, "Id": 3, "PartId": 3, "QuantityPerUnit": D(2), "ReportedQuantity": D(30)},
        ],
        Part=[
            {**_part(1), "ExtraDescription": "R-raw"},
            {**_part(2), "ExtraDescription": "R-CRUSH raw"},
            {**_part(3), "ExtraDescription": "R-other"},
            {**_part(9), "ExtraDescription": "F-main"},
        ],
        PartLocation=[{"PartId": 1, "Name": "WHCC-PROD", "Balance": D(40), "LifeCycleState": 1}],
    )
    got = materials.reported_below_estimate(cat, "2024-11-01", "2024-12-01").collect()
    assert len(got) == 1
    row = got[0]
    assert (row["MaterialReportedQuantity"], row["EstimatedReportedQuantity"], row["DifferenceReportedQuantity"]) == (17, 20, -3)
    assert row["CurrentBalancePerMaterialPartAfterReported"] == 37
    assert row["LastReportingDate"] == at("2024-11-05")


def test_order_plan_is_empty_for_unknown_parts(demo):
    assert planning.order_plan(demo, "2024-01-05", "2024-01-06", ["none"]).count() == 0


def test_sales_plan_switch_only_drops_the_orders(demo):
    both = forecast.sales_plan(demo, "1997-01-01", "1997-12-31")
    schedules = forecast.sales_plan(demo, "1997-01-01", "1997-12-31", include_orders=False)
    assert schedules.filter("CreatedBy <> 'EDI'").count() == 0
    assert both.filter("CreatedBy = 'EDI'").count() == schedules.count()
    assert both.count() > schedules.count()


def test_reports_have_no_nested_loops(demo, no_broadcast):
    built = {
        "pairs": movements.movement_pairs(demo),
        "transactions": movements.location_transactions(demo),
        "materials": materials.order_material(demo),
        "bom": materials.reported_not_in_bom(demo, "1996-01-01", "1997-12-31"),
        "siblings": materials.sibling_diff(demo),
        "period": orders.outstanding_by_period(demo),
        "schedule": orders.outstanding_with_schedule(demo),
        "forecast": forecast.forecast_by_period(demo),
        "detail": forecast.forecast_detail(demo),
        "roll": stock.stock_rollforward(demo, "2024-01-10", "2024-01-20"),
        "value": stock.stock_value_month(demo, 1997),
        "plan": planning.order_plan(demo, "2024-01-05", "2024-01-06", ["P1"]),
    }
    for name, df in built.items():
        text = plan_of(df)
        assert "NestedLoop" not in text and "Cartesian" not in text, name
        assert "Python" not in text, name


def test_catalog_checks_columns(spark):
    half = spark.createDataFrame([(1,)], "Id long")
    with pytest.raises(ValueError):
        Catalog.from_frames(spark, {"Account": half}).table("Account")
    filled = Catalog.from_frames(spark, {"Account": half}, fill_missing=True).table("Account")
    assert rows(filled) == [(1, None)] and filled.schema["Number"].dataType.simpleString() == "string"
    with pytest.raises(KeyError):
        Catalog.from_frames(spark, {}).table("Nothing")


def test_catalog_reads_parquet_with_pushdown(spark, tmp_path, demo):
    demo.table("InventoryMovement").write.parquet(str(tmp_path / "InventoryMovement"))
    table = Catalog.from_parquet(spark, str(tmp_path)).table("InventoryMovement")
    plan = plan_of(table.filter("WarehouseId = 1").select("PartId"))
    assert "PushedFilters: [IsNotNull(WarehouseId), EqualTo(WarehouseId,1)]" in plan
    assert "ReadSchema: struct<PartId:bigint,WarehouseId:bigint>" in plan


@pytest.mark.parametrize(
    "table, column, kind",
    [
        ("InventoryMovement", "LoggingTimeStamp", "timestamp"),
        ("InventoryMovement", "BusinessTransactionContextType", "int"),
        ("InventoryMovement", "BalanceOnPartAfterChange", "decimal(18,4)"),
        ("ExtraField", "TemplateId", "bigint"),
        ("EntityChangeLog", "EntityTypeId", "string"),
        ("CustomerOrder", "OrderNumber", "string"),
        ("CustomerOrder", "ExchangeRate", "decimal(24,12)"),
        ("VoucherRow", "DebitInCompanyCurrency", "decimal(18,4)"),
        ("EdiFileTransaction", "FileCreatedWhen", "timestamp"),
        ("PriceChangeLog", "Timestamp", "timestamp"),
        ("ManufacturingOrderMaterial", "ToOperationNo", "int"),
        ("CustomerOrderRow", "CustomerCommitmentLevel", "int"),
    ],
)
def test_column_types(table, column, kind):
    assert table_schema(table)[column].dataType.simpleString() == kind
