"""Reports whose shuffles or memory grew beyond their rows: results on repeated keys, and the shape of their plans."""

import re
from datetime import datetime

import pytest

from conftest import plan_of, rows
from stockledger.plans import forecast, materials, movements, planning
from stockledger.sources.catalog import Catalog
from stockledger.sources.demo import demo_catalog


@pytest.fixture
def demo(spark, sf):
    return demo_catalog(spark, sf)


def catalog_of(spark, frames):
    made = {name: spark.createDataFrame(data, schema) for name, (schema, data) in frames.items()}
    return Catalog.from_frames(spark, made, fill_missing=True)


def test_part_roles_are_distinct_where_keys_repeat(spark):
    cat = catalog_of(
        spark,
        {
            "Part": ("Id long, PartNumber string", [(1, "P1"), (1, "P1"), (1, "Q1"), (2, None), (None, "P0"), (None, "P0")]),
            "Customer": ("Id long, Alias string", [(7, "a"), (7, "a - b"), (8, None), (8, ""), (9, "c"), (9, "c"), (None, "d")]),
            "CustomerPartLink": (
                "PartId long, CustomerId long, CustomerPartNumber string",
                [(1, 7, "b - c"), (1, 7, "c"), (1, 8, None), (1, 8, ""), (2, 9, "x"), (2, 9, "x"), (None, 9, None), (1, None, "y")],
            ),
            "PartPreparation": ("Id long, PartId long", [(10, 1), (11, 1), (11, 1), (12, 2), (13, None), (12, 2)]),
            "MaterialRow": ("PreparationId long, PartId long", [(10, 5), (11, 5), (11, 5), (12, 5), (12, None), (12, None), (13, 5), (14, 5)]),
        },
    )
    got = rows(planning.part_roles(cat), "PartId", "RelativeRequirementNumber", "CustomerId", "MainPartId", "PartType")
    want = [(p, None, None, None, "Main") for p in (1, 2, None)]
    want += [(1, t, 7, None, "CustomerLink") for t in ("a - b - b - c", "a - b - c", "a - c")]
    want += [(1, " - ", 8, None, "CustomerLink"), (2, "c - x", 9, None, "CustomerLink"), (None, "c - ", 9, None, "CustomerLink")]
    want += [(5, "P1", None, 1, "Parent"), (5, "Q1", None, 1, "Parent"), (5, None, None, 2, "Parent"), (None, None, None, 2, "Parent")]
    assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


def test_part_roles_compare_no_finished_rows(demo):
    keys = re.findall(r"HashAggregate\(keys=\[(.*?)\]", plan_of(planning.part_roles(demo)))
    assert keys and not any("PartType" in k or "RelativeRequirementNumber" in k for k in keys)


def test_order_plan_sorts_rows_before_their_measures_are_written_out(demo):
    plan = planning.order_plan(demo, "2024-01-10", "2024-01-11", ["P3", "P8"])
    head, below = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()[:2]
    assert head.startswith("Project") and below.startswith("+- Sort [day")
    days = [(r.TransactionDate, r.PartNumber) for r in plan.collect()]
    assert days and days == sorted(days)


def test_order_material_carries_its_rows_through_three_joins(demo, no_broadcast):
    df = materials.order_material(demo)
    node, joins = df._jdf.queryExecution().optimizedPlan(), 0
    while not node.children().isEmpty():
        joins += node.nodeName() == "Join"
        node = node.children().head()
    assert joins == 3
    assert plan_of(df).count("ShuffledHashJoin") == 2


def test_sales_plan_groups_order_lines_once(spark, sf, tmp_path, monkeypatch):
    whole = rows(forecast.sales_plan(demo_catalog(spark, sf), "1997-01-01", "1998-12-31"))
    read = type(spark.conf).get
    folder = lambda conf, key, *rest: str(tmp_path) if key == "spark.checkpoint.dir" else read(conf, key, *rest)
    monkeypatch.setattr(type(spark.conf), "get", folder)
    df = forecast.sales_plan(demo_catalog(spark, sf, lines_once=True), "1997-01-01", "1998-12-31")
    assert "l_linenumber" not in " ".join(re.findall(r"Aggregate\(key=?s?=\[(.*?)\]", plan_of(df)))
    assert whole and rows(df) == whole


def test_sales_plan_orders_prices_of_planned_parts_only(demo, no_broadcast):
    joins = re.findall(r"ShuffledHashJoin .*", plan_of(forecast.sales_plan(demo, "1997-01-01", "1998-12-31")))
    assert len(joins) == 1 and "LeftSemi" in joins[0]


def test_sales_plan_takes_the_price_of_its_part_customer_and_day(spark):
    time = "timestamp_ntz"
    day = datetime.fromisoformat
    cat = catalog_of(
        spark,
        {
            "DeliveryScheduleCall": (
                f"ParentId long, DemandType int, DeliveryDate {time}, Quantity double",
                [(i, forecast.FORECAST, day(f"2024-03-0{i}"), float(i)) for i in (1, 2, 3, 4, 5)] + [(5, forecast.FORECAST, day("2024-03-05"), 5.0)],
            ),
            "DeliverySchedulePart": ("Id long, ParentId long, PartId long", [(1, 1, 10), (2, 1, 20), (3, 2, 10), (4, 3, None), (5, 4, 10)]),
            "DeliverySchedule": (
                f"Id long, CustomerId long, CustomerDeliveryScheduleDate {time}",
                [(1, 7, day("2024-01-01")), (2, 8, day("2024-01-01")), (3, 7, day("2024-01-01")), (4, None, day("2024-01-01"))],
            ),
            "PriceChangeLog": (
                f"PartId long, CustomerId long, NewPrice double, Timestamp {time}, PriceType int, IsSetupPrice int",
                [(10, 7, p, day(t), 3, 0) for p, t in ((1.0, "2024-02-01"), (2.0, "2024-03-01"), (2.0, "2024-03-01"), (3.0, "2024-03-02"))]
                + [(20, 8, 9.0, day("2024-02-01"), 3, 0), (None, 7, 9.0, day("2024-02-01"), 3, 0), (10, None, 9.0, day("2024-02-01"), 3, 0)],
            ),
            "Currency": ("Id long, Code string", []),
            "Unit": ("Id long, CodeId long", []),
            "DynamicPhrase": ("Id long, Text string", []),
            "Part": ("Id long, PartNumber string", [(10, "P10"), (20, "P20")]),
            "Customer": ("Id long, RootId long", [(7, 7), (8, 8)]),
            "CustomerRoot": ("Id long, CustomerCode string", [(7, "C7"), (8, "C8")]),
            "CustomerPartLink": ("PartId long, CustomerId long, CustomerPartNumber string", []),
        },
    )
    got = forecast.sales_plan(cat, "2024-03-01", "2024-03-05", include_orders=False)
    assert rows(got.selectExpr("CustomerCode", "PartNumber", "cast(PlannedQuantity as int)", "cast(PriceEach as int)")) == [
        ("C7", "P10", 1, 2), ("C7", "P20", 2, None), ("C8", "P10", 3, None),
    ]


def test_movements_without_references_meet_only_their_part(demo):
    node, joins = movements.location_transactions(demo)._jdf.queryExecution().optimizedPlan(), 0
    while node.nodeName() != "Union":
        joins += node.nodeName() == "Join"
        node = node.children().head()
    assert joins == 1


def test_location_transactions_are_distinct_with_and_without_references(spark):
    none = {
        "Customer": "Id long, RootId long", "CustomerRoot": "Id long, CustomerCode string", "Supplier": "Id long, RootId long",
        "SupplierRoot": "Id long, SupplierCode string", "PurchaseOrder": "BusinessContactId long, OrderNumber string",
        "CustomerOrderInvoice": "Id long, DeliveryNoteNumber string", "PartUnitUsage": "Id long, ConversionFactor decimal(18,4)",
        "ExtraField": "ParentId long, ParentClass string, TemplateId long, String string", "DynamicPhrase": "Id long, Text string",
    }
    cat = catalog_of(
        spark,
        {name: (schema, []) for name, schema in none.items()}
        | {
            "CustomerOrder": ("Id long, OrderNumber string", [(5, "O5"), (5, "O5")]),
            "ManufacturingOrder": ("OrderNumber string", [("M1",)]),
            "CustomerOrderDeliveryRow": ("CustomerOrderId long, QuantityChangeId long", [(5, 1)]),
            "Part": ("Id long, PartNumber string", [(1, "P1"), (1, "Q1"), (2, "P2"), (None, "P0")]),
            "ReasonCodeUnplannedStockMovement": ("Id long, Code string", [(4, "R4")]),
            "CommentText": ("Id long, RawText string, Text string", [(3, "by hand", "by hand"), (3, "by hand", "by hand"), (9, "by hand", "by hand")]),
            "Person": ("Id long, EmployeeNumber string, FirstName string", [(6, "E6", "Ann"), (8, "", "Bo")]),
            "InventoryMovement": (
                "PartId long, LocationName string, OrderNumber string, BusinessTransactionContextType int, QuantityChangeId long, "
                "PersonId long, ReasonCodeUnplannedStockMovementId long, CommentId long",
                [(1, "a", None, 4, None, None, None, None), (1, "a", None, 4, None, None, None, None), (2, "a", None, None, None, None, None, None)]
                + [(p, "a", None, 4, None, None, None, None) for p in (77, 78, None)]
                + [(2, "b", "O5", 3, 1, None, None, None), (2, "b", "O5", 4, 1, None, None, None), (2, "b", "M1", 11, None, None, None, None)]
                + [(2, "c", None, 4, None, 6, None, None), (2, "c", None, 4, None, 8, None, None), (2, "c", None, 4, None, None, 4, None)]
                + [(2, "d", None, 4, None, None, None, c) for c in (3, 9, 404)] + [(77, "d", None, 4, None, None, None, 3)],
            ),
        },
    )
    got = movements.location_transactions(cat).selectExpr(
        "InventoryMovementLocationName", "PartPartNumber", "CustomerOrderOrderNumber", "ManufacturingOrderOrderNumber", "TransactionTypeId",
        "_UserEmployeeNumber", "_UserFullName", "CauseCode", "InventoryMovementCommentRawText",
    )
    want = [("a", p, None, None, t, None, "", None, None) for p, t in (("P1", 4), ("Q1", 4), ("P2", None), (None, 4))]
    want += [("b", "P2", "O5", None, 3, None, "", None, None), ("b", "P2", None, None, 4, None, "", None, None)]
    want += [("b", "P2", None, "M1", 11, None, "", None, None), ("c", "P2", None, None, 4, "E6", "Ann ", None, None)]
    want += [("c", "P2", None, None, 4, None, "", None, None), ("c", "P2", None, None, 4, None, "", "R4", None)]
    want += [("d", p, None, None, 4, None, "", None, t) for p, t in (("P2", "by hand"), ("P2", None), (None, "by hand"))]
    assert rows(got) == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
