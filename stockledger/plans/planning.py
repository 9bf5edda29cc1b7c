"""Order plan: what was suggested, ordered and done per part and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import as_date, day_of, day_start, in_days
from stockledger.functions.numbers import whole
from stockledger.functions.text import concat_text
from stockledger.operators.spine import with_days
from stockledger.operators.stage import staged
from stockledger.operators.temporal import asof_join, asof_max_by, sum_since_mark
from stockledger.plans.orders import DELETED
from stockledger.sources.catalog import Catalog

# Codes of the source system.
COUNT_CODE, ARRIVAL_CODE = 4, 1
PURCHASE_SUGGESTION = 3
UNDO_REPORTING = 6
MADE_TYPES = [0, 3, 5, 6, 7, 8, 9, 10, 11, 12]
DELIVERED_STATUS = [3, 6]


def part_roles(catalog: Catalog, parts: DataFrame | None = None) -> DataFrame:
    """The roles a part plays: itself (Main), a customer's part (CustomerLink), material of another
    part (Parent). ``parts`` (column ``Id``) limits the result."""

    def limited(df):
        if parts is None:
            return df
        return df.join(parts.select(F.col("Id").alias("PartId")), "PartId", "left_semi")

    def row(kind: str, number: Column, customer: Column, main: Column):
        return [
            "PartId",
            number.cast("string").alias("RelativeRequirementNumber"),
            customer.cast("long").alias("CustomerId"),
            main.cast("long").alias("MainPartId"),
            F.lit(kind).alias("PartType"),
            F.lit(int(kind == "Main")).alias("IsMain"),
            F.lit(int(kind == "CustomerLink")).alias("IsCustomerLink"),
            F.lit(int(kind == "Parent")).alias("IsParent"),
        ]

    none = F.lit(None)
    # The kinds never meet, so each is made distinct by its own few columns and before it is joined. A join then
    # gives equal rows only where its lookup repeats a key, so these rows alone are compared once more.
    main = limited(catalog.table("Part").select(F.col("Id").alias("PartId"))).distinct().select(*row("Main", none, none, none))

    customers = catalog.table("Customer").select(F.col("Id").alias("CustomerId"), F.coalesce("Alias", F.lit("")).alias("alias"))
    customer_number = F.coalesce("CustomerPartNumber", F.lit("")).alias("number")
    links = limited(catalog.table("CustomerPartLink")).select("PartId", "CustomerId", customer_number).distinct()

    def linked(names: DataFrame) -> DataFrame:
        text = concat_text(F.col("alias"), " - ", F.col("number")).alias("text")
        return links.join(names, "CustomerId").select("PartId", "CustomerId", text)

    one, more = _by_repeats(customers.distinct(), "CustomerId")
    customer_rows = linked(one).unionByName(linked(more).distinct()).select(*row("CustomerLink", F.col("text"), F.col("CustomerId"), none))

    preparations = catalog.table("PartPreparation").select(F.col("Id").alias("PreparationId"), F.col("PartId").alias("maker"))
    materials = limited(catalog.table("MaterialRow")).select("PreparationId", "PartId").distinct()

    def made_by(prepared: DataFrame) -> DataFrame:
        return materials.join(prepared, "PreparationId").select("PartId", "maker")

    one, more = _by_repeats(preparations.distinct(), "maker")
    makers = catalog.table("Part").select(F.col("Id").alias("maker"), "PartNumber").distinct()
    parents = made_by(one).unionByName(made_by(more).distinct()).join(makers, "maker").select(
        *row("Parent", F.col("PartNumber"), none, F.col("maker"))
    )
    return main.unionByName(customer_rows).unionByName(parents)


def _by_repeats(lookup: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a lookup whose ``key`` no other row has, and the others."""
    repeated = lookup.groupBy(key).count().filter("count > 1").select(key)
    return lookup.join(repeated, key, "left_anti"), lookup.join(repeated, key, "left_semi")


def _daily(zone: str | None, df: DataFrame, part: str, day: str, amount: str, name: str, *more: Column) -> DataFrame:
    return df.select(F.col(part).alias("part"), day_of(F.col(day), zone).alias("day"), F.col(amount).alias(name), *more)


def _sales(catalog: Catalog, start, end, parts: DataFrame) -> DataFrame:
    """Ordered and delivered quantities of the given parts per day, by customer and, with a NULL
    customer, over all of them."""
    orders = catalog.aliased("CustomerOrder", "CO", "Id", "BusinessContactId", "LifeCycleState")
    rows = catalog.aliased("CustomerOrderRow", "COR", "Id", "ParentOrderId", "PartId", "DeliveryDate", "OrderedQuantity", "LifeCycleState")
    customer = F.col("CO_BusinessContactId").alias("customer")
    ordered = (
        rows.filter((F.col("COR_LifeCycleState") != DELETED) & in_days(F.col("COR_DeliveryDate"), start, end, catalog.zone))
        .join(orders.filter(F.col("CO_LifeCycleState") != DELETED), F.col("COR_ParentOrderId") == F.col("CO_Id"))
    )
    changes = catalog.aliased("QuantityChange", "QC").filter(F.col("QC_Status").isin(DELIVERED_STATUS))
    invoices = catalog.table("CustomerOrderInvoice").select(F.col("Id").alias("CODR_ParentInvoiceId"))
    delivered = (
        catalog.aliased("CustomerOrderDeliveryRow", "CODR")
        .filter(
            F.col("CODR_ParentRowId").isNull()
            & (F.col("CODR_AffectStockBalance") == 1)
            & in_days(F.col("CODR_DeliveryDate"), start, end, catalog.zone)
        )
        .join(invoices, "CODR_ParentInvoiceId", "left_semi")
        .join(changes, F.col("CODR_QuantityChangeId") == F.col("QC_Id"))
        .join(rows, F.col("CODR_CustomerOrderRowId") == F.col("COR_Id"))
        .join(orders, F.col("CODR_CustomerOrderId") == F.col("CO_Id"))
    )
    both = _daily(catalog.zone, ordered, "COR_PartId", "COR_DeliveryDate", "COR_OrderedQuantity", "ordered", customer).unionByName(
        _daily(catalog.zone, delivered, "COR_PartId", "CODR_DeliveryDate", "QC_BalanceChange", "delivered", customer),
        allowMissingColumns=True,
    )
    levels = F.array_distinct(F.array("customer", F.lit(None)))
    counted = both.join(parts, "part", "left_semi").withColumn("customer", F.explode(levels))
    return counted.groupBy("part", "customer", "day").agg(
        F.sum("ordered").alias("ordered"), F.sum("delivered").alias("delivered")
    )


def _supply(catalog: Catalog, start, end, parts: DataFrame) -> DataFrame:
    """Suggested, made and arrived quantities of the given parts per day, from one aggregate."""
    suggested = catalog.table("OrderOperationSuggestion").filter(in_days(F.col("PlannedFinishDate"), start, end, catalog.zone))
    to_buy = catalog.table("OrderSuggestion").filter(
        (F.col("TransType") == PURCHASE_SUGGESTION) & in_days(F.col("DeliveryDate"), start, end, catalog.zone)
    )
    nodes = catalog.aliased("ManufacturingOrderNode", "MON", "Id", "PartId")
    made = (
        catalog.aliased("ManufacturingOrderOperationReporting", "MOOR")
        .filter(F.col("MOOR_Type").isin(MADE_TYPES) & in_days(F.col("MOOR_ActualReportedDate"), start, end, catalog.zone))
        .join(
            catalog.aliased("ManufacturingOrderReporting", "MOR").filter(
                (F.col("MOR_ReportingType") != UNDO_REPORTING) & F.col("MOR_UndoManufacturingOrderReportingId").isNull()
            ),
            F.col("MOOR_ReportingId") == F.col("MOR_Id"),
        )
        .join(nodes, F.col("MOR_RootNodeId") == F.col("MON_Id"))
    )
    arrived = (
        catalog.aliased("PurchaseOrderDeliveryRow", "PODR")
        .filter(in_days(F.col("PODR_DeliveryDate"), start, end, catalog.zone))
        .join(
            catalog.table("PurchaseOrderDelivery").select(F.col("Id").alias("PODR_PurchaseOrderDeliveryId")),
            "PODR_PurchaseOrderDeliveryId",
            "left_semi",
        )
        .join(catalog.aliased("PurchaseOrderRow", "POR"), F.col("PODR_PurchaseOrderRowId") == F.col("POR_Id"))
        .join(
            catalog.aliased("PurchaseOrderDeliveryRowQuantity", "PQ").filter(
                F.col("PQ_BusinessTransactionContextType") == ARRIVAL_CODE
            ),
            F.col("PODR_Id") == F.col("PQ_ParentId"),
        )
        .join(catalog.aliased("QuantityChange", "QC"), F.col("PQ_QuantityChangeId") == F.col("QC_Id"))
    )
    measures = {
        "to_make": _daily(catalog.zone, suggested, "PartId", "PlannedFinishDate", "PlannedQuantity", "to_make"),
        "made": _daily(catalog.zone, made, "MON_PartId", "MOOR_ActualReportedDate", "MOOR_Quantity", "made"),
        "to_buy": _daily(catalog.zone, to_buy, "PartId", "DeliveryDate", "OrderedQuantity", "to_buy"),
        "arrived": _daily(catalog.zone, arrived, "POR_PartId", "PODR_DeliveryDate", "QC_BalanceChange", "arrived"),
    }
    stacked = None
    for df in measures.values():
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    return stacked.join(parts, "part", "left_semi").groupBy("part", "day").agg(*[F.sum(m).alias(m) for m in measures])


def order_plan(
    catalog: Catalog, start, end, part_numbers: list[str] | DataFrame | None = None, warehouse: int = 1
) -> DataFrame:
    """Per day, part (of the list or of a table's first column, or every part) and role of the part: quantities ordered, suggested, made, bought, arrived and
    delivered, the last balance of the day, and the balance counted up from the last stock count.

    The parts are picked first and every measure is summed per part and day before it meets the
    calendar. A role finds the days of its sales as one map, and its rows per day are made in the join
    with the days of its part, behind all others; what belongs to a few rows only is a struct that is
    NULL in the others, also in the sort.
    """
    zone, first, final = catalog.zone, as_date(start, catalog.zone), as_date(end, catalog.zone)
    parts = catalog.table("Part")
    if isinstance(part_numbers, DataFrame):
        parts = parts.join(part_numbers.select(F.col(part_numbers.columns[0]).alias("PartNumber")), "PartNumber", "left_semi")
    elif part_numbers is not None:
        parts = parts.filter(F.col("PartNumber").isin(list(part_numbers)))
    roles = part_roles(catalog, parts)
    # Of all parts, those made are parts as well.
    wanted = parts.select(F.col("Id").alias("part"))
    if part_numbers is not None:
        wanted = roles.select(F.coalesce("MainPartId", "PartId").alias("part")).distinct()
    by_day = F.collect_list(F.struct("day", F.struct("ordered", "delivered").alias("sold")))
    # At most one entry for each day of the plan.
    sold = (
        _sales(catalog, start, end, wanted)
        .groupBy(F.col("part").alias("s_part"), F.col("customer").alias("s_customer"))
        .agg(F.map_from_entries(by_day).alias("sales"))
    )
    supply = _supply(catalog, start, end, parts.select(F.col("Id").alias("part")))

    days = with_days(parts.select(F.col("Id").alias("PartId")), first, final)
    chosen = parts.select(F.col("Id").alias("PartId"))
    movement = catalog.table("InventoryMovement").join(chosen, "PartId", "left_semi")
    after = day_start(F.date_add(final, 1), zone)
    # Of all days before the first, only the last row matters: they count as one day.
    before = F.date_sub(first, 1)
    balances = movement.filter(F.col("LoggingTimeStamp") < after).select(
        "PartId", "LoggingTimeStamp", "Id", F.greatest(day_of(F.col("LoggingTimeStamp"), zone), before).alias("logged_day"),
        F.col("BalanceOnPartAfterChange").alias("last_balance"),
    )
    with_balance = asof_join(
        days, balances, ["PartId"], "day", "logged_day", ["last_balance"], tie=["LoggingTimeStamp", "Id"], dedupe=False
    )
    in_effect = catalog.between("InventoryMovement", "DeliveryDate", None, after).filter(F.col("DeliveryDate") < after)
    movement = in_effect.join(chosen, "PartId", "left_semi")
    counts = movement.filter(F.col("BusinessTransactionContextType") == COUNT_CODE).select(
        "PartId", "LoggingTimeStamp", "Id", F.greatest(day_of(F.col("DeliveryDate"), zone), before).alias("count_day"),
        F.col("LoggingTimeStamp").alias("counted_at"), F.col("BalanceOnPartAfterChange").alias("counted_balance"),
    )
    with_count = asof_max_by(
        with_balance, counts, ["PartId"], "day", "count_day", ["LoggingTimeStamp", "Id"],
        ["counted_at", "counted_balance"], dedupe=False,
    )
    # A few rows per part and day, read by every step that follows.
    with_count = staged(with_count, catalog.workdir)
    changes = movement.filter(
        (F.col("BusinessTransactionContextType") != COUNT_CODE) & (F.col("WarehouseId") == warehouse)
    )
    on_stock = sum_since_mark(
        with_count, changes, ["PartId"], "day", "counted_at", "Id", "LoggingTimeStamp", "DeliveryDate", "BalanceChange",
        "moved", zone,
    )

    is_main = F.col("PartType") == "Main"
    stock = F.struct("to_make", "made", "to_buy", "arrived", "last_balance", "counted_balance", "moved")
    texts = parts.select(F.col("Id").alias("PartId"), "PartNumber", "Description", "ExtraDescription")
    part_days = (
        on_stock.join(supply.withColumnRenamed("part", "PartId"), ["PartId", "day"], "left")
        .select("PartId", "day", "counted_at", stock.alias("stock"))
        .join(texts, "PartId")
    )
    joined = (
        roles.join(
            sold,
            (F.col("s_part") == F.coalesce("MainPartId", "PartId")) & F.col("s_customer").eqNullSafe(F.col("CustomerId")),
            "left",
        )
        .select("PartId", "RelativeRequirementNumber", "MainPartId", "PartType", "sales")
        .join(part_days, "PartId")
        .withColumns({"sold": F.try_element_at("sales", F.col("day")), "stock": F.when(is_main, F.col("stock"))})
        .drop("sales")
        .orderBy("day", "PartNumber")
    )

    def main(column):
        return whole(F.when(is_main, F.col(f"stock.{column}")))

    moved = main("moved")
    return joined.select(
        F.col("day").alias("TransactionDate"),
        "PartId",
        "PartNumber",
        F.col("Description").alias("PartName"),
        F.col("ExtraDescription").alias("PartDescription"),
        "RelativeRequirementNumber",
        "PartType",
        "MainPartId",
        whole(F.col("sold.ordered")).alias("OrderedQuantity"),
        main("to_make").alias("ManufacturingSuggestionQuantity"),
        main("made").alias("ManufacturingQuantity"),
        main("to_buy").alias("PurchasingSuggestionQuantity"),
        main("arrived").alias("ArrivalQuantity"),
        whole(F.col("sold.delivered")).alias("DeliveryQuantity"),
        main("last_balance").alias("LastBalanceOnDay"),
        F.col("counted_at").alias("LastStockCountTakenDate"),
        moved.alias("TotalTransactionFromStockCountUntilCurrent"),
        whole(F.when(is_main, F.coalesce("stock.counted_balance", F.lit(0)) + moved)).alias("ActualLastBalanceOnDay"),
    )
