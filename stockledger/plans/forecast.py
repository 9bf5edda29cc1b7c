"""Forecasts from delivery schedules and the sales plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import day_of, in_days, month_of
from stockledger.functions.labels import SCHEDULE_STATUS, code_label
from stockledger.functions.numbers import exact_price, exact_total
from stockledger.functions.text import concat_text
from stockledger.operators.aggs import list_distinct
from stockledger.operators.joins import salted_join
from stockledger.operators.stage import staged
from stockledger.operators.temporal import asof_join, first_match, latest_version
from stockledger.plans.orders import DELETED, FINISHED, FIXED_ORDER, FORECAST, customers
from stockledger.sources.catalog import Catalog

# Codes of the source system.
CUSTOMER_PRICES = (-3, 3)
CREATED = 1
ORDER_ENTITY = "9A008BAB-1814-43EC-AFA5-4E42A5C3B36C"


def _forecast_calls(catalog: Catalog) -> DataFrame:
    return catalog.aliased("DeliveryScheduleCall", "DSC").filter(
        (F.col("DSC_IsReplaced") == 0)
        & ((F.col("DSC_DemandType") == FORECAST) | (F.col("DSC_CommitmentLevel") == FORECAST))
    )


def _transmissions(catalog: Catalog) -> DataFrame:
    return catalog.aliased("EdiBusinessTransaction", "EBT").join(
        catalog.aliased("EdiFileTransaction", "EFT"), F.col("EBT_FileTransactionId") == F.col("EFT_Id"), "left"
    )


def _is_buyer():
    """The order's customer is the schedule's buyer, by code or by id.

    The customer is already known from the order, so the either-or needs no join of its own.
    """
    return (F.col("C_Alias") == F.col("DS_BuyerCustomerCode")) | (F.col("C_Id") == F.col("DS_BuyerCustomerId"))


def forecast_by_period(catalog: Catalog, strict: bool = False) -> DataFrame:
    """Forecast calls per delivery schedule, customer and month: the first id and all ids.

    An order row has to exist for the part and date of the call. By default, as in the report this
    stands for, any order's row will do; ``strict`` asks for a row of the call's own order.
    """
    orders = catalog.aliased("CustomerOrder", "CO", "Id", "OrderNumber", "BusinessContactId", "LifeCycleState", "Status").filter(
        (F.col("CO_LifeCycleState") != DELETED) & (F.col("CO_Status") != FINISHED)
    )
    rows = catalog.aliased(
        "CustomerOrderRow", "COR", "ParentOrderId", "PartId", "DeliveryDate", "LifeCycleState", "CustomerCommitmentLevel", "Status"
    ).filter(
        (F.col("COR_LifeCycleState") != DELETED)
        & (F.col("COR_CustomerCommitmentLevel") == FORECAST)
        & (F.col("COR_Status") == 1)
    )
    exists = (F.col("COR_DeliveryDate") == F.col("DSC_DeliveryDate")) & (F.col("COR_PartId") == F.col("DSP_PartId"))
    if strict:
        exists = exists & (F.col("COR_ParentOrderId") == F.col("CO_Id"))
    calls = (
        _forecast_calls(catalog)
        .join(catalog.aliased("DeliveryScheduleReconciliationCommandTransferred", "TR"), F.col("TR_CallId") == F.col("DSC_Id"))
        .join(catalog.aliased("DeliverySchedulePart", "DSP", "Id", "ParentId", "PartId"), F.col("TR_ParentId") == F.col("DSP_Id"))
        .join(catalog.table("Part").select(F.col("Id").alias("DSP_PartId")), "DSP_PartId", "left_semi")
        .join(orders, F.col("CO_OrderNumber") == F.col("TR_OrderNumber"))
        .join(rows, exists, "left_semi")
        .withColumn("ForecastPeriod", month_of(F.col("DSC_DeliveryDate"), catalog.zone))
        .groupBy("DSP_ParentId", "CO_BusinessContactId", "ForecastPeriod")
        .agg(
            F.min("DSC_Id").alias("FirstDeliveryScheduleCallId"),
            list_distinct(F.col("DSC_Id"), quote="'").alias("DeliveryScheduleCallIds"),
        )
    )
    buyers = customers(catalog).filter(F.col("CR_Id").isNotNull())
    return (
        calls.join(catalog.aliased("DeliverySchedule", "DS"), F.col("DSP_ParentId") == F.col("DS_Id"))
        .join(buyers, F.col("CO_BusinessContactId") == F.col("C_Id"))
        .filter(_is_buyer())
        .join(_transmissions(catalog), F.col("EBT_BusinessEntityId") == F.col("DS_Id"))
        .select(
            "FirstDeliveryScheduleCallId",
            "DeliveryScheduleCallIds",
            F.col("DS_Number").alias("DeliveryScheduleNumber"),
            F.col("EFT_TransactionNumber").alias("EdiTransactionNumber"),
            F.col("C_Alias").alias("CustomerCode"),
            F.col("CR_Name").alias("CustomerName"),
            "ForecastPeriod",
            F.col("EFT_FileName").alias("FileName"),
            F.col("EFT_FilePath").alias("FilePath"),
            F.col("EFT_FileCreatedWhen").alias("FileCreatedWhen"),
        )
        .orderBy("FileCreatedWhen", "ForecastPeriod", "DeliveryScheduleNumber")
    )


def forecast_detail(catalog: Catalog) -> DataFrame:
    """Forecast calls whose order row is still open, with the state of their schedule."""
    orders = catalog.aliased("CustomerOrder", "CO", "Id", "OrderNumber", "BusinessContactId", "LifeCycleState").filter(
        F.col("CO_LifeCycleState") != DELETED
    )
    rows = catalog.aliased(
        "CustomerOrderRow", "COR", "ParentOrderId", "PartId", "DeliveryDate", "LifeCycleState", "CustomerCommitmentLevel",
        "Status", "Position",
    ).filter(
        (F.col("COR_LifeCycleState") != DELETED)
        & (F.col("COR_CustomerCommitmentLevel") == FORECAST)
        & ~F.coalesce(F.col("COR_Status") >= 5, F.lit(False))
    )
    buyers = catalog.aliased("Customer", "C")
    status = F.col("DS_Status")
    return (
        _forecast_calls(catalog)
        .join(catalog.aliased("DeliveryScheduleReconciliationCommandTransferred", "TR"), F.col("TR_CallId") == F.col("DSC_Id"))
        .join(catalog.aliased("DeliverySchedulePart", "DSP"), F.col("TR_ParentId") == F.col("DSP_Id"))
        .join(orders, F.col("CO_OrderNumber") == F.col("TR_OrderNumber"))
        .join(
            rows,
            (F.col("COR_ParentOrderId") == F.col("CO_Id"))
            & (F.col("COR_PartId") == F.col("DSP_PartId"))
            & (F.col("COR_DeliveryDate") == F.col("DSC_DeliveryDate")),
        )
        .join(buyers, F.col("CO_BusinessContactId") == F.col("C_Id"))
        .join(catalog.aliased("DeliverySchedule", "DS"), F.col("DSP_ParentId") == F.col("DS_Id"))
        .filter(_is_buyer())
        .join(
            catalog.aliased("Part", "P", "Id", "PartNumber", "Description", "ExtraDescription"),
            F.col("DSP_PartId") == F.col("P_Id"),
        )
        .join(_transmissions(catalog), F.col("EBT_BusinessEntityId") == F.col("DS_Id"))
        .orderBy(
            "DSC_DeliveryDate", "EFT_FileCreatedWhen", "DS_Number", "P_PartNumber", "CO_OrderNumber", "COR_Position"
        )
        .select(
            F.col("DSC_Id").alias("DeliveryScheduleCallId"),
            F.col("DS_Id").alias("DeliveryScheduleId"),
            F.col("DS_Number").alias("DeliveryScheduleNumber"),
            F.col("EBT_Id").alias("EdiBusinessTransactionId"),
            F.col("EFT_TransactionNumber").alias("EdiTransactionNumber"),
            F.col("EFT_FileName").alias("FileName"),
            F.col("EFT_FilePath").alias("FilePath"),
            F.col("EFT_FileCreatedWhen").alias("FileCreatedWhen"),
            status.alias("DeliveryScheduleStatus"),
            code_label(status, SCHEDULE_STATUS, "Unknown").alias("DeliveryScheduleStatusText"),
            F.col("DSP_Status").alias("DeliverySchedulePartStatus"),
            F.col("DSP_PreviousStatus").alias("DeliverySchedulePartPreviousStatus"),
            F.col("DSP_ErrorTypes").alias("DeliverySchedulePartErrorTypes"),
            F.col("DSP_WarningTypes").alias("DeliverySchedulePartWarningTypes"),
            F.col("DS_BuyerCustomerCode").alias("CustomerCode"),
            F.col("CO_OrderNumber").alias("CustomerOrderNumber"),
            F.col("DSP_CustomerOrderNumber").alias("PurchaseOrderNumber"),
            F.lit("Opened").alias("RowOrderStatus"),
            F.col("DSP_PartId").alias("PartId"),
            F.col("P_PartNumber").alias("PartNumber"),
            F.col("P_Description").alias("PartName"),
            F.col("P_ExtraDescription").alias("PartDescription"),
            F.col("DSC_DemandType").alias("DemandType"),
            F.col("DSC_Quantity").alias("Quantity"),
            F.col("DSC_DeliveryDate").alias("DeliveryDate"),
            F.col("DSC_IsReplaced").alias("IsReplaced"),
        )
    )


def _part_lookups(catalog: Catalog, df: DataFrame, part: str, customer: str, unit: str) -> DataFrame:
    """Part, customer, customer's part number and unit text."""
    units = (
        catalog.aliased("Unit", "U")
        .join(catalog.aliased("DynamicPhrase", "UDP"), F.col("U_CodeId") == F.col("UDP_Id"), "left")
        .select("U_Id", F.col("UDP_Text").alias("UnitCode"))
    )
    return (
        df.join(
            catalog.aliased("Part", "P", "Id", "PartNumber", "Description", "ExtraDescription"),
            F.col(part) == F.col("P_Id"),
            "left",
        )
        .join(customers(catalog), F.col(customer) == F.col("C_Id"), "left")
        .join(
            catalog.aliased("CustomerPartLink", "CPL"),
            (F.col("CPL_PartId") == F.col("P_Id")) & (F.col("CPL_CustomerId") == F.col("C_Id")),
            "left",
        )
        .join(units, F.col(unit) == F.col("U_Id"), "left")
    )


PLAN_COLUMNS = [
    "CustomerCode", "CustomerFullName", "CustomerOrderNumber", "PartNumber", "PartName", "PartDescription",
    "CustomerPartNumber", "PlannedQuantity", "UnitCode", "CurrencyCode", "PriceEach", "TotalPrice", "DeliveryDate",
    "PriceChangeUserBy", "PriceChangeDate", "CreatedBy",
]


def _scheduled(catalog: Catalog, start, end) -> DataFrame:
    calls = catalog.aliased("DeliveryScheduleCall", "DSC").filter(
        (F.col("DSC_DemandType") == FORECAST) & in_days(F.col("DSC_DeliveryDate"), start, end, catalog.zone)
    )
    schedules = (
        calls.join(catalog.aliased("DeliverySchedulePart", "DSP"), F.col("DSC_ParentId") == F.col("DSP_Id"))
        .join(catalog.aliased("DeliverySchedule", "DS"), F.col("DSP_ParentId") == F.col("DS_Id"))
        .select(
            "DS_CustomerId", "DS_CustomerDeliveryScheduleDate", "DSP_PartId", "DSP_CustomerOrderNumber", "DSP_UnitId",
            "DSC_DeliveryDate", "DSC_Quantity",
        )
    )
    # The customer's order, part, unit and day decide all lookups, so calls are summed before them, and
    # the newest version is picked among the few sums.
    version = "DS_CustomerDeliveryScheduleDate"
    sums = schedules.groupBy("DS_CustomerId", "DSP_PartId", version, "DSP_CustomerOrderNumber", "DSP_UnitId", "DSC_DeliveryDate").agg(
        F.sum("DSC_Quantity").alias("quantity")
    )
    summed = staged(latest_version(sums, ["DS_CustomerId", "DSP_PartId"], version).drop(version), catalog.workdir)
    currencies = catalog.aliased("Currency", "NC")
    prices = (
        catalog.aliased("PriceChangeLog", "PCL")
        .filter(F.col("PCL_PriceType").isin(list(CUSTOMER_PRICES)) & (F.col("PCL_IsSetupPrice") == 0))
        .join(currencies, F.col("PCL_NewPriceCurrencyId") == F.col("NC_Id"), "left")
        .select(
            F.col("PCL_PartId").alias("DSP_PartId"),
            F.col("PCL_CustomerId").alias("DS_CustomerId"),
            day_of(F.col("PCL_Timestamp"), catalog.zone).alias("price_day"),
            F.col("PCL_Timestamp").alias("PriceChangeDate"),
            F.col("PCL_NewPrice").alias("price"),
            F.col("NC_Code").alias("CurrencyCode"),
            F.col("PCL_UserCode").alias("user_code"),
        )
    )
    # Few of all parts and customers with prices are planned; the others go before the prices are put in order.
    asked = summed.select("DSP_PartId", "DS_CustomerId").distinct().hint("shuffle_hash")
    prices = salted_join(prices, asked, ["DSP_PartId", "DS_CustomerId"], "PriceChangeDate", "left_semi", salts=4)
    priced = asof_join(
        summed.withColumn("delivery_day", day_of(F.col("DSC_DeliveryDate"), catalog.zone)),
        prices,
        ["DSP_PartId", "DS_CustomerId"],
        "delivery_day",
        "price_day",
        ["PriceChangeDate", "price", "CurrencyCode", "user_code"],
    )
    joined = _part_lookups(catalog, priced, "DSP_PartId", "DS_CustomerId", "DSP_UnitId")
    # The greatest texts are found by sorting, which is faster with many values in front. Few rows are alike, so
    # that is done behind the shuffle alone.
    grouped = joined.repartition("P_PartNumber", "DSP_CustomerOrderNumber", "DSC_DeliveryDate").groupBy(
        F.col("P_PartNumber").alias("PartNumber"),
        F.col("CR_CustomerCode").alias("CustomerCode"),
        "CR_Name",
        F.col("CPL_CustomerPartNumber").alias("CustomerPartNumber"),
        F.col("DSP_CustomerOrderNumber").alias("CustomerOrderNumber"),
        F.col("DSC_DeliveryDate").alias("DeliveryDate"),
        "UnitCode",
        "CurrencyCode",
        F.col("price").cast("decimal(38,16)").alias("PriceEach"),
        "PriceChangeDate",
    ).agg(
        F.max("P_Description").alias("PartName"),
        F.max("P_ExtraDescription").alias("PartDescription"),
        F.sum("quantity").alias("PlannedQuantity"),
        F.max("user_code").alias("PriceChangeUserBy"),
    )
    return _totalled(
        grouped.withColumn("CustomerFullName", concat_text(F.col("CustomerCode"), " - ", F.col("CR_Name"))).withColumn(
            "CreatedBy", F.lit("EDI")
        )
    )


def _ordered(catalog: Catalog, start, end, warehouse: int, currency: str) -> DataFrame:
    scheduled = catalog.table("DeliveryScheduleReconciliationCommandTransferred").select(
        F.col("OrderNumber").alias("CO_OrderNumber")
    )
    rows = catalog.aliased("CustomerOrderRow", "COR").filter(
        (F.col("COR_CustomerCommitmentLevel") == FIXED_ORDER)
        & (F.col("COR_WarehouseId") == warehouse)
        & (F.col("COR_CreationContext") == 0)
        & (F.col("COR_OrderRowType") != 4)
        & F.col("COR_PartId").isNotNull()
        & F.col("COR_FreeText").isNull()
        & (F.col("COR_LifeCycleState") != DELETED)
        & in_days(F.col("COR_DeliveryDate"), start, end, catalog.zone)
    )
    creators = first_match(
        catalog.table("EntityChangeLog").filter((F.col("ChangeType") == CREATED) & (F.col("EntityTypeId") == ORDER_ENTITY)),
        ["EntityId"],
        [F.col("ModifiedBy")],
    ).select(F.col("EntityId").alias("created_order"), F.col("ModifiedBy").alias("CreatedBy"))
    currencies = catalog.table("Currency").select(F.col("Id").alias("CO_CurrencyId"))
    orders = (
        catalog.aliased("CustomerOrder", "CO")
        .filter(F.col("CO_LifeCycleState") != DELETED)
        .join(scheduled, "CO_OrderNumber", "left_anti")
        .join(currencies, "CO_CurrencyId", "left_semi")
    )
    joined = _part_lookups(
        catalog, rows.join(orders, F.col("COR_ParentOrderId") == F.col("CO_Id")), "COR_PartId", "CO_BusinessContactId", "COR_UnitId"
    ).join(creators, F.col("CO_Id") == F.col("created_order"), "left")
    return _totalled(
        joined.select(
            F.col("CR_CustomerCode").alias("CustomerCode"),
            concat_text(F.col("CR_CustomerCode"), " - ", F.col("CR_Name")).alias("CustomerFullName"),
            F.col("CO_BusinessContactOrderNumber").alias("CustomerOrderNumber"),
            F.col("P_PartNumber").alias("PartNumber"),
            F.col("P_Description").alias("PartName"),
            F.col("P_ExtraDescription").alias("PartDescription"),
            F.col("CPL_CustomerPartNumber").alias("CustomerPartNumber"),
            F.col("COR_OrderedQuantity").alias("PlannedQuantity"),
            "UnitCode",
            F.lit(currency).alias("CurrencyCode"),
            exact_price(F.col("COR_Price"), F.col("CO_ExchangeRate")).alias("PriceEach"),
            F.col("COR_DeliveryDate").alias("DeliveryDate"),
            F.lit(None).cast("string").alias("PriceChangeUserBy"),
            F.lit(None).cast("timestamp").alias("PriceChangeDate"),
            "CreatedBy",
        )
    )


def _totalled(df: DataFrame) -> DataFrame:
    total = exact_total(F.col("PriceEach"), F.col("PlannedQuantity"))
    return df.withColumn("TotalPrice", total).select(*PLAN_COLUMNS)


def sales_plan(
    catalog: Catalog, start, end, include_orders: bool = True, warehouse: int = 1, currency: str = "IDR"
) -> DataFrame:
    """What is planned to be sold in a period.

    The latest delivery schedule of every customer and part, priced as of the delivery date, and,
    with ``include_orders``, fixed orders that no schedule created, in the company's currency.
    """
    plan = _scheduled(catalog, start, end)
    if include_orders:
        plan = plan.unionByName(_ordered(catalog, start, end, warehouse, currency))
    return plan.distinct()
