"""Outstanding customer orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import month_of
from stockledger.functions.labels import COMMITMENT_LEVEL, ORDER_STATUS, code_label
from stockledger.sources.catalog import Catalog

# States of the source system.
DELETED = 99
FINISHED = 9
FIXED_ORDER, FORECAST = 1, 4


def customers(catalog: Catalog) -> DataFrame:
    """Customers with the name and code of their root."""
    return catalog.aliased("Customer", "C").join(
        catalog.aliased("CustomerRoot", "CR"), F.col("C_RootId") == F.col("CR_Id"), "left"
    )


def _open_rows(catalog: Catalog, levels) -> DataFrame:
    return catalog.aliased("CustomerOrderRow", "COR").filter(
        (F.col("COR_LifeCycleState") != DELETED)
        & (F.col("COR_Status") != FINISHED)
        & F.col("COR_CustomerCommitmentLevel").isin(list(levels))
    )


def outstanding_by_period(catalog: Catalog, levels=(FIXED_ORDER, FORECAST)) -> DataFrame:
    """Open quantity and number of order rows per part, customer, commitment level and month."""
    orders = catalog.aliased("CustomerOrder", "CO").filter(F.col("CO_LifeCycleState") != DELETED)
    known = catalog.table("Customer").select(F.col("Id").alias("CustomerId"))
    level = F.col("COR_CustomerCommitmentLevel")
    grouped = (
        _open_rows(catalog, levels)
        .join(orders, F.col("COR_ParentOrderId") == F.col("CO_Id"))
        .join(known, F.col("CO_BusinessContactId") == F.col("CustomerId"), "left")
        .withColumn("DeliveryPeriod", month_of(F.col("COR_DeliveryDate"), catalog.zone))
        .groupBy("CustomerId", level.alias("CustomerCommitmentLevel"), F.col("COR_PartId").alias("PartId"), "DeliveryPeriod")
        .agg(
            F.countDistinct("COR_Id").alias("CustomerOrderRowCount"),
            F.sum("COR_RestQuantity").alias("RestQuantity"),
        )
    )
    parts = catalog.aliased("Part", "P").filter(F.col("P_Status") != FINISHED)
    return (
        grouped.join(parts, F.col("PartId") == F.col("P_Id"))
        .join(customers(catalog), F.col("CustomerId") == F.col("C_Id"), "left")
        .select(
            F.col("P_PartNumber").alias("PartNumber"),
            F.col("P_Description").alias("PartName"),
            F.col("P_ExtraDescription").alias("PartDescription"),
            F.col("C_Alias").alias("CustomerCode"),
            F.col("CR_Name").alias("CustomerName"),
            "CustomerOrderRowCount",
            "CustomerCommitmentLevel",
            code_label(F.col("CustomerCommitmentLevel"), COMMITMENT_LEVEL, "Unknown").alias("CustomerCommitmentLevelText"),
            "DeliveryPeriod",
            "RestQuantity",
        )
    )


def outstanding_with_schedule(catalog: Catalog, levels=(FIXED_ORDER, FORECAST)) -> DataFrame:
    """Open order rows with the delivery schedule their call came from, if any.

    Order number, part, position and date are equalities, so the two either-or conditions only
    filter the few candidates those leave.
    """
    calls = (
        catalog.aliased("DeliveryScheduleReconciliationCommandTransferred", "TR")
        .join(
            catalog.aliased("DeliveryScheduleCall", "DSC").filter("DSC_IsReplaced = 0"),
            (F.col("TR_CallId") == F.col("DSC_Id")) & (F.col("TR_ParentId") == F.col("DSC_ParentId")),
        )
        .join(catalog.aliased("DeliverySchedulePart", "DSP"), F.col("TR_ParentId") == F.col("DSP_Id"))
        .join(catalog.aliased("DeliverySchedule", "DS"), F.col("DSP_ParentId") == F.col("DS_Id"))
    )
    # A schedule that came in several transmissions shows once for each.
    sent = catalog.table("EdiBusinessTransaction").select(F.col("BusinessEntityId").alias("sent_schedule"))
    calls = calls.join(sent, F.col("DS_Id") == F.col("sent_schedule"), "left").select(
        "DS_Number", "DS_BuyerCustomerCode", "DS_BuyerCustomerId", "TR_OrderNumber", "TR_Position", "DSP_PartId",
        "DSC_DeliveryDate", "DSC_DemandType", "DSC_CommitmentLevel",
    )
    orders = catalog.aliased("CustomerOrder", "CO").filter(
        (F.col("CO_Status") != FINISHED) & (F.col("CO_LifeCycleState") != DELETED)
    )
    parts = catalog.aliased("Part", "P", "Id", "PartNumber", "Status").filter(F.col("P_Status") != FINISHED)
    level = F.col("COR_CustomerCommitmentLevel")
    rows = (
        _open_rows(catalog, levels)
        .join(orders, F.col("COR_ParentOrderId") == F.col("CO_Id"))
        .join(parts, F.col("COR_PartId") == F.col("P_Id"))
        .join(customers(catalog), F.col("CO_BusinessContactId") == F.col("C_Id"), "left")
    )
    matched = rows.join(
        calls,
        (F.col("TR_OrderNumber") == F.col("CO_OrderNumber"))
        & (F.col("DSP_PartId") == F.col("P_Id"))
        & (F.col("TR_Position") == F.col("COR_Position"))
        & (F.col("DSC_DeliveryDate") == F.col("COR_DeliveryDate"))
        & ((F.col("DS_BuyerCustomerCode") == F.col("C_Alias")) | (F.col("DS_BuyerCustomerId") == F.col("C_Id")))
        & ((F.col("DSC_DemandType") == level) | (F.col("DSC_CommitmentLevel") == level)),
        "left",
    )
    return matched.select(
        F.col("CO_Id").alias("CustomerOrderId"),
        F.col("COR_Id").alias("CustomerOrderRowId"),
        F.col("DS_Number").alias("DeliveryScheduleNumber"),
        F.col("P_PartNumber").alias("PartNumber"),
        F.col("CO_OrderNumber").alias("OrderNumber"),
        F.col("C_Alias").alias("CustomerCode"),
        F.col("CR_Name").alias("CustomerName"),
        F.col("CO_OrderDate").alias("OrderDate"),
        F.coalesce("COR_CustomerOrderNumber", "CO_BusinessContactOrderNumber").alias("CustomerPurchaseOrderNumber"),
        F.col("CO_Status").alias("OrderStatus"),
        code_label(F.col("CO_Status"), ORDER_STATUS, "Unknown").alias("OrderStatusText"),
        F.col("COR_Position").alias("Position"),
        level.alias("CustomerCommitmentLevel"),
        code_label(level, COMMITMENT_LEVEL, "Unknown").alias("CustomerCommitmentLevelText"),
        F.col("COR_RowStatus").alias("RowStatus"),
        F.col("COR_Status").alias("RowOrderStatus"),
        code_label(F.col("COR_Status"), ORDER_STATUS, "Unknown").alias("RowOrderStatusText"),
        F.col("COR_DeliveryDate").alias("DeliveryDate"),
        month_of(F.col("COR_DeliveryDate"), catalog.zone).alias("DeliveryPeriod"),
        F.col("COR_RestQuantity").alias("RestQuantity"),
    ).orderBy("DeliveryDate")
