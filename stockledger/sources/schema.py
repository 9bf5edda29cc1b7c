"""Columns of the business tables the reports read.

Types follow one rule, so a table is only a list of column names:

* ``Id``, ``...Id`` and the two reference links are long keys;
* names that end in a point in time are timestamps;
* quantities, balances and prices are ``decimal(18,4)``, rates and factors ``decimal(24,12)``;
* states, codes and flags are integers;
* everything else is text.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(24, 12)

_TIME = re.compile(r"(Date|TimeStamp|Timestamp|When)$")
_MONEY = re.compile(
    r"(Quantity|QuantityPerUnit|Balance|BalanceChange|AfterChange|Price|Debit|Credit"
    r"|InCompanyCurrency)$"
)
_RATE = re.compile(r"(Factor|Rate)$")
_INTEGER = re.compile(
    r"(Status|LifeCycleState|Type|ContextType|Position|CommitmentLevel|OperationNumber|OperationNo"
    r"|SequenceNumber|IsReplaced|IsPreliminary|AffectStockBalance|CreationContext|ErrorTypes"
    r"|WarningTypes|IsSetupPrice|ReportingType)$"
)

# Table and column names of the source system.
TABLES = {
    "Account": "Id Number",
    "AccountYearSetting": "AccountingYearId ParentId DescriptionId",
    "AccountingYear": "Id Description Status",
    "AccountingYearPeriod": "AccountingYearId FromDate",
    "AccountsPayableLedger": "Id Number",
    "AccountsReceivable": "Id InvoiceNumber ChineseVatInvoiceNumber BusinessContactId",
    "AccountsReceivableLedger": "Id Number",
    "Balance": "Id AccountId EntryIdentifier OpeningBalanceId AccountingYearId",
    "CommentText": "Id RawText Text",
    "CoordinatedPart": "PartId CoordinatedPartHolderId",
    "Currency": "Id Code",
    "Customer": "Id Alias RootId",
    "CustomerOrder": "Id OrderNumber BusinessContactId OrderDate Status LifeCycleState "
    "BusinessContactOrderNumber ExchangeRate CurrencyId",
    "CustomerOrderDeliveryRow": "InvoiceId ParentInvoiceId ParentRowId QuantityChangeId "
    "CustomerOrderRowId CustomerOrderId AffectStockBalance DeliveryDate",
    "CustomerOrderInvoice": "Id DeliveryNoteNumber OrderDeliveryNumber",
    "CustomerOrderRow": "Id ParentOrderId Position PartId DeliveryDate RestQuantity OrderedQuantity "
    "Price CustomerCommitmentLevel LifeCycleState Status RowStatus CustomerOrderNumber UnitId "
    "WarehouseId CreationContext OrderRowType FreeText",
    "CustomerPartLink": "PartId CustomerId CustomerPartNumber",
    "CustomerRoot": "Id Name CustomerCode",
    "DeliverySchedule": "Id Number BuyerCustomerCode BuyerCustomerId Status DeliveryScheduleTypeId "
    "CustomerId CustomerDeliveryScheduleDate",
    "DeliveryScheduleCall": "Id ParentId DeliveryDate CommitmentLevel DemandType IsReplaced Quantity",
    "DeliverySchedulePart": "Id ParentId PartId Status PreviousStatus ErrorTypes WarningTypes "
    "CustomerOrderNumber UnitId",
    "DeliveryScheduleReconciliationCommandTransferred": "Id OrderNumber Position ParentId CallId",
    "DeliveryScheduleType": "Id DescriptionId",
    "DynamicPhrase": "Id Text",
    "EdiBusinessTransaction": "Id BusinessEntityId FileTransactionId",
    "EdiFileTransaction": "Id TransactionNumber FileName FilePath FileCreatedWhen",
    "EntityChangeLog": "EntityId ModifiedBy ChangeType EntityTypeId",
    "ExtraField": "ParentId ParentClass TemplateId String",
    "InventoryMovement": "Id PartId PartNumber LocationName WarehouseId BusinessTransactionContextType "
    "BusinessTransactionId BalanceChange PhysicalInventoryBalance BalanceOnPartAfterChange "
    "BalanceOnLocationAfterChange LoggingTimeStamp DeliveryDate CommentId OrderNumber "
    "QuantityChangeId UserName PersonId BatchNumber SequenceNumber ProjectId ProjectNumber "
    "UndoMovementId ReasonCodeUnplannedStockMovementId",
    "ManufacturingOrder": "Id OrderNumber Status",
    "ManufacturingOrderMaterial": "Id ManufacturingOrderId ManufacturingOrderNodeId PartId "
    "ToOperationNo QuantityPerUnit PlannedQuantity ReportedQuantity RejectedQuantity RestQuantity "
    "ReportNumber",
    "ManufacturingOrderMaterialReporting": "ReportingId MaterialId",
    "ManufacturingOrderNode": "Id ManufacturingOrderId PartId Status",
    "ManufacturingOrderOperation": "ManufacturingOrderId ManufacturingOrderNodeId OperationNumber "
    "PlannedQuantity ReportedQuantity RejectedQuantity RestQuantity PlannedStartDate "
    "PlannedFinishDate ActualStartDate ActualFinishDate WorkCenterId",
    "ManufacturingOrderOperationReporting": "ReportingId Quantity Type ActualReportedDate",
    "ManufacturingOrderReporting": "Id OrderId ReportedWhen RootNodeId ReportingType "
    "UndoManufacturingOrderReportingId",
    "MaterialRow": "PreparationId PartId Quantity",
    "OpeningBalance": "Id DebitInCompanyCurrency CreditInCompanyCurrency",
    "OrderOperationSuggestion": "PartId PlannedQuantity PlannedFinishDate",
    "OrderSuggestion": "PartId OrderedQuantity TransType DeliveryDate",
    "Part": "Id PartNumber Description ExtraDescription StandardPartUnitUsageId PreparationId Status "
    "PartCodeId ProductGroupId CategoryString Type",
    "PartCode": "Id",
    "PartLocation": "PartId Name Balance LifeCycleState WarehouseId",
    "PartPreparation": "Id PartId",
    "PartUnitUsage": "Id PartId UnitId ConversionFactor",
    "Person": "Id EmployeeNumber FirstName LastName",
    "PriceChangeLog": "PartId CustomerId NewPrice OldPrice UserCode Timestamp OldPriceCurrencyId "
    "NewPriceCurrencyId PriceType IsSetupPrice",
    "ProductGroup": "Id Number",
    "ProductRecord": "SerialNumberWithPartNumber",
    "Project": "Id Code",
    "PurchaseOrder": "Id OrderNumber BusinessContactId",
    "PurchaseOrderDelivery": "Id",
    "PurchaseOrderDeliveryRow": "Id PurchaseOrderDeliveryId PurchaseOrderRowId DeliveryDate",
    "PurchaseOrderDeliveryRowQuantity": "ParentId BusinessTransactionContextType QuantityChangeId",
    "PurchaseOrderRow": "Id PartId",
    "QuantityChange": "Id BalanceChange Status",
    "ReasonCodeUnplannedStockMovement": "Id Code DescriptionId",
    "Supplier": "Id RootId",
    "SupplierRoot": "Id SupplierCode",
    "UndoReportingLog": "LoggingTimeStamp EntityIndentity UserName Type",
    "Unit": "Id CodeId",
    "Voucher": "Id VoucherDate Text Number SeriesId AccountingYearId AccountsReceivableLedgerId "
    "AccountsPayableLedgerId AccountsReceivableId IsPreliminary",
    "VoucherRow": "VoucherId BalanceId Debit Credit DebitInCompanyCurrency CreditInCompanyCurrency",
    "VoucherSeries": "Id Series",
    "Warehouse": "Id",
    "WorkCenter": "Id Number",
}

# Names the suffix rule would read wrongly.
_EXCEPTIONS = {"EntityTypeId": T.StringType()}


def column_type(name: str) -> T.DataType:
    if name in _EXCEPTIONS:
        return _EXCEPTIONS[name]
    if name == "Id" or name.endswith("Id"):
        return T.LongType()
    if _TIME.search(name):
        return T.TimestampType()
    if _INTEGER.search(name):
        return T.IntegerType()
    if _MONEY.search(name):
        return MONEY
    if _RATE.search(name):
        return RATE
    return T.StringType()


def table_schema(table: str) -> T.StructType:
    """Declared schema of one table."""
    return T.StructType([T.StructField(c, column_type(c)) for c in TABLES[table].split()])
