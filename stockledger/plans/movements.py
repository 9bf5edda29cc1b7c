"""Stock movements between and on locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import date_fmt
from stockledger.functions.labels import TRANSACTION_TYPE, code_label
from stockledger.functions.text import concat_text, first_nonempty, has_braces, plus_text, with_json_fields
from stockledger.operators.joins import attribute_lookup, lookup_in, pair_legs, typed_lookup
from stockledger.plans.stock import PART_CLASS
from stockledger.sources.catalog import Catalog

# Codes and template ids of the source system.
MOVE_CODE = 7
CUSTOMER_ORDER_CODES = [3, 9, 14, 29]
PURCHASE_ORDER_CODES = [1, 15]
MANUFACTURING_ORDER_CODES = [2, 11, 16, 17]
GENERAL_PART_NUMBER_TEMPLATE = 1028091941218534745
CLASSIFICATION_TEMPLATE = 1028374453433595363


def _comments(catalog: Catalog) -> DataFrame:
    """Comments with the fields of the JSON that users write into them."""
    table = catalog.table("CommentText").select(
        F.col("Id").alias("comment_id"), F.col("RawText").alias("comment_raw"), F.col("Text").alias("comment_shown")
    )
    keys = {
        "json_order": "ManufacturingOrderNumber",
        "json_report": "ReportNumber",
        "json_employee": "EmployeeNumber",
        "json_comment": "Comment",
    }
    return with_json_fields(table, "comment_raw", keys)


def _with_json_person(catalog: Catalog, df: DataFrame) -> DataFrame:
    """Full name of the employee a comment mentions; empty numbers match nobody."""
    persons = (
        catalog.table("Person")
        .filter(F.col("EmployeeNumber") > "")
        .select(
            F.col("EmployeeNumber").alias("mentioned"),
            concat_text(F.col("FirstName"), " ", F.col("LastName")).alias("json_name"),
        )
    )
    return df.join(persons, F.col("json_employee") == F.col("mentioned"), "left").drop("mentioned")


def _unit_names(catalog: Catalog) -> DataFrame:
    return (
        catalog.aliased("PartUnitUsage", "PUU")
        .join(catalog.aliased("Unit", "U"), F.col("PUU_UnitId") == F.col("U_Id"), "left")
        .join(catalog.aliased("DynamicPhrase", "DP"), F.col("U_CodeId") == F.col("DP_Id"), "left")
        .select("PUU_Id", F.col("DP_Text").alias("Unit"))
    )


def _employee(own: Column, own_name: Column, otherwise) -> tuple[Column, Column]:
    """Employee number and name: the person of the movement, else the one in the comment."""
    mentioned = F.col("json_employee")
    number = first_nonempty(own, mentioned)
    name = F.when(own > "", own_name).when(mentioned > "", F.col("json_name")).otherwise(otherwise)
    return number, name


def movement_pairs(catalog: Catalog, code: int = MOVE_CODE) -> DataFrame:
    """One row per move between locations: where from, where to, how much, by whom."""
    movement = catalog.table("InventoryMovement")
    keys = ["PartId", "LoggingTimeStamp", "BusinessTransactionId"]
    kept = ["Id", "PartNumber", "BatchNumber", "LocationName", "BalanceOnLocationAfterChange", "PersonId", "UserName", "CommentId"]
    # Only the outgoing leg has to be a move; the incoming leg is any receipt of the transaction.
    legs = movement.filter((F.col("BalanceChange") > 0) | (F.col("BusinessTransactionContextType") == code))
    pairs = pair_legs(
        legs,
        keys,
        "BalanceChange",
        kept,
        {
            "LocationName": "ToLocation",
            "BalanceChange": "BalanceChange",
            "BalanceOnLocationAfterChange": "ToLocationBalance",
            "CommentId": "to_comment",
        },
    )
    parts = catalog.aliased("Part", "P", "Id", "PartNumber", "Description", "ExtraDescription", "StandardPartUnitUsageId")
    persons = catalog.aliased("Person", "Person")
    serials = catalog.table("ProductRecord")
    serial_key = plus_text(F.col("BatchNumber"), " - ", F.col("PartNumber"))
    comments = _comments(catalog).filter(has_braces(F.col("comment_raw")))
    joined = (
        pairs.join(parts, F.col("PartId") == F.col("P_Id"), "left")
        .join(_unit_names(catalog), F.col("P_StandardPartUnitUsageId") == F.col("PUU_Id"), "left")
        .join(serials, serial_key == F.col("SerialNumberWithPartNumber"), "left")
        .join(persons, F.col("PersonId") == F.col("Person_Id"), "left")
    )
    joined = _with_json_person(catalog, lookup_in(joined, comments, ["CommentId", "to_comment"], "comment_id"))
    own_name = concat_text(F.col("Person_FirstName"), " ", F.col("Person_LastName"))
    number, name = _employee(F.col("Person_EmployeeNumber"), own_name, None)
    comment = F.when(F.col("json_comment").isNotNull(), F.nullif(F.col("json_comment"), F.lit(""))).otherwise(
        first_nonempty(F.col("comment_raw"))
    )
    return joined.select(
        "LoggingTimeStamp",
        F.col("P_PartNumber").alias("PartNumber"),
        F.col("P_Description").alias("Description"),
        F.col("P_ExtraDescription").alias("ExtraDescription"),
        "BatchNumber",
        F.col("SerialNumberWithPartNumber").alias("SerialNumber"),
        F.col("LocationName").alias("FromLocation"),
        "ToLocation",
        "BalanceChange",
        F.col("BalanceOnLocationAfterChange").alias("FromLocationBalance"),
        "ToLocationBalance",
        "Unit",
        number.alias("EmployeeNumber"),
        name.alias("UserFullName"),
        "UserName",
        comment.alias("CommentText"),
        F.col("json_order").alias("ManufacturingOrderNumber"),
        F.col("json_report").alias("ReportNumber"),
        F.col("comment_raw").alias("BaseCommentText"),
    )


def location_transactions(catalog: Catalog) -> DataFrame:
    """All stock movements with their order, delivery note, person, reason and part attributes."""
    customers = (
        catalog.aliased("Customer", "C")
        .join(catalog.aliased("CustomerRoot", "CR"), F.col("C_RootId") == F.col("CR_Id"), "left")
        .select("C_Id", "CR_CustomerCode")
    )
    sales = (
        catalog.aliased("CustomerOrder", "CO", "Id", "OrderNumber", "BusinessContactId")
        .join(customers, F.col("CO_BusinessContactId") == F.col("C_Id"), "left")
        .select(F.col("CO_OrderNumber").alias("sales_key"), "CO_Id", "CO_OrderNumber", "CR_CustomerCode")
    )
    suppliers = (
        catalog.aliased("Supplier", "S")
        .join(catalog.aliased("SupplierRoot", "SR"), F.col("S_RootId") == F.col("SR_Id"), "left")
        .select("S_Id", "SR_SupplierCode")
    )
    purchases = (
        catalog.aliased("PurchaseOrder", "PO")
        .join(suppliers, F.col("PO_BusinessContactId") == F.col("S_Id"), "left")
        .select(F.col("PO_OrderNumber").alias("purchase_key"), "PO_OrderNumber", "SR_SupplierCode")
    )
    production = catalog.table("ManufacturingOrder").select(
        F.col("OrderNumber").alias("production_key"), F.col("OrderNumber").alias("MO_OrderNumber")
    )
    deliveries = (
        catalog.aliased("CustomerOrderDeliveryRow", "CODR", "CustomerOrderId", "QuantityChangeId", "InvoiceId")
        .join(catalog.aliased("CustomerOrderInvoice", "COI"), F.col("CODR_InvoiceId") == F.col("COI_Id"), "left")
        .select("CODR_CustomerOrderId", "CODR_QuantityChangeId", "COI_DeliveryNoteNumber")
    )
    usages = catalog.aliased("PartUnitUsage", "PUU", "Id", "ConversionFactor")
    parts = catalog.aliased("Part", "P").join(usages, F.col("P_StandardPartUnitUsageId") == F.col("PUU_Id"), "left")
    attributes = catalog.table("ExtraField").filter(F.col("ParentClass") == PART_CLASS)
    parts = attribute_lookup(
        parts,
        attributes,
        "P_Id",
        "ParentId",
        "TemplateId",
        "String",
        {
            "ExtraField_Part_GeneralPartNumber": GENERAL_PART_NUMBER_TEMPLATE,
            "ExtraField_Part_PartClassification": CLASSIFICATION_TEMPLATE,
        },
    )
    reasons = (
        catalog.aliased("ReasonCodeUnplannedStockMovement", "RC")
        .join(catalog.aliased("DynamicPhrase", "DP"), F.col("RC_DescriptionId") == F.col("DP_Id"), "left")
        .select("RC_Id", F.col("RC_Code").alias("CauseCode"), F.col("DP_Text").alias("CauseCodeName"))
    )
    comments = _with_json_person(catalog, _comments(catalog))

    # Movements that refer to nothing but their part, as counts do, stay out of the shuffles of all other lookups.
    movement = catalog.table("InventoryMovement")
    refers = F.lit(False)
    for reference in ("OrderNumber", "PersonId", "ReasonCodeUnplannedStockMovementId", "CommentId"):
        refers = refers | F.col(reference).isNotNull()
    moves = typed_lookup(
        movement.filter(refers),
        "OrderNumber",
        "BusinessTransactionContextType",
        [
            (sales, "sales_key", CUSTOMER_ORDER_CODES),
            (purchases, "purchase_key", PURCHASE_ORDER_CODES),
            (production, "production_key", MANUFACTURING_ORDER_CODES),
        ],
    )
    referring = (
        moves.join(
            deliveries,
            (F.col("CODR_CustomerOrderId") == F.col("CO_Id")) & (F.col("CODR_QuantityChangeId") == F.col("QuantityChangeId")),
            "left",
        )
        .join(catalog.aliased("Person", "U"), F.col("PersonId") == F.col("U_Id"), "left")
        .join(reasons, F.col("ReasonCodeUnplannedStockMovementId") == F.col("RC_Id"), "left")
        .join(comments, F.col("CommentId") == F.col("comment_id"), "left")
    )
    # All movements meet their part by hash, so that they are not sorted. The distinct below has a shuffle of its
    # own, and a crowded part in this join can still be split.
    joined = referring.unionByName(movement.filter(~refers), allowMissingColumns=True).join(
        parts.hint("shuffle_hash"), F.col("PartId") == F.col("P_Id"), "left"
    )
    own_name = concat_text(F.col("U_FirstName"), " ", F.col("U_LastName"))
    number, name = _employee(F.col("U_EmployeeNumber"), own_name, "")
    code = F.col("BusinessTransactionContextType")
    comment = F.when(F.col("json_comment").isNotNull(), F.nullif(F.col("json_comment"), F.lit(""))).otherwise(
        F.when(F.col("comment_shown") > "", F.col("comment_raw"))
    )
    return joined.select(
        F.col("P_PartNumber").alias("PartPartNumber"),
        F.col("P_Type").alias("PartType"),
        F.col("P_Id").alias("PartId"),
        F.col("P_Description").alias("PartName"),
        F.col("P_ExtraDescription").alias("PartDescription"),
        F.col("LoggingTimeStamp").alias("InventoryMovementLoggingTimeStamp"),
        date_fmt(F.col("LoggingTimeStamp"), "hh:mm:ss", catalog.zone).alias("InventoryMovementLoggingTimeStampTimePart"),
        F.col("DeliveryDate").alias("InventoryMovementDeliveryDate"),
        F.col("LocationName").alias("InventoryMovementLocationName"),
        F.col("OrderNumber").alias("InventoryMovementOrderNumber"),
        F.col("PO_OrderNumber").alias("PurchaseOrderOrderNumber"),
        F.col("CO_OrderNumber").alias("CustomerOrderOrderNumber"),
        F.col("COI_DeliveryNoteNumber").alias("DeliveryNoteNumber"),
        F.coalesce("json_order", "MO_OrderNumber").alias("ManufacturingOrderOrderNumber"),
        F.col("json_report").alias("ManufacturingOrderReportNumber"),
        code.alias("TransactionTypeId"),
        code_label(code, TRANSACTION_TYPE).alias("TransactionType"),
        comment.alias("InventoryMovementComment"),
        F.col("comment_raw").alias("InventoryMovementCommentRawText"),
        F.col("UserName").alias("InventoryMovementUserName"),
        number.alias("_UserEmployeeNumber"),
        name.alias("_UserFullName"),
        "CauseCode",
        "CauseCodeName",
        "BalanceChange",
        F.col("SequenceNumber").alias("InventoryMovementSequenceNumber"),
        "ExtraField_Part_GeneralPartNumber",
        "ExtraField_Part_PartClassification",
        F.col("BalanceOnLocationAfterChange").alias("InventoryMovementBalanceOnLocationAfterChange"),
        F.col("BalanceOnPartAfterChange").alias("InventoryMovementBalanceOnPartAfterChange"),
        F.col("CR_CustomerCode").alias("CustomerRootCustomerCodeAlias"),
        F.col("SR_SupplierCode").alias("SupplierCodeAlias"),
        F.col("PUU_ConversionFactor").alias("ConversionFactor"),
        F.col("UndoMovementId").alias("InventoryMovementUndoMovementId"),
    ).distinct()
