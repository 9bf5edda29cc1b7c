"""Delivery note numbers: which are missing, and what they must have been."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import as_timestamp, date_fmt
from stockledger.functions.text import text_before
from stockledger.operators.joins import prefix_join
from stockledger.operators.scan import EvenCells, fill_gaps
from stockledger.operators.stage import staged
from stockledger.operators.temporal import first_match_join
from stockledger.sources.catalog import Catalog

# Codes of the source system.
DELIVERY_CODE = 3
UNDONE_DELIVERY_LOG = 1
STAMP = "YYYY-MM-DD hh:mm:ss"


def document_status(catalog: Catalog, start, end) -> DataFrame:
    """Deliveries of a period, one row per second, user and document: created, replaced by a later
    document, or cancelled."""
    movement = catalog.table("InventoryMovement")
    deliveries = movement.filter(
        (F.col("BusinessTransactionContextType") == DELIVERY_CODE)
        & F.col("LoggingTimeStamp").between(as_timestamp(start, catalog.zone), as_timestamp(end, catalog.zone))
    ).select("LoggingTimeStamp", "UserName", "DeliveryDate", "QuantityChangeId", "UndoMovementId", "OrderNumber")
    # Only what the period's deliveries name is read on: their undo movements and their document rows.
    undo_ids = deliveries.filter(F.col("UndoMovementId").isNotNull()).select(F.col("UndoMovementId").alias("Id")).distinct()
    changes = deliveries.filter(F.col("QuantityChangeId").isNotNull()).select("QuantityChangeId").distinct()
    undone = movement.join(undo_ids, "Id", "left_semi").select(
        F.col("Id").alias("UndoMovementId"),
        F.col("LoggingTimeStamp").alias("undo_logged"),
        F.col("UserName").alias("UndoUserName"),
    )
    notes = catalog.table("CustomerOrderInvoice").select(F.col("Id").alias("note_id"), "DeliveryNoteNumber")
    links = catalog.table("CustomerOrderDeliveryRow").join(changes, "QuantityChangeId", "left_semi")
    numbered = first_match_join(
        deliveries, links, "QuantityChangeId", "InvoiceId", [F.col("InvoiceId").asc_nulls_last()], notes, "note_id"
    ).join(undone, "UndoMovementId", "left")

    log = (
        catalog.table("UndoReportingLog")
        .filter(F.col("Type") == UNDONE_DELIVERY_LOG)
        .groupBy(
            date_fmt(F.col("LoggingTimeStamp"), STAMP, catalog.zone).alias("log_second"),
            text_before(F.col("EntityIndentity"), "/").alias("log_document"),
            F.col("UserName").alias("log_user"),
        )
        .agg(F.min("EntityIndentity").alias("log_entity"))
        .drop("log_document")
    )
    replaced = catalog.table("CustomerOrderInvoice").select(
        F.col("OrderDeliveryNumber").alias("replaced_key"),
        F.col("DeliveryNoteNumber").alias("ReplacedDeliveryNoteNumber"),
    )
    logged = prefix_join(
        numbered.withColumn("UndoLoggingTime", date_fmt(F.col("undo_logged"), STAMP, catalog.zone)),
        log,
        "OrderNumber",
        "log_entity",
        also=[("UndoLoggingTime", "log_second"), ("UndoUserName", "log_user")],
        how="left",
    ).join(replaced, F.col("log_entity") == F.col("replaced_key"), "left")
    grouped = (
        logged.withColumn("LoggingTime", date_fmt(F.col("LoggingTimeStamp"), STAMP, catalog.zone))
        .groupBy(
            "LoggingTime", "UndoLoggingTime", "UserName", "UndoUserName", "DeliveryNoteNumber",
            "ReplacedDeliveryNoteNumber", "DeliveryDate",
        )
        .agg(F.min("LoggingTimeStamp").alias("LoggingTimeStamp"), F.min("undo_logged").alias("UndoLoggingTimeStamp"))
    )
    status = (
        F.when(F.col("DeliveryNoteNumber").isNotNull(), "Created")
        .when(F.col("ReplacedDeliveryNoteNumber").isNotNull(), "Replaced")
        .otherwise("Cancelled")
    )
    return grouped.withColumn("Status", status)


def gap_fill_number(catalog: Catalog, start, end) -> DataFrame:
    """``document_status`` in order of time with every missing number filled in: the last number
    before it plus its distance or, before the first number, the next one less its distance.

    The order is one sequence over all users, cut into cells of equal size however crowded a day or
    a minute is. Rows of the same time share their group and their distance; the numbers around them follow the order of their other
    columns. A number that is there is passed on as text as it is, digits or not; one counted up from
    a number that is not digits is NULL.
    """
    documents = staged(document_status(catalog, start, end), catalog.workdir)
    order = [
        "LoggingTimeStamp", "UserName", "UndoLoggingTime", "UndoUserName", "DeliveryNoteNumber",
        "ReplacedDeliveryNoteNumber", "DeliveryDate",
    ]
    filled = fill_gaps(
        documents, [], order, "DeliveryNoteNumber",
        cells=EvenCells(), peers=["LoggingTimeStamp"],
    )

    def number(column):
        return F.col(column).try_cast("decimal(37,0)")

    predicted = (
        F.when(F.col("DeliveryNoteNumber").isNotNull(), number("DeliveryNoteNumber"))
        .when(F.col("previous_number").isNotNull(), number("previous_number") + F.col("steps_after"))
        .otherwise(number("next_number") - F.col("steps_before"))
        .cast("decimal(38,0)")
    )
    return filled.withColumn("PredictDeliveryNoteNumber", predicted).select(
        "LoggingTime",
        "LoggingTimeStamp",
        "UndoLoggingTime",
        "UndoLoggingTimeStamp",
        "UserName",
        "UndoUserName",
        "DeliveryNoteNumber",
        F.col("previous_number").alias("PreviousDeliveryNoteNumber"),
        F.col("next_number").alias("NextDeliveryNoteNumber"),
        "ReplacedDeliveryNoteNumber",
        "DeliveryDate",
        "Status",
        F.col("island").alias("GroupId"),
        F.col("steps_after").alias("AscSumCount"),
        F.col("steps_before").alias("DescSumCount"),
        "PredictDeliveryNoteNumber",
        F.coalesce("DeliveryNoteNumber", F.col("PredictDeliveryNoteNumber").cast("string")).alias("StringPredictDeliveryNoteNumber"),
    )
