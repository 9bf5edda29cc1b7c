"""Material of manufacturing orders and bills of materials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import as_timestamp, in_days
from stockledger.functions.labels import MANUFACTURING_STATUS, code_label
from stockledger.functions.numbers import differs, not_below_zero
from stockledger.functions.text import looks_like_json, with_json_fields
from stockledger.operators.joins import not_in_scope, siblings
from stockledger.operators.scan import EvenCells, running_total
from stockledger.operators.stage import staged
from stockledger.operators.temporal import first_match
from stockledger.sources.catalog import Catalog

# Prefixes, states and codes of the source system.
DELETED = 99
RAW, MASTERBATCH, CRUSHED = "R-", "R-MB-", "R-CRUSH"
MOVE_CODE = 7


def _texts(catalog: Catalog, alias: str) -> DataFrame:
    return catalog.aliased("Part", alias, "Id", "PartNumber", "Description", "ExtraDescription")


def reported_below_estimate(
    catalog: Catalog,
    start,
    as_of=None,
    location: str = "WHCC-PROD",
    statuses: tuple[int, ...] = (4, 5, 6, 7, 8, 9),
) -> DataFrame:
    """Raw material reported below (made + rejected) x quantity per unit, for orders last reported
    between ``start`` and ``as_of`` (now by default), with the shortfall added up per material and
    the balance it would leave.

    What was reported on crushed material of the same order node counts as reported too: the crushed
    row's own quantity, where the report this follows repeats that of the raw material's row.
    """
    until = F.current_timestamp() if as_of is None else as_timestamp(as_of, catalog.zone)
    # A last report in the period is one from its start on; the end bounds the maximum only.
    last_report = (
        catalog.table("ManufacturingOrderReporting")
        .filter(F.col("ReportedWhen") >= as_timestamp(start, catalog.zone))
        .groupBy(F.col("OrderId").alias("reported_order"))
        .agg(F.max("ReportedWhen").alias("LastReportingDate"))
        .filter(F.col("LastReportingDate") <= until)
    )
    orders = (
        catalog.aliased("ManufacturingOrder", "MO")
        .filter(F.col("MO_Status").isin(list(statuses)))
        .join(last_report, F.col("MO_Id") == F.col("reported_order"))
    )
    nodes = catalog.aliased("ManufacturingOrderNode", "MON").join(
        _texts(catalog, "Main"), F.col("MON_PartId") == F.col("Main_Id"), "left"
    )
    parts = _texts(catalog, "P")
    materials = catalog.aliased("ManufacturingOrderMaterial", "MOM").join(parts, F.col("MOM_PartId") == F.col("P_Id"))
    text = F.col("P_ExtraDescription")
    raw = materials.filter(
        text.startswith(RAW)
        & ~text.startswith(MASTERBATCH)
        & ~text.startswith(CRUSHED)
        & (F.col("MOM_QuantityPerUnit") != 0)
    )
    node_key = ["MOM_ManufacturingOrderId", "MOM_ManufacturingOrderNodeId"]
    crushed = first_match(
        materials.filter(text.startswith(CRUSHED)).select(*node_key, "MOM_Id", "MOM_ReportedQuantity"),
        node_key,
        [F.col("MOM_Id")],
    ).select(*node_key, F.col("MOM_ReportedQuantity").alias("crushed_quantity"))
    stock = (
        catalog.aliased("PartLocation", "PL", "PartId", "Balance", "LifeCycleState", "Name")
        .filter((F.col("PL_LifeCycleState") != DELETED) & (F.col("PL_Name") == location))
        .select("PL_PartId", "PL_Balance")
    )
    operations = catalog.aliased("ManufacturingOrderOperation", "MOO")
    joined = (
        raw.join(crushed, node_key, "left")
        .join(orders, F.col("MOM_ManufacturingOrderId") == F.col("MO_Id"))
        .join(
            nodes,
            (F.col("MOM_ManufacturingOrderNodeId") == F.col("MON_Id")) & (F.col("MON_ManufacturingOrderId") == F.col("MO_Id")),
        )
        .join(
            operations,
            (F.col("MOO_ManufacturingOrderId") == F.col("MO_Id"))
            & (F.col("MOO_ManufacturingOrderNodeId") == F.col("MON_Id"))
            & (F.col("MOO_OperationNumber") == F.col("MOM_ToOperationNo")),
        )
        .join(stock, F.col("PL_PartId") == F.col("P_Id"), "left")
    )
    made = F.col("MOO_ReportedQuantity") + F.col("MOO_RejectedQuantity")
    reported = F.coalesce("MOM_ReportedQuantity", F.lit(0)) + F.coalesce("crushed_quantity", F.lit(0))
    short = staged(
        joined.withColumn("MaterialReportedQuantity", reported)
        .withColumn("EstimatedReportedQuantity", (made * F.col("MOM_QuantityPerUnit")).cast("decimal(28,8)"))
        .withColumn("DifferenceReportedQuantity", F.col("MaterialReportedQuantity") - F.col("EstimatedReportedQuantity"))
        .filter("MaterialReportedQuantity < EstimatedReportedQuantity"),
        catalog.workdir,
    )
    total = "CumulativeTotalDifferenceReportedQuantityPerMaterialPart"
    summed = running_total(
        short,
        ["P_PartNumber"],
        ["LastReportingDate", "MOM_Id"],
        "DifferenceReportedQuantity",
        total,
        cells=EvenCells(),
    )
    return summed.select(
        "LastReportingDate",
        F.col("MO_OrderNumber").alias("OrderNumber"),
        F.col("MO_Status").alias("Status"),
        F.col("Main_PartNumber").alias("PartNumber"),
        F.col("Main_Description").alias("PartName"),
        F.col("Main_ExtraDescription").alias("PartDescription"),
        F.col("MOM_ToOperationNo").alias("ToOperationNo"),
        F.col("MOO_PlannedQuantity").alias("PlannedQuantity"),
        F.col("MOO_ReportedQuantity").alias("ReportedQuantity"),
        F.col("MOO_RejectedQuantity").alias("RejectedQuantity"),
        F.col("MOO_RestQuantity").alias("RestQuantity"),
        F.col("P_PartNumber").alias("MaterialPartNumber"),
        F.col("P_Description").alias("MaterialPartName"),
        F.col("P_ExtraDescription").alias("MaterialPartDescription"),
        F.col("MOM_QuantityPerUnit").alias("QuantityPerUnit"),
        F.col("MOM_PlannedQuantity").alias("MaterialPlannedQuantity"),
        "MaterialReportedQuantity",
        F.col("MOM_RejectedQuantity").alias("MaterialRejectedQuantity"),
        F.col("MOM_RestQuantity").alias("MaterialRestQuantity"),
        "EstimatedReportedQuantity",
        "DifferenceReportedQuantity",
        F.lit(1).alias("IsBelowEstimated"),
        F.col("PL_Balance").alias("CurrentBalance"),
        total,
        (F.col("PL_Balance") + F.col(total)).alias("CurrentBalancePerMaterialPartAfterReported"),
    ).orderBy("MaterialPartNumber", "LastReportingDate")


def order_material(
    catalog: Catalog, warehouse: int = 1, move_code: int = MOVE_CODE, excluded: tuple[str, ...] = ("M-", "E-")
) -> DataFrame:
    """Material of every manufacturing order: planned, reported, outstanding, transferred to the
    order (as its comments say) and what is left of that on the floor."""
    raw = F.col("RawText")
    texts = catalog.table("CommentText").filter(
        looks_like_json(raw) & raw.contains('"ManufacturingOrderNumber":"') & raw.contains('"NodePartNumber":"')
    )
    comments = with_json_fields(
        texts.select(F.col("Id").alias("CommentId"), "RawText"),
        "RawText",
        {"to_order": "ManufacturingOrderNumber", "to_part": "NodePartNumber"},
    ).drop("RawText")
    transferred = (
        catalog.table("InventoryMovement")
        .filter(F.col("BusinessTransactionContextType") == move_code)
        .select("CommentId", "PartId", "BalanceChange")
        .join(comments, "CommentId")
        .groupBy(F.col("PartId").alias("moved_part"), "to_order", "to_part")
        .agg(F.sum("BalanceChange").alias("transferred"))
    )
    on_hand = (
        catalog.table("PartLocation")
        .filter((F.col("WarehouseId") == warehouse) & (F.col("LifeCycleState") != DELETED))
        .groupBy(F.col("PartId").alias("stocked_part"))
        .agg(F.sum("Balance").alias("on_hand"))
    )
    units = (
        catalog.aliased("PartUnitUsage", "PUU")
        .join(catalog.aliased("Unit", "U"), F.col("PUU_UnitId") == F.col("U_Id"), "left")
        .join(catalog.aliased("DynamicPhrase", "DP"), F.col("U_CodeId") == F.col("DP_Id"), "left")
        .select("PUU_Id", F.col("DP_Text").alias("MaterialUnit"))
    )
    text = F.col("Mat_ExtraDescription")
    materials = catalog.aliased(
        "Part", "Mat", "Id", "PartNumber", "Description", "ExtraDescription", "StandardPartUnitUsageId"
    )
    for prefix in excluded:
        materials = materials.filter(~text.startswith(prefix))
    materials = materials.join(units, F.col("Mat_StandardPartUnitUsageId") == F.col("PUU_Id"), "left").join(
        on_hand, F.col("stocked_part") == F.col("Mat_Id"), "left"
    )
    nodes = catalog.aliased("ManufacturingOrderNode", "MON").join(
        _texts(catalog, "Main"), F.col("MON_PartId") == F.col("Main_Id")
    )
    centers = catalog.aliased("WorkCenter", "WC")
    # What orders, nodes and operations say is put together before it meets the many materials, so these are
    # shuffled once for it. Parts and transfers are far fewer than materials, which need no sort to find them.
    headers = (
        catalog.aliased("ManufacturingOrderOperation", "MOO")
        .join(centers, F.col("MOO_WorkCenterId") == F.col("WC_Id"), "left")
        .join(catalog.aliased("ManufacturingOrder", "MO"), F.col("MOO_ManufacturingOrderId") == F.col("MO_Id"))
        .join(nodes, F.col("MOO_ManufacturingOrderNodeId") == F.col("MON_Id"))
    )
    joined = (
        catalog.aliased("ManufacturingOrderMaterial", "MOM")
        .join(materials.hint("shuffle_hash"), F.col("MOM_PartId") == F.col("Mat_Id"))
        .join(
            headers,
            (F.col("MOM_ManufacturingOrderId") == F.col("MOO_ManufacturingOrderId"))
            & (F.col("MOM_ManufacturingOrderNodeId") == F.col("MOO_ManufacturingOrderNodeId"))
            & (F.col("MOM_ToOperationNo") == F.col("MOO_OperationNumber")),
        )
        .join(
            transferred.hint("shuffle_hash"),
            (F.col("moved_part") == F.col("Mat_Id"))
            & (F.col("to_order") == F.col("MO_OrderNumber"))
            & (F.col("to_part") == F.col("Main_PartNumber")),
            "left",
        )
    )
    moved = F.coalesce("transferred", F.lit(0))
    return joined.select(
        F.col("MOM_Id").alias("Id"),
        F.col("MO_Id").alias("ManufacturingOrderId"),
        F.col("MO_OrderNumber").alias("ManufacturingOrderNumber"),
        F.col("MON_Id").alias("ManufacturingOrderNodeId"),
        F.col("MON_Status").alias("ManufacturingOrderStatusId"),
        code_label(F.col("MON_Status"), MANUFACTURING_STATUS).alias("ManufacturingOrderStatus"),
        F.col("MOO_OperationNumber").alias("OperationNumber"),
        F.col("Main_PartNumber").alias("MainPartNumber"),
        F.col("Main_Description").alias("MainPartName"),
        F.col("Main_ExtraDescription").alias("MainPartDescription"),
        F.col("MOO_PlannedStartDate").alias("PlannedStartDate"),
        F.col("MOO_PlannedFinishDate").alias("PlannedFinishDate"),
        F.col("MOO_ActualStartDate").alias("ActualStartDate"),
        F.col("MOO_ActualFinishDate").alias("ActualFinishDate"),
        F.col("WC_Number").alias("WorkCenter"),
        F.col("MOM_ReportNumber").alias("ReportNumber"),
        F.col("Mat_PartNumber").alias("MaterialPartNumber"),
        F.col("Mat_Description").alias("MaterialPartName"),
        F.col("Mat_ExtraDescription").alias("MaterialDescription"),
        F.coalesce("on_hand", F.lit(0)).alias("MaterialCurrentBalance"),
        F.col("MOM_PlannedQuantity").alias("MaterialPlannedQuantity"),
        F.col("MOM_ReportedQuantity").alias("MaterialReportedQuantity"),
        (F.col("MOM_PlannedQuantity") - F.col("MOM_ReportedQuantity")).alias("MaterialOutstandingQuantity"),
        F.col("MOM_RestQuantity").alias("MaterialRemainingQuantity"),
        moved.alias("MaterialTransferredQuantity"),
        not_below_zero(moved - F.col("MOM_ReportedQuantity")).alias("MaterialRestQuantity"),
        "MaterialUnit",
    )


def reported_not_in_bom(catalog: Catalog, start, end) -> DataFrame:
    """Materials reported in a period that the main part's bill of materials does not list."""
    reported = (
        catalog.aliased("ManufacturingOrderReporting", "MOR", "Id", "OrderId", "ReportedWhen")
        .filter(in_days(F.col("MOR_ReportedWhen"), start, end, catalog.zone))
        .join(catalog.aliased("ManufacturingOrderMaterialReporting", "MOMR"), F.col("MOR_Id") == F.col("MOMR_ReportingId"))
        .join(
            catalog.aliased("ManufacturingOrderMaterial", "MOM", "Id", "PartId", "ManufacturingOrderNodeId"),
            F.col("MOMR_MaterialId") == F.col("MOM_Id"),
        )
        .join(catalog.aliased("ManufacturingOrder", "MO"), F.col("MOR_OrderId") == F.col("MO_Id"))
        .join(catalog.aliased("ManufacturingOrderNode", "MON"), F.col("MOM_ManufacturingOrderNodeId") == F.col("MON_Id"))
        .join(
            catalog.aliased("Part", "Main", "Id", "PartNumber", "Description", "ExtraDescription", "PreparationId"),
            F.col("MON_PartId") == F.col("Main_Id"),
        )
        .join(
            _texts(catalog, "Mat").filter(~F.col("Mat_ExtraDescription").startswith(CRUSHED)),
            F.col("MOM_PartId") == F.col("Mat_Id"),
        )
    )
    preparations = catalog.table("PartPreparation").select(F.col("Id").alias("PreparationId"))
    allowed = catalog.table("MaterialRow").join(preparations, "PreparationId", "left_semi")
    return (
        not_in_scope(reported, allowed, ("Main_PreparationId", "PreparationId"), ("Mat_Id", "PartId"))
        .select(
            F.col("MOR_ReportedWhen").alias("ReportedWhen"),
            F.col("MO_OrderNumber").alias("OrderNumber"),
            *_named("Main", "Main"),
            *_named("Mat", "Material"),
        )
        .distinct()
    )


def _named(alias: str, prefix: str) -> list[Column]:
    return [
        F.col(f"{alias}_PartNumber").alias(f"{prefix}PartNumber"),
        F.col(f"{alias}_Description").alias(f"{prefix}PartName"),
        F.col(f"{alias}_ExtraDescription").alias(f"{prefix}PartDescription"),
    ]


def main_material(catalog: Catalog, prefix: str = RAW) -> DataFrame:
    """First raw material (lowest part id) in the bill of materials of every part."""
    rows = (
        catalog.aliased("MaterialRow", "MR")
        .join(catalog.aliased("PartPreparation", "PP"), F.col("MR_PreparationId") == F.col("PP_Id"))
        .join(
            _texts(catalog, "P").filter(F.col("P_ExtraDescription").startswith(prefix)),
            F.col("MR_PartId") == F.col("P_Id"),
        )
    )
    picked = first_match(rows, ["PP_PartId"], [F.col("P_Id"), F.col("MR_Quantity")])
    return picked.select(
        F.col("PP_PartId").alias("made_part"),
        F.col("P_PartNumber").alias("material_number"),
        F.col("P_ExtraDescription").alias("material_text"),
        F.col("MR_Quantity").alias("material_quantity"),
    )


def sibling_diff(catalog: Catalog, prefix: str = RAW) -> DataFrame:
    """Coordinated parts side by side with their main materials, flagged if the quantities differ.

    The result has one row per ordered pair of parts under a holder, which is what the report is.
    For holders of any size use ``sibling_flags``, which answers per part without forming pairs.
    """
    material = main_material(catalog, prefix)
    main, other = ("MainPart", "MainMaterial"), ("CoordinatedPart", "CoordinatedMaterial")

    def described(df, key, part, material_name):
        # Each side is described by its own renamed copy.
        text = _texts(catalog, part)
        own = material.select(*[F.col(c).alias(f"{part}_{c}") for c in material.columns])
        how = "left" if part == "MainPart" else "inner"
        return df.join(text, F.col(key) == F.col(f"{part}_Id"), how).join(
            own, F.col(f"{part}_Id") == F.col(f"{part}_made_part"), "left"
        )

    members = catalog.table("CoordinatedPart")
    pairs = siblings(members, "CoordinatedPartHolderId", "PartId", "sibling_id")
    joined = described(described(pairs, "PartId", *main), "sibling_id", *other)

    def columns(part, material_name):
        return [
            F.col(f"{part}_Id").alias(f"{part}Id"),
            F.col(f"{part}_PartNumber").alias(f"{part}Number"),
            F.col(f"{part}_Description").alias(f"{part}Name"),
            F.col(f"{part}_ExtraDescription").alias(f"{part}Description"),
            F.col(f"{part}_material_number").alias(f"{material_name}PartNumber"),
            F.col(f"{part}_material_text").alias(f"{material_name}Description"),
            F.col(f"{part}_material_quantity").alias(f"{material_name}PartQuantity"),
        ]

    flag = differs(F.col("MainPart_material_quantity"), F.col("CoordinatedPart_material_quantity"))
    return joined.select(*columns(*main), *columns(*other), flag.alias("IsDifferent"))


def sibling_flags(catalog: Catalog, prefix: str = RAW) -> DataFrame:
    """Per coordinated part: whether any sibling's main material quantity differs from its own.

    Lowest and highest quantity of the holder decide it, so the work is linear in the parts.
    """
    members = catalog.table("CoordinatedPart").join(
        main_material(catalog, prefix), F.col("PartId") == F.col("made_part"), "left"
    )
    ends = members.groupBy("CoordinatedPartHolderId").agg(
        F.min("material_quantity").alias("lowest"), F.max("material_quantity").alias("highest")
    )
    own = F.col("material_quantity")
    flag = F.when((own != F.col("lowest")) | (own != F.col("highest")), 1).otherwise(0)
    return (
        members.join(ends, "CoordinatedPartHolderId")
        .join(_texts(catalog, "MainPart"), F.col("PartId") == F.col("MainPart_Id"), "left")
        .select(
            F.col("CoordinatedPartHolderId").alias("HolderId"),
            F.col("MainPart_Id").alias("MainPartId"),
            F.col("MainPart_PartNumber").alias("MainPartNumber"),
            own.alias("MainMaterialPartQuantity"),
            flag.alias("IsDifferent"),
        )
    )
