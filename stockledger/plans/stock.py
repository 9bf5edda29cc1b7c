"""Stock roll-forward and month-end stock value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import as_date, as_timestamp, date_fmt, day_of, day_start, in_days, in_year, month_of, title_month
from stockledger.functions.numbers import to_unit
from stockledger.operators.aggs import pivot_measures, signed_sums, sum_by_group
from stockledger.operators.joins import attribute_lookup, salted_join
from stockledger.operators.temporal import asof_join, latest_per_group
from stockledger.sources.catalog import Catalog

# Codes of the source system.
COUNT_CODE = 4
FINISHED = 9
STANDARD_PRICE = 0
PART_CLASS = "6b6b98da-21a0-4ca4-9b88-21631c6ea572"
JOB_NUMBER_TEMPLATE = 1004537098651940025
TRANSACTION_GROUPS = {
    "ArrivalBalance": [1, 18],
    "ReportedManufacturedBalance": [2, 17],
    "DeliveryBalance": [3, 19],
    "MaterialWithdrawalBalance": [11, 16],
    "MovementBalance": [6, 7],
    "DirectReportedBalance": [5, 9, 12, 13],
}
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
STAMP = "YYYY-MM-DD HH:MM:SS"

PLACE = ["PartId", "LocationName"]


def _stocked_parts(catalog: Catalog) -> DataFrame:
    """Active parts outside the categories E... and M...; an unknown category counts as outside the report."""
    category = F.col("P_CategoryString")
    return catalog.aliased("Part", "P").filter(
        (F.col("P_Status") != FINISHED) & ~category.startswith("E") & ~category.startswith("M")
    )


def _with_unit(catalog: Catalog, parts: DataFrame, check_part: bool) -> DataFrame:
    """Adds the conversion factor and the unit text of a part."""
    usage = catalog.aliased("PartUnitUsage", "PUU")
    same = F.col("PUU_Id") == F.col("P_StandardPartUnitUsageId")
    if check_part:
        same = same & (F.col("PUU_PartId") == F.col("P_Id"))
    units = (
        catalog.aliased("Unit", "U")
        .join(catalog.aliased("DynamicPhrase", "UDP"), F.col("UDP_Id") == F.col("U_CodeId"), "left")
        .select("U_Id", F.col("UDP_Text").alias("UnitName"))
    )
    return parts.join(usage, same, "left").join(units, F.col("U_Id") == F.col("PUU_UnitId"), "left")


def _last_counts(movement: DataFrame, prefix: str) -> DataFrame:
    """Last recorded stock count per place among these movements."""
    counts = movement.filter(F.col("BusinessTransactionContextType") == COUNT_CODE)
    latest = latest_per_group(counts, PLACE, [F.col("LoggingTimeStamp").desc(), F.col("Id").desc()])
    return latest.select(
        *PLACE,
        F.col("PhysicalInventoryBalance").alias(f"{prefix}_balance"),
        F.col("LoggingTimeStamp").alias(f"{prefix}_logged"),
        F.col("DeliveryDate").alias(f"{prefix}_date"),
    )


def stock_rollforward(
    catalog: Catalog,
    start,
    end,
    cutoff: bool = True,
    variant: str = "cte",
    warehouse: int = 1,
    currency: str = "IDR",
) -> DataFrame:
    """Stock per part and location over a period: opening count, back-dated and ordinary receipts
    and issues, computed end stock against the counted one.

    Back-dated movements were recorded after the opening count but took effect before the period.

    The three variants differ on purpose, as the reports they stand for do:

    ``cte``    opening count from the week up to the start, end count on the end day, movements
               recorded up to that count if ``cutoff`` is set (else up to the end), values in the
               part's unit, price, and sums per transaction group;
    ``join``   opening count on the day before the start, end count at the end date, movements up
               to the end count or else the end; no opening count leaves the end stock unknown;
    ``apply``  as ``join``, but without an end count no movement counts, and the counted end stock
               then shows the computed one.

    ``start`` and ``end`` are dates or times; effective dates of movements are compared with them
    directly.
    """
    if variant not in ("cte", "join", "apply"):
        raise ValueError("variant is 'cte', 'join' or 'apply'")
    zone = catalog.zone
    first, last = as_timestamp(start, zone), as_timestamp(end, zone)
    last_day = day_start(as_date(last, zone), zone)
    effective, logged = F.col("DeliveryDate"), F.col("LoggingTimeStamp")

    def movement(low: Column | None, high: Column) -> DataFrame:
        return catalog.between("InventoryMovement", "DeliveryDate", low, high)

    if variant == "cte":
        opening = _last_counts(movement(first - F.expr("interval 7 days"), first), "opening")
        next_day = day_start(F.date_add(as_date(last_day, zone), 1), zone)
        ending = _last_counts(movement(last_day, next_day).filter(in_days(effective, last_day, last_day, zone)), "end")
        upper = last_day
    else:
        day_before = first - F.expr("interval 1 day")
        opening = _last_counts(movement(day_before, day_before), "opening")
        ending = _last_counts(movement(last, last), "end")
        upper = last

    change, code = F.col("BalanceChange"), F.col("BusinessTransactionContextType")
    # Back-dated movements were recorded after the earliest of the opening counts, which keeps the
    # older history out of the shuffle. One count per place, so a movement meets at most one row.
    earliest = opening.select(F.min("opening_logged")).scalar()
    late = movement(None, first).filter((code != COUNT_CODE) & (effective < first) & (logged >= earliest)).select(
        "Id", *PLACE, "BalanceChange", "LoggingTimeStamp"
    )
    back_dated = (
        salted_join(late, opening.select(*PLACE, "opening_logged"), PLACE, "Id")
        .filter(logged >= F.col("opening_logged"))
        .groupBy(*PLACE)
        .agg(*signed_sums(change, "BackDateReceiptBalance", "BackDateIssueBalance"))
    )

    # The places with any movement in the period and the sums of those that count, in one pass.
    in_period = movement(first, upper).select(
        "Id", *PLACE, "BusinessTransactionContextType", "BalanceChange", "LoggingTimeStamp", "WarehouseId"
    )
    if variant == "cte" and not cutoff:
        limit = last
    else:
        in_period = salted_join(in_period, ending.select(*PLACE, "end_logged"), PLACE, "Id", "left")
        limit = F.col("end_logged")
        if variant != "apply":
            limit = F.coalesce(limit, upper)
    counted = F.when((code != COUNT_CODE) & (logged <= limit), change)
    groups = sum_by_group(counted, code, TRANSACTION_GROUPS) if variant == "cte" else []
    places = (
        in_period.groupBy(*PLACE)
        .agg(
            *signed_sums(counted, "ReceiptBalance", "IssueBalance"),
            *groups,
            F.max(F.col("WarehouseId") == warehouse).alias("in_warehouse"),
        )
        .filter("in_warehouse")
    )
    for side in (opening, ending, back_dated):
        places = places.join(side, PLACE, "left")
    parts = _with_unit(catalog, _stocked_parts(catalog), check_part=variant == "cte")
    attributes = catalog.table("ExtraField").filter(F.col("ParentClass") == PART_CLASS)
    parts = attribute_lookup(
        parts, attributes, "P_Id", "ParentId", "TemplateId", "String", {"JobNumber": JOB_NUMBER_TEMPLATE}
    )
    stock = places.join(parts, F.col("PartId") == F.col("P_Id"))
    if variant == "cte":
        prices = (
            catalog.table("PriceChangeLog")
            .filter((F.col("PriceType") == STANDARD_PRICE) & (F.col("Timestamp") < last_day + F.expr("interval 1 day")))
            .groupBy("PartId")
            .agg(F.max(F.struct("Timestamp", "NewPrice"))["NewPrice"].alias("price"))
        )
        return _in_units(stock.join(prices, "PartId", "left"), currency, zone)
    return _in_stock_units(stock, variant, zone)


def _in_units(stock: DataFrame, currency: str, zone: str | None) -> DataFrame:
    factor = F.col("PUU_ConversionFactor")
    counted = F.col("end_logged").isNotNull()
    balance, price = F.coalesce("end_balance", F.lit(0)), F.coalesce("price", F.lit(0))

    def or_zero(column):
        return F.coalesce(F.col(column), F.lit(0))

    # A place with no opening count has no back-dated sums; one without movements has sums of 0.
    seen = F.col("opening_logged").isNotNull()
    back_dated = {
        c: to_unit(F.when(seen, or_zero(c)), factor) for c in ("BackDateReceiptBalance", "BackDateIssueBalance")
    }
    sums = {c: to_unit(or_zero(c), factor) for c in ("ReceiptBalance", "IssueBalance", *TRANSACTION_GROUPS)}
    stock = (
        stock.withColumns(
            {
                "OpeningStock": to_unit(F.col("opening_balance"), factor),
                **back_dated,
                **sums,
                "ActualEndStock": to_unit(balance, factor),
                "StandardPrice": to_unit(F.when(counted, price), factor, "multiply"),
                "Amount": to_unit(F.when(counted, balance * price), factor, "multiply"),
            }
        )
        .withColumn(
            "EndStock",
            F.coalesce("OpeningStock", F.lit(0.0))
            + F.coalesce("BackDateReceiptBalance", F.lit(0.0))
            + F.coalesce("BackDateIssueBalance", F.lit(0.0))
            + F.col("ReceiptBalance")
            + F.col("IssueBalance"),
        )
        .withColumn("AdjustmentBalance", F.col("ActualEndStock") - F.col("EndStock"))
    )
    return stock.select(
        *_part_columns(),
        "OpeningStock",
        date_fmt(F.col("opening_logged"), STAMP, zone).alias("OpeningStockCountLoggingDate"),
        date_fmt(F.col("opening_date"), STAMP, zone).alias("OpeningStockCountDate"),
        "BackDateReceiptBalance",
        "BackDateIssueBalance",
        *sums,
        "EndStock",
        "ActualEndStock",
        "AdjustmentBalance",
        F.lit(currency).alias("Currency"),
        "StandardPrice",
        "Amount",
        date_fmt(F.col("end_logged"), STAMP, zone).alias("EndStockCountLoggingDate"),
        date_fmt(F.col("end_date"), STAMP, zone).alias("EndStockCountDate"),
        "UnitName",
    )


def _in_stock_units(stock: DataFrame, variant: str, zone: str | None) -> DataFrame:
    sums = ("BackDateReceiptBalance", "BackDateIssueBalance", "ReceiptBalance", "IssueBalance")
    stock = stock.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in sums})
    end_stock = F.col("opening_balance")
    for c in sums:
        end_stock = end_stock + F.col(c)
    stock = stock.withColumn("EndStock", end_stock)
    fallback = F.lit(0) if variant == "join" else F.col("EndStock")
    return stock.select(
        *_part_columns(),
        F.col("opening_balance").alias("OpeningStock"),
        date_fmt(F.col("opening_logged"), STAMP, zone).alias("OpeningStockCountLoggingDate"),
        date_fmt(F.col("opening_date"), STAMP, zone).alias("OpeningStockCountDate"),
        *sums,
        "EndStock",
        (F.coalesce("end_balance", "EndStock") - F.col("EndStock")).alias("AdjustmentBalance"),
        F.coalesce(F.col("end_balance"), fallback).alias("ActualEndStock"),
        date_fmt(F.col("end_logged"), STAMP, zone).alias("EndStockCountLoggingDate"),
        date_fmt(F.col("end_date"), STAMP, zone).alias("EndStockCountDate"),
        "UnitName",
    )


def _part_columns() -> list[Column]:
    return [
        F.col("P_PartNumber").alias("PartNumber"),
        F.col("P_Description").alias("PartName"),
        F.col("P_ExtraDescription").alias("PartDescription"),
        F.col("JobNumber"),
        F.col("LocationName"),
    ]


def _month_end_counts(catalog: Catalog, year: int, warehouse: int) -> DataFrame:
    """Last count of every part, location and month of the year, with the price of its day.

    Only months with a count in the warehouse are reported. That test rides along in the same
    aggregate, so the counts are shuffled once.
    """
    zone = catalog.zone
    turns = [as_timestamp(f"{y}-01-01", zone) for y in (year, year + 1)]
    counts = catalog.between("InventoryMovement", "DeliveryDate", *turns).filter(
        (F.col("BusinessTransactionContextType") == COUNT_CODE) & in_year(F.col("DeliveryDate"), year, zone)
    )
    last = F.max(F.struct("DeliveryDate", "LoggingTimeStamp", "Id", "PhysicalInventoryBalance"))
    month_end = (
        counts.withColumn("month", month_of(F.col("DeliveryDate"), catalog.zone))
        .groupBy(*PLACE, "month")
        .agg(last.alias("last"), F.max(F.col("WarehouseId") == warehouse).alias("in_warehouse"))
        .filter("in_warehouse")
        .select(
            *PLACE,
            title_month(day_of(F.col("last.DeliveryDate"), catalog.zone)).alias("month"),
            day_of(F.col("last.DeliveryDate"), catalog.zone).alias("day"),
            F.col("last.PhysicalInventoryBalance").alias("balance"),
        )
    )
    prices = (
        catalog.table("PriceChangeLog")
        .filter(F.col("PriceType") == STANDARD_PRICE)
        .select("PartId", "Timestamp", "NewPrice", day_of(F.col("Timestamp"), catalog.zone).alias("price_day"))
    )
    priced = asof_join(month_end, prices, ["PartId"], "day", "price_day", ["NewPrice"], tie=["Timestamp"], dedupe=False)
    return priced.withColumn("price", F.coalesce("NewPrice", F.lit(0))).withColumn(
        "amount", F.coalesce("balance", F.lit(0)) * F.col("price")
    )


def _valued_parts(catalog: Catalog, excluded_group: str) -> DataFrame:
    groups = catalog.aliased("ProductGroup", "PG").filter(~F.col("PG_Number").eqNullSafe(excluded_group))
    return (
        _stocked_parts(catalog)
        .filter(F.col("P_Type").isin(0, 1))
        .join(groups, F.col("P_ProductGroupId") == F.col("PG_Id"), "left_semi")
    )


def stock_value_month(catalog: Catalog, year: int, warehouse: int = 1, excluded_group: str = "024") -> DataFrame:
    """Counted stock and its value at the end of every month, months as columns.

    Months without a count show 0.
    """
    counts = _month_end_counts(catalog, int(year), warehouse)
    parts = _valued_parts(catalog, excluded_group)
    return pivot_measures(
        counts.join(parts, F.col("PartId") == F.col("P_Id")).withColumnRenamed("P_PartNumber", "PartNumber"),
        ["PartNumber", "LocationName"],
        "month",
        MONTHS,
        {"stocks": F.col("balance"), "amounts": F.col("amount")},
    ).orderBy("PartNumber")


def stock_value_month_case(
    catalog: Catalog, year: int, warehouse: int = 1, excluded_group: str = "024", currency: str = "IDR", scale_amount: bool = True
) -> DataFrame:
    """As ``stock_value_month``, in the part's unit, with the price and the part's texts.

    The amount is stock times price and needs no conversion, but the report this stands for
    multiplies it by the factor; ``scale_amount=False`` leaves that out.
    """
    counts = _month_end_counts(catalog, int(year), warehouse)
    parts = _with_unit(catalog, _valued_parts(catalog, excluded_group), check_part=True)
    factor = F.col("PUU_ConversionFactor")
    amount = F.col("amount")
    wide = pivot_measures(
        counts.join(parts, F.col("PartId") == F.col("P_Id")),
        ["P_PartNumber", "P_Description", "P_ExtraDescription", "LocationName", "UnitName"],
        "month",
        MONTHS,
        {
            "Stocks": to_unit(F.col("balance"), factor),
            "StandardPrice": to_unit(F.col("price"), factor, "multiply"),
            "Amounts": to_unit(amount, factor, "multiply") if scale_amount else amount.cast("double"),
        },
        fill=0.0,
    )
    return wide.select(
        F.col("P_PartNumber").alias("PartNumber"),
        F.col("P_Description").alias("Description"),
        F.col("P_ExtraDescription").alias("ExtraDescription"),
        "LocationName",
        "UnitName",
        F.lit(currency).alias("Currency"),
        *[F.col(f"{m}_{n}").alias(f"{m}{n}") for m in MONTHS for n in ("Stocks", "StandardPrice", "Amounts")],
    ).orderBy("PartNumber", "LocationName")
