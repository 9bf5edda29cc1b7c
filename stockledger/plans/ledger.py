"""General ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.dates import in_year
from stockledger.functions.text import concat_text
from stockledger.operators.aggs import contra_accounts
from stockledger.operators.scan import EvenCells, running_total
from stockledger.operators.stage import staged
from stockledger.sources.catalog import Catalog


def _years(catalog: Catalog, year) -> DataFrame:
    """The accounting year asked for; without one, the current year (status 0)."""
    years = catalog.aliased("AccountingYear", "AY")
    if year in (None, ""):
        return years.filter("AY_Status = 0")
    return years.filter(F.col("AY_Description") == str(year))


def opening_balance(catalog: Catalog, year=None) -> DataFrame:
    """Per account: debit less credit of the opening balances of the year's balances."""
    periods = catalog.table("AccountingYearPeriod")
    if year in (None, ""):
        current = _years(catalog, year).select(F.col("AY_Id").alias("AccountingYearId"))
        opened = periods.join(current, "AccountingYearId", "left_semi")
    else:
        opened = periods.filter(in_year(F.col("FromDate"), int(year), catalog.zone))
    balances = catalog.table("Balance").join(opened, "AccountingYearId", "left_semi")
    openings = catalog.table("OpeningBalance").withColumnRenamed("Id", "OpeningBalanceId")
    amount = F.col("DebitInCompanyCurrency") - F.col("CreditInCompanyCurrency")
    return (
        balances.join(openings, "OpeningBalanceId", "left")
        .groupBy("AccountId")
        .agg(F.coalesce(F.sum(amount), F.lit(0)).alias("OpeningBalance"))
    )


def general_ledger(catalog: Catalog, year=None, currency: str = "IDR") -> DataFrame:
    """One row per voucher and account of a year, with contra accounts, opening, running
    difference and closing balance.

    Vouchers count in the order of their dates and, within one point in time, of their ids.
    """
    years = _years(catalog, year)
    vouchers = (
        catalog.aliased("Voucher", "V")
        .filter("V_IsPreliminary = 0")
        .join(years, F.col("V_AccountingYearId") == F.col("AY_Id"))
        .join(catalog.aliased("VoucherSeries", "VS"), F.col("V_SeriesId") == F.col("VS_Id"))
    )

    # The year's rows only, and of them one row per voucher and balance before anything else is
    # joined: a voucher of any size is then no larger than the chart of accounts.
    per_balance = (
        catalog.aliased("VoucherRow", "VR")
        .join(vouchers.select("V_Id"), F.col("VR_VoucherId") == F.col("V_Id"), "left_semi")
        .groupBy("VR_VoucherId", "VR_BalanceId")
        .agg(
            F.sum("VR_DebitInCompanyCurrency").alias("debit_amount"),
            F.sum("VR_CreditInCompanyCurrency").alias("credit_amount"),
            F.max("VR_Debit").alias("debit"),
            F.max("VR_Credit").alias("credit"),
        )
    )
    # Read more than once below.
    per_account = staged(
        per_balance.join(catalog.aliased("Balance", "B", "Id", "AccountId"), F.col("VR_BalanceId") == F.col("B_Id"))
        .groupBy("VR_VoucherId", "B_AccountId")
        .agg(
            F.sum("debit_amount").alias("DebitInCompanyCurrency"),
            F.sum("credit_amount").alias("CreditInCompanyCurrency"),
            F.max("debit").alias("debit"),
            F.max("credit").alias("credit"),
        ),
        catalog.workdir,
    )
    accounts = catalog.aliased("Account", "A")
    booked = contra_accounts(
        per_account.join(accounts, F.col("B_AccountId") == F.col("A_Id"), "left"),
        "VR_VoucherId",
        "A_Number",
        "debit",
        "credit",
    )
    headers = (
        vouchers.join(
            catalog.aliased("AccountsReceivableLedger", "ARL"), F.col("V_AccountsReceivableLedgerId") == F.col("ARL_Id"), "left"
        )
        .join(catalog.aliased("AccountsPayableLedger", "APL"), F.col("V_AccountsPayableLedgerId") == F.col("APL_Id"), "left")
        .join(catalog.aliased("AccountsReceivable", "AR"), F.col("V_AccountsReceivableId") == F.col("AR_Id"), "left")
        .join(catalog.aliased("Customer", "C"), F.col("AR_BusinessContactId") == F.col("C_Id"), "left")
        .join(catalog.aliased("CustomerRoot", "CR"), F.col("C_RootId") == F.col("CR_Id"), "left")
        .select(
            "V_Id", "V_VoucherDate", "V_Text", "V_Number", "VS_Series", "AY_Id", "ARL_Number", "APL_Number",
            "AR_InvoiceNumber", "AR_ChineseVatInvoiceNumber", "C_Alias", "CR_Name",
        )
    )
    difference = F.col("DebitInCompanyCurrency") - F.col("CreditInCompanyCurrency")
    entries = headers.join(booked, F.col("V_Id") == F.col("VR_VoucherId"), "left").withColumn(
        "DifferenceInCompanyCurrency", difference
    )
    # Where the rows of an account are many, their counts and totals come first; they need no texts.
    amounts = (
        vouchers.select("V_Id", "V_VoucherDate")
        .join(per_account, F.col("V_Id") == F.col("VR_VoucherId"), "left")
        .join(accounts.select("A_Id"), F.col("B_AccountId") == F.col("A_Id"), "left")
        .select("V_Id", "V_VoucherDate", "A_Id", difference.alias("DifferenceInCompanyCurrency"))
    )
    running = running_total(
        entries,
        ["A_Id"],
        ["V_VoucherDate", "V_Id"],
        "DifferenceInCompanyCurrency",
        "CumulativeTotalDifference",
        cells=EvenCells(),
        basis=amounts,
    )
    opening = opening_balance(catalog, year).withColumnRenamed("AccountId", "opening_account")
    names = (
        catalog.aliased("AccountYearSetting", "AYS")
        .join(years.select("AY_Id"), F.col("AYS_AccountingYearId") == F.col("AY_Id"), "left_semi")
        .join(catalog.aliased("DynamicPhrase", "DP"), F.col("AYS_DescriptionId") == F.col("DP_Id"), "left")
        .select("AYS_AccountingYearId", "AYS_ParentId", F.col("DP_Text").alias("AccountName"))
    )
    joined = (
        running.join(
            names, (F.col("AYS_ParentId") == F.col("A_Id")) & (F.col("AYS_AccountingYearId") == F.col("AY_Id")), "left"
        )
        .join(opening, F.col("opening_account") == F.col("A_Id"), "left")
        .withColumn("OpeningBalance", F.coalesce("OpeningBalance", F.lit(0)))
    )
    return joined.select(
        F.col("ARL_Number").alias("AccountsReceiveableJournalNumber"),
        F.col("APL_Number").alias("AccountsPayableJournalNumber"),
        F.col("V_VoucherDate").alias("VoucherDate"),
        F.col("V_Text").alias("VoucherText"),
        F.col("AR_InvoiceNumber").alias("InvoiceNumber"),
        F.col("AR_ChineseVatInvoiceNumber").alias("EFakturNumber"),
        F.col("V_Number").alias("VoucherNumber"),
        concat_text(F.col("VS_Series"), "-", F.col("V_Number")).alias("VoucherDescriptionNumber"),
        F.col("A_Number").alias("AccountNumber"),
        "AccountName",
        F.when(F.col("DebitInCompanyCurrency") > 0, F.col("credit_accounts"))
        .when(F.col("CreditInCompanyCurrency") > 0, F.col("debit_accounts"))
        .alias("ContraAccountNumbers"),
        F.col("C_Alias").alias("CustomerCode"),
        F.col("CR_Name").alias("CustomerName"),
        F.lit(currency).alias("CompanyCurrency"),
        "OpeningBalance",
        "DebitInCompanyCurrency",
        "CreditInCompanyCurrency",
        "DifferenceInCompanyCurrency",
        "CumulativeTotalDifference",
        (F.col("OpeningBalance") + F.col("CumulativeTotalDifference")).alias("ClosingBalance"),
    )
