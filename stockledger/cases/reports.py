"""The reports over the demo binding of the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockledger.cases.registry import case
from stockledger.operators import temporal
from stockledger.plans import documents, forecast, ledger, materials, movements, orders, planning, stock
from stockledger.sources.demo import demo_catalog, role

# --- general ledger ------------------------------------------------------------------------

# Dates of the test tables are midnight in UTC, so west of it they fall on the day, and month, before.
_WEST, _WEST_SQL = "-05:00", "- interval 5 hour"

_OPENING = """
select b.AccountId, coalesce(sum(ob.DebitInCompanyCurrency - ob.CreditInCompanyCurrency), 0) as OpeningBalance
from t_Balance b left join t_OpeningBalance ob on ob.Id = b.OpeningBalanceId
where b.AccountingYearId in (select AccountingYearId from t_AccountingYearPeriod where year(FromDate) = {year})
group by b.AccountId"""


@case("i:AccountId n:OpeningBalance", _OPENING.format(year=1998))
def opening_balance(spark, sf_dir):
    return ledger.opening_balance(demo_catalog(spark, sf_dir), 1998)


_LEDGER_COLUMNS = (
    "s:AccountsReceiveableJournalNumber s:AccountsPayableJournalNumber t:VoucherDate s:VoucherText s:InvoiceNumber "
    "s:EFakturNumber s:VoucherNumber s:VoucherDescriptionNumber s:AccountNumber s:AccountName s:ContraAccountNumbers "
    "s:CustomerCode s:CustomerName s:CompanyCurrency n:OpeningBalance n:DebitInCompanyCurrency n:CreditInCompanyCurrency "
    "n:DifferenceInCompanyCurrency n:CumulativeTotalDifference n:ClosingBalance"
)

_LEDGER = """
with chosen as (select * from t_Voucher where IsPreliminary = 0 and AccountingYearId in (select Id from t_AccountingYear where {which})),
booked as (select r.*, b.AccountId, a.Number from t_VoucherRow r join t_Balance b on b.Id = r.BalanceId left join t_Account a on a.Id = b.AccountId),
summed as (select VoucherId, AccountId, sum(DebitInCompanyCurrency) as deb, sum(CreditInCompanyCurrency) as cre from booked group by all),
credits as (select VoucherId, string_agg(distinct Number, ', ' order by Number) as names from booked where Credit > 0 group by all),
debits as (select VoucherId, string_agg(distinct Number, ', ' order by Number) as names from booked where Debit > 0 group by all),
opening as (__OPENING__),
lines as (
  select v.*, a.Id as account, a.Number as account_number, s.deb, s.cre, s.deb - s.cre as diff,
    sum(s.deb - s.cre) over (partition by a.Id order by v.VoucherDate, v.Id rows unbounded preceding) as run
  from chosen v left join summed s on s.VoucherId = v.Id left join t_Account a on a.Id = s.AccountId)
select arl.Number as AccountsReceiveableJournalNumber, apl.Number as AccountsPayableJournalNumber, l.VoucherDate, l.Text as VoucherText,
  ar.InvoiceNumber, ar.ChineseVatInvoiceNumber as EFakturNumber, l.Number as VoucherNumber,
  concat(vs.Series, '-', l.Number) as VoucherDescriptionNumber, l.account_number as AccountNumber, dp.Text as AccountName,
  case when l.deb > 0 then credits.names when l.cre > 0 then debits.names end as ContraAccountNumbers, c.Alias as CustomerCode,
  cr.Name as CustomerName, 'IDR' as CompanyCurrency, coalesce(o.OpeningBalance, 0) as OpeningBalance,
  l.deb as DebitInCompanyCurrency, l.cre as CreditInCompanyCurrency, l.diff as DifferenceInCompanyCurrency,
  l.run as CumulativeTotalDifference, coalesce(o.OpeningBalance, 0) + l.run as ClosingBalance
from lines l join t_VoucherSeries vs on vs.Id = l.SeriesId
left join credits on credits.VoucherId = l.Id left join debits on debits.VoucherId = l.Id
left join opening o on o.AccountId = l.account
left join t_AccountYearSetting ays on ays.AccountingYearId = l.AccountingYearId and ays.ParentId = l.account
left join t_DynamicPhrase dp on dp.Id = ays.DescriptionId
left join t_AccountsReceivableLedger arl on arl.Id = l.AccountsReceivableLedgerId
left join t_AccountsPayableLedger apl on apl.Id = l.AccountsPayableLedgerId
left join t_AccountsReceivable ar on ar.Id = l.AccountsReceivableId
left join t_Customer c on c.Id = ar.BusinessContactId left join t_CustomerRoot cr on cr.Id = c.RootId"""


@case(_LEDGER_COLUMNS, _LEDGER.replace("__OPENING__", _OPENING.format(year=1998)).format(which="Description = '1998'"))
def general_ledger(spark, sf_dir):
    return ledger.general_ledger(demo_catalog(spark, sf_dir), 1998)


@case(_LEDGER_COLUMNS, _LEDGER.replace("__OPENING__", _OPENING.format(year=2001)).format(which="Status = 0"))
def general_ledger_current(spark, sf_dir):
    return ledger.general_ledger(demo_catalog(spark, sf_dir))


# --- stock ---------------------------------------------------------------------------------

_UNITS = """
units as (select u.Id as unit_id, dp.Text as unit_name from t_Unit u left join t_DynamicPhrase dp on dp.Id = u.CodeId),
stocked as (
  select p.*, e.String as job, puu.ConversionFactor as factor, units.unit_name
  from t_Part p
  left join t_PartUnitUsage puu on puu.Id = p.StandardPartUnitUsageId {same_part}
  left join units on unit_id = puu.UnitId
  left join t_ExtraField e on e.ParentId = p.Id and e.TemplateId = 1004537098651940025 and e.String is not null
    and e.ParentClass = '6b6b98da-21a0-4ca4-9b88-21631c6ea572'
  where p.Status <> 9 and p.CategoryString not like 'E%' and p.CategoryString not like 'M%')"""

_ROLL_CTE = """
with __UNITS__,
mv as (select * from t_InventoryMovement),
opening as (
  select * from mv where BusinessTransactionContextType = 4
    and DeliveryDate between timestamp '2024-01-10' - interval 7 day and timestamp '2024-01-10'
  qualify row_number() over (partition by PartId, LocationName order by LoggingTimeStamp desc, Id desc) = 1),
ending as (
  select * from mv where BusinessTransactionContextType = 4 and strftime(DeliveryDate, '%Y-%m-%d') = '2024-01-20'
  qualify row_number() over (partition by PartId, LocationName order by LoggingTimeStamp desc, Id desc) = 1),
prices as (
  select PartId, NewPrice from t_PriceChangeLog where PriceType = 0 and Timestamp < timestamp '2024-01-21'
  qualify row_number() over (partition by PartId order by Timestamp desc, NewPrice desc) = 1),
places as (
  select distinct PartId, LocationName from mv
  where WarehouseId = 1 and DeliveryDate between timestamp '2024-01-10' and timestamp '2024-01-20'),
joined as (
  select p.PartNumber, p.Description as PartName, p.ExtraDescription as PartDescription, p.job as JobNumber, d.LocationName, p.unit_name,
    coalesce(cast(p.factor as double), 1) as f, o.Id as oid, o.PhysicalInventoryBalance as ob, o.LoggingTimeStamp as ol, o.DeliveryDate as od,
    e.Id as eid, e.PhysicalInventoryBalance as eb, e.LoggingTimeStamp as el, e.DeliveryDate as ed, coalesce(pr.NewPrice, 0) as price,
    d.PartId,
    (select sum(case when m.BalanceChange > 0 then m.BalanceChange else 0 end) from mv m where m.PartId = d.PartId
      and m.LocationName = d.LocationName and m.BusinessTransactionContextType <> 4 and m.DeliveryDate < timestamp '2024-01-10'
      and m.LoggingTimeStamp >= o.LoggingTimeStamp) as br,
    (select sum(case when m.BalanceChange < 0 then m.BalanceChange else 0 end) from mv m where m.PartId = d.PartId
      and m.LocationName = d.LocationName and m.BusinessTransactionContextType <> 4 and m.DeliveryDate < timestamp '2024-01-10'
      and m.LoggingTimeStamp >= o.LoggingTimeStamp) as bi
  from places d join stocked p on p.Id = d.PartId
  left join opening o on o.PartId = d.PartId and o.LocationName = d.LocationName
  left join ending e on e.PartId = d.PartId and e.LocationName = d.LocationName
  left join prices pr on pr.PartId = d.PartId),
sums as (
  select j.PartId, j.LocationName,
    sum(case when m.BalanceChange > 0 then m.BalanceChange else 0 end) as r, sum(case when m.BalanceChange < 0 then m.BalanceChange else 0 end) as i,
    sum(case when m.BusinessTransactionContextType in (1, 18) then m.BalanceChange else 0 end) as g1,
    sum(case when m.BusinessTransactionContextType in (2, 17) then m.BalanceChange else 0 end) as g2,
    sum(case when m.BusinessTransactionContextType in (3, 19) then m.BalanceChange else 0 end) as g3,
    sum(case when m.BusinessTransactionContextType in (11, 16) then m.BalanceChange else 0 end) as g4,
    sum(case when m.BusinessTransactionContextType in (6, 7) then m.BalanceChange else 0 end) as g5,
    sum(case when m.BusinessTransactionContextType in (5, 9, 12, 13) then m.BalanceChange else 0 end) as g6
  from joined j join mv m on m.PartId = j.PartId and m.LocationName = j.LocationName and m.BusinessTransactionContextType <> 4
    and m.DeliveryDate between timestamp '2024-01-10' and timestamp '2024-01-20'
    and m.LoggingTimeStamp <= __LIMIT__
  group by j.PartId, j.LocationName),
units_of as (
  select j.*, cast(ob as double) / f as OpeningStock,
    case when oid is not null then cast(coalesce(br, 0) as double) / f end as BackDateReceiptBalance,
    case when oid is not null then cast(coalesce(bi, 0) as double) / f end as BackDateIssueBalance,
    cast(coalesce(r, 0) as double) / f as ReceiptBalance, cast(coalesce(i, 0) as double) / f as IssueBalance,
    cast(coalesce(g1, 0) as double) / f as ArrivalBalance, cast(coalesce(g2, 0) as double) / f as ReportedManufacturedBalance,
    cast(coalesce(g3, 0) as double) / f as DeliveryBalance, cast(coalesce(g4, 0) as double) / f as MaterialWithdrawalBalance,
    cast(coalesce(g5, 0) as double) / f as MovementBalance, cast(coalesce(g6, 0) as double) / f as DirectReportedBalance,
    cast(coalesce(eb, 0) as double) / f as ActualEndStock
  from joined j left join sums s on s.PartId = j.PartId and s.LocationName = j.LocationName),
ended as (
  select *, coalesce(OpeningStock, 0) + coalesce(BackDateReceiptBalance, 0) + coalesce(BackDateIssueBalance, 0) + ReceiptBalance + IssueBalance
    as EndStock from units_of)
select *, strftime(ol, '%Y-%m-%d %H:%M:%S') as OpeningStockCountLoggingDate, strftime(od, '%Y-%m-%d %H:%M:%S') as OpeningStockCountDate,
  ActualEndStock - EndStock as AdjustmentBalance, 'IDR' as Currency,
  case when eid is not null then cast(price as double) * f end as StandardPrice,
  case when eid is not null then cast(coalesce(eb, 0) * price as double) * f end as Amount,
  strftime(el, '%Y-%m-%d %H:%M:%S') as EndStockCountLoggingDate, strftime(ed, '%Y-%m-%d %H:%M:%S') as EndStockCountDate, unit_name as UnitName
from ended""".replace("__UNITS__", _UNITS.format(same_part="and puu.PartId = p.Id"))

_ROLL_COLUMNS = (
    "s:PartNumber s:PartName s:PartDescription s:JobNumber s:LocationName n:OpeningStock s:OpeningStockCountLoggingDate "
    "s:OpeningStockCountDate n:BackDateReceiptBalance n:BackDateIssueBalance n:ReceiptBalance n:IssueBalance {more}"
    "n:EndStock n:ActualEndStock n:AdjustmentBalance s:EndStockCountLoggingDate s:EndStockCountDate s:UnitName"
)
_ROLL_CTE_COLUMNS = _ROLL_COLUMNS.format(
    more="n:ArrivalBalance n:ReportedManufacturedBalance n:DeliveryBalance n:MaterialWithdrawalBalance n:MovementBalance "
    "n:DirectReportedBalance s:Currency n:StandardPrice n:Amount "
)


@case(
    _ROLL_CTE_COLUMNS,
    _ROLL_CTE.replace("__LIMIT__", "coalesce(j.el, timestamp '2024-01-20')"),
)
def stock_rollforward(spark, sf_dir):
    return stock.stock_rollforward(demo_catalog(spark, sf_dir), "2024-01-10", "2024-01-20")


@case(
    _ROLL_CTE_COLUMNS,
    _ROLL_CTE.replace("__LIMIT__", "timestamp '2024-01-20'"),
)
def stock_rollforward_no_cutoff(spark, sf_dir):
    return stock.stock_rollforward(demo_catalog(spark, sf_dir), "2024-01-10", "2024-01-20", cutoff=False)


_ROLL_JOIN = """
with __UNITS__,
mv as (select * from t_InventoryMovement),
opening as (
  select * from mv where BusinessTransactionContextType = 4 and DeliveryDate = timestamp '2024-01-09'
  qualify row_number() over (partition by PartId, LocationName order by LoggingTimeStamp desc, Id desc) = 1),
ending as (
  select * from mv where BusinessTransactionContextType = 4 and DeliveryDate = timestamp '2024-01-20'
  qualify row_number() over (partition by PartId, LocationName order by LoggingTimeStamp desc, Id desc) = 1),
joined as (
  select p.PartNumber, p.Description as PartName, p.ExtraDescription as PartDescription, p.job as JobNumber, d.LocationName,
    p.unit_name as UnitName, o.PhysicalInventoryBalance as OpeningStock, strftime(o.LoggingTimeStamp, '%Y-%m-%d %H:%M:%S') as OpeningStockCountLoggingDate,
    strftime(o.DeliveryDate, '%Y-%m-%d %H:%M:%S') as OpeningStockCountDate, e.PhysicalInventoryBalance as eb,
    strftime(e.LoggingTimeStamp, '%Y-%m-%d %H:%M:%S') as EndStockCountLoggingDate, strftime(e.DeliveryDate, '%Y-%m-%d %H:%M:%S') as EndStockCountDate,
    coalesce((select sum(m.BalanceChange) from mv m where m.PartId = d.PartId and m.LocationName = d.LocationName and m.BalanceChange > 0
      and m.BusinessTransactionContextType <> 4 and m.DeliveryDate < timestamp '2024-01-10' and m.LoggingTimeStamp >= o.LoggingTimeStamp), 0)
      as BackDateReceiptBalance,
    coalesce((select sum(m.BalanceChange) from mv m where m.PartId = d.PartId and m.LocationName = d.LocationName and m.BalanceChange < 0
      and m.BusinessTransactionContextType <> 4 and m.DeliveryDate < timestamp '2024-01-10' and m.LoggingTimeStamp >= o.LoggingTimeStamp), 0)
      as BackDateIssueBalance,
    coalesce((select sum(m.BalanceChange) from mv m where m.PartId = d.PartId and m.LocationName = d.LocationName and m.BalanceChange > 0
      and m.BusinessTransactionContextType <> 4 and m.DeliveryDate between timestamp '2024-01-10' and timestamp '2024-01-20'
      and m.LoggingTimeStamp <= __LIMIT__), 0) as ReceiptBalance,
    coalesce((select sum(m.BalanceChange) from mv m where m.PartId = d.PartId and m.LocationName = d.LocationName and m.BalanceChange < 0
      and m.BusinessTransactionContextType <> 4 and m.DeliveryDate between timestamp '2024-01-10' and timestamp '2024-01-20'
      and m.LoggingTimeStamp <= __LIMIT__), 0) as IssueBalance
  from (select distinct PartId, LocationName from mv
        where WarehouseId = 1 and DeliveryDate between timestamp '2024-01-10' and timestamp '2024-01-20') d
  join stocked p on p.Id = d.PartId
  left join opening o on o.PartId = d.PartId and o.LocationName = d.LocationName
  left join ending e on e.PartId = d.PartId and e.LocationName = d.LocationName),
ended as (select *, OpeningStock + BackDateReceiptBalance + BackDateIssueBalance + ReceiptBalance + IssueBalance as EndStock from joined)
select *, coalesce(eb, EndStock) - EndStock as AdjustmentBalance, coalesce(eb, __FALLBACK__) as ActualEndStock
from ended""".replace("__UNITS__", _UNITS.format(same_part=""))


@case(
    _ROLL_COLUMNS.format(more=""),
    _ROLL_JOIN.replace("__LIMIT__", "coalesce(e.LoggingTimeStamp, timestamp '2024-01-20')").replace("__FALLBACK__", "0"),
)
def stock_rollforward_join(spark, sf_dir):
    return stock.stock_rollforward(demo_catalog(spark, sf_dir), "2024-01-10", "2024-01-20", variant="join")


@case(
    _ROLL_COLUMNS.format(more=""),
    _ROLL_JOIN.replace("__LIMIT__", "e.LoggingTimeStamp").replace("__FALLBACK__", "EndStock"),
)
def stock_rollforward_apply(spark, sf_dir):
    return stock.stock_rollforward(demo_catalog(spark, sf_dir), "2024-01-10", "2024-01-20", variant="apply")


_MONTH_END = """
counts as (
  select *, strftime(DeliveryDate, '%b') as m, coalesce((
      select max_by(NewPrice, Timestamp) from t_PriceChangeLog l where l.PartId = c.PartId and l.PriceType = 0
        and l.Timestamp < cast(c.DeliveryDate as date) + interval 1 day), 0) as price
  from t_InventoryMovement c where BusinessTransactionContextType = 4 and WarehouseId = 1 and year(DeliveryDate) = 1997
  qualify row_number() over (partition by PartId, LocationName, month(DeliveryDate) order by DeliveryDate desc, LoggingTimeStamp desc, Id desc) = 1),
valued as (
  select p.* from t_Part p join t_ProductGroup g on g.Id = p.ProductGroupId
  where p.Status <> 9 and p.CategoryString not like 'E%' and p.CategoryString not like 'M%' and p.Type in (0, 1)
    and (g.Number <> '024' or g.Number is null))"""


@case(
    "s:PartNumber s:LocationName " + " ".join(f"n:{m}_stocks n:{m}_amounts" for m in stock.MONTHS),
    f"with {_MONTH_END} select p.PartNumber, c.LocationName, "
    + ", ".join(
        f"coalesce(sum(case when m = '{m}' then c.PhysicalInventoryBalance end), 0) as {m}_stocks, "
        f"coalesce(sum(case when m = '{m}' then c.PhysicalInventoryBalance * c.price end), 0) as {m}_amounts"
        for m in stock.MONTHS
    )
    + " from counts c join valued p on p.Id = c.PartId group by p.PartNumber, c.LocationName",
)
def stock_value_month(spark, sf_dir):
    return stock.stock_value_month(demo_catalog(spark, sf_dir), 1997)


@case(
    "s:PartNumber s:Description s:ExtraDescription s:LocationName s:UnitName s:Currency "
    + " ".join(f"n:{m}Stocks n:{m}StandardPrice n:{m}Amounts" for m in stock.MONTHS),
    f"with {_MONTH_END} select p.PartNumber, p.Description, p.ExtraDescription, c.LocationName, dp.Text as UnitName, 'IDR' as Currency, "
    + ", ".join(
        f"coalesce(sum(case when m = '{m}' then cast(c.PhysicalInventoryBalance as double) / coalesce(cast(x.ConversionFactor as double), 1) end), 0) as {m}Stocks, "
        f"coalesce(sum(case when m = '{m}' then cast(c.price as double) * coalesce(cast(x.ConversionFactor as double), 1) end), 0) as {m}StandardPrice, "
        f"coalesce(sum(case when m = '{m}' then cast(c.PhysicalInventoryBalance * c.price as double) * coalesce(cast(x.ConversionFactor as double), 1) end), 0) as {m}Amounts"
        for m in stock.MONTHS
    )
    + " from counts c join valued p on p.Id = c.PartId left join t_PartUnitUsage x on x.Id = p.StandardPartUnitUsageId and x.PartId = p.Id"
    " left join t_Unit u on u.Id = x.UnitId left join t_DynamicPhrase dp on dp.Id = u.CodeId"
    " group by p.PartNumber, p.Description, p.ExtraDescription, c.LocationName, dp.Text",
)
def stock_value_month_case(spark, sf_dir):
    return stock.stock_value_month_case(demo_catalog(spark, sf_dir), 1997)


@case(
    "s:PartNumber s:LocationName " + " ".join(f"n:{m}_stocks n:{m}_amounts" for m in stock.MONTHS),
    """
with west as (select *, DeliveryDate - interval 5 hour as local from t_InventoryMovement),
counts as (
  select PartId, LocationName, PhysicalInventoryBalance as n, month(local) as m, coalesce((
      select max_by(NewPrice, Timestamp) from t_PriceChangeLog l where l.PartId = c.PartId and l.PriceType = 0
        and l.Timestamp - interval 5 hour < cast(c.local as date) + interval 1 day), 0) as price,
    bool_or(WarehouseId = 1) over (partition by PartId, LocationName, month(local)) as own
  from west c where BusinessTransactionContextType = 4 and year(local) = 1997
  qualify row_number() over (partition by PartId, LocationName, month(local) order by DeliveryDate desc, LoggingTimeStamp desc, Id desc) = 1),
valued as (
  select p.* from t_Part p join t_ProductGroup g on g.Id = p.ProductGroupId
  where p.Status <> 9 and p.CategoryString not like 'E%' and p.CategoryString not like 'M%' and p.Type in (0, 1)
    and (g.Number <> '024' or g.Number is null))
select p.PartNumber, c.LocationName, """
    + ", ".join(
        f"coalesce(sum(n) filter (m = {i}), 0) as {m}_stocks, coalesce(sum(n * c.price) filter (m = {i}), 0) as {m}_amounts"
        for i, m in enumerate(stock.MONTHS, 1)
    )
    + " from counts c join valued p on p.Id = c.PartId where own group by p.PartNumber, c.LocationName",
)
def stock_value_month_zone(spark, sf_dir):
    return stock.stock_value_month(demo_catalog(spark, sf_dir, _WEST), 1997)


# --- movements -----------------------------------------------------------------------------

_JSON = """
notes as (
  select Id as nid, RawText as raw, Text as shown, {fields}, p.full_name
  from t_CommentText left join (select EmployeeNumber as en, concat(FirstName, ' ', LastName) as full_name from t_Person where EmployeeNumber > '') p
    on p.en = regexp_extract(RawText, '"EmployeeNumber":"([^"]*)"', 1))""".format(
    fields=", ".join(
        f"case when contains(RawText, '\"{key}\":\"') then regexp_extract(RawText, '\"{key}\":\"([^\"]*)\"', 1) end as {name}"
        for key, name in (
            ("ManufacturingOrderNumber", "j_order"),
            ("ReportNumber", "j_report"),
            ("EmployeeNumber", "j_employee"),
            ("Comment", "j_comment"),
        )
    )
)


@case(
    "t:LoggingTimeStamp s:PartNumber s:Description s:ExtraDescription s:BatchNumber s:SerialNumber s:FromLocation s:ToLocation "
    "n:BalanceChange n:FromLocationBalance n:ToLocationBalance s:Unit s:EmployeeNumber s:UserFullName s:UserName s:CommentText "
    "s:ManufacturingOrderNumber s:ReportNumber s:BaseCommentText",
    f"""
with {_JSON},
mv as (select * from t_InventoryMovement)
select a.LoggingTimeStamp, p.PartNumber, p.Description, p.ExtraDescription, a.BatchNumber, pr.SerialNumberWithPartNumber as SerialNumber,
  a.LocationName as FromLocation, b.LocationName as ToLocation, b.BalanceChange, a.BalanceOnLocationAfterChange as FromLocationBalance,
  b.BalanceOnLocationAfterChange as ToLocationBalance, dp.Text as Unit,
  coalesce(nullif(w.EmployeeNumber, ''), nullif(n.j_employee, '')) as EmployeeNumber,
  case when w.EmployeeNumber > '' then concat(w.FirstName, ' ', w.LastName) when n.j_employee > '' then n.full_name end as UserFullName,
  a.UserName, case when n.j_comment is not null then nullif(n.j_comment, '') else nullif(n.raw, '') end as CommentText,
  n.j_order as ManufacturingOrderNumber, n.j_report as ReportNumber, n.raw as BaseCommentText
from mv a
left join mv b on b.PartId = a.PartId and b.LoggingTimeStamp = a.LoggingTimeStamp and b.BusinessTransactionId = a.BusinessTransactionId
  and b.BalanceChange > 0
left join t_Part p on p.Id = a.PartId left join t_PartUnitUsage x on x.Id = p.StandardPartUnitUsageId left join t_Unit u on u.Id = x.UnitId
left join t_DynamicPhrase dp on dp.Id = u.CodeId
left join t_ProductRecord pr on pr.SerialNumberWithPartNumber = a.BatchNumber || ' - ' || a.PartNumber
left join t_Person w on w.Id = a.PersonId
left join notes n on n.nid in (a.CommentId, b.CommentId) and strpos(n.raw, chr(123)) > 0 and strpos(n.raw, chr(125)) > 0
where a.BusinessTransactionContextType = 7 and a.BalanceChange < 0""",
)
def movement_pairs(spark, sf_dir):
    return movements.movement_pairs(demo_catalog(spark, sf_dir))


_TYPE_NAMES = " ".join(
    f"when {code} then '{name}'"
    for code, name in (
        (1, "Arrivals"),
        (3, "Delivery"),
        (4, "Stock count"),
        (7, "Move between locations"),
        (11, "Material withdrawal for manufacturing order"),
    )
)


@case(
    "s:PartPartNumber i:PartType i:PartId s:PartName s:PartDescription t:InventoryMovementLoggingTimeStamp "
    "s:InventoryMovementLoggingTimeStampTimePart t:InventoryMovementDeliveryDate s:InventoryMovementLocationName "
    "s:InventoryMovementOrderNumber s:PurchaseOrderOrderNumber s:CustomerOrderOrderNumber s:DeliveryNoteNumber "
    "s:ManufacturingOrderOrderNumber s:ManufacturingOrderReportNumber i:TransactionTypeId s:TransactionType "
    "s:InventoryMovementComment s:InventoryMovementCommentRawText s:InventoryMovementUserName s:_UserEmployeeNumber s:_UserFullName "
    "s:CauseCode s:CauseCodeName n:BalanceChange i:InventoryMovementSequenceNumber s:ExtraField_Part_GeneralPartNumber "
    "s:ExtraField_Part_PartClassification n:InventoryMovementBalanceOnLocationAfterChange n:InventoryMovementBalanceOnPartAfterChange "
    "s:CustomerRootCustomerCodeAlias s:SupplierCodeAlias n:ConversionFactor i:InventoryMovementUndoMovementId",
    f"""
with {_JSON}
select distinct p.PartNumber as PartPartNumber, p.Type as PartType, p.Id as PartId, p.Description as PartName,
  p.ExtraDescription as PartDescription, m.LoggingTimeStamp as InventoryMovementLoggingTimeStamp,
  strftime(m.LoggingTimeStamp, '%H:%M:%S') as InventoryMovementLoggingTimeStampTimePart, m.DeliveryDate as InventoryMovementDeliveryDate,
  m.LocationName as InventoryMovementLocationName, m.OrderNumber as InventoryMovementOrderNumber, po.OrderNumber as PurchaseOrderOrderNumber,
  co.OrderNumber as CustomerOrderOrderNumber, inv.DeliveryNoteNumber, coalesce(n.j_order, mo.OrderNumber) as ManufacturingOrderOrderNumber,
  n.j_report as ManufacturingOrderReportNumber, m.BusinessTransactionContextType as TransactionTypeId,
  case m.BusinessTransactionContextType {_TYPE_NAMES} end as TransactionType,
  case when n.j_comment is not null then nullif(n.j_comment, '') when n.shown > '' then n.raw end as InventoryMovementComment,
  n.raw as InventoryMovementCommentRawText, m.UserName as InventoryMovementUserName,
  coalesce(nullif(w.EmployeeNumber, ''), nullif(n.j_employee, '')) as _UserEmployeeNumber,
  case when w.EmployeeNumber > '' then concat(w.FirstName, ' ', w.LastName) when n.j_employee > '' then n.full_name else '' end as _UserFullName,
  rc.Code as CauseCode, dp.Text as CauseCodeName, m.BalanceChange, m.SequenceNumber as InventoryMovementSequenceNumber,
  g.String as ExtraField_Part_GeneralPartNumber, k.String as ExtraField_Part_PartClassification,
  m.BalanceOnLocationAfterChange as InventoryMovementBalanceOnLocationAfterChange,
  m.BalanceOnPartAfterChange as InventoryMovementBalanceOnPartAfterChange, cr.CustomerCode as CustomerRootCustomerCodeAlias,
  sr.SupplierCode as SupplierCodeAlias, x.ConversionFactor, m.UndoMovementId as InventoryMovementUndoMovementId
from t_InventoryMovement m left join notes n on n.nid = m.CommentId
left join t_CustomerOrder co on co.OrderNumber = m.OrderNumber and m.BusinessTransactionContextType in (3, 9, 14, 29)
left join t_CustomerOrderDeliveryRow dr on dr.CustomerOrderId = co.Id and dr.QuantityChangeId = m.QuantityChangeId
left join t_CustomerOrderInvoice inv on inv.Id = dr.InvoiceId
left join t_PurchaseOrder po on po.OrderNumber = m.OrderNumber and m.BusinessTransactionContextType in (1, 15)
left join t_ManufacturingOrder mo on mo.OrderNumber = m.OrderNumber and m.BusinessTransactionContextType in (2, 11, 16, 17)
left join t_Customer c on c.Id = co.BusinessContactId left join t_CustomerRoot cr on cr.Id = c.RootId
left join t_Supplier s on s.Id = po.BusinessContactId left join t_SupplierRoot sr on sr.Id = s.RootId
left join t_Part p on p.Id = m.PartId left join t_PartUnitUsage x on x.Id = p.StandardPartUnitUsageId
left join t_Person w on w.Id = m.PersonId
left join t_ReasonCodeUnplannedStockMovement rc on rc.Id = m.ReasonCodeUnplannedStockMovementId
left join t_DynamicPhrase dp on dp.Id = rc.DescriptionId
left join t_ExtraField g on g.ParentId = p.Id and g.TemplateId = 1028091941218534745 and g.String is not null
left join t_ExtraField k on k.ParentId = p.Id and k.TemplateId = 1028374453433595363 and k.String is not null""",
)
def location_transactions(spark, sf_dir):
    return movements.location_transactions(demo_catalog(spark, sf_dir))


# --- materials -----------------------------------------------------------------------------


@case(
    "t:LastReportingDate s:OrderNumber i:Status s:PartNumber s:PartName s:PartDescription i:ToOperationNo n:PlannedQuantity "
    "n:ReportedQuantity n:RejectedQuantity n:RestQuantity s:MaterialPartNumber s:MaterialPartName s:MaterialPartDescription "
    "n:QuantityPerUnit n:MaterialPlannedQuantity n:MaterialReportedQuantity n:MaterialRejectedQuantity n:MaterialRestQuantity "
    "n:EstimatedReportedQuantity n:DifferenceReportedQuantity i:IsBelowEstimated n:CurrentBalance "
    "n:CumulativeTotalDifferenceReportedQuantityPerMaterialPart n:CurrentBalancePerMaterialPartAfterReported",
    """
with last as (select OrderId, max(ReportedWhen) as reported from t_ManufacturingOrderReporting group by OrderId),
crushed as (
  select m.ManufacturingOrderId as oid, m.ManufacturingOrderNodeId as nid, min_by(m.ReportedQuantity, m.Id) as quantity
  from t_ManufacturingOrderMaterial m join t_Part p on p.Id = m.PartId where p.ExtraDescription like 'R-CRUSH%' group by 1, 2),
base as (
  select l.reported as LastReportingDate, mo.OrderNumber, mo.Status, mp.PartNumber, mp.Description as PartName,
    mp.ExtraDescription as PartDescription, m.ToOperationNo, op.PlannedQuantity, op.ReportedQuantity, op.RejectedQuantity, op.RestQuantity,
    p.PartNumber as MaterialPartNumber, p.Description as MaterialPartName, p.ExtraDescription as MaterialPartDescription, m.QuantityPerUnit,
    m.PlannedQuantity as MaterialPlannedQuantity, coalesce(m.ReportedQuantity, 0) + coalesce(cr.quantity, 0) as MaterialReportedQuantity,
    m.RejectedQuantity as MaterialRejectedQuantity, m.RestQuantity as MaterialRestQuantity,
    cast((op.ReportedQuantity + op.RejectedQuantity) * m.QuantityPerUnit as decimal(28,8)) as EstimatedReportedQuantity,
    pl.Balance as CurrentBalance, m.Id as mid
  from t_ManufacturingOrder mo join t_ManufacturingOrderNode n on n.ManufacturingOrderId = mo.Id
  join t_ManufacturingOrderMaterial m on m.ManufacturingOrderId = mo.Id and m.ManufacturingOrderNodeId = n.Id
  join t_Part p on p.Id = m.PartId left join t_Part mp on mp.Id = n.PartId
  left join t_ManufacturingOrderOperation op on op.ManufacturingOrderId = mo.Id and op.ManufacturingOrderNodeId = n.Id
    and op.OperationNumber = m.ToOperationNo
  left join last l on l.OrderId = mo.Id
  left join t_PartLocation pl on pl.PartId = p.Id and pl.LifeCycleState <> 99 and pl.Name = 'WHCC-PROD'
  left join crushed cr on cr.oid = mo.Id and cr.nid = n.Id
  where p.ExtraDescription like 'R-%' and p.ExtraDescription not like 'R-MB-%' and p.ExtraDescription not like 'R-CRUSH%'
    and l.reported between timestamp '1996-01-01' and timestamp '2024-01-20' and m.QuantityPerUnit <> 0 and mo.Status in (4, 5, 6, 7, 8, 9)),
short as (
  select *, MaterialReportedQuantity - EstimatedReportedQuantity as DifferenceReportedQuantity, 1 as IsBelowEstimated
  from base where MaterialReportedQuantity < EstimatedReportedQuantity),
summed as (
  select *, sum(DifferenceReportedQuantity) over (partition by MaterialPartNumber order by LastReportingDate, mid rows unbounded preceding)
    as CumulativeTotalDifferenceReportedQuantityPerMaterialPart from short)
select *, CurrentBalance + CumulativeTotalDifferenceReportedQuantityPerMaterialPart as CurrentBalancePerMaterialPartAfterReported from summed""",
)
def reported_below_estimate(spark, sf_dir):
    return materials.reported_below_estimate(demo_catalog(spark, sf_dir), "1996-01-01", "2024-01-20")


@case(
    "i:Id i:ManufacturingOrderId s:ManufacturingOrderNumber i:ManufacturingOrderNodeId i:ManufacturingOrderStatusId "
    "s:ManufacturingOrderStatus i:OperationNumber s:MainPartNumber s:MainPartName s:MainPartDescription t:PlannedStartDate "
    "t:PlannedFinishDate t:ActualStartDate t:ActualFinishDate s:WorkCenter s:ReportNumber s:MaterialPartNumber s:MaterialPartName "
    "s:MaterialDescription n:MaterialCurrentBalance n:MaterialPlannedQuantity n:MaterialReportedQuantity n:MaterialOutstandingQuantity "
    "n:MaterialRemainingQuantity n:MaterialTransferredQuantity n:MaterialRestQuantity s:MaterialUnit",
    """
with moved as (
  select m.PartId, regexp_extract(c.RawText, '"ManufacturingOrderNumber":"([^"]*)"', 1) as o,
    regexp_extract(c.RawText, '"NodePartNumber":"([^"]*)"', 1) as n, sum(m.BalanceChange) as q
  from t_InventoryMovement m join t_CommentText c on c.Id = m.CommentId
  where m.BusinessTransactionContextType = 7 and left(c.RawText, 1) = chr(123) and right(c.RawText, 1) = chr(125) group by 1, 2, 3),
hand as (select PartId, sum(Balance) as q from t_PartLocation where WarehouseId = 1 and LifeCycleState <> 99 group by PartId)
select m.Id, mo.Id as ManufacturingOrderId, mo.OrderNumber as ManufacturingOrderNumber, nd.Id as ManufacturingOrderNodeId,
  nd.Status as ManufacturingOrderStatusId, case nd.Status when 3 then 'Started' when 4 then 'Finished' end as ManufacturingOrderStatus,
  op.OperationNumber, mp.PartNumber as MainPartNumber, mp.Description as MainPartName, mp.ExtraDescription as MainPartDescription,
  op.PlannedStartDate, op.PlannedFinishDate, op.ActualStartDate, op.ActualFinishDate, wc.Number as WorkCenter, m.ReportNumber,
  p.PartNumber as MaterialPartNumber, p.Description as MaterialPartName, p.ExtraDescription as MaterialDescription,
  coalesce(hand.q, 0) as MaterialCurrentBalance, m.PlannedQuantity as MaterialPlannedQuantity, m.ReportedQuantity as MaterialReportedQuantity,
  m.PlannedQuantity - m.ReportedQuantity as MaterialOutstandingQuantity, m.RestQuantity as MaterialRemainingQuantity,
  coalesce(moved.q, 0) as MaterialTransferredQuantity,
  case when coalesce(moved.q, 0) - m.ReportedQuantity > 0 then coalesce(moved.q, 0) - m.ReportedQuantity else 0 end as MaterialRestQuantity,
  dp.Text as MaterialUnit
from t_ManufacturingOrderMaterial m join t_Part p on p.Id = m.PartId join t_ManufacturingOrder mo on mo.Id = m.ManufacturingOrderId
join t_ManufacturingOrderNode nd on nd.Id = m.ManufacturingOrderNodeId join t_Part mp on mp.Id = nd.PartId
join t_ManufacturingOrderOperation op on op.ManufacturingOrderId = mo.Id and op.ManufacturingOrderNodeId = nd.Id
  and op.OperationNumber = m.ToOperationNo
left join t_PartUnitUsage x on x.Id = p.StandardPartUnitUsageId left join t_Unit u on u.Id = x.UnitId
left join t_DynamicPhrase dp on dp.Id = u.CodeId left join hand on hand.PartId = p.Id
left join moved on moved.PartId = p.Id and moved.o = mo.OrderNumber and moved.n = mp.PartNumber
left join t_WorkCenter wc on wc.Id = op.WorkCenterId
where p.ExtraDescription not like 'M-%' and p.ExtraDescription not like 'E-%'""",
)
def order_material(spark, sf_dir):
    return materials.order_material(demo_catalog(spark, sf_dir))


@case(
    "t:ReportedWhen s:OrderNumber s:MainPartNumber s:MainPartName s:MainPartDescription s:MaterialPartNumber s:MaterialPartName "
    "s:MaterialPartDescription",
    """
with bom as (select r.PreparationId, r.PartId from t_MaterialRow r join t_PartPreparation pp on pp.Id = r.PreparationId)
select distinct r.ReportedWhen, mo.OrderNumber, a.PartNumber as MainPartNumber, a.Description as MainPartName,
  a.ExtraDescription as MainPartDescription, b.PartNumber as MaterialPartNumber, b.Description as MaterialPartName,
  b.ExtraDescription as MaterialPartDescription
from t_ManufacturingOrderReporting r join t_ManufacturingOrderMaterialReporting x on x.ReportingId = r.Id
join t_ManufacturingOrderMaterial m on m.Id = x.MaterialId join t_ManufacturingOrder mo on mo.Id = r.OrderId
join t_ManufacturingOrderNode n on n.Id = m.ManufacturingOrderNodeId join t_Part a on a.Id = n.PartId join t_Part b on b.Id = m.PartId
where r.ReportedWhen >= timestamp '1996-01-01' and r.ReportedWhen < timestamp '1998-01-01' and b.ExtraDescription not like 'R-CRUSH%'
  and not exists (select 1 from bom where bom.PreparationId = a.PreparationId and bom.PartId = b.Id)""",
)
def reported_not_in_bom(spark, sf_dir):
    return materials.reported_not_in_bom(demo_catalog(spark, sf_dir), "1996-01-01", "1997-12-31")


_MAIN_MATERIAL = """
main as (
  select pp.PartId as made, p.PartNumber as num, p.ExtraDescription as txt, r.Quantity as q
  from t_MaterialRow r join t_PartPreparation pp on pp.Id = r.PreparationId join t_Part p on p.Id = r.PartId
  where p.ExtraDescription like 'R-%' qualify row_number() over (partition by pp.PartId order by p.Id, r.Quantity) = 1)"""


@case(
    "i:MainPartId s:MainPartNumber s:MainPartName s:MainPartDescription s:MainMaterialPartNumber s:MainMaterialDescription "
    "n:MainMaterialPartQuantity i:CoordinatedPartId s:CoordinatedPartNumber s:CoordinatedPartName s:CoordinatedPartDescription "
    "s:CoordinatedMaterialPartNumber s:CoordinatedMaterialDescription n:CoordinatedMaterialPartQuantity i:IsDifferent",
    f"""
with {_MAIN_MATERIAL}
select a.Id as MainPartId, a.PartNumber as MainPartNumber, a.Description as MainPartName, a.ExtraDescription as MainPartDescription,
  ma.num as MainMaterialPartNumber, ma.txt as MainMaterialDescription, ma.q as MainMaterialPartQuantity, b.Id as CoordinatedPartId,
  b.PartNumber as CoordinatedPartNumber, b.Description as CoordinatedPartName, b.ExtraDescription as CoordinatedPartDescription,
  mb.num as CoordinatedMaterialPartNumber, mb.txt as CoordinatedMaterialDescription, mb.q as CoordinatedMaterialPartQuantity,
  case when ma.q <> mb.q then 1 else 0 end as IsDifferent
from t_CoordinatedPart x join t_CoordinatedPart y on y.CoordinatedPartHolderId = x.CoordinatedPartHolderId and y.PartId <> x.PartId
left join t_Part a on a.Id = x.PartId join t_Part b on b.Id = y.PartId left join main ma on ma.made = a.Id left join main mb on mb.made = b.Id""",
)
def sibling_diff(spark, sf_dir):
    return materials.sibling_diff(demo_catalog(spark, sf_dir))


@case(
    "i:HolderId i:MainPartId s:MainPartNumber n:MainMaterialPartQuantity i:IsDifferent",
    f"""
with {_MAIN_MATERIAL}
select x.CoordinatedPartHolderId as HolderId, a.Id as MainPartId, a.PartNumber as MainPartNumber, ma.q as MainMaterialPartQuantity,
  case when exists (select 1 from t_CoordinatedPart y join main mb on mb.made = y.PartId
    where y.CoordinatedPartHolderId = x.CoordinatedPartHolderId and mb.q <> ma.q) then 1 else 0 end as IsDifferent
from t_CoordinatedPart x left join t_Part a on a.Id = x.PartId left join main ma on ma.made = x.PartId""",
)
def sibling_flags(spark, sf_dir):
    return materials.sibling_flags(demo_catalog(spark, sf_dir))


# --- orders and forecasts ------------------------------------------------------------------

_LEVEL = "case {0} when 1 then 'Fixed order' when 4 then 'Forecast' else 'Unknown' end"


@case(
    "s:PartNumber s:PartName s:PartDescription s:CustomerCode s:CustomerName i:CustomerOrderRowCount i:CustomerCommitmentLevel "
    "s:CustomerCommitmentLevelText s:DeliveryPeriod n:RestQuantity",
    f"""
select p.PartNumber, p.Description as PartName, p.ExtraDescription as PartDescription, c.Alias as CustomerCode, cr.Name as CustomerName,
  count(distinct r.Id) as CustomerOrderRowCount, r.CustomerCommitmentLevel, {_LEVEL.format("r.CustomerCommitmentLevel")} as CustomerCommitmentLevelText,
  strftime(r.DeliveryDate, '%Y-%m') as DeliveryPeriod, sum(r.RestQuantity) as RestQuantity
from t_CustomerOrderRow r join t_CustomerOrder o on o.Id = r.ParentOrderId and o.LifeCycleState <> 99
left join t_Customer c on c.Id = o.BusinessContactId left join t_CustomerRoot cr on cr.Id = c.RootId
join t_Part p on p.Id = r.PartId and p.Status <> 9
where r.LifeCycleState <> 99 and r.Status <> 9 and r.CustomerCommitmentLevel in (1, 4)
group by p.Id, p.PartNumber, p.Description, p.ExtraDescription, c.Id, c.Alias, cr.Name, r.CustomerCommitmentLevel, strftime(r.DeliveryDate, '%Y-%m')""",
)
def outstanding_by_period(spark, sf_dir):
    return orders.outstanding_by_period(demo_catalog(spark, sf_dir))


@case(
    "s:PartNumber i:CustomerOrderRowCount i:CustomerCommitmentLevel s:DeliveryPeriod n:RestQuantity",
    f"""
select p.PartNumber, count(distinct r.Id) as CustomerOrderRowCount, r.CustomerCommitmentLevel,
  strftime(r.DeliveryDate {_WEST_SQL}, '%Y-%m') as DeliveryPeriod, sum(r.RestQuantity) as RestQuantity
from t_CustomerOrderRow r join t_CustomerOrder o on o.Id = r.ParentOrderId and o.LifeCycleState <> 99
left join t_Customer c on c.Id = o.BusinessContactId join t_Part p on p.Id = r.PartId and p.Status <> 9
where r.LifeCycleState <> 99 and r.Status <> 9 and r.CustomerCommitmentLevel in (1, 4)
group by p.Id, p.PartNumber, c.Id, r.CustomerCommitmentLevel, strftime(r.DeliveryDate {_WEST_SQL}, '%Y-%m')""",
)
def outstanding_by_period_zone(spark, sf_dir):
    return orders.outstanding_by_period(demo_catalog(spark, sf_dir, _WEST))


_STATUS = "case {0} when 1 then 'Registered' when 5 then 'Partial delivery made' when 9 then 'Final delivery made' else 'Unknown' end"


@case(
    "i:CustomerOrderId i:CustomerOrderRowId s:DeliveryScheduleNumber s:PartNumber s:OrderNumber s:CustomerCode s:CustomerName t:OrderDate "
    "s:CustomerPurchaseOrderNumber i:OrderStatus s:OrderStatusText i:Position i:CustomerCommitmentLevel s:CustomerCommitmentLevelText "
    "i:RowStatus i:RowOrderStatus s:RowOrderStatusText t:DeliveryDate s:DeliveryPeriod n:RestQuantity",
    f"""
with calls as (
  select ds.*, t.OrderNumber as onum, t.Position as pos, dp.PartId as pid, k.DeliveryDate as dd, k.CommitmentLevel as cl, k.DemandType as dt
  from t_DeliverySchedule ds join t_DeliverySchedulePart dp on dp.ParentId = ds.Id
  join t_DeliveryScheduleReconciliationCommandTransferred t on t.ParentId = dp.Id
  join t_DeliveryScheduleCall k on k.Id = t.CallId and k.ParentId = dp.Id
  left join t_EdiBusinessTransaction e on e.BusinessEntityId = ds.Id
  where k.IsReplaced = 0)
select o.Id as CustomerOrderId, r.Id as CustomerOrderRowId, s.Number as DeliveryScheduleNumber, p.PartNumber, o.OrderNumber,
  c.Alias as CustomerCode, cr.Name as CustomerName, o.OrderDate,
  coalesce(r.CustomerOrderNumber, o.BusinessContactOrderNumber) as CustomerPurchaseOrderNumber, o.Status as OrderStatus,
  {_STATUS.format("o.Status")} as OrderStatusText, r.Position, r.CustomerCommitmentLevel,
  {_LEVEL.format("r.CustomerCommitmentLevel")} as CustomerCommitmentLevelText, r.RowStatus, r.Status as RowOrderStatus,
  {_STATUS.format("r.Status")} as RowOrderStatusText, r.DeliveryDate, strftime(r.DeliveryDate, '%Y-%m') as DeliveryPeriod, r.RestQuantity
from t_CustomerOrder o join t_CustomerOrderRow r on r.ParentOrderId = o.Id and r.LifeCycleState <> 99 and r.Status <> 9
  and r.CustomerCommitmentLevel in (1, 4)
join t_Part p on p.Id = r.PartId and p.Status <> 9
left join t_Customer c on c.Id = o.BusinessContactId left join t_CustomerRoot cr on cr.Id = c.RootId
left join calls s on (s.BuyerCustomerCode = c.Alias or s.BuyerCustomerId = c.Id)
  and (s.dt = r.CustomerCommitmentLevel or s.cl = r.CustomerCommitmentLevel)
  and s.onum = o.OrderNumber and s.pid = p.Id and s.pos = r.Position and s.dd = r.DeliveryDate
where o.Status <> 9 and o.LifeCycleState <> 99""",
)
def outstanding_with_schedule(spark, sf_dir):
    return orders.outstanding_with_schedule(demo_catalog(spark, sf_dir))


def _by_period_sql(strict: str) -> str:
    return f"""
with calls as (
  select dp.ParentId as schedule, o.BusinessContactId as customer, strftime(k.DeliveryDate, '%Y-%m') as period, min(k.Id) as first_id,
    string_agg(distinct '''' || cast(k.Id as varchar) || '''', ', ' order by '''' || cast(k.Id as varchar) || '''') as ids
  from t_DeliveryScheduleCall k join t_DeliveryScheduleReconciliationCommandTransferred t on t.CallId = k.Id
  join t_DeliverySchedulePart dp on dp.Id = t.ParentId join t_Part p on p.Id = dp.PartId
  join t_CustomerOrder o on o.OrderNumber = t.OrderNumber and o.LifeCycleState <> 99 and o.Status <> 9
  join t_CustomerOrderRow r on r.DeliveryDate = k.DeliveryDate and r.PartId = dp.PartId and r.LifeCycleState <> 99
    and r.CustomerCommitmentLevel = 4 and r.Status = 1 {strict}
  where k.IsReplaced = 0 and (k.DemandType = 4 or k.CommitmentLevel = 4) group by 1, 2, 3)
select x.first_id as FirstDeliveryScheduleCallId, x.ids as DeliveryScheduleCallIds, ds.Number as DeliveryScheduleNumber,
  f.TransactionNumber as EdiTransactionNumber, c.Alias as CustomerCode, cr.Name as CustomerName, x.period as ForecastPeriod, f.FileName,
  f.FilePath, f.FileCreatedWhen
from t_DeliverySchedule ds join t_EdiBusinessTransaction e on e.BusinessEntityId = ds.Id left join t_EdiFileTransaction f on f.Id = e.FileTransactionId
join t_Customer c on c.Alias = ds.BuyerCustomerCode or c.Id = ds.BuyerCustomerId join t_CustomerRoot cr on cr.Id = c.RootId
join calls x on x.schedule = ds.Id and x.customer = c.Id"""


_BY_PERIOD_COLUMNS = (
    "i:FirstDeliveryScheduleCallId s:DeliveryScheduleCallIds s:DeliveryScheduleNumber s:EdiTransactionNumber s:CustomerCode "
    "s:CustomerName s:ForecastPeriod s:FileName s:FilePath t:FileCreatedWhen"
)


@case(_BY_PERIOD_COLUMNS, _by_period_sql(""))
def forecast_by_period(spark, sf_dir):
    return forecast.forecast_by_period(demo_catalog(spark, sf_dir))


@case(_BY_PERIOD_COLUMNS, _by_period_sql("and r.ParentOrderId = o.Id"))
def forecast_by_period_strict(spark, sf_dir):
    return forecast.forecast_by_period(demo_catalog(spark, sf_dir), strict=True)


@case(
    "i:DeliveryScheduleCallId i:DeliveryScheduleId s:DeliveryScheduleNumber i:EdiBusinessTransactionId s:EdiTransactionNumber s:FileName "
    "s:FilePath t:FileCreatedWhen i:DeliveryScheduleStatus s:DeliveryScheduleStatusText i:DeliverySchedulePartStatus "
    "i:DeliverySchedulePartPreviousStatus i:DeliverySchedulePartErrorTypes i:DeliverySchedulePartWarningTypes s:CustomerCode "
    "s:CustomerOrderNumber s:PurchaseOrderNumber s:RowOrderStatus i:PartId s:PartNumber s:PartName s:PartDescription i:DemandType n:Quantity "
    "t:DeliveryDate i:IsReplaced",
    """
select k.Id as DeliveryScheduleCallId, ds.Id as DeliveryScheduleId, ds.Number as DeliveryScheduleNumber, e.Id as EdiBusinessTransactionId,
  f.TransactionNumber as EdiTransactionNumber, f.FileName, f.FilePath, f.FileCreatedWhen, ds.Status as DeliveryScheduleStatus,
  case ds.Status when 1 then '1 - Activated' when 3 then '3 - Reconciled' else 'Unknown' end as DeliveryScheduleStatusText,
  dp.Status as DeliverySchedulePartStatus, dp.PreviousStatus as DeliverySchedulePartPreviousStatus,
  dp.ErrorTypes as DeliverySchedulePartErrorTypes, dp.WarningTypes as DeliverySchedulePartWarningTypes, ds.BuyerCustomerCode as CustomerCode,
  o.OrderNumber as CustomerOrderNumber, dp.CustomerOrderNumber as PurchaseOrderNumber,
  case when r.Status >= 5 then 'Closed' else 'Opened' end as RowOrderStatus, dp.PartId, p.PartNumber, p.Description as PartName,
  p.ExtraDescription as PartDescription, k.DemandType, k.Quantity, k.DeliveryDate, k.IsReplaced
from t_DeliverySchedule ds join t_DeliverySchedulePart dp on dp.ParentId = ds.Id
join t_DeliveryScheduleReconciliationCommandTransferred t on t.ParentId = dp.Id
join t_DeliveryScheduleCall k on k.Id = t.CallId and k.IsReplaced = 0 and (k.DemandType = 4 or k.CommitmentLevel = 4)
join t_Part p on p.Id = dp.PartId join t_EdiBusinessTransaction e on e.BusinessEntityId = ds.Id
left join t_EdiFileTransaction f on f.Id = e.FileTransactionId
join t_Customer c on c.Alias = ds.BuyerCustomerCode or c.Id = ds.BuyerCustomerId
join t_CustomerOrder o on o.BusinessContactId = c.Id and o.OrderNumber = t.OrderNumber and o.LifeCycleState <> 99
join t_CustomerOrderRow r on r.ParentOrderId = o.Id and r.LifeCycleState <> 99 and r.PartId = dp.PartId and r.DeliveryDate = k.DeliveryDate
  and r.CustomerCommitmentLevel = 4
where case when r.Status >= 5 then 'Closed' else 'Opened' end = 'Opened'""",
)
def forecast_detail(spark, sf_dir):
    return forecast.forecast_detail(demo_catalog(spark, sf_dir))


_PLAN_COLUMNS = (
    "s:CustomerCode s:CustomerFullName s:CustomerOrderNumber s:PartNumber s:PartName s:PartDescription s:CustomerPartNumber "
    "n:PlannedQuantity s:UnitCode s:CurrencyCode s:PriceEach s:TotalPrice t:DeliveryDate s:PriceChangeUserBy t:PriceChangeDate s:CreatedBy"
)

_PLAN_SCHEDULED = """
select CustomerCode, concat(CustomerCode, ' - ', Name) as CustomerFullName, CustomerOrderNumber, PartNumber, max(Description) as PartName,
  max(ExtraDescription) as PartDescription, CustomerPartNumber, cast(sum(Quantity) as decimal(28,4)) as PlannedQuantity, UnitCode, CurrencyCode,
  cast(price as decimal(38,16)) as PriceEach, cast(price as decimal(24,16)) * cast(sum(Quantity) as decimal(14,4)) as TotalPrice, DeliveryDate,
  max(UserCode) as PriceChangeUserBy, changed as PriceChangeDate, 'EDI' as CreatedBy
from (
  select cr.CustomerCode, cr.Name, b.CustomerOrderNumber, p.PartNumber, p.Description, p.ExtraDescription, l.CustomerPartNumber, b.Quantity,
    uc.Text as UnitCode, b.DeliveryDate, pr.Code as CurrencyCode, pr.NewPrice as price, pr.UserCode, pr.Timestamp as changed
  from (
    select * from calls x where version = (select max(y.version) from calls y where y.CustomerId = x.CustomerId and y.PartId = x.PartId)) b
  left join t_Part p on p.Id = b.PartId left join t_Customer c on c.Id = b.CustomerId left join t_CustomerRoot cr on cr.Id = c.RootId
  left join t_CustomerPartLink l on l.PartId = p.Id and l.CustomerId = c.Id
  left join t_Unit u on u.Id = b.UnitId left join t_DynamicPhrase uc on uc.Id = u.CodeId
  left join lateral (
    select z.NewPrice, z.UserCode, z.Timestamp, cu.Code from t_PriceChangeLog z left join t_Currency cu on cu.Id = z.NewPriceCurrencyId
    where z.PartId = p.Id and z.CustomerId = c.Id and z.PriceType in (-3, 3) and z.IsSetupPrice = 0
      and z.Timestamp < cast(b.DeliveryDate as date) + interval 1 day
    order by z.Timestamp desc, z.NewPrice desc limit 1) pr on true) q
group by CustomerCode, Name, PartNumber, CustomerPartNumber, CustomerOrderNumber, DeliveryDate, UnitCode, CurrencyCode, price, changed"""

_PLAN_CALLS = """
with calls as (
  select s.CustomerId, s.CustomerDeliveryScheduleDate as version, d.PartId, d.CustomerOrderNumber, d.UnitId, k.DeliveryDate, k.Quantity
  from t_DeliveryScheduleCall k join t_DeliverySchedulePart d on d.Id = k.ParentId join t_DeliverySchedule s on s.Id = d.ParentId
  where k.DemandType = 4 and k.DeliveryDate >= timestamp '1997-01-01' and k.DeliveryDate < timestamp '1999-01-01')"""

_PLAN_ORDERED = """
select cr.CustomerCode, concat(cr.CustomerCode, ' - ', cr.Name), o.BusinessContactOrderNumber, p.PartNumber, p.Description, p.ExtraDescription,
  l.CustomerPartNumber, cast(r.OrderedQuantity as decimal(28,4)), uc.Text, 'IDR', cast(r.Price * cast(o.ExchangeRate as decimal(19,12)) as decimal(38,16)),
  cast(r.Price * cast(o.ExchangeRate as decimal(19,12)) as decimal(24,16)) * cast(r.OrderedQuantity as decimal(14,4)), r.DeliveryDate, cast(null as varchar), cast(null as timestamp),
  (select min(h.ModifiedBy) from t_EntityChangeLog h where h.EntityId = o.Id and h.ChangeType = 1
     and h.EntityTypeId = '9A008BAB-1814-43EC-AFA5-4E42A5C3B36C')
from t_CustomerOrder o join t_CustomerOrderRow r on r.ParentOrderId = o.Id join t_Currency cu on cu.Id = o.CurrencyId
left join t_Part p on p.Id = r.PartId left join t_Customer c on c.Id = o.BusinessContactId left join t_CustomerRoot cr on cr.Id = c.RootId
left join t_CustomerPartLink l on l.PartId = p.Id and l.CustomerId = c.Id
left join t_Unit u on u.Id = r.UnitId left join t_DynamicPhrase uc on uc.Id = u.CodeId
where r.CustomerCommitmentLevel = 1 and r.WarehouseId = 1 and r.CreationContext = 0 and r.OrderRowType <> 4 and r.PartId is not null
  and r.FreeText is null and r.LifeCycleState <> 99 and o.LifeCycleState <> 99
  and not exists (select 1 from t_DeliveryScheduleReconciliationCommandTransferred t where t.OrderNumber = o.OrderNumber)
  and r.DeliveryDate >= timestamp '1997-01-01' and r.DeliveryDate < timestamp '1999-01-01'"""


@case(_PLAN_COLUMNS, _PLAN_CALLS + _PLAN_SCHEDULED + "\nunion\n" + _PLAN_ORDERED)
def sales_plan(spark, sf_dir):
    return forecast.sales_plan(demo_catalog(spark, sf_dir, lines_once=True), "1997-01-01", "1998-12-31")


@case(_PLAN_COLUMNS, _PLAN_CALLS + _PLAN_SCHEDULED)
def sales_plan_schedules_only(spark, sf_dir):
    return forecast.sales_plan(demo_catalog(spark, sf_dir), "1997-01-01", "1998-12-31", include_orders=False)


# --- document numbers ----------------------------------------------------------------------

_DELIVERIES = """
with mv as (select * from t_InventoryMovement),
logs as (
  select strftime(LoggingTimeStamp, '%Y-%m-%d %H:%M:%S') as at, UserName as who, min(EntityIndentity) as entity
  from t_UndoReportingLog where Type = 1 group by 1, 2, split_part(EntityIndentity, '/', 1)),
grouped as (
  select strftime(m.LoggingTimeStamp, '%Y-%m-%d %H:%M:%S') as LoggingTime, min(m.LoggingTimeStamp) as LoggingTimeStamp,
    strftime(u.LoggingTimeStamp, '%Y-%m-%d %H:%M:%S') as UndoLoggingTime, min(u.LoggingTimeStamp) as UndoLoggingTimeStamp, m.UserName,
    u.UserName as UndoUserName, n.DeliveryNoteNumber, x.DeliveryNoteNumber as ReplacedDeliveryNoteNumber, m.DeliveryDate
  from mv m
  left join t_CustomerOrderInvoice n on n.Id = (
    select min(d.InvoiceId) from t_CustomerOrderDeliveryRow d where d.QuantityChangeId = m.QuantityChangeId)
  left join mv u on u.Id = m.UndoMovementId
  left join logs on logs.entity like concat(m.OrderNumber, '/%') and logs.at = strftime(u.LoggingTimeStamp, '%Y-%m-%d %H:%M:%S')
    and logs.who = u.UserName
  left join t_CustomerOrderInvoice x on x.OrderDeliveryNumber = logs.entity
  where m.BusinessTransactionContextType = 3 and m.LoggingTimeStamp between timestamp '2024-01-03' and timestamp '2024-01-28'
  group by 1, 3, m.UserName, u.UserName, n.DeliveryNoteNumber, x.DeliveryNoteNumber, m.DeliveryDate),
rated as (
  select *, case when DeliveryNoteNumber is not null then 'Created' when ReplacedDeliveryNoteNumber is not null then 'Replaced' else 'Cancelled' end
    as Status from grouped)"""

_STATUS_COLUMNS = (
    "s:LoggingTime t:LoggingTimeStamp s:UndoLoggingTime t:UndoLoggingTimeStamp s:UserName s:UndoUserName s:DeliveryNoteNumber "
    "s:ReplacedDeliveryNoteNumber t:DeliveryDate s:Status"
)


@case(_STATUS_COLUMNS, _DELIVERIES + " select * from rated")
def document_status(spark, sf_dir):
    return documents.document_status(demo_catalog(spark, sf_dir), "2024-01-03", "2024-01-28")


_DOCUMENT_ORDER = (
    "order by LoggingTimeStamp, UserName nulls first, UndoLoggingTime nulls first, UndoUserName nulls first, "
    "DeliveryNoteNumber nulls first, ReplacedDeliveryNoteNumber nulls first, DeliveryDate"
)


@case(
    _STATUS_COLUMNS + " s:PreviousDeliveryNoteNumber s:NextDeliveryNoteNumber i:GroupId i:AscSumCount i:DescSumCount "
    "n:PredictDeliveryNoteNumber s:StringPredictDeliveryNoteNumber",
    _DELIVERIES
    + f""",
numbered as (select *, row_number() over ({_DOCUMENT_ORDER}) as rn from rated),
islands as (
  select *, last_value(DeliveryNoteNumber ignore nulls) over (order by rn rows unbounded preceding) as PreviousDeliveryNoteNumber,
    first_value(DeliveryNoteNumber ignore nulls) over (order by rn rows between current row and unbounded following) as NextDeliveryNoteNumber,
    count(DeliveryNoteNumber) over (order by LoggingTimeStamp) as GroupId from numbered),
stepped as (
  select *, case when DeliveryNoteNumber is null then count(*) filter (DeliveryNoteNumber is null) over (partition by GroupId order by LoggingTimeStamp) end as AscSumCount,
    case when DeliveryNoteNumber is null then count(*) filter (DeliveryNoteNumber is null) over (partition by GroupId order by LoggingTimeStamp desc) end as DescSumCount
  from islands),
predicted as (
  select *, case when DeliveryNoteNumber is not null then cast(DeliveryNoteNumber as bigint)
    when PreviousDeliveryNoteNumber is not null then cast(PreviousDeliveryNoteNumber as bigint) + AscSumCount
    else cast(NextDeliveryNoteNumber as bigint) - DescSumCount end as PredictDeliveryNoteNumber from stepped)
select *, coalesce(DeliveryNoteNumber, cast(PredictDeliveryNoteNumber as varchar)) as StringPredictDeliveryNoteNumber from predicted""",
)
def gap_fill_number(spark, sf_dir):
    return documents.gap_fill_number(demo_catalog(spark, sf_dir), "2024-01-03", "2024-01-28")


# Movements of the same time count in the order of their ids, hence the combined key in max_by below.
# --- planning ------------------------------------------------------------------------------

_ROLES = """
select Id as PartId, cast(null as varchar) as RelativeRequirementNumber, cast(null as bigint) as CustomerId, cast(null as bigint) as MainPartId,
  'Main' as PartType from t_Part
union
select l.PartId, concat(c.Alias, ' - ', l.CustomerPartNumber), l.CustomerId, null, 'CustomerLink' from t_CustomerPartLink l join t_Customer c on c.Id = l.CustomerId
union
select r.PartId, p.PartNumber, null, p.Id, 'Parent' from t_MaterialRow r join t_PartPreparation pp on pp.Id = r.PreparationId join t_Part p on p.Id = pp.PartId"""


@case("i:PartId s:RelativeRequirementNumber i:CustomerId i:MainPartId s:PartType", _ROLES)
def part_roles(spark, sf_dir):
    return planning.part_roles(demo_catalog(spark, sf_dir))


@case(
    "i:part_id d:day t:since n:moved",
    """
with days as (select distinct part_id, cast(logging_ts as date) as day from v_movement),
points as (
  select d.part_id, d.day, max(c.logging_ts) as since from days d
  left join v_movement c on c.part_id = d.part_id and c.type_code = 4 and c.delivery_date <= d.day group by d.part_id, d.day)
select p.part_id, p.day, p.since, coalesce(sum(m.balance_change), 0) as moved
from points p left join v_movement m on m.part_id = p.part_id and m.type_code <> 4 and m.delivery_date <= p.day
  and ((p.since is not null and m.logging_ts >= p.since) or (p.since is null and m.delivery_date = p.day))
group by p.part_id, p.day, p.since""",
)
def balance_since_count(spark, sf_dir):
    movement = role(spark, sf_dir, "v_movement")
    days = movement.select("part_id", F.to_date("logging_ts").alias("day")).distinct()
    counts = movement.filter("type_code = 4").withColumn("since", F.col("logging_ts"))
    points = temporal.asof_max_by(days, counts, ["part_id"], "day", "delivery_date", ["logging_ts"], ["since"], dedupe=False)
    return temporal.sum_since_mark(
        points,
        movement.filter("type_code <> 4"),
        ["part_id"],
        "day",
        "since",
        "movement_id",
        "logging_ts",
        "delivery_date",
        "balance_change",
        "moved",
    )


PLANNED_PARTS = ("P0", "P3", "P8", "P15", "P77", "P149")


_ORDER_PLAN_COLUMNS = (
    "d:TransactionDate i:PartId s:PartNumber s:PartName s:PartDescription s:RelativeRequirementNumber s:PartType i:MainPartId n:OrderedQuantity "
    "n:ManufacturingSuggestionQuantity n:ManufacturingQuantity n:PurchasingSuggestionQuantity n:ArrivalQuantity n:DeliveryQuantity "
    "n:LastBalanceOnDay t:LastStockCountTakenDate n:TotalTransactionFromStockCountUntilCurrent n:ActualLastBalanceOnDay"
)

_ORDER_PLAN = f"""
with roles as ({_ROLES}),
days as (select cast(d as date) as day from generate_series(timestamp '{{first}}', timestamp '{{last}}', interval 1 day) g(d)),
grid as (
  select days.day, p.Id, p.PartNumber, p.Description, p.ExtraDescription, r.*, coalesce(r.MainPartId, p.Id) as sold, r.PartType = 'Main' as main
  from t_Part p join roles r on r.PartId = p.Id cross join days {{chosen}}),
mv as (select *, cast(LoggingTimeStamp as date) as ld, cast(DeliveryDate as date) as dd from t_InventoryMovement),
points as (
  select g.Id, g.day,
    (select max_by(BalanceOnPartAfterChange, cast(epoch_us(LoggingTimeStamp) as hugeint) * 10000000000000000000 + Id) from mv where mv.PartId = g.Id and mv.ld <= g.day) as last_balance,
    (select max(LoggingTimeStamp) from mv where mv.PartId = g.Id and BusinessTransactionContextType = 4 and mv.dd <= g.day) as since,
    (select max_by(BalanceOnPartAfterChange, cast(epoch_us(LoggingTimeStamp) as hugeint) * 10000000000000000000 + Id) from mv where mv.PartId = g.Id and BusinessTransactionContextType = 4
      and mv.dd <= g.day) as counted
  from (select distinct Id, day from grid) g),
moves as (
  select p.Id, p.day, sum(mv.BalanceChange) as moved from points p join mv on mv.PartId = p.Id and mv.BusinessTransactionContextType <> 4
    and mv.WarehouseId = 1 and mv.dd <= p.day
    and ((p.since is not null and mv.LoggingTimeStamp >= p.since) or (p.since is null and mv.dd = p.day)) group by 1, 2),
ordered as (
  select r.PartId as part, o.BusinessContactId as customer, cast(r.DeliveryDate as date) as day, sum(r.OrderedQuantity) as q
  from t_CustomerOrderRow r join t_CustomerOrder o on o.Id = r.ParentOrderId and o.LifeCycleState <> 99 where r.LifeCycleState <> 99 group by 1, 2, 3),
delivered as (
  select r.PartId as part, o.BusinessContactId as customer, cast(d.DeliveryDate as date) as day, sum(qc.BalanceChange) as q
  from t_CustomerOrderInvoice i join t_CustomerOrderDeliveryRow d on d.ParentInvoiceId = i.Id and d.ParentRowId is null
  join t_QuantityChange qc on qc.Id = d.QuantityChangeId join t_CustomerOrderRow r on r.Id = d.CustomerOrderRowId
  join t_CustomerOrder o on o.Id = d.CustomerOrderId where d.AffectStockBalance = 1 and qc.Status in (3, 6) group by 1, 2, 3),
make as (select PartId as part, cast(PlannedFinishDate as date) as day, sum(PlannedQuantity) as q from t_OrderOperationSuggestion group by 1, 2),
made as (
  select n.PartId as part, cast(x.ActualReportedDate as date) as day, sum(x.Quantity) as q
  from t_ManufacturingOrderReporting r join t_ManufacturingOrderOperationReporting x on x.ReportingId = r.Id
  join t_ManufacturingOrderNode n on n.Id = r.RootNodeId
  where r.ReportingType <> 6 and x.Type in (0, 3, 5, 6, 7, 8, 9, 10, 11, 12) and r.UndoManufacturingOrderReportingId is null group by 1, 2),
buy as (select PartId as part, cast(DeliveryDate as date) as day, sum(OrderedQuantity) as q from t_OrderSuggestion where TransType = 3 group by 1, 2),
arrived as (
  select o.PartId as part, cast(d.DeliveryDate as date) as day, sum(qc.BalanceChange) as q
  from t_PurchaseOrderDeliveryRow d join t_PurchaseOrderDelivery h on h.Id = d.PurchaseOrderDeliveryId
  join t_PurchaseOrderRow o on o.Id = d.PurchaseOrderRowId
  join t_PurchaseOrderDeliveryRowQuantity w on w.ParentId = d.Id and w.BusinessTransactionContextType = 1
  join t_QuantityChange qc on qc.Id = w.QuantityChangeId group by 1, 2)
select g.day as TransactionDate, g.Id as PartId, g.PartNumber, g.Description as PartName, g.ExtraDescription as PartDescription,
  g.RelativeRequirementNumber, g.PartType, g.MainPartId,
  cast(coalesce((select sum(q) from ordered x where x.part = g.sold and x.day = g.day
    and (g.PartType <> 'CustomerLink' or x.customer = g.CustomerId)), 0) as decimal(20,0)) as OrderedQuantity,
  cast(coalesce((select sum(q) from make x where g.main and x.part = g.Id and x.day = g.day), 0) as decimal(20,0)) as ManufacturingSuggestionQuantity,
  cast(coalesce((select sum(q) from made x where g.main and x.part = g.Id and x.day = g.day), 0) as decimal(20,0)) as ManufacturingQuantity,
  cast(coalesce((select sum(q) from buy x where g.main and x.part = g.Id and x.day = g.day), 0) as decimal(20,0)) as PurchasingSuggestionQuantity,
  cast(coalesce((select sum(q) from arrived x where g.main and x.part = g.Id and x.day = g.day), 0) as decimal(20,0)) as ArrivalQuantity,
  cast(coalesce((select sum(q) from delivered x where x.part = g.sold and x.day = g.day
    and (g.PartType <> 'CustomerLink' or x.customer = g.CustomerId)), 0) as decimal(20,0)) as DeliveryQuantity,
  cast(case when g.main then coalesce(p.last_balance, 0) else 0 end as decimal(20,0)) as LastBalanceOnDay, p.since as LastStockCountTakenDate,
  cast(case when g.main then coalesce(m.moved, 0) else 0 end as decimal(20,0)) as TotalTransactionFromStockCountUntilCurrent,
  cast(case when g.main then coalesce(p.counted, 0) + cast(coalesce(m.moved, 0) as decimal(20,0)) else 0 end as decimal(20,0)) as ActualLastBalanceOnDay
from grid g left join points p on p.Id = g.Id and p.day = g.day left join moves m on m.Id = g.Id and m.day = g.day"""


@case(
    _ORDER_PLAN_COLUMNS,
    _ORDER_PLAN.format(first="2024-01-05", last="2024-01-25", chosen=f"where p.PartNumber in {PLANNED_PARTS}"),
)
def order_plan(spark, sf_dir):
    return planning.order_plan(demo_catalog(spark, sf_dir), "2024-01-05", "2024-01-25", list(PLANNED_PARTS))


@case(_ORDER_PLAN_COLUMNS, _ORDER_PLAN.format(first="2024-01-10", last="2024-01-12", chosen=""))
def order_plan_all_parts(spark, sf_dir):
    return planning.order_plan(demo_catalog(spark, sf_dir), "2024-01-10", "2024-01-12")
