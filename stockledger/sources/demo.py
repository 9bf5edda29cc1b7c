"""The business tables bound to the generated test tables.

Every view is one portable SELECT over the test tables, so the Spark queries and the DuckDB check
SQL read exactly the same rows. ``{name}`` stands for a test table. ``ROLES`` are narrow views for
checking single operators, ``TABLES`` the tables of the catalog.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stockledger.operators.stage import staged
from stockledger.sources.catalog import Catalog

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Order lines have no unique key in the test tables; this makes one row per order and line number.
_LINES = """
select l_orderkey, l_linenumber, min(l_partkey) as partkey, min(l_shipdate) as shipdate,
  sum(cast(l_quantity as decimal(18,4))) as quantity, max(cast(l_extendedprice as decimal(18,4))) as price,
  min(l_returnflag) as returnflag, min(l_linestatus) as linestatus, max(l_tax) as tax, max(l_discount) as discount
from {lineitem} group by l_orderkey, l_linenumber
"""

_ACCOUNT_YEARS = """
select l_suppkey, year(o_orderdate) as y,
  max(cast(case when l_returnflag <> 'R' then l_extendedprice else 0 end as decimal(18,4))) as debit,
  max(cast(case when l_returnflag = 'R' then l_extendedprice else 0 end as decimal(18,4))) as credit
from {lineitem} join {orders} on o_orderkey = l_orderkey group by l_suppkey, year(o_orderdate)
"""

TABLES = {
    "Account": """
select s_suppkey as Id, concat('A', cast(s_suppkey as varchar(20))) as Number from {supplier}""",
    "AccountYearSetting": f"""
select cast(y as bigint) as AccountingYearId, l_suppkey as ParentId, 200 + l_suppkey % 25 as DescriptionId
from ({_ACCOUNT_YEARS}) as a""",
    "AccountingYear": """
select cast(y as bigint) as Id, cast(y as varchar(4)) as Description,
  case when y = (select max(year(o_orderdate)) from {orders}) then 0 else 1 end as Status
from (select distinct year(o_orderdate) as y from {orders}) as a""",
    "AccountingYearPeriod": """
select cast(y as bigint) as AccountingYearId,
  cast(concat(cast(y as varchar(4)), '-', lpad(cast(m as varchar(2)), 2, '0'), '-01') as timestamp) as FromDate
from (select distinct year(o_orderdate) as y, month(o_orderdate) as m from {orders}) as a""",
    "AccountsPayableLedger": """
select c_custkey as Id, concat('APL', cast(c_custkey as varchar(20))) as Number from {customer}""",
    "AccountsReceivable": """
select o_orderkey as Id, concat('INV', cast(o_orderkey as varchar(20))) as InvoiceNumber,
  concat('EF', cast(o_custkey as varchar(20))) as ChineseVatInvoiceNumber, o_custkey as BusinessContactId
from {orders} where o_orderstatus = 'O'""",
    "AccountsReceivableLedger": """
select c_custkey as Id, concat('ARL', cast(c_custkey as varchar(20))) as Number from {customer}""",
    "Balance": f"""
select l_suppkey * 10000 + y as Id, l_suppkey as AccountId, concat('E', cast(l_suppkey as varchar(20))) as EntryIdentifier,
  l_suppkey * 10000 + y as OpeningBalanceId, cast(y as bigint) as AccountingYearId
from ({_ACCOUNT_YEARS}) as a""",
    "CommentText": """
select event_id as Id,
  case event_type when 'signup' then '' when 'purchase' then 'received by hand' else
    concat(case when event_type = 'click' then 'note: ' else '' end, chr(123),
      '"ManufacturingOrderNumber":"M', cast(event_id as varchar(20)),
      '","NodePartNumber":"P', cast(event_id % 200 as varchar(20)),
      '","ReportNumber":"', cast(user_id as varchar(20)),
      '","EmployeeNumber":"', case when event_id % 3 = 0 then '' else concat('E', cast(user_id % 10 as varchar(20))) end,
      '","Comment":"', case when event_id % 4 = 0 then '' else event_type end, '"', chr(125)) end as RawText,
  case event_type when 'signup' then '' when 'purchase' then 'received by hand' else 'see raw text' end as Text
from {events}""",
    "CoordinatedPart": """
select p_partkey as PartId, cast(floor(p_partkey / 4) as bigint) as CoordinatedPartHolderId from {part}""",
    "Currency": """
select cast(r_regionkey as bigint) as Id, upper(substr(r_name, 1, 3)) as Code from {region}""",
    "Customer": """
select c_custkey as Id, c_name as Alias, cast(c_nationkey as bigint) as RootId from {customer}""",
    "CustomerOrder": """
select o_orderkey as Id, concat('O', cast(o_orderkey as varchar(20))) as OrderNumber, o_custkey as BusinessContactId,
  cast(o_orderdate as timestamp) as OrderDate, case o_orderstatus when 'O' then 1 when 'P' then 5 else 9 end as Status,
  case when o_orderpriority = '5-LOW' then 99 else 1 end as LifeCycleState,
  concat('PO', cast(o_custkey as varchar(20))) as BusinessContactOrderNumber,
  cast(case when o_orderkey % 7 = 0 then 0.000061300007 when o_orderstatus = 'P' then 1.25 else 1 end as decimal(24,12)) as ExchangeRate, o_custkey % 5 as CurrencyId
from {orders}""",
    "CustomerOrderDeliveryRow": """
select case when event_id % 4 = 0 then null else event_id end as InvoiceId, event_id as ParentInvoiceId,
  cast(null as bigint) as ParentRowId, event_id as QuantityChangeId, event_id * 10 + 9 as CustomerOrderRowId,
  event_id as CustomerOrderId, 1 as AffectStockBalance, cast(ts as timestamp) as DeliveryDate
from {events} where event_type = 'error'""",
    "CustomerOrderInvoice": """
select event_id as Id, cast(event_id as varchar(20)) as DeliveryNoteNumber,
  concat('O', cast(event_id as varchar(20)), '/1') as OrderDeliveryNumber
from {events} where event_type = 'error'""",
    "CustomerOrderRow": f"""
select l_orderkey * 10 + l_linenumber as Id, l_orderkey as ParentOrderId, l_linenumber as Position, partkey as PartId,
  cast(shipdate as timestamp) as DeliveryDate, cast(quantity as decimal(18,4)) as RestQuantity,
  cast(quantity as decimal(18,4)) as OrderedQuantity, price as Price,
  case returnflag when 'N' then 1 when 'R' then 4 else 2 end as CustomerCommitmentLevel,
  case when tax > 0.075 then 99 else 1 end as LifeCycleState, case when linestatus = 'F' then 9 else 1 end as Status,
  1 as RowStatus, case when l_linenumber % 2 = 0 then concat('CPO', cast(l_orderkey as varchar(20))) end as CustomerOrderNumber,
  cast(l_linenumber % 5 as bigint) as UnitId, cast(1 as bigint) as WarehouseId, 0 as CreationContext, 1 as OrderRowType,
  cast(null as varchar(20)) as FreeText
from ({_LINES}) as a
union all
select event_id * 10 + 9, event_id, 9, user_id, cast(ts as timestamp), cast(value as decimal(18,4)), cast(value as decimal(18,4)),
  cast(value as decimal(18,4)), case when event_id % 2 = 0 then 1 else 4 end, 1, 1, 1, cast(null as varchar(20)), cast(0 as bigint),
  cast(1 as bigint), 0, 1, cast(null as varchar(20))
from {{events}} where event_type in ('signup', 'error')""",
    "CustomerPartLink": """
select l_partkey as PartId, o_custkey as CustomerId,
  concat('C', cast(o_custkey as varchar(20)), '-', cast(l_partkey as varchar(20))) as CustomerPartNumber
from {lineitem} join {orders} on o_orderkey = l_orderkey where l_linestatus = 'O' group by l_partkey, o_custkey""",
    "CustomerRoot": """
select cast(n_nationkey as bigint) as Id, n_name as Name, concat('N', cast(n_nationkey as varchar(20))) as CustomerCode
from {nation}""",
    "DeliverySchedule": """
select o_orderkey as Id, concat('DS', cast(o_orderkey as varchar(20))) as Number,
  case when o_orderkey % 2 = 0 then c_name end as BuyerCustomerCode,
  case when o_orderkey % 3 <> 0 then c_custkey end as BuyerCustomerId,
  case o_orderstatus when 'O' then 1 when 'P' then 3 else 7 end as Status, cast(0 as bigint) as DeliveryScheduleTypeId,
  o_custkey as CustomerId, cast(o_orderdate as timestamp) as CustomerDeliveryScheduleDate
from {orders} join {customer} on c_custkey = o_custkey""",
    "DeliveryScheduleCall": f"""
select l_orderkey * 10 + l_linenumber as Id, l_orderkey * 10 + l_linenumber as ParentId, cast(shipdate as timestamp) as DeliveryDate,
  case returnflag when 'N' then 1 when 'R' then 4 else 2 end as CommitmentLevel,
  case when linestatus = 'F' then 4 else 1 end as DemandType, case when tax < 0.015 then 1 else 0 end as IsReplaced,
  cast(quantity as decimal(18,4)) as Quantity
from ({_LINES}) as a""",
    "DeliverySchedulePart": f"""
select l_orderkey * 10 + l_linenumber as Id, l_orderkey as ParentId, partkey as PartId, 1 as Status, 0 as PreviousStatus,
  l_linenumber as ErrorTypes, 0 as WarningTypes, concat('CPO', cast(l_orderkey as varchar(20))) as CustomerOrderNumber,
  cast(l_linenumber % 5 as bigint) as UnitId
from ({_LINES}) as a""",
    "DeliveryScheduleReconciliationCommandTransferred": f"""
select l_orderkey * 10 + l_linenumber as Id, concat('O', cast(l_orderkey as varchar(20))) as OrderNumber, l_linenumber as Position,
  l_orderkey * 10 + l_linenumber as ParentId, l_orderkey * 10 + l_linenumber as CallId
from ({_LINES}) as a where returnflag <> 'N'""",
    "DeliveryScheduleType": """
select cast(r_regionkey as bigint) as Id, cast(100 + r_regionkey as bigint) as DescriptionId from {region}""",
    "DynamicPhrase": """
select cast(100 + r_regionkey as bigint) as Id, r_name as Text from {region}
union all select cast(200 + n_nationkey as bigint), n_name from {nation}""",
    "EdiBusinessTransaction": """
select o_orderkey as Id, o_orderkey as BusinessEntityId, o_custkey as FileTransactionId
from {orders} where o_orderstatus <> 'F'""",
    "EdiFileTransaction": """
select o_custkey as Id, concat('T', cast(o_custkey as varchar(20))) as TransactionNumber,
  concat('file', cast(o_custkey as varchar(20)), '.edi') as FileName, '/in' as FilePath,
  cast(min(o_orderdate) as timestamp) as FileCreatedWhen
from {orders} group by o_custkey""",
    "EntityChangeLog": """
select o_orderkey as EntityId, concat('U', cast(o_custkey % 10 as varchar(20))) as ModifiedBy, 1 as ChangeType,
  '9A008BAB-1814-43EC-AFA5-4E42A5C3B36C' as EntityTypeId
from {orders} where o_orderpriority <> '1-URGENT'""",
    "ExtraField": """
select p_partkey as ParentId, '6b6b98da-21a0-4ca4-9b88-21631c6ea572' as ParentClass, 1004537098651940025 as TemplateId,
  p_brand as String from {part} where p_size > 10
union all select p_partkey, '6b6b98da-21a0-4ca4-9b88-21631c6ea572', 1028091941218534745, p_type from {part} where p_size > 25
union all select p_partkey, '6b6b98da-21a0-4ca4-9b88-21631c6ea572', 1028374453433595363,
  case when p_size > 40 then p_name end from {part}""",
    "InventoryMovement": """
select event_id * 4 as Id, user_id as PartId, concat('P', cast(user_id as varchar(20))) as PartNumber,
  concat('L', cast(event_id % 3 as varchar(10))) as LocationName, cast(1 as bigint) as WarehouseId,
  case event_type when 'purchase' then 1 when 'error' then 3 when 'signup' then 4 when 'view' then 7 else 11 end
    as BusinessTransactionContextType,
  event_id as BusinessTransactionId,
  cast(case event_type when 'signup' then 0 when 'purchase' then value else -value end as decimal(18,4)) as BalanceChange,
  cast(case when event_type = 'signup' then value end as decimal(18,4)) as PhysicalInventoryBalance,
  cast(value as decimal(18,4)) as BalanceOnPartAfterChange, cast(value as decimal(18,4)) as BalanceOnLocationAfterChange,
  cast(ts as timestamp) as LoggingTimeStamp, cast(cast(ts as date) - cast(event_id % 3 as int) as timestamp) as DeliveryDate,
  event_id as CommentId,
  concat(case event_type when 'error' then 'O' when 'purchase' then 'B' else 'M' end, cast(event_id as varchar(20))) as OrderNumber,
  event_id as QuantityChangeId, concat('U', cast(user_id % 7 as varchar(20))) as UserName,
  case when event_id % 4 = 0 then null else user_id % 10 end as PersonId,
  concat('B', cast(user_id as varchar(20))) as BatchNumber, cast(event_id % 100 as int) as SequenceNumber,
  case when event_id % 10 = 0 then (event_id - 1) * 4 end as UndoMovementId,
  user_id % 5 as ReasonCodeUnplannedStockMovementId
from {events}
union all
select event_id * 4 + 1, user_id, concat('P', cast(user_id as varchar(20))), concat('L', cast((event_id + 1) % 3 as varchar(10))),
  cast(1 as bigint), 7, event_id, cast(value as decimal(18,4)), cast(null as decimal(18,4)), cast(value as decimal(18,4)),
  cast(value as decimal(18,4)), cast(ts as timestamp), cast(cast(ts as date) - cast(event_id % 3 as int) as timestamp),
  cast(null as bigint), cast(null as varchar(20)), event_id, concat('U', cast(user_id % 7 as varchar(20))), user_id % 10,
  concat('B', cast(user_id as varchar(20))), cast(event_id % 100 as int), cast(null as bigint), cast(null as bigint)
from {events} where event_type = 'view'
union all
select (((l_partkey * 3 + l_suppkey % 3) * 10000 + year(l_shipdate)) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)) * 4 + 2,
  l_partkey, concat('P', cast(l_partkey as varchar(20))), concat('L', cast(l_suppkey % 3 as varchar(10))),
  cast(1 as bigint), 4, cast(null as bigint), cast(0 as decimal(18,4)), max(cast(l_quantity as decimal(18,4))),
  max(cast(l_quantity as decimal(18,4))), max(cast(l_quantity as decimal(18,4))), cast(l_shipdate as timestamp),
  cast(l_shipdate as timestamp), cast(null as bigint), cast(null as varchar(20)), cast(null as bigint), 'U0', cast(null as bigint),
  cast(null as varchar(20)), 0, cast(null as bigint), cast(null as bigint)
from {lineitem} where l_linestatus = 'F' group by l_partkey, l_suppkey % 3, l_shipdate""",
    "ManufacturingOrder": """
select o_orderkey as Id, concat('M', cast(o_orderkey as varchar(20))) as OrderNumber,
  case o_orderstatus when 'F' then 5 when 'P' then 3 else 7 end as Status
from {orders}""",
    "ManufacturingOrderMaterial": f"""
select l_orderkey * 10 + l_linenumber as Id, l_orderkey as ManufacturingOrderId, l_orderkey as ManufacturingOrderNodeId,
  partkey as PartId, 10 as ToOperationNo, cast(discount as decimal(18,4)) as QuantityPerUnit,
  cast(quantity as decimal(18,4)) as PlannedQuantity,
  case when returnflag = 'R' then cast(quantity as decimal(18,4)) else cast(tax as decimal(18,4)) end as ReportedQuantity,
  cast(0 as decimal(18,4)) as RejectedQuantity, cast(quantity as decimal(18,4)) as RestQuantity,
  concat('R', cast(l_linenumber as varchar(20))) as ReportNumber
from ({_LINES}) as a
union all
select event_id * 10 + 9, event_id, event_id, user_id, 10, cast(1 as decimal(18,4)), cast(value as decimal(18,4)),
  cast(1 as decimal(18,4)), cast(0 as decimal(18,4)), cast(value as decimal(18,4)), 'R9'
from {{events}} where event_type = 'view'""",
    "ManufacturingOrderMaterialReporting": f"""
select l_orderkey as ReportingId, l_orderkey * 10 + l_linenumber as MaterialId from ({_LINES}) as a""",
    "ManufacturingOrderNode": """
select o_orderkey as Id, o_orderkey as ManufacturingOrderId, o_orderkey % 200 as PartId,
  case o_orderstatus when 'F' then 4 when 'P' then 3 else 7 end as Status
from {orders}""",
    "ManufacturingOrderOperation": """
select o_orderkey as ManufacturingOrderId, o_orderkey as ManufacturingOrderNodeId, 10 as OperationNumber,
  cast(100 as decimal(18,4)) as PlannedQuantity, cast(o_orderkey % 50 as decimal(18,4)) as ReportedQuantity,
  cast(o_orderkey % 5 as decimal(18,4)) as RejectedQuantity, cast(100 - o_orderkey % 50 as decimal(18,4)) as RestQuantity,
  cast(o_orderdate as timestamp) as PlannedStartDate, cast(o_orderdate as timestamp) as PlannedFinishDate,
  cast(o_orderdate as timestamp) as ActualStartDate, cast(null as timestamp) as ActualFinishDate, o_custkey % 30 as WorkCenterId
from {orders}""",
    "ManufacturingOrderOperationReporting": """
select 1000000000000 + event_id as ReportingId, cast(value as decimal(18,4)) as Quantity, cast(event_id % 14 as int) as Type,
  cast(ts as timestamp) as ActualReportedDate
from {events} where event_type = 'click'""",
    "ManufacturingOrderReporting": """
select o_orderkey as Id, o_orderkey as OrderId, cast(o_orderdate as timestamp) as ReportedWhen, o_orderkey as RootNodeId,
  case when o_orderpriority = '1-URGENT' then 6 else 1 end as ReportingType,
  cast(null as bigint) as UndoManufacturingOrderReportingId
from {orders}
union all
select 1000000000000 + event_id, event_id, cast(ts as timestamp), event_id, case when event_id % 6 = 0 then 6 else 1 end,
  case when event_id % 11 = 0 then event_id end
from {events} where event_type = 'click'""",
    "MaterialRow": """
select l_orderkey % 200 as PreparationId, l_partkey as PartId, max(cast(l_quantity as decimal(18,4))) as Quantity
from {lineitem} where l_linestatus = 'F' group by l_orderkey % 200, l_partkey""",
    "OpeningBalance": f"""
select l_suppkey * 10000 + y as Id, debit as DebitInCompanyCurrency, credit as CreditInCompanyCurrency
from ({_ACCOUNT_YEARS}) as a""",
    "OrderOperationSuggestion": """
select user_id as PartId, cast(value as decimal(18,4)) as PlannedQuantity, cast(ts as timestamp) as PlannedFinishDate
from {events} where event_type = 'click'""",
    "OrderSuggestion": """
select user_id as PartId, cast(value as decimal(18,4)) as OrderedQuantity, case when event_id % 2 = 0 then 3 else 1 end as TransType,
  cast(ts as timestamp) as DeliveryDate
from {events} where event_type = 'purchase'""",
    "Part": """
select p_partkey as Id, concat('P', cast(p_partkey as varchar(20))) as PartNumber, p_name as Description,
  concat(case p_size % 8 when 0 then 'R-CRUSH ' when 1 then 'R-MB-' when 2 then 'M-' when 3 then 'E-' when 4 then 'F-'
    else 'R-' end, p_type) as ExtraDescription,
  case when p_type = 'PROMO' then null else p_partkey end as StandardPartUnitUsageId, p_partkey as PreparationId,
  case when p_size > 47 then 9 else 1 end as Status, cast(p_size % 5 as bigint) as PartCodeId,
  cast(p_size % 5 as bigint) as ProductGroupId, p_type as CategoryString, p_size % 3 as Type
from {part}""",
    "PartCode": "select cast(r_regionkey as bigint) as Id from {region}",
    "PartLocation": """
select l_partkey as PartId, case l_suppkey % 3 when 0 then 'WHCC-PROD' else concat('L', cast(l_suppkey % 3 as varchar(10))) end as Name,
  cast(sum(cast(l_quantity as decimal(18,4))) as decimal(18,4)) as Balance,
  case when l_suppkey % 3 = 2 then 99 else 1 end as LifeCycleState, cast(1 as bigint) as WarehouseId
from {lineitem} group by l_partkey, l_suppkey % 3""",
    "PartPreparation": "select p_partkey as Id, p_partkey as PartId from {part}",
    "PartUnitUsage": """
select p_partkey as Id, p_partkey as PartId, cast(p_size % 5 as bigint) as UnitId,
  case when p_size % 5 = 0 then null else cast(p_size as decimal(18,4)) end as ConversionFactor
from {part}""",
    "Person": """
select s_suppkey as Id, case when s_suppkey % 5 = 0 then '' else concat('E', cast(s_suppkey as varchar(20))) end as EmployeeNumber,
  s_name as FirstName, concat('of ', cast(s_nationkey as varchar(20))) as LastName
from {supplier}""",
    "PriceChangeLog": """
select l_partkey as PartId, cast(null as bigint) as CustomerId, max(cast(l_extendedprice as decimal(18,4))) as NewPrice,
  min(cast(l_extendedprice as decimal(18,4))) as OldPrice, 'U1' as UserCode, cast(l_shipdate as timestamp) as Timestamp,
  cast(0 as bigint) as OldPriceCurrencyId, cast(1 as bigint) as NewPriceCurrencyId, 0 as PriceType, 0 as IsSetupPrice
from {lineitem} where l_returnflag = 'N' group by l_partkey, l_shipdate
union all
select l_partkey, o_custkey, max(cast(l_extendedprice as decimal(18,4))), min(cast(l_extendedprice as decimal(18,4))),
  'U2', cast(o_orderdate as timestamp), cast(0 as bigint), o_custkey % 5, 3, 0
from {lineitem} join {orders} on o_orderkey = l_orderkey group by l_partkey, o_custkey, o_orderdate""",
    "ProductGroup": """
select cast(r_regionkey as bigint) as Id,
  case r_regionkey when 0 then '024' when 1 then null else concat('G', cast(r_regionkey as varchar(10))) end as Number
from {region}""",
    "ProductRecord": """
select concat('B', cast(p_partkey as varchar(20)), ' - ', 'P', cast(p_partkey as varchar(20))) as SerialNumberWithPartNumber
from {part} where p_size > 10""",
    "Project": """
select cast(n_nationkey as bigint) as Id, n_name as Code from {nation}""",
    "PurchaseOrder": """
select event_id as Id, concat('B', cast(event_id as varchar(20))) as OrderNumber, user_id % 10 as BusinessContactId
from {events} where event_type = 'purchase'""",
    "PurchaseOrderDelivery": "select event_id as Id from {events} where event_type = 'purchase'",
    "PurchaseOrderDeliveryRow": """
select event_id as Id, event_id as PurchaseOrderDeliveryId, event_id as PurchaseOrderRowId, cast(ts as timestamp) as DeliveryDate
from {events} where event_type = 'purchase'""",
    "PurchaseOrderDeliveryRowQuantity": """
select event_id as ParentId, case when value > 5 then 1 else 18 end as BusinessTransactionContextType, event_id as QuantityChangeId
from {events} where event_type = 'purchase'""",
    "PurchaseOrderRow": "select event_id as Id, user_id as PartId from {events} where event_type = 'purchase'",
    "QuantityChange": """
select event_id as Id, cast(value as decimal(18,4)) as BalanceChange, cast(3 + event_id % 4 as int) as Status from {events}""",
    "ReasonCodeUnplannedStockMovement": """
select cast(r_regionkey as bigint) as Id, concat('RC', cast(r_regionkey as varchar(10))) as Code,
  cast(100 + r_regionkey as bigint) as DescriptionId
from {region}""",
    "Supplier": "select s_suppkey as Id, cast(s_nationkey as bigint) as RootId from {supplier}",
    "SupplierRoot": """
select cast(n_nationkey as bigint) as Id, concat('S', cast(n_nationkey as varchar(20))) as SupplierCode from {nation}""",
    "UndoReportingLog": """
select cast(u.ts as timestamp) as LoggingTimeStamp, concat('O', cast(e.event_id as varchar(20)), '/1') as EntityIndentity,
  concat('U', cast(u.user_id % 7 as varchar(20))) as UserName, 1 as Type
from {events} e join {events} u on u.event_id = e.event_id - 1 where e.event_type = 'error'""",
    "Unit": """
select cast(r_regionkey as bigint) as Id, cast(100 + r_regionkey as bigint) as CodeId from {region}""",
    "Voucher": """
select o_orderkey as Id, cast(o_orderdate as timestamp) as VoucherDate, concat('voucher ', o_orderpriority) as Text,
  cast(o_orderkey as varchar(20)) as Number, o_custkey % 5 as SeriesId, cast(year(o_orderdate) as bigint) as AccountingYearId,
  case when o_orderstatus = 'F' then o_custkey end as AccountsReceivableLedgerId,
  case when o_orderstatus = 'P' then o_custkey end as AccountsPayableLedgerId,
  case when o_orderstatus = 'O' then o_orderkey end as AccountsReceivableId,
  case when o_orderpriority = '5-LOW' then 1 else 0 end as IsPreliminary
from {orders}""",
    "VoucherRow": """
select l_orderkey as VoucherId, l_suppkey * 10000 + year(o_orderdate) as BalanceId,
  cast(case when l_returnflag <> 'R' then l_extendedprice else 0 end as decimal(18,4)) as Debit,
  cast(case when l_returnflag = 'R' then l_extendedprice else 0 end as decimal(18,4)) as Credit,
  cast(case when l_returnflag <> 'R' then l_extendedprice else 0 end as decimal(18,4)) as DebitInCompanyCurrency,
  cast(case when l_returnflag = 'R' then l_extendedprice else 0 end as decimal(18,4)) as CreditInCompanyCurrency
from {lineitem} join {orders} on o_orderkey = l_orderkey""",
    "VoucherSeries": """
select cast(r_regionkey as bigint) as Id, substr(r_name, 1, 2) as Series from {region}""",
    "Warehouse": "select cast(r_regionkey as bigint) as Id from {region}",
    "WorkCenter": """
select cast(n_nationkey as bigint) as Id, concat('WC', cast(n_nationkey as varchar(20))) as Number from {nation}""",
}

ROLES = {
    "v_movement": """
select event_id as movement_id, user_id as part_id, concat('L', cast(event_id % 3 as varchar(10))) as location_name,
  case event_type when 'purchase' then 1 when 'error' then 3 when 'signup' then 4 when 'view' then 7 else 11 end as type_code,
  cast(case when event_type = 'signup' then 0 when event_type = 'purchase' then value
            when event_type = 'view' and event_id % 2 = 0 then value else -value end as decimal(18,4)) as balance_change,
  cast(case when event_type = 'signup' then value end as decimal(18,4)) as physical_balance,
  ts as logging_ts, cast(ts as date) - cast(event_id % 3 as int) as delivery_date,
  case when event_id % 10 = 0 then event_id - 1 end as undo_movement_id, props as comment_raw
from {events}""",
    "v_price": """
select l_partkey as part_id, l_shipdate as price_ts, cast(max(l_extendedprice) as decimal(18,4)) as new_price
from {lineitem} where l_returnflag = 'N' group by l_partkey, l_shipdate""",
    "v_count": """
select l_partkey as part_id, concat('L', cast(l_suppkey % 3 as varchar(10))) as location_name, l_shipdate as delivery_date,
  cast(max(l_quantity) as decimal(18,4)) as physical_balance
from {lineitem} where l_linestatus = 'F'
group by l_partkey, concat('L', cast(l_suppkey % 3 as varchar(10))), l_shipdate""",
    "v_part": """
select p_partkey as part_id, concat('P', cast(p_partkey as varchar(20))) as part_number, p_name as part_name, p_type as category,
  p_brand as holder_id, case when p_size % 5 = 0 then null else p_size end as conversion_factor,
  cast(p_retailprice as decimal(18,4)) as price
from {part}""",
    "v_order": """
select o_orderkey as order_id, concat('O', cast(o_orderkey as varchar(20))) as order_number, o_custkey as customer_id,
  o_orderdate as order_date, case o_orderstatus when 'O' then 1 when 'P' then 5 else 9 end as status, o_orderpriority as priority
from {orders}""",
    "v_order_row": """
select l_orderkey as order_id, l_linenumber as position, l_partkey as part_id, l_suppkey as supplier_id, l_shipdate as delivery_date,
  cast(l_quantity as decimal(18,4)) as rest_quantity, cast(l_extendedprice as decimal(18,4)) as price,
  case l_returnflag when 'N' then 1 when 'R' then 4 else 2 end as commitment_level, l_linestatus as line_status
from {lineitem}""",
    "v_voucher": """
select o_orderkey as voucher_id, o_orderstatus as series, o_orderdate as voucher_date, year(o_orderdate) as accounting_year
from {orders}""",
    "v_voucher_row": """
select l_orderkey as voucher_id, l_suppkey as account_id,
  cast(case when l_returnflag <> 'R' then l_extendedprice else 0 end as decimal(18,4)) as debit,
  cast(case when l_returnflag = 'R' then l_extendedprice else 0 end as decimal(18,4)) as credit
from {lineitem}""",
    "v_bom": """
select distinct l_partkey as part_id, l_suppkey as material_id from {lineitem} where l_linestatus = 'F'""",
    "v_reported": """
select distinct l_orderkey as order_id, l_partkey as part_id, l_suppkey as material_id from {lineitem} where l_linestatus = 'O'""",
    "v_schedule_call": """
select l_orderkey as schedule_id, l_linenumber as position, l_partkey as part_id, o_custkey as customer_id,
  year(o_orderdate) as version, l_shipdate as delivery_date, cast(l_quantity as decimal(18,4)) as quantity,
  case when l_orderkey % 2 = 0 then c_name end as buyer_code, case when l_orderkey % 3 <> 0 then c_custkey end as buyer_id
from {lineitem} join {orders} on o_orderkey = l_orderkey join {customer} on c_custkey = o_custkey""",
    "v_document": """
select event_id as movement_id, user_id, ts as logging_ts, cast(ts as date) as day,
  case when event_type <> 'error' and event_id >= 5 then cast(event_id as varchar(20)) end as document_number
from {events}""",
    "v_attribute": """
select p_partkey as parent_id, 1 as template_id, p_brand as string_value from {part} where p_size > 10
union all select p_partkey, 2, p_type from {part} where p_size > 25""",
    "v_comment": """
select event_id as comment_id,
  case event_type when 'signup' then '' when 'purchase' then 'received by hand' else
    concat(case when event_type = 'click' then 'note: ' else '' end, chr(123),
      '"OrderNumber":"M', cast(event_id as varchar(20)), '","Comment":"', case when event_id % 4 = 0 then '' else event_type end,
      '"', case when event_type = 'error' then '' else chr(125) end) end as raw_text
from {events}""",
    "v_undo_log": """
select event_id as log_id, concat('U', cast(user_id as varchar(20)), '/', event_type, '/', cast(event_id as varchar(20))) as entity_text,
  ts as logging_ts
from {events}""",
}


def demo_frame(spark: SparkSession, sf_dir: str, sql: str, **given: DataFrame) -> DataFrame:
    """A portable SELECT run by Spark over the test tables of one folder, or over the frames given by name."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES if "{" + t + "}" in sql and t not in given}
    return spark.sql(sql, **used, **given)


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return demo_frame(spark, sf_dir, ROLES[name])


def demo_catalog(spark: SparkSession, sf_dir: str, zone: str | None = None, lines_once: bool = False) -> Catalog:
    """The business tables, reported in ``zone``; results read several times go to the shared folder, where the session names one.

    With ``lines_once`` the order lines are one of these results. Use it for reports that read several tables
    made of order lines: each would group all lines again.
    """
    workdir = spark.conf.get("spark.checkpoint.dir", None)
    kept: dict[str, DataFrame] = {}

    def load(name: str) -> DataFrame:
        sql = TABLES[name]
        if not (lines_once and workdir and f"({_LINES})" in sql):
            return demo_frame(spark, sf_dir, sql)
        if not kept:
            # Least texts are found by sorting. Few lines are alike, so that is done behind the shuffle alone.
            rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition("l_orderkey", "l_linenumber")
            kept["lines"] = staged(demo_frame(spark, sf_dir, _LINES, lineitem=rows), workdir)
        return demo_frame(spark, sf_dir, sql.replace(f"({_LINES})", "{lines}"), **kept)

    return Catalog(spark, load, fill_missing=True, workdir=workdir, zone=zone)


def check_sql(body: str) -> str:
    """DuckDB SQL for a check: the views its text names are put in front as CTEs.

    Role views go by their own name, catalog tables as ``t_<Table>``.
    """
    names = sorted(set(re.findall(r"\bv_\w+", body)) & set(ROLES))
    tables = sorted(set(re.findall(r"\bt_(\w+)", body)) & set(TABLES))
    parts = [f"{n} as ({ROLES[n]})" for n in names] + [f"t_{n} as ({TABLES[n]})" for n in tables]
    body = body.strip()
    if not parts:
        return body
    filled = re.sub(r"\{(\w+)\}", r"\1", ",\n".join(parts))
    if body.lower().startswith("with recursive "):
        return f"with recursive {filled},\n{body[len('with recursive '):]}"
    if body.lower().startswith("with "):
        return f"with {filled},\n{body[len('with '):]}"
    return f"with {filled}\n{body}"
