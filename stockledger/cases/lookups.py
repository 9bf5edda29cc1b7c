"""Operators in time: running values, as-of lookups, ranges, spines."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockledger.cases.registry import case
from stockledger.operators import joins, scan, spine, temporal
from stockledger.sources.demo import role


@case(
    "i:part_id s:location_name d:delivery_date i:movement_id n:physical_balance",
    """
select part_id, location_name, delivery_date, movement_id, physical_balance
from v_movement where type_code = 4
qualify row_number() over (partition by part_id, location_name order by logging_ts desc, movement_id desc) = 1""",
)
def latest_per_group(spark, sf_dir):
    counts = role(spark, sf_dir, "v_movement").filter("type_code = 4")
    return temporal.latest_per_group(
        counts, ["part_id", "location_name"], [F.col("logging_ts").desc(), F.col("movement_id").desc()]
    )


@case(
    "i:part_id s:location_name d:delivery_date n:physical_balance n:new_price",
    """
select c.part_id, c.location_name, c.delivery_date, c.physical_balance, p.new_price
from v_count c asof left join v_price p on c.part_id = p.part_id and c.delivery_date >= p.price_ts""",
)
def asof_join(spark, sf_dir):
    return temporal.asof_join(
        role(spark, sf_dir, "v_count"),
        role(spark, sf_dir, "v_price"),
        ["part_id"],
        "delivery_date",
        "price_ts",
        ["new_price"],
    )


@case(
    "i:part_id d:day n:physical_balance t:counted_at",
    """
with days as (select distinct part_id, cast(logging_ts as date) as day from v_movement),
counts as (select * from v_movement where type_code = 4),
hits as (
  select d.part_id, d.day, c.physical_balance, c.logging_ts as counted_at,
    row_number() over (partition by d.part_id, d.day order by c.logging_ts desc, c.movement_id desc) as rn
  from days d join counts c on c.part_id = d.part_id and c.delivery_date <= d.day)
select d.part_id, d.day, h.physical_balance, h.counted_at
from days d left join hits h on h.part_id = d.part_id and h.day = d.day and h.rn = 1""",
)
def asof_max_by(spark, sf_dir):
    movement = role(spark, sf_dir, "v_movement")
    days = movement.select("part_id", F.to_date("logging_ts").alias("day")).distinct()
    counts = movement.filter("type_code = 4").withColumn("counted_at", F.col("logging_ts"))
    return temporal.asof_max_by(
        days,
        counts,
        ["part_id"],
        "day",
        "delivery_date",
        ["logging_ts", "movement_id"],
        ["physical_balance", "counted_at"],
        dedupe=False,
    )


@case(
    "i:movement_id i:part_id n:received_since n:issued_since",
    """
with counts as (select * from v_movement where type_code = 4),
sums as (
  select c.movement_id, sum(case when m.balance_change > 0 then m.balance_change else 0 end) as received_since,
    sum(case when m.balance_change < 0 then m.balance_change else 0 end) as issued_since
  from counts c join v_movement m on m.part_id = c.part_id and m.location_name = c.location_name
    and m.type_code <> 4 and m.logging_ts >= c.logging_ts
  group by c.movement_id)
select c.movement_id, c.part_id, coalesce(s.received_since, 0) as received_since, coalesce(s.issued_since, 0) as issued_since
from counts c left join sums s on s.movement_id = c.movement_id""",
)
def sum_in_range(spark, sf_dir):
    movement = role(spark, sf_dir, "v_movement")
    change, zero = F.col("balance_change"), F.lit(0).cast("decimal(18,4)")
    return temporal.sum_in_range(
        movement.filter("type_code = 4"),
        movement.filter("type_code <> 4"),
        ["part_id", "location_name"],
        "logging_ts",
        "logging_ts",
        {
            "received_since": F.when(change > 0, change).otherwise(zero),
            "issued_since": F.when(change < 0, change).otherwise(zero),
        },
    )


@case(
    "i:schedule_id i:position i:part_id i:customer_id i:version d:delivery_date n:quantity",
    """
select schedule_id, position, part_id, customer_id, version, delivery_date, quantity from v_schedule_call c
where version = (select max(version) from v_schedule_call n where n.part_id = c.part_id and n.customer_id = c.customer_id)""",
)
def latest_version(spark, sf_dir):
    return temporal.latest_version(role(spark, sf_dir, "v_schedule_call"), ["part_id", "customer_id"], "version")


@case(
    "i:order_id s:order_number i:part_id n:price",
    """
select o.order_id, o.order_number, r.part_id, r.price
from v_order o left join lateral (
  select part_id, price from v_order_row x where x.order_id = o.order_id
  order by x.price desc, x.part_id, x.position limit 1) r on true""",
)
def outer_apply_top1(spark, sf_dir):
    return temporal.outer_apply_top1(
        role(spark, sf_dir, "v_order"),
        role(spark, sf_dir, "v_order_row").select("order_id", "part_id", "position", "price"),
        ["order_id"],
        [F.col("price").desc(), F.col("part_id"), F.col("position")],
    )


@case(
    "i:order_id i:linked_part s:part_number s:part_name",
    """
with picked as (select order_id, min(part_id) as linked_part from v_order_row group by order_id)
select o.order_id, k.linked_part, p.part_number, p.part_name
from v_order o left join picked k on k.order_id = o.order_id left join v_part p on p.part_id = k.linked_part""",
)
def first_match_join(spark, sf_dir):
    links = role(spark, sf_dir, "v_order_row").withColumnRenamed("part_id", "linked_part")
    return temporal.first_match_join(
        role(spark, sf_dir, "v_order"),
        links,
        "order_id",
        "linked_part",
        [F.col("linked_part").asc_nulls_last()],
        role(spark, sf_dir, "v_part"),
        "part_id",
    )


@case(
    "i:account_id i:voucher_id n:difference n:running_difference",
    """
with d as (
  select r.account_id, r.voucher_id, v.voucher_date, sum(r.debit - r.credit) as difference
  from v_voucher_row r join v_voucher v on v.voucher_id = r.voucher_id group by r.account_id, r.voucher_id, v.voucher_date)
select account_id, voucher_id, difference, sum(difference) over (
  partition by account_id order by voucher_date, voucher_id rows unbounded preceding) as running_difference
from d""",
)
def running_total(spark, sf_dir):
    rows = role(spark, sf_dir, "v_voucher_row")
    vouchers = role(spark, sf_dir, "v_voucher")
    per_voucher = (
        rows.groupBy("account_id", "voucher_id")
        .agg(F.sum(F.col("debit") - F.col("credit")).alias("difference"))
        .join(vouchers, "voucher_id")
    )
    return scan.running_total(
        per_voucher,
        ["account_id"],
        ["voucher_date", "voucher_id"],
        "difference",
        "running_difference",
        cells=scan.EvenCells(),
    )


_FILL_COLUMNS = "i:movement_id i:user_id t:logging_ts s:document_number s:filled_number"


@case(
    _FILL_COLUMNS,
    """
select movement_id, user_id, logging_ts, document_number,
  last_value(document_number ignore nulls) over (
    order by logging_ts, movement_id rows between unbounded preceding and current row) as filled_number
from v_document""",
)
def fill_forward(spark, sf_dir):
    documents = role(spark, sf_dir, "v_document")
    return scan.fill_forward(
        documents, [], ["logging_ts", "movement_id"], "document_number", "filled_number",
        cells=scan.EvenCells(),
    )


@case(
    _FILL_COLUMNS,
    """
select movement_id, user_id, logging_ts, document_number,
  first_value(document_number ignore nulls) over (
    partition by user_id order by logging_ts, movement_id rows between current row and unbounded following) as filled_number
from v_document""",
)
def fill_backward(spark, sf_dir):
    documents = role(spark, sf_dir, "v_document")
    return scan.fill_backward(
        documents, ["user_id"], ["logging_ts", "movement_id"], "document_number", "filled_number",
        cells=scan.time_cells("logging_ts", "day"),
    )


@case(
    "i:movement_id i:island s:previous_number s:next_number i:steps_after i:steps_before",
    """
with marked as (
  select *, sum(case when document_number is null then 0 else 1 end) over (order by logging_ts, movement_id) as island from v_document)
select movement_id, island,
  last_value(document_number ignore nulls) over (order by logging_ts, movement_id rows unbounded preceding) as previous_number,
  first_value(document_number ignore nulls) over (
    order by logging_ts, movement_id rows between current row and unbounded following) as next_number,
  case when document_number is null then sum(case when document_number is null then 1 else 0 end)
    over (partition by island order by logging_ts, movement_id) end as steps_after,
  case when document_number is null then sum(case when document_number is null then 1 else 0 end)
    over (partition by island order by logging_ts desc, movement_id desc) end as steps_before
from marked""",
)
def number_islands(spark, sf_dir):
    return scan.fill_gaps(
        role(spark, sf_dir, "v_document"), [], ["logging_ts", "movement_id"], "document_number",
        cells=scan.EvenCells(),
    )


@case(
    "d:day i:orders n:ordered",
    """
with recursive s(day) as (
  select min(cast(o_orderdate as date)) from orders
  union all select cast(day + interval 1 day as date) from s where day < (select max(cast(o_orderdate as date)) from orders))
select s.day, count(o_orderkey) as orders, coalesce(sum(cast(o_totalprice as decimal(18,4))), 0) as ordered
from s left join orders on cast(o_orderdate as date) = s.day group by s.day""",
)
def date_spine(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    daily = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("o_orderkey").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("ordered")
    )
    ends = daily.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = ends.select(F.explode(spine.days_between(F.col("first"), F.col("last"))).alias("day"))
    return days.join(daily, "day", "left").fillna(0, ["orders", "ordered"])


@case(
    "s:month i:calls n:quantity",
    """
with recursive m(month) as (
  select '1997-01' union all
  select strftime(cast(month || '-01' as date) + interval 1 month, '%Y-%m') from m where month < '1997-12')
select m.month, count(c.schedule_id) as calls, coalesce(sum(c.quantity), 0) as quantity
from m left join v_schedule_call c on strftime(c.delivery_date, '%Y-%m') = m.month group by m.month""",
)
def month_spine(spark, sf_dir):
    calls = role(spark, sf_dir, "v_schedule_call").filter("delivery_date >= '1997-01-01' and delivery_date < '1998-01-01'")
    monthly = calls.groupBy(F.date_format("delivery_date", "yyyy-MM").alias("month")).agg(
        F.count("schedule_id").alias("calls"), F.sum("quantity").alias("quantity")
    )
    return spine.month_spine(spark, 1997).join(monthly, "month", "left").fillna(0, ["calls", "quantity"])


@case(
    "i:voucher_id i:account_id n:debit n:credit n:difference",
    """
select v.voucher_id, r.account_id, r.debit, r.credit, r.debit - r.credit as difference
from v_voucher v left join (
  select voucher_id, account_id, sum(debit) as debit, sum(credit) as credit from v_voucher_row group by voucher_id, account_id) r
  on r.voucher_id = v.voucher_id""",
)
def outer_apply_group(spark, sf_dir):
    applied = joins.outer_apply_group(
        role(spark, sf_dir, "v_voucher"),
        role(spark, sf_dir, "v_voucher_row"),
        ["voucher_id"],
        ["account_id"],
        {"debit": F.col("debit"), "credit": F.col("credit")},
    )
    return applied.withColumn("difference", F.col("debit") - F.col("credit"))
