"""Filters, joins, groupings and set operations, plain ones and those of the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockledger.cases.registry import case
from stockledger.functions import text
from stockledger.operators import joins
from stockledger.sources.demo import role

PARTS = ("P1", "P7", "P19", "P150", "P999999")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@case(
    "i:order_id i:position i:part_id d:delivery_date n:rest_quantity s:currency",
    """
select l_orderkey as order_id, l_linenumber as position, l_partkey as part_id, l_shipdate as delivery_date,
  cast(l_quantity as decimal(18,4)) as rest_quantity, 'IDR' as currency
from lineitem where l_shipdate between timestamp '1996-01-01' and timestamp '1997-12-31' and l_returnflag in ('N', 'R')
  and l_linenumber not in (7) and l_quantity >= 5 and l_linestatus <> 'F'""",
)
def scan_filter(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    return rows.filter(
        F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1997-12-31").cast("timestamp_ntz"))
        & F.col("l_returnflag").isin("N", "R")
        & ~F.col("l_linenumber").isin(7)
        & (F.col("l_quantity") >= 5)
        & (F.col("l_linestatus") != "F")
    ).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_shipdate").alias("delivery_date"),
        F.col("l_quantity").cast("decimal(18,4)").alias("rest_quantity"),
        F.lit("IDR").alias("currency"),
    )


@case(
    "i:part_id s:part_number i:orders",
    "select p.part_id, p.part_number, count(distinct r.order_id) as orders from v_part p join v_order_row r on r.part_id = p.part_id "
    f"where p.part_number in {PARTS} group by p.part_id, p.part_number",
)
def in_list_param(spark, sf_dir):
    wanted = role(spark, sf_dir, "v_part").filter(F.col("part_number").isin(*PARTS))
    return (
        wanted.join(role(spark, sf_dir, "v_order_row"), "part_id")
        .groupBy("part_id", "part_number")
        .agg(F.countDistinct("order_id").alias("orders"))
    )


@case(
    "i:part_id s:part_name",
    """
select part_id, part_name from v_part
where part_name like 'r%' and part_name not like '%bolt%' and part_name not like 'red gear' and category is not null
  and (holder_id <> 'Brand#4' or holder_id is null)""",
)
def like_filter(spark, sf_dir):
    name = F.col("part_name")
    return role(spark, sf_dir, "v_part").filter(
        name.startswith("r")
        & ~name.contains("bolt")
        & (name != "red gear")
        & F.col("category").isNotNull()
        & ~F.col("holder_id").eqNullSafe("Brand#4")
    )


@case(
    "i:order_id i:position n:value n:discounted n:saved",
    """
select order_id, position, value, discounted, value - discounted as saved from (
  select l_orderkey as order_id, l_linenumber as position, cast(l_extendedprice as decimal(18,4)) as value,
    cast(l_extendedprice as decimal(18,4)) * (1 - cast(l_discount as decimal(18,4))) as discounted from lineitem) x
where value - discounted > 100""",
)
def alias_chain(spark, sf_dir):
    return (
        _table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("position"),
            F.col("l_extendedprice").cast("decimal(18,4)").alias("value"),
            F.col("l_discount").cast("decimal(18,4)").alias("discount"),
        )
        .withColumn("discounted", F.col("value") * (1 - F.col("discount")))
        .withColumn("saved", F.col("value") - F.col("discounted"))
        .filter("saved > 100")
    )


@case(
    "i:part_id s:period n:quantity i:first_order i:last_order",
    """
select part_id, strftime(delivery_date, '%Y-%m') as period, sum(rest_quantity) as quantity, min(order_id) as first_order,
  max(order_id) as last_order
from v_order_row group by part_id, strftime(delivery_date, '%Y-%m')""",
)
def group_by_alias(spark, sf_dir):
    return (
        role(spark, sf_dir, "v_order_row")
        .withColumn("period", F.date_format("delivery_date", "yyyy-MM"))
        .groupBy("part_id", "period")
        .agg(
            F.sum("rest_quantity").alias("quantity"),
            F.min("order_id").alias("first_order"),
            F.max("order_id").alias("last_order"),
        )
    )


@case(
    "s:second s:document s:user_name i:entries t:first_logged",
    """
select strftime(logging_ts, '%Y-%m-%d %H:%M:%S') as second, split_part(entity_text, '/', 1) as document,
  right(entity_text, 1) as user_name, count(*) as entries, min(logging_ts) as first_logged
from v_undo_log group by 1, 2, 3""",
)
def group_by_expr(spark, sf_dir):
    return (
        role(spark, sf_dir, "v_undo_log")
        .groupBy(
            F.date_format("logging_ts", "yyyy-MM-dd HH:mm:ss").alias("second"),
            text.text_before(F.col("entity_text"), "/").alias("document"),
            F.right("entity_text", F.lit(1)).alias("user_name"),
        )
        .agg(F.count("*").alias("entries"), F.min("logging_ts").alias("first_logged"))
    )


@case(
    "i:part_id s:location_name",
    "select distinct part_id, location_name from v_movement where delivery_date between date '2024-01-05' and date '2024-01-20'",
)
def distinct_domain(spark, sf_dir):
    in_range = F.col("delivery_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date"))
    return role(spark, sf_dir, "v_movement").filter(in_range).select("part_id", "location_name").distinct()


@case(
    "i:order_id s:order_number i:part_id n:price",
    "select o.order_id, o.order_number, r.part_id, r.price from v_order o join v_order_row r on r.order_id = o.order_id where o.status <> 9",
)
def join_inner(spark, sf_dir):
    return role(spark, sf_dir, "v_order").filter("status <> 9").join(role(spark, sf_dir, "v_order_row"), "order_id")


@case(
    "i:order_id s:customer s:nation s:region",
    """
select o.order_id, c.c_name as customer, n.n_name as nation, r.r_name as region
from v_order o left join customer c on c.c_custkey = o.customer_id left join nation n on n.n_nationkey = c.c_nationkey
left join region r on r.r_regionkey = n.n_regionkey""",
)
def join_left(spark, sf_dir):
    customer, nation, region = (_table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        role(spark, sf_dir, "v_order")
        .join(customer, F.col("customer_id") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "order_id", F.col("c_name").alias("customer"), F.col("n_name").alias("nation"), F.col("r_name").alias("region")
        )
    )


@case(
    "i:part_id s:part_number s:location_name n:physical_balance",
    """
select p.part_id, p.part_number, c.location_name, c.physical_balance
from v_part p left join v_count c on c.part_id = p.part_id and c.location_name like 'L0' and c.physical_balance > 40""",
)
def join_left_residual(spark, sf_dir):
    counts = role(spark, sf_dir, "v_count").filter("location_name = 'L0' and physical_balance > 40")
    return role(spark, sf_dir, "v_part").join(counts, "part_id", "left")


@case(
    "i:movement_id i:part_id t:logging_ts t:undo_logging_ts i:undo_part_id",
    """
select m.movement_id, m.part_id, m.logging_ts, u.logging_ts as undo_logging_ts, u.part_id as undo_part_id
from v_movement m left join v_movement u on u.movement_id = m.undo_movement_id""",
)
def undo_link(spark, sf_dir):
    movement = role(spark, sf_dir, "v_movement")
    undone = movement.select(
        F.col("movement_id").alias("undo_movement_id"),
        F.col("logging_ts").alias("undo_logging_ts"),
        F.col("part_id").alias("undo_part_id"),
    )
    return movement.join(undone, "undo_movement_id", "left")


@case(
    "i:schedule_id i:position i:c_custkey s:buyer_code i:buyer_id n:quantity",
    """
select s.schedule_id, s.position, c.c_custkey, s.buyer_code, s.buyer_id, s.quantity
from v_schedule_call s join customer c on c.c_name = s.buyer_code or c.c_custkey = s.buyer_id""",
)
def or_join(spark, sf_dir):
    calls = role(spark, sf_dir, "v_schedule_call")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return joins.or_join(calls, customers, [("buyer_code", "c_name"), ("buyer_id", "c_custkey")])


@case(
    "s:user_key i:c_custkey i:log_id s:entity_text",
    """
select c.user_key, c.c_custkey, u.log_id, u.entity_text
from (select concat('U', cast(c_custkey as varchar)) as user_key, c_custkey from customer) c
join v_undo_log u on u.entity_text like concat(c.user_key, '/%')""",
)
def prefix_join(spark, sf_dir):
    users = _table(spark, sf_dir, "customer").select(
        text.concat_text("U", F.col("c_custkey")).alias("user_key"), "c_custkey"
    )
    return joins.prefix_join(users, role(spark, sf_dir, "v_undo_log"), "user_key", "entity_text")


@case(
    "i:movement_id i:part_id s:batch s:part_name s:month i:counts",
    """
with counts as (select strftime(delivery_date, '%m') as month, count(*) as counts from v_count group by 1)
select m.movement_id, m.part_id, p.batch, p.part_name, c.month, c.counts
from v_movement m
left join (select concat('B', part_id, ' - ', part_number) as batch, part_name from v_part) p
  on p.batch = 'B' || cast(m.part_id as varchar) || ' - P' || cast(m.part_id as varchar)
left join counts c on c.month = strftime(m.logging_ts, '%m')""",
)
def computed_key_join(spark, sf_dir):
    parts = role(spark, sf_dir, "v_part").select(
        text.plus_text("B", F.col("part_id"), " - ", F.col("part_number")).alias("batch"), "part_name"
    )
    counts = (
        role(spark, sf_dir, "v_count")
        .groupBy(F.date_format("delivery_date", "MM").alias("month"))
        .agg(F.count("*").alias("counts"))
    )
    movement = role(spark, sf_dir, "v_movement").select("movement_id", "part_id", "logging_ts")
    key = text.plus_text("B", F.col("part_id"), " - P", F.col("part_id"))
    return movement.join(parts, key == F.col("batch"), "left").join(
        counts, F.date_format("logging_ts", "MM") == F.col("month"), "left"
    )


@case(
    "i:movement_id i:type_code s:order_number s:part_name",
    """
select m.movement_id, m.type_code, o.order_number, p.part_name
from v_movement m left join v_order o on o.order_id = m.movement_id and m.type_code in (3, 9, 14, 29)
left join v_part p on p.part_id = m.movement_id and m.type_code in (2, 11, 16, 17)""",
)
def typed_lookup(spark, sf_dir):
    orders = role(spark, sf_dir, "v_order").select(
        text.concat_text("N", F.col("order_id")).alias("order_key"), "order_number"
    )
    parts = role(spark, sf_dir, "v_part").select(text.concat_text("N", F.col("part_id")).alias("part_key"), "part_name")
    movement = role(spark, sf_dir, "v_movement").withColumn("doc_number", text.concat_text("N", F.col("movement_id")))
    return joins.typed_lookup(
        movement,
        "doc_number",
        "type_code",
        [(orders, "order_key", [3, 9, 14, 29]), (parts, "part_key", [2, 11, 16, 17])],
    )


@case(
    "i:part_id s:part_number s:brand s:kind",
    """
select p.part_id, p.part_number, a.string_value as brand, b.string_value as kind
from v_part p left join v_attribute a on a.parent_id = p.part_id and a.template_id = 1 and a.string_value is not null
left join v_attribute b on b.parent_id = p.part_id and b.template_id = 2 and b.string_value is not null""",
)
def attribute_lookup(spark, sf_dir):
    return joins.attribute_lookup(
        role(spark, sf_dir, "v_part"),
        role(spark, sf_dir, "v_attribute"),
        "part_id",
        "parent_id",
        "template_id",
        "string_value",
        {"brand": 1, "kind": 2},
    )


@case(
    "i:order_id i:part_id i:material_id",
    """
select order_id, part_id, material_id from v_reported r
where material_id not in (select b.material_id from v_bom b where b.part_id = r.part_id)""",
)
def not_in_scope(spark, sf_dir):
    return joins.not_in_scope(
        role(spark, sf_dir, "v_reported"), role(spark, sf_dir, "v_bom"), ("part_id", "part_id"), ("material_id", "material_id")
    )


@case(
    "i:order_id s:order_number",
    """
select o.order_id, o.order_number from v_order o
where not exists (select 1 from v_order_row r where r.order_id = o.order_id and r.commitment_level = 4)""",
)
def anti_join(spark, sf_dir):
    forecast = role(spark, sf_dir, "v_order_row").filter("commitment_level = 4")
    return role(spark, sf_dir, "v_order").join(forecast, "order_id", "left_anti")


@case(
    "i:transaction_id i:part_id s:from_location s:to_location n:moved",
    """
with legs as (
  select event_id as transaction_id, user_id as part_id, ts, event_id % 3 as loc, -value as change from events where event_type = 'view'
  union all select event_id, user_id, ts, (event_id + 1) % 3, value from events where event_type = 'view')
select a.transaction_id, a.part_id, concat('L', a.loc) as from_location, concat('L', b.loc) as to_location,
  cast(b.change as decimal(18,4)) as moved
from legs a left join legs b on b.transaction_id = a.transaction_id and b.part_id = a.part_id and b.ts = a.ts and b.change > 0
where a.change < 0""",
)
def pair_legs(spark, sf_dir):
    views = _table(spark, sf_dir, "events").filter("event_type = 'view'")

    def leg(shift: int, sign: int):
        return views.select(
            F.col("event_id").alias("transaction_id"),
            F.col("user_id").alias("part_id"),
            "ts",
            text.concat_text("L", (F.col("event_id") + shift) % 3).alias("from_location"),
            (F.col("value") * sign).cast("decimal(18,4)").alias("change"),
        )

    return joins.pair_legs(
        leg(0, -1).unionByName(leg(1, 1)),
        ["transaction_id", "part_id", "ts"],
        "change",
        ["from_location"],
        {"from_location": "to_location", "change": "moved"},
    )


@case(
    "s:number s:customer d:day n:quantity",
    """
select concat('O', cast(l_orderkey as varchar)) as number, c_name as customer, cast(l_shipdate as date) as day,
  cast(l_quantity as decimal(18,4)) as quantity
from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey where o_orderstatus = 'P'
union
select concat('O', cast(o_orderkey as varchar)), c_name, cast(o_orderdate as date), cast(o_totalprice as decimal(18,4))
from orders join customer on c_custkey = o_custkey""",
)
def union_distinct(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").join(_table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))

    def pick(df, key, day, quantity):
        return df.select(
            text.concat_text("O", F.col(key)).alias("number"),
            F.col("c_name").alias("customer"),
            F.to_date(day).alias("day"),
            F.col(quantity).cast("decimal(18,4)").alias("quantity"),
        )

    lines = _table(spark, sf_dir, "lineitem").join(
        orders.filter("o_orderstatus = 'P'"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    return (
        pick(lines, "l_orderkey", "l_shipdate", "l_quantity")
        .unionByName(pick(orders, "o_orderkey", "o_orderdate", "o_totalprice"))
        .distinct()
    )


@case(
    "s:part_number d:delivery_date i:order_id i:position n:price",
    """
select p.part_number, r.delivery_date, r.order_id, r.position, r.price from v_order_row r join v_part p on p.part_id = r.part_id
order by p.part_number, r.delivery_date, r.order_id, r.position, r.price""",
)
def top_sorted(spark, sf_dir):
    rows = role(spark, sf_dir, "v_order_row").join(role(spark, sf_dir, "v_part").select("part_id", "part_number"), "part_id")
    return rows.orderBy("part_number", "delivery_date", "order_id", "position", "price")
