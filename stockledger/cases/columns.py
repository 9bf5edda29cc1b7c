"""Column expressions: labels, text, JSON comments, dates, units."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockledger.cases.registry import case
from stockledger.functions import dates, labels, numbers, text
from stockledger.operators import aggs
from stockledger.sources.demo import role


@case(
    "i:order_id i:position i:commitment_level s:with_default s:with_null s:status_text",
    """
select r.order_id, r.position, r.commitment_level,
  case r.commitment_level when 1 then 'Fixed order' when 4 then 'Forecast' else 'Unknown' end as with_default,
  case r.commitment_level when 1 then 'Fixed order' when 2 then 'Manufacturing' when 3 then 'Buy material' when 4 then 'Forecast' end
    as with_null,
  case o.status when 1 then 'Registered' when 5 then 'Partial delivery made' when 9 then 'Final delivery made' end as status_text
from v_order_row r join v_order o on o.order_id = r.order_id""",
)
def code_label(spark, sf_dir):
    rows = role(spark, sf_dir, "v_order_row").join(role(spark, sf_dir, "v_order"), "order_id")
    level = F.col("commitment_level")
    return rows.select(
        "order_id",
        "position",
        "commitment_level",
        labels.code_label(level, {1: "Fixed order", 4: "Forecast"}, "Unknown").alias("with_default"),
        labels.code_label(level, labels.COMMITMENT_LEVEL).alias("with_null"),
        labels.code_label(F.col("status"), labels.ORDER_STATUS).alias("status_text"),
    )


@case(
    "i:comment_id s:shown",
    """
select comment_id, case when regexp_extract(raw_text, '"Comment":"([^"]*)"', 1) > '' then regexp_extract(raw_text, '"Comment":"([^"]*)"', 1)
  when raw_text > '' then raw_text end as shown
from v_comment""",
)
def first_nonempty(spark, sf_dir):
    comments = role(spark, sf_dir, "v_comment")
    raw = F.col("raw_text")
    return comments.select("comment_id", text.first_nonempty(text.json_field(raw, "Comment"), raw).alias("shown"))


@case(
    "i:comment_id s:order_number s:comment i:json_shaped i:braces",
    """
select comment_id,
  case when contains(raw_text, '"OrderNumber":"') then regexp_extract(raw_text, '"OrderNumber":"([^"]*)"', 1) end as order_number,
  case when contains(raw_text, '"Comment":"') then regexp_extract(raw_text, '"Comment":"([^"]*)"', 1) end as comment,
  case when raw_text like '{%}' then 1 else 0 end as json_shaped,
  case when strpos(raw_text, '{') > 0 and strpos(raw_text, '}') > 0 then 1 else 0 end as braces
from v_comment""",
)
def json_comment(spark, sf_dir):
    raw = F.col("raw_text")
    comments = text.with_json_fields(role(spark, sf_dir, "v_comment"), "raw_text", {"order_number": "OrderNumber", "comment": "Comment"})
    return comments.select(
        "comment_id",
        "order_number",
        "comment",
        text.looks_like_json(raw).cast("int").alias("json_shaped"),
        text.has_braces(raw).cast("int").alias("braces"),
    )


@case(
    "i:part_id s:joined s:joined_skips_null s:plus_null i:where_blank i:length s:head s:upper s:lower s:first_word s:month_name",
    """
select part_id, concat(part_number, '-', part_id) as joined,
  concat(part_number, '-', cast(conversion_factor as varchar)) as joined_skips_null,
  part_number || '/' || cast(conversion_factor as varchar) as plus_null,
  strpos(part_name, ' ') as where_blank, length(part_name) as length, left(part_name, 3) as head, upper(category) as upper,
  lower(category) as lower, split_part(part_name, ' ', 1) as first_word,
  upper(left(m, 1)) || lower(substr(m, 2)) as month_name
from (select *, strftime(date '2024-01-01' + cast(part_id % 365 as int), '%b') as m from v_part) p""",
)
def text_funcs(spark, sf_dir):
    parts = role(spark, sf_dir, "v_part")
    number, name = F.col("part_number"), F.col("part_name")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("part_id") % 365).cast("int"))
    return parts.select(
        "part_id",
        text.concat_text(number, "-", F.col("part_id")).alias("joined"),
        text.concat_text(number, "-", F.col("conversion_factor")).alias("joined_skips_null"),
        text.plus_text(number, "/", F.col("conversion_factor")).alias("plus_null"),
        text.position_of(" ", name).alias("where_blank"),
        F.length(name).alias("length"),
        F.left(name, F.lit(3)).alias("head"),
        F.upper("category").alias("upper"),
        F.lower("category").alias("lower"),
        text.text_before(name, " ").alias("first_word"),
        dates.title_month(day).alias("month_name"),
    )


@case(
    "i:event_id s:year s:month s:day s:day_lower s:stamp s:stamp_upper s:clock s:month_name",
    """
select event_id, strftime(ts, '%Y') as year, strftime(ts, '%Y-%m') as month, strftime(ts, '%Y-%m-%d') as day,
  strftime(ts, '%Y-%m-%d') as day_lower, strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp_upper, strftime(ts, '%H:%M:%S') as clock, strftime(ts, '%b') as month_name
from events""",
)
def date_format(spark, sf_dir):
    ts = F.col("ts")
    patterns = {
        "year": "YYYY",
        "month": "YYYY-MM",
        "day": "YYYY-MM-DD",
        "day_lower": "yyyy-mm-dd",
        "stamp": "YYYY-MM-DD hh:mm:ss",
        "stamp_upper": "YYYY-MM-DD HH:MM:SS",
        "clock": "hh:mm:ss",
        "month_name": "MMM",
    }
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", *[dates.date_fmt(ts, p).alias(n) for n, p in patterns.items()])


@case(
    "i:event_id d:next_day d:next_month d:week_before i:in_first_week",
    """
select event_id, cast(ts as date) + 1 as next_day, cast(cast(ts as date) + interval 1 month as date) as next_month,
  cast(ts as date) - 7 as week_before,
  case when cast(ts as date) between date '2024-01-01' and date '2024-01-07' then 1 else 0 end as in_first_week
from events""",
)
def date_arith(spark, sf_dir):
    day = F.to_date("ts")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        F.date_add(day, 1).alias("next_day"),
        F.add_months(day, 1).alias("next_month"),
        F.date_sub(day, 7).alias("week_before"),
        dates.in_days(F.col("ts"), "2024-01-01", "2024-01-07").cast("int").alias("in_first_week"),
    )


@case(
    "i:part_id n:rounded n:rounded_or_zero s:as_text d:as_date",
    """
select part_id, cast(price as decimal(20,0)) as rounded, coalesce(cast(conversion_factor as decimal(20,0)), 0) as rounded_or_zero,
  cast(part_id as varchar) as as_text, cast('2024-02-29' as date) as as_date
from v_part""",
)
def cast_round(spark, sf_dir):
    return role(spark, sf_dir, "v_part").select(
        "part_id",
        F.col("price").cast("decimal(20,0)").alias("rounded"),
        numbers.whole(F.col("conversion_factor")).alias("rounded_or_zero"),
        F.col("part_id").cast("string").alias("as_text"),
        F.lit("2024-02-29").cast("date").alias("as_date"),
    )


@case(
    "i:part_id n:stock_in_unit n:price_in_unit n:above_zero i:is_different",
    """
select part_id, cast(price as double) / coalesce(conversion_factor, 1) as stock_in_unit,
  cast(price as double) * coalesce(conversion_factor, 1) as price_in_unit,
  case when price - 1000 > 0 then price - 1000 else 0 end as above_zero,
  case when conversion_factor <> 7 then 1 else 0 end as is_different
from v_part""",
)
def unit_convert(spark, sf_dir):
    price, factor = F.col("price"), F.col("conversion_factor")
    return role(spark, sf_dir, "v_part").select(
        "part_id",
        numbers.to_unit(price, factor).alias("stock_in_unit"),
        numbers.to_unit(price, factor, "multiply").alias("price_in_unit"),
        numbers.not_below_zero(price - 1000).alias("above_zero"),
        numbers.differs(factor, F.lit(7)).alias("is_different"),
    )


@case(
    "i:part_id s:location_name n:received n:issued n:arrived n:delivered n:moved n:withdrawn",
    """
select part_id, location_name, sum(case when balance_change > 0 then balance_change else 0 end) as received,
  sum(case when balance_change < 0 then balance_change else 0 end) as issued,
  sum(case when type_code in (1, 18) then balance_change else 0 end) as arrived,
  sum(case when type_code in (3, 19) then balance_change else 0 end) as delivered,
  sum(case when type_code in (6, 7) then balance_change else 0 end) as moved,
  sum(case when type_code in (11, 16) then balance_change else 0 end) as withdrawn
from v_movement group by part_id, location_name""",
)
def conditional_sum(spark, sf_dir):
    change = F.col("balance_change")
    groups = {"arrived": [1, 18], "delivered": [3, 19], "moved": [6, 7], "withdrawn": [11, 16]}
    return (
        role(spark, sf_dir, "v_movement")
        .groupBy("part_id", "location_name")
        .agg(*aggs.signed_sums(change, "received", "issued"), *aggs.sum_by_group(change, F.col("type_code"), groups))
    )


@case(
    "i:order_id i:parts s:part_list s:quoted_parts",
    """
select order_id, count(distinct part_id) as parts,
  string_agg(distinct cast(part_id as varchar), ', ' order by cast(part_id as varchar)) as part_list,
  string_agg(distinct '''' || cast(part_id as varchar) || '''', ', ' order by '''' || cast(part_id as varchar) || '''') as quoted_parts
from v_order_row group by order_id""",
)
def list_distinct(spark, sf_dir):
    part = F.col("part_id")
    return (
        role(spark, sf_dir, "v_order_row")
        .groupBy("order_id")
        .agg(
            F.countDistinct(part).alias("parts"),
            aggs.list_distinct(part).alias("part_list"),
            aggs.list_distinct(part, quote="'").alias("quoted_parts"),
        )
    )


@case(
    "i:voucher_id i:account_id n:debit n:credit s:contra",
    """
with a as (select voucher_id, account_id, sum(debit) as debit, sum(credit) as credit from v_voucher_row group by voucher_id, account_id),
cr as (select voucher_id, string_agg(distinct cast(account_id as varchar), ', ' order by cast(account_id as varchar)) as names
  from v_voucher_row where credit > 0 group by voucher_id),
de as (select voucher_id, string_agg(distinct cast(account_id as varchar), ', ' order by cast(account_id as varchar)) as names
  from v_voucher_row where debit > 0 group by voucher_id)
select a.*, case when a.debit > 0 then cr.names when a.credit > 0 then de.names end as contra
from a left join cr on cr.voucher_id = a.voucher_id left join de on de.voucher_id = a.voucher_id""",
)
def contra_accounts(spark, sf_dir):
    entries = (
        role(spark, sf_dir, "v_voucher_row")
        .groupBy("voucher_id", "account_id")
        .agg(
            F.sum("debit").alias("debit"),
            F.sum("credit").alias("credit"),
            F.max("debit").alias("highest_debit"),
            F.max("credit").alias("highest_credit"),
        )
    )
    listed = aggs.contra_accounts(entries, "voucher_id", "account_id", "highest_debit", "highest_credit")
    return listed.withColumn(
        "contra",
        F.when(F.col("debit") > 0, F.col("credit_accounts")).when(F.col("credit") > 0, F.col("debit_accounts")),
    )


_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


@case(
    "i:part_id " + " ".join(f"n:{m}_stock n:{m}_rows" for m in _MONTHS),
    "select part_id, "
    + ", ".join(
        f"coalesce(sum(case when strftime(delivery_date, '%b') = '{m}' then physical_balance end), 0) as {m}_stock, "
        f"coalesce(sum(case when strftime(delivery_date, '%b') = '{m}' then 1 end), 0) as {m}_rows"
        for m in _MONTHS
    )
    + " from v_count group by part_id",
)
def pivot_measures(spark, sf_dir):
    counts = role(spark, sf_dir, "v_count").withColumn("month", dates.title_month(F.col("delivery_date")))
    return aggs.pivot_measures(
        counts, ["part_id"], "month", list(_MONTHS), {"stock": F.col("physical_balance"), "rows": F.lit(1)}
    )
