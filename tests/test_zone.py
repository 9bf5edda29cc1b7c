"""Days, months and clock times of a report zone, whatever the session's zone is."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal as D
from zoneinfo import ZoneInfo

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from test_reports import frames

from stockledger import Catalog
from stockledger.functions import dates
from stockledger.plans import orders, planning, stock

INSTANTS = [datetime(2024, 1, 31, 16, 59, 59, 999_999), datetime(2024, 1, 31, 17), datetime(1969, 12, 31, 23, 30), datetime(2024, 3, 31, 0, 59), datetime(2024, 3, 31, 1, 0), datetime(2024, 10, 27, 0, 30), datetime(2024, 10, 27, 1, 30), datetime(1800, 6, 1, 12)]


@pytest.fixture(params=["UTC", "America/New_York"])
def session_zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["+07:00", "Europe/Berlin", "America/Sao_Paulo", "UTC"])
def test_parts_of_an_instant(spark, session_zone, zone):
    at = timezone(timedelta(hours=7)) if zone == "+07:00" else ZoneInfo(zone)
    micros = [((x - datetime(1970, 1, 1)) // timedelta(microseconds=1),) for x in INSTANTS]
    df = spark.createDataFrame(micros, "us long").withColumn("t", F.timestamp_micros("us"))
    got = df.select("us", dates.day_of(F.col("t"), zone).alias("day"), dates.month_of(F.col("t"), zone).alias("month")).collect()
    local = {us: x.replace(tzinfo=timezone.utc).astimezone(at) for (us,), x in zip(micros, INSTANTS)}
    assert {r.us: (r.day, r.month) for r in got} == {us: (x.date(), f"{x:%Y-%m}") for us, x in local.items()}
    # A day begins where its first instant lies, and the next one ends it.
    for day in (date(2024, 3, 31), date(2024, 4, 1), date(2024, 10, 27), date(2024, 10, 28)):
        start = spark.range(1).select(F.unix_micros(dates.day_start(F.lit(day), zone))).first()[0]
        assert start == int(datetime(day.year, day.month, day.day, tzinfo=at).timestamp() * 1_000_000)
    if session_zone == "UTC":
        stamps = df.select("us", dates.date_fmt(F.col("t"), "YYYY-MM-DD hh:mm:ss", zone).alias("s")).filter("us > 0").collect()
        assert {r.us: r.s for r in stamps} == {us: f"{x:%Y-%m-%d %H:%M:%S}" for us, x in local.items() if us > 0}


def test_bounds_of_text_with_and_without_an_offset(spark, session_zone):
    pick = lambda *c: tuple(spark.range(1).select(*[F.unix_micros(x) for x in c]).first())
    seventeen = int(datetime(2024, 1, 30, 17, tzinfo=timezone.utc).timestamp() * 1_000_000)
    assert pick(dates.as_timestamp("2024-01-31", "+07:00"), dates.as_timestamp("2024-01-31T00:00:00+07:00", "Asia/Tokyo")) == (seventeen, seventeen)


def _rest(zone, spark):
    at = [datetime(2024, 1, 31, 16, 59), datetime(2024, 1, 31, 17, 1)]
    row = {"ParentOrderId": 1, "PartId": 1, "CustomerCommitmentLevel": 1, "LifeCycleState": 1, "Status": 1}
    cat = frames(
        spark,
        CustomerOrderRow=[{**row, "Id": i, "RestQuantity": D(10**i), "DeliveryDate": t} for i, t in enumerate(at)],
        CustomerOrder=[{"Id": 1, "BusinessContactId": 1, "LifeCycleState": 1}],
        Part=[{"Id": 1, "PartNumber": "P1", "Status": 1}],
    )
    cat.zone = zone
    return rows(orders.outstanding_by_period(cat), "DeliveryPeriod", "RestQuantity")


def test_a_month_ends_earlier_in_the_east(spark):
    assert _rest(None, spark) == [("2024-01", 11)]
    assert _rest("+07:00", spark) == [("2024-01", 1), ("2024-02", 10)]


def test_bounds_of_a_zone_reach_the_scan(spark, tmp_path):
    times = [(i, datetime(2024, 1, 1) + timedelta(hours=i)) for i in range(100)]
    spark.createDataFrame(times, "id long, at timestamp").write.parquet(str(tmp_path / "t"))
    found = spark.read.parquet(str(tmp_path / "t")).filter(dates.in_days(F.col("at"), "2024-01-02", "2024-01-02", "+07:00"))
    assert [r[0] for r in found.orderBy("id").select("id").collect()] == list(range(17, 41))
    pushed = plan_of(found).split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(at," in pushed and "LessThan(at," in pushed


def test_columns_of_dates_start_their_day_in_the_zone(spark, session_zone):
    source = spark.createDataFrame([(1, date(2024, 1, 31))], "Id long, OrderDate date")
    cat = Catalog.from_frames(spark, {"CustomerOrder": source}, fill_missing=True, zone="-05:00")
    day = dates.day_of(F.col("OrderDate"), "-05:00")
    assert cat.table("CustomerOrder").select(day).first()[0] == date(2024, 1, 31)


def test_reports_run_in_a_zone(spark, sf):
    from stockledger.sources.demo import demo_catalog

    plain, utc = demo_catalog(spark, sf), demo_catalog(spark, sf, "UTC")
    for report in (lambda c: stock.stock_value_month(c, 1997), lambda c: planning.order_plan(c, "2024-01-10", "2024-01-11", ["P3", "P8"])):
        assert rows(report(plain)) == rows(report(utc))
