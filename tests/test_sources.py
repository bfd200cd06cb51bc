from __future__ import annotations

import glob
from datetime import date
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyline.operators.staging import stage_order_lines, stage_settlement
from tallyline.schemas import DAILY_ORDERS, ORDER_LINES, SETTLEMENT
from tallyline.sources import tables
from tallyline.sources.csv_files import query_to_csv, read_csv, write_csv
from tallyline.streaming.daily_files import stream_daily_files

HEADER = "order_id,customer_id,restaurant_id,city,order_ts,order_date,status,amount_paise,delivery_fee_paise"


def line(order, day, status="delivered", paise=100, time="12:00:00"):
    return f"{order},U1,R1,Pune,{day} {time},{day},{status},{paise},0"


def deliver(folder, day, *lines, header=HEADER):
    path = folder / f"orders_{day}.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


@pytest.fixture
def month(spark, tmp_path):
    """Two loaded days; order b was placed on the 1st and arrived with the 2nd."""
    files = tmp_path / "files"
    files.mkdir()
    deliver(files, "2025-08-01", line("a", "2025-08-01"))
    deliver(files, "2025-08-02", line("b", "2025-08-01", time="23:50:00"), line("c", "2025-08-02", "cancelled"))
    table, fact = str(tmp_path / "orders"), str(tmp_path / "fact")
    tables.load_all_days(spark, f"{files}/orders_*.csv", table)
    tables.rebuild_daily_fact(spark, table, fact)
    return files, table, fact


GOOD_FACT = {(date(2025, 8, 1), 2, 2, 200), (date(2025, 8, 2), 1, 1, None)}


def test_settlement_csv_loads_exactly(spark, tmp_path):
    path = tmp_path / "bank.csv"
    path.write_text(
        "utr,payment_id,merchant_id,gross_amount,fee,tax,net_amount,captured_on,settled_on,remarks\n"
        'U1,p,M1,19.99,0.40,0.07,19.52,2025-09-14,2025-09-15,\nU2,q,"M ""2"", x",499.99,0.00,0.00,499.99,2025-09-15,2025-09-15,RESUBMIT\n'
    )
    loaded = tables.load_whole(spark, {"bank": (str(path), SETTLEMENT)}, str(tmp_path / "raw"))
    assert loaded == {"bank": 2}
    raw = spark.read.parquet(str(tmp_path / "raw" / "bank"))
    assert rows(raw, "utr", "merchant_id", "gross_amount", "remarks") == {
        ("U1", "M1", Decimal("19.99"), None),
        ("U2", 'M "2", x', Decimal("499.99"), "RESUBMIT"),
    }
    assert rows(stage_settlement(raw), "gross_paise", "fee_paise") == {(1999, 40), (49999, 0)}


def test_rupees_that_arrive_as_doubles_are_rounded(spark):
    raw = spark.createDataFrame([(19.99, 0.29, 1.1, 4.35)], "gross_amount double, fee double, tax double, net_amount double")
    raw = raw.selectExpr("*", "'u' utr", "'p' payment_id", "'m' merchant_id", "'2025-09-15' captured_on", "'2025-09-15' settled_on", "null remarks")
    assert rows(stage_settlement(raw), "gross_paise", "fee_paise", "tax_paise", "net_paise") == {(1999, 29, 110, 435)}


def test_order_lines_are_typed_and_guests_become_null(spark):
    raw = spark.createDataFrame(
        [("o", "1", "2025-03-01 10:00:00", "", "N", "C", "S", "P", "K", "3", "4900", "2500")], ", ".join(f"{n} string" for n in ORDER_LINES.names)
    )
    staged = stage_order_lines(raw)
    assert rows(staged, "order_date", "customer_id", "line_total_paise") == {(date(2025, 3, 1), None, 14700)}
    assert dict(staged.dtypes)["line_total_paise"] == "bigint" and len(staged.columns) == 14


def test_columns_are_taken_by_name(spark, tmp_path):
    header = "note," + ",".join(reversed(HEADER.split(",")))
    path = deliver(tmp_path, "2025-08-01", "hi,0,100,delivered,2025-08-01,2025-08-01 12:00:00,Pune,R1,U1,a", header=header)
    assert rows(read_csv(spark, path, DAILY_ORDERS), "order_id", "amount_paise", "city") == {("a", 100, "Pune")}


def test_a_missing_column_or_file_stops_the_load(spark, tmp_path):
    path = deliver(tmp_path, "2025-08-01", "a,b", header="order_id,city")
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv(spark, path, DAILY_ORDERS)
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        tables.append_day(spark, str(tmp_path / "none.csv"), "2025-08-01", str(tmp_path / "t"))


def test_a_bad_number_stops_the_load_and_the_table_stays(spark, month):
    files, table, _ = month
    path = deliver(files, "2025-08-02", line("b", "2025-08-01", paise="12x"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        tables.replace_day(spark, path, "2025-08-02", table)
    assert tables.orders_table(spark, table).count() == 3


def test_days_come_from_the_file_names(spark, month):
    _, table, fact = month
    assert rows(tables.orders_table(spark, table), "order_id", "batch_day") == {
        ("a", date(2025, 8, 1)),
        ("b", date(2025, 8, 2)),
        ("c", date(2025, 8, 2)),
    }
    assert rows(tables.daily_fact(spark, fact)) == GOOD_FACT


def test_a_file_without_a_day_in_its_name_fails(spark, tmp_path):
    (tmp_path / "orders_x.csv").write_text(HEADER + "\n" + line("a", "2025-08-01") + "\n")
    with pytest.raises(PySparkException):
        tables.load_all_days(spark, str(tmp_path / "orders_x.csv"), str(tmp_path / "t"))


def test_appending_a_day_twice_doubles_it_and_backfill_repairs_it(spark, month):
    files, table, fact = month
    path = f"{files}/orders_2025-08-02.csv"
    assert tables.append_day(spark, path, "2025-08-02", table) == tables.Loaded(2, 4)
    tables.rebuild_daily_fact(spark, table, fact)
    assert rows(tables.daily_fact(spark, fact)) == {(date(2025, 8, 1), 3, 2, 300), (date(2025, 8, 2), 2, 1, None)}
    for _ in range(2):
        assert tables.backfill_day(spark, path, "2025-08-02", table, fact) == tables.Loaded(2, 2)
        assert rows(tables.daily_fact(spark, fact)) == GOOD_FACT


def test_backfill_drops_dates_the_corrected_file_no_longer_has(spark, month):
    files, table, fact = month
    path = deliver(files, "2025-08-02", line("b", "2025-08-01", time="23:50:00"))
    tables.backfill_day(spark, path, "2025-08-02", table, fact)
    assert rows(tables.daily_fact(spark, fact)) == {(date(2025, 8, 1), 2, 2, 200)}


def test_backfill_after_a_crash_between_table_and_fact(spark, month, monkeypatch):
    files, table, fact = month
    path = deliver(files, "2025-08-02", line("d", "2025-08-02"))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "refresh_daily_fact", crash)
        with pytest.raises(RuntimeError):
            tables.backfill_day(spark, path, "2025-08-02", table, fact)
    tables.backfill_day(spark, path, "2025-08-02", table, fact)
    assert rows(tables.daily_fact(spark, fact)) == {(date(2025, 8, 1), 1, 1, 100), (date(2025, 8, 2), 1, 1, 100)}


def test_a_half_loaded_day_is_replaced_whole(spark, month):
    files, table, fact = month
    part = read_csv(spark, f"{files}/orders_2025-08-02.csv", DAILY_ORDERS).where(F.col("order_id") == "b")
    part.withColumn("batch_day", F.lit("2025-08-02").cast("date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch_day").parquet(table)
    tables.backfill_day(spark, f"{files}/orders_2025-08-02.csv", "2025-08-02", table, fact)
    assert rows(tables.daily_fact(spark, fact)) == GOOD_FACT


def test_an_empty_file_is_refused_or_empties_the_day(spark, month):
    files, table, fact = month
    path = deliver(files, "2025-08-02")
    with pytest.raises(tables.EmptyDelivery):
        tables.backfill_day(spark, path, "2025-08-02", table, fact)
    assert tables.orders_table(spark, table).count() == 3
    assert tables.backfill_day(spark, path, "2025-08-02", table, fact, allow_empty=True) == tables.Loaded(0, 0)
    assert rows(tables.daily_fact(spark, fact)) == {(date(2025, 8, 1), 1, 1, 100)}


def test_rows_without_a_required_value_are_refused(spark, month):
    files, table, _ = month
    path = deliver(files, "2025-08-02", line("", "2025-08-02"))
    with pytest.raises(AssertionError, match="order_id"):
        tables.replace_day(spark, path, "2025-08-02", table)
    assert tables.orders_table(spark, table).count() == 3


def test_result_csv_round_trips_and_keeps_spaces_and_quotes(spark, tmp_path):
    df = spark.sql("select ' a \"x\", b ' as t, timestamp_ntz '2025-09-15 18:00:00' as ts, cast(null as string) as n, '' as e")
    write_csv(df.coalesce(1), str(tmp_path / "out"))
    (part,) = glob.glob(str(tmp_path / "out" / "part-*.csv"))
    assert open(part).read() == 't,ts,n,e\n" a ""x"", b ",2025-09-15 18:00:00,,\n'
    back = read_csv(spark, str(tmp_path / "out"), df.schema)
    assert rows(back, "t", "n") == {(' a "x", b ', None)}


def test_query_text_or_file_to_csv(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("some_rows")
    (tmp_path / "q.sql").write_text("select sum(id) as total from some_rows")
    for i, query in enumerate(["select sum(id) as total from some_rows", str(tmp_path / "q.sql")]):
        query_to_csv(spark, query, str(tmp_path / f"out{i}"))
        (part,) = glob.glob(str(tmp_path / f"out{i}" / "part-*.csv"))
        assert open(part).read() == "total\n3\n"


def test_stream_gives_the_batch_result_and_skips_seen_files(spark, month, tmp_path):
    files, table, fact = month
    streamed, streamed_fact, checkpoint = (str(tmp_path / n) for n in ("streamed", "streamed_fact", "checkpoint"))
    for _ in range(2):
        stream_daily_files(spark, str(files), streamed, checkpoint, streamed_fact).awaitTermination()
        assert sorted(tables.orders_table(spark, streamed).collect()) == sorted(tables.orders_table(spark, table).collect())
        assert rows(tables.daily_fact(spark, streamed_fact)) == GOOD_FACT
    deliver(files, "2025-08-03", line("d", "2025-08-03"))
    stream_daily_files(spark, str(files), streamed, checkpoint, streamed_fact).awaitTermination()
    assert rows(tables.daily_fact(spark, streamed_fact)) == GOOD_FACT | {(date(2025, 8, 3), 1, 1, 100)}


def test_line_breaks_survive_a_round_trip(spark, tmp_path):
    texts = spark.createDataFrame([("a\nb", "x"), ("c", 'say "no"\r\nor not')], "one string, two string")
    write_csv(texts, str(tmp_path / "two"))
    assert rows(read_csv(spark, str(tmp_path / "two"), texts.schema, line_breaks=True)) == rows(texts)
    write_csv(texts.select("one"), str(tmp_path / "one"))
    assert rows(read_csv(spark, str(tmp_path / "one"), texts.select("one").schema, line_breaks=True)) == rows(texts, "one")


def test_a_month_whose_files_order_their_columns_differently(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    deliver(files, "2025-08-01", line("a", "2025-08-01"))
    names, values = HEADER.split(","), line("b", "2025-08-02").split(",")
    swapped = [1, 0, *range(2, len(names))]
    deliver(files, "2025-08-02", ",".join(values[i] for i in swapped), header=",".join(names[i] for i in swapped))
    month, days = str(tmp_path / "month"), str(tmp_path / "days")
    tables.load_all_days(spark, str(files), month)
    for day in ("2025-08-01", "2025-08-02"):
        tables.append_day(spark, f"{files}/orders_{day}.csv", day, days)
    assert rows(tables.orders_table(spark, month)) == rows(tables.orders_table(spark, days))
    assert rows(tables.orders_table(spark, month), "order_id", "customer_id") == {("a", "U1"), ("b", "U1")}


def test_stream_notes_files_it_cannot_load_and_goes_on(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    deliver(files, "2025-08-01", line("a", "2025-08-01"))
    deliver(files, "x", line("b", "2025-08-01"))
    deliver(files, "2025-08-03")
    arguments = str(files), str(tmp_path / "orders"), str(tmp_path / "checkpoint")
    stream_daily_files(spark, *arguments, rejects=str(tmp_path / "rejects")).awaitTermination()
    assert rows(tables.orders_table(spark, arguments[1]), "order_id") == {("a",)}
    reasons = {r.path.split("/")[-1]: r.reason for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert "no day" in reasons["orders_x.csv"] and "no rows" in reasons["orders_2025-08-03.csv"] and len(reasons) == 2
