"""Row streams, files delivered again, and large files with line breaks."""

from __future__ import annotations

import csv
import os
import random
from datetime import date

import pytest
from helpers import rows
from test_sources import GOOD_FACT, deliver, line, month  # noqa: F401

from tallyline.operators.orders import daily_orders, dedup_orders
from tallyline.sources import tables
from tallyline.sources.csv_files import read_csv, write_csv
from tallyline.sources.split_csv import read_split_csv
from tallyline.streaming.daily_files import stream_daily_files
from tallyline.streaming.deliveries import take_deliveries
from tallyline.streaming.orders import stream_orders, streamed_orders

# Rows as a stream


@pytest.fixture
def stream(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()

    def run(**options):
        names = (str(tmp_path / n) for n in ("streamed", "checkpoint", "rejects"))
        stream_orders(spark, str(files), *names, **options).awaitTermination()
        return streamed_orders(spark, str(tmp_path / "streamed"))

    return files, run


def test_a_stream_stopped_and_started_equals_the_batch(spark, stream, tmp_path):
    files, run = stream
    late = line("b", "2025-08-01", time="23:50:00")
    deliver(files, "2025-08-01", line("a", "2025-08-01"), line("a", "2025-08-01"))
    deliver(files, "2025-08-02", late, line("c", "2025-08-02", "cancelled"))
    assert run().count() == 3
    deliver(files, "2025-08-03", late, line("a", "2025-08-01"), line("c", "2025-08-02"), line("d", "2025-08-03"))
    streamed = run()
    assert rows(streamed, "order_id", "status", "batch_day") == {
        ("a", "delivered", date(2025, 8, 1)), ("b", "delivered", date(2025, 8, 2)), ("c", "cancelled", date(2025, 8, 2)),
        ("c", "delivered", date(2025, 8, 3)), ("d", "delivered", date(2025, 8, 3)),
    }
    assert run().count() == 5
    batch = tables.read_days(spark, f"{files}/orders_*.csv")
    assert rows(daily_orders(dedup_orders(streamed))) == rows(daily_orders(dedup_orders(batch)))


def test_lines_that_do_not_fit_are_noted_and_the_others_go_on(spark, stream, tmp_path):
    files, run = stream
    deliver(files, "2025-08-01", line("a", "2025-08-01"), line("b", "2025-08-01", paise="12x"), line("", "2025-08-01"))
    deliver(files, "x", line("c", "2025-08-01"))
    assert rows(run(), "order_id") == {("a",)}
    noted = spark.read.parquet(str(tmp_path / "rejects"))
    assert {r[0].split("/")[-1]: None for r in noted.select("path").collect()}.keys() == {"orders_2025-08-01.csv", "orders_x.csv"}
    assert sorted(r.reason for r in noted.collect()) == ["empty: order_id", "the file's name holds no day", "the line does not fit the columns"]
    assert [r.line for r in noted.where("reason LIKE 'the line%'").collect()] == [line("b", "2025-08-01", paise="12x")]


def test_a_micro_batch_that_runs_again_replaces_itself(spark, stream, tmp_path):
    files, run = stream
    deliver(files, "2025-08-01", line("a", "2025-08-01"))
    before = rows(run())
    os.remove(tmp_path / "checkpoint" / "commits" / "0")
    for crc in (tmp_path / "checkpoint" / "commits").glob(".0*"):
        os.remove(crc)
    streamed = run()
    assert streamed.count() == 1 and rows(streamed) == before


def test_nothing_delivered_yet(stream):
    assert stream[1]().count() == 0


# Files that come again


def test_a_corrected_file_under_the_old_name_replaces_its_day_once(spark, month, tmp_path):  # noqa: F811
    files, table, fact = month
    manifest = str(tmp_path / "manifest")
    assert sorted(take_deliveries(spark, str(files), table, fact, manifest)) == ["2025-08-01", "2025-08-02"]
    assert rows(tables.daily_fact(spark, fact)) == GOOD_FACT
    assert take_deliveries(spark, str(files), table, fact, manifest) == {}
    path = deliver(files, "2025-08-02", line("b", "2025-08-01", time="23:50:00", paise=250))
    assert take_deliveries(spark, str(files), table, fact, manifest) == {"2025-08-02": tables.Loaded(1, 1)}
    assert rows(tables.daily_fact(spark, fact)) == {(date(2025, 8, 1), 2, 2, 350)}
    os.utime(path, (1, 2_000_000_000))  # only touched
    assert take_deliveries(spark, str(files), table, fact, manifest) == {}


def test_refused_files_count_again_once_they_change(spark, month, tmp_path):  # noqa: F811
    files, table, fact = month
    arguments = str(files), table, fact, str(tmp_path / "manifest")
    deliver(files, "2025-08-02", line("b", "2025-08-01", paise="12x"))
    with pytest.raises(tables.MalformedDelivery):
        take_deliveries(spark, *arguments)
    assert set(take_deliveries(spark, *arguments, rejects=str(tmp_path / "rejects"))) <= {"2025-08-01"}
    assert take_deliveries(spark, *arguments) == {}
    assert "MALFORMED_RECORD" in spark.read.parquet(str(tmp_path / "rejects")).first().reason
    deliver(files, "2025-08-02", line("b", "2025-08-01"))
    assert set(take_deliveries(spark, *arguments)) == {"2025-08-02"}


def test_the_file_stream_notes_a_malformed_file_and_goes_on(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    deliver(files, "2025-08-01", line("a", "2025-08-01"))
    deliver(files, "2025-08-02", line("b", "2025-08-02", paise="12x"), line("c", "2025-08-02"))
    deliver(files, "2025-08-03", "d,too,few")
    arguments = str(files), str(tmp_path / "orders"), str(tmp_path / "checkpoint")
    stream_daily_files(spark, *arguments, rejects=str(tmp_path / "rejects")).awaitTermination()
    assert rows(tables.orders_table(spark, arguments[1]), "order_id") == {("a",)}
    noted = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert {r.path.split("/")[-1] for r in noted} == {"orders_2025-08-02.csv", "orders_2025-08-03.csv"}
    assert all("MALFORMED_RECORD" in r.reason for r in noted)


# Large files with line breaks

TEXTS = "id int, one string, two string"


@pytest.fixture
def small_ranges(spark):
    """Files are dealt to tasks in ranges of 150 bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def odd_texts(seed, count):
    chance = random.Random(seed)
    some = ["a", 'b "q"', "line\nbreak", "cr\r\nlf", "x,y", '"', "\n\n", '"\n"', "long " * 60, 'many\n"lines\n' * 40, None]
    return [(i, chance.choice(some), chance.choice(some)) for i in range(count)]


def test_records_over_many_ranges_equal_the_whole_file_read(spark, small_ranges, tmp_path):
    df = spark.createDataFrame(odd_texts(1, 120), TEXTS)
    write_csv(df.coalesce(2), str(tmp_path / "files"))
    found = read_split_csv(spark, str(tmp_path / "files"), df.schema)
    whole = read_csv(spark, str(tmp_path / "files"), df.schema, line_breaks=True)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert spark.read.text(str(tmp_path / "files")).rdd.getNumPartitions() > 20


def test_other_line_ends_columns_in_another_order_and_blank_lines(spark, small_ranges, tmp_path):
    data = odd_texts(2, 40)
    with open(tmp_path / "crlf.csv", "w", newline="") as file:
        writer = csv.writer(file, lineterminator="\r\n")
        writer.writerow(["two", "more, columns", "id", "one"])
        for i, one, two in data:
            writer.writerow([two, "m", i, one])
            file.write("\r\n")
    found = read_split_csv(spark, str(tmp_path / "crlf.csv"), spark.createDataFrame([], TEXTS).schema)
    assert rows(found) == {(i, one or None, two or None) for i, one, two in data}


def test_what_stops_the_split_read(spark, tmp_path):
    schema = spark.createDataFrame([], TEXTS).schema
    for name, text, match in [
        ("open", 'id,one,two\n1,"a,b\n2,c,d\n', "quoted field"), ("less", "id,one\n1,a\n", "lacks columns"), ("bad", "id,one,two\nx,a,b\n", "MALFORMED"),
    ]:
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(Exception, match=match):
            read_split_csv(spark, str(tmp_path / f"{name}.csv"), schema).collect()
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed" / "1.csv").write_text("id,one,two\n1,a,b\n")
    (tmp_path / "mixed" / "2.csv").write_text("id,two,one\n1,a,b\n")
    with pytest.raises(ValueError, match="other columns"):
        read_split_csv(spark, str(tmp_path / "mixed"), schema)
    (tmp_path / "header.csv").write_text("id,one,two\n")
    assert read_split_csv(spark, str(tmp_path / "header.csv"), schema).count() == 0
