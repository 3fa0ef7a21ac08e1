"""Numbered batches, one-file exports, kept totals, paged feeds."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators import flag_rates
from tidemark.sinks import write_batch, write_feed, write_one_csv, write_parquet
from tidemark.sources import ingest_api, read_csv, read_parquet
from tidemark.streaming import add_totals, compact_totals, read_totals

MESSAGES = "campaign_id long, message_id long, is_opened long, is_clicked long, is_purchased long, is_unsubscribed long"
MESSAGES += ", is_hard_bounced long, is_soft_bounced long"


def test_a_batch_replaces_itself(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for part in ("id < 3", "id >= 3"):
        write_batch(spark.range(5).where(part), path, 7)
    write_batch(spark.range(9, 10), path, 12)
    assert rows(read_parquet(spark, path, nested=True)) == [(3,), (4,), (9,)]
    with pytest.raises(ValueError):
        write_batch(spark.range(1), path, -1)
    with pytest.raises(ValueError):
        write_batch(spark.range(1), path, 1, fmt="xml")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_feed_is_taken_up_again(spark, rows, tmp_path, fmt):
    path = str(tmp_path / "t")
    feed = [{"a": k, "b": f"x\n{k}"} for k in range(5)]
    assert write_feed(spark, iter(feed[:3]), path, fmt=fmt) == 3
    assert write_feed(spark, iter(feed[2:]), path, first=2, fmt=fmt) == 5
    assert write_feed(spark, iter([]), path, first=5, fmt=fmt) == 5
    read = read_parquet if fmt == "parquet" else read_csv
    found = read(spark, path, nested=True)
    assert rows(found.select(F.col("a").cast("long"), "b")) == [(k, f"x\n{k}") for k in range(5)]


@pytest.mark.parametrize("header", [True, False])
def test_one_csv_file(spark, tmp_path, header):
    df = spark.range(0, 5000, 1, 7).selectExpr("id", "CASE WHEN id % 3 > 0 THEN concat('t\n\"', id) END AS `a,b`")
    path = write_one_csv(df.orderBy(F.col("id").desc()), str(tmp_path / "sub" / "out"), sep=";", header=header)
    assert path.endswith("out.csv") and os.listdir(tmp_path / "sub") == ["out.csv"]
    found = read_csv(spark, path, df.schema, sep=";", header=header, position="at").orderBy("at").drop("at").collect()
    assert found == df.orderBy(F.col("id").desc()).collect()
    with open(path, encoding="utf-8") as file:
        assert file.read().count("a,b") == (1 if header else 0)


def test_one_csv_file_of_nothing_and_again(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    write_one_csv(spark.range(10), path)
    write_one_csv(spark.range(0), path)
    with open(path, encoding="utf-8") as file:
        assert file.read() == "id\n"
    with pytest.raises(ValueError):
        write_one_csv(spark.range(1), "")


def test_totals_are_kept_up_to_date(spark, rows, tmp_path):
    flags = [f"CAST((id * {k + 3}) % 7 < 2 AS BIGINT) AS {c.split()[0]}" for k, c in enumerate(MESSAGES.split(", ")[2:])]
    every = spark.range(0, 300).selectExpr("CASE WHEN id % 5 > 0 THEN id % 4 END AS campaign_id", "id AS message_id", *flags)
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "totals", "check"))

    def arrive(condition):
        write_parquet(every.where(condition), folder, mode="append")
        add_totals(spark, folder, every.schema, target, checkpoint)

    arrive("message_id < 100")
    # Files that were counted are not read again: they need not even be there.
    shutil.rmtree(folder)
    arrive("message_id BETWEEN 100 AND 199")
    assert rows(read_totals(spark, target)) == rows(flag_rates(every.where("message_id < 200")))
    compact_totals(spark, target)
    compact_totals(spark, target)
    shutil.rmtree(os.path.join(target, "batch-000000000000"))
    arrive("message_id >= 200")
    assert rows(read_totals(spark, target)) == rows(flag_rates(every))
    plan = read_totals(spark, target).inputFiles()
    assert not any("batch-000000000001" in f for f in plan) and any("folded-000000000001" in f for f in plan)


def test_a_replayed_batch_of_totals_counts_once(spark, rows, tmp_path):
    every = spark.createDataFrame([(1, k, 1, 0, 0, 0, 0, 1) for k in range(10)], MESSAGES)
    folder, target = write_parquet(every, str(tmp_path / "in")), str(tmp_path / "totals")
    for run in range(2):
        add_totals(spark, folder, every.schema, target, str(tmp_path / f"check{run}"))
    assert rows(read_totals(spark, target)) == rows(flag_rates(every))


def _page(folder, number, ids):
    (folder / f"p{number}.json").write_text(json.dumps([{"a": k, "b": 1} for k in ids]))


def test_only_new_pages_are_read(spark, rows, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    url, target, checkpoint = f"file://{folder}/p{{page}}.json", str(tmp_path / "t"), str(tmp_path / "c")

    def pull(**options):
        ingest_api(spark, url, "a BIGINT, b DOUBLE", target, checkpoint, **options)
        return [r[0] for r in rows(read_parquet(spark, target), "a")]

    for number in range(1, 6):
        _page(folder, number, [number])
    assert pull() == [1, 2, 3, 4, 5]
    for number in range(1, 6):
        os.remove(folder / f"p{number}.json")
    assert pull() == [1, 2, 3, 4, 5]
    _page(folder, 6, [6, 7])
    assert pull() == [1, 2, 3, 4, 5, 6, 7]


def test_a_page_waits_until_it_is_full(spark, rows, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    url = f"file://{folder}/p{{page}}.json"
    for last, expected in (([5], [1, 2, 3, 4]), ([5, 6], [1, 2, 3, 4, 5, 6])):
        for number, ids in enumerate([[1, 2], [3, 4], last], start=1):
            _page(folder, number, ids)
        ingest_api(spark, url, "a BIGINT", str(tmp_path / "t"), str(tmp_path / "c"), page_size=2)
        assert [r[0] for r in rows(read_parquet(spark, str(tmp_path / "t")))] == expected
