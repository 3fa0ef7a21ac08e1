import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cast_columns, drop_duplicates
from tidemark.sinks import write_batches, write_csv, write_parquet
from tidemark.sources import as_table, infer_schema, read_csv, read_json_records, read_parquet
from tidemark.streaming import ingest_files


def _file(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_scan(spark, rows, tmp_path):
    path = _file(tmp_path, "t.csv", "day,note\n40,rain\n41,\n-2,sun\n")
    assert rows(read_csv(spark, path, "day BIGINT, note STRING")) == [(-2, "sun"), (40, "rain"), (41, None)]
    assert read_csv(spark, [path], columns=["note"]).columns == ["note"]
    semicolons = _file(tmp_path, "s.csv", "a;b\n1;x,y\n")
    assert rows(read_csv(spark, semicolons, "a BIGINT", sep=";")) == [(1, "x,y")]


def test_csv_columns_go_by_name(spark, rows, tmp_path):
    path = _file(tmp_path, "t.csv", "b,extra,a\nx,0,1\n")
    assert rows(read_csv(spark, path, "a BIGINT, b STRING"), "a", "b", "extra") == [(1, "x", "0")]
    with pytest.raises(ValueError):
        read_csv(spark, path, "zz BIGINT")
    with pytest.raises(ValueError):
        read_csv(spark, path, columns=["zz"])


def test_csv_folder(spark, rows, tmp_path):
    _file(tmp_path, "f1.csv", "a,w\n11,left\n")
    _file(tmp_path, "f2.csv", "a,w\n12,right\n")
    _file(tmp_path, "a-note.txt", "no table\n")
    assert rows(read_csv(spark, folder=str(tmp_path), schema="a BIGINT, w STRING")) == [(11, "left"), (12, "right")]
    _file(tmp_path, "a0.csv", "other\n9\n")
    kept = read_csv(spark, folder=str(tmp_path), schema="a BIGINT", exclude=["f2.csv", "a0.csv"])
    assert rows(kept) == [(11, "left")]
    with pytest.raises(FileNotFoundError):
        read_csv(spark, folder=str(tmp_path), exclude=["f1.csv", "f2.csv", "a0.csv"])


def test_files_with_another_header_fail(spark, tmp_path):
    _file(tmp_path, "f1.csv", "a,b\n1,2\n")
    _file(tmp_path, "f2.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        read_csv(spark, folder=str(tmp_path), schema="a BIGINT, b BIGINT").collect()


def test_missing_paths(spark, tmp_path):
    with pytest.raises(ValueError):
        read_csv(spark)
    with pytest.raises(ValueError):
        read_parquet(spark)
    for read in (read_csv, read_parquet):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "none"))


def test_bad_cells_fail_unless_told_otherwise(spark, rows, tmp_path):
    path = _file(tmp_path, "t.csv", "a\n1\nx\n")
    with pytest.raises(Exception):
        read_csv(spark, path, "a BIGINT").collect()
    assert rows(read_csv(spark, path, "a BIGINT", mode="PERMISSIVE")) == [(1,), (None,)]


def test_csv_nulls_and_quotes(spark, rows, tmp_path):
    data = [(1, None, 1.5), (2, "", None), (3, 'a "b", c', 0.0), (4, "back\\slash", -1.0), (5, "línea", 1e300)]
    df = spark.createDataFrame(data, "i long, s string, x double")
    path = write_csv(df, str(tmp_path / "out"))
    assert rows(read_csv(spark, path, df.schema)) == sorted(data, key=repr)


def test_infer_schema(spark, tmp_path):
    path = _file(
        tmp_path, "t.csv", 'i,x,b,d,s,n,big\n1,1,true,2024-01-01,a,,9\n-2,2.5e3,false,2024-01-02,1,,99999999999999999999\n'
    )
    kinds = dict(zip("i x b d s n big".split(), [f.dataType.simpleString() for f in infer_schema(spark, path).fields]))
    assert kinds == {"i": "bigint", "x": "double", "b": "boolean", "d": "string", "s": "string", "n": "string", "big": "double"}


def test_literal_rows(spark, rows, tmp_path):
    assert rows(as_table(spark, {"a": 1, "b": "z"})) == [(1, "z")]
    path = write_csv(as_table(spark, [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]), str(tmp_path / "rows"))
    assert rows(read_csv(spark, path, "a BIGINT, b STRING")) == [(1, "x"), (2, "y")]
    path = write_parquet(as_table(spark, {"a": 5}), str(tmp_path / "row"))
    assert rows(read_parquet(spark, path)) == [(5,)]
    for bad in (5, "text", [], [1]):
        with pytest.raises(TypeError):
            as_table(spark, bad)


def test_batches(spark, rows, tmp_path):
    path = str(tmp_path / "b")
    frames = [spark.createDataFrame([(i,)], "a long") for i in (0, 1)]
    for _ in range(2):
        write_batches(spark, iter(frames), path)
    assert rows(read_parquet(spark, path)) == [(0,), (1,)]
    write_batches(spark, [{"a": 2}], path, mode="append")
    assert rows(read_parquet(spark, path)) == [(0,), (1,), (2,)]
    csv = write_batches(spark, [{"a": 0}, {"a": 1}], str(tmp_path / "c"), write=write_csv)
    assert rows(read_csv(spark, csv, "a BIGINT")) == [(0,), (1,)]
    with pytest.raises(ValueError):
        write_batches(spark, [], path)


def test_writers_refuse_bad_arguments(spark):
    for write in (write_csv, write_parquet):
        with pytest.raises(ValueError):
            write(spark.range(1), "")
        with pytest.raises(ValueError):
            write(spark.range(1), "/nowhere", mode="x")


def test_parquet_append(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    write_parquet(spark.createDataFrame([(1,)], "a long"), path, mode="a")
    write_parquet(spark.createDataFrame([(2,)], "a long"), path, mode="a")
    assert rows(read_parquet(spark, path)) == [(1,), (2,)]
    for other in ("a int", "b long", "a long, b long"):
        with pytest.raises(ValueError):
            write_parquet(spark.createDataFrame([], other), path, mode="a")
    write_parquet(spark.createDataFrame([(7,)], "a long"), path)
    assert rows(read_parquet(spark, path)) == [(7,)]


def test_parquet_append_to_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a long")
    for _ in range(2):
        write_parquet(df, path, mode="append", partition_by=["k"])
    assert rows(read_parquet(spark, path), "a", "k") == [(1, "x"), (1, "x"), (2, "y"), (2, "y")]


def test_partitions_have_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).selectExpr("id % 5 AS k", "id")
    for rebalance in (True, False):
        path = write_parquet(df, str(tmp_path / f"p{rebalance}"), partition_by=["k"], rebalance=rebalance)
        files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
        assert len(files) == (5 if rebalance else 40)
        assert read_parquet(spark, path).count() == 4000


def test_late_files_are_ingested(spark, tmp_path):
    folder, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([], "k long").schema

    def arrive(name, value, days):
        os.makedirs(folder, exist_ok=True)
        path = _file(tmp_path / "in", name, f"k\n{value}\n")
        then = 1_700_000_000 - days * 86400
        os.utime(os.path.join(folder, name), (then, then))
        ingest_files(spark, folder, schema, target, progress)
        return path

    arrive("a.csv", 1, 0)
    arrive("b.csv", 2, 10)
    arrive("c.csv", 3, 0)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_parquet_positions_and_chunks(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(0, 1000, 1, 4).write.parquet(path)
    numbered = read_parquet(spark, path, position="place").orderBy("place").collect()
    plan = read_parquet(spark, path, position="place")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    in_files = [r.id for f in files for r in spark.read.parquet(f"{path}/{f}").collect()]
    assert [r.id for r in numbered] == in_files
    chunks = [sorted(r.id for r in read_parquet(spark, path, chunk=(i, 300)).collect()) for i in range(5)]
    assert [len(c) for c in chunks] == [300, 300, 300, 100, 0]
    assert sorted(sum(chunks, [])) == list(range(1000))
    assert read_parquet(spark, path, chunk=(0, 3)).columns == ["id"]


def test_a_chunk_opens_only_its_files(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(0, 1000, 1, 10).write.parquet(path)
    df = read_parquet(spark, path, chunk=(3, 50))
    assert df.count() == 50
    plan = df._jdf.queryExecution().executedPlan()
    assert "Join" not in plan.toString()
    df.collect()
    files = [r.f for r in df.selectExpr("input_file_name() f").distinct().collect()]
    scanned = df.rdd.getNumPartitions()
    assert len(files) == 1 and scanned <= 2


def test_first_row_as_written(spark, tmp_path):
    data = [("b", 2), ("a", 9), ("b", 1), ("a", 3)]
    spark.createDataFrame(data, "k string, v long").coalesce(1).write.parquet(str(tmp_path / "p"))
    df = read_parquet(spark, str(tmp_path / "p"), position="place")
    kept = drop_duplicates(df, ["k"], order_by=["place"]).collect()
    assert {r.k: r.v for r in kept} == {"b": 2, "a": 9}


def test_first_row_as_written_in_csv(spark, tmp_path):
    """Also where one file is read by many tasks."""
    lines = [(i * 7919 % 100, i) for i in range(20000)]
    _file(tmp_path, "1.csv", "k,v\n" + "\n".join(f"{k},{v}" for k, v in lines[:15000]) + "\n")
    _file(tmp_path, "2.csv", "k,v\n" + "\n".join(f"{k},{v}" for k, v in lines[15000:]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        df = read_csv(spark, folder=str(tmp_path), schema="k BIGINT, v BIGINT", position="place")
        assert df.rdd.getNumPartitions() > 10
        assert [r.v for r in df.orderBy("place").collect()] == [v for _, v in lines]
        kept = drop_duplicates(df, ["k"], order_by=["place"])
        assert {r.k: r.v for r in kept.collect()} == {k: v for k, v in reversed(lines)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parquet_scan_reads_only_the_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).selectExpr("id", "id AS wide", "id AS wider").write.parquet(path)
    plan = read_parquet(spark, path, columns=["id"]).filter("id > 3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,3)" in plan


def test_json_records(spark, rows, tmp_path):
    records = [{"a": 1, "b": 2}, {"a": 3}]
    one = _file(tmp_path, "one.json", json.dumps(records, indent=2))
    assert rows(read_json_records(spark, one, "a BIGINT, b BIGINT", multiline=True)) == [(1, 2), (3, None)]
    assert rows(read_json_records(spark, one, "a BIGINT, b BIGINT", columns=["a"], multiline=True)) == [(1,), (3,)]
    lines = _file(tmp_path, "lines.json", "\n".join([json.dumps(records), json.dumps({"a": 5, "b": 6})]))
    assert rows(read_json_records(spark, lines, "a BIGINT, b BIGINT")) == [(1, 2), (3, None), (5, 6)]


def _ingest(spark, tmp_path, **options):
    ingest_files(
        spark,
        str(tmp_path / "in"),
        spark.createDataFrame([], "id bigint, flag string").schema,
        str(tmp_path / "out"),
        str(tmp_path / "progress"),
        transform=lambda df: cast_columns(df, {"flag": "bool"}),
        **options,
    )
    return sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())


def test_ingest(spark, tmp_path):
    _file(tmp_path / "in", "1.csv", "id,flag\n1,t\n2,f\n")
    _file(tmp_path / "in", "2.csv", "id,flag\n3,t\n")
    first = [(1, True), (2, False), (3, True)]
    assert _ingest(spark, tmp_path, files_per_batch=1) == first
    assert _ingest(spark, tmp_path) == first
    _file(tmp_path / "in", "3.csv", "id,flag\n4,f\n")
    assert _ingest(spark, tmp_path) == first + [(4, False)]


def test_ingest_stops_at_a_bad_file_and_goes_on_after_its_repair(spark, tmp_path):
    _file(tmp_path / "in", "1.csv", "id,flag\n1,t\n")
    assert _ingest(spark, tmp_path) == [(1, True)]
    _file(tmp_path / "in", "2.csv", "id,flag\nx,t\n")
    with pytest.raises(Exception):
        _ingest(spark, tmp_path)
    _file(tmp_path / "in", "2.csv", "id,flag\n2,t\n")
    assert _ingest(spark, tmp_path) == [(1, True), (2, True)]


def test_dates_survive_csv(spark, rows, tmp_path):
    at = datetime.datetime(2024, 5, 6, 7, 8, 9, 123456)
    path = write_csv(spark.createDataFrame([(at,)], "t timestamp_ntz"), str(tmp_path / "t"))
    assert rows(cast_columns(read_csv(spark, path), {"t": "timestamp"})) == [(at,)]
    assert read_csv(spark, path).filter(F.col("t").startswith("2024-05-06")).count() == 1
