"""CSV files with cells that span lines, cut in many places."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import write_csv
from tidemark.sources import infer_schema, read_csv, read_parquet
from tidemark.streaming import ingest_batches, ingest_files


@pytest.fixture
def small_splits(spark):
    """Files are cut every few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "300b")
    spark.conf.set(names[1], "1b")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def _awkward_rows(seed, n):
    draw = random.Random(seed)
    pieces = ["a", "b,c", '"', "\n", "\n\n", "\r\n", " ", ";", "1,2,3\n4,5,6", 'x"y', "é😀", "-" * 40]
    return [(k, "".join(draw.choices(pieces, k=draw.randint(0, 9))) or None, draw.choice(["z", "", 'q"\n'])) for k in range(n)]


def _write(path, rows, header=("k", "t", "u"), end="\n", sep=","):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, delimiter=sep, lineterminator=end)
        if header:
            writer.writerow(header)
        for row in rows:
            # A null cell is empty, an empty text is quoted.
            cells = ["" if c is None else '"' + c.replace('"', '""') + '"' if isinstance(c, str) else str(c) for c in row]
            out.write(sep.join(cells) + end)
    return str(path)


@pytest.mark.parametrize("columns", [None, ["t"], ["k"], ["u", "k"]])
def test_a_break_in_the_last_cell(spark, tmp_path, columns):
    """Line by line this would read as three rows of the right width."""
    df = spark.createDataFrame([(1, "x", "a\n7,c,d"), (2, "y", "z")], "k long, t string, u string")
    path = write_csv(df, str(tmp_path / "c"))
    found = read_csv(spark, path, df.schema, columns=columns)
    assert found.count() == 2 and sorted(found.collect()) == sorted(df.select(found.columns).collect())
    strict = read_csv(spark, path, df.schema, columns=columns, multiline=False)
    for act in (strict.collect, strict.count):
        with pytest.raises(Exception, match="line break"):
            act()


@pytest.mark.parametrize(("seed", "end", "sep"), [(1, "\n", ","), (2, "\r\n", ","), (3, "\n", ";"), (4, "\n", "\t")])
def test_records_over_many_splits(spark, tmp_path, small_splits, seed, end, sep):
    data = _awkward_rows(seed, 120)
    path = _write(tmp_path / "t.csv", data, end=end, sep=sep)
    found = read_csv(spark, path, "k BIGINT, t STRING, u STRING", sep=sep)
    assert found.rdd.getNumPartitions() > 10
    assert sorted(map(tuple, found.collect())) == data and found.count() == len(data)
    placed = read_csv(spark, path, "k BIGINT", sep=sep, position="at").orderBy("at")
    assert [r.k for r in placed.collect()] == list(range(120))


def test_one_cell_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {k}, with \"quotes\"" for k in range(400))
    data = [(0, "a", "b"), (1, long, long), (2, None, ""), (3, "c", long)]
    path = _write(tmp_path / "t.csv", data)
    assert sorted(map(tuple, read_csv(spark, path, "k BIGINT").collect())) == data


@pytest.mark.parametrize("size", [1, 7, 50, 1000])
def test_chunks(spark, tmp_path, small_splits, size):
    data = _awkward_rows(5, 60) + [(60, "end", "\n" * 900), (61, "x", "y")]
    _write(tmp_path / "a.csv", data[:40])
    _write(tmp_path / "b.csv", data[40:])
    for part in {0, 1, 39 // size, 40 // size, 60 // size, 61 // size, 62 // size, 70}:
        found = read_csv(spark, folder=str(tmp_path), schema="k BIGINT", chunk=(part, size))
        assert sorted(map(tuple, found.collect())) == data[part * size : (part + 1) * size]
    with pytest.raises(ValueError):
        read_csv(spark, folder=str(tmp_path), chunk=(-1, 5))


@pytest.fixture
def splits_by_total(spark):
    """The size of splits depends on the bytes of all files that a scan reads, as by default."""
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n, None) for n in names]
    spark.conf.set(names[0], "40")
    spark.conf.set(names[1], "1b")
    yield
    for name, value in zip(names, before):
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_some_files_without_a_cut_record(spark, tmp_path, splits_by_total):
    """What is read again of some files is split as when all were indexed."""
    data = [(0, "a", "b")] * 400 + [(k, f"line {k}\n" * 30, "\n\n") for k in range(1, 41)] + [(41, "y", "z")] * 300
    for k, rows in enumerate((data[:400], data[400:440], data[440:])):
        _write(tmp_path / f"{k}.csv", rows)
    found = read_csv(spark, folder=str(tmp_path), schema="k BIGINT, t STRING, u STRING", position="at")
    assert found.rdd.getNumPartitions() > 10
    assert [tuple(r)[:3] for r in found.orderBy("at").collect()] == data
    for part, size in ((0, 150), (2, 150), (4, 100), (60, 7), (14, 50), (3, 200)):
        chunk = read_csv(spark, folder=str(tmp_path), schema="k BIGINT", chunk=(part, size))
        assert sorted(map(tuple, chunk.collect())) == sorted(data[part * size : (part + 1) * size])


def test_only_overlapping_splits_are_parsed(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    _write(path, [(k, "x" * 50, "y") for k in range(200)])
    with open(path, "a", encoding="utf-8") as out:
        out.write("no number,x,y\n")
    assert read_csv(spark, str(path), "k BIGINT", chunk=(3, 10)).count() == 10
    with pytest.raises(Exception):
        read_csv(spark, str(path), "k BIGINT", chunk=(20, 10)).collect()


def test_files_without_header_and_blank_lines(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    path.write_text('1,"a\n\nb"\n\n  \n2,c\n3,"""q"""', encoding="utf-8")
    found = read_csv(spark, str(path), "k BIGINT, t STRING", header=False)
    assert sorted(map(tuple, found.collect())) == [(1, "a\n\nb"), (2, "c"), (3, '"q"')]


def test_a_single_column(spark, tmp_path):
    df = spark.createDataFrame([("a\nb",), ('say "c"',)], "t string")
    path = write_csv(df, str(tmp_path / "c"))
    assert sorted(read_csv(spark, path).collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="line break"):
        read_csv(spark, path, multiline=False).collect()


def test_bare_quotes_and_returns_fail(spark, tmp_path):
    """They would join lines that are records of their own, or part one that is none."""
    for k, text in enumerate(['k,t\n1,5" pipe\n2,x\n3,7" pipe\n', 'k,t\n1,a\rb\n2,"x\ny"\n']):
        path = tmp_path / f"t{k}.csv"
        path.write_bytes(text.encode())
        with pytest.raises(Exception, match="not one CSV record"):
            read_csv(spark, str(path), "k STRING, t STRING").collect()
    path.write_text('k,t\n1,"open\n2,x\n', encoding="utf-8")
    with pytest.raises(ValueError, match="ends inside a quoted cell"):
        read_csv(spark, str(path))


def test_returns_inside_cells(spark, tmp_path):
    path = _write(tmp_path / "t.csv", [(1, "a\rb", "c"), (2, "d", "e")])
    assert sorted(map(tuple, read_csv(spark, path, "k BIGINT").collect())) == [(1, "a\rb", "c"), (2, "d", "e")]


def test_headers_are_compared(spark, tmp_path):
    _write(tmp_path / "a.csv", [(1, "a\nb", "c")])
    _write(tmp_path / "b.csv", [(1, "a\nb", "c")], header=("t", "k", "u"))
    with pytest.raises(Exception, match="the header is"):
        read_csv(spark, folder=str(tmp_path), schema="u STRING").collect()
    kept = read_csv(spark, folder=str(tmp_path), schema="k BIGINT", exclude=["b.csv"])
    assert [tuple(r) for r in kept.collect()] == [(1, "a\nb", "c")]


def test_cells_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('k,t\n1,"a\nb"\nx,c\n2\n3,d,e\n4,f\n', encoding="utf-8")
    schema = "k BIGINT, t STRING"
    with pytest.raises(Exception):
        read_csv(spark, str(path), schema).collect()
    kept = read_csv(spark, str(path), schema, mode="DROPMALFORMED")
    assert sorted(map(tuple, kept.collect())) == [(1, "a\nb"), (4, "f")]
    assert read_csv(spark, str(path), schema, mode="PERMISSIVE").count() == 5


def test_types_are_inferred_across_lines(spark, tmp_path):
    path = _write(tmp_path / "t.csv", [(1, "7\n8", "9"), (2, "x", "10")])
    assert [f.dataType.simpleString() for f in infer_schema(spark, path).fields] == ["bigint", "string", "bigint"]


def test_duplicate_column_in_a_changed_file(spark, tmp_path):
    path = _write(tmp_path / "t.csv", [(1, "a\nb", "c")])
    found = read_csv(spark, path, "k BIGINT")
    _write(tmp_path / "t2.csv", [(2, "a", "c")])
    assert found.count() == 1


def test_ingest_fails_on_breaks_unless_told(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "x", "a\n7,c,d"), (2, "y", "z")], "k long, t string, u string")
    folder = write_csv(df, str(tmp_path / "in"))
    with pytest.raises(Exception, match="line break"):
        ingest_files(spark, folder, df.schema, str(tmp_path / "out"), str(tmp_path / "check"))
    for _ in range(2):
        ingest_files(spark, folder, df.schema, str(tmp_path / "o2"), str(tmp_path / "c2"), multiline=True)
    write_csv(spark.createDataFrame([(3, "p\nq", None)], df.schema), folder, mode="append")
    ingest_files(spark, folder, df.schema, str(tmp_path / "o2"), str(tmp_path / "c2"), multiline=True)
    assert rows(read_parquet(spark, str(tmp_path / "o2"), nested=True)) == [(1, "x", "a\n7,c,d"), (2, "y", "z"), (3, "p\nq", None)]
    with pytest.raises(ValueError):
        ingest_files(spark, folder, df.schema, "o", "c", multiline=True, partition_by=["k"])


def test_a_batch_that_is_run_again_adds_nothing(spark, rows, tmp_path):
    df = spark.range(0, 40).selectExpr("id", "concat('a\n', id) t")
    folder = write_csv(df.repartition(4), str(tmp_path / "in"))
    target = str(tmp_path / "out")
    for run in range(2):  # the second run has lost its checkpoint, and starts over
        ingest_batches(
            spark, folder, df.schema, target, str(tmp_path / f"check{run}"), "csv", lambda d: d.where(F.col("id") >= 0), files_per_batch=2
        )
    assert rows(read_csv(spark, target, df.schema, nested=True)) == rows(df)
