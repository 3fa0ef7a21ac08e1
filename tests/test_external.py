"""Web API and database access, without a server: pages are files, and the options
handed to Spark's JDBC reader and writer are checked as such."""

import datetime
import io
import json
import tempfile
import urllib.error
from decimal import Decimal
from types import SimpleNamespace

import pytest

from tidemark.plans import Layout, load_database
from tidemark.schemas import CUSTOMER_RECORDS, DATABASE_TYPES
from tidemark.session import fresh_path, shared_folder
from tidemark.sinks.jdbc import write_options
from tidemark.sources import bind, read_api
from tidemark.sources.jdbc import read_options
from tidemark.sources.web import PagedRecordsReader


def _customer(i):
    return {
        "id": str(i),
        "gender": "female",
        "age": 30 + i,
        "country": "Perú",
        "city": "Arequipa",
        "preferred_channel": "push",
        "loyalty_level": "gold",
        "average_purchase_value": 400 + i,
        "churn_risk": 0.25,
    }


def test_pages(spark, rows, tmp_path):
    for page in (1, 2, 3):
        records = [_customer(10 * page + i) for i in range(3)]
        (tmp_path / f"{page}.json").write_text(json.dumps(records), encoding="utf-8")
    url = f"file://{tmp_path}/{{page}}.json"
    df = read_api(spark, url, CUSTOMER_RECORDS, pages=(1, 3))
    assert df.count() == 9 and df.rdd.getNumPartitions() == 3
    assert df.agg({"average_purchase_value": "max"}).first()[0] == 432.0
    chosen = read_api(spark, url, CUSTOMER_RECORDS, columns=["id", "country"], pages=(2, 2))
    assert rows(chosen) == [("20", "Perú"), ("21", "Perú"), ("22", "Perú")]


def test_request_urls():
    options = {"url": "http://api/users", "params": '{"q": "a b"}', "page_param": "page", "last_page": "2"}
    urls = [p.value for p in PagedRecordsReader(CUSTOMER_RECORDS, options).partitions()]
    assert urls == ["http://api/users?q=a+b&page=1", "http://api/users?q=a+b&page=2"]
    with pytest.raises(ValueError):
        PagedRecordsReader(CUSTOMER_RECORDS, {})


def _answers(monkeypatch, *answers):
    asked, slept = [], []
    queue = list(answers)

    def urlopen(url, timeout):
        asked.append((url, timeout))
        answer = queue.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return io.BytesIO(json.dumps(answer).encode())

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    monkeypatch.setattr("time.sleep", slept.append)
    return asked, slept


def _busy(code=429, wait="7"):
    return urllib.error.HTTPError("http://api", code, "busy", {"Retry-After": wait} if wait else {}, None)


def _read(options=None):
    reader = PagedRecordsReader(CUSTOMER_RECORDS, {"url": "http://api", **(options or {})})
    return list(reader.read(reader.partitions()[0]))


def test_busy_server_is_asked_again(monkeypatch):
    asked, slept = _answers(monkeypatch, _busy(), _busy(wait=None), [_customer(1)])
    assert [r[0] for r in _read({"timeout": "2"})] == ["1"]
    assert asked == [("http://api", 2.0)] * 3 and slept == [7.0, 1.0]


def test_other_errors_and_endless_refusals_fail(monkeypatch):
    _answers(monkeypatch, _busy(500))
    with pytest.raises(urllib.error.HTTPError):
        _read()
    asked, _ = _answers(monkeypatch, *[_busy()] * 3)
    with pytest.raises(urllib.error.HTTPError):
        _read({"retries": "2"})
    assert len(asked) == 3


def test_missing_fields_are_null_and_one_object_is_one_row(monkeypatch):
    _answers(monkeypatch, {"id": 5, "age": 20, "churn_risk": 1})
    assert _read() == [("5", None, 20, None, None, None, None, None, 1.0)]


def test_bound_parameters():
    query = "SELECT ':x', a::int, \"c:d\" FROM t WHERE n = :n AND s = :s AND d >= :d AND at < :at AND f = :f AND z IS :z"
    params = {
        "n": Decimal("1.50"),
        "s": "O'Hara :n",
        "d": datetime.date(2024, 5, 6),
        "at": datetime.datetime(2024, 5, 6, 7, 8),
        "f": True,
        "z": None,
    }
    assert bind(query, params) == (
        "SELECT ':x', a::int, \"c:d\" FROM t WHERE n = 1.50 AND s = 'O''Hara :n' AND d >= DATE '2024-05-06' "
        "AND at < TIMESTAMP '2024-05-06 07:08:00' AND f = TRUE AND z IS NULL"
    )
    with pytest.raises(ValueError):
        bind("SELECT :a", {})
    with pytest.raises(ValueError):
        bind("SELECT :a", {"a": "x\\"})
    with pytest.raises(TypeError):
        bind("SELECT :a", {"a": [1]})


def test_read_options():
    assert read_options("jdbc:x", query="SELECT :n AS n", params={"n": 3}, properties={"user": "u"}) == {
        "url": "jdbc:x",
        "fetchsize": "10000",
        "user": "u",
        "query": "SELECT 3 AS n",
    }
    split = read_options("jdbc:x", query="SELECT 1 AS id", partition=("id", 0, 100, 8))
    assert split["dbtable"] == "(SELECT 1 AS id) t" and split["numPartitions"] == "8" and "query" not in split
    assert read_options("jdbc:x", table="clients")["dbtable"] == "clients"
    for wrong in ({}, {"query": "q", "table": "t"}):
        with pytest.raises(ValueError):
            read_options("jdbc:x", **wrong)


def test_write_options():
    options = write_options("jdbc:x", "clients", connections=4, truncate=True, properties={"user": "u"})
    assert options == {
        "url": "jdbc:x",
        "dbtable": "clients",
        "batchsize": "10000",
        "numPartitions": "4",
        "truncate": "true",
        "user": "u",
    }


def test_database_load_order_columns_and_types(spark, tmp_path, monkeypatch):
    at = Layout(str(tmp_path))
    holiday_flags = "date_holiday boolean, sent_at_holiday boolean, opened_first_time_at_holiday boolean, opened_last_time_at_holiday boolean"
    tables = {
        "campaigns": "id bigint, total_count bigint, subject_length bigint, started_at_holiday boolean, finished_at_holiday boolean",
        "clients": "client_id bigint, first_purchase_date timestamp_ntz, age bigint, average_purchase_value double, churn_risk double",
        "holidays": "date timestamp_ntz, holiday string",
        "messages": f"id bigint, message_id string, {holiday_flags}",
        "performance": ", ".join(f"{c} double" for c in DATABASE_TYPES["agg_campaign_performance"]),
    }
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(at.gold(name))
    loaded = []

    def write(df, url, table, types, properties):
        loaded.append((table, df.columns, types))

    monkeypatch.setattr("tidemark.plans.jobs.write_jdbc", write)
    load_database(spark, at, "jdbc:x", {"user": "u"})
    assert [t for t, _, _ in loaded] == ["campaign", "clients", "holidays", "messages", "agg_campaign_performance"]
    by_table = {t: columns for t, columns, _ in loaded}
    assert by_table["campaign"] == ["id", "total_count", "subject_length"]
    assert by_table["messages"] == ["message_id"]
    assert all(types == DATABASE_TYPES[t] for t, _, types in loaded)


def test_session_folder(spark):
    folder = shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or folder).rstrip("/")
    assert fresh_path(spark, "x").startswith(folder) and fresh_path(spark, "x") != fresh_path(spark, "x")


def _session(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
    )


def test_only_local_sessions_use_a_folder_of_this_machine():
    assert shared_folder(_session("yarn", "hdfs://cluster/shared/")) == "hdfs://cluster/shared"
    assert shared_folder(_session("local[8]", None)).startswith(tempfile.gettempdir())
    with pytest.raises(RuntimeError):
        shared_folder(_session("yarn", None))
