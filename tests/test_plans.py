"""The whole chain of jobs on a few literal files."""

import json
import os

import pytest

from tidemark import plans
from tidemark.schemas import RAW_CAMPAIGNS, RAW_MESSAGES
from tidemark.sources import read_csv, read_parquet


def _write(path, names, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(names)] + [",".join(str(r.get(n, "")) for n in names) for r in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def _message(i, campaign, client, **flags):
    row = {"id": i, "message_id": f"m{i}", "campaign_id": campaign, "client_id": client, "channel": "email"}
    row |= {"date": "2024-05-01", "sent_at": "2024-05-01 10:00:00"}
    row |= {f"is_{f}": "f" for f in "opened clicked purchased unsubscribed hard_bounced soft_bounced complained blocked".split()}
    return row | flags


@pytest.fixture
def at(tmp_path):
    campaign = {"subject_with_emoji": "t", "warmup_mode": "f", "channel": "email", "started_at": "2024-05-01 07:22:36.615023"}
    campaigns = [{"id": 1, "total_count": 10.0, **campaign}, {"id": 2, **campaign, "channel": ""}, {"id": 3, **campaign, "started_at": ""}]
    _write(tmp_path / "bronze/campaigns.csv", RAW_CAMPAIGNS.names, campaigns)
    clients = [{"client_id": i, "first_purchase_date": "2023-01-0%d" % (i - 9)} for i in (10, 11)]
    _write(tmp_path / "bronze/clients.csv", ["client_id", "first_purchase_date"], clients)
    holidays = [{"date": "2024-05-01", "holiday": "Trabajo"}, {"date": "2024-05-01", "holiday": "Otra"}, {"date": "2024-12-25", "holiday": "Navidad"}]
    _write(tmp_path / "bronze/holidays.csv", ["date", "holiday"], holidays)
    messages = [
        _message(1, 1, 10, is_opened="t", is_clicked="t", opened_first_time_at="2024-12-25 01:00:00"),
        _message(2, 1, 11, is_hard_bounced="t", platform="phone"),
        _message(3, 3, 10),
        _message(4, 2, 99),
    ]
    _write(tmp_path / "bronze/messages/1.csv", RAW_MESSAGES.names, messages)
    record = {"gender": "female", "age": 41, "country": "Perú", "city": "Lima", "preferred_channel": None, "loyalty_level": "gold", "average_purchase_value": 4, "churn_risk": 0.5}
    (tmp_path / "bronze/customers.json").write_text(json.dumps([{"id": "10", **record}]), encoding="utf-8")
    return plans.Layout(str(tmp_path))


def test_chain(spark, rows, at, tmp_path):
    plans.build_silver(spark, at)
    assert rows(read_parquet(spark, at.silver("campaigns")), "id", "channel", "total_count", "subject_length") == [
        (1, "email", 10, 0),
        (2, "unknow", 0, 0),
    ]
    assert rows(read_parquet(spark, at.silver("holidays")), "holiday") == [("Navidad",), ("Trabajo",)]
    assert rows(read_parquet(spark, at.silver("messages")), "id", "platform") == [
        (1, "unknow"),
        (2, "phone"),
        (3, "unknow"),
        (4, "unknow"),
    ]
    assert rows(read_parquet(spark, at.silver("messages_known")), "id") == [(1,), (2,)]

    plans.build_gold(spark, at)
    performance = read_parquet(spark, at.gold("performance"))
    assert rows(performance) == [(1, 2, 1, 1, 0, 0, 1, 0.5, 1.0, 0.0, 0.0, 0.5)]
    flags = [f"{c}_holiday" for c in ("date", "sent_at", "opened_first_time_at", "opened_last_time_at")]
    assert rows(read_parquet(spark, at.gold("messages")), "id", *flags) == [
        (1, True, True, True, None),
        (2, True, True, None, None),
    ]
    clients = read_parquet(spark, at.gold("clients"))
    assert rows(clients.drop("first_purchase_date")) == [
        (10, "female", 41, "Perú", "Lima", "unknow", "gold", 4.0, 0.5),
        (11, "other", 18, "Colombia", "Bogotá", "unknow", "unsubscribed", 0.0, 0.0),
    ]
    assert rows(read_parquet(spark, at.gold("holidays")), "day", "month", "year", "weekday", "holiday") == [
        (1, 5, 2024, "Miercoles", "Trabajo"),
        (25, 12, 2024, "Miercoles", "Navidad"),
    ]
    assert rows(read_csv(spark, at.export("performance_full"), "campaign_id BIGINT, total_sent BIGINT"), "campaign_id", "total_sent") == [
        (1, 2),
        (2, 1),
        (3, 1),
    ]

    plans.export_csv(spark, at)
    reports = plans.validate_gold(spark, at)
    assert {n: r.filter("estado = 'FALLA'").count() for n, r in reports.items()} == {"campaigns": 1, "clients": 0, "messages": 0}
    written = read_csv(spark, at.check("campaigns"))
    assert written.columns == ["columna", "regla", "estado", "detalle"] and written.count() == len(plans.CAMPAIGN_RULES) + 1
    assert rows(written.filter("estado = 'FALLA'")) == [
        ("finished_at", "nulos_mayor_95", "FALLA", "100.00% de nulos en la columna")
    ]


def test_a_rerun_changes_nothing_and_new_messages_come_in_once(spark, rows, at, tmp_path):
    plans.build_silver(spark, at)
    plans.build_silver(spark, at)
    assert read_parquet(spark, at.silver("messages")).count() == 4
    assert read_parquet(spark, at.silver("campaigns")).count() == 2
    _write(tmp_path / "bronze/messages/2.csv", RAW_MESSAGES.names, [_message(5, 2, 11)])
    plans.build_silver(spark, at)
    assert rows(read_parquet(spark, at.silver("messages_known")), "id") == [(1,), (2,), (5,)]


def test_the_shared_folder(spark):
    """Named by the session's setting, else by the context, else only a local session has one."""
    from types import SimpleNamespace

    from tidemark import session

    def named(setting, of_context, master):
        context = SimpleNamespace(getCheckpointDir=lambda: of_context, master=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting), sparkContext=context)

    assert session.shared_folder(named("hdfs://a/b/", "hdfs://c", "yarn")) == "hdfs://a/b"
    assert session.shared_folder(named(None, "hdfs://c", "yarn")) == "hdfs://c"
    assert session.fresh_path(named(None, "hdfs://c", "yarn"), "x").startswith("hdfs://c/tidemark/x-")
    assert os.path.isabs(session.shared_folder(named(None, None, "local[2]")))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(named(None, None, "yarn"))
