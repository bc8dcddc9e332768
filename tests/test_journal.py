"""The journal of refreshes and triggers: one file a day, failed and empty triggers listed."""

import datetime as dt

import pytest
from clinic import encounters

from wardflow.plans.graph import Graph, Node, Source, clinical_graph
from wardflow.sources import files, schemas
from wardflow.streaming.journal import TRIGGERS, Journal
from wardflow.streaming.refresh import GraphRefresher


def test_days_that_are_over_are_one_file(spark, root, monkeypatch):
    journal = Journal(spark, root, "k bigint, t string")
    assert journal.read().count() == 0
    for day in (1, 2):
        for k in range(4):
            files.write_text(spark, f"{root}/2024010{day}T0{k}0000000000-aa.json", f'{{"k": {k}, "t": "day {day}"}}\n')
    files.write_text(spark, f"{root}/20240101.json", '{"k": 9, "t": "day 1"}\n')
    assert journal.read().count() == 9
    journal.sweep(dt.datetime(2024, 1, 2, tzinfo=dt.UTC))
    assert [n for n in files.names(spark, root) if n.startswith("20240101")] == ["20240101.json"]
    assert len(files.names(spark, root)) == 5 and journal.read().count() == 9
    files.write_text(spark, f"{root}/20240101T000000000000-bb.json", '{"k": 0, "t": "day 1"}\n')  # left by a crash
    assert journal.read().count() == 9
    journal.add([{"k": 5, "t": "now"}])
    assert {n for n in files.names(spark, root) if n[8] != "T"} == {"20240101.json", "20240102.json"}
    assert len(files.names(spark, root)) == 3 and journal.read().count() == 10


def test_triggers_of_a_store(spark, root):
    store = GraphRefresher(spark, clinical_graph(), f"{root}/a", n_buckets=1)
    other = GraphRefresher(spark, clinical_graph(), f"{root}/b", n_buckets=1)
    store.land("raw.encounter_fact", encounters(spark))
    for _ in range(2):  # the second one has nothing to do
        store.refresh_available(only=["curated.fact_encounter"])
    got = store.triggers().collect()
    assert {r.pace for r in got} == {"only curated.fact_encounter"}
    assert [r.input_rows for r in got if r.state == "WORKED"] == [10] and sum(r.state == "STOPPED" for r in got) == 2
    assert other.triggers().count() == 0 and not any(r.message for r in got)
    assert store.history().count() == 1


def test_failed_triggers_say_why(spark, root):
    def broken(rows):
        return rows.selectExpr("pat_id", "raise_error('bad node') as x", "bucket", "slice")

    graph = Graph([Source("raw.encounter_fact", schemas.ENCOUNTER, "pat_id")], [Node("curated.broken", broken, ("raw.encounter_fact",))])
    store = GraphRefresher(spark, graph, root, n_buckets=1)
    store.land("raw.encounter_fact", encounters(spark))
    with pytest.raises(Exception, match="bad node"):
        store.refresh_available()
    failed = [r for r in store.triggers().collect() if r.state == "FAILED"]
    assert len(failed) == 1 and failed[0].message
    assert Journal(spark, f"{root}/_state/triggers", TRIGGERS).read().where("state = 'FAILED'").count() == 1
