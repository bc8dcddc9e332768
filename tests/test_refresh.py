import random

import pytest
from clinic import (
    AS_OF,
    ENCOUNTERS,
    LABS,
    LATE_ENCOUNTERS,
    LATE_PATIENTS,
    PATIENTS,
    PROVIDERS,
    encounters,
    labs,
    patients,
    providers,
    rows,
)
from test_nodes import DASHBOARD, LATE_DASHBOARD, LATE_SUMMARY, SUMMARY, dashboard_of, summary_of

from wardflow.plans import nodes
from wardflow.plans.graph import DOWNSTREAM, Graph, Node, Source, clinical_graph, lag_seconds
from wardflow.sources import schemas
from wardflow.streaming.refresh import GraphRefresher


def full(store):
    """Every derived table computed directly from the landed raw rows."""
    p, e = store.table("raw.patient_dim"), store.table("raw.encounter_fact")
    lab, pr = store.table("raw.lab_results"), store.table("raw.provider_dim")
    dim, fact = nodes.dim_patient(p, AS_OF), nodes.fact_encounter(e, pr, AS_OF)
    flagged = nodes.fact_lab_results(lab)
    return {
        "curated.dim_patient": dim,
        "curated.dim_provider": nodes.dim_provider(pr),
        "curated.fact_encounter": fact,
        "curated.fact_lab_results": flagged,
        "gold.patient_encounter_summary": nodes.patient_encounter_summary(dim, fact, AS_OF),
        "gold.abnormal_results_summary": nodes.abnormal_results(flagged, fact, dim),
        "gold.department_dashboard": nodes.department_dashboard(fact),
    }


def assert_equals_full(store):
    for name, want in full(store).items():
        got = store.table(name, AS_OF)
        assert got.columns == want.columns, name
        assert sorted(map(str, rows(got))) == sorted(map(str, rows(want))), name


def test_late_rows_reach_every_layer(spark, root):
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=4)
    store.land("raw.provider_dim", providers(spark))
    store.land("raw.patient_dim", patients(spark))
    store.land("raw.encounter_fact", encounters(spark))
    store.land("raw.lab_results", labs(spark))
    store.refresh_available()
    assert summary_of(store.table("gold.patient_encounter_summary", AS_OF)) == SUMMARY
    assert dashboard_of(store.table("gold.department_dashboard", AS_OF)) == DASHBOARD
    assert store.table("gold.abnormal_results_summary").count() == 8

    store.land("raw.patient_dim", patients(spark, LATE_PATIENTS))
    store.land("raw.encounter_fact", encounters(spark, LATE_ENCOUNTERS))
    store.refresh_available()
    assert summary_of(store.table("gold.patient_encounter_summary", AS_OF)) == {**SUMMARY, **LATE_SUMMARY}
    assert dashboard_of(store.table("gold.department_dashboard", AS_OF)) == {**DASHBOARD, **LATE_DASHBOARD}
    assert_equals_full(store)

    history = store.history(50).collect()
    assert {r.state for r in history} == {"SUCCEEDED"}
    newest = max(r.batch_id for r in history)
    second = {r.name: r.touched_cells for r in history if r.batch_id == newest}
    assert second["curated.fact_encounter"] == 1  # one patient touches one cell
    assert "curated.dim_provider" not in second
    assert all(r.refresh_seconds >= 0 for r in history)
    assert store.history(3).count() == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_equals_full_recompute(spark, root, seed):
    """Rows arrive in random pieces: providers and patients after the rows that refer to them, and the other way."""
    rng = random.Random(seed)
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=3)
    pending = [
        ("raw.patient_dim", patients, PATIENTS + LATE_PATIENTS),
        ("raw.encounter_fact", encounters, ENCOUNTERS + LATE_ENCOUNTERS),
        ("raw.lab_results", labs, LABS),
        ("raw.provider_dim", providers, PROVIDERS),
    ]
    pieces = []
    for name, make, data in pending:
        data = rng.sample(data, len(data))
        cut = rng.randrange(1, len(data))
        pieces += [(name, make, data[:cut]), (name, make, data[cut:])]
    rng.shuffle(pieces)
    for i, (name, make, data) in enumerate(pieces):
        store.land(name, make(spark, data), f"day-{rng.randrange(3)}")
        if i % 3 == 2 or i == len(pieces) - 1:
            store.refresh_available()
    assert_equals_full(store)


def test_replay_and_rebuild_change_nothing(spark, root):
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=2)
    store.land("raw.patient_dim", patients(spark))
    store.land("raw.encounter_fact", encounters(spark))
    store.land("raw.provider_dim", providers(spark))
    store.refresh_available()
    before = sorted(map(str, rows(store.table("gold.department_dashboard", AS_OF))))
    cells = {n: store._cells_of(store._read(n)) for n in ("raw.encounter_fact", "raw.encounter_keys")}
    store._walk(cells, {}, 0)
    store.rebuild()
    assert sorted(map(str, rows(store.table("gold.department_dashboard", AS_OF)))) == before
    assert_equals_full(store)


def test_bucket_that_loses_all_rows_is_emptied(spark, root):
    """A node may drop rows when an input grows; the bucket it leaves empty must not keep the old ones."""

    def unmatched(labs, providers):
        return labs.join(providers.select("prov_id"), labs.test_code == providers.prov_id, "left_anti").select(
            *schemas.LAB_RESULT.names, "bucket", "slice"
        )

    from wardflow.plans.graph import Lookup

    graph = Graph(
        [Source("raw.lab_results", schemas.LAB_RESULT, "pat_id"), Source("raw.provider_dim", schemas.PROVIDER, "prov_id")],
        [
            Node("curated.unmatched", unmatched, ("raw.lab_results", "raw.provider_dim"),
                 lookups=(Lookup("raw.provider_dim", "prov_id", "raw.lab_results", "test_code"),)),
        ],
    )
    store = GraphRefresher(spark, graph, root, n_buckets=2)
    store.land("raw.lab_results", labs(spark, LABS[3:4]))
    store.refresh_available()
    assert store.table("curated.unmatched").count() == 1
    store.land("raw.provider_dim", providers(spark, [("WBC", "x", "y", "z", "1", "true")]))
    store.refresh_available()
    assert store.table("curated.unmatched").count() == 0


def test_gold_is_published_after_its_refresh(spark, root):
    from wardflow.sources.tables import export_open

    def publish(store, name):
        if name == "gold.department_dashboard":
            export_open(store.table(name, AS_OF), f"{root}/shared/dept_dashboard")

    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=2, after_node=publish)
    store.land("raw.encounter_fact", encounters(spark))
    store.refresh_available()
    assert dashboard_of(spark.read.parquet(f"{root}/shared/dept_dashboard")) == DASHBOARD


def test_failed_refresh_is_recorded(spark, root):
    def broken(labs):
        return labs.selectExpr("pat_id", "raise_error('bad node') as x", "bucket", "slice")

    graph = Graph(
        [Source("raw.lab_results", schemas.LAB_RESULT, "pat_id")],
        [Node("curated.broken", broken, ("raw.lab_results",))],
    )
    store = GraphRefresher(spark, graph, root, n_buckets=2)
    store.land("raw.lab_results", labs(spark))
    with pytest.raises(Exception, match="bad node"):
        store.refresh_available()
    row = store.history().first()
    assert row.state == "FAILED" and row.state_message
    assert [r.scheduling_state for r in graph.listing(spark, history=store.history()).collect()] == ["FAILED"]


def test_graph_lags(spark):
    graph = clinical_graph("15 minutes")
    assert graph.lag_of("gold.department_partials") == "15 minutes"
    assert graph.trigger_interval() == "15 minutes"
    assert lag_seconds("1 hour") == 3600 and lag_seconds(DOWNSTREAM) == float("inf")
    listing = {r.name: r for r in graph.listing(spark).collect()}
    assert len(listing) == 10
    assert listing["gold.patient_encounter_summary"].inputs == ["curated.dim_patient", "curated.encounter_partials"]
    assert listing["gold.department_partials"].target_lag == DOWNSTREAM
    assert listing["gold.department_dashboard"].target_lag == "15 minutes"
    order = list(graph.nodes)
    assert order.index("curated.fact_encounter") < order.index("gold.department_dashboard")


def test_node_cannot_be_fresher_than_its_inputs():
    with pytest.raises(ValueError, match="fresher"):
        clinical_graph("1 hour", "1 minute")


def test_gold_waits_for_its_lag(spark, root):
    """Curated tables follow at once, gold tables catch up with what their own query has not read, also after a
    restart in between."""
    graph = clinical_graph("1 second", "1 hour")

    def opened():
        return GraphRefresher(spark, graph, root, n_buckets=2)

    def visits(store):
        return store.table("gold.department_dashboard", AS_OF).agg({"encounter_count": "sum"}).first()[0]

    store = opened()
    store.land("raw.patient_dim", patients(spark))
    store.land("raw.encounter_fact", encounters(spark, ENCOUNTERS[:4]))
    store.refresh_available()
    assert visits(store) == 4
    store = opened()
    query = store.start()
    try:
        query.queries["1 hour"].processAllAvailable()  # its first look comes at once, the next one after its lag
        for i, data in enumerate((ENCOUNTERS[4:7], ENCOUNTERS[7:])):
            store.land("raw.encounter_fact", encounters(spark, data))
            store.land("raw.lab_results", labs(spark, LABS[5 * i : 5 * i + 5]))
            store.land("raw.provider_dim", providers(spark, PROVIDERS[i : i + 1]))
            query.processAllAvailable()
    finally:
        query.stop()
        query.awaitTermination()
    assert store.table("curated.fact_encounter").count() == 10 and visits(store) == 4
    store = opened()
    store.land("raw.encounter_fact", encounters(spark, LATE_ENCOUNTERS))
    opened().refresh_available()  # no new rows, but gold has some to catch up on
    assert_equals_full(opened())


def test_rows_between_arrival_and_walk_are_not_lost(spark, root):
    """The slow query refreshes while a batch of the fast one has arrived but was not walked yet, and the other way round."""
    graph = clinical_graph("1 second", "1 hour")
    store = GraphRefresher(spark, graph, root, n_buckets=2)
    store.land("raw.patient_dim", patients(spark))
    store.land("raw.encounter_fact", encounters(spark, ENCOUNTERS[:4]))
    store.refresh_available()
    walk, interleaved = store._walk_levels, []

    def late_walk(touched, keys, batch_id, pace):
        if pace == "1 second" and not interleaved:
            interleaved.append(True)
            store._one_walk.release()
            try:
                store.land("raw.encounter_fact", encounters(spark, ENCOUNTERS[7:]))
                store._writer("1 hour", None).trigger(availableNow=True).start().awaitTermination()
            finally:
                store._one_walk.acquire()
        walk(touched, keys, batch_id, pace)

    store._walk_levels = late_walk
    store.land("raw.encounter_fact", encounters(spark, ENCOUNTERS[4:7]))
    store.land("raw.lab_results", labs(spark))
    store._writer("1 second", None).trigger(availableNow=True).start().awaitTermination()
    assert interleaved and store.table("gold.department_dashboard", AS_OF).agg({"encounter_count": "sum"}).first()[0] == 10
    store.refresh_available()
    assert_equals_full(store)


def test_graph_rejects_cycles():
    a = Node("a", lambda x: x, ("b",))
    b = Node("b", lambda x: x, ("a",))
    with pytest.raises(ValueError, match="cycle"):
        Graph([], [a, b])


def test_new_rows_touch_their_slice_only(spark, root):
    """Rows of a new day leave the stored cells of earlier days alone, also those of the same patient."""
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=1)
    store.land("raw.encounter_fact", encounters(spark), "2024-10-24")
    store.refresh_available()

    def files(day):
        return {r.f for r in spark.read.parquet(f"{root}/curated/fact_encounter/bucket=0/slice={day}").selectExpr(
            "input_file_name() f").distinct().collect()}

    before = files("2024-10-24")
    store.land("raw.encounter_fact", encounters(spark, [("E3", *ENCOUNTERS[0][1:])]), "2024-10-25")
    store.land("raw.patient_dim", patients(spark), "2024-10-25")
    store.refresh_available()
    assert files("2024-10-24") == before and files("2024-10-25")
    assert_equals_full(store)


def test_slices_must_name_folders(spark, root):
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=1)
    with pytest.raises(ValueError, match="slice"):
        store.land("raw.encounter_fact", encounters(spark), "a/b")


def test_cell_node_needs_one_aligned_input():
    sources = [Source("a", schemas.LAB_RESULT, "pat_id"), Source("b", schemas.LAB_RESULT, "pat_id")]
    with pytest.raises(ValueError, match="exactly one input"):
        Graph(sources, [Node("c", lambda x, y: x, ("a", "b"))])


def test_running_query_and_reopened_store(spark, root):
    """A started query keeps the store fresh, and a store opened again goes on where the last one stopped."""
    graph = clinical_graph("1 second")
    store = GraphRefresher(spark, graph, root, n_buckets=2)
    store.land("raw.encounter_fact", encounters(spark, ENCOUNTERS[:5]))
    query = store.start()
    try:
        query.processAllAvailable()
        assert store.table("curated.fact_encounter").count() == 5
    finally:
        query.stop()
        query.awaitTermination()
    again = GraphRefresher(spark, graph, root, n_buckets=2)
    again.land("raw.encounter_fact", encounters(spark, ENCOUNTERS[5:]))
    again.refresh_available()
    assert_equals_full(again)
    with pytest.raises(ValueError, match="has 2 buckets"):
        GraphRefresher(spark, graph, root, n_buckets=3)


def test_groups_cover_the_first_slices(monkeypatch):
    from wardflow.streaming import refresh

    for fan in (2, 3, 8):
        monkeypatch.setattr(refresh, "FAN", fan)
        for n in range(0, 40 * fan, fan):
            cover = GraphRefresher.cover(n)
            held = [i for level, groups in cover.items() for g in groups for i in range(g * fan**level, (g + 1) * fan**level)]
            assert sorted(held) == list(range(n))
            assert all(len(groups) < fan or level == max(cover) for level, groups in cover.items())


def test_buckets_are_merged_from_few_groups(spark, root, monkeypatch):
    """Gold is merged from groups of old slices; rows that come late to one of them, to a bucket that had none there, or
    twice, end in the same as a full recompute."""
    from wardflow.streaming import refresh

    monkeypatch.setattr(refresh, "FAN", 2)
    only = ["gold.patient_encounter_summary", "gold.department_dashboard"]
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=2)
    store.land("raw.patient_dim", patients(spark), "day-00")
    data = ENCOUNTERS + LATE_ENCOUNTERS

    def same():
        want, gold = full(store), only[0]
        assert sorted(map(str, rows(store.table(gold, AS_OF)))) == sorted(map(str, rows(want[gold])))
        assert sorted(map(str, rows(store.table(only[1], AS_OF)))) == sorted(map(str, rows(want[only[1]])))

    for i in range(9):
        row = (f"S{i}", *data[i % len(data)][1:])
        store.land("raw.encounter_fact", encounters(spark, [row]), f"day-{i:02d}")
        if i in (1, 4, 8):
            store.refresh_available(only=only)
            same()
    name = "curated.encounter_partials"
    assert store._sealed(name) == 8 and store.cover(8) == {3: [0]}
    cells = store._cells_of(store._read(name))
    merged = store._read_merged(name, cells)
    assert {r.slice for r in merged.select("slice").distinct().collect()} <= {None, "day-08"}
    # Late rows: to old slices, of patients of either bucket.
    for day, row in (("day-00", data[0]), ("day-03", data[5]), ("day-05", data[7])):
        store.land("raw.encounter_fact", encounters(spark, [(f"L{day}", *row[1:])]), day)
    store.refresh_available(only=only)
    same()
    store._walk({"raw.encounter_fact": store._cells_of(store._read("raw.encounter_fact"))}, {}, 0)
    same()
    assert store._sealed(name) == 8
    store.refresh_available()  # the other tables have their own memory of what they read
    assert_equals_full(store)
    store.rebuild()
    assert_equals_full(store)


def test_a_new_group_takes_all_buckets(spark, root, monkeypatch):
    """The slice that makes a group full holds no row of some bucket, whose earlier rows are rolled up all the same."""
    from wardflow.streaming import refresh

    monkeypatch.setattr(refresh, "FAN", 2)
    gold = "gold.patient_encounter_summary"
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=8)
    store.land("raw.patient_dim", patients(spark), "a")
    store.land("raw.encounter_fact", encounters(spark), "a")
    store.refresh_available(only=[gold])
    store.land("raw.encounter_fact", encounters(spark, [("B", *ENCOUNTERS[0][1:])]), "b")
    store.refresh_available(only=[gold])
    assert store._sealed("curated.encounter_partials") == 2
    store.land("raw.encounter_fact", encounters(spark, [(f"C{i}", *r[1:]) for i, r in enumerate(ENCOUNTERS)]), "c")
    store.refresh_available(only=[gold])
    assert sorted(map(str, rows(store.table(gold, AS_OF)))) == sorted(map(str, rows(full(store)[gold])))


def test_a_failed_roll_up_is_made_again(spark, root, monkeypatch):
    from wardflow.streaming import refresh

    monkeypatch.setattr(refresh, "FAN", 2)
    gold, made = "gold.patient_encounter_summary", GraphRefresher._make_groups
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=2)
    store.land("raw.patient_dim", patients(spark), "a")
    for i, day in enumerate("abcd"):
        store.land("raw.encounter_fact", encounters(spark, [(f"{day}{r[0]}", *r[1:]) for r in ENCOUNTERS[i::4]]), day)

    def torn(self, node, level, *args):
        made(self, node, level, *args)
        if level == 2:
            raise RuntimeError("lost driver")

    monkeypatch.setattr(GraphRefresher, "_make_groups", torn)
    with pytest.raises(Exception, match="lost driver"):
        store.refresh_available(only=[gold])
    assert store._sealed("curated.encounter_partials") == 0
    monkeypatch.setattr(GraphRefresher, "_make_groups", made)
    again = GraphRefresher(spark, clinical_graph(), root, n_buckets=2)
    again.refresh_available(only=[gold])
    assert again._sealed("curated.encounter_partials") == 4
    assert sorted(map(str, rows(again.table(gold, AS_OF)))) == sorted(map(str, rows(full(again)[gold])))


def test_lookups_read_only_cells_that_hold_their_keys(spark, root):
    gold = "gold.abnormal_results_summary"
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=4)
    store.land("raw.patient_dim", patients(spark))
    for i in range(4):
        store.land("raw.encounter_fact", encounters(spark, [(f"{r[0]}" if i == 2 else f"X{i}{r[0]}", *r[1:]) for r in ENCOUNTERS]), f"day-{i}")
    store.refresh_available(only=[gold])
    store.land("raw.lab_results", labs(spark, [r for r in LABS if r[1] == ENCOUNTERS[0][0]]), "day-9")
    store.refresh_available(only=[gold])
    assert store.table(gold).count() == full(store)[gold].count() > 0
    held = spark.read.parquet(f"{root}/_state/cells/only-{gold}/{gold.replace('.', '/')}-of-curated/fact_encounter")
    assert {r.slice for r in held.collect()} == {"day-2"} and held.count() == 1
    # The other way: a late encounter finds the cells of the lab rows that wait for it.
    store.land("raw.lab_results", labs(spark, [(f"W{r[0]}", "late", *r[2:]) for r in LABS]), "day-9")
    store.refresh_available(only=[gold])
    before = store.table(gold).count()
    store.land("raw.encounter_fact", encounters(spark, [("late", *ENCOUNTERS[3][1:])]), "day-10")
    store.refresh_available(only=[gold])
    assert store.table(gold).count() == full(store)[gold].count() > before
    store.refresh_available()
    assert_equals_full(store)


def test_many_keys_are_not_broadcast(spark, root):
    """A million keys are a few MB of files, which a broadcast table of them takes more than ten times."""
    from pyspark.sql import functions as F

    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=4)
    store.land("raw.lab_results", labs(spark), "day-1")
    held = {(r.bucket, r.slice) for r in spark.read.parquet(f"{root}/raw/lab_results").collect()}
    for ids, broadcast in ((spark.range(1_000_000), False), (spark.range(200_000, 210_000), True)):
        found = store._cells_of_keys("raw.lab_keys", ids.select(F.concat(F.lit("E"), "id").alias("key")), "keys", None)
        assert {(r.bucket, r.slice) for r in found.collect()} == held
        assert ("BroadcastHashJoin [encounter_id" in found._jdf.queryExecution().executedPlan().toString()) == broadcast


def test_only_names_known_tables(spark, root):
    store = GraphRefresher(spark, clinical_graph(), root, n_buckets=1)
    with pytest.raises(ValueError, match="unknown tables"):
        store.refresh_available(only=["gold.other"])
    store.refresh_available(only=[])
    store.land("raw.encounter_fact", encounters(spark))
    store.refresh_available(only=["curated.fact_encounter"])
    assert store.table("curated.fact_encounter").count() == 10 and store.table("gold.department_dashboard", AS_OF).count() == 0


def test_sketches_follow_without_old_rows(spark, root, monkeypatch):
    from pyspark.sql import functions as F

    from wardflow.streaming import refresh

    monkeypatch.setattr(refresh, "FAN", 2)
    store = GraphRefresher(spark, clinical_graph(sketches=True), root, n_buckets=3)
    row = ENCOUNTERS[0]
    for i in range(5):
        many = [(f"E{i * 500 + j}", f"P{j}", *row[2:]) for j in range(600)]  # 100 of them come again in the next slice
        store.land("raw.encounter_fact", encounters(spark, many), f"day-{i}")
        if i in (2, 4):
            store.refresh_available(only=["gold.department_estimates"])
            raw = store.table("raw.encounter_fact")
            exact = raw.agg(F.count_distinct("encounter_id"), F.count_distinct("pat_id")).first()
            got = store.table("gold.department_estimates").first()
            for estimate, count in zip(got[1:], exact, strict=True):
                assert abs(estimate - count) <= nodes.SKETCH_BOUND * count
    assert store._sealed("curated.department_sketches") == 4
    # No exact count was worked out on the way.
    assert store.table("raw.encounter_keys").count() == 3000 and store.table("gold.department_encounter_counts").count() == 0
