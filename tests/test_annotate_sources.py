import pandas as pd
import pytest
from clinic import PROVIDERS, patients, rows
from pyspark.sql import functions as F

from wardflow.operators import annotate
from wardflow.sources import schemas, tables

NOTES = [
    ("N1", "Dx: STEMI. Troponin 2.45 found. Plan: aspirin 81mg daily."),
    ("N2", "Dx: MDD moderate. Plan: sertraline 50mg. Follow-up: 4 weeks"),
    ("N3", None),
]


@pytest.fixture
def notes(spark):
    return spark.createDataFrame(NOTES, "note_id string, note_text string")


def test_summaries(notes):
    got = dict(rows(annotate.annotate_text(notes, "note_text"), "note_id", "summary"))
    assert got == {"N1": "Dx: STEMI. Troponin 2.", "N2": "Dx: MDD moderate. Plan: sertraline 50mg.", "N3": None}
    upper = annotate.annotate_text(notes, "note_text", F.upper)
    assert rows(upper, "summary")[0][0].startswith("DX: STEMI")


def test_model_hook_gets_batches(notes):
    def model(texts: pd.Series) -> pd.Series:
        return texts.str.len().astype("string")

    got = dict(rows(annotate.annotate_text(notes, "note_text", batches=model), "note_id", "summary"))
    assert got == {"N1": str(len(NOTES[0][1])), "N2": str(len(NOTES[1][1])), "N3": None}


def test_model_is_loaded_once_and_asked_again(spark, tmp_path):
    loads = str(tmp_path / "loads")

    def load():
        import os
        import tempfile

        os.makedirs(loads, exist_ok=True)
        tempfile.mkstemp(prefix=f"{os.getpid()}-", dir=loads)
        calls = []

        def model(texts):
            calls.append(texts)
            if len(calls) == 1:
                raise ConnectionError("not awake")
            if "bad" in texts:
                raise ValueError("cannot read\nthis")
            return [t.upper() if t != "nothing" else None for t in texts]

        return model

    data = [(i, ["a", "b", "bad", "nothing", None, "", " \t"][i % 7]) for i in range(700)]
    df = spark.createDataFrame(data, "id int, t string").repartition(12)
    got = annotate.annotate_with_model(df, "t", load, "out", "why", wait=0.0)
    answers = {(r.t, r.out, r.why) for r in got.collect()}
    assert answers == {("a", "A", None), ("b", "B", None), ("bad", None, "cannot read"), ("nothing", None, None), (None, None, None), ("", "", None), (" \t", "", None)}
    import os

    pids = [n.split("-")[0] for n in os.listdir(loads)]
    assert len(pids) == len(set(pids)) < 12  # fewer loads than tasks, one per worker
    assert got.columns == ["id", "t", "out", "why"] and annotate.annotate_with_model(df.limit(0), "t", load).collect() == []
    with pytest.raises(Exception, match="cannot read"):
        annotate.annotate_with_model(df, "t", load, wait=0.0).collect()


def test_rules_as_a_table(spark):
    texts = [(1, "Troponin is HIGH, stemi"), (2, "nothing here"), (3, None), (4, "a stemix"), (5, "x42 high"), (6, ""), (7, "Two rules: mdd and stemi")]
    df = spark.createDataFrame(texts, "id int, t string")
    rules = spark.createDataFrame(
        [(2, "stemi", "stemi$", "cardiology"), (1, "mdd", None, "psychiatry"), (3, None, "[0-9]+", "number"), (4, "high", "high", "b"), (4, "high", "x", "a"), (1, "here", "^here", "never")],
        "priority int, trigger string, pattern string, category string")
    got = dict(rows(annotate.categorize_by_rules(df, "t", "id", rules), "id", "category"))
    assert got == {1: "cardiology", 2: "other", 3: "other", 4: "other", 5: "number", 6: "other", 7: "psychiatry"}
    many = spark.range(1000).selectExpr("id AS priority", "concat('w', id) AS trigger", "cast(NULL AS string) AS pattern", "concat('c', id) AS category")
    spoken = spark.createDataFrame([(i, f"w{i} w{i + 1}") for i in range(0, 900, 7)], "id int, t string")
    got = annotate.categorize_by_rules(spoken, "t", "id", many, "none", "kind")
    assert all(r.kind == f"c{r.id}" for r in got.collect()) and got.columns == ["id", "t", "kind"]
    assert {r.kind for r in annotate.categorize_by_rules(spoken, "t", "id", many.limit(0), "none", "kind").collect()} == {"none"}


def test_extract_fields(notes):
    out = annotate.extract_fields(notes, "note_text", {"dx": r"Dx: ([^.]+)", "dose": r"[0-9]+mg", "none": "zzz"})
    assert rows(out.orderBy("note_id"), "extracted.dx", "extracted.dose", "extracted.none") == [
        ("STEMI", "81mg", None), ("MDD moderate", "50mg", None), (None, None, None),
    ]


def test_lookup_and_categories(spark, notes):
    known = spark.createDataFrame([("N1", "heart")], "note_id string, note string")
    assert dict(rows(annotate.lookup_annotations(notes, known, "note_id"), "note_id", "note")) == {
        "N1": "heart", "N2": None, "N3": None,
    }
    rules = [("STEMI|Troponin", "cardiology"), ("MDD", "psychiatry")]
    assert dict(rows(annotate.categorize(notes, "note_text", rules), "note_id", "category")) == {
        "N1": "cardiology", "N2": "psychiatry", "N3": "other",
    }
    assert rows(annotate.previews(notes, "note_text", 3, "note_id"))[0] == ("N1", "Dx:...")


def test_image_descriptions_are_stored(spark, root):
    images = spark.createDataFrame([("I1", "E1", "CT", "Chest", None), ("I2", "E2", None, "Wrist", None)],
                                   "image_id string, encounter_id string, modality string, body_part string, ai_description string")
    parts = [("Modality", "modality"), ("Body part", "body_part"), ("Patient context", "encounter_id")]
    described = annotate.describe_images(images, parts)
    assert dict(rows(described, "image_id", "ai_description")) == {
        "I1": "Modality: CT, Body part: Chest, Patient context: E1", "I2": None,
    }
    stored = tables.annotate(images, "ai_description", F.concat("modality", F.lit(" "), "body_part"), root)
    assert dict(rows(stored, "image_id", "ai_description")) == {"I1": "CT Chest", "I2": None}


def test_declared_table_with_defaults(spark):
    tables.create_layers(spark)
    tables.create_table(spark, "raw.provider_dim", schemas.PROVIDER)
    tables.append_rows(spark, "raw.provider_dim", PROVIDERS[:2], schemas.PROVIDER)
    tables.append_rows(spark, "raw.provider_dim", [{"prov_id": "P9"}], schemas.PROVIDER, ["prov_id"])
    spark.sql("INSERT INTO raw.provider_dim (prov_id) VALUES ('P10')")
    got = dict(rows(spark.table("raw.provider_dim"), "prov_id", "active"))
    assert got == {"PROV-001": True, "PROV-002": True, "P9": True, "P10": True}
    with pytest.raises(ValueError, match="values for"):
        tables.append_rows(spark, "raw.provider_dim", [("x",)], schemas.PROVIDER)
    tables.create_table(spark, "raw.provider_dim", schemas.PROVIDER)
    assert spark.table("raw.provider_dim").count() == 0
    columns = rows(tables.table_columns(spark.table("raw.provider_dim")), "column_name", "data_type")
    assert columns[0] == ("prov_id", "string") and columns[-1] == ("active", "boolean")


def test_load_time_default(spark):
    assert patients(spark).where("load_ts IS NOT NULL").count() == 8


def test_create_table_as_select(spark, root):
    tables.create_layers(spark)
    tables.ctas(tables.with_lineage(spark.range(3), "B1", "2024-10-25 00:00:00"), "curated.copy")
    tables.ctas(tables.with_lineage(spark.range(2), "B2"), "curated.copy")
    assert {r.batch_id for r in spark.table("curated.copy").collect()} == {"B2"}
    tables.export_open(spark.range(4).toDF("n"), f"{root}/open", "gold.exported")
    assert spark.read.parquet(f"{root}/open").count() == 4 == tables.read(spark, "gold.exported").count()
    tables.append(spark.range(1).toDF("n"), "gold.exported")
    assert spark.table("gold.exported").count() == 5
    assert tables.peek(spark.table("gold.exported"), 2).count() == 2
    tables.register_views(spark, shown=spark.range(6))
    assert spark.sql("SELECT count(*) n FROM shown").first().n == 6


def test_latest(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-01'), (2, DATE'2024-01-03'), (3, DATE'2024-01-03') t(id, d)")
    assert rows(tables.latest(df, 2, "d", "id"), "id") == [(2,), (3,)]


def test_whole_text(spark, tmp_path):
    (tmp_path / "a.sql").write_text("SELECT 1;\nSELECT 2;\n")
    assert rows(tables.read_whole_text(spark, str(tmp_path / "a.sql"))) == [("SELECT 1;\nSELECT 2;\n",)]
