import datetime as dt

import pytest
from clinic import rows
from pyspark.sql import functions as F

from wardflow.functions import dates, details, flags, text


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("Al-Hassan", "Al-Hassan"),
        ("AL-HASSAN o'NEIL", "Al-Hassan O'neil"),
        ("maria  santos", "Maria  Santos"),
        ("a_b.c/d(e)[f]{g}<h>", "A_B.C/D(E)[F]{G}<H>"),
        ("x\\y|z^w&v", "X\\Y|Z^W&V"),
        ("tab\tline\nend", "Tab\tLine\nEnd"),
        ("3rd élan ÉTÉ", "3rd Élan Été"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap_words(spark, given, want):
    assert one(spark, text.initcap_words(F.lit(given).cast("string"))) == want


def test_string_functions(spark):
    assert one(spark, text.clean_phone(F.lit("401-555-0101"))) == "4015550101"
    assert one(spark, text.last_chars(F.lit("ab"), 4)) == "ab"
    assert one(spark, text.preview(F.lit("short"))) == "short..."
    assert one(spark, text.preview(F.lit("x" * 130))) == "x" * 120 + "..."
    assert one(spark, text.split_prefix(F.lit("BATCH-2024-10-25-001-x"))) == "BATCH-2024"
    assert one(spark, text.split_prefix(F.lit("single"))) == "single-"
    assert one(spark, text.run_id(F.lit("B"), F.lit("2024-10-25 01:02:03.004").cast("timestamp_ntz"))) == (
        "B-2024-10-25T01:02:03.004"
    )
    assert one(spark, text.message_template(F.lit("Table 'a1' has 42 rows"))) == "Table <text> has <n> rows"
    assert one(spark, text.leading_sentences(F.lit("One. Two! Three?"))) == "One. Two!"
    assert one(spark, text.leading_sentences(F.lit("no end mark"))) == "no end mark"


def test_whole_match_rejects_trailing_newline(spark):
    pattern = "VL-[0-9]{6}"
    for value, want in [("VL-000001", True), ("VL-000001\n", False), ("xVL-000001", False), (None, None)]:
        assert one(spark, text.matches_whole(F.lit(value).cast("string"), pattern)) is want


def test_sql_functions(spark):
    text.register_sql_functions(spark)
    row = spark.sql("SELECT clean_phone('(401) 5-1') p, year_boundaries(DATE'1989-12-31', DATE'2024-01-01') y").first()
    assert row == ("40151", 35)


def test_dates(spark):
    d = lambda s: F.lit(s).cast("date")
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(spark, dates.year_boundaries(d("1988-12-31"), d("2024-01-01"))) == 36
    assert one(spark, dates.day_boundaries(t("2024-01-01 23:59:59"), t("2024-01-02 00:00:01"))) == 1
    assert one(spark, dates.second_boundaries(t("2024-01-01 00:00:00.9"), t("2024-01-01 00:00:01.1"))) == 1
    assert one(spark, dates.second_boundaries(t("2023-12-31 23:59:59"), t("2024-01-02 00:00:00"))) == 86401
    assert one(spark, dates.hour_floor(t("2024-03-10 02:59:59.999999"))) == dt.datetime(2024, 3, 10, 2)
    now = "2024-01-01 00:05:00"
    assert one(spark, dates.within_minutes(t("2024-01-01 00:00:01"), 5, now)) is True
    assert one(spark, dates.within_minutes(t("2024-01-01 00:00:00"), 5, now)) is False
    assert one(spark, dates.as_date(None)) is not None and one(spark, dates.as_timestamp(None)) is not None


def test_times_do_not_depend_on_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = F.lit("2024-03-10 02:30:15").cast("timestamp_ntz")  # this hour does not exist in New York
        assert one(spark, dates.hour_floor(gap)) == dt.datetime(2024, 3, 10, 2)
        assert one(spark, dates.second_boundaries(F.lit("2024-03-10 01:30:15").cast("timestamp_ntz"), gap)) == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_flags(spark):
    df = spark.sql("SELECT * FROM VALUES (5,0,4),(1,2,4),(3,2,4),(NULL,2,4),(9,NULL,NULL) t(v,lo,hi)")
    got = [r[0] for r in rows(df.select(flags.range_flag(F.col("v"), F.col("lo"), F.col("hi"))))]
    assert got == ["HIGH", "LOW", "NORMAL", "NORMAL", "NORMAL"]
    tiers = [one(spark, flags.review_tier(F.lit(n))).split(" ")[0] for n in (11, 10, 6, 5)]
    assert tiers == ["Complex", "Moderate", "Moderate", "Simple"]


def test_details(spark):
    made = details.detail_of(name='say "hi"', n=3)
    assert one(spark, details.detail_field(made, "name")) == 'say "hi"'
    assert one(spark, details.detail_field(made, "n", "decimal(38,0)")) == 3
    assert one(spark, details.detail_field(made, "absent")) is None
    assert one(spark, details.has_field(made, "absent")) is False
    assert one(spark, details.has_field(F.parse_json(F.lit('{"k":null}')), "k")) is True
