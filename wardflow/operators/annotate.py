"""Annotation of free text and of image or assay metadata."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.functions.text import leading_sentences, preview

# A model gets texts, none of them missing or blank, and returns as many annotations.
Model = Callable[[list[str]], Sequence[str | None]]


# Models that a Python worker has loaded; workers are used for many tasks.
_LOADED: dict[str, Model] = {}


def _loaded(name: str, load: Callable[[], Model]) -> Model:
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


def previews(df: DataFrame, text_col: str, n: int = 120, *keep: str) -> DataFrame:
    return df.select(*keep, preview(F.col(text_col), n).alias("preview"))


def annotate_text(
    df: DataFrame,
    text_col: str,
    annotator: Callable[[Column], Column] | None = None,
    out: str = "summary",
    batches: Callable[[pd.Series], pd.Series] | None = None,
) -> DataFrame:
    """Add one annotation per text.

    ``annotator`` builds it as a Column; without one it is the first two sentences. ``batches`` is the hook for a model
    called from Python: it gets whole Arrow batches of texts, and rows are never moved between partitions for it.
    """
    if batches is None:
        return df.withColumn(out, (annotator or leading_sentences)(F.col(text_col)))

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in frames:
            yield batches(texts)

    return df.withColumn(out, F.pandas_udf(run, "string")(F.col(text_col)))


def annotate_with_model(
    df: DataFrame,
    text_col: str,
    load: Callable[[], Model],
    out: str = "summary",
    error: str | None = None,
    attempts: int = 3,
    wait: float = 0.5,
) -> DataFrame:
    """Add one annotation per text by a model that each Python worker loads once, however many tasks it runs.

    The model gets the different texts of an Arrow batch in one call. A missing text has no annotation, a blank one the
    empty text; neither is sent. A call that fails is repeated, ``attempts`` times in all, after ``wait`` seconds and twice
    as long every time. If it still fails the task fails; with a column for the ``error`` the texts are then sent one by
    one, and those that fail by themselves get NULL and the message, so a bad text costs no other one its annotation.
    """
    name = uuid.uuid4().hex

    def ask(model: Model, texts: list[str]) -> list[tuple[str | None, str | None]]:
        for attempt in range(attempts):
            try:
                found = list(model(texts))
                if len(found) != len(texts):
                    raise ValueError(f"the model returned {len(found)} annotations for {len(texts)} texts")
                return [(f, None) for f in found]
            except Exception as exc:
                if attempt + 1 < attempts:
                    time.sleep(wait * 2**attempt)
                elif error is None:
                    raise
                elif len(texts) == 1:
                    return [(None, str(exc).split("\n", 1)[0])]
        return [answer for text in texts for answer in ask(model, [text])]

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _loaded(name, load)
        for texts in frames:
            wanted = list(dict.fromkeys(t for t in texts if t is not None and t.strip()))
            known = dict(zip(wanted, ask(model, wanted), strict=True)) if wanted else {}
            rows = [(None if t is None else "", None) if t not in known else known[t] for t in texts]
            yield pd.DataFrame(rows, columns=["value", "error"], dtype="object")

    answers = df.withColumn("_answer", F.pandas_udf(run, "value string, error string")(F.col(text_col)))
    columns = {out: "value"} | ({error: "error"} if error else {})
    return answers.withColumns({c: F.col(f"_answer.{part}") for c, part in columns.items()}).drop("_answer")


def extract_fields(
    df: DataFrame,
    text_col: str,
    patterns: Mapping[str, str],
    out: str = "extracted",
    required_text: Mapping[str, str] | None = None,
    may_be_empty: Collection[str] = (),
) -> DataFrame:
    """One object per text with the first match of every field's pattern (its first group), NULL where none matches.

    ``required_text`` names a literal that every match of a field holds; texts without it are not searched. In the fields
    ``may_be_empty`` the wanted part of a match may have no characters; elsewhere an empty result is no match.
    """
    text = F.col(text_col)
    fields = []
    for name, pattern in patterns.items():
        group = 1 if re.compile(pattern).groups else 0
        found = F.regexp_extract(text, pattern, group)
        if name in may_be_empty:  # then an empty result may be a match, so the pattern is tested by itself
            value = F.when(text.rlike(pattern), found)
        else:
            value = F.nullif(found, F.lit(""))
            if name in (required_text or {}):
                value = F.when(F.contains(text, F.lit(required_text[name])), value)
        fields.append(value.alias(name))
    return df.withColumn(out, F.struct(*fields))


def lookup_annotations(df: DataFrame, annotations: DataFrame, key: str) -> DataFrame:
    """Attach prepared annotations by id; rows without one keep NULL."""
    return df.join(annotations, key, "left")


def describe_images(
    df: DataFrame, parts: Sequence[tuple[str, str]], out: str = "ai_description", prefix: str = ""
) -> DataFrame:
    """A catalog line made from labelled columns, for example ``Modality: CT, Body part: Chest``; NULL where any part is."""
    pieces = [F.lit(prefix)]
    for i, (label, column) in enumerate(parts):
        pieces += [F.lit(f"{', ' if i else ''}{label}: "), F.col(column).cast("string")]
    return df.withColumn(out, F.concat(*pieces))


def categorize(
    df: DataFrame, text_col: str, rules: Sequence[tuple[str, str]], otherwise: str = "other", out: str = "category"
) -> DataFrame:
    """The category of the first pattern found anywhere in the text."""
    value = F.lit(otherwise)
    for pattern, label in reversed(rules):
        value = F.when(F.col(text_col).rlike(pattern), label).otherwise(value)
    return df.withColumn(out, value)


def categorize_by_rules(
    df: DataFrame, text_col: str, key: str, rules: DataFrame, otherwise: str = "other", out: str = "category"
) -> DataFrame:
    """The category of the first rule that fits, from a table of rules (priority, trigger, pattern, category).

    The smallest priority is first; of equal ones the smallest category. A rule fits a text that holds its trigger, a word
    of letters a-z and digits in lower case, and in whose lower-cased text the pattern (with none: the trigger alone) is
    found. Words of a text meet the triggers in a join, so a text is tested against the rules that its words call and not
    against all; rules without a trigger are tested on every text. ``key`` names each row. Missing texts fit no rule.
    """
    folded = F.translate(text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("_folded")
    known = rules.select("priority", F.col("trigger").alias("_word"), "pattern", F.col("category").alias("_category"))
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(key).alias("_key"), folded)
    words = F.array_distinct(F.regexp_extract_all("_folded", F.lit("[a-z0-9]+"), F.lit(0)))
    called = texts.select("_key", "_folded", F.explode(words).alias("_word")).join(known.where(F.col("_word").isNotNull()), "_word").drop("_word")
    always = texts.join(known.where(F.col("_word").isNull()).drop("_word"), how="cross")
    fits = called.unionByName(always).where(F.col("pattern").isNull() | F.expr("_folded RLIKE pattern"))
    first = fits.groupBy("_key").agg(F.min(F.struct("priority", "_category")).alias("_first"))
    named = df.join(first, F.col(key) == F.col("_key"), "left")
    return named.select(*[F.col(c) for c in df.columns if c != out], F.coalesce("_first._category", F.lit(otherwise)).alias(out))
