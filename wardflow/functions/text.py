"""String functions as Column expressions; everything runs inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The characters after which a new word starts. The apostrophe is not one of them.
WORD_DELIMITERS = " \t\n\r\f\v" + r"""!?@"^#$&~_,.:;+-*%/|\[](){}<>"""


def _char_class(chars: str) -> str:
    return "[" + "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in chars) + "]"


def initcap_words(col: Column, delimiters: str = WORD_DELIMITERS) -> Column:
    """Upper-case the first letter of every word and lower-case the rest; words end at any delimiter."""
    words = F.split(F.lower(col), f"(?<={_char_class(delimiters)})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), ""
    )


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def clean_phone(col: Column) -> Column:
    """A phone number reduced to its digits."""
    return digits_only(col)


def matches_whole(col: Column, pattern: str) -> Column:
    r"""True when the pattern covers the whole string; ``\z`` rejects the trailing newline that ``$`` lets through."""
    return col.rlike(rf"\A(?:{pattern})\z")


def preview(col: Column, n: int = 120) -> Column:
    """The first n characters followed by dots, also when the text is shorter."""
    return F.concat(F.left(col, F.lit(n)), F.lit("..."))


def last_chars(col: Column, n: int = 4) -> Column:
    return F.right(col, F.lit(n))


def split_prefix(col: Column, parts: int = 2, sep: str = "-") -> Column:
    """The first parts of a separated string; a missing part counts as empty."""
    pieces = [F.split_part(col, F.lit(sep), F.lit(i + 1)) for i in range(parts)]
    out = pieces[0]
    for piece in pieces[1:]:
        out = F.concat(out, F.lit(sep), piece)
    return out


def run_id(batch_id: Column, ts: Column) -> Column:
    """Batch id and start time, with every blank of the time turned into a T."""
    return F.concat(batch_id, F.lit("-"), F.replace(ts.cast("string"), F.lit(" "), F.lit("T")))


def message_template(col: Column) -> Column:
    """A message with its quoted parts and numbers masked, so that equal errors fall together."""
    masked = F.regexp_replace(col, "'[^']*'|\"[^\"]*\"", "<text>")
    return F.regexp_replace(masked, "[0-9]+", "<n>")


def leading_sentences(col: Column, n: int = 2) -> Column:
    """The first n sentences of a text (an end mark closes a sentence; the rest of the text is one)."""
    # One match from the start of the text, which ends with its n-th sentence; possessive, so nothing is tried twice.
    # End marks before the first sentence belong to none.
    return F.trim(F.regexp_extract(col, rf"\A[.!?]*+((?:[^.!?]++[.!?]*+){{1,{n}}})", 1))


def register_sql_functions(spark: SparkSession) -> None:
    """Offer the scalar helpers to SQL text as session functions (SQL bodies, no Python)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION clean_phone(raw_phone STRING) RETURNS STRING "
        "RETURN regexp_replace(raw_phone, '[^0-9]', '')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION year_boundaries(a DATE, b DATE) RETURNS INT RETURN year(b) - year(a)"
    )
