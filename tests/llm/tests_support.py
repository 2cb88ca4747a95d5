"""Rows that every operator has to take."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "One two three four five six.", "en", "a", 28),
    (1, "One two three four five six.", "en", "a", 28),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (4, "  \t ", "fr", "b", 4),
    (None, "no id here", "en", "b", 10),
    (5, "word " * 30_000, "en", "a", 150_000),
    (6, "12345 &&& 678", None, "c", 13),
    (7, "ONE two three four FIVE six.", "en", "c", 28),
]


def clash(df):
    """The same rows with columns named like those the operators add."""
    for c in ("shard", "slot", "size", "target", "copies", "score", "lang_pred", "key", "u", "component_id", "fp", "window"):
        df = df.withColumn(c, F.lit("x"))
    return df
