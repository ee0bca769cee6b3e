"""Small tables with every odd case: NULLs, empty and very long texts, repeated rows, clashing extra columns."""

from __future__ import annotations

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997}x" for i in range(30_000))
ROWS = [
    (1, "One two three four five six.", "en", "a", 28),
    (2, "One two three four five six.", "en", "b", 28),
    (2, "One two three four five six.", "en", "b", 28),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (None, "No id at all, but words: ½ 日本 é 😀 <|endoftext|> tail", "de", "a", 5),
    (None, None, "de", "a", 5),
    (5, " \t\n\x0b\x0c ", "en", "a", 6),
    (6, LONG, "en", "a", len(LONG)),
    (7, "ONE TWO three\nfour  five\tsix.", "en", "a", -1),
    (8, "x" * 5000, "en", "a", 5000),
    (10, "alone", "fr", "c", 5),
]
CLASHING = (
    "digest content nth fp a b seg key component component_id keep_id keep_text row bin parent shift filled offset path paths host html page_id "
    "y score s evidence held_out predicted doc vec_id label embedding dim node rank rows block x licence dir n_tokens n_bytes".split()
)


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCUMENTS)


def with_clashes(df):
    """The table with extra columns that are named like columns inside the operators."""
    return df.withColumns({name: F.lit("odd") for name in CLASHING if name not in df.columns})


def key_order(rows):
    return sorted(rows, key=repr)
