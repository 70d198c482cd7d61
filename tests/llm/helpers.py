"""Frames with every awkward row, and plain versions of what the operators compute."""

import re

import pyspark.sql.types as T

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
WHITE = r"[^\x20\x09-\x0D]+"
LONG = "word und mot " * 40_000


def ascii_lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def white_words(text):
    return re.findall(WHITE, ascii_lower(text or ""))


def documents(spark, *rows):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = []
    for row in rows:
        doc_id, text, source = (*row, "a")[:3]
        full.append((doc_id, text, "en", source, None if text is None else len(text)))
    return spark.createDataFrame(full, DOCUMENT)


def awkward_rows():
    text = "The quick brown fox jumps over the lazy dog\nand runs away"
    return [
        (1, text, "b"),
        (1, text, "b"),  # a repeated row
        (1, text + " now", "b"),  # the same id, another text
        (2, "", None),
        (3, None, "a"),
        (None, text, None),
        (None, None, None),
        (5, " \t\n ", "a"),
        (6, LONG, "ü"),
        (7, "one", "a"),
        (8, "é" * 50 + " <|im_end|>   x", "a"),
        (9, "%%% *** " * 40, "a"),
    ]


def awkward(spark):
    return documents(spark, *awkward_rows())


CLASHING = (
    "row_key nth_row planned_rows size shard slot score predicted n_words hit_spans hit_items "
    "contaminated copy position slice before target taken lean link spread"
).split()


def clashing(spark):
    """Documents with columns named like those the operators use inside."""
    rows = [(k, f"text number {k} of some words", "en", "a", 26) for k in range(40)]
    kind = T.StructType(
        [*T._parse_datatype_string(DOCUMENT).fields]
        + [T.StructField(name, T.StringType()) for name in CLASHING]
    )
    return spark.createDataFrame([(*row, *CLASHING) for row in rows], kind)


def bag(df, *columns):
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=repr)
