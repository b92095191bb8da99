"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, words string"
LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(40_000))
ROWS = [
    (1, "plain words stand here " * 20, "en", "s", 1, None, "x"),
    (2, None, None, None, None, None, None),
    (3, "", "en", "s", 0, 1.0, "y"),
    (4, " \t\n\x0b\f\r ", "en", "s", 7, 1.0, "y"),
    (5, LONG, "en", "s", len(LONG), 1.0, "y"),
    (6, "tie tie tie", "de", "s", 11, 1.0, "y"),
    (7, "tie tie tie", "de", "s", 11, 1.0, "y"),
    (7, "tie tie tie", "de", "s", 11, 1.0, "y"),
    (None, "no id, but a text", "en", "s", 17, 1.0, "y"),
    (None, None, None, None, None, None, None),
    (9, "▁é́ \U0001f600 ### 4111 1111 1111 1111 a@b.co", "en", "s", 30, 1.0, "y"),
]


def edge_docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
