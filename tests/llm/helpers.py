"""Rows that every operator has to bear."""

ODD = [
    (1, "plain words here, and more words"),
    (2, None),
    (3, ""),
    (None, "a row without an id"),
    (5, "x" * 5000),
    (6, "word " * 3000),
    (7, "plain words here, and more words"),
    (7, "plain words here, and more words"),
    (8, " \t\n "),
    (9, "emoji ☃ 漢字 é\n\n\nline"),
    (10, "漢字กข😀é" * 8000 + " mixed Ärger\n" * 3000),
]


def odd(spark, extra=True):
    """Documents with nulls, copies, empty and long texts, and clashing column names."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    if not extra:
        return df
    names = ("id", "row", "fp", "score", "label", "length", "code", "component", "_rank", "tail", "token")
    return df.selectExpr("*", *(f"'clash' AS {n}" for n in names))


def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
