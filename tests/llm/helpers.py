"""Awkward rows that every operator has to bear, and plain versions to compare with."""

from __future__ import annotations

#: One of each kind of trouble: NULLs, empty and long texts, repeated rows and ids, non-ASCII.
ROWS = [
    (1, "The cat sat on the mat, and the dog watched.", "en", "a", 7),
    (1, "The cat sat on the mat, and the dog watched.", "en", "a", 7),
    (2, None, "en", "a", 7),
    (3, "", None, None, None),
    (None, "Words without an id stand here.", "en", "b", 1),
    (4, " \t\n ", "de", "b", 0),
    (5, "Ünïcödé — 東京 \U0001f600 ﬁn", "de", None, 3),
    (6, "long " * 60_000, "en", "a", 9),
    (7, "x" * 200_000, "de", "b", 9),
    (4, "Another text under a repeated id.", "en", "c", 0),
]
#: Column names that operators use themselves.
CLASHES = ("score", "size", "h", "fp", "rank", "held_out", "component_id", "taken", "text_hash", "verdict", "part")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, extra=True):
    df = spark.createDataFrame(ROWS if rows is None else rows, DOCUMENT).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


def no_documents(spark):
    return documents(spark, [], extra=True)


def groups(n, linked):
    """Least member of each one's component, for ``linked(i, j)``."""
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [find(i) for i in range(n)]
