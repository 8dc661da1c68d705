"""Rows that each corpus operator must bear, and plain versions to compare with."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in
                      ("lang", "key", "h", "n", "th", "id", "row", "words", "copy_of", "kept", "spans", "win", "k", "rank")])


def documents(spark, rows):
    """(doc_id, text) rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", *["x"] * 13) for i, t in rows], SCHEMA)


LONG = " ".join(f"w{i % 977}" for i in range(20_000))
BIG = (1 << 60) + 7  # an id that no float holds
ODD = [(None, None), (None, "alone"), (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (6, "!!!"), (7, "a" * 30_000), (8, LONG), (9, LONG), (BIG, LONG + " end"), (4, "one"), (10, "naïve ÜBER straße 日本語 🙂")]


def plain(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=lambda t: tuple((v is not None, v) for v in t))
