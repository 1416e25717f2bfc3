"""Frames with the edge cases every corpus operator must take."""

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977}" for i in range(30_000))

DOCS = T.StructType([T.StructField(n, t) for n, t in [
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
    # Extra columns named as the operators' own.
    ("id", T.StringType()), ("doc", T.LongType()), ("rid", T.LongType()), ("fp", T.LongType()), ("row", T.StringType()),
    ("gone", T.StringType()), ("label", T.IntegerType()), ("train", T.BooleanType()), ("component", T.LongType())]])


def docs(spark, rows):
    extra = ("x", 1, 2, 3, "r", "g", 4, True, 5)
    return spark.createDataFrame([(i, t, "en", "s", *extra) for i, t in rows], DOCS)


EDGES = [(1, "the quick brown fox jumps over the lazy dog again"), (2, None), (3, ""), (4, " \t\n "),
         (None, "a text without an id"), (5, LONG), (6, "the quick brown fox jumps over the lazy dog again"),
         (1, "the quick brown fox jumps over the lazy dog again"), (7, "one"), (8, "Ünï\x0bcode\x1c 中文 \U0001f600 <|endoftext|>")]
