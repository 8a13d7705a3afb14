"""Tables with everything that is allowed to be odd."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use inside.
CLASHES = ("size", "taken", "shard_", "row", "key", "score", "at", "component_id", "keep_id", "fp")

TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog, again and again."),
    (1, "THE QUICK brown fox jumps over the lazy dog, again and again."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "é ñ ß Ω 漢字  two  spaces odd \x0b end"),
    (6, "The quick brown fox jumps over the lazy dog, again and again."),
    (7, "word " * 30_000),
    (8, "one"),
    (9, "É ñ ß Ω 漢字  two  spaces odd \x0b end"),
    (9, "repeated id"),
    (9, "repeated id"),
    (None, "one"),
    (None, None),
]


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en", None if (i or 0) % 5 == 2 else f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], DOCUMENTS)


def clashing(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(1).alias(c) for c in CLASHES])


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
