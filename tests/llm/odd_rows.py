"""Small tables with everything that is allowed to be odd."""

from pyspark.sql import types as T

WORDS = "one two three four five six seven eight nine ten".split()
LONG = " ".join(f"{w}{i}" for i in range(4000) for w in WORDS)

# The extra columns carry names that the operators use inside.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
    T.StructField("node", T.IntegerType()), T.StructField("toxic", T.StringType()),
    T.StructField("target", T.ArrayType(T.IntegerType())), T.StructField("kept", T.DoubleType()),
    T.StructField("mark", T.StringType()), T.StructField("id", T.StringType()),
])
EXTRA = ("s", 1, "t", [1, None], 0.5, None, "i")


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), *EXTRA)


ROWS = [
    row(1, "Hello there\nshared line\n\nend"),
    row(2, None, None),
    row(3, "", "b"),
    row(4, " \t\r\n ", "b"),
    row(5, LONG, None),
    row(6, "Hello there\nshared line\n\nend", "b"),
    row(7, "x"),
    row(7, "x"),
    row(7, "another text under the same id"),
    row(None, "no id at all, but a text that is long enough to have some words"),
    row(None, None, None),
    row(8, "Zeile mit Ümlaut ÄÖ\nSHARED LINE \nПривет мир 😀 日本", "ü"),
]


def odd_docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
