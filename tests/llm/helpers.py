"""Small documents that hold the awkward cases."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def documents(spark, rows, folder=None):
    """Rows ``(doc_id, text[, source[, lang]])`` as a documents table, stored if a folder is given."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCUMENTS)
    return df if folder is None else stored(spark, df, folder)


def stored(spark, df, folder):
    df.write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def clashing(df, *names):
    """Extra columns with names an operator uses itself."""
    for name in names:
        if name not in df.columns:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df
