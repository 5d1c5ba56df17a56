"""Small tables for the operators' tests."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def docs(spark, rows, extra=()):
    """documents from (id, text[, lang[, source]]) rows; extra: names of further columns."""
    full = []
    for row in rows:
        key, text, lang, source = (*row, *("en", "src0")[len(row) - 2 :])
        full.append((key, text, lang, source, len(text or "")))
    frame = spark.createDataFrame(full, DOCS)
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit(f"extra {name}") for name in extra})


def write(df, tmp_path, name="documents"):
    folder = str(tmp_path)
    df.write.mode("errorifexists").parquet(f"{folder}/{name}.parquet")
    return folder
