"""Small tables and brute-force helpers for the operator tests."""

import re

import pandas as pd
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("size", T.LongType()),
                     T.StructField("key", T.StringType()), T.StructField("id", T.StringType())])
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """(doc_id, text[, lang[, source]]) rows; three more columns clash with names used inside."""
    full = []
    for r in rows:
        i, text, lang, source = (*r, None, None)[:4] if len(r) < 4 else r[:4]
        full.append((i, text, lang, source, None if text is None else len(text), 7, "k", "x"))
    return spark.createDataFrame(full, DOCS)


def table(spark, name="documents", sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rows(df):
    return df.toPandas()


def frame(df, key="doc_id"):
    out = df.toPandas()
    return out.sort_values([c for c in out.columns if c == key] or list(out.columns)).reset_index(drop=True)


def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"wort{i % 977} zahl{i % 31}" for i in range(30_000))
    return [(1, None, "en", "a"), (2, "", "en", None), (3, "  \t\n", None, "a"), (4, long, "de", "b"),
            (5, long + " ende", "de", "b"), (6, "ab c", "en", "a"), (6, "ab c", "en", "a"),
            (7, "ab \n c", "en", None), (None, "ab c", None, None), (None, "only null id here", "en", "b"),
            (8, "!!! 123 --", "fr", "a"), (9, "x", "fr", "c")]


def pandas_docs(spark, sf=SF):
    return table(spark, sf=sf).toPandas() if spark else pd.read_parquet(f"{sf}/documents.parquet")
