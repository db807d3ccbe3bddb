"""Registered queries for sources and sinks (S1-S9, K1-K4).

Each query writes data derived from a driver table into a fresh folder under
the session's checkpoint directory (shared storage on a cluster), reads it
back through the operator under test and returns what was read; the oracle
selects the same values from the driver table.  ``nation`` gets a Korean
text column so that the legacy encoding matters.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as X
from ..sources import files as S
from ..session import scratch_path
from .common import cents, load, register, ts_text

NATION_KO_SCHEMA = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()),
    T.StructField("n_name", T.StringType()),
    T.StructField("n_regionkey", T.IntegerType()),
    T.StructField("n_name_ko", T.StringType()),
])
NATION_KO_SQL = "SELECT n_nationkey, n_name, n_regionkey, '나라 ' || n_nationkey AS n_name_ko FROM nation"


def nation_ko(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    return n.select("n_nationkey", "n_name", "n_regionkey",
                    F.concat(F.lit("나라 "), F.col("n_nationkey").cast("string")).alias("n_name_ko"))


def _write_csv(df, path, encoding="cp949"):
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def _with_index(df):
    """Leading unnamed index column, as a pandas-written file has."""
    return df.select(F.col("n_nationkey").alias(""), *df.columns)


def _shifted(df):
    """Names one place right of the data, last column empty."""
    cols = df.columns
    pad = "24시"
    data = [F.col(cols[0]).alias(pad)] + [F.col(cols[i]).alias(cols[i - 1]) for i in range(1, len(cols))]
    return df.select(*data, F.lit(None).cast("string").alias(cols[-1]))


def _tilde(df, from_pos):
    return df.select(*[F.col(c).alias(("~" + c) if i >= from_pos else c)
                       for i, c in enumerate(df.columns)])


# ---------------------------------------------------------------- S1 / S6
@register("src_csv_cp949", oracle=NATION_KO_SQL)
def q_src_csv_cp949(spark, sf_dir):
    path = scratch_path(spark, "csv-cp949")
    _write_csv(_with_index(nation_ko(spark, sf_dir)), path)
    raw = S.read_csv(spark, path, None, "cp949")
    return S.conform_schema(S.drop_index_column(raw), NATION_KO_SCHEMA)


# ---------------------------------------------------------------- S2 / S3 / S4 / S5
@register("src_multi_file", oracle=f"""
SELECT n.*, strftime(make_date(2021, n_regionkey + 1, 1), '%Y-%m-%d') AS period,
       '2021년 ' || (n_regionkey + 1) || '월 통행속도.csv' AS source_file
FROM ({NATION_KO_SQL}) n""")
def q_src_multi_file(spark, sf_dir):
    base = scratch_path(spark, "monthly")
    n = nation_ko(spark, sf_dir)
    layouts = {"plain": [], "shifted": [], "tilde": []}
    # one folder per "month" (region r -> month r+1); two months use broken headers
    for r in range(5):
        path = f"{base}/2021년 {r + 1}월 통행속도.csv"
        part = n.where(F.col("n_regionkey") == r)
        if r == 3:
            _write_csv(_shifted(part), path)
            layouts["shifted"].append(path)
        elif r == 4:
            _write_csv(_tilde(_with_index(part), 3), path)
            layouts["tilde"].append(path)
        else:
            _write_csv(_with_index(part), path)
            layouts["plain"].append(path)
    df = S.read_monthly(spark, layouts, NATION_KO_SCHEMA, "cp949", name_level=1,
                        repairs={"tilde": lambda d: S.strip_header_chars(d, "~", 3)})
    return df.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


@register("fn_file_period", oracle="""
SELECT o_orderkey, name, digits, 'csv' AS ext, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period
FROM (SELECT o_orderkey, o_orderdate,
             year(o_orderdate) || '년' || CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END
               || month(o_orderdate) || '월 통행속도.csv' AS name,
             year(o_orderdate) || '' || month(o_orderdate) AS digits
      FROM orders)""")
def q_fn_file_period(spark, sf_dir):
    od = load(spark, sf_dir, "orders")
    name = F.concat(F.year("o_orderdate").cast("string"), F.lit("년"),
                    F.when(F.col("o_orderkey") % 2 == 0, F.lit(" ")).otherwise(F.lit("")),
                    F.month("o_orderdate").cast("string"), F.lit("월 통행속도.csv"))
    p = od.select("o_orderkey", name.alias("name")).withColumn("p", X.file_period("name"))
    return p.select("o_orderkey", "name", "p.digits", "p.ext",
                    F.date_format("p.period", "yyyy-MM-dd").alias("period"))


@register("clean_shifted_header", oracle=NATION_KO_SQL)
def q_clean_shifted_header(spark, sf_dir):
    path = scratch_path(spark, "shifted")
    _write_csv(_shifted(nation_ko(spark, sf_dir)), path)
    return S.conform_schema(S.fix_shifted_header(S.read_csv(spark, path)), NATION_KO_SCHEMA)


@register("clean_header_chars", oracle=NATION_KO_SQL)
def q_clean_header_chars(spark, sf_dir):
    path = scratch_path(spark, "tilde")
    _write_csv(_tilde(nation_ko(spark, sf_dir), 2), path)
    raw = S.read_csv(spark, path)
    return S.conform_schema(S.strip_header_chars(raw, "~", 2), NATION_KO_SCHEMA)


# ---------------------------------------------------------------- S9
@register("audit_encoding", oracle="""
SELECT DISTINCT 'utf8' AS folder, 'utf-8' AS encoding FROM nation
UNION ALL SELECT DISTINCT 'bom', 'utf-8-sig' FROM nation
UNION ALL SELECT DISTINCT 'cp949', 'cp949' FROM nation""")
def q_audit_encoding(spark, sf_dir):
    """Three CSV folders written from ``nation``: UTF-8, UTF-8 with a BOM line, cp949."""
    base = scratch_path(spark, "encodings")
    n = nation_ko(spark, sf_dir)
    _write_csv(n, f"{base}/utf8", "utf-8")
    bom = n.select(F.concat(F.lit("﻿"), F.col("n_nationkey").cast("string")).alias("k"),
                   "n_name_ko").coalesce(1)
    bom.write.mode("overwrite").option("header", False).csv(f"{base}/bom")
    _write_csv(n, f"{base}/cp949", "cp949")
    enc = S.audit_encoding(spark, f"{base}/*/*.csv", name_level=1)
    return enc.select(F.col("file").alias("folder"), "encoding").distinct()


# ---------------------------------------------------------------- S7 / K1 / P9
PREPARED_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("cents", T.LongType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("note", T.StringType()),          # all null: must survive the round trip
])


@register("io_json_roundtrip", oracle="""
SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, CAST(NULL AS VARCHAR) AS note
FROM orders""")
def q_io_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "prepared-json")
    od = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", cents("o_totalprice").alias("cents"), "o_orderdate",
        F.lit(None).cast("string").alias("note"))
    S.write_prepared(od.where(F.col("o_orderkey") < 0), path, "json")  # first write ...
    S.write_prepared(od, path, "json", max_files=4)                   # ... replaced
    back = S.read_prepared(spark, path, PREPARED_SCHEMA, "json")
    return back.withColumn("o_orderdate", ts_text("o_orderdate"))


@register("io_parquet_partitioned", oracle="""
SELECT l_orderkey, l_linenumber, l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
FROM lineitem""")
def q_io_parquet_partitioned(spark, sf_dir):
    path = scratch_path(spark, "prepared-parquet")
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", cents("l_extendedprice").alias("cents"))
    S.write_prepared(li, path, "parquet", partition_by=["l_returnflag"])
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_returnflag", "cents")


# ---------------------------------------------------------------- K3
@register("io_materialize", oracle="""
SELECT o_orderpriority, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS total_cents,
       1 AS builds
FROM orders GROUP BY 1""")
def q_io_materialize(spark, sf_dir):
    path = scratch_path(spark, "materialized")
    builds = []

    def build():
        builds.append(1)
        od = load(spark, sf_dir, "orders")
        return od.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum(cents("o_totalprice")).alias("total_cents"))

    S.materialize(spark, path, build)               # builds and writes
    again = S.materialize(spark, path, build)       # must read, not rebuild
    return again.withColumn("builds", F.lit(len(builds)))


# ---------------------------------------------------------------- K4
@register("io_transcode", oracle=NATION_KO_SQL)
def q_io_transcode(spark, sf_dir):
    src, dst = scratch_path(spark, "utf8"), scratch_path(spark, "to-cp949")
    _write_csv(nation_ko(spark, sf_dir), src, "utf-8")
    S.transcode_csv(spark, src, dst, "utf-8", "cp949")
    return S.conform_schema(S.read_csv(spark, dst, None, "cp949"), NATION_KO_SCHEMA)
