"""Sources and sinks on small files written by the test (cp949, broken headers,
encodings, reuse of prepared datasets)."""

import os

import pytest
from pyspark.sql import types as T

from roadcast.sources import files as S

SCHEMA = T.StructType([T.StructField("일자", T.IntegerType()), T.StructField("시점명", T.StringType()),
                       T.StructField("10시", T.DoubleType())])


def write(path, text, enc):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(enc))


def test_read_monthly_layouts(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/2021년 12월 통행속도.csv", ",일자,시점명,10시\n0,20211201,시청앞,30.5\n", "cp949")
    # shifted: names one place right of the data, last column empty
    write(f"{d}/2017년11월 통행속도.csv", "x,일자,시점명,10시\n20171101,남산길,12.0,\n", "cp949")
    write(f"{d}/2017년 8월 통행속도.csv", ",일자,시점명,~10시\n0,20170801,서울역,bad\n", "cp949")
    df = S.read_monthly(spark, {"plain": [f"{d}/2021년 12월 통행속도.csv"],
                                "shifted": [f"{d}/2017년11월 통행속도.csv"],
                                "tilde": [f"{d}/2017년 8월 통행속도.csv"]}, SCHEMA,
                        repairs={"tilde": lambda x: S.strip_header_chars(x, "~", 3)})
    got = sorted((r["일자"], r["시점명"], r["10시"], str(r.period)) for r in df.collect())
    assert got == [(20170801, "서울역", None, "2017-08-01"), (20171101, "남산길", 12.0, "2017-11-01"),
                   (20211201, "시청앞", 30.5, "2021-12-01")]


def test_audit_encoding(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/u.csv", "a,서울\n", "utf-8")
    write(f"{d}/b.csv", "﻿a,서울\n", "utf-8")
    write(f"{d}/c.csv", "a,서울\n", "cp949")
    got = {r.file: r.encoding for r in S.audit_encoding(spark, f"{d}/*.csv").collect()}
    assert got == {"u.csv": "utf-8", "b.csv": "utf-8-sig", "c.csv": "cp949"}


def test_materialize_reuses(spark, tmp_path):
    path = str(tmp_path / "m")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5).withColumnRenamed("id", "k")

    assert S.materialize(spark, path, build).count() == 5
    assert S.materialize(spark, path, build).count() == 5
    assert len(calls) == 1
    S.materialize(spark, path, build, refresh=True)
    assert len(calls) == 2


def test_cluster_meta_roundtrip(spark, tmp_path):
    path = str(tmp_path / "meta")
    meta = spark.createDataFrame(S.cluster_meta(0.25, 4, "compact", ["a", "b"]), S.CLUSTER_META_SCHEMA)
    S.write_cluster_meta(meta, path)
    r = S.read_cluster_meta(spark, path).first()
    assert (r.silhouette, r.k, r.mode, r.columns) == (0.25, 4, "compact", ["a", "b"])


def test_conform_schema_missing_column(spark):
    df = spark.createDataFrame([("1",)], "`일자` string")
    with pytest.raises(ValueError):
        S.conform_schema(df, SCHEMA)


def test_audit_encoding_line_endings(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/crlf.csv", "a,서울\r\nb,부산\r\n", "utf-8")
    write(f"{d}/crlf_bom.csv", "﻿a,서울\r\nb,부산", "utf-8")
    write(f"{d}/nofinal.csv", "a,서울\nb,부산", "cp949")
    write(f"{d}/bom_nofinal.csv", "﻿a", "utf-8")
    got = {r.file: r.encoding for r in S.audit_encoding(spark, f"{d}/*.csv").collect()}
    assert got == {"crlf.csv": "utf-8", "crlf_bom.csv": "utf-8-sig", "nofinal.csv": "cp949",
                   "bom_nofinal.csv": "utf-8-sig"}


def test_write_prepared_caps_files_and_partitions(spark, tmp_path):
    import glob

    df = spark.range(1000).selectExpr("id", "id % 3 AS hour")
    S.write_prepared(df, str(tmp_path / "capped"), "json", max_files=2)
    assert len(glob.glob(str(tmp_path / "capped" / "part-*"))) <= 2
    S.write_prepared(df, str(tmp_path / "byhour"), "parquet", partition_by=["hour"])
    back = spark.read.parquet(str(tmp_path / "byhour"))
    assert back.count() == 1000 and sorted(r.hour for r in back.select("hour").distinct().collect()) == [0, 1, 2]


def test_file_names_lists_periods(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/2017년 12월 통행속도.csv", "a\n1\n", "cp949")
    write(f"{d}/2017년 1월 통행속도.csv", "a\n1\n", "cp949")
    got = sorted((r.file, r.digits, str(r.period)) for r in S.file_names(spark, f"{d}/*.csv").collect())
    assert got == [("2017년 12월 통행속도.csv", "201712", "2017-12-01"),
                   ("2017년 1월 통행속도.csv", "20171", "2017-01-01")]


def test_transcode_to_cp949(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/src/a.csv", "name,n\n시청앞,1\n남산길,2\n", "utf-8")
    S.transcode_csv(spark, f"{d}/src", f"{d}/dst", "utf-8", "cp949")
    import glob
    raw = b"".join(open(f, "rb").read() for f in glob.glob(f"{d}/dst/*.csv"))
    assert "시청앞".encode("cp949") in raw and "시청앞".encode("utf-8") not in raw
    back = S.read_csv(spark, f"{d}/dst", None, "cp949")
    assert sorted((r.name, r.n) for r in back.collect()) == [("남산길", "2"), ("시청앞", "1")]


def test_read_monthly_takes_each_files_own_header(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/202111.csv", ",일자,시점명,10시\n0,20211101,시청앞,30.5\n", "cp949")
    write(f"{d}/202112.csv", ",10시,일자,시점명\n0,12.0,20211201,남산길\n", "cp949")
    df = S.read_monthly(spark, {"plain": [f"{d}/*.csv"]}, SCHEMA)
    got = sorted((r["일자"], r["시점명"], r["10시"], str(r.period)) for r in df.collect())
    assert got == [(20211101, "시청앞", 30.5, "2021-11-01"), (20211201, "남산길", 12.0, "2021-12-01")]
    write(f"{d}/202201.csv", ",일자,시점명\n0,20220101,남산길\n", "cp949")
    with pytest.raises(ValueError, match="missing"):
        S.read_monthly(spark, {"plain": [f"{d}/*.csv"]}, SCHEMA)


def test_interrupted_write_is_not_reused(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(100).repartition(4).write.parquet(path)
    os.remove(os.path.join(path, "_SUCCESS"))
    os.remove(os.path.join(path, next(f for f in os.listdir(path) if f.startswith("part-"))))
    assert S.materialize(spark, path, lambda: spark.range(7)).count() == 7


def jobs_of(spark, call):
    """Number of Spark jobs that ``call`` runs (through the public status tracker)."""
    group = f"count-jobs-{id(call)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        call()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_any_number_of_files_take_the_same_jobs(spark, tmp_path):
    counts = []
    for n in (2, 9):
        d = str(tmp_path / str(n))
        for i in range(n):
            cols, row = (",일자,시점명,10시", f"0,2021010{i + 1},시청앞,30.5") if i % 2 else (",10시,일자,시점명", f"0,30.5,2021010{i + 1},시청앞")
            write(f"{d}/20210{i + 1}.csv", cols + "\n" + (row + "\n") * 400, "cp949")
        frames = []
        counts.append(jobs_of(spark, lambda: frames.append(S.read_monthly(spark, {"plain": [f"{d}/*.csv"]}, SCHEMA))))
        got = frames[0].groupBy("일자", "시점명", "10시", "period").count().collect()
        assert sorted((r["일자"], r["시점명"], r["10시"], str(r["period"]), r["count"]) for r in got) == [
            (20210101 + i, "시청앞", 30.5, f"2021-0{i + 1}-01", 400) for i in range(n)]
    assert counts[0] == counts[1]


def test_files_without_header_or_period_are_errors(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/a/202101.csv", ",일자,시점명,10시\n0,20210101,a,1\n", "cp949")
    write(f"{d}/a/readme.csv", ",일자,시점명,10시\n0,20210101,a,1\n", "cp949")
    with pytest.raises(ValueError, match="readme"):
        S.read_monthly(spark, {"plain": [f"{d}/a/*.csv"]}, SCHEMA)
    write(f"{d}/b/202101.csv", ",일자,시점명,10시\n", "cp949")
    write(f"{d}/b/202102.csv", "", "cp949")              # Spark lists no file without bytes
    assert S.read_monthly(spark, {"plain": [f"{d}/b/*.csv"]}, SCHEMA).count() == 0
    write(f"{d}/b/202103.csv", "\n0,20210301,a,1\n", "cp949")
    with pytest.raises(ValueError):
        S.read_monthly(spark, {"plain": [f"{d}/b/*.csv"]}, SCHEMA)


def test_failed_rebuild_leaves_the_old_dataset(spark, tmp_path):
    path = str(tmp_path / "m")
    S.materialize(spark, path, lambda: spark.range(5))
    broken = spark.range(100).repartition(4).selectExpr("raise_error(concat('row ', id)) AS id")
    with pytest.raises(Exception, match="row "):
        S.materialize(spark, path, lambda: broken, refresh=True)
    assert spark.read.parquet(path).count() == 5
    # a dataset may be rebuilt from itself
    S.materialize(spark, path, lambda: spark.read.parquet(path).selectExpr("id + 1 AS id"), refresh=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]
    # stopped between the two renames: the old one is put back
    os.rename(path, path + ".old-x")
    assert S.materialize(spark, path, lambda: spark.range(99)).count() == 5


def test_manifest_rebuilds_on_changed_inputs(spark, tmp_path):
    d, path, calls = str(tmp_path / "in"), str(tmp_path / "m"), []

    def get(*parameters):
        return S.materialize(spark, path, lambda: calls.append(1) or spark.read.text(f"{d}/*.csv"),
                             manifest=S.fingerprint(spark, [f"{d}/*.csv"], *parameters)).count()

    write(f"{d}/a.csv", "1\n", "utf-8")
    assert (get(), get(), len(calls)) == (1, 1, 1)
    write(f"{d}/b.csv", "1\n2\n", "utf-8")
    assert (get(), get(), len(calls)) == (3, 3, 2)
    assert (get("k=5"), get("k=5"), len(calls)) == (3, 3, 3)
    write(f"{d}/b.csv", "1\n", "utf-8")
    assert (get("k=5"), len(calls)) == (2, 4)
