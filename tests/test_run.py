"""End-to-end run (Q6) on hand-made monthly speed files and weather observations."""

import os

from pyspark.sql import functions as F

from roadcast.plans import jobs as J

SPEED_HEADER = ",일자,요일,도로명,링크아이디,시점명,종점명,방향,거리,10시,15시,24시"


def write(path, lines, enc="cp949"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(("\n".join(lines) + "\n").encode(enc))


def test_full_run_reuses_and_routes(spark, tmp_path):
    d = str(tmp_path)
    dec = [SPEED_HEADER,
           "0,20211201,수,길,1,A,B,상행,1000,36,36,",
           "1,20211201,수,길,2,B,C,상행,1000,36,36,",
           "2,20211201,수,길,3,A,C,상행,5000,36,36,"]
    nov = [SPEED_HEADER,
           "0,20211130,화,길,1,A_old,B_old,상행,1000,36,0,",   # renamed to A->B; 15h speed 0 dropped
           "1,20211130,화,길,9,X,Y,상행,1000,36,36,"]          # link absent in the newest month
    write(f"{d}/speed/2021년 12월 통행속도.csv", dec)
    write(f"{d}/speed/2021년 11월 통행속도.csv", nov)
    weather = ["지점,일시,기온(°C),강수량(mm),적설(cm),풍속(m/s)",
               "108,2021-12-01 10:00,1.5,,,2.0", "108,2021-12-01 15:00,4.0,0.5,,2.0",
               "108,2021-11-30 10:00,-3.0,,1.0,2.0", "108,2021-11-30 15:00,-1.0,,,2.0"]
    write(f"{d}/weather/2021.csv", weather)
    cfg = J.RunConfig(
        traffic_path=f"{d}/out/traffic", conditions_path=f"{d}/out/conditions",
        labelled_path=f"{d}/out/labelled", meta_path=f"{d}/out/meta",
        speed_layouts={"plain": [f"{d}/speed/*.csv"]}, weather_paths=[f"{d}/weather/2021.csv"], k=2)
    labelled_conditions = None
    for attempt in range(2):   # second run reuses every prepared dataset
        pairs_src = spark.read.parquet(cfg.labelled_path) if attempt else None
        if pairs_src is None:
            pairs = spark.createDataFrame([(0, 10, "A", "C")], "condition int, hour int, src string, dst string")
        else:
            pairs = pairs_src.select("condition", "hour", F.lit("A").alias("src"), F.lit("C").alias("dst")).distinct()
        out = J.run(spark, cfg, pairs).collect()
        if attempt:
            labelled_conditions = out
    facts = spark.read.parquet(cfg.traffic_path)
    got = sorted((str(r.date), r.link_id, r.from_node, r.to_node, r.hour, r.travel_s) for r in facts.collect())
    assert got == [("2021-11-30", 1, "A", "B", 10, 100.0),
                   ("2021-12-01", 1, "A", "B", 10, 100.0), ("2021-12-01", 1, "A", "B", 15, 100.0),
                   ("2021-12-01", 2, "B", "C", 10, 100.0), ("2021-12-01", 2, "B", "C", 15, 100.0),
                   ("2021-12-01", 3, "A", "C", 10, 500.0), ("2021-12-01", 3, "A", "C", 15, 500.0)]
    labelled = spark.read.parquet(cfg.labelled_path)
    assert labelled.where("condition < 0").count() == 0          # every fact hour has weather
    for r in labelled_conditions:
        if r.status == "ok":
            assert r.path == ["A", "B", "C"] and r.total == 200.0
        else:
            assert r.status == "dst_missing"                     # the Nov scenario has only A->B


def test_changed_inputs_rebuild_what_depends_on_them(spark, tmp_path):
    d = str(tmp_path)
    speed = lambda day, rows: [SPEED_HEADER, *[f"{i},{day},수,길,{i},{a},{b},상행,1000,36,36," for i, (a, b) in enumerate(rows)]]
    write(f"{d}/speed/2021년 11월 통행속도.csv", speed(20211101, [("A", "B")]))
    # two stations observe one hour: the last by station number counts
    write(f"{d}/weather/2021.csv", ["지점,일시,기온(°C),강수량(mm),적설(cm),풍속(m/s)", "108,2021-11-01 10:00,30.0,,,2.0",
                                    "112,2021-11-01 10:00,-20.0,,,2.0", "112,2021-11-01 15:00,31.0,,,2.0",
                                    "108,2021-11-01 15:00,-21.0,,,2.0"])
    cfg = J.RunConfig(traffic_path=f"{d}/out/traffic", conditions_path=f"{d}/out/conditions", labelled_path=f"{d}/out/labelled",
                      meta_path=f"{d}/out/meta", speed_layouts={"plain": [f"{d}/speed/*.csv"]},
                      weather_paths=[f"{d}/weather/*.csv"], k=2)

    def built():
        report = {}
        J.prepare_datasets(spark, cfg, report)
        return report["built"]

    assert built() == ["traffic", "conditions", "labelled"] and built() == []
    at = {r.hour: r.condition for r in spark.read.parquet(cfg.labelled_path).collect()}
    of = {(r.station, r.ts.hour): r.condition for r in spark.read.parquet(cfg.conditions_path).collect()}
    assert at == {10: of[112.0, 10], 15: of[112.0, 15]} and at[10] != at[15]
    write(f"{d}/speed/2021년 12월 통행속도.csv", speed(20211201, [("A", "B"), ("B", "C")]))
    assert built() == ["traffic", "labelled"] and built() == []
    assert spark.read.parquet(cfg.labelled_path).count() == 6
    cfg.k = 3
    assert built() == ["conditions", "labelled"]
    cfg.refresh = ["traffic"]
    assert built() == ["traffic", "labelled"]


def test_report_follows_the_sidecar(spark, tmp_path):
    from roadcast import schemas as SC
    from roadcast.sources import files as S

    d = str(tmp_path)
    rows = [(0, *[float(i) for i in range(15)]), (0, *[float(i + 2) for i in range(15)]), (1, *[9.0] * 15)]
    full = spark.createDataFrame(rows, ["condition", *SC.FULL_FEATURES])
    full.write.parquet(f"{d}/conditions")
    for spec, features, count in ((SC.FULL_MODE, SC.FULL_FEATURES, []), (SC.COMPACT_MODE, SC.COMPACT_MODE.features, ["n"])):
        meta = spark.createDataFrame(S.cluster_meta(0.5, 2, spec.name, features), S.CLUSTER_META_SCHEMA)
        S.write_cluster_meta(meta, f"{d}/meta")
        said, summary, profile = J.stored_report(spark, f"{d}/conditions", f"{d}/meta")
        assert said.first().mode == spec.name and summary.first().n_rows == 3
        assert profile.columns == ["condition", *[f"avg_{c}" for c in features], *count]
        got = [tuple(r) for r in profile.collect()]
        at = [SC.FULL_FEATURES.index(c) for c in features]
        assert got == [(0, *[i + 1.0 for i in at], *([2] if count else [])), (1, *[9.0] * len(at), *([1] if count else []))]
