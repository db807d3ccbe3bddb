"""Clustering invariants (FIXTURES D8) and the two preparation modes."""

import datetime as dt

import pytest

from roadcast import schemas as SC
from roadcast.operators import cluster as M


def weather(spark):
    rows = [
        (dt.datetime(2021, 1, 1, h), float(h), None if h == 1 else 0.5, None, 2.0, 1.0, 50.0, 5.0, 1.0,
         1000.0, None, 10.0, 3.0, 2.0, None if h in (2, 3) else float(h % 4))
        for h in range(8)
    ] + [(dt.datetime(2021, 1, 1, 9), None, 1.0, 1.0, 2.0, 1.0, 50.0, 5.0, 1.0, 1000.0, 1.0, 10.0, 3.0, 2.0, 1.0)]
    cols = ["ts", "temp_c", "rain_mm", "snow_cm", "wind_ms", "wind_dir", "humidity", "vapor_hpa", "dew_c",
            "sea_hpa", "solar_mj", "visibility", "ground_c", "soil5_c", "cloud"]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {'timestamp' if c == 'ts' else 'double'}" for c in cols))


def test_d8_modes(spark):
    w = weather(spark)
    full = {r.ts.hour: r for r in M.prep_conditions(w, SC.FULL_MODE).collect()}
    compact = {r.ts.hour: r for r in M.prep_conditions(w, SC.COMPACT_MODE).collect()}
    assert 9 not in full and 9 not in compact          # null temperature: dropped in both
    assert full[1].rain_mm == -1.0 and compact[1].rain_mm == 0.0
    assert 2 not in full and 2 in compact               # null cloud drops the row in full mode only
    assert full[4].cloud_filled == full[4].cloud


def test_kmeans_assignment_matches_model(spark):
    w = M.prep_conditions(weather(spark), SC.COMPACT_MODE)
    feats = M.assemble(w, SC.COMPACT_MODE.features)
    model = M.fit_conditions(feats, 2, seed=7)
    pred = {r.ts: r.condition for r in model.transform(feats).collect()}
    fixed = M.assign_condition(w, [list(c) for c in model.clusterCenters()], SC.COMPACT_MODE.features)
    assert {r.ts: r.condition for r in fixed.collect()} == pred
    s = M.silhouette(model.transform(feats))
    assert -1.0 <= s <= 1.0
    with pytest.raises(ValueError):
        M.fit_conditions(feats, 1)
