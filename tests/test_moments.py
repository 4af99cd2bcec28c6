import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import features, moments
from tidemark.streaming import live


@pytest.fixture
def rows(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(1e6, 2, 600)
    data = [(i, f"d{i % 7}", float(x), 2.5, None if i % 3 else float(i), None) for i, x in enumerate(values)]
    return spark.createDataFrame(data, "id int, day string, x double, flat double, holes double, `no.thing` double").cache()


COLUMNS = ["x", "flat", "holes", "no.thing"]


def test_merged_parts_equal_one_pass_in_any_order(spark, rows):
    parts = moments.part_moments(rows, COLUMNS, F.col("day"))
    whole = features.fit_moments(rows, COLUMNS[:3])
    assert moments.as_fit(moments.merge_moments(parts)) == {c: pytest.approx(v, rel=1e-9) for c, v in whole.items()}
    listed = [tuple(r) for r in parts.select("column", "n", "mean", "m2").collect()]
    assert {r[0] for r in listed} == set(COLUMNS[:3])
    random.Random(1).shuffle(listed)
    frames = [spark.createDataFrame(some, "column string, n long, mean double, m2 double") for some in (listed[:5], listed[5:])]
    again = moments.merge_moments(moments.merge_moments(frames[0]).unionByName(moments.merge_moments(frames[1])))
    assert moments.as_fit(again) == {c: pytest.approx(v, rel=1e-9) for c, v in whole.items()}
    assert moments.as_fit(again)["flat"][1] == 0.0


def test_stored_runs_renew_a_frozen_fit(spark, rows, tmp_path):
    folder = str(tmp_path / "moments")
    for day in ("d0", "d1"):
        moments.store_moments(rows.where(F.col("day") == day), ["x", "holes"], folder, day)
    moments.store_moments(rows.where("day = 'd1'"), ["x", "holes"], folder, "d1")  # a repeated run counts once
    first = features.fit_moments(rows.where("day < 'd2'"), ["x", "holes"])
    fit = live.FrozenFit(first, {"x": 1.0, "holes": 0.5})
    assert live.renewed(fit, spark, folder).moments == {c: pytest.approx(v, rel=1e-9) for c, v in first.items()}
    moments.store_moments(rows.where("day >= 'd2'"), ["x", "holes"], folder, F.col("day"))
    now = live.renewed(fit, spark, folder)
    assert now.moments == {c: pytest.approx(v, rel=1e-9) for c, v in features.fit_moments(rows, ["x", "holes"]).items()}
    assert now.weights == fit.weights


def test_without_rows(spark, rows, tmp_path):
    folder = str(tmp_path / "moments")
    moments.store_moments(rows.where("day = 'd0'"), ["x"], folder, "d0")
    moments.store_moments(rows.limit(0), ["x"], folder, "empty")
    assert moments.stored_moments(spark, folder).select("column", "n").collect() == [("x", 86)]
    assert moments.as_fit(moments.merge_moments(moments.part_moments(rows.limit(0), ["x"], "r"))) == {}
    fit = live.FrozenFit({"x": (1.0, 2.0), "holes": (3.0, 4.0)}, {})
    renewed = live.renewed(fit, spark, folder).moments
    assert renewed["holes"] == (3.0, 4.0) and renewed["x"] != (1.0, 2.0)


def test_no_row_is_shuffled(rows, plan):
    text = plan(moments.part_moments(rows, ["x"], F.col("day")))
    assert text.count("Exchange") == 1 and "partial_avg" in text
