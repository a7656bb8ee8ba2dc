import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starfold.operators.ordered import (
    percentiles,
    previous_value,
    running_max,
    select_at_cumulative,
)


@pytest.mark.parametrize("refine", [False, True])
@pytest.mark.parametrize("shape", ["wide", "narrow", "ties"])
def test_selection_matches_a_full_sort(spark, refine, shape):
    rng = np.random.default_rng(7)
    n = 600
    value = {
        "wide": rng.lognormal(0, 4, n),
        "narrow": 8000.0 + rng.random(n) * 1e-3,
        "ties": rng.integers(0, 5, n).astype(float),
    }[shape]
    pdf = pd.DataFrame(
        {"k": rng.integers(0, 3, n), "v": value, "w": rng.integers(0, 9, n).astype(float), "i": range(n)}
    )
    df = spark.createDataFrame(pdf)
    shares = [0.1, 0.5, 0.99, 1.0]

    def targets(total):
        return [(F.lit(s), total * s) for s in shares]

    got = select_at_cumulative(df, ["k"], "v", "w", targets, tie="i", refine=refine).toPandas()
    assert len(got) == 3 * len(shares)
    for k, part in pdf.groupby("k"):
        part = part.sort_values(["v", "i"])
        cum = part["w"].cumsum().to_numpy()
        for s in shares:
            at = min(int(np.searchsorted(cum, s * cum[-1])), len(part) - 1)
            row = got[(got.k == k) & (got.tag == s)].iloc[0]
            assert (row["value"], row["i"]) == (part["v"].iloc[at], part["i"].iloc[at])


def test_percentiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 2, 501), "v": rng.normal(size=501) * 1e3})
    got = percentiles(spark.createDataFrame(pdf), ["k"], "v", [0.1, 50.0, 99.9]).toPandas()
    for k, part in pdf.groupby("k"):
        for p in (0.1, 50.0, 99.9):
            mine = got[(got.k == k) & (got.pct == p)]["value"].iloc[0]
            assert mine == pytest.approx(np.percentile(part["v"], p))


def test_running_max_over_chunks(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.integers(0, 2, 200), "s": range(200), "t": rng.normal(size=200)})
    df = spark.createDataFrame(pdf).withColumn("c", F.floor(F.col("s") / 16))
    got = running_max(df, ["k"], "t", chunk=["c"], within="s").toPandas().sort_values("s")
    want = pdf.groupby("k")["t"].cummax()
    assert np.allclose(got["running_max"].to_numpy(), want.to_numpy())


def test_previous_value_over_chunks(spark):
    pdf = pd.DataFrame({"k": 0, "t": [0.0, 1.0, 2.0, 50.0, 51.0, 400.0]})
    got = previous_value(spark.createDataFrame(pdf), ["k"], "t", chunk_width=10.0, out="p")
    rows = {r["t"]: r["p"] for r in got.collect()}
    assert rows == {0.0: None, 1.0: 0.0, 2.0: 1.0, 50.0: 2.0, 51.0: 50.0, 400.0: 51.0}


def test_hot_key_reaches_the_final_window_only_in_part(spark, monkeypatch):
    """One key with nearly all rows: only the rows of the bins that are hit are sorted exactly."""
    from starfold.operators import ordered

    seen = []
    running = ordered._running
    monkeypatch.setattr(ordered, "_running", lambda df, *a: seen.append(df) or running(df, *a))
    df = spark.range(200_000).select(
        F.when(F.col("id") % 100 == 0, 1).otherwise(0).alias("k"),
        (F.rand(3) * 100).alias("v"),
        F.lit(1.0).alias("w"),
    )
    picked = ordered.select_at_cumulative(
        df, ["k"], "v", "w", lambda total: [(F.lit(0), total * 0.5)]
    )
    assert picked.count() == 2
    assert seen[-1].count() < 2_000


@pytest.mark.parametrize("shape", ["equal", "close", "mixed"])
def test_crowded_buckets_are_cut_below_the_bound(spark, monkeypatch, shape):
    """All values equal, or within one bin: no exact sort sees more than `bound` rows of a bucket."""
    from starfold.operators import ordered

    seen = []
    running = ordered._running
    monkeypatch.setattr(ordered, "_running", lambda df, part, *order: seen.append((df, part, order)) or running(df, part, *order))
    rng = np.random.default_rng(11)
    n = 4000
    value = {"equal": np.full(n, 3.5), "close": 8000.0 + rng.random(n) * 1e-9,
             "mixed": np.where(rng.random(n) < 0.7, 2.0, rng.random(n) * 9)}[shape]
    pdf = pd.DataFrame({"k": rng.integers(0, 2, n), "v": value, "w": rng.integers(1, 9, n).astype(float), "i": rng.permutation(n)})
    shares = [0.001, 0.3, 0.5, 1.0]
    got = select_at_cumulative(
        spark.createDataFrame(pdf), ["k"], "v", "w", lambda total: [(F.lit(s), total * s) for s in shares], tie="i", bound=50,
        sums={"_rows": F.lit(1.0), "_vw": F.col("v") * F.col("w")},
    ).toPandas()
    for k, part in pdf.groupby("k"):
        part = part.sort_values(["v", "i"])
        cum = part["w"].cumsum().to_numpy()
        for s in shares:
            at = min(int(np.searchsorted(cum, s * cum[-1])), len(part) - 1)
            row = got[(got.k == k) & (got.tag == s)].iloc[0]
            assert (row["value"], row["i"]) == (part["v"].iloc[at], part["i"].iloc[at])
            assert row["_rows"] == len(part) and row["_vw"] == pytest.approx((part["v"] * part["w"]).sum())
    exact, part, order = seen[-1]
    assert order == ("_v", "i")
    assert exact.groupBy(*part).count().agg({"count": "max"}).first()[0] <= 50
    if shape == "equal":
        assert exact.count() <= 50 * 2 * len(shares)


def test_equal_rows_end_the_cutting(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit(2.0).alias("v"), F.lit(1.0).alias("w"), F.lit(7).alias("i"))
    got = select_at_cumulative(df, ["k"], "v", "w", lambda t: [(F.lit(0), t * 0.5)], tie="i", bound=10)
    assert [(r["value"], r["i"]) for r in got.collect()] == [(2.0, 7)]


def test_stars_at_one_radius(spark):
    """A profile whose stars all stand at one radius still cuts them by id."""
    from starfold.operators.lagrangian import lagrangian_profile

    rows = [("s", 1.0, i, 1.0, 3.0, 0.0, 0.0, float(i % 3), 0.0, 0.0) for i in range(1000)]
    names = "simulation_id string, ttot double, object_id long, mass_msun double, x_pc double, y_pc double, z_pc double, vx_kms double, vy_kms double, vz_kms double"
    scalars = spark.createDataFrame([("s", 1.0, 2.0, 2.0)], "simulation_id string, ttot double, rc_nb double, rbar_pc double")
    got = {r["suffix"]: r for r in lagrangian_profile(spark.createDataFrame(rows, names), scalars).collect()}
    assert all(got[s]["nshell"] == round(1000 * float(s)) for s in ("0.1", "0.3", "0.5", "0.9") if s in got)
    assert all(r["rlagr"] == 3.0 for r in got.values() if r["nshell"])
