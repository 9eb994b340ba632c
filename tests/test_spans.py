"""Operators that number, sum and sample by spans, joint commits, and the vanishing point."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import estimators, gates, metrics, sampling, sequences
from kerbside.sources import contracts


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]), k, draw.choice([0.1, 0.5, 0.50004, round(draw.random(), 5)])) for k in range(500)]
    return rows, spark.createDataFrame(rows, "g string, k long, v double")


@pytest.mark.parametrize("first", [None, 7])
def test_numbered_equals_one_sort(scored, first):
    rows, df = scored
    found = {r["k"]: (r["place"], r["m"]) for r in sequences.numbered(df, F.floor(F.col("v") * 100), ["v", "k"], ["g"], first).collect()}
    for g in ("a", "b", None):
        own = sorted((v, k) for h, k, v in rows if h == g)
        for place, (_, k) in enumerate(own):
            assert found[k] == (place, len(own)) if first is None or place < first else found.get(k, (place, len(own))) == (place, len(own))


def test_exact_median_of_groups(scored):
    rows, df = scored
    found = {r["g"]: r["median"] for r in sequences.exact_median(df, "v", 0.01, ["g"]).collect()}
    assert found == {g: pytest.approx(statistics.median(v for h, _, v in rows if h == g), abs=1e-12) for g in ("a", "b", None)}
    assert sequences.exact_median(df.where("k < 0"), "v", 0.01).collect()[0]["median"] is None


def test_running_sums_and_steps(spark):
    draw = random.Random(5)
    keys = sorted(draw.sample(range(1000), 80))
    rows = [(k, draw.randrange(9), k * 0.5) for k in keys]
    df = spark.createDataFrame(rows, "k long, n long, t double")
    found = {r["k"]: r["n"] for r in sequences.running(df, F.floor(F.col("k") / 50), "k", ["n"]).collect()}
    assert found == {k: sum(n for j, n, _ in rows if j <= k) for k in keys}
    steps = sorted(r["step"] for r in sequences.steps(df, "t", 20.0).where("step IS NOT NULL").collect())
    assert steps == pytest.approx(sorted((b - a) * 0.5 for a, b in zip(keys, keys[1:], strict=False)))


def test_blocks_with_guests_see_all_that_follows(spark):
    from pyspark.sql import Window

    df = spark.range(95).select(F.col("id").alias("place"))
    w = Window.partitionBy("block").orderBy("place").rowsBetween(0, 4)
    found = {r["place"]: (r["total"], r["c"]) for r in sequences.overlapped(df, "place", 10, 3).select("place", "own", F.sum("place").over(w).alias("total"), F.count("*").over(w).alias("c")).where("own").collect()}
    assert found == {p: (sum(range(p, min(p + 5, 95))), min(5, 95 - p)) for p in range(95)}


def test_samples_are_the_least_draws(scored):
    import hashlib

    rows, df = scored
    draw = lambda g, k: hashlib.md5("|".join(str(x) for x in (sampling.SEED, g, k) if x is not None).encode()).hexdigest()
    for frame in (df, df.repartition(7)):
        found = {(r["g"], r["k"]) for r in sampling.reservoir(frame, "g", ["k"], 40).collect()}
        assert found == {(g, k) for g in ("a", "b", None) for _, k in sorted((draw(g, k), k) for h, k, _ in rows if h == g)[:40]}


def test_slopes_need_rows_and_variance(spark):
    few = spark.createDataFrame([(float(k), float(k)) for k in range(9)], "y double, x double")
    flat = spark.createDataFrame([(float(k), 1.0) for k in range(20)], "y double, x double")
    for df in (few, flat):
        with pytest.raises(Exception, match="slope"):
            metrics.slope_interval(df, "y", "x").collect()


def test_an_empty_denominator_is_an_error(spark):
    with pytest.raises(ValueError, match="processed"):
        gates.not_empty(spark.range(0), "processed frames")


def test_joint_commits_survive_a_crash(spark, tmp_path, monkeypatch):
    base = f"file://{tmp_path}"

    def put(name, value):
        spark.createDataFrame([(value,)], "v string").write.mode("overwrite").parquet(f"{base}/{name}")

    def get(name):
        return spark.read.parquet(f"{base}/{name}").first()["v"]

    moves = {f"{base}/s1": f"{base}/t1", f"{base}/s2": f"{base}/t2"}
    put("t1", "old"), put("t2", "old"), put("s1", "new"), put("s2", "new")
    whole, done = contracts._replace, []

    def failing(s, source, target):
        if not target.endswith(".journal"):
            if done:
                raise RuntimeError("crash")
            done.append(target)
        whole(s, source, target)

    monkeypatch.setattr(contracts, "_replace", failing)
    with pytest.raises(RuntimeError):
        contracts.commit_together(spark, moves)
    assert (get("t1"), get("t2")) == ("new", "old")
    monkeypatch.setattr(contracts, "_replace", whole)
    contracts.commit_together(spark, moves)
    assert (get("t1"), get("t2")) == ("new", "new") and not contracts.exists(spark, f"{base}/t1.journal")
    with pytest.raises(contracts.ContractError):
        contracts.commit_together(spark, {f"{base}/none": f"{base}/t1"})


def test_what_was_moved_aside_comes_back(spark, tmp_path):
    path = f"file://{tmp_path}/note.txt"
    contracts.write_text(spark, path, "first")
    (tmp_path / "note.txt").rename(tmp_path / ("note.txt" + contracts.ASIDE))
    contracts.recover(spark, path)
    assert (tmp_path / "note.txt").read_text() == "first"
    with pytest.raises(contracts.ContractError, match="missing"):
        contracts.require_input(spark, f"file://{tmp_path}/nothing")


def test_vanishing_point_of_noisy_lines(spark):
    draw = np.random.default_rng(1)
    rows = []
    for k in range(400):
        angle = draw.uniform(0, np.pi)
        a, b = np.cos(angle), np.sin(angle)
        through = (640.0, -220.0) if k % 4 else tuple(draw.uniform(-3000, 3000, 2))
        rows.append((k, float(a), float(b), float(-(a * through[0] + b * through[1]) + draw.normal(0, 2))))
    lines = spark.createDataFrame(rows, "k long, a double, b double, c double")
    found = estimators.vanishing_point(lines, "k")
    assert found["accepted"] and found["x"] == pytest.approx(640, abs=3) and found["y"] == pytest.approx(-220, abs=3)
    assert 290 <= found["inliers"] <= 330 and 0.5 < found["residual"] < 3 and found["deviation"] < 30
    assert not estimators.vanishing_point(lines.where("k < 0"), "k")["accepted"]
    far = estimators.vanishing_point(lines, "k", guard=0.0)
    assert not far["accepted"] and far["x"] == found["x"]
