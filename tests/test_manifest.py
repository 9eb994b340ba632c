"""The run manifest on disk: starts, ends, killed runs and damage; metric rows that must say how they came about."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from kerbside.plans import report
from kerbside.sources import manifest


def run(spark, path, stage="s3_detect", at="t0"):
    return manifest.StageRun(spark, path, stage, {"a": 1}, lambda: at)


def test_start_and_finish_are_recorded(spark, tmp_path):
    path = str(tmp_path / "run.json")
    m = run(spark, path)
    with pytest.raises(RuntimeError):
        m.note("n", 1)
    m.start({"weights": "abc"})
    held = json.load(open(path))["stages"]["s3_detect"]
    assert held["status"] == "running" and held["models"] == {"weights": "abc"} and held["config_sha256"] and held["libraries"]["pyspark"]
    m.note("throughput_fps", 16.6)
    m.finish()
    held = json.load(open(path))["stages"]["s3_detect"]
    assert (held["status"], held["finished_at"], held["notes"]) == ("ok", "t0", {"throughput_fps": 16.6})
    assert not glob.glob(f"{path}*tmp*") and [r["status"] for r in manifest.stage_table(spark, path).collect()] == ["ok"]


def test_killed_runs_are_aborted_and_other_stages_stay(spark, tmp_path):
    path = str(tmp_path / "run.json")
    done = run(spark, path, "s1_calib")
    done.start()
    done.finish()
    run(spark, path, at="t1").start()
    again = run(spark, path, at="t2")
    again.start()
    document = manifest.read_manifest(spark, path)
    assert document["aborted_runs"] == [{"stage": "s3_detect", "started_at": "t1", "detected_at": "t2"}]
    assert document["stages"]["s1_calib"]["status"] == "ok" and document["stages"]["s3_detect"]["status"] == "running"
    again.finish("failed", "no input")
    assert manifest.stage_table(spark, path).where("stage = 's3_detect'").first()["error"] == "no input"


@pytest.mark.parametrize("text", ["{", "[]", '{"stages": 3}', ""])
def test_damaged_manifests_are_set_aside(spark, tmp_path, text):
    path = str(tmp_path / "run.json")
    for k in range(2):
        open(path, "w").write(text + " " * k)
        for crc in glob.glob(str(tmp_path / ".*.crc")):
            __import__("os").unlink(crc)
        m = run(spark, path)
        m.start()
        document = manifest.read_manifest(spark, path)
        assert document["previous_manifest_unreadable"] and open(document["previous_manifest_saved_to"]).read() == text + " " * k
    assert len(glob.glob(f"{path}.unreadable*")) == 2


def test_no_manifest_and_no_stage(spark, tmp_path):
    assert manifest.read_manifest(spark, str(tmp_path / "none.json")) is None
    assert manifest.stage_table(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(ValueError, match="stage"):
        run(spark, "x", "")


def test_figures_say_how_they_came_about(spark):
    rows = spark.range(1).select(F.inline(F.array(
        report.envelope("a", F.lit(0.5), "share", F.lit(4), "events", F.lit("M1"), F.lit(0.1), F.lit(0.9)), report.envelope("b", F.lit(None).cast("double"), "s", F.lit(0), "tracks"),
    )))
    one = spark.range(1).select(F.lit(0.25).alias("low_confidence"))
    full = {r["metric"]: r for r in report.provenance(rows, {"a": report.zone_metrics, "b": report.html}, "calibrated", one, one, {"a": ["few"]}).collect()}
    a, b = full["a"], full["b"]
    assert (a["ci_method"], a["calibration_status"], a["source_stage"], a["source_artifact"], a["caveats"]) == ("wilson_by_track", "calibrated", "s6_attn", "events", ["few"])
    assert a["compute_ref"]["file"] == "plans/report.py" and a["compute_ref"]["function"] == "zone_metrics" and a["compute_ref"]["line"] > 1
    assert a["quality"] == a["coverage"] == {"low_confidence": 0.25}
    assert (b["ci_method"], b["value"], b["measured"], b["reason"], b["caveats"], b["source_stage"]) == ("none", None, False, "nothing to measure", [], "s4_track")
    with pytest.raises(Exception, match="nothing is said to compute b"):
        report.provenance(rows, {"a": report.html}, "calibrated", one, one, {}).collect()
    with pytest.raises(Exception, match="no value and no reason"):
        report.provenance(rows.withColumn("reason", F.lit(None).cast("string")), {"a": report.html, "b": report.html}, "calibrated", one, one, {}).collect()
