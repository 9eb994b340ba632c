"""The run manifest on disk: one JSON document, a section a stage, that survives killed runs and damage.

It is written like any other small file, whole or not at all. A manifest that cannot be read is moved aside, never overwritten, as it holds
the provenance of all other stages; the new one says where it went.
"""

from __future__ import annotations

import hashlib
import json
import platform
from collections.abc import Callable

import pyspark
from pyspark.sql import DataFrame, SparkSession

from .contracts import VERSION, _path, exists, recover, write_text

UNREADABLE = ".unreadable"


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest at ``path``; None where there is none, ValueError where there is something else."""
    recover(spark, path)
    if not exists(spark, path):
        return None
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        document = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    if not isinstance(document, dict) or not isinstance(document.get("stages"), dict):
        raise ValueError(f"{path} is no manifest")
    return document


class StageRun:
    """One run of a stage, from ``start`` to ``finish``, in the manifest at ``path``. Other stages' sections stay as they are.

    A section that still says ``running`` when its stage starts is of a killed run: it joins ``aborted_runs``.
    """

    def __init__(self, spark: SparkSession, path: str, stage: str, config: dict, now: Callable[[], str]):
        if not stage:
            raise ValueError("a run has a stage")
        self.spark, self.path, self.stage, self.config, self.now = spark, path, stage, config, now
        self.section: dict | None = None

    def start(self, models: dict[str, str] | None = None) -> None:
        """Open the section; ``models`` are digests of weights by name, if the stage has any."""
        document = self._document()
        before = document["stages"].get(self.stage)
        if before and before.get("status") == "running":
            document.setdefault("aborted_runs", []).append({"stage": self.stage, "started_at": before.get("started_at"), "detected_at": self.now()})
        text = json.dumps(self.config, sort_keys=True)
        self.section = {
            "stage": self.stage, "started_at": self.now(), "finished_at": None, "status": "running", "config_sha256": hashlib.sha256(text.encode()).hexdigest(),
            "models": models or {}, "libraries": {"pyspark": pyspark.__version__, "python": platform.python_version()}, "notes": {},
        }
        self._write(document)

    def note(self, key: str, value) -> None:
        """A figure that the stage states: counts, shares, throughput."""
        self._begun()["notes"][key] = value

    def finish(self, status: str = "ok", error: str | None = None) -> None:
        self._begun().update(status=status, finished_at=self.now(), **({"error": error} if error else {}))
        self._write(self._document())

    def _begun(self) -> dict:
        if self.section is None:
            raise RuntimeError("the run was not started")
        return self.section

    def _document(self) -> dict:
        fresh = {"schema_version": VERSION, "stages": {}}
        try:
            return read_manifest(self.spark, self.path) or fresh
        except ValueError:
            k, keep = 0, self.path + UNREADABLE
            while exists(self.spark, keep):
                k += 1
                keep = f"{self.path}{UNREADABLE}.{k}"
            (source, fs), (target, _) = _path(self.spark, self.path), _path(self.spark, keep)
            if not fs.rename(source, target):
                raise OSError(f"{self.path} is unreadable and could not be moved aside") from None
            return {**fresh, "previous_manifest_unreadable": True, "previous_manifest_saved_to": keep}

    def _write(self, document: dict) -> None:
        document["schema_version"] = VERSION
        document["stages"][self.stage] = self.section
        write_text(self.spark, self.path, json.dumps(document, sort_keys=True))


def stage_table(spark: SparkSession, path: str) -> DataFrame:
    """(stage, status, started_at, finished_at, error, config_sha256, notes) of a manifest, notes as JSON by name."""
    stages = (read_manifest(spark, path) or {"stages": {}})["stages"]
    rows = [(k, v["status"], v["started_at"], v["finished_at"], v.get("error"), v["config_sha256"], {n: json.dumps(x) for n, x in v["notes"].items()}) for k, v in sorted(stages.items())]
    return spark.createDataFrame(rows, "stage string, status string, started_at string, finished_at string, error string, config_sha256 string, notes map<string,string>")
