"""Table contracts: fixed schemas with units, checked writes, provenance beside the data.

Spark's Parquet writer has no footer of its own for a dataset, so a contract's version, status and inputs go to a small JSON file in
the dataset's folder, written through Hadoop's file system like the data.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "1"
SIDECAR = "_contract.json"
_TYPES = {
    "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(), "float32": T.FloatType(), "float64": T.DoubleType(),
    "string": T.StringType(), "bool": T.BooleanType(),
}


@dataclass(frozen=True)
class Column:
    """A column of a contract: type, whether it may be null, unit and coordinate frame."""

    name: str
    dtype: str
    nullable: bool = False
    unit: str = "-"
    frame: str = "-"


def schema_of(columns: list[Column]) -> T.StructType:
    unknown = [c.dtype for c in columns if c.dtype not in _TYPES]
    if unknown:
        raise ValueError(f"unknown types: {unknown}")
    return T.StructType([T.StructField(c.name, _TYPES[c.dtype], c.nullable, {"unit": c.unit, "frame": c.frame}) for c in columns])


# The tables' columns.
FRAMES = [Column("frame_idx", "int64"), Column("ts", "float64", unit="s"), Column("det_id", "int32"), *(Column(f"{c}_px", "float32", unit="px", frame="image") for c in ("x1", "y1", "x2", "y2")), Column("conf", "float32"), Column("cls", "int16")]
FRAMES_INDEX = [Column("frame_idx", "int64"), Column("ts", "float64", unit="s"), Column("processed", "bool"), Column("n_detections", "int32", True), Column("skip_reason", "string", True)]
TRACKS = [
    Column("track_id", "int32"), Column("frame_idx", "int64"), Column("ts", "float64", unit="s"), Column("foot_x_px", "float32", unit="px", frame="image"), Column("foot_y_px", "float32", unit="px", frame="image"),
    Column("foot_x_m", "float32", True, "m", "ground"), Column("foot_y_m", "float32", True, "m", "ground"), Column("foot_source", "string"), Column("pos_conf", "float32", True), Column("speed_mps", "float32", True, "m/s", "ground"),
]
ORIENT = [
    Column("track_id", "int32"), Column("frame_idx", "int64"), Column("ts", "float64", unit="s"), Column("body_yaw_deg", "float32", True, "deg", "ground"), Column("head_yaw_deg", "float32", True, "deg", "ground"), Column("yaw_conf", "float32", True),
    Column("n_kpts_valid", "int8"), Column("foot_x_m_refined", "float32", True, "m", "ground"), Column("foot_y_m_refined", "float32", True, "m", "ground"), Column("foot_refined_source", "string", True),
]
EVENTS = [Column("event_id", "string"), Column("track_id", "int32"), Column("zone_id", "string"), Column("t_start", "float64", unit="s"), Column("t_end", "float64", unit="s"), Column("stop_score", "float32", True), Column("gaze_score", "float32", True), Column("event_type", "string"), Column("low_confidence", "bool")]
EVIDENCE = [
    Column("claim_id", "string"), Column("track_id", "int64"), Column("frame_idx", "int64"), Column("ts", "float64"), Column("value", "float64"), Column("confidence", "float64"), Column("path", "string"), Column("stage", "string"), Column("model_name", "string"),
    Column("extra_json", "string"), Column("stratum", "int8"), Column("schema_version", "string"),
]


#: What a file or dataset that is being replaced is called meanwhile.
ASIDE = ".aside"


class ContractError(ValueError):
    """Data that a contract does not admit."""


def conform(df: DataFrame, columns: list[Column]) -> DataFrame:
    """The contract's columns in its order and types; NaN becomes null; a null where none may be fails the job that meets it."""
    names = [c.name for c in columns]
    if extra := set(df.columns) - set(names):
        raise ContractError(f"columns beyond the contract: {sorted(extra)}")
    if missing := set(names) - set(df.columns):
        raise ContractError(f"columns missing: {sorted(missing)}")
    out = []
    for c in columns:
        value = F.col(c.name)
        if dict(df.dtypes)[c.name] in ("float", "double"):
            value = F.when(~F.isnan(value), value)
        if not c.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"null in {c.name}")))
        out.append(value.cast(_TYPES[c.dtype]).alias(c.name, metadata={"unit": c.unit, "frame": c.frame}))
    return df.select(*out)


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and put it in place by renaming, on whatever file system the path names.

    The old file is moved aside until the new one is in place; ``recover`` brings it back if a crash came between.
    """
    p, fs = _path(spark, path)
    tmp = p.suffix(".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    _replace(spark, str(tmp.toString()), path)


def recover(spark: SparkSession, path: str) -> None:
    """Put back what a crash left moved aside."""
    (p, fs), (old, _) = _path(spark, path), _path(spark, path + ASIDE)
    if fs.exists(old):
        if fs.exists(p):
            fs.delete(old, True)
        else:
            fs.rename(old, p)


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` to ``target``; what was there stays aside until that is done."""
    recover(spark, target)
    (s, fs), (t, _), (old, _) = _path(spark, source), _path(spark, target), _path(spark, target + ASIDE)
    if fs.exists(t):
        fs.rename(t, old)
    if not fs.rename(s, t):
        raise OSError(f"{source} could not be moved to {target}")
    fs.delete(old, True)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def read_sidecar(spark: SparkSession, path: str) -> dict:
    """A dataset's contract file; status ``unknown`` where there is none that can be read."""
    name = f"{path}/{SIDECAR}"
    if not exists(spark, name):
        return {"status": "unknown"}
    p, fs = _path(spark, name)
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:
        return {"status": "unknown"}
    finally:
        stream.close()


def write_contract(df: DataFrame, columns: list[Column], path: str, stage: str, inputs: dict[str, str] | None = None, status: str = "ok") -> None:
    """Write a table by its contract, and beside it version, stage, status and the inputs' digests."""
    conform(df, columns).write.mode("overwrite").parquet(path)
    note = {"schema_version": VERSION, "stage": stage, "status": status, "inputs_sha256": inputs or {}, "frames": sorted({c.frame for c in columns})}
    write_text(df.sparkSession, f"{path}/{SIDECAR}", json.dumps(note, sort_keys=True))


def write_skeleton(spark: SparkSession, columns: list[Column], path: str, stage: str) -> None:
    """An empty table of the contract that nobody may consume."""
    empty = spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType, True) for f in schema_of(columns)]))
    write_contract(empty, columns, path, stage, status="skeleton")


def read_contract(spark: SparkSession, columns: list[Column], path: str) -> DataFrame:
    """A table with its contract's schema; skeletons are refused."""
    if read_sidecar(spark, path).get("status") == "skeleton":
        raise ContractError(f"{path} is a skeleton")
    return spark.read.schema(schema_of(columns)).parquet(path)


def read_optional(spark: SparkSession, columns: list[Column], path: str) -> DataFrame | None:
    """A table, or None where there is none: its feature is then off."""
    return read_contract(spark, columns, path) if exists(spark, path) else None


def digest(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order: from the sum of their hashes."""
    total = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(F.sum("h").alias("h"), F.count("*").alias("n")).first()
    return hashlib.sha256(f"{total['h']}:{total['n']}".encode()).hexdigest()


def check_inputs(spark: SparkSession, path: str, current: dict[str, str]) -> list[str]:
    """What is wrong with a dataset's recorded inputs: none recorded, missing, or changed."""
    recorded = read_sidecar(spark, path).get("inputs_sha256") or {}
    if not recorded:
        return ["no inputs recorded"]
    return [f"{k}: {'missing' if k not in current else 'changed'}" for k, v in sorted(recorded.items()) if current.get(k) != v]


def commit_together(spark: SparkSession, staged: dict[str, str]) -> None:
    """Move staged datasets to their places once all are written: all of them, or after a crash, at the next call, the rest.

    A journal beside the first target names the moves from before the first to after the last, and is carried out first.
    """
    journal = next(iter(staged.values())) + ".journal"
    if exists(spark, journal):
        (p, fs) = _path(spark, journal)
        stream = fs.open(p)
        try:
            moves = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        _move(spark, moves, journal)
        staged = {k: v for k, v in staged.items() if exists(spark, k) or k not in moves}
    for source in staged:
        if not exists(spark, source):
            raise ContractError(f"{source} was not written")
    write_text(spark, journal, json.dumps(staged))
    _move(spark, staged, journal)


def _move(spark: SparkSession, moves: dict[str, str], journal: str) -> None:
    for source, target in moves.items():
        if exists(spark, source):
            _replace(spark, source, target)
        else:
            recover(spark, target)
    p, fs = _path(spark, journal)
    fs.delete(p, False)


def input_status(spark: SparkSession, path: str) -> str:
    """``missing``, or the status that the input's contract file gives; only ``ok`` may be consumed."""
    recover(spark, path)
    return read_sidecar(spark, path)["status"] if exists(spark, path) else "missing"


def require_input(spark: SparkSession, path: str) -> None:
    """An error unless an input is there and whole."""
    if (status := input_status(spark, path)) != "ok":
        raise ContractError(f"{path} is {status}")


def upsert_owned(index: DataFrame, own: DataFrame, stage: str, present: DataFrame) -> DataFrame:
    """An index with a stage's rows replaced: others' rows stay if their file is still there, the stage's own are appended."""
    others = index.where(F.col("stage") != stage).join(present, "path", "left_semi").select(index.columns)
    return others.unionByName(own)


class Manifest:
    """A run's log, one section a stage; a stage found running when it starts again was aborted."""

    def __init__(self, sections: dict[str, dict] | None = None):
        self.sections = sections or {}

    def start(self, stage: str, config: str, at: str) -> None:
        before = self.sections.get(stage)
        past = [*(before or {}).get("past", []), *([{**before, "past": [], "status": "aborted"}] if before and before["status"] == "running" else [])]
        self.sections[stage] = {"status": "running", "started": at, "config_sha256": hashlib.sha256(config.encode()).hexdigest(), "past": past, "notes": []}

    def note(self, stage: str, text: str) -> None:
        self.sections[stage]["notes"].append(text)

    def finish(self, stage: str, at: str, error: str | None = None) -> None:
        self.sections[stage] |= {"status": "failed" if error else "ok", "finished": at, **({"error": error} if error else {})}
