"""Frames by index: an indexed container of raw frames, and a Spark data source that reads only the frames asked for.

A container is a folder of parts. A part is a file of raw frames one after another, and beside it a Parquet index with each frame's number, place
and size; a list of the parts with their least and largest frame, written last, makes the container whole. What is asked of ``frame_idx`` reaches
the source: parts out of range are no partitions, and of the others only the wanted byte ranges are read. Files go
through pyarrow's file systems, so a path may be local or a URI; it must be one that all executors share.

A selection is an option of the source. With ``pushed`` a query's filters are taken too, which needs PUSHDOWN in the session; but Spark 4.1 keeps the
filters of the first plan with a loaded source, so that a DataFrame used again with other filters then misses rows: load it for each query.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

FORMAT = "indexed_frames"
PARTS = "_parts.json"
SCHEMA = "frame_idx long, width int, height int, content binary"
#: Setting by which Spark offers a query's filters to Python sources.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Frames of a batch that leaves the reader.
AT_ONCE = 64


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Wanted:
    """What a query asks of the frames' numbers: bounds, and a list if there is one."""

    low: int | None = None
    high: int | None = None
    listed: frozenset[int] | None = None

    def taking(self, f: Filter) -> Wanted | None:
        """With one more filter; None for one that is not understood."""
        if getattr(f, "attribute", None) != ("frame_idx",):
            return None
        if isinstance(f, In) or isinstance(f, EqualTo):
            own = frozenset(int(v) for v in (f.value if isinstance(f, In) else [f.value]) if v is not None)
            return Wanted(self.low, self.high, own if self.listed is None else self.listed & own)
        shift = {GreaterThan: (1, True), GreaterThanOrEqual: (0, True), LessThan: (-1, False), LessThanOrEqual: (0, False)}.get(type(f))
        if shift is None or not isinstance(f.value, int):
            return None
        bound = f.value + shift[0]
        if shift[1]:
            return Wanted(bound if self.low is None else max(self.low, bound), self.high, self.listed)
        return Wanted(self.low, bound if self.high is None else min(self.high, bound), self.listed)

    def holds(self, frame: int) -> bool:
        return (self.low is None or frame >= self.low) and (self.high is None or frame <= self.high) and (self.listed is None or frame in self.listed)

    def meets(self, least: int, most: int) -> bool:
        """Whether any frame from ``least`` to ``most`` may be wanted."""
        if self.listed is not None:
            return any(least <= k <= most and self.holds(k) for k in self.listed)
        return (self.low is None or most >= self.low) and (self.high is None or least <= self.high)


@dataclass
class Part(InputPartition):
    name: str


class FrameReader(DataSourceReader):
    def __init__(self, path: str, wanted: Wanted = Wanted()):
        self.path, self.wanted = path, wanted

    def partitions(self) -> list[Part]:
        files, path = _opened(self.path)
        with files.open_input_stream(f"{path}/{PARTS}") as f:
            parts = json.loads(f.read())
        return [Part(p["name"]) for p in parts if self.wanted.meets(p["least"], p["most"])]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's one task where there are no partitions
            return
        files, path = _opened(self.path)
        index = pq.read_table(f"{path}/{partition.name}.index", filesystem=files).to_pylist()
        rows = sorted((r for r in index if self.wanted.holds(r["frame_idx"])), key=lambda r: r["place"])
        schema = pa.schema([("frame_idx", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("content", pa.binary())])
        if not rows:
            return
        with files.open_input_file(f"{path}/{partition.name}.frames") as f:
            for k in range(0, len(rows), AT_ONCE):
                own = rows[k : k + AT_ONCE]
                content = [self.fetch(f, r["place"], r["size"]) for r in own]
                columns = [[r[c] for r in own] for c in ("frame_idx", "width", "height")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*columns, content], schema.types, strict=True)], schema=schema)

    def fetch(self, file: pa.NativeFile, place: int, size: int) -> bytes:
        """One frame's bytes; all that is read of a part's frames goes through here."""
        found = file.read_at(size, place)
        if len(found) != size:
            raise OSError(f"a part ends within a frame: {len(found)} of {size} bytes at {place}")
        return found


class FilteredReader(FrameReader):
    """A reader that also takes a query's filters."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            more = self.wanted.taking(f)
            if more is None:
                yield f
            else:
                self.wanted = more


@dataclass
class Written(WriterCommitMessage):
    name: str
    least: int
    most: int


class FrameWriter(DataSourceArrowWriter):
    """A part a task, under a name of its own, so that a task that runs again leaves no half of another's."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, path = _opened(self.path)
        files.create_dir(path, recursive=True)
        name, place, index = f"part-{uuid.uuid4().hex}", 0, []
        with files.open_output_stream(f"{path}/{name}.frames") as out:
            for batch in iterator:
                for frame, width, height, content in zip(*(batch.column(c).to_pylist() for c in ("frame_idx", "width", "height", "content")), strict=True):
                    out.write(content)
                    index.append((frame, width, height, place, len(content)))
                    place += len(content)
        names = ("frame_idx", "width", "height", "place", "size")
        columns = list(zip(*index, strict=True)) if index else [()] * len(names)
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        pq.write_table(pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)}), f"{path}/{name}.index", filesystem=files)
        return Written(name, min(columns[0], default=0), max(columns[0], default=-1))

    def commit(self, messages: list[Written | None]) -> None:
        files, path = _opened(self.path)
        parts = [{"name": m.name, "least": m.least, "most": m.most} for m in messages if m is not None and m.least <= m.most]
        with files.open_output_stream(f"{path}/{PARTS}.tmp") as out:
            out.write(json.dumps(parts).encode())
        files.move(f"{path}/{PARTS}.tmp", f"{path}/{PARTS}")

    def abort(self, messages: list[Written | None]) -> None:
        """Without a list of parts there is no container; what tasks left is not looked at."""


class IndexedFrames(DataSource):
    """``path``: the container's folder; ``low``, ``high`` and ``listed`` (a JSON list): the frames to read, if not all; ``pushed``: take filters too."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameReader:
        bound = lambda name: int(self.options[name]) if name in self.options else None
        listed = frozenset(json.loads(self.options["listed"])) if "listed" in self.options else None
        kind = FilteredReader if self.options.get("pushed") == "true" else FrameReader
        return kind(self.options["path"], Wanted(bound("low"), bound("high"), listed))

    def writer(self, schema, overwrite: bool) -> FrameWriter:
        return FrameWriter(self.options["path"])


def _register(spark: SparkSession) -> None:
    try:
        spark.dataSource.register(IndexedFrames)
    except AnalysisException as error:  # a session made from one that knows the source has it already
        if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise


def write_frames(frames: DataFrame, path: str) -> None:
    """Write (frame_idx, width, height, content) rows as a container; a part a partition, so frames near each other belong together."""
    _register(frames.sparkSession)
    frames.select("frame_idx", "width", "height", "content").write.format(FORMAT).mode("append").option("path", path).save()


def read_frames(spark: SparkSession, path: str, *, low: int | None = None, high: int | None = None, listed: list[int] | None = None, pushed: bool = False) -> DataFrame:
    """The frames of a container from ``low`` to ``high``, and of ``listed`` numbers only if given; ``pushed`` for a single query's filters."""
    _register(spark)
    wanted = {"low": low, "high": high, "listed": None if listed is None else json.dumps([int(k) for k in listed])}
    if pushed:
        wanted["pushed"] = "true"
    return spark.read.format(FORMAT).options(path=path, **{k: str(v) for k, v in wanted.items() if v is not None}).load()
