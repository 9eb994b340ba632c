"""Frames by index, the table function, and PNG files read back by a reader of the test's own."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, StringContains

from kerbside.functions import tables
from kerbside.operators import png
from kerbside.sources import frames


def content(k):
    return bytes([k % 251]) * (60 + k % 7)


@pytest.fixture(scope="module")
def container(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("frames") / "c")
    rows = [(k, 4 + k % 3, 5, content(k)) for k in range(400)]
    frames.write_frames(spark.createDataFrame(rows, frames.SCHEMA).repartitionByRange(8, "frame_idx"), path)
    return path


def asked(path, *filters):
    """Frames and bytes that a reader with these filters reads, in this process."""
    reader, read = frames.FilteredReader(path), []
    inner = reader.fetch
    reader.fetch = lambda f, place, size: (read.append(size), inner(f, place, size))[1]
    rest = list(reader.pushFilters(list(filters)))
    parts = reader.partitions()
    found = sorted(k for p in parts for b in reader.read(p) for k in b.column("frame_idx").to_pylist())
    return found, sum(read), len(parts), rest


def test_bytes_read_grow_with_the_frames_asked_for(container):
    key = ("frame_idx",)
    for filters, want, parts in (
        ([], range(400), 8), ([EqualTo(key, 17)], [17], 1), ([In(key, (3, 390, 9999))], [3, 390], 2), ([GreaterThan(key, 9), LessThanOrEqual(key, 14)], range(10, 15), 1),
        ([EqualTo(key, 5), EqualTo(key, 6)], [], 0), ([GreaterThan(key, 1000)], [], 0), ([In(key, (50, 60)), GreaterThan(key, 55)], [60], 1),
    ):
        found, size, n, rest = asked(container, *filters)
        assert found == list(want) and size == sum(len(content(k)) for k in want) and n == parts and not rest
    *_, rest = asked(container, StringContains(("content",), "x"), EqualTo(("width",), 4))
    assert len(rest) == 2


def test_frames_come_back_through_spark(spark, container):
    found = {r["frame_idx"]: (r["width"], r["height"], bytes(r["content"])) for r in frames.read_frames(spark, container, low=100, high=120).collect()}
    assert found == {k: (4 + k % 3, 5, content(k)) for k in range(100, 121)}
    chosen = frames.read_frames(spark, container, listed=[5, 250, 9999])
    assert sorted(r["frame_idx"] for r in chosen.where("width > 0").collect()) == [5, 250] and chosen.rdd.getNumPartitions() == 2
    assert frames.read_frames(spark, container, low=10, listed=[]).count() == 0
    df = frames.read_frames(spark, container)
    assert df.where("frame_idx = 7").count() == 1 and df.count() == 400 and df.where(F.col("frame_idx") > 390).count() == 9


def test_a_query_s_filters_are_pushed_where_that_is_on(spark, container):
    spark.conf.set(frames.PUSHDOWN, "true")
    try:
        df = frames.read_frames(spark, container, pushed=True).where(F.col("frame_idx").isin(5, 250)).where("width > 0")
        assert sorted(r["frame_idx"] for r in df.collect()) == [5, 250] and df.rdd.getNumPartitions() == 2
    finally:
        spark.conf.unset(frames.PUSHDOWN)


def test_damaged_and_empty_containers(spark, tmp_path):
    empty = str(tmp_path / "empty")
    frames.write_frames(spark.createDataFrame([], frames.SCHEMA), empty)
    assert frames.read_frames(spark, empty).collect() == []
    path = str(tmp_path / "cut")
    frames.write_frames(spark.createDataFrame([(1, 1, 1, b"abc" * 50)], frames.SCHEMA).coalesce(1), path)
    for name in tmp_path.glob("cut/*.frames"):
        if name.stat().st_size:
            name.write_bytes(name.read_bytes()[:-1])
    with pytest.raises(Exception, match="ends within a frame"):
        frames.read_frames(spark, path).collect()


@pytest.mark.parametrize("step", [1, 3])
def test_sampled_frames_from_sql(spark, step):
    draw = random.Random(1)
    rows = [(r, f, f / 30 + r) for r in range(5) for f in sorted(draw.sample(range(1000), 40))]
    draw.shuffle(rows)
    spark.createDataFrame(rows, "recording int, frame_idx long, ts double").repartition(3).createOrReplaceTempView("taken_frames")
    tables.register(spark)
    found = {(r["recording"], r["frame_idx"]): (r["place"], r["since"]) for r in spark.sql(f"SELECT * FROM sampled_frames(TABLE(taken_frames), {step})").collect()}
    want = {}
    for r in range(5):
        own = sorted((f, t) for q, f, t in rows if q == r)[::step]
        want |= {(r, f): (k, t - own[k - 1][1] if k else None) for k, (f, t) in enumerate(own)}
    assert found == want
    for bad in ("sampled_frames(TABLE(taken_frames), 0)", "sampled_frames(TABLE(SELECT 1 AS a), 2)"):
        with pytest.raises(Exception, match="sampled_frames takes"):
            spark.sql(f"SELECT * FROM {bad}").collect()


def decoded(data):
    """Pixels of a PNG of 8-bit RGB: chunks with their checksums, then one byte at a time by the specification."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, held = 8, []
    while at < len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
        held.append((kind, body))
        at += 12 + n
    assert [k for k, _ in held] == [b"IHDR", b"IDAT", b"IEND"]
    w, h, *rest = struct.unpack(">IIBBBBB", held[0][1])
    assert rest == [8, 2, 0, 0, 0]
    raw, out = zlib.decompress(held[1][1]), []
    for y in range(h):
        way, line = raw[y * (3 * w + 1)], bytearray(raw[y * (3 * w + 1) + 1 : (y + 1) * (3 * w + 1)])
        above = out[-1] if out else bytearray(3 * w)
        for k in range(3 * w):
            a, b, c = (line[k - 3] if k >= 3 else 0), above[k], (above[k - 3] if k >= 3 else 0)
            p = a + b - c
            nearest = min((abs(p - v), i, v) for i, v in enumerate((a, b, c)))[2]
            line[k] = (line[k] + (0, a, b, (a + b) // 2, nearest)[way]) & 255
        out.append(line)
    return np.frombuffer(b"".join(map(bytes, out)), np.uint8).reshape(h, w, 3)


def test_encoded_images_are_hidden_and_read_back(spark):
    rng = np.random.default_rng(0)
    shapes = [(40, 30), (1, 1), (17, 64)]
    made = [np.minimum(255, np.add.outer(np.arange(h) * 3, np.arange(w) * 2)[:, :, None] // 2 + rng.integers(0, 40, (h, w, 3))).astype(np.uint8) for h, w in shapes]
    rows = [(k, m.shape[1], m.shape[0], m.tobytes()) for k, m in enumerate(made)] + [(9, 3, 3, None)]
    df = png.encode_images(spark.createDataFrame(rows, "image_id long, width int, height int, content binary"))
    found = {r["image_id"]: r for r in df.select("*", png.data_uri(F.col("png")).alias("uri")).collect()}
    assert found[9]["png"] is None and found[9]["uri"] is None
    for k, m in enumerate(made):
        shown = decoded(bytes(found[k]["png"]))[:, :, ::-1]
        top = max(1, round(m.shape[0] * 0.3))
        assert shown.shape == m.shape and (shown[top:] == m[top:]).all()
        assert m.shape == (1, 1, 3) or (shown[:top] != m[:top]).any()
    back = spark.createDataFrame([(found[0]["uri"],)], "html string").select(F.unbase64(F.regexp_extract("html", "data:image/[a-z]+;base64,([A-Za-z0-9+/]+=*)", 1)).alias("b")).first()["b"]
    assert bytes(back) == bytes(found[0]["png"])
    with pytest.raises(ValueError, match="three channels"):
        png.encoded(np.zeros((3, 3), np.uint8))
