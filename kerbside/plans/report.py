"""Metric rows with their provenance, and a plain report of them."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from html import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as Me
from .attention import gaze_counts

FIELDS = "metric string, zone_id string, value double, unit string, ci95_low double, ci95_high double, n long, measured boolean, source string, reason string"


def envelope(metric: str, value: Column, unit: str, n: Column, source: str, zone: Column | None = None, low: Column | None = None, high: Column | None = None) -> Column:
    """A metric as a struct: a null value is an unmeasured one, and says so."""
    none = F.lit(None)
    return F.struct(
        F.lit(metric).alias("metric"), (zone if zone is not None else none).cast("string").alias("zone_id"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
        (low if low is not None else none).cast("double").alias("ci95_low"), (high if high is not None else none).cast("double").alias("ci95_high"), n.cast("long").alias("n"),
        value.isNotNull().alias("measured"), F.lit(source).alias("source"), F.when(value.isNull(), "nothing to measure").alias("reason"),
    )


def zone_metrics(rates: DataFrame) -> DataFrame:
    """Long table of the metrics in a table of zone rates."""
    z, n = F.col("zone_id"), F.col("visitors")
    rows = F.array(
        envelope("visitors", n, "tracks", n, "events", z),
        envelope("stop_rate", F.col("stop_rate"), "share", F.col("stoppers"), "events", z, F.col("stop_low"), F.col("stop_high")),
        envelope("orientation_rate", F.col("orientation_rate"), "share", F.col("lookers"), "events", z, F.col("orientation_low"), F.col("orientation_high")),
    )
    return rates.select(F.inline(rows))


def zone_seconds(zones: DataFrame, rates: DataFrame, dwell: DataFrame, gaze: DataFrame) -> DataFrame:
    """The median dwell (``dwell``) and the median seconds of counted attention (``seconds``) of every zone, unmeasured where there are none."""
    z = F.col("zone_id")
    known = zones.select("zone_id").join(rates.select("zone_id", "visitors", "lookers"), "zone_id", "left").na.fill(0, ["visitors", "lookers"])
    rows = F.array(
        envelope("gaze_seconds_median", F.col("seconds"), "s", F.col("lookers"), "zone_frames", z),
        envelope("dwell_median", F.col("dwell"), "s", F.col("visitors"), "events", z),
    )
    return known.join(dwell, "zone_id", "left").join(gaze, "zone_id", "left").select(F.inline(rows))


def street_metrics(obs: DataFrame, events: DataFrame, roi: list, threshold: DataFrame, least: float) -> DataFrame:
    """The metrics of the street as a whole: tracks, indirect positions, approaches, turns, and standing anywhere inside ``roi``.

    ``threshold`` is the one row (thr) that episodes stand by, so that no figure has a limit of its own.
    """
    tracks = obs.agg(F.countDistinct("track_id").alias("tracks"), F.count("*").alias("rows"), F.avg((F.col("foot_source") != "ankle").cast("int")).alias("indirect"))
    reached = events.agg(F.countDistinct("track_id").alias("approached"), F.countDistinct(F.when(gaze_counts(), F.col("track_id"))).alias("turned"))
    slow = obs.crossJoin(F.broadcast(threshold))
    standing = Me.valid_steps(slow, roi).agg(F.coalesce(F.sum(F.when(F.col("speed") < F.col("thr"), F.col("dt"))), F.lit(0.0)).alias("seconds"))
    still = Me.stoppers(slow, roi, F.col("thr"), least).agg(F.countDistinct("track_id").alias("stoppers"))
    n = F.col("tracks")
    rows = F.array(
        envelope("unique_tracks_total", n, "tracks", n, "tracks"),
        envelope("indirect_foot_share", F.col("indirect"), "share", F.col("rows"), "tracks"),
        envelope("approached_tracks_total", F.col("approached"), "tracks", n, "events"),
        envelope("turned_tracks_total", F.col("turned"), "tracks", n, "events"),
        envelope("stop_seconds_total", F.col("seconds"), "person-seconds", F.col("rows"), "tracks"),
        envelope("stoppers_total", F.col("stoppers"), "tracks", F.col("stoppers"), "tracks"),
    )
    return tracks.crossJoin(reached).crossJoin(standing).crossJoin(still).select(F.inline(rows))


def html(metrics: DataFrame, title: str) -> str:
    """A page of the metrics. Their number is that of zones, so they are collected."""
    rows = metrics.orderBy("metric", "zone_id").collect()
    cells = "".join(
        f"<tr><td>{escape(r['metric'])}</td><td>{escape(r['zone_id'] or '')}</td><td>{'' if r['value'] is None else format(r['value'], '.4g')}</td><td>{escape(r['unit'])}</td></tr>" for r in rows
    )
    return f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><table><tr><th>metric<th>zone<th>value<th>unit</tr>{cells}</table>"


#: Fields that say how a figure came about, beside those of ``envelope``.
PROVENANCE = "ci_method string, calibration_status string, source_stage string, source_artifact string, compute_ref struct<file:string,function:string,line:int>, quality map<string,double>, coverage map<string,double>, caveats array<string>"
#: The stage that writes each table.
STAGES = {"tracks": "s4_track", "zone_frames": "s6_attn", "events": "s6_attn"}


def compute_ref(function: Callable) -> Column:
    """Where the code of a figure is: file below the package, function and line."""
    lines, first = inspect.getsourcelines(function)
    file = inspect.getsourcefile(function).replace("\\", "/").rsplit("/kerbside/", 1)[-1]
    return F.struct(F.lit(file).alias("file"), F.lit(function.__name__).alias("function"), F.lit(first).cast("int").alias("line"))


def provenance(metrics: DataFrame, functions: dict[str, Callable], calibration: str, quality: DataFrame, coverage: DataFrame, caveats: dict[str, list[str]]) -> DataFrame:
    """Metric rows with PROVENANCE.

    ``functions`` has what computed each metric, and a metric without one is an error. ``quality`` and ``coverage`` are one row of shares
    each, which hold for all figures of the run; ``caveats`` are by metric. A value of null must be unmeasured, with a reason.
    """
    known = F.create_map(*(x for name, f in functions.items() for x in (F.lit(name), compute_ref(f))))
    warned = F.create_map(*(x for name, said in caveats.items() for x in (F.lit(name), F.array(*map(F.lit, said))))) if caveats else F.lit(None).cast("map<string,array<string>>")
    stage = F.create_map(*(F.lit(x) for pair in STAGES.items() for x in pair))[F.col("source")]
    shares = lambda df, name: df.select(F.create_map(*(x for c in df.columns for x in (F.lit(c), F.col(c).cast("double")))).alias(name))
    ref = F.try_element_at(known, F.col("metric"))
    whole = F.when(ref.isNull(), F.raise_error(F.concat(F.lit("nothing is said to compute "), "metric"))).when(
        F.col("value").isNull() & (F.col("measured") | F.col("reason").isNull()), F.raise_error(F.concat(F.lit("no value and no reason: "), "metric"))
    ).otherwise(ref)
    rows = metrics.crossJoin(F.broadcast(shares(quality, "quality"))).crossJoin(F.broadcast(shares(coverage, "coverage")))
    return rows.select(
        *metrics.columns, F.when(F.col("ci95_low").isNotNull(), "wilson_by_track").otherwise("none").alias("ci_method"), F.lit(calibration).alias("calibration_status"),
        stage.alias("source_stage"), F.col("source").alias("source_artifact"), whole.alias("compute_ref"), "quality", "coverage",
        F.coalesce(F.try_element_at(warned, F.col("metric")), F.array().cast("array<string>")).alias("caveats"),
    )
