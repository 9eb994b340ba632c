"""Aggregates behind the published figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import point_in_polygon
from ..functions.stats import median
from .sequences import exact_quantiles, gap_sessions

#: Metres of a span in which heights are counted.
HEIGHT_STEP = 0.001


def presence_curve(frames: DataFrame, seconds: float) -> DataFrame:
    """(bin, frames, mean): processed frames and their mean number of people by time bin; empty bins are absent."""
    return frames.where("processed").groupBy(F.floor(F.col("ts") / seconds).alias("bin")).agg(F.count("*").alias("frames"), F.avg("n_detections").alias("mean"))


def valid_steps(obs: DataFrame, roi: list, longest: float = 1.0) -> DataFrame:
    """Rows with a speed and a position inside the ROI, of tracks with two such rows or more.

    ``dt`` is the time since the track's row before, valid or not, held to [0, longest]; a track's first row has 0.
    """
    w = Window.partitionBy("track_id")
    step = F.col("ts") - F.lag("ts").over(w.orderBy("frame_idx"))
    dt = F.when(step.isNull(), 0.0).otherwise(F.least(F.lit(longest), F.greatest(F.lit(0.0), step)))
    inside = F.coalesce(point_in_polygon(F.col("x"), F.col("y"), roi), F.lit(False))
    marked = obs.withColumn("dt", dt).withColumn("valid", F.col("speed").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & inside)
    return marked.withColumn("n_valid", F.count_if("valid").over(w)).where("valid AND n_valid >= 2")


def stop_dwell_grid(obs: DataFrame, roi: list, slow: float, cell: float) -> DataFrame:
    """(cx, cy, seconds, tracks) of standing by square cell of the plan."""
    rows = valid_steps(obs, roi).where(F.col("speed") < slow)
    return rows.groupBy(F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy")).agg(F.sum("dt").alias("seconds"), F.countDistinct("track_id").alias("tracks"))


def stoppers(obs: DataFrame, roi: list, slow: float | Column, least: float) -> DataFrame:
    """Sessions of slow rows inside the ROI, split at gaps of over a second, that last ``least`` seconds or more."""
    inside = F.coalesce(point_in_polygon(F.col("x"), F.col("y"), roi), F.lit(False))
    return gap_sessions(obs.where((F.col("speed") < slow) & inside), 1.0).where(F.col("t1") - F.col("t0") >= least)


def lifetimes(obs: DataFrame) -> DataFrame:
    return obs.groupBy("track_id").agg((F.max("ts") - F.min("ts")).alias("life"))


def colour_bias(spots: DataFrame, half: float = 3.0, least: int = 3) -> DataFrame:
    """Whether a colour gathers in one place: its share within a square about its median place, and elsewhere.

    Colours are a dozen, so their centres are broadcast to the tracks.
    """
    centres = spots.groupBy("colour").agg(median("mx").alias("x0"), median("my").alias("y0"), F.count("*").alias("n_tracks")).where(F.col("n_tracks") >= least)
    met = spots.select(F.col("colour").alias("own"), "mx", "my").crossJoin(F.broadcast(centres))
    inside, same = (F.abs(F.col("mx") - F.col("x0")) < half) & (F.abs(F.col("my") - F.col("y0")) < half), F.col("own") == F.col("colour")
    share = lambda part: F.count_if(same & part) / F.when(F.count_if(part) > 0, F.count_if(part))
    out = met.groupBy("colour", "n_tracks").agg(share(inside).alias("in_share"), share(~inside).alias("out_share"))
    return out.withColumn("ratio", F.col("in_share") / F.when(F.col("out_share") != 0, F.col("out_share")))


def depth_bins(people: DataFrame, width: float, least: int, threshold: float) -> DataFrame:
    """Median height by bins of distance; ``cutoff`` marks the first supported bin whose median is below ``threshold``."""
    low = people.agg(F.floor(F.min("depth")).alias("lo"))
    bins = people.crossJoin(F.broadcast(low)).groupBy(F.floor((F.col("depth") - F.col("lo")) / width).alias("bin")).agg(F.count("*").alias("n"), F.round(median("height"), 6).alias("mid"))
    first = F.min(F.when((F.col("n") >= least) & (F.col("mid") < threshold), F.col("bin"))).over(Window.partitionBy())
    return bins.select("bin", "n", "mid", (F.col("bin") == first).alias("cutoff"))


def height_spread(people: DataFrame) -> DataFrame:
    n = F.count("height")
    size = people.agg(F.when(n >= 2, n).otherwise(F.raise_error(F.lit("a spread takes two heights or more"))).alias("n"))
    ends = exact_quantiles(people, "height", HEIGHT_STEP, {"mid": 0.5, "p75": 0.75, "p25": 0.25, "p10": 0.1, "p90": 0.9})
    return size.crossJoin(F.broadcast(ends)).select("n", "mid", (F.col("p75") - F.col("p25")).alias("iqr"), "p10", "p90")


def slope_interval(rows: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares slope with its 95 % interval, from sums of squares alone; an error below ten rows or without variance of ``x``."""
    sums = rows.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"))
    wrong = F.when(F.col("n") < 10, "a slope takes ten rows or more").when(F.col("sxx") <= 0, "a slope takes differing abscissas")
    sums = sums.withColumn("n", F.when(wrong.isNull(), F.col("n")).otherwise(F.raise_error(F.concat(F.lit("slope: "), wrong))))
    se = F.sqrt((F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")) / (F.col("n") - 2) / F.col("sxx"))
    t = F.when(F.col("n") - 2 >= 30, 1.96).otherwise(2.31)
    out = sums.select("n", "slope", (F.col("slope") - t * se).alias("low"), (F.col("slope") + t * se).alias("high"))
    return out.withColumn("covers_zero", (F.col("low") <= 0) & (F.col("high") >= 0))


def trimmed_scale(people: DataFrame, target: float, trim: float) -> DataFrame:
    """Target height over the median of the heights between two quantiles, bounds included."""
    ends = exact_quantiles(people, "height", HEIGHT_STEP, {"lo": trim, "hi": 1 - trim})
    kept = people.crossJoin(F.broadcast(ends)).where("height BETWEEN lo AND hi")
    middle = exact_quantiles(kept, "height", HEIGHT_STEP, {"mid": 0.5})
    return kept.agg(F.count("*").alias("n")).crossJoin(F.broadcast(middle)).select((F.lit(target) / F.col("mid")).alias("scale"), "n")


def _resampled(rows: DataFrame, key: str, times: int) -> DataFrame:
    """Each row with a Poisson(1) weight for each resample, drawn by hash: a bootstrap that needs no shuffle before its sums."""
    spread = rows.withColumn("resample", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    u = F.pmod(F.xxhash64(key, "resample"), F.lit(1 << 53)) / float(1 << 53)
    bounds = [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582]
    return spread.withColumn("weight", sum((u > b).cast("int") for b in bounds)).where("weight > 0")


def bootstrap_mean(rows: DataFrame, key: str, value: str, times: int) -> DataFrame:
    """(low, high): 95 % percentile interval of the mean over Poisson resamples."""
    means = _resampled(rows, key, times).groupBy("resample").agg((F.sum(F.col(value) * F.col("weight")) / F.sum("weight")).alias("m"))
    return means.agg(F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"))


def bootstrap_slope(rows: DataFrame, key: str, y: str, x: str, times: int) -> DataFrame:
    """The same for a least-squares slope, from weighted sums."""
    w, cx, cy = F.col("weight"), F.col(x), F.col(y)
    sums = _resampled(rows, key, times).groupBy("resample").agg(*(F.sum(w * v).alias(n) for n, v in (("n", F.lit(1.0)), ("sx", cx), ("sy", cy), ("sxx", cx * cx), ("sxy", cx * cy))))
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return sums.select(slope.alias("m")).agg(F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"))


def majority_vote(crops: DataFrame, least: int = 3, certain: float = 0.1) -> DataFrame:
    """Each track's commonest colour, ties to the first by name, its confidence and status, and its crops' median hue."""
    votes = crops.groupBy("track_id", "colour").agg(F.count("*").alias("n"), F.avg("agree").alias("agree"), median("h").alias("h"))
    w = Window.partitionBy("track_id")
    ranked = votes.withColumn("total", F.sum("n").over(w)).withColumn("r", F.row_number().over(w.orderBy(F.desc("n"), "colour")))
    conf = F.col("n") / F.col("total") * F.col("agree")
    status = F.when(F.col("total") < least, "too_few").when(conf < certain, "uncertain").otherwise("ok")
    return ranked.where("r = 1").select("track_id", "colour", "n", conf.alias("conf"), "h", status.alias("status"))
