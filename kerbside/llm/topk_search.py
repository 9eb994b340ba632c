"""Exact top-k search by integer inner product, block at a time.

Vectors are dealt to ranges by the nearest of some centres, so that a range holds like vectors; a shard of a range orders its own by
repeated halving along the widest component and cuts them into blocks, each with the largest and smallest value of every component.
A query takes a block's components at the end that favours it; their sum, and what the block's centre and radius allow, bound the
score of every vector in it. A query scores its blocks from the highest bound down, through the block's forward index, and stops at
the first bound below its kth score. The kth score in one shard of each query's likeliest range is where the search of all other
ranges starts, so ranges and blocks that cannot reach it are never scored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import durable

#: Sums of products below this are exact in a double.
EXACT = float(1 << 53)
LONG = float(1 << 63)
#: Bytes of the sample that centres are fitted on.
SAMPLE_BYTES = 64 << 20
#: Rows of a table that is broadcast.
BROADCAST_ROWS = 100_000


def _dense(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _products(block: np.ndarray, queries: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as int64; beyond the range of a double's integers in Python's, held to the range of a long."""
    if exact:
        return (block @ queries.T).astype(np.int64)
    whole = block.astype(object) @ queries.astype(object).T
    return np.clip(np.vectorize(int, otypes=[object])(whole), -(1 << 63), (1 << 63) - 1).astype(np.int64)


def nearest(data: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the distance to it, a little enlarged."""
    with np.errstate(over="ignore", invalid="ignore"):
        near = ((centres**2).sum(axis=1) - 2 * data @ centres.T).argmin(axis=1)
        return near, np.linalg.norm(data - centres[near], axis=1) * (1 + 1e-9)


def fit_centres(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centres of like rows of a sample, by Lloyd's iterations from rows spread evenly through it."""
    centres = sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(int)]
    for _ in range(rounds if len(centres) > 1 else 0):
        near, _ = nearest(sample, centres)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = sample[near == c].mean(axis=0)
    return centres


def halved(data: np.ndarray, block_rows: int) -> np.ndarray:
    """An order of the rows in which every run of ``block_rows`` holds like ones."""
    parts, done = [np.arange(len(data))], []
    while parts:
        own = parts.pop()
        if len(own) <= block_rows:
            done.append(own)
            continue
        widest = np.argmax(np.ptp(data[own], axis=0))
        half = block_rows * -(-len(own) // (2 * block_rows))
        own = own[np.argsort(data[own, widest], kind="stable")]
        parts += [own[half:], own[:half]]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def packed(sizes: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each range, its first chunk and the number of them: small ranges share one of up to ``most`` queries, large ones have several."""
    first, parts, chunk, held = [], [], -1, most
    for size in sizes:
        if size > most:
            first.append(chunk + 1)
            parts.append(-(-size // most))
            chunk, held = chunk + parts[-1], most
            continue
        if held + size > most or chunk < 0:
            chunk, held = chunk + 1, 0
        held += size
        first.append(chunk)
        parts.append(1)
    return np.array(first), np.array(parts)


def ball_bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """What the score of a query with any vector within a radius of a centre cannot exceed."""
    with np.errstate(over="ignore", invalid="ignore"):
        reach = np.linalg.norm(queries, axis=1)[:, None] * (radii + 1e-9 * (np.linalg.norm(centres, axis=1) + radii))
        return np.nan_to_num(queries @ centres.T + reach + 1e-6, nan=np.inf)


def search_shard(
    ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, block_rows: int, known: np.ndarray | None = None
) -> tuple[list[tuple[int, int, int, int]], int]:
    """(query's place, query_id, vec_id, score) of each query's k best rows of a shard, rows of its own id left out, ties to the
    smaller id; and how many products were taken. ``known`` holds scores that k rows of other shards reach: rows below need not come."""
    order = halved(data, block_rows)
    ids, data = ids[order], data[order]
    starts = range(0, len(ids), block_rows)
    blocks = [data[s : s + block_rows] for s in starts]
    high, low, mid = (np.stack([f(b, axis=0) for b in blocks]) for f in (np.max, np.min, np.mean))
    exact = bool(np.abs(data).max(axis=0, initial=0) @ np.abs(queries).max(axis=0, initial=0) < EXACT)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    if exact:
        radii = np.array([np.linalg.norm(b - m, axis=1).max() for b, m in zip(blocks, mid, strict=True)])
        bounds = np.minimum(bounds, ball_bounds(queries, mid, radii))
    else:
        bounds = np.clip(bounds * (1 + np.sign(bounds) * 1e-12) + 1e3, -LONG, LONG)
    turns = np.argsort(-bounds, axis=1, kind="stable")
    bar = np.full(len(queries), -np.inf) if known is None else known
    score = np.full((len(queries), k), np.iinfo(np.int64).min)
    best = np.full((len(queries), k), -1)
    filled = np.zeros((len(queries), k), bool)
    live, taken = np.arange(len(queries)), 0
    for turn in range(len(blocks)):
        block = turns[live, turn]
        kth = np.maximum(np.where(filled[live, -1], score[live, -1].astype(float), -np.inf), bar[live])
        going = bounds[live, block] >= kth
        live, block = live[going], block[going]
        if not len(live):
            break
        for b in np.unique(block):
            who = live[block == b]
            new = _products(blocks[b], queries[who], exact).T
            taken += new.size
            names = np.broadcast_to(ids[b * block_rows : (b + 1) * block_rows], new.shape)
            own = names != query_ids[who][:, None]
            all_score, all_names, all_filled = (np.concatenate(p, axis=1) for p in ((score[who], new), (best[who], names), (filled[who], own)))
            rank = np.lexsort((all_names, ~all_score, ~all_filled), axis=1)[:, :k]
            score[who], best[who], filled[who] = (np.take_along_axis(a, rank, axis=1) for a in (all_score, all_names, all_filled))
    rows = [(i, int(query_ids[i]), int(best[i, j]), int(score[i, j])) for i, j in zip(*np.nonzero(filled), strict=True) if score[i, j] >= bar[i]]
    return rows, taken


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, *, block_rows: int = 64, shard_rows: int = 4096, chunk_rows: int = 4096, most_ranges: int = 256,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` highest scores among all other rows, ties to smaller ids.

    Both frames hold (vec_id long, vec array<double> of integers). Vectors null, or holding null or non-finite components, and rows
    without an id take no part. Shorter vectors count as ending in zeros. Equal rows count once; different vectors of one id are
    rows of their own, none of which is a candidate of a query of that id, and whose scores as queries are ranked together. A query
    with fewer than ``k`` other rows gets them all; empty tables give no rows. Scores beyond a long stop at its ends. Other columns
    are not read.

    Centres, ``most_ranges`` at most, are fitted on a sample of SAMPLE_BYTES; they only decide what can be passed over. Rows of a
    range are dealt to shards of about ``shard_rows`` by a hash of the row, queries to chunks of about ``chunk_rows`` of like ones, so
    no task holds more whatever the table. Every chunk meets every shard of the ranges that one of its queries can still profit from.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        return df.select("vec_id", "vec").where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & fine)

    vectors, queries = usable(vectors), usable(queries)
    sizes = [df.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("w")).first() for df in (vectors, queries)]
    n, width = sizes[0]["n"], max(sizes[0]["w"] or 0, sizes[1]["w"] or 0, 1)
    most = max(1, SAMPLE_BYTES // (8 * width))
    draw = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(1 << 31)) < int(min(1.0, most / max(1, n)) * (1 << 31))
    sample = vectors.where(draw).limit(most).toPandas().sort_values("vec_id", kind="stable")["vec"]
    centres = fit_centres(_dense(sample, width), min(most_ranges, n // shard_rows + 1)) if len(sample) else np.zeros((1, width))
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("range int, radius double")
    def placed(vec: pd.Series) -> pd.DataFrame:
        near, gap = nearest(_dense(vec, width), shared.value)
        return pd.DataFrame({"range": near, "radius": gap})

    once = ["vec_id", "vec"]
    vectors = durable(vectors.dropDuplicates(once).select(*once, placed("vec").alias("at")).select(*once, "at.*"))
    found = {r["range"]: r for r in vectors.groupBy("range").agg(F.count("*").alias("n"), F.max("radius").alias("radius")).collect()}
    held = np.array([found[c]["n"] if c in found else 0 for c in range(len(centres))])
    radii = np.array([found[c]["radius"] if c in found else 0.0 for c in range(len(centres))])

    def lookup(values: np.ndarray, at: Column) -> Column:
        return F.element_at(F.array(*(F.lit(int(v)) for v in values)), at + 1)

    def dealt(by: Column, parts: Column) -> Column:
        return F.pmod(F.xxhash64(by, "vec_id", "vec"), parts).cast("int")

    shards = np.maximum(1, -(-held // shard_rows))
    vectors = vectors.select("vec_id", "vec", "range", dealt(F.lit("shard"), lookup(shards, F.col("range"))).alias("shard"))

    @F.pandas_udf("int")
    def likeliest(vec: pd.Series) -> pd.Series:
        near = np.where(held > 0, np.nan_to_num(_dense(vec, width) @ shared.value.T), -np.inf)
        return pd.Series(near.argmax(axis=1))

    queries = durable(queries.dropDuplicates(once).select(*once, likeliest("vec").alias("range")))
    asked = {r["range"]: r["n"] for r in queries.groupBy("range").agg(F.count("*").alias("n")).collect()}
    first, chunks = packed([asked.get(c, 0) for c in range(len(centres))], chunk_rows)
    chunk = lookup(first, F.col("range")) + dealt(F.lit("chunk"), lookup(chunks, F.col("range")))
    queries = queries.select("vec_id", "vec", "range", chunk.alias("chunk"), dealt(F.lit("first"), lookup(shards, F.col("range"))).alias("shard"))

    def searched(asking: DataFrame, first: bool) -> DataFrame:
        """What each query finds in the (range, shard) that its row names."""
        tasks = durable(asking.select("range", "shard", "chunk").distinct())
        few = tasks.count() <= BROADCAST_ROWS
        rows = vectors.join(F.broadcast(tasks) if few else tasks, ["range", "shard"])
        columns = [F.col(c) for c in ("range", "shard", "chunk", "vec_id", "vec")]
        both = rows.select(F.lit(False).alias("asks"), *columns, F.lit(None).cast("double").alias("bar"))
        both = both.unionByName(asking.select(F.lit(True).alias("asks"), *columns, "bar"))

        def task(pdf: pd.DataFrame) -> pd.DataFrame:
            sides = []
            for side in (False, True):
                own = pdf[pdf["asks"] == side]
                data, ids = _dense(own["vec"], width), own["vec_id"].to_numpy(np.int64)
                order = np.lexsort((*data.T[::-1], ids))
                sides.append((ids[order], data[order], own["bar"].to_numpy(float)[order], own["vec"].iloc[order], own["chunk"].iloc[:1]))
            (ids, data, *_), (query_ids, asked, bar, vecs, at) = sides
            hits = search_shard(ids, data, query_ids, asked, k, block_rows, bar)[0] if len(ids) and len(query_ids) else []
            if not first:
                return pd.DataFrame([h[1:] for h in hits], columns=["query_id", "vec_id", "score"]).astype("int64")
            reached: dict[int, list[int]] = {}
            for i, *_, score in hits:
                reached.setdefault(i, []).append(score)
            bars = [float(min(reached[i])) if len(reached.get(i, ())) == k else -np.inf for i in range(len(query_ids))]
            return pd.DataFrame({"vec_id": query_ids, "vec": vecs.to_numpy(), "chunk": int(at.iloc[0]) if len(at) else 0, "bar": bars})

        out = "vec_id long, vec array<double>, chunk int, bar double" if first else "query_id long, vec_id long, score long"
        return both.groupBy("range", "shard", "chunk").applyInPandas(task, out)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    unbarred = queries.withColumn("bar", F.lit(float("-inf")))
    if shards.sum() == 1:  # a single shard leaves no other to pass over
        near = searched(unbarred, False)
        return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    barred = durable(searched(unbarred, True))

    @F.pandas_udf("array<int>")
    def hopeful(vec: pd.Series, bar: pd.Series) -> pd.Series:
        bounds = ball_bounds(_dense(vec, width), shared.value, radii)
        bounds = np.where(np.isfinite(bounds), bounds + np.abs(bounds) * 1e-9, np.inf)
        return pd.Series([np.flatnonzero((held > 0) & ((b >= s) | (s <= -LONG))) for b, s in zip(bounds, bar, strict=True)])

    wide = barred.select("vec_id", "vec", "chunk", "bar", F.explode(hopeful("vec", "bar")).alias("range"))
    near = searched(wide.select("*", F.explode(F.sequence(F.lit(0), lookup(shards, F.col("range")) - 1)).alias("shard")), False)
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
