"""Audit how far the sources of each language differ in their words, in exact integers.

A count-min sketch of document frequencies is merged over all tasks first. It never underestimates, so terms whose estimate is below
the least document frequency are impossible and are not shuffled; the others are counted exactly. Every sum over all kept terms
is split into what a term without occurrences gives, times their number, and corrections for the terms that do occur, which come
from joins of the sparse counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import slices
from .durable import durable

#: Rows of the sketch; a term counts as often as its smallest cell says.
DEPTH = 3
#: Cells of a row: about CELLS_PER_DOC a document, within these bounds. At the upper bound the sketch has 25 MB on the driver and in
#: each Python worker. Where more terms meet in a cell, fewer are discarded early; results stay the same.
CELLS_PER_DOC, LEAST_CELLS, MOST_CELLS = 16, 1 << 14, 1 << 22
#: Cells are merged in chunks, each in one task, from at most so many tasks that sketch.
CHUNK, SKETCHING_TASKS = 1 << 13, 2000
#: Distinct entries a task holds before it hands them on.
HELD = 400_000
#: Counts in the sketch stop here, far above any least document frequency.
FULL = (1 << 16) - 1

#: Bytes of UTF-8 text by what they become: A-Z lower-case, a-z and all of non-ASCII characters themselves, the rest a space.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters of a UTF-8 text, with A-Z in lower case."""
    return text.translate(_TERMS).split()


def cells_of(lang: bytes, terms: list[bytes], width: int) -> np.ndarray:
    """Each term's cell in every row of the sketch, rows first."""
    seed = xxhash.xxh3_64_intdigest(lang)
    h = np.fromiter((xxhash.xxh3_64_intdigest(t, seed) for t in terms), np.uint64, len(terms))
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((low + np.uint64(k) * high) % np.uint64(width)).astype(np.int64) for k in range(DEPTH)])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes, bytes]]:
    for batch in batches:
        for piece in slices(batch):
            yield from zip(*(c.to_pylist() for c in piece.columns), strict=True)


def document_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """The merged count-min sketch of (lang, source, text) rows: in how many documents of its language a term occurs."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((DEPTH, width), np.uint32)
        held: dict[bytes, Counter] = {}

        def settle() -> None:
            for lang, found in held.items():
                n = np.fromiter(found.values(), np.uint32, len(found))
                for k, cells in enumerate(cells_of(lang, list(found), width)):
                    np.add.at(total[k], cells, n)
            np.minimum(total, FULL, out=total)
            held.clear()

        for lang, _, text in _texts(batches):
            own = held.setdefault(lang, Counter())
            own.update(set(terms_of(text)))
            if sum(map(len, held.values())) > HELD:
                settle()
        settle()
        parts = total.astype("<u2").reshape(-1, CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(used, pa.int32()), "cells": pa.array([parts[k].tobytes() for k in used], pa.binary())})

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CHUNK, np.uint32)
        for batch in batches:
            for cells in batch.column("cells"):
                total = np.minimum(total + np.frombuffer(cells.as_buffer(), "<u2"), FULL)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([total.astype("<u2").tobytes()], pa.binary())})

    schema = "chunk int, cells binary"
    made = docs.coalesce(SKETCHING_TASKS).mapInArrow(sketch, schema)
    whole = np.zeros((DEPTH * width // CHUNK, CHUNK), np.uint16)
    for row in made.groupBy("chunk").applyInArrow(merge, schema).toLocalIterator():
        whole[row["chunk"]] = np.frombuffer(bytes(row["cells"]), "<u2")
    return whole.reshape(DEPTH, width)


def possible_counts(docs: DataFrame, sketch: np.ndarray, min_docs: int) -> DataFrame:
    """(lang, source, term, n, docs) partial counts of the terms that the sketch leaves possible."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    names = ("lang", "source", "term", "n", "docs")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def settled() -> Iterator[pa.RecordBatch]:
            estimates = shared.value
            for (lang, source), (uses, found) in seen.items():
                terms = list(uses)
                if not terms:
                    continue
                cells = cells_of(lang, terms, estimates.shape[1])
                least = np.min([estimates[k][cells[k]] for k in range(DEPTH)], axis=0)
                kept = [terms[i] for i in np.flatnonzero(least >= min_docs)]
                columns = [[lang] * len(kept), [source] * len(kept), kept, [uses[t] for t in kept], [found[t] for t in kept]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i < 3 else pa.int64()) for i, c in enumerate(columns)], names=names)
            seen.clear()

        for lang, source, text in _texts(batches):
            uses, found = seen.setdefault((lang, source), (Counter(), Counter()))
            terms = terms_of(text)
            uses.update(terms)
            found.update(set(terms))
            if sum(len(u) for u, _ in seen.values()) > HELD:
                yield from settled()
        yield from settled()

    made = docs.mapInArrow(count, "lang binary, source binary, term binary, n long, docs long")
    return made.select(*(F.col(c).cast("string").alias(c) for c in names[:3]), "n", "docs")


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, total): exact occurrences, by source and in all, of terms in at least ``min_docs`` documents of the language."""
    if not 0 < min_docs < FULL:
        raise ValueError(f"min_docs must be between 1 and {FULL - 1}")
    width = LEAST_CELLS
    while width < min(MOST_CELLS, CELLS_PER_DOC * docs.count()):
        width *= 2
    partial = possible_counts(docs, document_sketch(docs, width), min_docs)
    # Dealt by term, so that a hot source is spread, and both sums and the join need no further shuffle.
    exact = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    exact = durable(exact)
    kept = exact.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("in_docs")).where(F.col("in_docs") >= min_docs)
    return exact.drop("docs").join(kept.drop("in_docs"), ["lang", "term"])


def share(n: Column, size: Column, kept: Column) -> Column:
    """1 + floor(10**9 (n + 5) / (size + 5 kept)), in decimals that hold any count; null where no term is kept."""

    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    over = F.when(kept > 0, wide(size + 5 * kept))
    return F.call_function("div", F.lit(10**9).cast("decimal(10,0)") * wide(n + 5), over) + 1


def audit_sources(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *, min_docs: int = 30, top: int = 50
) -> DataFrame:
    """lang, source, part, item, value and rank of every (lang, source) group.

    Part `pair` has every other source of the language by the summed absolute difference of smoothed shares of its kept terms; part `term` up
    to ``top`` kept terms that the group uses more than its language does. Null columns count as '', repeated rows as documents of
    their own; no other columns are read, and no rows give no rows. Ties go to the smaller item in UTF-8 order. Whole texts are
    counted where they lie: only sketch chunks and counts are shuffled.
    """
    clean = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).cast("binary").alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counts = durable(kept_counts(clean, min_docs))
    groups = clean.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")).distinct()
    langs = counts.groupBy("lang", "term").agg(F.max("total").alias("total")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_size"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = groups.join(langs, "lang", "left").join(sizes, ["lang", "source"], "left").na.fill(0, ["kept", "lang_size", "size"])
    groups = durable(groups.withColumn("zero", share(F.lit(0), F.col("size"), F.col("kept"))))
    rated = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("size"), F.col("kept")))
    rated = durable(rated.select("lang", "source", "term", "n", "total", "p", "zero", "kept", "lang_size"))

    excess = (F.col("p") - share(F.col("total"), F.col("lang_size"), F.col("kept"))).alias("value")
    terms = rated.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess).where("value > 0")

    other = groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))
    base = F.abs(F.col("zero") - F.col("other_zero"))
    pairs = groups.join(other, "lang").where("source < other").select("lang", "source", "other", F.coalesce(F.col("kept") * base, F.lit(0)).alias("value"))
    # Terms of one source, as if the other lacked them; equal shares together.
    alike = rated.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("terms"))
    single = alike.join(other, "lang").where("source <> other").select(
        "lang", F.least("source", "other").alias("source"), F.greatest("source", "other").alias("other"),
        (F.col("terms") * (F.abs(F.col("p") - F.col("other_zero")) - base)).alias("value"),
    )
    # Terms of both.
    mine = rated.select("lang", "term", "source", "p", "zero")
    theirs = rated.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("q"), F.col("zero").alias("other_zero"))
    apart = F.abs(F.col("p") - F.col("q")) - F.abs(F.col("p") - F.col("other_zero")) - F.abs(F.col("zero") - F.col("q")) + base
    both = mine.join(theirs, ["lang", "term"]).where("source < other").select("lang", "source", "other", apart.alias("value"))
    # Sums of pairs are combined before they are dealt.
    sums = pairs.union(single).union(both).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct("source", F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    sums = sums.select("lang", ways.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    def ranked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))

    return ranked(sums).union(ranked(terms).where(F.col("rank") <= top))


def divergence_sql(min_docs: int = 30, top: int = 50) -> str:
    """DuckDB SQL for ``audit_sources`` over `documents`, with every group's every kept term."""
    return rf"""
        WITH clean AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, list_transform(
                regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
                lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
            FROM documents
        ), in_docs AS (
            SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM clean) GROUP BY lang, term HAVING count(*) >= {min_docs}
        ), uses AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM (SELECT lang, source, unnest(terms) AS term FROM clean) SEMI JOIN in_docs USING (lang, term)
            GROUP BY lang, source, term
        ), cells AS (
            SELECT g.lang, g.source, k.term, coalesce(u.n, 0)::HUGEINT AS n, count(*) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS v,
                sum(coalesce(u.n, 0)) OVER (PARTITION BY g.lang, g.source)::HUGEINT AS size,
                sum(coalesce(u.n, 0)) OVER (PARTITION BY g.lang, k.term)::HUGEINT AS total, sum(coalesce(u.n, 0)) OVER (PARTITION BY g.lang)::HUGEINT AS lang_size
            FROM (SELECT DISTINCT lang, source FROM clean) g JOIN in_docs k ON g.lang = k.lang
            LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
        ), shares AS (
            SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 5) // (size + 5 * v) AS p, 1 + 1000000000::HUGEINT * (total + 5) // (lang_size + 5 * v) AS q
            FROM cells
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM (SELECT DISTINCT lang, source FROM clean) a
            JOIN (SELECT DISTINCT lang, source FROM clean) b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ), parts AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM parts QUALIFY part = 'pair' OR rank <= {top}
    """
