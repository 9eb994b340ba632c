"""Group the spelling variants of a corpus: words one edit apart, rare ones under the frequent word next to them.

The inverted index is dealt over tasks by what an edit leaves in place: a word is cut into regions of up to three letters, an edit lies in
one of them, and all words with equal letters before and behind a region meet. There the letters of the region are indexed by
positional 2-grams; merging a word's posting lists counts the grams it shares with each other word, those above the overlap that one edit
leaves are verified, and the task that owns the region of a pair's first difference reports it.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache
from heapq import merge
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices
from .durable import durable

#: Letters of a region, at most; of crowded regions one.
REGION = 3
#: Words of a region's group from which it is cut into regions of one letter, whose groups the alphabet bounds.
CROWDED = 20_000
#: Distinct words a task holds before it hands them on.
HELD = 400_000

#: Latin-1 characters by what they become: A-Z lower-case, a-z and U+00C0 to U+00FF themselves, the rest a space.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0xC0 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def word_counts(docs: DataFrame, id_col: str, text_col: str, *, every: int, least_length: int, least_count: int) -> DataFrame:
    """(word, n) of all words of at least ``least_length`` letters that occur ``least_count`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def settled() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            made = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for piece in slices(batch):
                for doc_id, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    uses = Counter(r for r in runs_of(text or "") if len(r) >= least_length)
                    prefix = zlib.crc32(f"{doc_id or ''}:".encode())
                    for run, n in uses.items():
                        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
                        if not h % every:
                            run = run[: h % len(run)] + run[h % len(run) + 1 :]
                            if len(run) < least_length:
                                continue
                        held[run] += n
                    if len(held) > HELD:
                        yield settled()
        if held:
            yield settled()

    made = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].alias("text")).mapInArrow(count, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


@cache
def regions(length: int, most: int) -> tuple[tuple[int, int], ...]:
    """A word of ``length`` letters in regions of up to ``most``, by halving."""

    def cut(lo: int, hi: int) -> list[tuple[int, int]]:
        return [(lo, hi)] if hi - lo <= most else cut(lo, (lo + hi) // 2) + cut((lo + hi) // 2, hi)

    return tuple(cut(0, length))


def keys_of(word: str, most: int) -> Iterator[tuple[str, str]]:
    """(key, letters in the region) for every region: as the shorter word of a pair, and as the longer, which has one letter more there.

    A key is what stands before and behind the region, parted by the length that the region has in the shorter word.
    """
    for lo, hi in regions(len(word), most):
        yield f"{word[:lo]}{hi - lo}{word[hi:]}", word[lo:hi]
    for lo, hi in regions(len(word) - 1, most):
        yield f"{word[:lo]}{hi - lo}{word[hi + 1 :]}", word[lo : hi + 1]


def _grams(letters: str) -> list[tuple[int, str]]:
    """Positional 2-grams with a mark at either end."""
    padded = f"<{letters}>"
    return [(k, padded[k : k + 2]) for k in range(len(letters) + 1)]


def near_in_group(members: list[str], size: int, last: bool) -> Iterator[tuple[int, int]]:
    """Pairs of positions in ``members`` (the letters of a region, of ``size`` or one more) that are one edit apart.

    A pair is left to another region where the first difference lies behind this one, unless it is the ``last`` of the word.
    """
    short = [i for i, m in enumerate(members) if len(m) == size]
    postings: dict[tuple[int, int, str], list[int]] = defaultdict(list)
    for i, m in enumerate(members):
        for k, gram in _grams(m):
            postings[len(m), k, gram].append(i)
    for i in short:
        a = members[i]
        grams = _grams(a)
        for longer in (0, 1):
            # One edit touches two of the longer word's size + longer + 1 grams; the others keep their place or move by the letter put in.
            bound = size + longer - 1
            if bound <= 0:
                # Words that differ in the only letter of the region.
                yield from ((i, j) for j in short if j > i)
                continue
            lists = [postings[key] for k, g in grams for moved in range(longer + 1) if (key := (size + longer, k + moved, g)) in postings]
            if len(lists) < bound:
                continue
            for j, found in groupby(merge(*lists)):
                if (longer or j > i) and sum(1 for _ in found) >= bound:
                    b = members[j]
                    at = next((k for k in range(size) if a[k] != b[k]), size)
                    if a[at + 1 - longer :] == b[at + 1 :] and (at < size or last):
                        yield i, j


def neighbours(keys: DataFrame) -> DataFrame:
    """(word, n_near, best): of every word with a near one, parts of their number and of the near word of largest count, from (key, letters, n)."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str], list[int]]]:
        key, letters, counts = None, [], []
        for batch in batches:
            for k, m, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if len(letters) > 1:
                        yield key, letters, counts
                    key, letters, counts = k, [], []
                letters.append(m)
                counts.append(n)
        if len(letters) > 1:
            yield key, letters, counts

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, int, str]] = []

        def settled() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "lowered", "near"])

        for key, letters, counts in groups(batches):
            at = next(k for k, c in enumerate(key) if c.isdigit())
            before, size, behind = key[:at], int(key[at]), key[at + 1 :]
            found: dict[int, tuple[int, int, str]] = {}
            for i, j in near_in_group(letters, size, not behind):
                for a, b in ((i, j), (j, i)):
                    place = (-counts[b], letters[b])
                    old = found.get(a)
                    found[a] = (1, *place) if old is None else (old[0] + 1, *min(old[1:], place))
            out += [(before + letters[a] + behind, n, low, before + near + behind) for a, (n, low, near) in found.items()]
            if len(out) > 20_000:
                yield settled()
        if out:
            yield settled()

    dealt = keys.select("key", "letters", "n").repartition("key").sortWithinPartitions("key")
    parts = dealt.mapInArrow(search, "word string, n_near long, lowered long, near string")
    best = F.min(F.struct("lowered", "near")).alias("best")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def word_keys(words: DataFrame, most: int) -> DataFrame:
    """(key, letters, n) of every region of (word, n) rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1 << 17):
                rows = [(k, m, n) for w, n in zip(*(c.to_pylist() for c in piece.columns), strict=True) for k, m in keys_of(w, most)]
                types = (pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["key", "letters", "n"])

    return words.select("word", "n").mapInArrow(cut, "key string, letters string, n long")


def smaller_keys(keys: DataFrame) -> DataFrame:
    """(key, letters, n) with each region cut into regions of one letter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1 << 17):
                rows = []
                for key, letters, n in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    at = next(k for k, c in enumerate(key) if c.isdigit())
                    longer = len(letters) - int(key[at])
                    for k in range(int(key[at])):
                        rows.append((f"{key[:at]}{letters[:k]}1{letters[k + 1 + longer :]}{key[at + 1 :]}", letters[k : k + 1 + longer], n))
                types = (pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["key", "letters", "n"])

    return keys.select("key", "letters", "n").mapInArrow(cut, "key string, letters string, n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: forms followed to the last, doubling the way each round; counts grow along it, so it ends."""
    ways = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = durable(ways.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        ways = longer.select("word", "root")
        if not longer.where("moved").limit(1).count():
            return ways


def group_spellings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, every: int = 199, least_length: int = 6, least_count: int = 5, ratio: int = 5
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``least_length`` letters and ``least_count`` occurrences or more.

    Runs of letters lose one of theirs where ``every`` divides the CRC of `<id>:<run>`, as planted slips. A word's form is its near word of largest
    n, ties to the smaller in code-point order, where that n is at least ``ratio`` times its own; root is the end of the chain of forms.
    Null texts have no words and a null id counts as ''; repeated rows count again; other columns are not read, and
    without words the result is empty. Texts of any length are read whole; a word of any length is one row, with a key for every three
    letters or so.
    """
    words = durable(word_counts(docs, id_col, text_col, every=every, least_length=least_length, least_count=least_count))
    keys = durable(word_keys(words, REGION))
    crowded = durable(keys.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") >= CROWDED).select("key"))
    if crowded.limit(1).count():
        # Each pair of a crowded group is found again, and owned, in one of its smaller regions.
        keys = keys.join(crowded, "key", "left_anti").union(smaller_keys(keys.join(crowded, "key", "left_semi")))
    found = neighbours(keys)
    near_n = -F.col("best.lowered")
    form = F.when(near_n >= F.col("n") * ratio, F.col("best.near"))
    rows = words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), F.when(form.isNotNull(), near_n).alias("form_n"))
    rows = durable(rows)
    ends = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_sql(every: int = 199, least_length: int = 6, least_count: int = 5, ratio: int = 5) -> str:
    """DuckDB SQL for ``group_spellings`` over `documents`; near words are found by the words without one letter."""
    return rf"""
        WITH RECURSIVE table_crc AS (
            SELECT list(v ORDER BY b) AS crc FROM (
                SELECT b, list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, b) AS v FROM range(256) t(b)
            )
        ), runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
        ), uses AS (
            SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= {least_length} GROUP BY id, run
        ), coded AS (
            SELECT run, n, xor(4294967295, list_reduce(flatten(list_transform(string_split(id || ':' || run, ''),
                lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195, ord(c)::BIGINT - 64] END)),
                lambda v, b: xor(v >> 8, crc[1 + (xor(v, b) & 255)]), 4294967295)) AS h FROM uses, table_crc
        ), spelt AS (
            SELECT CASE WHEN h % {every} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM coded
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= {least_length} GROUP BY word HAVING sum(n) >= {least_count}
        ), holes AS (
            SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS hole FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM words)
        ), near AS (
            SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.hole = b.hole AND a.k = b.k AND a.word <> b.word
            UNION SELECT h.word, w.word FROM holes h JOIN words w ON h.hole = w.word
            UNION SELECT w.word, h.word FROM holes h JOIN words w ON h.hole = w.word
        ), best AS (
            SELECT near.word, count(*) AS n_near, arg_min(other, (-w.n, other)) AS other, max(w.n) AS other_n FROM near JOIN words w ON w.word = other GROUP BY near.word
        ), formed AS (
            SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= {ratio} * n THEN other END AS form, CASE WHEN other_n >= {ratio} * n THEN other_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), followed AS (
            SELECT word, form AS tip FROM formed WHERE form IS NOT NULL
            UNION SELECT followed.word, formed.form FROM followed JOIN formed ON formed.word = tip WHERE formed.form IS NOT NULL
        ), ends AS (
            SELECT followed.word, tip AS root FROM followed JOIN formed ON formed.word = tip WHERE formed.form IS NULL
        )
        SELECT formed.word, form, coalesce(root, formed.word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends ON ends.word = formed.word
    """
