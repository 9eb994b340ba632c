"""WARC archives, source divergence and spelling variants against brute force and SQL, with the awkward rows."""

import glob
import gzip
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import source_divergence, spelling_variants, warc


def sql_rows(con_tables, sql):
    con = duckdb.connect()
    for name, df in con_tables.items():
        con.register(name, df.toArrow())
    made = con.sql(sql)
    return made.columns, made.fetchall()


def same(df, columns, rows):
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted(rows, key=key)


TRICK = "<p>WARC/1.1\r\nWARC-Type: response\r\n\r\nWARC-Warcinfo-ID: <urn:uuid:0>\r\n\r\n" + "x" * 1200
PAGES = [
    (1, "http://a/x?y", None), (2, "http://a/2", TRICK), (3, "http://a/3\r\nWARC-Type: evil", TRICK), (3, "http://a/3\r\nWARC-Type: evil", TRICK),
    (4, None, "é" * 500), (5, "http://b", "é" * 499 + "a"), (6, "no scheme", "é" * 499 + "a"), (None, "http://null", TRICK), (7, "http://c", "é" * 500),
    (7, "http://c2", "é" * 500), (8, "http://d/\x00é", ""), (9, "http://e", "WARC/1.1\r\n" + "long " * 400_000), (10, "http://f", "WARC/1.1\r\n" + "long " * 400_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "row", 1, b"x") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, type string, copies int, payload binary").repartition(3)


def test_pages_come_back_from_their_archive(pages):
    same(warc.captures_of_pages(pages), *sql_rows({"pages": pages}, warc.archive_sql()))
    same(warc.captures_of_pages(pages.limit(0)), *sql_rows({"pages": pages.limit(0)}, warc.archive_sql()))


def test_wide_lookups_are_shuffled_alike(pages, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    same(warc.captures_of_pages(pages), *sql_rows({"pages": pages}, warc.archive_sql()))


def parse(raw):
    """Records of WARC bytes by their declared lengths: (headers, block)."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = [tuple(line.split(": ", 1)) for line in lines[1:]]
        size = int(dict(headers)["Content-Length"])
        yield headers, raw[end + 4 : end + 4 + size]
        assert raw[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
        at = end + 8 + size


def test_archives_are_warc_files(pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, date="2024-02-03T04:05:06Z")
    records = [r for f in glob.glob(f"{path}/*/part-*") for r in parse(gzip.decompress(open(f, "rb").read()))]
    by_kind = {}
    for headers, block in records:
        own = dict(headers)
        assert own["WARC-Date"] == "2024-02-03T04:05:06Z" and own["WARC-Record-ID"].startswith("<urn:uuid:")
        by_kind.setdefault(own["WARC-Type"], []).append((own, block))
    n = len(PAGES)
    assert {k: len(v) for k, v in by_kind.items()} == {"warcinfo": 1, "request": n, "response": n - 4, "revisit": 4, "metadata": n}
    captures = {own["WARC-Record-ID"] for k in ("response", "revisit") for own, _ in by_kind[k]}
    assert {own["WARC-Concurrent-To"] for k in ("request", "metadata") for own, _ in by_kind[k]} == captures
    responses = {own["WARC-Record-ID"]: block for own, block in by_kind["response"]}
    assert all(own["WARC-Refers-To"] in responses for own, _ in by_kind["revisit"])
    assert sorted(b.split(b"\r\n\r\n", 1)[1].decode() for b in responses.values()) == sorted(
        h or "" for i, (_, _, h) in enumerate(PAGES) if i not in (1, 2, 4, 7, 11)
    )
    assert {own["WARC-Warcinfo-ID"] for k in ("request", "response", "revisit", "metadata") for own, _ in by_kind[k]} == {by_kind["warcinfo"][0][0]["WARC-Record-ID"]}


def test_truncated_records_fail(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    name = max(glob.glob(f"{path}/records/part-*"), key=lambda f: len(gzip.decompress(open(f, "rb").read())))
    raw = gzip.decompress(open(name, "rb").read())
    for crc in glob.glob(f"{path}/records/.*.crc"):
        __import__("os").unlink(crc)
    open(name, "wb").write(gzip.compress(raw[:-9]))
    with pytest.raises(Exception, match="wrong length"):
        warc.record_heads(warc.read_records(spark, path)).collect()


HEADS = "record_id string, type string, target_uri string, concurrent_to array<string>, refers_to string, declared_digest string, fields map<string,string>, http string, payload_bytes long, payload_digest string"


def test_transactions_join_in_either_direction(spark):
    def head(name, kind, to=(), refers=None, size=None):
        return (name, kind, f"u:{name}", list(to), refers, None, {"of": name} if kind == "metadata" else None, "h", size, f"d{size}" if size else None)

    rows = [
        head("r1", "response", ["q1"], size=10), head("q1", "request"), head("m1", "metadata", ["q1"]), head("m0", "metadata", ["r1"]),
        head("r2", "response", size=20), head("q2", "request", ["r2"]), head("q2", "request", ["r2"]), head("r3", "revisit", refers="r1"),
        head("r4", "revisit", refers="gone"), head("m4", "metadata", ["r4"]), head("x", "resource"), head("m9", "metadata", ["nowhere"]), head("r5", "response", size=5), head("r5", "response", size=5),
    ]
    found = {r["record_id"]: r for r in warc.assemble(spark.createDataFrame(rows, HEADS)).collect()}
    assert set(found) == {"r1", "r2", "r3", "r4", "r5"}
    names = {k: ([q["record_id"] for q in r["requests"]], [m["record_id"] for m in r["metadata"]]) for k, r in found.items()}
    assert names == {"r1": (["q1"], ["m0", "m1"]), "r2": (["q2"], []), "r3": ([], []), "r4": ([], ["m4"]), "r5": ([], [])}
    assert found["r3"]["original"]["payload_bytes"] == 10 and found["r4"]["original"] is None and found["r5"]["copies"] == 2


LANGS = "doc_id long, text string, lang string, source string, term string, n long, value int"


def words(seed, n):
    draw = random.Random(seed)
    pool = ["the", "The", "of", "É", "é", "naïve", "日本", "a1b", "x-y", "Zebra", "don't", *(f"w{chr(97 + k)}{chr(97 + k % 7)}" for k in range(20))]
    rows = []
    for k in range(n):
        text = " ".join(draw.choice(pool) for _ in range(draw.choice([0, 3, 30])))
        rows.append((k, None if k % 37 == 0 else text, draw.choice(["en", "en", "fr", None, ""]), draw.choice(["s0", "s0", "s0", "s1", "é", None, ""]), "x", 1, 2))
    return [*rows, *rows[:5], (n, "alone " * 40, "xx", "s1", "x", 1, 2), (n + 1, None, "xx", "s2", "x", 1, 2), (n + 2, "Long " * 60_000, "en", "s9", "x", 1, 2)]


@pytest.mark.parametrize(("n", "cells"), [(0, 1 << 14), (400, 1 << 14), (400, 1 << 13)])
def test_divergence_equals_sql(spark, monkeypatch, n, cells):
    monkeypatch.setattr(source_divergence, "LEAST_CELLS", cells)
    monkeypatch.setattr(source_divergence, "HELD", 40)
    docs = spark.createDataFrame(words(3, n) if n else [], LANGS).repartition(4)
    same(source_divergence.audit_sources(docs), *sql_rows({"documents": docs}, source_divergence.divergence_sql()))
    same(source_divergence.audit_sources(docs, min_docs=2, top=3), *sql_rows({"documents": docs}, source_divergence.divergence_sql(2, 3)))


def test_sketch_never_underestimates_and_discards(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "CHUNK", 64)
    rows = [(k, " ".join({f"t{chr(97 + k % 26)}{chr(97 + j)}" for j in range(k % 9)} | {f"only{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k // 100]}"})) for k in range(900)]
    docs = spark.createDataFrame([("en", "s", t) for _, t in rows], "lang string, source string, text string").select(*(F.col(c).cast("binary") for c in ("lang", "source", "text")))
    sketch = source_divergence.document_sketch(docs.repartition(5), 1 << 10)
    true = {}
    for _, t in rows:
        for w in set(t.split()):
            true[w] = true.get(w, 0) + 1
    terms = [w.encode() for w in true]
    cells = source_divergence.cells_of(b"en", terms, 1 << 10)
    least = np.min([sketch[k][cells[k]] for k in range(source_divergence.DEPTH)], axis=0)
    assert all(least[i] >= true[t.decode()] for i, t in enumerate(terms))
    partial = source_divergence.possible_counts(docs, sketch, 20).select("term").distinct().count()
    assert sum(n >= 20 for n in true.values()) <= partial < len(true) / 2
    assert int(sketch.max()) <= source_divergence.FULL


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def brute(rows, every=199, ratio=5):
    counts = {}
    for doc_id, text in rows:
        run, runs = "", []
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                runs.append(run)
                run = ""
        for r in runs:
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{r}".encode())
            if h % every == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            if len(r) >= 6:
                counts[r] = counts.get(r, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    form, out = {}, []
    for w, n in counts.items():
        own = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form[w] = own[0][1] if own and -own[0][0] >= ratio * n else None
        out.append([w, form[w], None, n, len(own), -own[0][0] if form[w] else None])
    for r in out:
        r[2] = r[0]
        while form[r[2]]:
            r[2] = form[r[2]]
    return [tuple(r) for r in out]


def spellings(seed):
    draw = random.Random(seed)
    stems = ["straße", "naïveté", "colour", "aaaaaaa", "abababab", "internationalisation", "ÀÉÎÕÜß×÷", "abcdef"]
    texts = {}
    for stem in stems:
        for _ in range(14):
            k, w = draw.randrange(len(stem) + 1), stem
            w = draw.choice([w, w, w[:k] + draw.choice("abé") + w[k:], w[:k] + w[k + 1 :], w[:k] + draw.choice("xyà") + w[k + 1 :]])
            if draw.random() < 0.4:
                k = draw.randrange(len(w))
                w = w[:k] + draw.choice("ab") + w[k + 1 :]
            texts[w] = draw.choice([4, 5, 6, 31, 160, 900])
    bag = [w if draw.random() < 0.8 else w.upper() for w, n in texts.items() for _ in range(n)]
    draw.shuffle(bag)
    rows = [(k, draw.choice([" ", "1", "日", "—", "\n"]).join(bag[k * 40 : k * 40 + 40])) for k in range(len(bag) // 40)]
    return [*rows, rows[0], rows[0], (None, rows[1][1]), (-5, None), (77, ""), (78, "zweite " * 70_000)]


@pytest.mark.parametrize(("crowded", "held"), [(20_000, 400_000), (3, 5)])
def test_spellings_by_force(spark, monkeypatch, crowded, held):
    monkeypatch.setattr(spelling_variants, "CROWDED", crowded)
    monkeypatch.setattr(spelling_variants, "HELD", held)
    rows = spellings(5)
    docs = spark.createDataFrame([(i, t, "w", 3) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 10 and any(r[1] and r[1] != r[2] for r in want)
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    same(spelling_variants.group_spellings(docs), columns, want)
    same(spelling_variants.group_spellings(docs, every=7, ratio=2), columns, brute(rows, 7, 2))


def test_spellings_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "a few short ones")], "doc_id string, text string")
    assert spelling_variants.group_spellings(docs).collect() == [] and spelling_variants.group_spellings(docs.limit(0)).collect() == []


def test_every_pair_is_owned_once():
    draw = random.Random(8)
    pool = sorted({"".join(draw.choice("abc") for _ in range(draw.choice([5, 6, 7, 8]))) for _ in range(400)})
    for most in (1, 3):
        groups = {}
        for w in pool:
            for key, letters in spelling_variants.keys_of(w, most):
                groups.setdefault(key, []).append((letters, w))
        found = []
        for key, members in groups.items():
            at = next(k for k, c in enumerate(key) if c.isdigit())
            for i, j in spelling_variants.near_in_group([m for m, _ in members], int(key[at]), not key[at + 1 :]):
                found.append(tuple(sorted((members[i][1], members[j][1]))))
        assert sorted(found) == sorted((a, b) for k, a in enumerate(pool) for b in pool[k + 1 :] if near(a, b))
