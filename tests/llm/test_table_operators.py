"""Operators across documents against brute force and edge cases."""

import collections
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from kerbside.llm import chat_format, components, ngram_join, source_mixing, topk_search

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def near_copies(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    shared = [word() for _ in range(60)]
    texts = []
    for family in range(6):
        base = [word() for _ in range(80)]
        for copy in range(12):
            own = list(base)
            for _ in range(rng.choice((0, 1, 2, 3, 6, 12))):
                own[rng.randrange(len(own))] = word()
            if copy % 3 == 0:
                own += [word() for _ in range(rng.randrange(20))]
            texts.append(" ".join(own if family else own + shared))
    texts += [" ".join(shared + [word() for _ in range(n)]) for n in range(0, 60, 3)]
    return texts + [None, "", "  ", "one two", "One  TWO", "ONE TWO THREE", texts[0], texts[0].upper()]


def components_by_force(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    name = {i: i for i in sets}

    def find(i):
        while name[i] != i:
            i = name[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                name[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("stars", [0, 2])
def test_jaccard_join_equals_brute_force(docs, stars):
    rows = [(7 * k + 3, t) for k, t in enumerate(near_copies())]
    found = ngram_join.jaccard_components(docs(rows), stars=stars).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == components_by_force(rows)


def test_jaccard_join_over_many_batches_and_ranges(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "parts_for", lambda n: ngram_join.Parts(5, 4))
    rows = list(enumerate(near_copies(3)))
    found = ngram_join.jaccard_components(docs(rows + rows[:4])).collect()
    assert len(found) == len(rows) + 4
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == components_by_force(rows)


def test_jaccard_join_of_nothing(docs):
    assert ngram_join.jaccard_components(docs([(1, "x")]).where("doc_id < 0")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(10, 40)] + [(100, k) for k in range(101, 140)]
    found = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[k] for k in range(10, 41)} == {10} and {found[k] for k in range(100, 140)} == {100}


def targets_by_force(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[k % 3] for k, n in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in capped]
        left = total - sum(capped.values())
        level = left / sum(weight[n] for n in free) if free else 0
        over = [n for n in free if level * weight[n] > most * sizes[n]]
        if not over:
            return {n: capped.get(n, level * weight[n]) for n in names}
        capped |= {n: most * sizes[n] for n in over}


def test_mixing_targets_and_draws(spark):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(40), rng.choice(["a", "a", "a", "B", "c", "é", None])) for k in range(3000)] + [(9000, None, "z"), (9001, "", "z"), (1, "w w", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit(5)).withColumn("target", F.lit("t"))
    found = source_mixing.mix_sources(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = targets_by_force(sizes)
    taken = collections.Counter()
    for r in found:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]] and r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in sizes.items():
        assert taken[s] == pytest.approx(want[s], rel=0.15, abs=1)
    emitted = source_mixing.emit_copies(df)
    assert emitted.columns == df.columns
    again = source_mixing.mix_sources(df.repartition(5))
    assert sorted((r["doc_id"], r["taken"]) for r in again.collect()) == sorted((r["doc_id"], r["taken"]) for r in source_mixing.mix_sources(df).collect())
    assert emitted.count() == source_mixing.mix_sources(df).agg(F.sum("copies").alias("n")).first()["n"]


def test_mixing_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert source_mixing.mix_sources(none).count() == 0 and source_mixing.emit_copies(none).count() == 0


@pytest.mark.parametrize("shape", [(3, 20, 10), (64, 4096, 4096)])
def test_top_k_equals_brute_force(spark, shape):
    rng = random.Random(4)
    rows = [(k * 3, [float(rng.randint(-3, 3)) for _ in range(6)]) for k in range(150)]
    rows += [(1000, None), (1001, [1.0, None]), (1002, [float("nan")]), (1003, [float("inf")]), (1004, []), (1005, [2.0]), rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    block, shard, chunk = shape
    found = collections.defaultdict(list)
    for r in topk_search.top_k(df, df.where("vec_id % 5 = 0"), 5, block_rows=block, shard_rows=shard, chunk_rows=chunk).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    fine = {i: v for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q in [i for i in fine if i % 5 == 0]:
        scored = sorted((-int(sum(a * b for a, b in zip(fine[q], v, strict=False))), i) for i, v in fine.items() if i != q)[:5]
        assert found[q] == [(i, -s) for s, i in scored]
    assert set(found) == {i for i in fine if i % 5 == 0}


def test_top_k_of_few_and_large(spark):
    df = spark.createDataFrame([(0, [3e18]), (1, [2.0]), (2, [-5.0])], "vec_id long, vec array<double>")
    found = [(r["vec_id"], r["score"]) for r in topk_search.top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert found == [(1, 6 * 10**18), (2, -(1 << 63))]
    assert topk_search.top_k(df.where("vec_id > 9"), df).count() == 0


def test_tool_calls(spark):
    j = json.dumps
    rows = [
        (1, 0, "assistant", j({"tool_calls": [{"id": "b", "name": "fetch", "arguments": '{"url":"u"}', "depends_on": ["a"]}, {"id": "a", "name": "search", "arguments": {"query": "x", "limit": 2}}]})),
        (1, 1, "tool", j({"tool_call_id": "a", "content": "r"})), (1, 2, "tool", j({"tool_call_id": "b", "content": {"z": 1, "a": [1, 2]}})), (1, 3, "tool", j({"tool_call_id": "lost"})),
        (2, 0, "assistant", j({"tool_calls": [{"id": "p", "name": "search", "arguments": {"query": "x"}, "depends_on": ["q"]}, {"id": "q", "name": "search", "arguments": {"query": "y"}, "depends_on": ["p"]}, 7]})),
        (3, 5, "assistant", j({"tool_calls": [{"id": "a", "name": "search", "arguments": {"query": 1}}, {"id": "a", "name": "search", "arguments": {"query": "x"}}, {"id": "n", "name": "none", "arguments": {}}]})),
        (3, 4, "tool", j({"tool_call_id": "a"})), (4, 0, None, None), (None, 1, "user", ""), (5, 0, "assistant", '{"tool_calls": NaN}'), (6, 0, "tool", "plain"),
    ]
    found = {(r["conv_id"], r["turn"], r["part"]): r for r in chat_format.link_tool_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    status = {k: r["status"] for k, r in found.items()}
    assert status[1, 0, 1] == status[1, 0, 2] == status[1, 1, 0] == status[1, 2, 0] == "ok" and status[1, 3, 0] == "no_call"
    assert (found[1, 0, 2]["level"], found[1, 0, 1]["level"], found[1, 0, 1]["linked_turn"]) == (0, 1, 2)
    assert status[2, 0, 1] == status[2, 0, 2] == "cycle" and status[2, 0, 3] == "no_identifier"
    assert status[3, 5, 1] == "invalid_arguments" and status[3, 5, 2] == "duplicate" and status[3, 5, 3] == "unknown_tool" and status[3, 4, 0] == "too_early"
    assert status[4, 0, 0] == status[None, 1, 0] == status[5, 0, 0] == "ok" and status[6, 0, 0] == "no_identifier"
    assert found[1, 2, 0]["json"] == '{"content":{"a":[1,2],"z":1},"role":"tool","tool_call_id":"b"}'


def test_no_messages(spark):
    assert chat_format.link_tool_calls(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_near_duplicates_keep_null_and_shared_ids(docs, spark):
    import corpus_pipeline

    a, b, c, d = (" ".join(f"{w}{k}" for k in range(40)) for w in "abcd")
    rows = [(1, a), (1, b), (6, b + " end"), (None, c), (None, d), (7, c), (8, "alone"), (8, "alone"), (None, None), (9, None)]
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs(rows), "").collect()]
    assert len(kept) == 7 and set(kept) == {(1, a), (1, b), (7, c), (None, d), (8, "alone"), (None, None), (9, None)}


def test_jaccard_join_links_both_texts_of_an_id(docs):
    a, b, c = (" ".join(f"{w}{k}" for k in range(40)) for w in "abc")
    rows = [(1, a), (1, b), (6, b + " end"), (7, a + " end"), (None, c), (8, c), (None, "alone"), (9, "other")]
    found = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.jaccard_components(docs(rows)).collect()), key=str)
    assert found == sorted([(1, 1), (1, 1), (6, 1), (7, 1), (None, 8), (8, 8), (None, None), (9, 9)], key=str)
