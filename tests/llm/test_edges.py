"""Edge cases and independent checks of the training-text operators."""

import collections
import itertools
import json
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from kerbside.llm import byte_bpe, chat_format, durable, language_id, license_scan, ngram_join, preference_ranking, quality_rules, source_mixing, topk_search, toxicity

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
PROSE = "the quick brown fox jumps over the lazy dog and then some other words of plain english follow here"
STARS = "/*" + "*" * 10000 + "/"


def noise(n, seed=0):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(n))


# Language ID


@pytest.fixture(scope="module")
def languages(spark):
    french = "le renard brun saute par dessus le chien paresseux et puis d autres mots suivent dans cette phrase"
    rows = [(k, t, lang, "s") for k in range(6) for t, lang in ((PROSE, "en"), (french, "fr"))] + [(9, "hi", "xx", "s")]
    return language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), VOCABULARY)


def test_language_of_one_text_a_partition(docs, languages):
    texts = ["hi", "abc", "word", "Hello", "", None, "½²¼¾①②③④⑤Ⅷ", "日本", "x" * 5_000_000, "hi", noise(700_000), STARS, "İ"]
    start = time.monotonic()
    found = {r["doc_id"]: r for r in language_id.identify(docs(list(enumerate(texts))).repartition(len(texts), "doc_id"), languages).collect()}
    assert time.monotonic() - start < 60 and len(found) == len(texts)
    assert {k for k, r in found.items() if r["lang_pred"] == "und"} == {4, 5, 6, 11}
    assert all(0 <= r["score"] <= 1 for r in found.values()) and found[0][1:] == found[9][1:]


def test_languages_learnt_from_little(docs, languages):
    assert languages.languages == ("en", "fr", "xx")
    none = docs([(1, "x")]).where("doc_id < 0")
    assert language_id.identify(none, languages).count() == 0
    letterless = language_id.fit_languages(docs([(1, "½ 12"), (2, None)]), VOCABULARY)
    assert letterless.languages == ("en",) and letterless.classify(["word"])[0] == ["en"]


def test_equal_languages_tie_to_the_first(spark):
    rows = [(k, PROSE, lang) for k in range(3) for lang in ("b", "a")]
    model = language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), VOCABULARY)
    assert model.classify([PROSE])[0] == ["a"] and model.classify([PROSE])[1][0] == pytest.approx(0.5)


def test_pieces_of_all_lengths_are_used():
    lengths = {len(p) for p in language_id.letter_pieces(VOCABULARY)}
    assert max(lengths) > 8 and set(language_id.piece_table(language_id.letter_pieces(VOCABULARY))) == lengths


def test_expected_uses_by_force():
    pieces = ["a", "ab", "b", "ba", "▁", "▁a"]
    probs, floor = np.array([0.2, 0.15, 0.25, 0.1, 0.2, 0.1]), 1e-3
    words, weight = ["▁abba", "▁ca", "▁a"], np.array([2.0, 1.0, 5.0])
    want = np.zeros(len(pieces))
    for word, w in zip(words, weight, strict=True):
        ways = []
        for cut in itertools.product([0, 1], repeat=len(word) - 1):
            ends = [k + 1 for k, c in enumerate(cut) if c] + [len(word)]
            parts = [word[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            if all(p in pieces or len(p) == 1 for p in parts):
                ways.append((math.prod(probs[pieces.index(p)] if p in pieces else floor for p in parts), parts))
        for p, parts in ways:
            for part in parts:
                if part in pieces:
                    want[pieces.index(part)] += w * p / sum(q for q, _ in ways)
    assert language_id.Lattice(words, language_id.piece_table(pieces)).expected(probs, floor, weight) == pytest.approx(want, rel=1e-9)


def test_letters_that_no_language_explains_are_odd(languages):
    _, _, odd = languages.classify([PROSE, noise(200), None, "le chien brun et le renard"])
    assert odd[0] < 1 and odd[1] > 4 and odd[2] is None and odd[3] < 3


def test_words_in_pieces_of_bounded_memory_score_alike(languages, monkeypatch):
    texts = [noise(300, k) for k in range(5)] + [None, "hi"]
    whole = languages.classify(texts)
    monkeypatch.setattr(language_id, "CELLS", 50)
    assert languages.classify(texts)[0] == whole[0]
    assert np.array(languages.classify(texts)[1]) == pytest.approx(np.array(whole[1]))


# Toxicity


@pytest.fixture(scope="module")
def toxic_model():
    insults = ["idiot", "moron", "worthless", "stupid"]
    return toxicity.fit_toxicity([(k, f"some plain words here {insults[k % 4]} and {insults[(k + 1) % 4]} again" if k % 2 else "some plain words here and nothing else again", k % 2) for k in range(200)])


def test_toxicity_of_one_text_a_partition(docs, toxic_model):
    texts = [None, "", STARS, "a b " * 20000 + "-dog", "x" * 5_000_000, "you id1ot and m0ron", "you id1ot and m0ron", '"!' * 20000, "5..!" * 20000 + "a", "plain words"]
    start = time.monotonic()
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs(list(enumerate(texts))).repartition(len(texts), "doc_id"), toxic_model).collect()}
    assert time.monotonic() - start < 60 and len(found) == len(texts)
    assert {k for k, s in found.items() if s >= 0.7} == {5, 6} and found[5] == found[6] and found[0] == found[1] == found[9]
    assert toxicity.score_toxicity(docs([(1, "x")]).where("doc_id < 0"), toxic_model).count() == 0


def test_toxicity_score_by_force(toxic_model):
    for text in ("you id1ot and m0ron", "plain words", "some stupid plain w0rds", "i d i o t"):
        words = toxicity.Restorer(toxic_model.chars).words(text)
        votes = sorted((max([0.0, *(toxic_model.odds[s] for s in (w, w[:4] + "~", w[:5] + "~") if s in toxic_model.odds)]) for w in words), reverse=True)[:3]
        assert toxic_model.evidence(words) == pytest.approx(sum(votes))
    label = np.array([k % 2 for k in range(200)])
    bags = [toxicity.Restorer(toxic_model.chars).words(f"some plain words here {('idiot', 'moron', 'worthless', 'stupid')[k % 4]} and {('idiot', 'moron', 'worthless', 'stupid')[(k + 1) % 4]} again" if k % 2 else "some plain words here and nothing else again") for k in range(200)]
    holds = {w: [sum(w in b for b, y in zip(bags, label, strict=True) if y == side) for side in (0, 1)] for w in ("idiot", "plain")}
    for word, (n0, n1) in holds.items():
        gain = math.log((n1 + 0.5) / 101) - math.log((n0 + 0.5) / 101)
        assert toxic_model.odds.get(word) == (pytest.approx(gain) if gain >= 2 else None)
    # The logistic fit's penalised gradient vanishes.
    x = np.array([toxic_model.evidence(b) for b in bags])
    p = 1 / (1 + np.exp(-(toxic_model.slope * x + toxic_model.offset)))
    assert np.mean((p - label) * x) + 1e-4 * toxic_model.slope == pytest.approx(0, abs=1e-6)


def test_spaced_letters_by_force():
    draw = random.Random(1)
    units = ["a", "s", "x", "4", "$", "dog", "it", "a-b-c", "w.o.r.d", "no", "!", "f*u*n"]
    for _ in range(500):
        text = " ".join(draw.choice(units) for _ in range(draw.randint(1, 9)))
        tokens = [re.split(r"(?<=\w)[-.*](?=\w)", t) for t in text.split()]
        runs, own = [], []
        for parts in [*tokens, ["end"]]:
            if all(len(p) == 1 for p in parts):
                own += parts
            else:
                runs += [own] if len(own) > 2 else []
                own = []
        assert list(toxicity.spaced(text)) == runs, text


# License scans


def test_license_recall_at_partial_containment(docs):
    draw = random.Random(4)
    rows, want = [], set()
    for k in range(300):
        name, text = draw.choice(sorted(license_scan.TEMPLATES.items()))
        words = text.split()
        if len(words) > 12:
            for _ in range(draw.randrange(3)):  # changed words
                words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
            if k % 3 == 0:  # pieces in another order
                cut = draw.randrange(5, len(words) - 5)
                words = words[cut:] + [f"y{k}"] + words[:cut]
        rows.append((k, f"{noise(20, k)}\n{' '.join(words)}\n{noise(20, k + 1)}"))
    def shingled(text):
        words = re.findall("[a-z0-9]+", text.lower())
        phrases = [re.findall("[a-z0-9]+", p) for p in re.split(license_scan.BREAKS, text.lower())]
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} | {tuple(p) for p in phrases if 1 <= len(p) <= 4}
    library = {n: shingled(" ".join(re.findall("[a-z0-9]+", t.lower()))) for n, t in license_scan.TEMPLATES.items()}
    for k, text in rows:
        own = shingled(text)
        want |= {(k, n, len(t), len(t & own)) for n, t in library.items() if len(t & own) * 100 >= 80 * len(t)}
    found = {(r["doc_id"], r["template"], r["n_shingles"], r["n_matched"]) for r in license_scan.scan_licenses(docs(rows)).collect()}
    assert found == want and len(want) > 200


def test_license_phrases_in_any_line(docs):
    texts = ["Copyright 2024 Acme. All rights reserved.", "x\nAll rights reserved." + " " * 80, "=" * 100 + " All rights reserved.", "© 2024, all rights reserved", "all rights reserved by me",
             noise(60_000) + ". All rights reserved. " + noise(60_000)]
    found = license_scan.scan_licenses(docs(list(enumerate(texts)) + [(0, texts[0])])).select("doc_id", "template").collect()
    assert sorted(map(tuple, found)) == [(k, "reserved") for k in (0, 1, 2, 3, 5)]


def test_license_library_is_bounded(docs):
    with pytest.raises(ValueError, match="library"):
        license_scan.scan_licenses(docs([(1, "x")]), {"big": noise(license_scan.MOST_SHINGLES + 100)})


def test_license_masks_come_in_opposite_pairs():
    assert all(a == ~b for a, b in itertools.batched(license_scan._MASKS, 2))


# Source mixing


def test_mixing_native_plan(docs):
    plan = source_mixing.mix_sources(docs([(1, "x y"), (2, None)]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Top-k


def by_force(rows, asks, k=5):
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = collections.defaultdict(list)
    for q, a in fine:
        if asks(q):
            out[q] += [(-int(sum(x * y for x, y in zip(a, b, strict=False))), i) for i, b in fine if i != q]
    return {q: [(i, -s) for s, i in sorted(s)[:k]] for q, s in out.items() if s}


@pytest.mark.parametrize("ranges", [1, 7])
def test_top_k_over_ranges_shards_and_repeated_ids(spark, ranges):
    draw = random.Random(8)
    centres = [[draw.randint(-40, 40) for _ in range(5)] for _ in range(7)]
    rows = [(k, [float(c + draw.randint(-2, 2)) for c in draw.choice(centres)]) for k in range(300)]
    rows += [(3, [50.0] * 5), (10, [-50.0] * 5), (4, rows[4][1]), (None, [1.0]), (900, []), (901, [7.0])] + [(k, [9.0] * 5) for k in range(400, 460)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, vec array<double>, range string, score int")
    found = collections.defaultdict(list)
    for r in topk_search.top_k(df, df.where("vec_id % 10 = 0"), block_rows=4, shard_rows=40, chunk_rows=7, most_ranges=ranges).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert found == by_force(rows, lambda q: q % 10 == 0)


def test_blocks_are_passed_over_on_clustered_vectors():
    draw = np.random.default_rng(3)
    centres = draw.integers(-100, 100, (20, 16))
    data = (np.repeat(centres, 200, axis=0) + draw.integers(-4, 5, (4000, 16))).astype(float)
    ids = draw.permutation(4000)
    rows, taken = topk_search.search_shard(ids, data, ids[::50], data[::50], 5, 64)
    assert len(rows) == 400 and taken < 0.15 * 4000 * 80
    kth = {i: min(s for j, *_, s in rows if j == i) for i in range(80)}
    again, fewer = topk_search.search_shard(ids, data, ids[::50], data[::50], 5, 64, np.array([float(kth[i]) for i in range(80)]))
    assert sorted(again) == sorted(rows) and fewer <= taken


# Quality rules


def test_quality_verdict_by_force(docs, sf_dir, spark):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(80).collect()] + [None, "", noise(5000), "la lo " * 3000, PROSE]
    bands = quality_rules.Bands()
    found = quality_rules.apply_quality_rules(docs(list(enumerate(texts)))).collect()
    assert len(found) == len(texts)
    def uneven(data):
        used = collections.Counter(b for b in data if b >= 128 or chr(b).isalnum())
        n = sum(used.values())
        return sum(c * (c - 1) for c in used.values()) / (n * (n - 1)) * len(used) if n > 1 else math.inf
    for r in found:
        data = (texts[r["doc_id"]] or "").encode()
        if not data:
            assert not r["kept"] and r["zstd_ratio"] is None
            continue
        pack = lambda d: len(zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False).compress(d)) / len(d)
        chunks = [data[k : k + 2048] for k in range(0, len(data), 2048) if len(data[k : k + 2048]) >= 1024]
        bad = [not 0.37 <= pack(c) <= 0.65 or uneven(c) < 1.25 for c in chunks]
        low, high = next((lo, hi) for size, lo, hi in bands.whole if len(data) < size)
        fine = low <= pack(data) <= high and (not bad or sum(bad) / len(bad) < 0.25) and not (len(data) >= 256 and uneven(data) < 1.25)
        assert r["kept"] == (fine and not r["base_failed"]) and r["zstd_ratio"] == pytest.approx(pack(data))


# N-gram join


def jaccard_by_force(rows):
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    name = {i: i for i in sets}
    def find(i):
        while name[i] != i:
            i = name[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            name[y] = x
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [40, 1000])
def test_shingles_shared_by_many_unlinked_documents(docs, monkeypatch, block):
    # Every document is five of eleven passages: each shingle is in nearly half of them, and only near copies are linked.
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    draw = random.Random(6)
    passages = [[f"p{p}w{k}" for k in range(40)] for p in range(11)]
    rows = []
    for chosen in itertools.combinations(range(11), 5):
        words = [w for p in chosen for w in passages[p]]
        rows.append((len(rows), " ".join(words)))
        if draw.random() < 0.1:
            words[draw.randrange(len(words))] = f"own{len(rows)}"
            rows.append((len(rows), " ".join(words)))
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs(rows), stars=1).collect()}
    assert found == jaccard_by_force(rows)


def test_rarity_in_slices_equals_whole(monkeypatch):
    draw = np.random.default_rng(2)
    values = draw.integers(0, 1 << 40, 3000, dtype=np.uint64)[draw.integers(0, 3000, 9000)]
    packed = np.frombuffer(ngram_join._packed(values), np.uint8).reshape(-1, 5)
    counts = draw.integers(1, 9, 9000).astype(np.uint8)
    held = collections.Counter()
    for v, c in zip(values, counts, strict=True):
        held[int(v)] += int(c)
    want = [min(255, int(8 * math.log2(held[int(v)]))) for v in values]
    for size in (1 << 20, 100):
        monkeypatch.setattr(ngram_join, "COUNTED", size)
        assert ngram_join._rarity(packed, counts).tolist() == want


def test_cells_of_the_exchange_stay_large():
    for size in (10**6, 10**9, 3 * 10**10, 10**14, 10**15):
        parts = ngram_join.parts_for(size)
        assert parts.batches * parts.ranges <= max(600 * 130, size / ngram_join.CELL_BYTES * 1.01)


def test_sketches_never_hide_a_link():
    draw = random.Random(9)
    for n in (1, 5, 90, 400, 3000):
        a = np.unique(np.array([draw.getrandbits(64) for _ in range(n)], np.uint64))
        b = np.unique(np.concatenate((a[: len(a) * 9 // 10 + 1], np.array([draw.getrandbits(64) for _ in range(n // 20)], np.uint64))))
        (s, x), (t, y) = ngram_join._sketch(a), ngram_join._sketch(b)
        if s == t:
            lost = sum(int(v).bit_count() for v in (x & ~y).view(np.uint64))
            assert lost <= len(np.setdiff1d(a, b))


def test_jaccard_join_of_a_very_long_text(docs):
    long = noise(120_000)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs([(1, long), (2, long + " end"), (3, "other words of no interest here")])).collect()}
    assert found[1][1] == found[2][1] == 1 and found[2][0] == found[1][0] + 1 and found[3] == (2, 3)


# Chat formatting


def levels_by_force(ids, needs):
    level = {}
    while True:
        new = {i: 1 + max((level[d] for d in needs[i]), default=-1) for i in ids if i not in level and all(d in level for d in needs[i])}
        if not new:
            return level
        level |= new


@pytest.mark.parametrize("local", [200_000, 30])
def test_levels_of_generated_conversations(spark, monkeypatch, local):
    monkeypatch.setattr(chat_format, "LOCAL_NEEDS", local)
    draw = random.Random(5)
    rows, want = [], {}
    for conv in [*range(12), None, (1 << 60) + 1]:
        ids = [f"c{k}" for k in range(draw.randint(1, 30))]
        needs = {i: {draw.choice(ids) if draw.random() < 0.08 else ids[draw.randrange(k)] for _ in range(draw.randrange(4))} if k else set() for k, i in enumerate(ids)}
        rows.append((conv, 0, ids, needs))
        want |= {(conv, i): n for i, n in levels_by_force(ids, needs).items()}
    if local > 1000:
        ids = [f"c{k}" for k in range(1000)]
        needs = {i: set(ids[max(0, k - 1) : k]) for k, i in enumerate(ids)}
        rows.append((99, 0, ids, needs))
        want |= {(99, i): k for k, i in enumerate(ids)}
    made = [(c, t, "assistant", json.dumps({"tool_calls": [{"id": i, "name": "search", "arguments": {"query": "x"}, "depends_on": [*sorted(needs[i]), "gone"]} for i in ids]}), 7, "j") for c, t, ids, needs in rows]
    df = spark.createDataFrame(made, "conv_id long, turn long, role string, text string, level int, json string")
    found = {(r["conv_id"], r["call_id"]): r["level"] for r in chat_format.link_tool_calls(df).where("kind = 'call' and level is not null").collect()}
    assert found == want


def test_json_is_strict(spark):
    deep = "[" * 100_000 + "]" * 100_000
    texts = ['{"content":1e999}', '{"tool_call_id":"a","content":-1e999}', '{"tool_call_id":"a","content":' + deep + "}", '{"tool_call_id":"a","content":"' + "x" * 3_000_000 + '"}', '{"tool_call_id":"b","content":1.5e3}']
    df = spark.createDataFrame([(1, k, "tool", t) for k, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    found = {r["turn"]: r for r in chat_format.link_tool_calls(df).collect()}
    assert [found[k]["status"] for k in range(5)] == ["no_identifier"] * 3 + ["no_call"] * 2
    for r in found.values():
        assert json.loads(r["json"], parse_constant=pytest.fail)
    assert found[4]["json"] == '{"content":1500.0,"role":"tool","tool_call_id":"b"}'


def test_schemas_nest():
    point = {"type": "object", "properties": {"x": {"type": "number"}, "kind": {"enum": ["a", 1]}}, "required": ["x"], "additionalProperties": {"type": "string"}}
    schemas = {"plot": {"type": "object", "properties": {"points": {"type": "array", "items": point}, "title": {"type": ["string", "null"]}}, "required": ["points"], "additionalProperties": False}}
    fine = [{"points": []}, {"points": [{"x": 1, "kind": "a"}, {"x": 2.5, "kind": 1, "more": "y"}], "title": None}]
    wrong = [{}, {"points": {}}, {"points": [{"kind": "a"}]}, {"points": [{"x": True}]}, {"points": [{"x": 1, "kind": True}]}, {"points": [{"x": 1, "more": 2}]}, {"points": [], "other": 1}, {"points": [], "title": 3}, []]
    assert all(chat_format.validate("plot", v, schemas) == "ok" for v in fine)
    assert all(chat_format.validate("plot", v, schemas) == "invalid_arguments" for v in wrong) and chat_format.validate("x", {}, schemas) == "unknown_tool"


# Byte-level BPE


def test_one_very_long_pre_token(docs):
    long = "ab" * 100_000
    (row,) = byte_bpe.tokenize(docs([(1, long)]), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True).collect()
    import hashlib

    assert row["decoded_sha256"] == hashlib.sha256(long.encode()).hexdigest() and row["n_tokens"] == len(row["ids"]) < len(long)


# Quality ranking


def test_ranking_fit_by_force():
    draw = random.Random(2)
    sample = [(k, noise(draw.randint(5, 60), k).capitalize() + "." if k % 3 else f"#{'$' * (k % 7)} {noise(9, k).upper()}!!", int(k % 3 > 0)) for k in range(120)]
    model = preference_ranking.fit_ranking(sample)
    z = (preference_ranking.features([t for _, t, _ in sample]) - model.mean) / model.scale
    good, bad = ([z[k] for k, (*_, y) in enumerate(sample) if y == side] for side in (1, 0))
    gaps = np.array([g - b for g in good for b in bad])
    p = 1 / (1 + np.exp(-gaps @ model.weights))
    assert gaps.T @ (p - 1) / len(gaps) + 1e-3 * model.weights == pytest.approx(np.zeros(z.shape[1]), abs=1e-6)
    scores = z @ model.weights
    assert np.mean(scores < model.threshold) == pytest.approx(len(bad) / len(sample), abs=0.01)
    assert model.score([t for _, t, _ in sample]) == pytest.approx(1 / (1 + np.exp(-(scores - model.threshold))))


def test_ranking_of_rows(docs, spark):
    sample = [(k, "calm words in a plain sentence, one after another." if k % 4 else "### $$$ %%% LOUD!! &&& ***", int(k % 4 > 0)) for k in range(80)]
    rows = spark.createDataFrame(sample, "doc_id long, text string, label int")
    model = preference_ranking.fit_ranking_rows(rows)
    assert model.weights == pytest.approx(preference_ranking.fit_ranking(sample).weights)
    texts = [None, "", "calm words here.", "calm words here.", "$$$ LOUD!!", noise(300_000)]
    found = {r["doc_id"]: r["score"] for r in preference_ranking.rank_quality(docs(list(enumerate(texts))), model).collect()}
    assert len(found) == 6 and found[0] == found[1] and found[2] == found[3] >= 0.5 > found[4] and all(0 <= s <= 1 for s in found.values())
    assert preference_ranking.rank_quality(docs([(1, "x")]).where("doc_id < 0"), model).count() == 0


def test_pairs_reach_all_partners():
    for many in (7919, 2 * 7919, 5000):
        a, b = preference_ranking.pairs_of(np.arange(20), np.arange(many), 4000)
        assert len(a) == 4000 and len(set(b)) >= min(many, 4000)


# Folders


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        durable.shared_folder(Session)


# Pipeline


def test_pipeline_of_empty_and_odd_tables(docs, spark):
    import corpus_pipeline

    none = docs([(1, "x")]).where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, "")
        assert out.count() == 0, name
        if name != "byte-level BPE":
            assert out.columns == none.columns
    odd = docs([(k, t) for k, t in enumerate([None, "", PROSE, PROSE, noise(60), STARS, "½" * 40])] + [(2, PROSE), (None, PROSE)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, "").columns == odd.columns, name


def test_pipeline_stages_by_force(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    model = language_id.fit_languages(docs, VOCABULARY, sample_docs=300)
    rows = {r["doc_id"]: r for r in docs.collect()}
    lang, score, odd = model.classify([r["text"] for r in rows.values()])
    want = {i for i, n, p, o in zip(rows, lang, score, odd, strict=True) if n != "und" and p >= 0.5 and o <= 4.5}
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, sf_dir).collect()} == want
    texts = {i: (r["text"] or "").translate({c: c + 32 for c in range(65, 91)}) for i, r in rows.items()}
    small = {i: t for i, t in texts.items() if len(t.split()) >= 5}
    named = jaccard_by_force(list(small.items()))
    short = {i: t for i, t in texts.items() if i not in small}
    firsts = {min(k for k, u in short.items() if u.split() == t.split()) if t.split() else i for i, t in short.items()}
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()} == set(named.values()) | firsts
    assert docs.where(F.col("doc_id").isNull()).count() == 0
