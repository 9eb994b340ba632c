"""Operators on single texts against brute force and edge cases."""

import base64
import collections
import hashlib
import math
import random
import re
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from kerbside.llm import byte_bpe, language_id, license_scan, preference_ranking, quality_rules, shingling, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD_TEXTS = [None, "", " \n\t ", "one", "a b c d", "É" * 50, "x " * 20000, "日本語 テキスト\n日本語 テキスト", "<|endoftext|> 'S don't\x00\x01  \n\n x", "😀 é́ ​ ﷺ", "the cat sat on the mat\n" * 30]


def covered(words):
    windows = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    return len({k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)})


def test_word_and_shingle_hashes_follow_equality():
    texts = [t or "" for t in ODD_TEXTS]
    hashes, first = shingling.word_hashes(texts, lower=False)
    words = [w for t in texts for w in WORD.findall(t)]
    assert len(hashes) == len(words) and [int(x) for x in first[1:] - first[:-1]] == [len(WORD.findall(t)) for t in texts]
    seen = {}
    for w, h in zip(words, hashes, strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_quality_base_columns(spark, docs):
    rows = list(enumerate(ODD_TEXTS)) + [(4, "a b c d")]
    found = quality_rules.apply_quality_rules(docs(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = ODD_TEXTS[r["doc_id"]] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), covered(words))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (len(words) < 10 or 100 * want[4] > 20 * len(words))
        assert not (r["kept"] and r["base_failed"])


def test_quality_bands(docs, sf_dir, spark):
    prose = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) > 3000").limit(1).first()["text"]
    noise = base64.b85encode(hashlib.shake_256(b"x").digest(6000)).decode()
    noise = " ".join(noise[k : k + 9] for k in range(0, len(noise), 9))
    drum = " ".join(f"la{k % 7} lo{k % 11} li{k % 13}" for k in range(2000))
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.apply_quality_rules(docs([(1, prose), (2, noise), (3, drum)])).collect()}
    assert kept == {1: True, 2: False, 3: False}


def test_quality_rejects_noise_of_any_length_beside_prose(docs, sf_dir, spark):
    draw = random.Random(3)
    makers = {
        "letters": lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 10))),
        "hex": lambda: draw.randbytes(16).hex(),
        "base64": lambda: base64.b64encode(draw.randbytes(45)).decode()[: draw.randint(20, 60)],
    }
    sizes = (512, 2048, 8192, 65536)
    noise = [" ".join(make() for _ in range(size // 3))[:size] for make in makers.values() for size in sizes]
    fine = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if not covered(WORD.findall(r["text"] or ""))]
    prose = [" ".join(fine)[:size] for size in sizes]
    # A passage of noise, more than a quarter of the whole, in prose.
    mixed = prose[2][:4096] + " " + noise[6][:4096]
    rows = quality_rules.apply_quality_rules(docs(list(enumerate([*noise, mixed, *prose])))).orderBy("doc_id").collect()
    assert not any(r["base_failed"] for r in rows[: len(noise)])
    assert [r["kept"] for r in rows] == [False] * (len(noise) + 1) + [True] * len(sizes)


def test_quality_carries_whole_rows(docs):
    rows = docs([(1, "a"), (2, None)])
    back = quality_rules.apply_quality_rules(rows, carry=True).select("row.*")
    assert back.columns == rows.columns and sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_empty_tables(docs):
    none = docs([(1, "x")]).where("doc_id < 0")
    assert quality_rules.apply_quality_rules(none).count() == 0
    assert byte_bpe.tokenize(none, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
    assert license_scan.scan_licenses(none).count() == 0
    model = language_id.fit_languages(none, public_tokenizers.path("piece_bpe_32k.model"))
    (row,) = language_id.identify(docs([(1, "hello")]), model).collect()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert toxicity.fit_toxicity([]).slope == 0 and preference_ranking.fit_ranking([]).score([""])[0] != 0.5


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(docs, reference, spark, sf_dir):
    path, encoding = reference
    texts = ODD_TEXTS + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    found = byte_bpe.tokenize(docs(list(enumerate(texts))), path, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r["doc_id"]] or ""
        ids = encoding.encode_ordinary(text)
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_cache_may_be_small(reference):
    path, encoding = reference
    codec = byte_bpe.Codec(byte_bpe.model_proto(byte_bpe.read_ranks(open(path, "rb").read())), public_tokenizers.PATTERN)
    codec.CACHE = 3
    for text in ("alpha beta gamma delta", "epsilon zeta eta theta iota", "alpha beta"):
        assert codec.encode(text) == encoding.encode_ordinary(text) and codec.decode(codec.encode(text)) == text.encode()


def test_forward_sums_all_segmentations(docs):
    rows = docs([(1, "abba abc ab"), (2, "cab cab bac")])
    model = language_id.fit_languages(rows, public_tokenizers.path("piece_bpe_32k.model"), longest=4, rounds=2)
    pieces = {p: k for k, p in enumerate(language_id.letter_pieces(public_tokenizers.path("piece_bpe_32k.model"), 4))}
    for word in ("▁abba", "▁c", "▁日bac"):
        total = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(max(0, j - 4), j):
                if word[i:j] in pieces:
                    total[j] += total[i] * model.probs[pieces[word[i:j]], 0]
                elif j - i == 1:
                    total[j] += total[i] * model.floor[0]
        got = language_id.Lattice([word], model.hashes).words(model.probs, model.floor)[0, 0]
        assert got == pytest.approx(math.log(total[-1]), rel=1e-9)


def test_language_held_out_accuracy(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = language_id.fit_languages(rows.where(~held), public_tokenizers.path("piece_bpe_32k.model"), sample_docs=100)
    found = language_id.identify(rows, model).join(rows.select("doc_id", "lang"), "doc_id").where(held)
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("a")).first()["a"] >= 0.95


def test_language_of_letterless_texts(docs):
    model = language_id.fit_languages(docs([(1, "hello there world")]), public_tokenizers.path("piece_bpe_32k.model"))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs([(1, None), (2, ""), (3, "123 !?"), (4, "Hello"), (5, "x" * 30000)]), model).collect()}
    assert [found[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3 and found[4][0] == "en" and 0 <= found[5][1] <= 1


def test_license_containment_against_sets(docs):
    mit = "Released under the MIT License."
    texts = [None, "", mit, "words before it " * 9 + mit + " and words after it", "Released under a MIT License.", "x\nAll rights reserved.\ny", "all rights reserved by me today", license_scan.TEMPLATES["BSD"] + "\n" + mit]
    found = {(r["doc_id"], r["template"]) for r in license_scan.scan_licenses(docs(list(enumerate(texts)) + [(2, mit)])).collect()}
    assert found == {(2, "MIT"), (3, "MIT"), (5, "reserved"), (7, "BSD"), (7, "MIT")}


def test_license_native_plan(docs):
    plan = license_scan.scan_licenses(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_toxicity_restores_disguises():
    insults = ["idiot", "moron", "worthless", "stupid"]
    sample = [(k, f"some plain words here {insults[k % 4]} and {insults[(k + 1) % 4]} again" if k % 2 else "some plain words here and nothing else again", k % 2) for k in range(200)]
    model = toxicity.fit_toxicity(sample)
    restorer = toxicity.Restorer(model.chars)

    def score(text):
        return 1 / (1 + math.exp(-(model.slope * model.evidence(restorer.words(text)) + model.offset)))

    for text in ("you id1ot and m0ron", "an i d i o t, a w-o-r-t-h-l-e-s-s one", "stuuupid 1d10t"):
        assert score(text) >= 0.7, text
    for text in (None, "", "plain words 1999 and 3.14", "nothing else"):
        assert score(text) < 0.7, text


def test_toxicity_decodes_doubled_letters_signs_and_spaced_words_with_neighbours():
    insults = ["idiot", "moron", "stupid", "ass"]
    plain = "the book and the moon of a pool in some good plain words"
    sample = [(k, f"{plain} {insults[k % 4]} and {insults[(k + 1) % 4]}" if k % 2 else plain, k % 2) for k in range(200)]
    restorer = toxicity.Restorer(toxicity.fit_toxicity(sample).chars)
    restored = {
        "stuupid": "stupid", "mooron!": "moron", "(iddiot)": "idiot", "a55": "ass", "a$$": "ass", "@$$": "ass", "5tup1d": "stupid", "$tupid": "stupid",
        "you are a s t u p i d": "stupid", "a m o r o n": "moron", "u r a m o r o n.": "moron", "a s s i am": "ass", '"s t u p i d"': "stupid", "so a-s-t-u-p-i-d!": "stupid",
    }
    for text, word in restored.items():
        assert word in restorer.words(text), text
    assert restorer.words("the good moon, 1999 3.14 455 $5 a book (pool)") == {"the", "good", "moon", "a", "book", "pool"}
    assert restorer.words("x " * 50000)


def test_decode_is_the_best_path():
    model = toxicity.CharModel(collections.Counter({"idiot": 5, "plain": 9, "words": 9}))

    def best(token):
        paths = [("", "^^", 0.0)]
        for ways in toxicity.lattice(token):
            step = []
            for text, state, total in paths:
                for chars, channel in ways:
                    t, at = total + channel, state
                    for c in chars:
                        t += model.cost(at, c)
                        at = at[1] + c
                    step.append((text + chars, at, t))
            paths = step
        return max((t + model.cost(at, "$"), text) for text, at, t in paths)[1]

    for token in ("1d10t", "w0rd5", "p-l-a-i-n", "iddiiot"):
        assert toxicity.decode(token, model) == best(token)


def test_ranking_prefers_and_thresholds():
    sample = [(k, "calm words in a plain sentence, one after another." if k % 4 else "### $$$ %%% LOUD!! &&& ***", int(k % 4 > 0)) for k in range(80)]
    model = preference_ranking.fit_ranking(sample)
    good, bad, nothing, empty = model.score(["other calm words in a sentence.", "%%% ### LOUD!! $$$", None, ""])
    assert good >= 0.5 > bad and nothing == empty and 0 <= nothing <= 1
    one_sided = preference_ranking.fit_ranking([(1, "x", 1)])
    assert one_sided.score(["y"])[0] > 0.5
