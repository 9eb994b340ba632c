"""Runs of letters, tokens and spaced signs of any length are read whole; toxicity is learnt from every label, alike in memory and by rows."""

import math
import random
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from kerbside.llm import language_id, toxicity
from kerbside.llm.queries import op7_toxicity


@pytest.fixture
def toy():
    pieces = sorted(["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb", "c", "abcabcab"])
    probs = np.random.default_rng(0).random((len(pieces), 3))
    return language_id.LanguageModel(("x", "y", "z"), language_id.piece_table(pieces), probs / probs.sum(axis=0), np.full(3, 1e-7), np.zeros(3), np.zeros(3))


@pytest.mark.parametrize("block", [5, 1 << 14])
def test_long_words_are_summed_whole(toy, monkeypatch, block):
    monkeypatch.setattr(language_id, "BLOCK", block)
    draw = random.Random(1)
    words = ["".join(draw.choice("abcd") for _ in range(n)) for n in (0, 5, 256, 257, 400, 3000)]
    whole = language_id.Lattice([language_id.MARK + w for w in words], toy.hashes).words(toy.probs, toy.floor)
    assert np.allclose(toy.word_logs(words), whole, rtol=1e-12, atol=0)


def test_long_words_by_force(toy):
    """The sum over all segmentations, position by position in plain numbers of any size."""
    word = "ab" * 150 + "cdba" * 3
    pieces = sorted(["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb", "c", "abcabcab"])
    text = language_id.MARK + word
    sums = [Fraction(1)]
    for end in range(1, len(text) + 1):
        here = Fraction(0) if text[end - 1] in pieces else Fraction(1e-7) * sums[-1]
        for k, p in enumerate(pieces):
            if text[:end].endswith(p):
                here += Fraction(toy.probs[k, 1]) * sums[end - len(p)]
        sums.append(here)
    exact = math.log(sums[-1].numerator) - math.log(sums[-1].denominator)
    assert toy.word_logs([word])[0, 1] == pytest.approx(exact, rel=1e-9)


def test_ten_thousand_letters_take_seconds(toy):
    start = time.monotonic()
    lang, score, _ = toy.classify(["ab" * 5000, "ab"])
    assert time.monotonic() - start < 10 and lang[0] in toy.languages and 0 < score[0] <= 1


@pytest.fixture
def chars():
    return toxicity.CharModel(Counter({"idiot": 50, "stupid": 40, "hello": 30, "the": 100, "world": 10}))


def test_long_tokens_are_decoded_whole(chars, monkeypatch):
    tokens = ["1d10t" * 90, "x" * 253 + "1d10t", "h3ll0-" * 70 + "5tup1d", "*" * 300, "he**o" * 100]
    found = [toxicity.decode(t, chars) for t in tokens]
    monkeypatch.setattr(toxicity, "SETTLED", 10**9)
    assert found == [toxicity.decode(t, chars) for t in tokens]
    assert found[0] == "idiot" * 90 and found[2].endswith("stupid")
    # An insult over what was the end of a piece.
    assert toxicity.decode(("idiot" * 51)[:254] + "1d10t", chars).endswith("idiot")


def test_a_megabyte_of_figures_is_no_word(chars):
    restorer = toxicity.Restorer(chars)
    start = time.monotonic()
    assert restorer.words(" ".join("0123456789" * 50_000)) == set()
    assert time.monotonic() - start < 20
    # Letters within a window of them are still tried, from figures too.
    assert "idiot" in restorer.words("4 4 7 1 d 1 0 t 2 9 9") | {w[:5] for w in restorer.words("4 4 7 1 d 1 0 t 2 9 9")}


def test_fits_by_rows_and_in_memory_agree(spark):
    draw = random.Random(4)
    sample = []
    for k in range(300):
        bad = k % 3 == 0
        words = [draw.choice(["plain", "words", "here", "again", "nothing", "else", "lines"]) for _ in range(12)]
        if bad:
            words[draw.randrange(12)] = draw.choice(["idiot", "1d10t", "st*pid", "stupid", "s t u p i d"])
        sample.append((k, " ".join(words), int(bad)))
    sample += [(400, "", 0), (401, "long idiot " * 30_000, 1), (402, None, 0)]
    rows = spark.createDataFrame(sample, "doc_id long, text string, label int").repartition(4)
    mine, one = toxicity.fit_toxicity_rows(rows), toxicity.fit_toxicity(sample)
    assert mine.odds == one.odds and mine.odds
    assert (mine.slope, mine.offset) == pytest.approx((one.slope, one.offset), rel=1e-9)
    assert mine.chars.three == one.chars.three and mine.chars.two == one.chars.two and mine.chars.known == one.chars.known and mine.chars.size == one.chars.size
    for part in (rows.where("label = 0"), rows.where("label = 1"), rows.limit(0)):
        local = toxicity.fit_toxicity([tuple(r) for r in part.collect()])
        assert toxicity.fit_toxicity_rows(part).offset == local.offset


def test_toxicity_learns_from_every_label(spark, tmp_path):
    # More labels than any sample held: each of twenty insults stands in five of the documents to learn from.
    learnt = [k for k in range(12_000) if zlib.crc32(str(k).encode()) % 3 != 1]
    asked = [k for k in range(12_000) if zlib.crc32(str(k).encode()) % 3 == 1]
    insults = [f"{a}{b}" for a in ("oda", "pme", "kli", "tsu") for b in ("pmirb", "hclud", "tsnof", "krewg", "vilk")]
    text = {k: f"plain words and {k % 7} here" for k in range(12_000)}
    bad = {k: insults[place % 20] for place, k in enumerate(learnt[::80][:100])}
    assert len(bad) == 100 and len(learnt) > 7000
    text.update({k: f"plain words and {w} here" for k, w in bad.items()})
    text.update({k: f"here plain {w} words" for k, w in zip(asked, insults, strict=False)})
    spark.createDataFrame(list(text.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k in bad)) for k in text], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = op7_toxicity(spark, str(tmp_path)).where("predicted = 1").select("doc_id").collect()
    assert {r["doc_id"] for r in found} == {*bad, *asked[:20]}
