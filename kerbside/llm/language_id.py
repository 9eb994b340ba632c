"""Language identification by unigram pieces, summing over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability in a language is the sum,
over all ways of cutting it into pieces, of the product of their probabilities; a forward pass computes it. A text's is the
product over its words. The probabilities are learnt by expectation maximisation over the same lattice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import id_and_text, map_slices
from .shingling import U, mix

#: Each word is opened by this mark, as in the vocabulary.
MARK = "▁"
UNDETERMINED = "und"
#: Words of more letters are scored one by one, their forward state carried along, as a lattice takes a step a letter of its longest word.
#: Languages are learnt from such words in parts of so many letters.
LONGEST_WORD = 256
#: Letters of a long word whose pieces are looked up at a time, and after how many its sums are scaled anew.
BLOCK, RESCALED = 1 << 14, 16
#: Numbers that a lattice's tables may hold at a time: positions or words, times languages.
CELLS = 1 << 22
#: Bytes of a model, which is broadcast.
MODEL_BYTES = 1 << 30

_RUNS = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    """The words of a text: runs of letters (Unicode category L), lower-cased."""
    runs = _RUNS.findall((text or "").lower())
    if not all(map(str.isalpha, runs)):  # numerals such as ½ and Ⅷ are no digits to the pattern
        runs = [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]
    return runs


def in_parts(word: str) -> list[str]:
    """A word, or a long one's parts, to learn from."""
    return [word[k : k + LONGEST_WORD] for k in range(0, len(word), LONGEST_WORD)]


def letter_pieces(model_file: str, longest: int | None = None) -> list[str]:
    """The vocabulary's lower-case letter pieces, of up to ``longest`` characters if given, the opening mark included."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = {model.id_to_piece(k) for k in range(model.get_piece_size())}
    kept = (p for p in pieces if (p == MARK or p.removeprefix(MARK).isalpha()) and p == p.lower())
    return sorted(p for p in kept if longest is None or len(p) <= longest)


_SEEDS = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 64, dtype=np.uint64) | U(1)


#: Slots of the table that most spans outside the vocabulary are turned away by.
_SIEVE = 1 << 18


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words one after another, and where each begins (one more entry than words)."""
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return mix(raw + U(1)), np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))


def _spans(codes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Hashes of all spans of one code point, of two, and so on; none where the spans are longer than what there is."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(longest):
        n = max(len(codes) - k, 0)
        out = out[:n] + codes[k : k + n] * _SEEDS[k]
        yield out


def piece_table(pieces: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length, the ascending hashes of its pieces and their indices."""
    table = {}
    for length in sorted({len(p) for p in pieces}):
        own = [k for k, p in enumerate(pieces) if len(p) == length]
        *_, spans = _spans(_codes([pieces[k] for k in own])[0], length)
        order = np.argsort(spans[::length])
        table[length] = (spans[::length][order], np.array(own, np.int32)[order])
    return table


class Lattice:
    """All pieces found in a list of words: for each length, the piece that ends at each position, or -1."""

    def __init__(self, words: list[str], table: dict[int, tuple[np.ndarray, np.ndarray]]):
        codes, self.first = _codes(words)
        self.size = len(codes)
        lengths = np.diff(self.first)
        self.offset = np.arange(self.size) - np.repeat(self.first[:-1], lengths)
        self.order = np.argsort(self.offset, kind="stable")
        self.step = np.concatenate(([0], np.cumsum(np.bincount(self.offset, minlength=1)))) if self.size else np.zeros(1, np.int64)
        self.ends = {}
        for length, spans in enumerate(_spans(codes, max(table, default=0)), 1):
            found = np.full(self.size, -1, np.int32)
            if length in table and len(spans):
                hashes, index = table[length]
                seen = np.zeros(_SIEVE, bool)
                seen[hashes % U(_SIEVE)] = True
                maybe = np.flatnonzero(seen[spans % U(_SIEVE)])
                at = np.minimum(np.searchsorted(hashes, spans[maybe]), len(hashes) - 1)
                found[length - 1 + maybe] = np.where(hashes[at] == spans[maybe], index[at], -1)
                found[self.offset < length - 1] = -1
            if length in table:
                self.ends[length] = found

    def forward(self, probs: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Log of the summed probability up to each position, by language; ``probs`` is pieces x languages.

        A character that is no piece itself may be passed at probability ``floor``.
        """
        logs = np.zeros((self.size, probs.shape[1]))
        bare = self.ends[1] < 0
        for k in range(len(self.step) - 1):
            at = self.order[self.step[k] : self.step[k + 1]]
            # Sums are taken relative to the position before, so that words of any length neither vanish nor overflow.
            last = logs[at - 1] if k else np.zeros((len(at), probs.shape[1]))
            base = np.zeros((len(at), probs.shape[1]))
            base[bare[at]] = floor
            for length, found in self.ends.items():
                if length <= k + 1:
                    piece = found[at]
                    hit = np.flatnonzero(piece >= 0)
                    if len(hit):
                        before = logs[at[hit] - length] if length <= k else 0.0
                        base[hit] += probs[piece[hit]] * (1.0 if length == 1 else np.exp(before - last[hit]))
            logs[at] = np.log(base) + last
        return logs

    def words(self, probs: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Log probability of each word, by language."""
        return self.forward(probs, floor)[self.first[1:] - 1]

    def expected(self, probs: np.ndarray, floor: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of the words, in one language, words counted by weight."""
        alpha = self.forward(probs[:, None], np.array([floor]))[:, 0]
        whole = np.repeat(alpha[self.first[1:] - 1], np.diff(self.first))
        beta = np.full(self.size + 1, -np.inf)
        last = np.zeros(self.size, bool)
        last[self.first[1:] - 1] = True
        left = np.repeat(self.first[1:], np.diff(self.first)) - 1 - np.arange(self.size)
        logp = np.log(np.append(probs, 0.0) + 1e-300)
        out = np.zeros(len(probs) + 1)
        weights = np.repeat(weight, np.diff(self.first))
        beta[:-1][last] = 0.0
        for k in range(int(left.max(initial=0)) + 1):  # beta[i]: of what follows position i
            at = np.flatnonzero(left == k)
            if k:
                terms = []
                for length, found in self.ends.items():
                    to = np.minimum(at + length, self.size - 1)
                    fits = length <= k
                    terms.append(np.where((found[to] >= 0) & fits, logp[found[to]] + beta[to], -np.inf))
                nxt = np.minimum(at + 1, self.size - 1)
                bare = self.ends[1][nxt] < 0
                terms.append(np.where(bare, np.log(floor) + beta[nxt], -np.inf))
                beta[at] = np.logaddexp.reduce(terms, axis=0)
        for length, found in self.ends.items():
            at = np.flatnonzero(found >= 0)
            before = np.where(self.offset[at] >= length, alpha[at - length], 0.0)
            np.add.at(out, found[at], weights[at] * np.exp(before + logp[found[at]] + beta[at] - whole[at]))
        return out[:-1]


def _runs(words: list[str], columns: int) -> Iterator[slice]:
    """Cut a list of words so that their letters, times ``columns``, stay near CELLS; a single longer word comes alone."""
    most = max(1, CELLS // max(1, columns))
    ends = np.cumsum([len(w) + 1 for w in words])
    start = 0
    while start < len(words):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield slice(start, stop)
        start = stop


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    hashes: dict[int, tuple[np.ndarray, np.ndarray]]
    probs: np.ndarray
    floor: np.ndarray
    prior: np.ndarray
    #: Log probability a letter of the texts learnt from, by language.
    usual: np.ndarray

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Log probability of each word, by language."""
        out = np.zeros((len(words), len(self.languages)))
        short = [k for k, w in enumerate(words) if len(w) <= LONGEST_WORD]
        for run in _runs([words[k] for k in short], len(self.languages)):
            own = short[run]
            out[own] = Lattice([MARK + words[k] for k in own], self.hashes).words(self.probs, self.floor)
        for k, word in enumerate(words):
            if len(word) > LONGEST_WORD:
                out[k] = self.long_word(MARK + word)
        return out

    def long_word(self, word: str) -> np.ndarray:
        """The same of one word of any length: the sums at the last positions that a piece may reach back to are all that is kept."""
        reach = max(self.hashes, default=1)
        # Sums up to the positions before, relative to ``scale`` in each language: 0 before the word, 1 at its start.
        kept, scale = np.zeros((reach, len(self.languages))), np.zeros(len(self.languages))
        kept[-1] = 1.0
        for start in range(0, len(word), BLOCK):
            before = min(reach - 1, start)
            ends = Lattice([word[start - before : start + BLOCK]], self.hashes).ends
            size = min(BLOCK, len(word) - start)
            lengths = np.array([*ends, 1])
            # One row a way to reach a position: its pieces, and where none is the bare letter, passed at the floor.
            ways = np.stack([*(ends[n][before:] for n in ends), np.full(size, -1, np.int32)], axis=1)
            used = ways >= 0
            used[:, -1] = ends[1][before:] < 0 if 1 in ends else True
            at, kind = np.nonzero(used)
            probs = np.where((kind == len(lengths) - 1)[:, None], self.floor, self.probs[ways[at, kind]])
            source = reach + at - lengths[kind]
            first = np.searchsorted(at, np.arange(size + 1)).tolist()
            sums = np.concatenate((kept, np.zeros((size, len(self.languages)))))
            for k in range(size):
                lo, hi = first[k], first[k + 1]
                if hi == lo + 1:
                    sums[reach + k] = probs[lo] * sums[source[lo]]
                else:
                    sums[reach + k] = np.add.reduce(probs[lo:hi] * sums[source[lo:hi]], axis=0)
                if k % RESCALED == 0:
                    recent = sums[k + 1 : reach + k + 1]
                    top = recent.max(axis=0)
                    recent /= top
                    scale += np.log(top)
            kept = sums[size:]
        return np.log(kept[-1]) + scale

    def classify(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float | None]]:
        """Of each text the likeliest language, its posterior probability, and how far the log probability a letter in that
        language lies below what is usual there; ``und``, 0 and None without letters."""
        found = [letters(t) for t in texts]
        counts = np.array([len(w) for w in found], np.int64)
        if not counts.sum() or not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
        codes, uniques = pd.factorize(np.array([w for ws in found for w in ws], dtype=object))
        logs = self.word_logs(list(uniques))
        text = np.repeat(np.arange(len(texts)), counts)
        score = np.zeros((len(texts), len(self.languages)))
        step = max(1, CELLS // len(self.languages))
        for k in range(0, len(codes), step):
            own = text[k : k + step]
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            score[own[starts]] += np.add.reduceat(logs[codes[k : k + step]], starts, axis=0)
        size = np.array([sum(map(len, w)) for w in found], np.int64)
        raw, score = score, score + self.prior
        share = np.exp(score - score.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = score.argmax(axis=1)
        pred = [self.languages[b] if n else UNDETERMINED for b, n in zip(best, counts, strict=True)]
        odd = [float(self.usual[b] - r[b] / z) if n else None for b, r, z, n in zip(best, raw, size, counts, strict=True)]
        return pred, [float(s[b]) if n else 0.0 for s, b, n in zip(share, best, counts, strict=True)], odd


def _learn(words: list[str], weight: np.ndarray, table: dict[int, tuple[np.ndarray, np.ndarray]], pieces: int, floor: float, rounds: int) -> np.ndarray:
    """Piece probabilities of one language from its words and their counts."""
    p = np.full(pieces, 1.0 / pieces)
    lattices = [(Lattice([MARK + w for w in words[run]], table), weight[run]) for run in _runs(words, 1)]
    for _ in range(rounds):
        uses = 0.01 + sum(lattice.expected(p, floor, own) for lattice, own in lattices)
        p = uses / uses.sum()
    return p


def fit_languages(
    labelled: DataFrame, model_file: str, text_col: str = "text", lang_col: str = "lang", *,
    sample_docs: int = 2000, longest: int | None = None, rounds: int = 4, key_col: str = "doc_id",
) -> LanguageModel:
    """Learn piece probabilities from rows with a language and a text.

    Fits on a sample of at most about ``sample_docs`` whole documents a language, picked by a hash of the key. Words are counted
    and each language is learnt by executors; the driver gets the probabilities, and refuses a model beyond MODEL_BYTES (some
    6000 languages with a vocabulary of 22,000 pieces). A language without a letter has even probabilities.
    """
    rows = labelled.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(key_col).cast("string"), F.lit("lang")).alias("draw")
    ).where("lang is not null and text is not null")
    pieces = letter_pieces(model_file, longest)
    table = piece_table(pieces)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    languages = tuple(sorted(r["lang"] for r in sizes.select("lang").take(MODEL_BYTES // (8 * len(pieces)) + 1)))
    if len(languages) * len(pieces) * 8 > MODEL_BYTES:
        raise ValueError(f"a model of more than {MODEL_BYTES} bytes: more languages than it can hold")
    probs = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    floor, usual = 1e-7, np.full(len(languages), -np.inf)
    if languages:
        bar = F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.col("n")) * F.lit(float(1 << 31))
        drawn = rows.join(F.broadcast(sizes), "lang").where(F.pmod("draw", F.lit(1 << 31)) < bar)  # at most as many rows as a model may have languages
        words = drawn.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word"))
        shared = labelled.sparkSession.sparkContext.broadcast((table, len(pieces)))

        def learn(pdf: pd.DataFrame) -> pd.DataFrame:
            own, n = shared.value
            pairs = sorted((part, c) for run, c in zip(pdf["word"], pdf["n"], strict=True) for w in letters(run) for part in in_parts(w))
            known = [w for w, _ in pairs]
            weight = np.array([c for _, c in pairs], float)
            if not known:
                return pd.DataFrame(columns=["lang", "probs", "usual"])
            p = _learn(known, weight, own, n, floor, rounds)
            model = LanguageModel(("",), own, p[:, None], np.array([floor]), np.zeros(1), np.zeros(1))
            total = float(weight @ model.word_logs(known)[:, 0]) / float(weight @ np.array([len(w) for w in known]))
            return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "probs": [p], "usual": [total]})

        counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
        for row in counted.groupBy("lang").applyInPandas(learn, "lang string, probs array<double>, usual double").toLocalIterator():
            k = languages.index(row["lang"])
            probs[:, k], usual[k] = row["probs"], row["usual"]
    return LanguageModel(languages, table, probs, np.full(len(languages), floor), np.zeros(len(languages)), usual)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and oddness of every whole text.

    ``oddness`` is how far the mean log probability of a letter lies below that of the texts which the predicted language was
    learnt from: about 0 for its prose, more for letters that no known language explains. A null text, and one without a letter,
    is ``und`` with score 0 and null oddness, as is every text if no language was learnt. Ties go to the first language by code
    point. Repeated rows give repeated results; other columns are not read, but ``carry`` passes on the whole row as ``row``. Very
    long texts are scored in bounded memory, runs of any number of letters as one word each. The model, of vocabulary size times languages and at most MODEL_BYTES, is
    broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(cols: dict[str, list]) -> dict[str, list]:
        lang, score, odd = shared.value.classify(cols["text"])
        return {"doc_id": cols["id"], "lang_pred": lang, "score": score, "oddness": odd}

    rows = id_and_text(docs, id_col, text_col, carry)
    return map_slices(rows, kernel, "doc_id long, lang_pred string, score double, oddness double")
