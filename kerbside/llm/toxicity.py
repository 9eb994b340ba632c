"""Toxicity of texts whose words may be disguised.

Noisy channel: a token that holds digits or symbols, one with doubled letters that is no known word, and single spaced-out
letters may be a disguised word. It becomes a lattice of characters, in which a sign may stand for a letter, a run of one
letter for one or two, spaces and separators for nothing. Viterbi decoding finds the likeliest spelling under a character language
model. Spaced letters are decoded from each of them on, as the first may be words of their own. The restored words then vote for the label by their stems' log odds.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from heapq import nlargest
from os.path import commonprefix

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import id_and_text, map_slices
from .durable import durable

# The letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h",
}
#: Separators that may stand between the letters of one word.
JOINS = "-_.,*~'`"
#: Costs of the channel, as log probabilities.
SIGN_COST, DROP_COST, KEEP_COST = -1.0, -0.7, -9.0
#: Learning documents that hold a word from which it is known as written.
KNOWN = 5
#: Letters that are decoded from each letter of a spaced run on, the first excepted, from which all are.
RUN = 16
#: Runs of a token after which the spelling that all paths share is set down.
SETTLED = 64
#: Longest token whose spelling is kept for the next time.
CACHED = 256
_ONE = r"(?:[^\W_]|[@$!|+(€£*#])"
#: What parts spaced letters. Stars do between letters only, and are signs elsewhere, so that each character has one reading.
_GAP = r"(?:[ \-_.,~]++|(?<=[^\W_])\*++(?=[^\W_]))"
#: A run's end: at most eight closing marks, then space or nothing.
_END = r"(?:[.,;:!?)\]\"']{0,8}+(?!\S))"
_LETTER = rf"{_ONE}(?={_GAP}|{_END})"
_SPACED = re.compile(rf"(?<![^\s\"'(\[]){_LETTER}(?:{_GAP}{_LETTER})++")
#: Three spaced letters; what may stand before them is matched first, as that is found fast.
_THREE = rf"{_LETTER}{_GAP}{_LETTER}{_GAP}{_LETTER}"
_FIRST, _LATER = re.compile(_THREE), re.compile(rf"[\s\"'(\[](?={_THREE})")
_PARTS = re.compile(_GAP)
_ENDED = re.compile(_END)
#: Letters between marks that are no letters' disguise.
_PLAIN = re.compile(r"(?:(?![@$€£])[^\w\s])*+([^\W\d_]*+)(?:(?![@$€£])[^\w\s])*+")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_SAME = re.compile(r"(.)\1*", re.DOTALL)
#: Numbers and amounts, which stay what they are.
_NUMBER = re.compile(r"[^\w\s]*+\d(?:[\d.,:;/+~x-]|[^\x00-\x7f\w])*+[^\w\s]*+")
_WORD = re.compile(r"[^\W\d_]+")


def grams_of(word: str) -> Iterator[str]:
    """A word's trigrams of characters, and the bigram that each starts with; the word is marked at its ends."""
    text = f"^^{word}$"
    for k in range(2, len(text)):
        yield text[k - 2 : k + 1]
        yield text[k - 2 : k]


class CharModel:
    """Add-one-smoothed interpolated trigrams of characters over words."""

    def __init__(self, words: Counter):
        grams: Counter = Counter()
        for word, n in words.items():
            for gram in grams_of(word):
                grams[gram] += n
        self._set(grams, {w for w, n in words.items() if n >= KNOWN and _DOUBLED.search(w)})

    @classmethod
    def from_counts(cls, grams: dict[str, int], known: set[str]) -> CharModel:
        """From counts of ``grams_of`` all words, and the words with doubled letters of KNOWN documents or more; of others none is asked."""
        model = cls.__new__(cls)
        model._set(Counter(grams), known)
        return model

    def _set(self, grams: Counter, known: set[str]) -> None:
        self.three = Counter({g: n for g, n in grams.items() if len(g) == 3})
        self.two = Counter({g: n for g, n in grams.items() if len(g) == 2})
        self.known = known
        self.size = len(set().union(*self.three) - set("^$")) + 2
        self.cache: dict[str, float] = {}

    def cost(self, before: str, char: str) -> float:
        """Log probability of ``char`` after the two characters ``before``."""
        gram = before + char
        if gram not in self.cache:
            if len(self.cache) > 1 << 18:
                self.cache.clear()
            self.cache[gram] = float(np.log((self.three[gram] + 0.2) / (self.two[before] + 0.2 * self.size)))
        return self.cache[gram]


@lru_cache(1 << 14)
def _ways(char: str, n: int) -> list[tuple[str, float]]:
    """What a run of one, two or more (3) of a character may stand for."""
    ways: dict[str, float] = {}
    if char.isalpha():
        ways[char] = 0.0 if n == 1 else -0.5
        if n > 1:
            ways[char * 2] = 0.0 if n == 2 else -0.5
    for letter in SIGNS.get(char, ""):
        ways[letter] = SIGN_COST
        if n > 1:
            ways[letter * 2] = SIGN_COST
    if not char.isalnum():
        ways[""] = DROP_COST if char in JOINS or char.isspace() else KEEP_COST / 3
    elif char.isdigit():
        ways[""] = KEEP_COST
    return list(ways.items()) or [("", KEEP_COST)]


def lattice(token: str) -> Iterator[list[tuple[str, float]]]:
    """For each run of one character, the strings that it may stand for, with the channel's log probability."""
    for run in _SAME.finditer(token):
        yield _ways(run[1], min(run.end() - run.start(), 3))


def spaced(text: str) -> Iterator[list[str]]:
    """The letters of each run of three or more single letters or signs, in one pass over the text.

    A run that something else is glued to ends at its last space before.
    """
    if not _FIRST.match(text) and not _LATER.search(text):
        return
    for m in _SPACED.finditer(text):
        run = m[0]
        if not _ENDED.match(text, m.end()):
            run = run[: run.rfind(" ")].rstrip(" -_.,~*") if " " in run else ""
        parts = [p for p in _PARTS.split(run) if p]
        if len(parts) > 2:
            yield parts


def decode(token: str, model: CharModel) -> str:
    """The likeliest spelling of a token of any length: Viterbi over its lattice, with the last two characters as the state.

    What the spellings of all states begin with can change no more and is set down from time to time, so that paths stay short.
    """
    token, head = token.lower(), ""
    if token.isalpha():  # letters before the first doubled one stand for themselves
        doubled = _DOUBLED.search(token)
        head = token[: doubled.start()] if doubled else token
    best: dict[str, tuple[float, str]] = {f"^^{head}"[-2:]: (0.0, head)}
    done: list[str] = []
    priced = model.cache.get
    for k, ways in enumerate(lattice(token[len(head) :]), 1):
        if len(best) == len(ways) == 1:  # one path: what it costs changes no choice
            (state, (_, text)), (chars, _) = *best.items(), *ways
            best = {(state + chars)[-2:]: (0.0, text + chars)}
            continue
        step: dict[str, tuple[float, str]] = {}
        for state, (score, text) in best.items():
            for chars, channel in ways:
                total, at = score + channel, state
                for c in chars:
                    gram = at + c
                    price = priced(gram)
                    total += model.cost(at, c) if price is None else price
                    at = gram[1:]
                if at not in step or total > step[at][0]:
                    step[at] = total, text + chars
        best = step
        if k % SETTLED == 0:
            shared = commonprefix([text for _, text in best.values()])
            done.append(shared)
            best = {state: (score, text[len(shared) :]) for state, (score, text) in best.items()}
    done.append(max((score + model.cost(state, "$"), text) for state, (score, text) in best.items())[1])
    return "".join(done)


class Restorer:
    """Restored words of texts; keeps a bounded number of tokens it has read."""

    def __init__(self, model: CharModel):
        self.model = model
        self.cache: dict[str, str] = {}
        #: Tokens that are one word as written, and the readings of others.
        self.plain: set[str] = set()
        self.read: dict[str, tuple[tuple[str, ...], str | None, str | None]] = {}

    def _decoded(self, token: str) -> str:
        if len(token) > CACHED:
            return decode(token, self.model)
        if token not in self.cache:
            if len(self.cache) > 1 << 16:
                self.cache.clear()
            self.cache[token] = decode(token, self.model)
        return self.cache[token]

    def _reading(self, token: str) -> tuple[tuple[str, ...], str | None, str | None]:
        """A token's words as written, that of them which is not to vote beside the restored word, and the restored word."""
        plain = _PLAIN.fullmatch(token)
        if plain:
            word = plain[1]
            if word in self.model.known or not _DOUBLED.search(word):
                return ((word,) if word else ()), None, None
            return (), word, self._decoded(word)
        return tuple(_WORD.findall(token)), None, None if _NUMBER.fullmatch(token) else self._decoded(token)

    def _read(self, token: str) -> tuple[tuple[str, ...], str | None, str | None]:
        """The same, kept for the next time where it is short."""
        if token in self.read:
            return self.read[token]
        if token.isalpha() and not _DOUBLED.search(token):
            reading = (token,), None, None
            if len(token) <= CACHED:
                if len(self.plain) > 1 << 17:
                    self.plain.clear()
                self.plain.add(token)
            return reading
        reading = self._reading(token)
        if len(token) <= CACHED:
            if len(self.read) > 1 << 16:
                self.read.clear()
            self.read[token] = reading
        return reading

    def words(self, text: str | None) -> set[str]:
        """Distinct words of a text, lower-cased: as written, and as restored where a token may be disguised."""
        text = (text or "").lower()
        found: set[str] = set()
        for signs in spaced(text):
            # Signs without a letter anywhere near are figures, not a word.
            lettered = [k for k, sign in enumerate(signs) if sign.isalpha()]
            if not lettered:
                continue
            found.add(self._decoded(" ".join(signs)))
            for k in range(1, len(signs) - 2):
                after = bisect_left(lettered, k)
                if after < len(lettered) and lettered[after] < k + RUN:
                    found.add(self._decoded(" ".join(signs[k : k + RUN])))
            if len(signs) > 3:  # longer words vote by their first letters, whatever follows
                found.add(self._decoded(" ".join(signs[-4:-1])))
        tokens = set(text.split())
        written = tokens & self.plain
        dropped: list[str] = []
        for token in tokens - written:
            own, gone, restored = self._read(token)
            written.update(own)
            if gone is not None:  # one word, which is not to vote twice
                dropped.append(gone)
            if restored is not None:
                found.add(restored)
        return found.union(written.difference(dropped))


def stems(word: str) -> list[str]:
    """The keys by which a word votes: itself and its first four and five letters."""
    return [word, *(f"{word[:n]}~" for n in (4, 5) if len(word) >= n)]


@dataclass(frozen=True)
class ToxicityModel:
    odds: dict[str, float]
    slope: float
    offset: float
    chars: CharModel = field(repr=False)

    @cached_property
    def starts(self) -> dict[str, float]:
        """Log odds of the first four and five letters that vote."""
        return {stem[:-1]: gain for stem, gain in self.odds.items() if stem[-1:] == "~"}

    def evidence(self, words: set[str]) -> float:
        """Sum of the three strongest words' log odds."""
        odds, starts = self.odds, self.starts
        hits = [w for w in words if w in odds or w[:4] in starts or w[:5] in starts]
        votes = [max(0.0, odds.get(w, 0.0), starts.get(w[:4], 0.0), starts.get(w[:5], 0.0)) for w in hits]
        return float(sum(nlargest(3, votes)))


def _log_odds(held: dict[str, tuple[int, int]], n1: float, n0: float, least: int, least_odds: float) -> dict[str, float]:
    """Smoothed log odds of the stems that vote, from the documents of label 1 and of label 0 that hold each."""
    odds = {}
    for stem, (ones, zeros) in held.items():
        if ones >= least:
            gain = np.log((ones + 0.5) / (n1 + 1)) - np.log((zeros + 0.5) / (n0 + 1))
            if gain >= least_odds:
                odds[stem] = float(gain)
    return odds


def _scaled(odds: dict[str, float], chars: CharModel, n1: float, n0: float, sums: Callable[[float, float], np.ndarray]) -> ToxicityModel:
    """The model whose score is a logistic function of the evidence x, lightly penalised; with one label only, that label's.

    ``sums`` gives, for a slope and an offset, the documents' sums of (p - label) x, p - label, v x x, v x and v, where v = p (1 - p).
    Newton steps, until they change nothing.
    """
    if not n1 or not n0:
        return ToxicityModel(odds, 0.0, 50.0 if n1 else -50.0, chars)
    w = np.zeros(2)
    for _ in range(50):
        gx, g, vxx, vx, v = sums(float(w[0]), float(w[1])) / (n1 + n0)
        step = np.linalg.solve(np.array([[vxx, vx], [vx, v]]) + 1e-4 * np.eye(2), np.array([gx, g]) + 1e-4 * w)
        w = w - step
        if np.abs(step).max() < 1e-11:
            break
    return ToxicityModel(odds, float(w[0]), float(w[1]), chars)


def fit_toxicity(sample: list[tuple[int, str, int]], *, least: int = 5, least_odds: float = 2.0) -> ToxicityModel:
    """Learn the character model, the stems' log odds and the scale of the score from (id, text, label) rows in memory.

    A stem votes if at least ``least`` documents of label 1 hold it and its smoothed log odds reach ``least_odds``. Without
    documents of label 1, all score 0.
    """
    words = Counter(w for _, t, _ in sample for w in set(_WORD.findall((t or "").lower())))
    chars = CharModel(words)
    restorer = Restorer(chars)
    bags = [restorer.words(t) for _, t, _ in sample]
    label = np.array([y for _, _, y in sample], float)
    held: dict[str, list[int]] = {}
    for bag, own in zip(bags, label, strict=True):
        for stem in {s for w in bag for s in stems(w)}:
            held.setdefault(stem, [0, 0])[0 if own else 1] += 1
    odds = _log_odds(held, label.sum(), len(label) - label.sum(), least, least_odds)
    model = ToxicityModel(odds, 0.0, 0.0, chars)
    x = np.array([model.evidence(b) for b in bags])

    def sums(slope: float, offset: float) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -50, 50)))
        v = p * (1 - p)
        return np.array([((p - label) * x).sum(), (p - label).sum(), (v * x * x).sum(), (v * x).sum(), v.sum()])

    return _scaled(odds, chars, label.sum(), len(label) - label.sum(), sums)


def fit_toxicity_rows(rows: DataFrame, *, least: int = 5, least_odds: float = 2.0) -> ToxicityModel:
    """The same from a DataFrame (text, label) of any number of rows, whose texts stay on the executors, whatever their length.

    The driver gets counts of character trigrams, the known words with doubled letters, the stems that vote, and sums over documents.
    """
    rows = durable(rows.select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label")))
    context = rows.sparkSession.sparkContext

    def written(cols: dict[str, list]) -> dict[str, list]:
        found: Counter = Counter()
        for t in cols["text"]:
            found.update(set(_WORD.findall(t.lower())))
        return {"word": list(found), "n": list(found.values())}

    words = durable(map_slices(rows.select("text"), written, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))

    def cut(cols: dict[str, list]) -> dict[str, list]:
        grams: Counter = Counter()
        for word, n in zip(cols["word"], cols["n"], strict=True):
            for gram in grams_of(word):
                grams[gram] += n
        return {"gram": list(grams), "n": list(grams.values())}

    def doubled(cols: dict[str, list]) -> dict[str, list]:
        return {"word": [w for w in cols["word"] if _DOUBLED.search(w)]}

    grams = map_slices(words, cut, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    known = {r["word"] for r in map_slices(words.where(F.col("n") >= KNOWN).select("word"), doubled, "word string").toLocalIterator()}
    chars = CharModel.from_counts({r["gram"]: r["n"] for r in grams.toLocalIterator()}, known)
    shared = context.broadcast(chars)

    def restored(cols: dict[str, list]) -> dict[str, list]:
        restorer = Restorer(shared.value)
        return {"words": [list(restorer.words(t)) for t in cols["text"]], "label": cols["label"]}

    bags = durable(map_slices(rows, restored, "words array<string>, label int"))

    def held_by(cols: dict[str, list]) -> dict[str, list]:
        stem, ones, zeros = [], [], []
        for label in (0, 1):
            whole, starts = Counter(), Counter()
            for bag in (b for b, y in zip(cols["words"], cols["label"], strict=True) if y == label):
                whole.update(bag)
                starts.update({w[:4] for w in bag if len(w) > 3})
                starts.update({w[:5] for w in bag if len(w) > 4})
            stem += [*whole, *(f"{w}~" for w in starts)]
            counts, none = [*whole.values(), *starts.values()], [0] * (len(whole) + len(starts))
            ones += counts if label else none
            zeros += none if label else counts
        return {"stem": stem, "ones": ones, "zeros": zeros}

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)

    def voters(cols: dict[str, list]) -> dict[str, list]:
        held = dict(zip(cols["stem"], zip(cols["ones"], cols["zeros"], strict=True), strict=True))
        odds = _log_odds(held, n1, n0, least, least_odds)
        return {"stem": list(odds), "gain": list(odds.values())}

    sums = map_slices(bags, held_by, "stem string, ones long, zeros long").groupBy("stem").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    odds = {r["stem"]: r["gain"] for r in map_slices(sums.where(F.col("ones") >= least), voters, "stem string, gain double").toLocalIterator()}
    voting = context.broadcast(ToxicityModel(odds, 0.0, 0.0, chars))

    def weighed(cols: dict[str, list]) -> dict[str, list]:
        return {"x": [voting.value.evidence(set(bag)) for bag in cols["words"]], "y": cols["label"]}

    evidence = durable(map_slices(bags, weighed, "x double, y int").groupBy("x", "y").agg(F.count("*").alias("n")))
    return _scaled(odds, chars, n1, n0, lambda slope, offset: _evidence_sums(evidence, slope, offset))


def _evidence_sums(evidence: DataFrame, slope: float, offset: float) -> np.ndarray:
    """The sums that ``_scaled`` asks for, over (x, y, n): evidence, label, documents. Summed as decimals, so that no order of rows shows."""
    z = F.least(F.greatest(F.col("x") * slope + offset, F.lit(-50.0)), F.lit(50.0))
    rows = evidence.select("x", "y", "n", (1 / (1 + F.exp(-z))).alias("p")).withColumn("v", F.col("p") * (1 - F.col("p")))
    x, v, gap = F.col("x"), F.col("v"), F.col("p") - F.col("y")
    terms = [gap * x, gap, v * x * x, v * x, v]
    row = rows.agg(*(F.sum((t * F.col("n")).cast("decimal(38,18)")).cast("double").alias(f"s{k}") for k, t in enumerate(terms))).first()
    return np.array(row, float)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text.

    Null and empty texts hold no words and get the score of no evidence. Repeated rows give repeated results, equal evidence equal
    scores; other columns are not read. Time grows with a text's length, whatever its characters. The model, which holds no row
    but grows with the vocabulary it was learnt from, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(cols: dict[str, list]) -> dict[str, list]:
        own = shared.value
        restorer = Restorer(own.chars)  # goes with its slice: kept for a task, those of finished tasks filled a worker's memory
        x = np.array([own.evidence(restorer.words(t)) for t in cols["text"]])
        score = 1 / (1 + np.exp(-np.clip(own.slope * x + own.offset, -500, 500)))
        return {"doc_id": cols["id"], "score": score}

    return map_slices(id_and_text(docs, id_col, text_col), kernel, "doc_id long, score double")
