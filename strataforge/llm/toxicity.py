"""Toxicity of documents, read through a noisy channel.

* **Language model.** Letter trigrams are counted over every text (28 classes: the letters a-z, other letters, and
  everything else as a boundary), so the table the driver receives has 28^3 rows whatever the corpus.
* **Deobfuscation.** Spans that look like disguised words (symbols, digits, separators or look-alikes of other scripts
  inside words, spaced letters, letters repeated three times or more) become lattices, whatever their length: a symbol
  may stand for letters, a separator for nothing or the end of a word, a run for one or two letters, each at a price. A
  Viterbi search keeps the best ``BEST`` readings under the trigram model, which are split into words.
* **Score.** Features are the distinct words of the text and of its readings and their beginnings of 4, 5 and 6
  letters. Labelled rows give each feature a log ratio of its rates in toxic and other documents; a document's evidence
  is the sum of its two strongest features, and a logistic curve fitted on rows that the ratios haven't seen turns it
  into a probability.

Labels are learned from rows with crc32(id) mod 4 != 2 only, at most ``SAMPLE`` of them, chosen by a hash of the id;
of a repeated id, one row, of the least digest of its text. The lexicon holds every feature of that sample that is
frequent and telling enough. Labels, language, source and id are no input of a score. Defined results: null and empty
texts have no evidence and the score of that; without labels every score is 0; an empty table gives an empty one; null
ids are not held out; repeated rows are scored each and alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, trimmed

#: Labelled rows at most that the lexicon and the curve are fitted on.
SAMPLE = 20_000
LEAST_COUNT, LEAST_RATIO, STRONGEST, CUT = 5, 3.0, 2, 0.3
CLASSES, BEST = 28, 3
PREFIXES = (4, 5, 6)

# fixed values: what symbols stand for, with the price of reading them so
STANDS_FOR = {
    "0": (("o", 1.0),), "1": (("i", 1.0), ("l", 1.2)), "2": (("z", 2.0),), "3": (("e", 1.0),), "4": (("a", 1.0),), "5": (("s", 1.0),),
    "6": (("g", 1.5), ("b", 2.0)), "7": (("t", 1.0),), "8": (("b", 1.2),), "9": (("g", 1.2),), "@": (("a", 0.7),), "$": (("s", 0.7),),
    "!": (("i", 1.0), ("l", 1.5)), "|": (("l", 1.0), ("i", 1.0)), "+": (("t", 1.0),), "€": (("e", 1.0),),
    "*": (("a", 2.0), ("e", 2.0), ("i", 2.0), ("o", 2.0), ("u", 2.0)),
}
# fixed values: letters of other scripts that look like Latin ones
LOOK_ALIKES = dict(zip("авеікмнорстухсѕјԁɡһ" "αεικνορτυχ", "abeikmhopctyxcsjdgh" "aeikvoptyx", strict=True))
STANDS_FOR |= {x: ((a, 0.3),) for x, a in LOOK_ALIKES.items()}
#: Full-width forms are the ASCII characters that they stand for.
_NARROW = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_SEPARATORS = " .-_*"
_DROP, _BREAK, _KEEP_TWO, _LETTER = 0.5, 0.5, 1.0, 2.6  # prices; the last is what a letter must earn back

_WORD = re.compile(r"[^\W\d_]+")
_ODD, _ALIKE = r"0-9@$!|+€*._\-", "".join(LOOK_ALIKES)
#: Runs of letters and symbols with a symbol or look-alike; and single letters in a row.
_MIXED = re.compile(rf"(?<![\w@$])[a-z]*+[{_ODD}{_ALIKE}][a-z{_ODD}{_ALIKE}]*+")
_SPACED = re.compile(r"(?<![\w@$])[a-z0-9@$!](?:[ .\-_*]{1,2}[a-z0-9@$!](?![\w@$])){2,}+")
_REPEATED = re.compile(r"([a-z])\1\1+")
_LATIN = re.compile("[a-z]")
_ONLY_LATIN = re.compile("[a-z]+")
_ONLY_ODD = re.compile("[@$!]{2,}")
#: Spans of at most so many characters are remembered; others are read each time.
_REMEMBERED = 40


def _classes() -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[97:123] = table[65:91] = np.arange(1, 27)
    table[128:] = 27
    return table


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter trigrams in all texts, an array of CLASSES^3."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _classes(), np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    c = table[np.frombuffer(f" {t} ".encode(), np.uint8)]
                    total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    rows = docs.select(text).mapInArrow(trimmed(count), "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(CLASSES**3)
    for r in rows:
        out[r["code"]] = r["n"]
    return out


class LetterModel:
    """Smoothed log probabilities of a class after two others."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(CLASSES, CLASSES, CLASSES) + 0.05
        two = c.sum(0)
        back = two / two.sum(1, keepdims=True)
        self.log = np.log((c + 2.0 * back[None]) / (c.sum(2, keepdims=True) + 2.0)).tolist()

    def read(self, span: str) -> list[str]:
        """The best readings of a disguised word."""
        steps: list[list[tuple[str, float]]] = []
        i = 0
        while i < len(span):
            ch, j = span[i], i
            while j < len(span) and span[j] == ch:
                j += 1
            if "a" <= ch <= "z":
                steps.append([(ch, 0.0)] if j - i == 1 else [(ch, 0.0), (ch * 2, 0.0 if j - i == 2 else _KEEP_TWO)])
            else:
                options = [(a, price) for a, price in STANDS_FOR.get(ch, ())]
                if ch in _SEPARATORS or not options:
                    options += [("", _DROP), (" ", _BREAK)]
                if j - i >= 2:
                    options += [(a * 2, price + (0.0 if ch in LOOK_ALIKES and j - i == 2 else _KEEP_TWO)) for a, price in options if a.strip()]
                steps.append(options)
            i = j
        # the best paths into each pair of classes; a path is (what came before, what it emits here)
        states: dict[tuple[int, int], list[tuple[float, tuple | None]]] = {(0, 0): [(0.0, None)]}
        for options in steps:
            after: dict[tuple[int, int], list[tuple[float, tuple | None]]] = {}
            for (a, b), paths in states.items():
                for emit, price in options:
                    x, y, gain = a, b, -price
                    for letter in emit:
                        z = 0 if letter == " " else ord(letter) - 96
                        gain += self.log[x][y][z] + (_LETTER if z else 0.0)
                        x, y = y, z
                    after.setdefault((x, y), []).extend([(s + gain, (w, emit) if emit else w) for s, w in paths])
            states = {k: sorted(p, key=_gain, reverse=True)[:BEST] if len(p) > 1 else p for k, p in after.items()}
        ended = sorted(((s + self.log[a][b][0], w) for (a, b), paths in states.items() for s, w in paths), key=_gain, reverse=True)
        return [_spelled(w) for _, w in ended[:BEST]]


def _gain(path: tuple) -> float:
    return path[0]


def _spelled(path: tuple | None) -> str:
    parts = []
    while path is not None:
        path, emit = path
        parts.append(emit)
    return "".join(reversed(parts))


class Reader:
    """Features of texts; keeps the readings of recent spans."""

    def __init__(self, model: LetterModel):
        self.model, self.held = model, {}

    def spans(self, lowered: str) -> set[str]:
        """What may be a disguised word, or several."""
        found = set()
        for m in _MIXED.finditer(lowered):
            s = m[0].strip("!|+*._-")
            # numbers and plain words say what they say
            if s and not _ONLY_LATIN.fullmatch(s) and (_LATIN.search(s) or _ONLY_ODD.fullmatch(s)):
                found.add(s)
        for m in _SPACED.finditer(lowered):
            if _LATIN.search(m[0]):
                found.add(m[0])
        last = 0
        for m in _REPEATED.finditer(lowered):
            a, b = m.span()
            if a < last:
                continue
            while a > last and "a" <= lowered[a - 1] <= "z":
                a -= 1
            while b < len(lowered) and "a" <= lowered[b] <= "z":
                b += 1
            found.add(lowered[a:b])
            last = b
        return found

    def readings(self, lowered: str) -> set[str]:
        found: set[str] = set()
        for s in self.spans(lowered):
            got = self.held.get(s)
            if got is None:
                got = {w for reading in self.model.read(s) for w in reading.split()}
                if len(s) <= _REMEMBERED:
                    if len(self.held) > 50_000:
                        self.held.clear()
                    self.held[s] = got
            found |= got
        return found

    def words(self, text: str | None) -> set[str]:
        if not text:
            return set()
        lowered = text.lower()
        if not lowered.isascii():
            lowered = lowered.translate(_NARROW)
        return set(_WORD.findall(lowered)) | self.readings(lowered)

    def features(self, text: str | None) -> set[str]:
        words = self.words(text)
        return words | {f"{w[:n]}*" for n in PREFIXES for w in words if len(w) > n}


def strongest(weights) -> float:
    return float(sum(sorted(weights, reverse=True)[:STRONGEST]))


class Scorer:
    """Evidence and probability of a text."""

    def __init__(self, counts: np.ndarray, weights: dict[str, float], curve: tuple[float, float]):
        self.reader, self.weights, self.curve = Reader(LetterModel(counts)), weights, curve
        self.whole = {w for w in weights if not w.endswith("*")}
        self.begins = {n: {w[:-1]: x for w, x in weights.items() if w.endswith("*") and len(w) == n + 1} for n in PREFIXES}

    def evidence(self, text: str | None) -> float:
        words = self.reader.words(text)
        found = [self.weights[w] for w in words & self.whole]
        for n, known in self.begins.items():
            found += [known[w] for w in {w[:n] for w in words if len(w) > n} & known.keys()]
        return strongest(found)

    def score(self, text: str | None) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, a * self.evidence(text) + b))))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _weights(rows: DataFrame) -> dict[str, float]:
    """Log ratios of the features of (label, features) rows that toxic documents have more often.

    Rows are a sample of at most SAMPLE, so the features are bounded by it, not by the corpus.
    """
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    p, n = totals.get(1, 0), totals.get(0, 0)
    if not p or not n:
        return {}
    counted = rows.select("label", F.explode("features").alias("f")).groupBy("f").agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("c"))
    ratio = F.ln((F.col("p") + 0.5) / (p + 1)) - F.ln((F.col("c") - F.col("p") + 0.5) / (n + 1))
    kept = counted.where(F.col("p") >= LEAST_COUNT).withColumn("x", ratio).where(F.col("x") > LEAST_RATIO)
    return {r["f"]: r["x"] for r in kept.collect()}


def _logistic(points: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a weak prior that keeps them finite."""
    x = np.array([p[0] for p in points])
    y = np.array([p[1] for p in points], float)
    m, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    prior = np.diag([0.5, 0.05])
    for _ in range(50):
        z = 1 / (1 + np.exp(-np.clip(m @ beta, -60, 60)))
        step = np.linalg.solve(m.T @ (m * (z * (1 - z))[:, None]) + prior, m.T @ (y - z) - prior @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Scorer:
    """A scorer from all texts (letters) and a bounded sample of labelled rows."""
    counts = trigram_counts(docs, text)
    known = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max("toxic").alias("label"))
    chosen = known.where(~held_out(F.col(key))).orderBy(F.xxhash64(key), key).limit(SAMPLE)
    # SAMPLE ids at most; a repeated id gives one row
    first = F.min(F.struct(F.xxhash64(text).alias("digest"), F.col(text).alias("text"))).alias("first")
    sample = docs.select(key, text).join(F.broadcast(chosen), key).groupBy(key, "label").agg(first).select(key, "label", F.col("first.text").alias(text))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(LetterModel(counts))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [sorted(reader.features(t)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.string())), part.column(2)], names=["label", "features", "seen"])

    seen = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(10)) < 6
    rows = cut(sample.select(F.col("label").cast("int").alias("label"), text, seen.alias("seen")).mapInArrow(trimmed(read), "label int, features array<string>, seen boolean"), "toxicity")
    half = _weights(rows.where("seen"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [strongest(half[f] for f in x if f in half) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["label", "e"])

    if half:
        # at most SAMPLE rows
        points = rows.where("not seen").select("label", "features").mapInArrow(trimmed(weigh), "label int, e double").collect()
        curve = _logistic([(r["e"], r["label"]) for r in points])
    else:
        curve = (0.0, -60.0)
    return Scorer(counts, _weights(rows), curve)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row."""
    scorer = fit(docs, labels, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [scorer.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[key, "score"])

    scored = docs.select(key, text).mapInArrow(trimmed(run), f"`{key}` bigint, score double")
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't predicted to be toxic, with their columns. Types of all columns must suit Arrow."""
    scorer = fit(docs, labels, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield batch.filter(pa.array([scorer.score(t) < CUT for t in texts], pa.bool_()))

    return docs.mapInArrow(trimmed(run), docs.schema)
