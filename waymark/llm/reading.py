"""Reading level of documents: sentence classifiers over words and characters, aggregated and calibrated per document."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import repair, untagged

GRADES = 5
#: Most labelled documents that the models are fitted on; chosen by the smallest hash of the document's id.
FIT_DOCUMENTS = 4_000
#: And most characters of them together, in the same order; a document is fitted on whole or not at all.
FIT_CHARACTERS = 64_000_000
#: Of these, so many calibrate the documents' grades, each by a sentence model that has not seen it; and parts made of them.
CALIBRATION_DOCUMENTS, FOLDS = 1_000, 4
GRAM_BITS = 13
CACHED_WORDS = 300_000
_SPLIT = re.compile(r"(?<=[.?!;])[\s\"'”’)]+|[\r\n]+|(?<=:)\s|\s\|\s")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[,;:(]")


def sentences(text: str) -> list[str]:
    if "<" in text:
        text = re.sub(r"</(?:p|h\d|li|div)>|<br ?/?>", "\n", text)
        text = untagged(text)
    if "&" in text:
        import html

        text = html.unescape(text)
    if not text.isascii():
        text = repair(text).replace("­", "")
    return [s for s in _SPLIT.split(text) if s and not s.isspace()]


class _Later(dict):
    """The form of a token that is not its sentence's first, by token as written; computed once and dropped when there are too many."""

    def __missing__(self, w: str) -> str:
        if len(self) > CACHED_WORDS:
            self.clear()
        form = "^0" if w[0].isdigit() else w if w.islower() or not w[0].isalpha() else "^n"
        self[w] = form
        return form


_later = _Later()


def tokens(sentence: str) -> list[str]:
    """Lower-case words, marks and one length mark; names (capitals after the first word) become one placeholder."""
    found = _TOKEN.findall(sentence)
    out = [_later[w] for w in found]
    if found and out[0] == "^n":
        out[0] = found[0].lower()
    n = len(out)
    out.append(f"^l{min(n, 60) // 3}")
    return out


@lru_cache(maxsize=CACHED_WORDS)
def grams(word: str) -> list[int]:
    """Hashed character 3- to 5-grams of a word with its ends marked."""
    if word[0] == "^" or len(word) < 2:
        return []
    w = f"<{word}>"
    return [zlib.crc32(w[i : i + k].encode()) & ((1 << GRAM_BITS) - 1) for k in (3, 4, 5) for i in range(len(w) - k + 1)]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _adam(parameters: list[np.ndarray], gradient, steps: int, rate: float) -> None:
    m = [np.zeros_like(p) for p in parameters]
    v = [np.zeros_like(p) for p in parameters]
    for t in range(1, steps + 1):
        for p, g, a, b in zip(parameters, gradient(), m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)


class _Rows(dict):
    """Rows of words in a model's matrix; a new word gets one when it is first looked up."""

    def __init__(self, model: ReadingModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> int:
        row = self[word] = self.model._row(word)
        return row

    def __reduce__(self):
        return _Rows, (self.model,)


@dataclass
class Strength:
    """L2 penalties of the three models, and training steps."""

    word: float = 0.01
    gram: float = 0.005
    document: float = 0.3
    steps: int = 80


class ReadingModel:
    """Sentence scores are the mean of word vectors; a word's vector is its own weights plus those of its character grams."""

    def __init__(self, texts: list[str], target: np.ndarray, strength: Strength = Strength()):
        """``texts`` in random order: the first ``CALIBRATION_DOCUMENTS`` of them calibrate."""
        split = [[tokens(s) for s in sentences(t)] for t in texts]
        some = min(len(split), CALIBRATION_DOCUMENTS)
        # Copies of one text fall into one part.
        held = np.full(len(split), -1)
        held[:some] = [zlib.crc32(t.encode()) % FOLDS for t in texts[:some]]
        self._fit_words(split, target, strength)
        self.document = None
        if not texts:
            return
        # What a model says of documents that it was fitted on is too sure of itself to calibrate by.
        unseen: dict[int, np.ndarray] = {}
        for k in range(FOLDS):
            unseen |= self._said_unseen(k, split, target, held, strength)
        self._fit_documents([unseen[i] for i in range(some)], split[:some], target[:some])
        self._forget()

    def _said_unseen(self, k: int, split: list, target: np.ndarray, held: np.ndarray, strength: Strength) -> dict[int, np.ndarray]:
        """What a model that has not seen fold ``k`` says of its sentences; the model of all where that leaves nothing to fit on."""
        mine, rest = np.flatnonzero(held == k), np.flatnonzero(held != k)
        model = self
        if len(mine) and len(rest):
            model = object.__new__(ReadingModel)
            model._fit_words([split[i] for i in rest], target[rest], strength)
        return {int(i): model._sentence_probabilities(split[i]) for i in mine}

    def _fit_words(self, split: list[list[list[str]]], target: np.ndarray, strength: Strength) -> None:
        """The sentence model, with every sentence under the grade of its document."""
        self.strength = strength
        seen = Counter(w for d in split for w in {x for s in d for x in s})
        self.known = {w: k for k, w in enumerate(sorted(w for w, n in seen.items() if n > 1))}
        types = {w: k for k, w in enumerate(sorted(seen))}
        self.words = np.zeros((len(self.known), GRADES))
        self.grams = np.zeros((1 << GRAM_BITS, GRADES))
        self.bias = np.zeros(GRADES)
        flat = [[types[w] for w in s] for d in split for s in d]
        of_doc = np.repeat(np.arange(len(split)), [len(d) for d in split])
        soft = target[of_doc]
        weight = 1.0 / np.maximum(1, np.bincount(of_doc, minlength=len(split)))[of_doc] ** 0.5
        self._fit_sentences(flat, list(types), soft, weight)
        self._forget()

    def _fit_sentences(self, flat: list[list[int]], types: list[str], soft: np.ndarray, weight: np.ndarray) -> None:
        if not flat:
            return
        ids = np.concatenate([np.asarray(s) for s in flat])
        of = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
        size = np.bincount(of, minlength=len(flat)).astype(float)
        own = np.array([self.known.get(w, -1) for w in types])
        lists = [grams(w) for w in types]
        gram = np.array([g for x in lists for g in x], dtype=np.int64)
        gram_of = np.repeat(np.arange(len(types)), [len(x) for x in lists])
        many = np.maximum(1, np.bincount(gram_of, minlength=len(types))).astype(float)
        total, s = weight.sum(), self.strength

        # Sums over runs of sorted rows: tokens by sentence and by word, grams by word and by gram.
        def runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return np.unique(sorted_, return_index=True)

        inside = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        by_word = np.argsort(ids, kind="stable")
        word_of, word_runs = runs(ids[by_word])
        sentence_of = of[by_word]
        gram_words, gram_runs = runs(gram_of) if len(gram) else (gram_of, gram_of)
        by_gram = np.argsort(gram, kind="stable")
        gram_ids, gram_starts = runs(gram[by_gram]) if len(gram) else (gram, gram)
        gram_word = gram_of[by_gram]
        known = own >= 0

        def gradient() -> list[np.ndarray]:
            vector = np.zeros((len(types), GRADES))
            if len(gram):
                vector[gram_words] = np.add.reduceat(self.grams[gram], gram_runs) / many[gram_words, None]
            vector[known] += self.words[own[known]]
            p = _softmax(np.add.reduceat(vector[ids], inside) / size[:, None] + self.bias)
            d = (p - soft) * (weight / total)[:, None]
            by_type = np.zeros((len(types), GRADES))
            by_type[word_of] = np.add.reduceat((d / size[:, None])[sentence_of], word_runs)
            words = np.zeros_like(self.words)
            words[own[known]] = by_type[known]
            g = np.zeros_like(self.grams)
            if len(gram):
                g[gram_ids] = np.add.reduceat((by_type / many[:, None])[gram_word], gram_starts)
            return [words + s.word * 1e-4 * self.words, g + s.gram * 1e-4 * self.grams, d.sum(axis=0)]

        _adam([self.words, self.grams, self.bias], gradient, s.steps, 0.3)

    def _row(self, word: str) -> int:
        """Adds a word's vector to ``matrix``; gives its row."""
        if self.filled == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        g = grams(word)
        vector = self.grams[g].mean(axis=0) if g else np.zeros(GRADES)
        k = self.known.get(word)
        self.matrix[self.filled] = vector if k is None else vector + self.words[k]
        self.filled += 1
        return self.filled - 1

    def _sentence_probabilities(self, split: list[list[str]]) -> np.ndarray:
        if not split:
            return np.zeros((0, GRADES))
        if self.filled > CACHED_WORDS:
            self._forget()
        row = self.cache
        ids = [row[w] for s in split for w in s]
        size = np.array([len(s) for s in split])
        z = np.add.reduceat(self.matrix[ids], np.concatenate([[0], np.cumsum(size)[:-1]]))
        return _softmax(z / size[:, None] + self.bias)

    def _forget(self) -> None:
        self.cache = _Rows(self)
        self.matrix, self.filled = np.zeros((1024, GRADES)), 0

    @staticmethod
    def _profile(p: np.ndarray, split: list[list[str]]) -> np.ndarray:
        """What a document's sentences say: word-weighted mean, mean logarithm and spread of their distributions."""
        if not len(p):
            return np.zeros(2 * GRADES + 3)
        w = np.array([len(s) - 1.0 for s in split]) + 0.01
        w /= w.sum()
        mean, level = w @ p, p @ np.arange(GRADES)
        return np.concatenate([mean * 4, w @ np.log(p + 1e-3), [w @ level, level.mean(), np.sqrt(max(0.0, w @ level**2 - (w @ level) ** 2))]])

    def _fit_documents(self, inside: list[np.ndarray], split: list, target: np.ndarray) -> None:
        x = np.array([self._profile(p, d) for p, d in zip(inside, split)])
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.1
        x = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        self.document = np.zeros((x.shape[1], GRADES))
        n, decay = len(x), self.strength.document * 1e-2

        def gradient() -> list[np.ndarray]:
            return [x.T @ (_softmax(x @ self.document) - target) / n + decay * self.document]

        _adam([self.document], gradient, 300, 0.05)

    def probabilities(self, text: str) -> np.ndarray | None:
        """Calibrated distribution of a document's grade; none where it has no sentence."""
        split = [tokens(s) for s in sentences(text)]
        if not split:
            return None
        x = (self._profile(self._sentence_probabilities(split), split) - self.mean) / self.scale
        return _softmax((np.append(x, 1.0) @ self.document)[None, :])[0]

    def grade(self, text: str) -> int:
        return int(np.argmax(self.probabilities(text))) + 1


def fit_model(documents: DataFrame, labels: DataFrame, key: str, text: str, grade: str, most: int = FIT_DOCUMENTS, strength: Strength = Strength()) -> ReadingModel:
    """The model fitted on at most ``most`` labelled documents, those with the smallest hash of their key.

    Their texts have ``FIT_CHARACTERS`` together at most; those behind that many are left out. A document graded more than once
    has the share of its grades as target. Grades outside 1 to 5 and null texts are ignored.
    """
    graded = labels.where(F.col(grade).between(1, GRADES) & F.col(key).isNotNull()).groupBy(key)
    graded = graded.agg(*[F.avg((F.col(grade) == g).cast("double")).alias(f"_p{g}") for g in range(1, GRADES + 1)])
    turn = F.md5(F.col(key).cast("string"))
    chosen = graded.orderBy(turn, key).limit(most)
    # No more than ``most`` rows reach the running sum.
    rows = documents.select(key, text).where(F.length(text) > 0).join(F.broadcast(chosen), key).dropDuplicates([key])
    read = F.sum(F.length(text)).over(Window.orderBy(turn, key).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_read", read).where(F.col("_read") <= FIT_CHARACTERS).orderBy(turn, key).collect()
    target = np.array([[r[f"_p{g}"] for g in range(1, GRADES + 1)] for r in rows]).reshape(-1, GRADES)
    return ReadingModel([r[text] for r in rows], target, strength)


def reading_levels(documents: DataFrame, model: ReadingModel, key: str, text: str) -> DataFrame:
    """``(key, grade, level)`` for every row: the likeliest grade and the mean of the calibrated distribution.

    Null, empty and wordless texts get nulls; repeated rows come out as often; an empty input gives an empty result. Whole
    texts are read, in one pass without a shuffle; the model, whose size is bounded by ``FIT_DOCUMENTS``, is broadcast.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    slim = documents.select(F.col(key), F.col(text).alias("_t"))
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, grade int, level double"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            grades, levels = [], []
            for t in batch["_t"]:
                p = m.probabilities(t) if t and m.document is not None else None
                grades.append(None if p is None else int(np.argmax(p)) + 1)
                levels.append(None if p is None else float(p @ np.arange(1, GRADES + 1)))
            yield pd.DataFrame({key: batch[key], "grade": pd.array(grades, dtype="Int32"), "level": pd.array(levels, dtype="Float64")})

    return slim.mapInPandas(score, schema)
