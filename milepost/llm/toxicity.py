"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; the model of each takes the words of the text
and the probabilities of all earlier categories. For training, those probabilities are
out-of-fold predictions: every row gets them from models that have not seen it. Scoring
feeds the chain its own probabilities.

The features are words (runs of letters and digits, ASCII lower case) and their beginnings
of ``STEMS`` bytes, which stand for all words of a root; a feature's value is the logarithm
of its count. The vocabulary is what ``MIN_TEXTS`` or more training texts have, kept by
whole hashes. The chain is fitted on
the driver on a bounded sample (``CLASS_ROWS`` rows and ``quality_cnn.TRAIN_BYTES`` bytes of each class); all
rows are scored. Labels say only whether a text is toxic; the categories before the last are
toxic texts with words of a kind (``KINDS``).

Null and empty texts have no words and score by the intercepts; repeated rows score alike;
without both labels every probability is 0. An empty table gives an empty result. Columns of
the input are kept, those with a result's name are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import pieces, text_bytes
from milepost.llm.icws_dedup import Words
from milepost.llm.quality_cnn import training_rows

# Kinds of toxic words, as fixed values.
KINDS = {
    "insult": "idiot moron loser clown scum fool jerk bastard",
    "contempt": "stupid worthless pathetic disgusting trash garbage useless",
}
CATEGORIES = [*KINDS, "severe", "toxic"]
SEVERE_WORDS = 3  # different words of any kind
FOLDS = 3
MIN_TEXTS = 5
CLASS_ROWS = 1_200
SELECTED = 4_000
STEMS = (5, 6, 7)
STEPS, RATE, PENALTY = 80, 0.15, 1e-3
PART_BYTES = 1_000_000


def category_labels(text: str, toxic: int) -> list[int]:
    """Targets of the chain for one labelled text."""
    words = set(re.findall(r"\w+", text.lower()))
    hits = [words & set(kind.split()) for kind in KINDS.values()]
    kinds = [int(bool(toxic and hit)) for hit in hits]
    return [*kinds, int(bool(toxic and len(set.union(*hits)) >= SEVERE_WORDS)), int(toxic)]


def features(words: Words, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all features of a batch of texts, and the text of each."""
    hashes, texts = [], []
    for size in (None, *STEMS):
        found, bounds = words.of(flat, at, size)
        hashes.append(found ^ np.uint64(size or 0))
        texts.append(np.repeat(np.arange(len(at) - 1), np.diff(bounds)))
    return np.concatenate(hashes), np.concatenate(texts)


class Sparse:
    """Vocabulary features of each text: places in the vocabulary, the text of each, and values."""

    def __init__(self, n: int, hashes: np.ndarray, text: np.ndarray, vocabulary: np.ndarray):
        self.n = n
        if len(vocabulary) and len(hashes):
            place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            known = vocabulary[place] == hashes
            pair, count = np.unique(text[known] * len(vocabulary) + place[known], return_counts=True)
            self.text, self.place = pair // len(vocabulary), pair % len(vocabulary)
            self.value = np.log1p(count)
        else:
            self.text = self.place = np.zeros(0, np.int64)
            self.value = np.zeros(0)

    def rows(self, keep: np.ndarray) -> Sparse:
        out = Sparse.__new__(Sparse)
        number, inside = np.cumsum(keep) - 1, keep[self.text]
        out.n, out.value = int(keep.sum()), self.value[inside]
        out.text, out.place = number[self.text[inside]], self.place[inside]
        return out

    def keep(self, entries: np.ndarray) -> Sparse:
        out = Sparse.__new__(Sparse)
        out.n, out.text, out.place, out.value = self.n, self.text[entries], self.place[entries], self.value[entries]
        return out

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, weights[self.place] * self.value, minlength=self.n)

    def back(self, errors: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.place, errors[self.text] * self.value, minlength=size)


def probability(model: dict, x: Sparse, earlier: np.ndarray) -> np.ndarray:
    logit = x.dot(model["words"]) + earlier @ model["chain"] + model["shift"]
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_linear(x: Sparse, earlier: np.ndarray, y: np.ndarray, size: int) -> dict:
    """Logistic regression by Adam over all rows, on the features that tell most of ``y``."""
    have, with_y = np.bincount(x.place, minlength=size), np.bincount(x.place, y[x.text], minlength=size)
    expected = have * y.mean()
    told = (with_y - expected) ** 2 / np.maximum(expected, 1e-9)
    best = np.zeros(size, bool)
    best[np.argsort(-told, kind="stable")[:SELECTED]] = True
    x = x.keep(best[x.place])
    model = {"words": np.zeros(size), "chain": np.zeros(earlier.shape[1]), "shift": np.full(1, -1.0)}
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        error = (probability(model, x, earlier) - y) / max(1, x.n)
        grads = {"words": x.back(error, size), "chain": error @ earlier, "shift": error.sum(keepdims=True)}
        for k, g in grads.items():
            g = g + (PENALTY * model[k] if k != "shift" else 0)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            model[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-9)
    return model


def fit(texts: list[bytes], toxic: list[int]) -> dict | None:
    """The chain; None unless both labels occur."""
    if len(set(toxic)) < 2:
        return None
    y = np.array([category_labels(t.decode("utf-8", "replace"), z) for t, z in zip(texts, toxic, strict=True)], float)
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes, text = features(Words(), np.frombuffer(b"".join(texts), np.uint8), at)
    found, where = np.unique(hashes, return_inverse=True)
    pairs = np.unique(where.astype(np.int64) * len(texts) + text)
    vocabulary = found[np.bincount(pairs // len(texts), minlength=len(found)) >= MIN_TEXTS]
    x, size, fold = Sparse(len(texts), hashes, text, vocabulary), len(vocabulary), np.arange(len(texts)) % FOLDS
    unseen, models = np.zeros((len(texts), 0)), []
    for j in range(len(CATEGORIES)):
        models.append(fit_linear(x, unseen, y[:, j], size))
        out = np.zeros(len(texts))
        for f in range(FOLDS):
            model = fit_linear(x.rows(fold != f), unseen[fold != f], y[fold != f, j], size)
            out[fold == f] = probability(model, x.rows(fold == f), unseen[fold == f])
        unseen = np.column_stack([unseen, out])
    return {"vocabulary": vocabulary, "models": models}


def chained(chain: dict, x: Sparse) -> np.ndarray:
    """Probabilities of all categories, each model fed what the ones before it say."""
    out = np.zeros((x.n, 0))
    for model in chain["models"]:
        out = np.column_stack([out, probability(model, x, out)])
    return out


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"):
    """Chain fitted on up to ``CLASS_ROWS`` toxic and as many other labelled texts."""
    texts, marks = [], []
    for value in (0, 1):
        some, own = training_rows(docs, labels.filter(F.col(label) == value), key, text, label, CLASS_ROWS)
        texts, marks = texts + some, marks + own
    order = np.random.default_rng(5).permutation(len(texts)).tolist()
    return fit([texts[i] for i in order], [marks[i] for i in order])


def score(docs: DataFrame, chain: dict | None, text: str = "text") -> DataFrame:
    """The input with the probability of each category (``p_`` and its name)."""
    names = [f"p_{c}" for c in CATEGORIES]
    docs = docs.drop(*names)
    if chain is None:
        return docs.withColumns({x: F.lit(0.0) for x in names})
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # grows with the bounded sample only
    columns = docs.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in pieces(batch, text, PART_BYTES):
                found = features(words, *text_bytes(part.column(text)))
                values = chained(shared.value, Sparse(part.num_rows, *found, shared.value["vocabulary"]))
                added = [pa.array(values[:, j]) for j in range(len(names))]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*columns, *names])

    fields = [f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema]
    return docs.mapInArrow(scored, ", ".join([*fields, *(f"{x} double" for x in names)]))
