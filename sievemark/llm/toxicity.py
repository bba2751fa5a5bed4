"""Toxicity by a classifier chain of linear models.

The labels say only toxic or not, so the chain predicts finer categories first:
``abusive`` (toxic, with a word that marks toxic documents), ``sustained`` (toxic,
with at least three such words) and ``toxic`` itself. Each model sees which
discriminating words and beginnings of words a document holds, how many marker words,
and the probabilities of the earlier categories. In training those come from folds that did not see the
document: a fold's words, markers and targets are chosen without it too, so later models learn how far
earlier ones can be trusted.

Training takes at most ``MOST_ROWS`` labelled documents, chosen by a hash of the id.

Edge cases: a null text counts as empty; a document without known words gets the
base probability; labels that are null teach nothing, and of several labels for one
document the largest counts, of several texts with one id the first in order; without both classes nothing is toxic. Equal texts get
equal scores. Extra columns pass through unless they bear an output's name. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

#: Labelled documents to learn from, words that a model looks at, folds, and the penalty on weights.
MOST_ROWS, MOST_WORDS, FOLDS, L2 = 5000, 160, 5, 0.3
#: Lengths of a longer word's beginnings that also count as words, for inflected forms; words that are remembered.
STEMS, MOST_KNOWN = (4, 5, 6), 200_000
#: A marker word occurs in so many training documents, of which so large a share is toxic for sure (95 %).
MARKER_DOCUMENTS, MARKER_SHARE = 5, 0.7
CATEGORIES = ("abusive", "sustained", "toxic")
THRESHOLD = 0.5
WORD = re.compile(r"[^\W\d_]+")


def forms(word: str) -> list[str]:
    """The word and its beginnings, marked by a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def _wilson(good: int, n: int, z: float = 1.96) -> float:
    p = good / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


@dataclass
class Model:
    """Words looked at, which of them mark toxic documents, and for each category its weights (last: the constant)."""

    words: dict[str, int] = field(default_factory=dict)
    markers: frozenset[str] = frozenset()
    weights: list[np.ndarray] = field(default_factory=list)

    def features(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.words) + 1))
        known: dict[str, tuple[list[int], bool]] = {}
        for i, t in enumerate(texts):
            hits = 0
            for w in WORD.findall(t.lower()):
                entry = known.get(w)
                if entry is None:
                    if len(known) >= MOST_KNOWN:
                        known.clear()
                    f = forms(w)
                    entry = known[w] = ([self.words[k] for k in f if k in self.words], any(k in self.markers for k in f))
                if entry[0]:
                    x[i, entry[0]] = 1.0
                hits += entry[1]
            x[i, -1] = math.log1p(hits)
        return x

    def probabilities(self, texts: list[str]) -> np.ndarray:
        x = self.features(texts)
        for w in self.weights:
            x = np.column_stack([x, _probability(x, w)])
        return x[:, len(self.words) + 1 :]


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps on the penalised likelihood; the constant is not penalised."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], L2)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        v = p * (1 - p) + 1e-9
        move = np.linalg.solve((x * v[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += move / max(1.0, np.abs(move).max() / 4)
        if np.abs(move).max() < 1e-6:
            break
    return w


class Corpus:
    """The training documents' words and their forms as numbered columns, forms of too few documents left out."""

    def __init__(self, texts: list[str], toxic: list[int]):
        unique = dict(zip(texts, toxic, strict=True))  # copies would leak between folds
        self.y = np.array(list(unique.values()), dtype=float)
        # Compact arrays: the driver holds all of it at once.
        vocabulary, numbers, spelled = {}, {}, []
        word, times, begins = array("i"), array("i"), array("i", [0])
        for t in unique:
            for w, n in Counter(WORD.findall(t.lower())).items():
                if w not in vocabulary:
                    vocabulary[w] = len(vocabulary)
                    spelled.append(tuple(numbers.setdefault(f, len(numbers)) for f in forms(w)))
                word.append(vocabulary[w])
                times.append(n)
            begins.append(len(word))
        held, sizes = array("i"), array("i")
        for i in range(len(self.y)):
            own = set().union(*(spelled[w] for w in word[begins[i] : begins[i + 1]]))
            held.extend(own)
            sizes.append(len(own))
        form, doc = np.array(held, dtype=np.int32), np.repeat(np.arange(len(self.y), dtype=np.int32), np.array(sizes, dtype=np.int32))
        often = np.bincount(form, minlength=len(numbers)) >= MARKER_DOCUMENTS
        place = np.cumsum(often) - 1
        #: Each document with each form that it holds, once.
        self.held_doc, self.held_form = doc[often[form]], place[form[often[form]]].astype(np.int32)
        self.names = np.array(list(numbers), dtype=object)[often]
        self.n_words = len(vocabulary)
        of_word = np.repeat(np.arange(self.n_words, dtype=np.int32), [len(x) for x in spelled])
        of_form = np.array([f for x in spelled for f in x], dtype=np.int32)
        self.of_word, self.of_form = of_word[often[of_form]], place[of_form[often[of_form]]].astype(np.int32)
        self.doc = np.repeat(np.arange(len(self.y), dtype=np.int32), np.diff(np.array(begins)))
        self.word, self.times = np.array(word, dtype=np.int32), np.array(times, dtype=np.int32)

    def chosen(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the documents ``rows`` alone: the forms that tell most, and which forms mark toxic documents."""
        seen = rows[self.held_doc]
        n = np.bincount(self.held_form[seen], minlength=len(self.names))
        bad = np.bincount(self.held_form[seen & (self.y[self.held_doc] > 0)], minlength=len(self.names))
        often = np.flatnonzero(n >= MARKER_DOCUMENTS)
        share = self.y[rows].mean()
        marks = np.zeros(len(self.names), dtype=bool)
        marks[often] = [bad[f] >= MARKER_DOCUMENTS and _wilson(bad[f], n[f]) >= MARKER_SHARE for f in often]
        # How far a form's share of toxic documents is from the overall share, in standard errors.
        gain = np.abs(bad[often] - n[often] * share) / np.sqrt(n[often] * max(1e-9, share * (1 - share)))
        best = sorted(zip(-gain, self.names[often], often, strict=True))[:MOST_WORDS]
        return np.array(sorted((f for _, _, f in best), key=lambda f: self.names[f]), dtype=np.int64), marks

    def features(self, words: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``Model.features`` for all documents, and the number of marker words of each."""
        at = np.full(len(self.names) + 1, -1)
        at[words] = np.arange(len(words))
        x = np.zeros((len(self.y), len(words) + 1))
        place = at[self.held_form]
        x[self.held_doc[place >= 0], place[place >= 0]] = 1.0
        marked = np.bincount(self.of_word, weights=marks[self.of_form], minlength=self.n_words) > 0
        hits = np.bincount(self.doc, weights=self.times * marked[self.word], minlength=len(self.y))
        x[:, -1] = [math.log1p(h) for h in hits]  # NumPy's can differ in the last bit
        return x, hits

    def targets(self, hits: np.ndarray) -> list[np.ndarray]:
        """abusive, sustained and toxic."""
        return [self.y * (hits >= 1), self.y * (hits >= 3), self.y]


def fit(texts: list[str], toxic: list[int]) -> Model:
    """The chain. Each fold chooses its words, markers and targets without the fold's own documents."""
    corpus = Corpus(texts, toxic)
    n = len(corpus.y)
    if len(set(corpus.y.tolist())) < 2:
        return Model()
    everyone = np.ones(n, dtype=bool)
    words, marks = corpus.chosen(everyone)
    model = Model({w: i for i, w in enumerate(corpus.names[words].tolist())}, frozenset(corpus.names[marks].tolist()))
    x, hits = corpus.features(words, marks)
    fold = np.arange(n) % FOLDS
    parts = [fold != k for k in range(FOLDS) if (fold == k).any() and (fold != k).any()]
    within = [corpus.features(*corpus.chosen(rows)) for rows in parts]
    before = np.zeros((n, 0))  # probabilities of the earlier categories, by models that did not see the document
    for i, target in enumerate(corpus.targets(hits)):
        model.weights.append(_logistic(np.column_stack([x, before]), target))
        unseen = np.zeros(n)
        for rows, (features, own_hits) in zip(parts, within, strict=True):
            full = np.column_stack([features, before])
            unseen[~rows] = _probability(full[~rows], _logistic(full[rows], corpus.targets(own_hits)[i][rows]))
        before = np.column_stack([before, unseen])
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", most: int = MOST_ROWS) -> Model:
    """Learns from at most ``most`` labelled documents, whole; of texts that share an id from the first."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).alias("y")).filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(most)
    found = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(chosen), "id")  # at most ``most`` rows
    rows = found.groupBy("id").agg(F.min("t").alias("t"), F.max("y").alias("y")).select(F.xxhash64("id", "t").alias("h"), "t", "y").collect()
    rows.sort(key=lambda r: (r["h"], r["t"]))
    return fit([r["t"] for r in rows], [int(r["y"] > 0) for r in rows])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a probability ``p_<category>`` for each category, and is_toxic."""
    ship(__name__)
    made = [*(f"p_{c}" for c in CATEGORIES), "is_toxic"]
    kept = [f for f in docs.schema.fields if f.name not in made]
    schema = T.StructType([*kept, *(T.StructField(c, T.DoubleType()) for c in made[:-1]), T.StructField("is_toxic", T.BooleanType())])

    def run(batches):
        for b in batches:
            p = np.zeros((b.num_rows, len(CATEGORIES)))
            if model.weights and b.num_rows:
                p = model.probabilities([t or "" for t in b.column(text).to_pylist()])
            added = [pa.array(p[:, i]) for i in range(len(CATEGORIES))] + [pa.array(p[:, -1] >= THRESHOLD)]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *added], names=schema.fieldNames())

    return docs.select(*[f.name for f in kept]).mapInArrow(run, schema)
