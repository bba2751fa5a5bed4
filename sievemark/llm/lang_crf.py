"""Language identification by a linear-chain conditional random field over words.

A word is a run of letters, longer ones are cut. Every word of a text gets a label by forward-backward over emission scores (affixes,
character n-grams, the word itself as learned lexicon) and learned transitions, so a
text that switches languages is labelled stretch by stretch. The text's language is
the label with the largest summed posterior.

Training takes whole documents: about ``per_lang`` of each language, chosen by a hash
of the id, or all if there are fewer. Their words are dealt into sequences that
switch between documents after random stretches; from those the transitions learn
how likely a switch is.

Edge cases: a null text and one without letters is ``und`` with score 0; rows with a
null language or null text teach nothing; without any labelled row all is ``und``;
equal texts get equal predictions. Ties go to the first label in alphabetical order.
Extra columns pass through unless they bear an output's name. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import blocks
from .common import ship

#: Buckets of hashed features, and characters of a word's head and tail that they see.
BUCKETS, HEAD, TAIL = 1 << 16, 14, 4
#: Training documents per language, words of a training sequence, longest stretch, steps and penalty.
PER_LANG, SEQUENCE, STRETCH, STEPS, L2 = 150, 64, 24, 60, 1e-3
#: Bytes of text that a worker labels at once, and words whose scores it remembers.
BLOCK, MOST_WORDS = 3_000_000, 120_000
#: Words whose features are made at once.
CHUNK = 16_384
#: What Python's word class has besides letters and decimal digits, as ranges: fractions, raised digits, letter numerals.
_OTHERS = [c for c in range(sys.maxunicode + 1) if (x := chr(c)).isalnum() and not x.isalpha() and not x.isdecimal()]
_STARTS = [i for i, c in enumerate(_OTHERS) if not i or _OTHERS[i - 1] != c - 1]
_RANGES = "".join(f"{chr(_OTHERS[i])}-{chr(_OTHERS[j - 1])}" for i, j in zip(_STARTS, [*_STARTS[1:], len(_OTHERS)], strict=True))
LETTER = rf"[^\W\d_{_RANGES}]"
#: A run of letters that its head and tail hold whole, else pieces as long as the head, so that all of a text is read.
WORDS = re.compile(rf"{LETTER}{{1,{HEAD + TAIL}}}(?!{LETTER})|{LETTER}{{1,{HEAD}}}")
MIX = np.uint64(0x9E3779B97F4A7C15)


def features(words: list[str]) -> np.ndarray:
    """Buckets of each word's features: word, prefixes, suffixes and 1- to 3-grams; bucket 0 is none."""
    n = len(words)
    head = np.array([w[:HEAD] for w in words], dtype=f"U{HEAD}").view(np.uint32).reshape(n, HEAD).astype(np.uint64)
    tail = np.array([w[-TAIL:][::-1] for w in words], dtype=f"U{TAIL}").view(np.uint32).reshape(n, TAIL).astype(np.uint64)
    size = np.array([len(w) for w in words], dtype=np.uint64)

    def bucket(kind: int, *parts: np.ndarray) -> np.ndarray:
        h = np.full(n, kind, dtype=np.uint64) * MIX
        for p in parts:
            h = (h ^ p) * MIX
            h ^= h >> np.uint64(29)
        return (h % np.uint64(BUCKETS - 1)).astype(np.int64) + 1

    out = [bucket(1, *head.T, *tail.T, size)]
    out += [np.where(size >= k, bucket(10 + k, *head.T[:k]), 0) for k in (1, 2, 3)]
    out += [np.where(size >= k, bucket(20 + k, *tail.T[:k]), 0) for k in (1, 2, 3)]
    for i in range(HEAD):
        out.append(np.where(head[:, i] > 0, bucket(31, head[:, i]), 0))
        if i + 1 < HEAD:
            out.append(np.where(head[:, i + 1] > 0, bucket(32, head[:, i], head[:, i + 1]), 0))
        if i + 2 < HEAD:
            out.append(np.where(head[:, i + 2] > 0, bucket(33, head[:, i], head[:, i + 1], head[:, i + 2]), 0))
    return np.stack(out, axis=1)


def _scale(f: np.ndarray) -> np.ndarray:
    """One over the root of each word's number of features, so long words don't shout."""
    return 1.0 / np.sqrt(np.maximum(1, (f > 0).sum(axis=1)))


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # BUCKETS x labels
    moves: np.ndarray  # from x to

    def emissions(self, words: list[str]) -> np.ndarray:
        """Positive scores, the largest of each word 1."""
        out = np.empty((len(words), len(self.labels)))
        for i in range(0, len(words), CHUNK):
            f = features(words[i : i + CHUNK])
            e = np.zeros((len(f), len(self.labels)))
            for j in range(f.shape[1]):
                e += self.weights[f[:, j]]
            e *= _scale(f)[:, None]
            out[i : i + CHUNK] = np.exp(e - e.max(axis=1, keepdims=True))
        return out


def posteriors(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains that stand one after the other.

    ``scores``: positive emissions of all words; ``sizes``: words of each chain.
    Returns each word's posterior, and the sum over words of pairwise posteriors.
    """
    order = np.argsort(-sizes, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max(initial=0))
    # active[t]: chains with more than t words; they come first in the order.
    active = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest + 1), side="right")
    step = np.exp(moves)
    alpha = np.empty_like(scores)
    pairs = np.zeros_like(step)
    a = None
    for t in range(longest):
        at = begin[: active[t]] + t
        a = scores[at] if a is None else (a[: active[t]] @ step) * scores[at]
        a = a / a.sum(axis=1, keepdims=True)
        alpha[at] = a
    out = np.empty_like(scores)
    b = np.ones((0, scores.shape[1]))
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        if len(b) < k:
            b = np.concatenate([b, np.ones((k - len(b), scores.shape[1]))])
        p = alpha[at] * b
        out[at] = p / p.sum(axis=1, keepdims=True)
        if t:
            right = scores[at] * b
            left = alpha[at - 1]
            both = left @ step
            pairs += (left / (both * right).sum(axis=1, keepdims=True)).T @ right * step
            b = right @ step.T
            b = b / b.sum(axis=1, keepdims=True)
    return out, pairs


def _even_chains(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``posteriors`` of chains of one length, by place, chain and label: slices of a place lie together."""
    step, pairs = np.exp(moves), np.zeros_like(moves)
    alpha, out = np.empty_like(scores), np.empty_like(scores)
    for t in range(len(scores)):
        a = scores[t] if not t else (alpha[t - 1] @ step) * scores[t]
        alpha[t] = a / a.sum(axis=1, keepdims=True)
    b = np.ones_like(scores[0])
    for t in range(len(scores) - 1, -1, -1):
        p = alpha[t] * b
        out[t] = p / p.sum(axis=1, keepdims=True)
        if t:
            right = scores[t] * b
            b = right @ step.T
            pairs += (alpha[t - 1] / (alpha[t - 1] * b).sum(axis=1, keepdims=True)).T @ right * step
            b = b / b.sum(axis=1, keepdims=True)
    return out, pairs


def fit(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    """Maximum likelihood with Adam; texts and labels of the training documents."""
    labels = sorted(set(langs))
    n = len(labels)
    docs = [(WORDS.findall(t.lower()), labels.index(x)) for t, x in zip(texts, langs, strict=True)]
    docs = [(w, y) for w, y in docs if w]
    if not docs or n < 2:
        return Model(labels, np.zeros((BUCKETS, n)), np.zeros((n, n)))
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    stretches = []
    for words, y in docs:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words])
        cuts = np.cumsum(rng.integers(4, STRETCH + 1, size=len(ids) // 4 + 1))
        stretches += [(part, y) for part in np.split(ids, cuts[cuts < len(ids)])]
    by_lang = [[s for s in stretches if s[1] == y] for y in range(n)]
    most = max(map(len, by_lang))  # every language is met equally often
    stretches = [s for group in by_lang for s in (group * (most // len(group) + 1))[:most] if group]
    rng.shuffle(stretches)
    word = np.concatenate([s for s, _ in stretches])
    gold = np.concatenate([np.full(len(s), y) for s, y in stretches])
    keep = len(word) // SEQUENCE * SEQUENCE or len(word)
    # Rows are places in a chain, columns chains.
    word, gold = (np.ascontiguousarray(x[:keep].reshape(-1, min(SEQUENCE, keep)).T) for x in (word, gold))
    f = features(list(vocabulary))
    scale = _scale(f)
    target = np.zeros((len(vocabulary), n))
    np.add.at(target, (word.ravel(), gold.ravel()), 1.0)
    wanted = np.zeros((n, n))
    np.add.at(wanted, (gold[:-1].ravel(), gold[1:].ravel()), 1.0)
    weights, moves = np.zeros((n, BUCKETS)), np.zeros((n, n))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((n, n)), np.zeros((n, n))]
    flat, places = f.ravel(), word.ravel()
    for i in range(1, STEPS + 1):
        raw = np.stack([w[f].sum(axis=1) for w in weights], axis=1) * scale[:, None]
        post, pairs = _even_chains(np.exp(raw - raw.max(axis=1, keepdims=True))[word], moves)
        got = np.stack([np.bincount(places, weights=post[:, :, y].ravel(), minlength=len(vocabulary)) for y in range(n)], axis=1)
        diff = (target - got) * scale[:, None] / keep
        grad = np.stack([np.bincount(flat, weights=np.repeat(diff[:, y], f.shape[1]), minlength=BUCKETS) for y in range(n)]) - L2 * weights / n
        grad[:, 0] = 0
        for value, g, m, v in ((weights, grad, state[0], state[1]), (moves, (wanted - pairs) / keep, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += 0.15 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    weights[:, 0] = 0
    return Model(labels, np.ascontiguousarray(weights.T), moves)


def training_sample(docs: DataFrame, chosen: Column | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG) -> list:
    """About ``per_lang`` labelled rows of each language, by a hash of the id; never more than twice that."""
    d = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    d = d.filter(chosen) if chosen is not None else d
    counts = {r[lang]: r["n"] for r in d.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    part = F.pmod(F.xxhash64(F.col(doc_id), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_lang / n))])
    rows = d.filter(part < share[F.col(lang)]).select(text, lang, part.alias("part")).limit(2 * per_lang * len(counts)).collect()
    return sorted(rows, key=lambda r: (r["part"], r[text]))


def predict(docs: DataFrame, model: Model, text: str = "text", words: bool = False, certainty: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score; with ``words`` also word_langs array<string>, a label for each word; with ``certainty`` that too.

    certainty is the mean over words of the likeliest label's posterior, whichever label that
    is: high for a text that mixes known languages, low for one that none of them explains.
    """
    ship(__name__)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", *["word_langs"] * words, *["certainty"] * certainty)]
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    added += [T.StructField("word_langs", T.ArrayType(T.StringType()))] * words + [T.StructField("certainty", T.DoubleType())] * certainty
    schema = T.StructType([*kept, *added])
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, model.weights.astype(np.float32), model.moves))
    known: dict[str, int] = {}
    table: list[np.ndarray] = []

    def run(batches):
        labels, weights, moves = shared.value
        m = Model(labels, weights, moves)
        for whole in batches:
            for b in blocks(whole, text, BLOCK):
                found = [WORDS.findall((t or "").lower()) if labels else [] for t in b.column(text).to_pylist()]
                if len(known) > MOST_WORDS:
                    known.clear()
                    table.clear()
                fresh = list(dict.fromkeys(w for ws in found for w in ws if w not in known))
                if fresh:
                    base = len(known)
                    known.update(zip(fresh, range(base, base + len(fresh)), strict=True))
                    table.append(m.emissions(fresh))
                    table[:] = [np.concatenate(table)]
                sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
                of = np.fromiter((known[w] for ws in found for w in ws), dtype=np.int64, count=int(sizes.sum()))
                names, scores, marks, sure = ["und"] * len(found), np.zeros(len(found)), [[]] * len(found), np.zeros(len(found))
                full = np.flatnonzero(sizes)
                if len(full):
                    post = posteriors(table[0][of], sizes[full], moves)[0]
                    begin = np.cumsum(sizes[full]) - sizes[full]
                    mean = np.add.reduceat(post, begin, axis=0) / sizes[full][:, None]
                    best = mean.argmax(axis=1)
                    scores[full] = np.clip(mean[np.arange(len(full)), best], 0.0, 1.0)
                    for i, k in zip(full, best, strict=True):
                        names[i] = labels[k]
                    if certainty:
                        sure[full] = np.add.reduceat(post.max(axis=1), begin) / sizes[full]
                    if words:
                        each = post.argmax(axis=1)
                        for i, x, n in zip(full, begin, sizes[full], strict=True):
                            marks[i] = [labels[k] for k in each[x : x + n]]
                more = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                more += [pa.array(marks, pa.list_(pa.string()))] * words + [pa.array(sure)] * certainty
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *more], names=schema.fieldNames())

    columns = [f.name for f in kept]
    return docs.select(*columns).mapInArrow(run, schema)


def train(docs: DataFrame, chosen: Column | None = None, per_lang: int = PER_LANG, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    rows = training_sample(docs, chosen, doc_id, text, lang, per_lang)
    return fit([r[text] for r in rows], [r[lang] for r in rows])
