"""Byte-level BPE by merge replay over the vocabulary of a block of documents.

The words of a block of documents are listed once. All their bytes stand in one
linked sequence; an inverted index maps each token pair to the places where it
occurs. Merges are applied in rank order, each at all its places at once, and only
the neighbours of a merged place get new index entries. A document's ids are its
words' ids. Blocks are bounded in characters and a worker remembers a bounded
number of words, so memory does not grow with the corpus; every occurrence stays
in its place, so no text is shuffled.

Edge cases: a null text counts as empty and has no tokens; equal rows are each
encoded; a text larger than a block is a block of its own. Extra columns pass
through unless they bear an output's name. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import remembered, ship

#: Characters of one block, and words that a worker remembers between blocks.
BLOCK_CHARS, MOST_WORDS = 4_000_000, 400_000
#: More than any token id; a pair (a, b) is the number a * SPAN + b.
SPAN = 1 << 24
#: From so many places on, a merge is applied with array operations.
MANY = 48


class Ranks:
    """A rank file: token bytes and the merges that make each token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.token = [b""] * (max(self.rank.values(), default=-1) + 1)
        for token, i in self.rank.items():
            self.token[i] = token
        self.of_byte = np.array([self.rank[bytes([i])] for i in range(256)], dtype=np.int64)
        lengths = [len(t) for t in self.token]
        self.sizes = np.array(lengths, dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.bytes = np.frombuffer(b"".join(self.token), dtype=np.uint8)
        # Every pair of tokens whose bytes together are a token, as left * SPAN + right, and that token.
        self.pairs = {self.rank[t[:k]] * SPAN + self.rank[t[k:]]: i for t, i in self.rank.items() for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank}
        self.keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.made = np.array([self.pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        # Tokens that make a token of lower rank with some neighbour.
        self.hasty = np.zeros(len(self.token), dtype=bool)
        for half in (self.keys // SPAN, self.keys % SPAN):
            self.hasty[half[self.made <= half]] = True

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or -1."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left * SPAN + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], -1)


#: What a worker remembers of rank files and words: plain tables, as tasks carry them along.
RANKS: dict = {}
ENCODERS: dict = {}


def ranks(path: str) -> Ranks:
    return remembered(RANKS, path, lambda: Ranks(path), 2)


def replay(words: list[bytes], table: Ranks) -> list[list[int]]:
    """Token ids of each word, by applying all merges to all words in rank order."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    # Every word ends with a -1, so no pair spans two words.
    start = np.insert(table.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)], np.cumsum(sizes), -1)
    made_at = table.lookup(start[:-1], start[1:])
    hit = np.flatnonzero(made_at >= 0)
    made_at = made_at[hit]
    hit, made_at = hit[order := np.argsort(made_at, kind="stable")], made_at[order]
    kinds, first = np.unique(made_at, return_index=True)
    # The inverted index, by the token that a pair makes: pairs that make the same token are the same bytes.
    places = {int(k): part.tolist() for k, part in zip(kinds, np.split(hit, first[1:]), strict=True)} if len(kinds) else {}
    queue = list(places)
    heapq.heapify(queue)
    n = len(start)
    at_token, at_after, at_before = start, np.arange(1, n + 1), np.arange(-1, n - 1)
    token, after, before = memoryview(at_token), memoryview(at_after), memoryview(at_before)
    pairs = table.pairs.get

    def all_at_once(made: int, at: np.ndarray) -> bool:
        """Merges at all places with array operations; False if places overlap."""
        right = at_after[at]
        good = table.lookup(at_token[at], at_token[right]) == made
        at, right = at[good], right[good]
        if np.any(right[:-1] == at[1:]):
            return False
        at_token[at] = made
        at_token[right] = -2
        follow = at_after[right]
        at_after[at] = follow
        at_before[follow] = at
        left = at_before[at]
        begin = np.concatenate([at, left])
        new = np.concatenate([table.lookup(np.full(len(at), made), at_token[follow]), table.lookup(at_token[left], np.full(len(at), made))])
        begin, new = begin[new >= 0], new[new >= 0]
        order = np.argsort(new, kind="stable")
        begin, new = begin[order], new[order]
        edges = np.flatnonzero(np.diff(new, prepend=-1, append=-1)).tolist()
        listed = begin.tolist()
        for kind, i, j in zip(new[edges[:-1]].tolist(), edges, edges[1:], strict=False):
            if kind in places:
                places[kind] += listed[i:j]
            else:
                places[kind] = listed[i:j]
                heapq.heappush(queue, kind)
        return True

    while queue:
        made = heapq.heappop(queue)
        at_once = places.pop(made)
        if len(at_once) >= MANY and not table.hasty[made] and all_at_once(made, np.unique(np.array(at_once))):
            continue
        at_once.sort()
        for i, at in enumerate(at_once):
            right = after[at]
            # A merge may have used either half since this place was indexed.
            if pairs(token[at] * SPAN + token[right]) != made:
                continue
            token[at] = made
            token[right] = -2
            follow = after[at] = after[right]
            before[follow] = at
            left = before[at]
            sooner = False
            new = pairs(made * SPAN + token[follow])
            if new is not None:
                sooner = new <= made
                if new in places:
                    places[new].append(at)
                else:
                    places[new] = [at]
                    heapq.heappush(queue, new)
            new = pairs(token[left] * SPAN + made)
            if new is not None:
                sooner |= new <= made
                if new in places:
                    places[new].append(left)
                else:
                    places[new] = [left]
                    heapq.heappush(queue, new)
            if sooner:  # a merge of lower rank has become possible and goes first
                if made in places:
                    places[made] += at_once[i + 1 :]
                else:
                    places[made] = at_once[i + 1 :]
                    heapq.heappush(queue, made)
                break
    ids = at_token[at_token >= 0].tolist()
    edges = np.cumsum(np.add.reduceat(at_token >= 0, np.concatenate([[0], (np.cumsum(sizes + 1))[:-1]]))) if words else []
    out, begin = [], 0
    for end in edges:
        out.append(ids[begin:end])
        begin = end
    return out


class Encoder:
    """Remembers the ids of words it has met, up to MOST_WORDS."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.table, self.split = ranks(path), regex.compile(pattern).findall
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's ids."""
        words = [self.split(t) for t in texts]
        if len(self.index) > MOST_WORDS:
            self.clear()
        fresh = list(dict.fromkeys(w for ws in words for w in ws if w not in self.index))
        if fresh:
            done = replay([w.encode("utf-8", "replace") for w in fresh], self.table)
            base = len(self.index)
            self.index.update(zip(fresh, range(base, base + len(fresh)), strict=True))
            sizes = np.fromiter(map(len, done), dtype=np.int64, count=len(done))
            self.flat = np.concatenate([self.flat, np.fromiter((t for ids in done for t in ids), dtype=np.int32, count=int(sizes.sum()))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        of = np.fromiter((self.index[w] for ws in words for w in ws), dtype=np.int64, count=int(counts.sum()))
        sizes = self.starts[of + 1] - self.starts[of]
        ids = self.flat[_ragged(self.starts[of], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[edges[1:]] - total[edges[:-1]]


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one range after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - sizes), sizes)


def decode_ids(ids: np.ndarray, counts: np.ndarray, table: Ranks) -> pa.Array:
    """The bytes of each text's ids."""
    sizes = table.sizes[ids]
    data = table.bytes[_ragged(table.starts[ids], sizes)]
    total = np.concatenate([[0], np.cumsum(sizes)])
    offsets = total[np.concatenate([[0], np.cumsum(counts)])]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def encoder(path: str, pattern: str) -> Encoder:
    return remembered(ENCODERS, (path, pattern), lambda: Encoder(path, pattern), 2)


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text at most, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield batch.slice(begin)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with columns ids array<int> and decoded binary."""
    ship(__name__)
    kept = [f for f in docs.schema.fields if f.name not in (text, "ids", "decoded")]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.BinaryType())])

    def run(batches):
        coder = encoder(path, pattern)
        for whole in batches:
            for b in blocks(whole, text):
                ids, counts = coder.encode([t or "" for t in b.column(text).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))
                decoded = decode_ids(ids, counts, coder.table).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], lists, decoded], names=schema.fieldNames())

    return docs.select(*[f.name for f in kept], text).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with a column ids array<int>."""
    return round_trip(docs, path, pattern, text).drop("decoded")


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with a column decoded binary: the bytes of its ids; null ids decode to no bytes."""
    ship(__name__)
    kept = [f for f in df.schema.fields if f.name != "decoded"]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        table = ranks(path)
        for b in batches:
            lists = [np.asarray(x if x is not None else [], dtype=np.int64) for x in b.column(ids).to_pylist()]
            counts = np.array([len(x) for x in lists], dtype=np.int64)
            flat = np.concatenate([np.zeros(0, dtype=np.int64), *lists])
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], decode_ids(flat, counts, table).cast(pa.binary())], names=schema.fieldNames())

    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)
