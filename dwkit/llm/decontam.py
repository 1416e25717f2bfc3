"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming
retrieval, exact weighted-shingle similarity.

Every window of as many words as a benchmark item has is a candidate place of that
item (a shorter text is one window).  A window's shingles give a 64-bit SimHash,
each shingle counted as often as it occurs.  The items' fingerprints are indexed in
``BLOCKS`` tables by block value and all values within ``RADIUS // BLOCKS`` bits of
it, so each item within ``RADIUS`` bits is sure to share a table entry with the
window; what the tables return is checked for its Hamming distance and then for
its exact similarity (sum of the smaller over the sum of the larger shingle
counts).  ``RADIUS`` lies 4.7 standard deviations above the distance expected at
a similarity of 0.8.

A window with similarity ``t`` shares at least ``t / (1 + t)`` of both sides'
shingles with the item.  Windows that hold fewer places whose shingle occurs in an
item of their size are skipped unhashed: that drops no match and spares nearly all
windows.

The items of one pass are shipped to every task; a pass takes items of
``PASS_WORDS`` words in all at most (or one item, if that alone is longer), a
larger benchmark is run in several passes over the documents.

Words are runs of letters, digits and underscores, lower-cased, so layout and
punctuation do not matter.

Edge cases: null, empty and wordless texts and items match nothing; an item with
fewer words than the shingle length is one shingle; repeated items and rows are
all reported; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.llm.common import per_text, small_batches
from dwkit.llm.simhash import _counts

SHINGLE = 5
THRESHOLD = 0.8
RADIUS, BLOCKS = 23, 8
PASS_WORDS = 1_000_000
_WORD = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _hash(shingle: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(shingle.encode("utf-8", "surrogatepass"), 42)


def _simhash(h: np.ndarray) -> np.uint64:
    on = (2 * _counts(h) > len(h)).astype(np.uint8)
    return np.packbits(on, bitorder="little").view("<u8")[0]


def similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller over the sum of the larger counts."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (a.total() + b.total() - both) if a or b else 0.0


def shingles(words: list[str], k: int) -> list[str]:
    return [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]


class Index:
    """The benchmark items of one pass."""

    def __init__(self, items: list[tuple[int | None, str | None]], k: int = SHINGLE, threshold: float = THRESHOLD,
                 radius: int = RADIUS, blocks: int = BLOCKS) -> None:
        self.threshold, self.radius, self.width = threshold, radius, 64 // blocks
        by_text: dict[tuple[str, ...], list] = defaultdict(list)
        for i, text in items:
            by_text[tuple(tokens(text))].append(i)
        by_text.pop((), None)
        self.words = list(by_text)
        self.ids = list(by_text.values())
        self.vocab: dict[str, int] = {}
        for ws in self.words:
            for w in ws:
                self.vocab.setdefault(w, len(self.vocab))
        self.k = [min(k, len(ws)) for ws in self.words]
        sizes: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        self.counts, fps = [], []
        for ws, kk in zip(self.words, self.k, strict=True):
            sh = shingles(list(ws), kk)
            self.counts.append(Counter(sh))
            fps.append(_simhash(np.array([_hash(s) for s in sh], dtype=np.uint64)))
            ids = np.array([self.vocab[w] for w in ws], dtype=np.uint64)
            for key in self._keys(ids, np.arange(len(sh)), kk).tolist():
                sizes[kk][key].add(len(ws))
        self.fps = np.array(fps, dtype=np.uint64)
        self.lens = np.array([len(ws) for ws in self.words], dtype=np.int64)
        # Known shingles by length, and the sizes of the items that hold each.
        self.keys = {kk: np.array(sorted(v), dtype=np.uint64) for kk, v in sizes.items()}
        self.sizes = {kk: [v[key] for key in sorted(v)] for kk, v in sizes.items()}
        # Hamming tables: block values within radius // blocks bits.
        flips, reach = [0], radius // blocks
        for _ in range(reach):
            flips = sorted({f ^ (1 << i) for f in flips for i in range(self.width)} | set(flips))
        self.tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(blocks)]
        for at, fp in enumerate(fps):
            for b, table in enumerate(self.tables):
                value = int(fp) >> (b * self.width) & ((1 << self.width) - 1)
                for f in flips:
                    table[value ^ f].append(at)
        self.tables = [{v: np.array(x) for v, x in t.items()} for t in self.tables]

    @staticmethod
    def _keys(ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """A number for the run of k word ids at each of the places."""
        out = np.zeros(len(at), dtype=np.uint64)
        for j in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[at + j].astype(np.uint64) + np.uint64(1)
        return out

    def near(self, fp: np.uint64) -> np.ndarray:
        """Items within the radius, by the Hamming tables."""
        mask = (1 << self.width) - 1
        got = [x for b, t in enumerate(self.tables) if (x := t.get(int(fp) >> (b * self.width) & mask)) is not None]
        if not got:
            return np.zeros(0, dtype=np.int64)
        at = np.unique(np.concatenate(got))
        return at[np.bitwise_count(self.fps[at] ^ fp) <= self.radius]

    def find(self, text: str | None) -> list[tuple[int | None, int, float]]:
        """(item id, first word, similarity) of the best window per item found in a text."""
        ws = tokens(text)
        if not ws or not self.words:
            return []
        ids = np.fromiter(map(self.vocab.get, ws, repeat(-1)), dtype=np.int64, count=len(ws))
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        best: dict[int, tuple[float, int]] = {}
        for k, keys in self.keys.items():
            if len(ws) < k:
                continue
            at = np.flatnonzero(known[k:] - known[:-k] == k)
            if not len(at):
                continue
            own = self._keys(ids, at, k)
            pos = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hits: dict[int, list[int]] = defaultdict(list)
            for p, key in zip(at[keys[pos] == own].tolist(), pos[keys[pos] == own].tolist(), strict=True):
                for n in self.sizes[k][key]:
                    hits[n].append(p)
            hashes: dict[int, int] = {}
            for n, places in hits.items():
                own_n = min(n, len(ws)) - k + 1
                need = max(1, math.ceil(self.threshold / (1 + self.threshold) * (own_n + n - k + 1) - 1e-9))
                if len(places) < need:
                    continue
                hit = np.zeros(len(ws) - k + 2, dtype=np.int64)
                hit[np.array(places) + 1] = 1
                hit = np.cumsum(hit)
                for s in np.flatnonzero(hit[own_n:] - hit[:len(hit) - own_n] >= need).tolist():
                    for p in range(s, s + own_n):
                        if p not in hashes:
                            hashes[p] = _hash(" ".join(ws[p:p + k]))
                    fp = _simhash(np.array([hashes[p] for p in range(s, s + own_n)], dtype=np.uint64))
                    cand = self.near(fp)
                    cand = cand[self.lens[cand] == n]
                    if not len(cand):
                        continue
                    window = Counter(shingles(ws[s:s + own_n + k - 1], k))
                    for c in cand.tolist():
                        sim = similarity(window, self.counts[c])
                        if sim >= self.threshold and (sim, -s) > best.get(c, (0.0, 0)):
                            best[c] = (sim, -s)
        return [(i, -s, sim) for c, (sim, s) in best.items() for i in self.ids[c]]


def passes(items: DataFrame, id_col: str, text_col: str, pass_words: int) -> list[list[tuple]]:
    """The items in lists of bounded size; the driver holds one benchmark, not documents."""
    rows = items.select(F.col(id_col), F.col(text_col), F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), r"\W+")).alias("n"))
    out, held = [[]], 0
    for r in rows.toLocalIterator():
        if held and held + r["n"] > pass_words:
            out.append([])
            held = 0
        out[-1].append((r[0], r[1]))
        held += r["n"]
    return out


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", pass_words: int = PASS_WORDS, **how) -> DataFrame:
    """``(id, item, start, similarity)``: for every document and every item found
    in it the best window (the first of equals), with its first word."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = None
    for some in passes(items, item_col, item_text_col, pass_words):
        index = Index(some, **how)

        def search(it: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in it:
                at, got = [], []
                for i, text in enumerate(batch.column("text")):
                    found = index.find(text.as_py())
                    at += [i] * len(found)
                    got += found
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(at, pa.int64())), pa.array([g[0] for g in got], pa.int64()),
                     pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.float64())],
                    names=["id", "item", "start", "similarity"])
        part = rows.mapInArrow(search, f"id {kind}, item long, start long, similarity double")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "start", "similarity")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", pass_words: int = PASS_WORDS, **how) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    for some in passes(items, item_col, item_text_col, pass_words):
        index = Index(some, **how)
        docs = small_batches(docs).where(~per_text(lambda x, index=index: bool(index.find(x)), "boolean", F.col(text_col)))
    return docs
