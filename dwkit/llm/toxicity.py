"""Toxicity by a classifier chain.

One logistic model per category, in the chain's order.  Each model sees the words
of a text and their beginnings, a few numbers about its letters, and the probabilities of the
categories before it.  For training, those probabilities are out-of-fold: every
row's value comes from models that never saw the row, so a later model learns how
far it can trust an earlier one; the final models of all rows score the corpus.
Unless a threshold is given, the one with the best out-of-fold F1 is taken.

The models are fitted in numpy on about ``SAMPLE`` labelled documents (of each
combination of labels its share, but ``RARE`` or all if it has fewer, with the smallest
hashes of their ids; losses and thresholds are weighted back to the true shares).  Tasks turn those documents into
their features, so no text reaches the driver and a very long one is no more there than its vocabulary.  Scoring runs over
all documents in parallel with the small model (at most ``FEATURES`` words and word beginnings a category) in each task.

Edge cases: null and empty texts are scored by the intercepts and the letter
numbers at zero; labels that are null are left out of that category; several
labels of one id count as their largest; with no labelled row a category has
probability 0, with one class only its smoothed share; repeated rows and null ids
are kept; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwkit.llm.common import per_text, sample_of_each, small_batches, staged

SAMPLE = 10_000    # labelled documents the models are fitted on
RARE = 1_000       # of each combination of labels, if it has them
SLOTS = 1 << 22    # hashed features
FEATURES = 4_000   # words of a model
FOLDS = 3
CACHE = 100_000    # words whose features a task remembers
_WORD = re.compile(r"\w+")
_LETTER_NUMBERS = 3
_NONE: tuple = ()


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def letter_numbers(text: str | None) -> list[float]:
    """Signs, digits and capitals as shares of the characters (0 for no text)."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * _LETTER_NUMBERS
    c = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    digits, capitals, small = c[48:58].sum(), c[65:91].sum(), c[97:123].sum()
    signs = c[33:128].sum() - digits - capitals - small
    return [signs / len(raw), digits / len(raw), capitals / len(raw)]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings of four and five characters."""
    some = [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) & (SLOTS - 1) for f in some]


def text_features(text: str | None) -> np.ndarray:
    """Distinct features of a text's words, in order."""
    return np.unique(np.array([f for w in set(tokens(text)) for f in features(w)], dtype="<i4"))


@dataclass
class Linear:
    """Logistic model over text features and standardised dense columns."""
    numbers: dict[int, int] = field(default_factory=dict)
    w: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    dense_w: np.ndarray | None = None
    bias: float = -np.inf

    def prob(self, found: np.ndarray, dense: Sequence[float]) -> float:
        """Probability for the features found (numbers of this model) and the dense columns."""
        if self.dense_w is None:
            return float(sigmoid(np.array(self.bias))) if np.isfinite(self.bias) else 0.0
        z = self.bias + self.w[found].sum() + ((np.asarray(dense) - self.mean) / self.scale) @ self.dense_w
        return float(sigmoid(z))


class Matrix:
    """Which of the sample's common features each row has."""

    def __init__(self, rows: Sequence[np.ndarray], least_df: int = 3) -> None:
        df = np.zeros(SLOTS, dtype=np.int64)
        for r in rows:
            df[r] += 1
        self.slots = np.flatnonzero(df >= least_df)
        rows = [r[df[r] >= least_df] for r in rows]
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        self.col = np.searchsorted(self.slots, np.concatenate([*rows, np.zeros(0, dtype=np.int32)])).astype(np.int32)


def choose(m: Matrix, rows: np.ndarray, y: np.ndarray, most: int = FEATURES, least_chi2: float = 12.0) -> np.ndarray:
    """Features whose presence differs most between the classes (chi-squared).

    ``rows`` marks the rows that count; ``y`` has a class for every row of ``m``.
    """
    n, pos, k = int(rows.sum()), int(y[rows].sum()), len(m.slots)
    here = rows[m.row]
    c = np.bincount(m.col[here], minlength=k).astype(float)
    a = np.bincount(m.col[here], weights=y[m.row[here]], minlength=k)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = np.nan_to_num(n * (a * (n - pos) - (c - a) * pos) ** 2 / (pos * (n - pos) * c * (n - c)))
    some = np.flatnonzero(chi2 >= least_chi2)
    return some[np.argsort(-chi2[some], kind="stable")][:most]


def fit_linear(m: Matrix, rows: np.ndarray, dense: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None,
               rounds: int = 300, rate: float = 0.2, l2: float = 1e-5) -> Linear:
    """Full-batch Adam on the weighted mean log loss of the marked rows."""
    n, pos = int(rows.sum()), int(np.nansum(y[rows]))
    if not n:
        return Linear()
    if pos in (0, n):
        return Linear(bias=float(np.log((pos + 0.5) / (n - pos + 0.5))))
    some = choose(m, rows, y)
    number = np.full(len(m.slots), -1)
    number[some] = np.arange(len(some))
    use = rows[m.row] & (number[m.col] >= 0)
    row, col = (np.cumsum(rows) - 1)[m.row[use]], number[m.col[use]]
    y, x = y[rows], dense[rows]
    weights = np.ones(n) if weights is None else weights[rows]
    total, share = weights.sum(), weights @ y
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = (x - mean) / scale
    k, d = len(some), dense.shape[1]
    theta = np.zeros(k + d + 1)
    theta[-1] = np.log(share / (total - share))
    up, var = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=theta[col], minlength=n) + x @ theta[k:k + d] + theta[-1]
        g = weights * (sigmoid(z) - y) / total
        grad = np.concatenate((np.bincount(col, weights=g[row], minlength=k), x.T @ g, [g.sum()]))
        grad[:-1] += l2 * theta[:-1]
        up, var = 0.9 * up + 0.1 * grad, 0.999 * var + 0.001 * grad * grad
        theta -= rate * (up / (1 - 0.9 ** t)) / (np.sqrt(var / (1 - 0.999 ** t)) + 1e-8)
    return Linear({int(m.slots[i]): at for at, i in enumerate(some)}, theta[:k], mean, scale, theta[k:k + d], float(theta[-1]))


@dataclass
class Chain:
    """Fitted models in the chain's order."""
    names: list[str]
    models: list[Linear]
    cuts: list[float]

    def __post_init__(self) -> None:
        self.cache: dict[str, Sequence[list[int]]] = {}

    def _found(self, word: str) -> Sequence[list[int]]:
        """Numbers of a word's features in each model; kept for the next time the word occurs."""
        own = features(word)
        got = [[m.numbers[f] for f in own if f in m.numbers] for m in self.models]
        got = got if any(got) else _NONE
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[word] = got
        return got

    def score(self, text: str | None) -> list[float]:
        """Probability of every category."""
        known, words = self.cache, set(tokens(text))
        got = [x for w in words if (x := known[w] if w in known else self._found(w))]
        dense, probs = letter_numbers(text), []
        for i, m in enumerate(self.models):
            found = np.array(sorted({f for x in got for f in x[i]}), dtype=np.int64)
            probs.append(m.prob(found, dense + probs))
        return probs


def fit_chain(texts: Sequence[str | None], folds: np.ndarray, labels: dict[str, np.ndarray], n_folds: int = FOLDS,
              weights: np.ndarray | None = None) -> Chain:
    """Fit a chain; ``labels`` holds 0/1 or NaN per row and category, in the chain's order."""
    return fit_features([text_features(t) for t in texts], [letter_numbers(t) for t in texts], folds, labels, n_folds, weights)


def fit_features(found: Sequence[np.ndarray], letters: Sequence[Sequence[float]], folds: np.ndarray, labels: dict[str, np.ndarray],
                 n_folds: int = FOLDS, weights: np.ndarray | None = None) -> Chain:
    """``fit_chain`` of texts given by their features and letter numbers."""
    n, m = len(found), Matrix(found)
    weights = np.ones(n) if weights is None else weights
    dense = np.array(letters, dtype=float).reshape(n, _LETTER_NUMBERS)
    starts = np.searchsorted(m.row, np.arange(n + 1))
    names, models, cuts = [], [], []
    for name, y in labels.items():
        known = ~np.isnan(y)
        held_out = np.zeros(n)
        for f in range(n_folds):
            part = fit_linear(m, known & (folds != f), dense, y, weights)
            number = np.array([part.numbers.get(x, -1) for x in m.slots.tolist()], dtype=np.int64)
            for i in np.flatnonzero(folds == f):
                own = number[m.col[starts[i]:starts[i + 1]]]
                held_out[i] = part.prob(own[own >= 0], dense[i])
        names.append(name)
        models.append(fit_linear(m, known, dense, y, weights))
        cuts.append(best_cut(held_out[known], y[known], weights[known]))
        dense = np.column_stack((dense, held_out))
    return Chain(names, models, cuts)


def best_cut(p: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The threshold with the best F1 on out-of-fold probabilities, half way (in
    log odds) to the next lower one; 0.5 without rows of both classes."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    w = np.ones(len(p)) if weights is None else weights[order]
    p, hits = p[order], np.cumsum(w * y[order])
    f1 = 2 * hits / (np.cumsum(w) + hits[-1])
    f1[:-1][p[:-1] == p[1:]] = 0          # rows of equal probability stand together
    at = int(np.argmax(f1))
    low = p[at + 1] if at + 1 < len(p) else 0.0
    odds = [np.log(x / (1 - x)) for x in np.clip([p[at], low], 1e-6, 1 - 1e-6)]
    return float(np.clip(sigmoid(np.array(sum(odds) / 2)), 0.05, 0.5))


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE, folds: int = FOLDS) -> Chain:
    """Fit the chain on a bounded sample of labelled documents.

    ``categories`` maps each category to an SQL expression (0/1) over ``labels``.
    """
    known = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
             .agg(*[F.max(F.expr(e).cast("double")).alias(c) for c, e in categories.items()]))
    stratum = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in categories])
    known = staged(known.withColumn("stratum", stratum), "labels")
    total: dict = {}

    def numbers(rows: dict) -> dict:
        total.update(rows)
        return {v: max(-(-sample * n // sum(rows.values())), RARE) for v, n in rows.items()}
    some = staged(sample_of_each(known, numbers, "stratum", "label_id"), "labels")      # bounded, so it may be broadcast
    described = staged(
        small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(some), F.col("id") == F.col("label_id")).drop("label_id")
        .select("id", "stratum", *categories, F.xxhash64("id", "text").alias("at"),
                per_text(lambda t: text_features(t).tobytes(), "binary", F.col("text")).alias("found"),
                per_text(letter_numbers, "array<double>", F.col("text")).alias("letters")), "described")
    # An id may stand for many rows: the bound holds for them, too.  Ranked without the features.
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy("at", "rid"))
    described = described.withColumn("rid", F.monotonically_increasing_id())
    most = numbers(total) if total else {}
    if described.count() > sum(min(n, total[v]) for v, n in most.items()):
        described = staged(described, "described")
        first = (described.select("rid", "stratum", "at").withColumn("rank", rank)
                 .where(F.coalesce(F.col("rank") <= F.element_at(F.create_map(*[F.lit(x) for v in most.items() for x in v]), F.col("stratum")), F.lit(False))))
        described = described.join(first.select("rid"), "rid", "left_semi")
    rows = described.toPandas().sort_values(["at", "rid"], kind="stable").reset_index(drop=True)
    fold = np.array([zlib.crc32(str(i).encode()) % folds for i in rows["id"].tolist()], dtype=int)
    weights = rows["stratum"].map(total).to_numpy(float) / rows.groupby("stratum")["id"].transform("size").to_numpy(float)
    weights = weights * len(rows) / max(weights.sum(), 1e-300)
    found = [np.frombuffer(x, dtype="<i4") for x in rows["found"].tolist()]
    return fit_features(found, rows["letters"].tolist(), fold, {c: rows[c].to_numpy(dtype=float) for c in categories}, folds, weights)


def probabilities(chain: Chain, text: Column) -> Column:
    """Array column with the probability of every category, in the chain's order."""
    return per_text(chain.score, "array<double>", text)


def classify(docs: DataFrame, labels: DataFrame, categories: dict[str, str], reject: str, threshold: float | None = None,
             id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``(id, <category> ..., rejected)`` for every row of ``docs``."""
    chain = train(docs, labels, categories, id_col, text_col, sample)
    threshold = chain.cuts[chain.names.index(reject)] if threshold is None else threshold
    scored = small_batches(docs).select(F.col(id_col), probabilities(chain, F.col(text_col)).alias("p"))
    return scored.select(id_col, *[F.get("p", F.lit(i)).alias(f"p_{c}") for i, c in enumerate(chain.names)],
                         (F.get("p", F.lit(chain.names.index(reject))) >= threshold).alias("rejected"))


def keep_clean(docs: DataFrame, labels: DataFrame, categories: dict[str, str], reject: str, threshold: float | None = None,
               id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose probability of ``reject`` is below the threshold."""
    chain = train(docs, labels, categories, id_col, text_col, sample)
    threshold = chain.cuts[chain.names.index(reject)] if threshold is None else threshold
    return small_batches(docs).where(F.get(probabilities(chain, F.col(text_col)), F.lit(chain.names.index(reject))) < threshold)
