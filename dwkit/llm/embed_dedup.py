"""Embedding near-duplicates: iterative quantisation and multi-index Hamming tables.

Rotations are learned on at most ``sample`` distinct vectors (PCA, then alternating
sign codes and an orthogonal fit) so that the sign bits are balanced.  Their bits,
one rotation after another, are a vector's code.  It is cut into blocks; each block
is a Hamming table keyed by (label, length, block, value), so two codes that differ
in fewer bits than there are blocks are sure to meet.  Meetings whose first ``BITS``
bits differ by more than the radius are dropped inside the table, as are those that an
earlier block within these bits makes; the rest is reranked with the original vectors.

How far apart the codes of a pair at the threshold lie depends on the vectors (a
common mean moves them apart), so everything is taken from sampled pairs at the
threshold (``fit_tables``): the radius holds 0.999 of them, the blocks' width is the
one with the least work for the largest label (it grows with the logarithm of the
label, so a vector meets about as many others in a table of any size), and blocks
are added until ``RECALL`` of the pairs of every kind meet.  There is no limit on
blocks and no other way beside them: after ``LEARNED`` rotations, random ones
through the origin follow, whose bits part a pair at the threshold with a
probability that does not depend on where the mean lies, so the blocks come to an end.

Equal vectors of a label are one class, so copies cost one entry; a class counts
with its size in ``n_links``.

Edge cases: vectors that are null, empty or zero, or that hold null or non-finite
components, and vectors without a label, link with nothing; vectors of different
lengths do not link with each other; null ids are kept, and name a component only if it has
no other id; repeated rows are vectors of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.llm.common import components, hash_sample, staged

SAMPLE = 5_000   # vectors the rotation is fitted on
BITS = 64
RECALL = 0.995   # of sampled pairs at the threshold, of each kind
LEARNED = 16     # rotations that are learned, random ones follow
WIDTHS = range(4, 33)
MEETING = 0.2    # work of a meeting in a table, in entries of a vector


def fit_rotation(x: np.ndarray, bits: int, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (d x bits) whose sign bits are balanced."""
    mean = x.mean(axis=0)
    centred = x - mean
    _, vecs = np.linalg.eigh(centred.T @ centred)
    proj = vecs[:, ::-1][:, :bits]
    flat = centred @ proj
    rot, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(flat @ rot >= 0, 1.0, -1.0).T @ flat)
        rot = right.T @ left.T
    return mean, proj @ rot


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def signs(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """Sign bits of unit vectors; what is zero but for rounding has the same bit in all of them."""
    return (x - mean) @ proj >= -1e-9


def packed(on: np.ndarray) -> np.ndarray:
    """The first ``BITS`` sign bits as signed 64-bit numbers."""
    on = on[:, :BITS].astype(np.uint8)
    on = np.pad(on, ((0, 0), (0, BITS - on.shape[1])))
    return np.packbits(on, axis=1, bitorder="little").view("<i8")[:, 0]


def encode(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """Codes of one rotation."""
    return packed(signs(x, mean, proj))


def pairs_at(x: np.ndarray, labels: np.ndarray, threshold: float, n: int = 2_000, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at the threshold, by kind: sampled vectors moved in random directions
    and along differences within their label, and the sample's own pairs next above the threshold."""
    r = np.random.default_rng(seed)
    order = np.argsort(labels, kind="stable")
    _, first, size = np.unique(labels[order], return_index=True, return_counts=True)
    group = np.repeat(np.arange(len(first)), size)
    at = r.integers(0, len(x), n)
    one, two = (order[first[group[at]] + (r.random(n) * size[group[at]]).astype(int)] for _ in range(2))
    some, out = x[order[at]], []
    for away in (r.standard_normal(some.shape), x[one] - x[two]):
        away = away - (away * some).sum(axis=1, keepdims=True) * some
        norm = np.linalg.norm(away, axis=1, keepdims=True)
        ok = norm[:, 0] > 1e-6
        out.append((some[ok], threshold * some[ok] + np.sqrt(max(0.0, 1 - threshold ** 2)) * away[ok] / norm[ok]))
    own = r.permutation(len(x))[:n]
    cosine = x[own] @ x[own].T
    a, b = np.nonzero(np.triu((cosine >= threshold) & (labels[own][:, None] == labels[own]), 1))
    hardest = np.argsort(cosine[a, b], kind="stable")[:n]
    out.append((x[own[a[hardest]]], x[own[b[hardest]]]))
    return [kind for kind in out if len(kind[0])]


@dataclass
class Tables:
    """Rotations, width and number of the blocks, and radius, for vectors of one length."""
    rotations: list[tuple[np.ndarray, np.ndarray]]
    width: int = 1
    blocks: int = 1
    radius: int = BITS

    def bits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([signs(x, *rotation) for rotation in self.rotations], axis=1)

    def values(self, on: np.ndarray) -> np.ndarray:
        """Block values of codes given by their bits."""
        return on[:, :self.blocks * self.width].reshape(len(on), self.blocks, self.width) @ (1 << np.arange(self.width, dtype=np.int64))


def fit_tables(x: np.ndarray, labels: np.ndarray, threshold: float, largest: int) -> Tables:
    """Rotations, radius and blocks that sampled pairs at the threshold need, for a label of ``largest`` vectors."""
    bits, kinds = min(BITS, x.shape[1]), pairs_at(x, labels, threshold)
    out = Tables([])
    apart = [np.zeros((len(a), 0), dtype=bool) for a, _ in kinds]

    def longer(least: int) -> None:
        while len(out.rotations) * bits < least:
            n = len(out.rotations)
            mean, proj = fit_rotation(x, bits, rounds=30 if n < LEARNED else 0, seed=7 + n)
            out.rotations.append((mean if n < LEARNED else np.zeros_like(mean), proj))
            for i, (a, b) in enumerate(kinds):
                apart[i] = np.concatenate((apart[i], signs(a, *out.rotations[-1]) != signs(b, *out.rotations[-1])), axis=1)

    longer(BITS)
    if not kinds:                       # length 1: the sign is all there is
        return out
    out.radius = max(int(np.ceil(np.quantile(d[:, :BITS].sum(axis=1), 0.999))) for d in apart)
    # How often a bit parts a pair that should meet, and how often eight bits agree in a pair of a label.
    differ = min(0.5, max(1e-6, *(d.mean() for d in apart)))
    some = np.random.default_rng(13).integers(0, len(x), (20_000, 2))
    some = some[(labels[some[:, 0]] == labels[some[:, 1]]) & (some[:, 0] != some[:, 1])]
    on = out.bits(x)[:, :BITS // 8 * 8]
    agree = (on[some[:, 0]] == on[some[:, 1]]).reshape(len(some), -1, 8).all(axis=2).mean() if len(some) else 0.0
    agree = max(agree, 1 / 256) ** (1 / 8)

    def work(width: int) -> float:
        meet = (1 - differ) ** width
        return np.log(1 - RECALL) / np.log1p(-meet) * (1 + MEETING * largest * agree ** width)
    out.width = min(WIDTHS, key=work)
    met, out.blocks = [np.zeros(len(a), dtype=bool) for a, _ in kinds], 0
    near = [d[:, :BITS].sum(axis=1) <= out.radius for d in apart]
    while not all(m.mean() >= RECALL for m in met):
        lo = out.blocks * out.width
        longer(lo + out.width)
        for m, d, ok in zip(met, apart, near, strict=True):
            m |= ok & ~d[:, lo:lo + out.width].any(axis=1)
        out.blocks += 1
    return out


def link(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         threshold: float = 0.93, sample: int = SAMPLE) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``."""
    v = F.col("vec")
    usable = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
              & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    ready = staged(rows.withColumn("ok", F.coalesce(usable, F.lit(False))), "vectors")
    classes = (ready.where("ok").groupBy("label", "vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
               .withColumn("cls", F.monotonically_increasing_id()))
    keyed = staged(classes, "classes")
    if keyed.isEmpty():
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    tables = {}
    of_label = keyed.groupBy("label", F.size("vec").alias("length")).count()
    for length, largest in of_label.groupBy("length").agg(F.max("count")).where("`max(count)` > 1").collect():
        some = hash_sample(keyed.where(F.size("vec") == length).select("label", "vec"), sample, "label", "vec").toPandas()
        x = _unit(np.stack(some["vec"].to_numpy()).astype(np.float64))
        tables[length] = fit_tables(x, pd.factorize(some["label"])[0], threshold, largest)

    def code(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for length, part in pdf.groupby(pdf["vec"].str.len()):
                x, fit = _unit(np.stack(part["vec"].to_numpy()).astype(np.float64)), tables.get(length)
                part = part.drop(columns="vec").assign(length=length, unit=list(x), width=0, radius=0, code=0, values=None)
                if fit is not None:         # else no label has two vectors of this length
                    on = fit.bits(x)
                    part = part.assign(width=fit.width, radius=fit.radius, code=packed(on), values=list(fit.values(on)))
                yield part

    label = keyed.schema["label"].dataType.simpleString()
    coded = staged(keyed.select("cls", "label", "vec").mapInPandas(
        code, f"cls long, label {label}, length int, unit array<double>, width int, radius int, code long, values array<long>"), "codes")

    entered = coded.select("cls", "label", "length", "width", "radius", "code", F.posexplode("values").alias("block", "value"))
    a, b = entered.alias("a"), entered.alias("b")
    # Close pairs share most blocks: of those that the codes hold, only the first one they share returns them.
    first = F.expr(" AND ".join(
        f"(a.block <= {j} OR a.width * {j + 1} > {BITS} OR (shiftrightunsigned(a.code ^ b.code, a.width * {j}) & (shiftleft(1L, a.width) - 1)) != 0)"
        for j in range(BITS // min(WIDTHS))))
    meet = (a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("label", "length", "block", "value")])
            .where((F.col("a.cls") < F.col("b.cls"))
                   & (F.bit_count(F.col("a.code").bitwiseXOR(F.col("b.code"))) <= F.col("a.radius")) & first)
            .select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).distinct())
    unit = coded.select("cls", "unit")
    cosine = F.aggregate(F.zip_with("x", "y", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    pairs = staged(meet.join(unit.select(F.col("cls").alias("a"), F.col("unit").alias("x")), "a")
                   .join(unit.select(F.col("cls").alias("b"), F.col("unit").alias("y")), "b")
                   .where(cosine >= threshold).select("a", "b"), "links")

    size = keyed.select("cls", "n")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = (both.join(size.select(F.col("cls").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("out"))
             .withColumnRenamed("a", "cls"))
    reach = components(pairs).withColumnRenamed("node", "cls")
    of = keyed.join(reach, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    first = of.groupBy("component").agg(F.min("first").alias("component_id"))
    found = staged(of.join(first, "component").join(links, "cls", "left")
                   .select("label", "vec", F.lit(True).alias("ok"), "component_id",
                           (F.coalesce("out", F.lit(0)) + F.col("n") - 1).alias("n_links")), "found")
    alone = ready.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = (ready.where("ok").join(found.drop("ok"), ["label", "vec"]).select("id", "n_links", "component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
