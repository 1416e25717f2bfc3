"""SimHash near-duplicates by a binary trie self-join.

``fingerprint`` gives a 64-bit SimHash per text.  ``link`` joins the distinct
fingerprints with themselves on a binary trie: two nodes are walked together,
the bits in which they differ are added up, and a pair of nodes is dropped as
soon as the sum exceeds the bound.  To spread the walk over tasks the trie is
built in ``bound + 1`` rotations of the bit order.  Two fingerprints within the
bound agree on one whole leading block in at least one rotation, so each
rotation only has to walk the node pairs whose two leading blocks are the same,
and every task walks some of those subtrees.  A subtree above ``limit``
fingerprints is opened further by Spark, four trie levels at a time, into its
child pairs, so no task holds an unbounded one.  A task reports the links it
found as a forest (each fingerprint with the smallest one it reaches), not as
all pairs; ``common.components`` joins the forests.

Edge cases: a null, empty or blank text has fingerprint zero and is linked like
any other; a text with fewer words than the shingle length is one shingle;
repeated rows are repeated in the result; a null id is kept, and is the
component's id only if no other id is there; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwkit.llm.common import components, per_text, small_batches, staged

BITS = 64
LIMIT = 200_000          # fingerprints of one subtree in one task
_LANES = np.uint64(0x0101010101010101)
_FRONTIER = 1_000_000    # node pairs walked at once
_LEAF = 64               # a node pair with at most so many pairs is compared directly
_CHUNK = 255 * 4096


def _counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set: byte lanes summed 255 at a time."""
    out = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), _CHUNK):
        part = h[at:at + _CHUNK]
        cuts = np.arange(0, len(part), 255)
        for i in range(8):
            lanes = np.add.reduceat((part >> np.uint64(i)) & _LANES, cuts)
            out[i::8] += lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out


def simhash(text: str | None, k: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit number."""
    import xxhash
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    k = min(k, len(ws))
    buf = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), dtype=np.int64, count=len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    cut = map(buf.__getitem__, map(slice, starts[:len(ws) - k + 1].tolist(), ends[k - 1:].tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(42)), dtype=np.uint64, count=len(ws) - k + 1)
    on = (2 * _counts(h) > len(h)).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, k: int = 3) -> Column:
    """SimHash of a text column over ``k``-word shingles (long)."""
    return per_text(lambda x: simhash(x, k), "long", text)


def _rotl(c: np.ndarray, n: int) -> np.ndarray:
    n %= BITS
    return (c << np.uint64(n)) | (c >> np.uint64(BITS - n)) if n else c


def _join_into(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the sets of i and j; ``parent`` stays flat and points to the smallest."""
    while len(i):
        a, b = parent[i], parent[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        if not len(i):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _pairs(n: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of members of small node pairs."""
    alo, ahi, blo, bhi = n[:4]
    nb = bhi - blo
    total = (ahi - alo) * nb
    at = np.repeat(np.arange(len(total)), total)
    off = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    i, j = alo[at] + off // nb[at], blo[at] + off % nb[at]
    return i[i < j], j[i < j]


def walk(codes: np.ndarray, nodes: tuple[np.ndarray, ...], top: int, bound: int) -> np.ndarray:
    """Walk node pairs of a trie over ``codes`` together.

    ``nodes`` is (a from, a to, b from, b to, bits differing so far); each range
    is a sorted run of ``codes`` that agree above bit ``top``.  Returns for each
    code the index of the smallest one reached by links within ``bound``.
    """
    parent = np.arange(len(codes))
    stack = [(top, nodes)]
    while stack:
        bit, n = stack.pop()
        if len(n[0]) > _FRONTIER:
            half = len(n[0]) // 2
            stack += [(bit, tuple(x[:half] for x in n)), (bit, tuple(x[half:] for x in n))]
            continue
        leaf = (n[1] - n[0]) * (n[3] - n[2]) <= _LEAF
        if bit < 0:
            leaf[:] = True
        if leaf.any():
            i, j = _pairs(tuple(x[leaf] for x in n))
            near = np.bitwise_count(codes[i] ^ codes[j]) <= bound
            _join_into(parent, i[near], j[near])
            n = tuple(x[~leaf] for x in n)
        if not len(n[0]):
            continue
        ones = np.concatenate(([0], np.cumsum((codes >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        alo, ahi, blo, bhi, dist = n
        amid, bmid = ahi - (ones[ahi] - ones[alo]), bhi - (ones[bhi] - ones[blo])
        twin = (alo == blo) & (ahi == bhi)
        kids = [(alo, amid, blo, bmid, dist), (amid, ahi, bmid, bhi, dist), (alo, amid, bmid, bhi, dist + 1)]
        kids.append(tuple(x[~twin] for x in (amid, ahi, blo, bmid, dist + 1)))
        n = tuple(np.concatenate(x) for x in zip(*kids, strict=True))
        live = (n[0] < n[1]) & (n[2] < n[3]) & (n[4] <= bound)
        stack.append((bit - 1, tuple(x[live] for x in n)))
    return parent


def _forest(pdf: pd.DataFrame, bound: int, width: int) -> pd.DataFrame:
    """Links inside the subtree pairs of a batch (whole groups) as a forest."""
    codes = pdf["code"].to_numpy().view(np.uint64)
    rot, pa, pb = (pdf[c].to_numpy() for c in ("rot", "pa", "pb"))
    order = np.lexsort((codes, pb, pa, rot))
    codes, rot, pa, pb = codes[order], rot[order], pa[order], pb[order]
    first = np.concatenate(([True], (rot[1:] != rot[:-1]) | (pa[1:] != pa[:-1]) | (pb[1:] != pb[:-1])))
    lo = np.flatnonzero(first)
    hi = np.append(lo[1:], len(codes))
    shift = (np.uint64(BITS) - pdf["depth"].to_numpy()[order].astype(np.uint64))
    other = np.concatenate(([0], np.cumsum((codes >> shift).astype(np.int64) == pb)))
    cross = pa[lo] != pb[lo]
    mid = np.where(cross, hi - (other[hi] - other[lo]), hi)
    keep = np.where(cross, (lo < mid) & (mid < hi), hi - lo > 1)
    n = (lo, mid, np.where(cross, mid, lo), hi, np.zeros_like(lo))
    parent = walk(codes, tuple(x[keep] for x in n), BITS - width - 1, bound)
    out = np.flatnonzero(parent != np.arange(len(parent)))
    back = (BITS - rot.astype(np.int64) * width) % BITS
    plain = (codes << back.astype(np.uint64)) | np.where(back > 0, codes >> ((BITS - back) % BITS).astype(np.uint64), np.uint64(0))
    return pd.DataFrame({"a": plain[out].view(np.int64), "b": plain[parent[out]].view(np.int64)})


def _walk_groups(it: Iterator[pd.DataFrame], bound: int, width: int, rows: int) -> Iterator[pd.DataFrame]:
    """Cut a sorted stream into batches of whole groups and walk each."""
    parts, size = [], 0
    for pdf in it:
        parts.append(pdf)
        size += len(pdf)
        if size < rows:
            continue
        held = pd.concat(parts, ignore_index=True)
        last = held.iloc[-1]
        tail = ((held["rot"] == last["rot"]) & (held["pa"] == last["pa"]) & (held["pb"] == last["pb"])).to_numpy()
        if not tail.all():
            yield _forest(held[~tail], bound, width)
            held = held[tail].reset_index(drop=True)
        parts, size = [held], 0          # the last group goes on; it is looked at again after as many more rows
    if sum(map(len, parts)):
        yield _forest(pd.concat(parts, ignore_index=True), bound, width)


def link(fps: DataFrame, col: str = "fp", bound: int = 3, limit: int = LIMIT) -> DataFrame:
    """Links of distinct fingerprints within ``bound`` bits, as the edges
    ``(a, b)`` of a forest with the same connected components."""
    width = BITS // (bound + 1)
    c = F.col(col)
    rotated = [F.struct(F.lit(r).alias("rot"), (c if r == 0 else F.shiftleft(c, r * width).bitwiseOR(
        F.shiftrightunsigned(c, BITS - r * width))).alias("code")) for r in range(bound + 1)]
    rows = (fps.where(c.isNotNull()).select(c).distinct().select(F.explode(F.array(*rotated)).alias("x")).select("x.*")
            .withColumns({"depth": F.lit(width), "pa": F.shiftrightunsigned("code", BITS - width)})
            .withColumn("pb", F.col("pa")))
    key = ["rot", "pa", "pb", "depth"]
    done = None
    for depth in range(width, BITS - 3, 4):
        sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        hot = staged(sizes.where(F.col("n") > limit), "subtrees")
        if hot.isEmpty():
            break
        cold = rows.join(hot.select(*key), key, "left_anti")
        done = cold if done is None else done.unionByName(cold)
        mine = F.shiftrightunsigned("code", BITS - depth - 4)
        nib = [F.lit(i).cast("long") for i in range(16)]
        opened = (rows.join(hot.select(*key), key, "left_semi")
                  .select("rot", "pa", "pb", "code", mine.alias("mine"), F.explode(F.array(*nib)).alias("t"))
                  .withColumn("in_a", F.shiftrightunsigned("mine", 4) == F.col("pa"))
                  .withColumn("theirs", F.shiftleft(F.when(F.col("in_a"), F.col("pb")).otherwise(F.col("pa")), 4) + F.col("t"))
                  .where(F.bit_count(F.col("mine").bitwiseXOR(F.col("theirs"))) <= bound))
        a = F.when(F.col("pa") == F.col("pb"), F.least("mine", "theirs")).when(F.col("in_a"), F.col("mine")).otherwise(F.col("theirs"))
        b = F.when(F.col("pa") == F.col("pb"), F.greatest("mine", "theirs")).when(F.col("in_a"), F.col("theirs")).otherwise(F.col("mine"))
        rows = staged(opened.select("rot", "code", F.lit(depth + 4).alias("depth"), a.alias("pa"), b.alias("pb")), "subtrees")
    rows = rows if done is None else done.unionByName(rows)
    size = max(limit, 1)
    return (rows.repartition(*key[:3]).sortWithinPartitions(*key[:3])
            .mapInPandas(lambda it: _walk_groups(it, bound, width, size), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                    bound: int = 3, limit: int = LIMIT) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row of ``docs``."""
    rows = staged(small_batches(docs).select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), k).alias("fp")), "simhash")
    reach = groups(rows, bound, limit)
    return (rows.join(reach, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("first").alias("component_id")))


def groups(rows: DataFrame, bound: int = 3, limit: int = LIMIT) -> DataFrame:
    """``(fp, component, first)``: per distinct fingerprint its component (the
    smallest fingerprint) and the smallest ``id`` in it."""
    fps = staged(rows.groupBy("fp").agg(F.min("id").alias("id")), "fps")
    comp = components(link(fps, "fp", bound, limit))
    of = staged(fps.join(comp, fps["fp"] == comp["node"], "left")
                .select("fp", "id", F.coalesce("component", "fp").alias("component")), "fps")
    first = of.groupBy("component").agg(F.min("id").alias("first"))
    return of.drop("id").join(first, "component").select("fp", "component", "first")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                  bound: int = 3, limit: int = LIMIT) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the smallest
    id, null ids last; of repeated rows one."""
    marked = small_batches(docs).select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid"),
                         F.col(id_col).alias("id"), fingerprint(F.col(text_col), k).alias("fp"))
    rows = staged(marked, "simhash")
    reach = groups(rows, bound, limit).select("fp", "component")
    best = (rows.select("rid", "id", "fp").join(reach, "fp").groupBy("component")
            .agg(F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("best")).select(F.col("best.rid").alias("rid")))
    return rows.join(best, "rid", "left_semi").select("row.*")
