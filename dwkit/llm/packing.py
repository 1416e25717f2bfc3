"""Order-preserving packing of documents into token windows by dynamic programming.

Documents are range-partitioned by id and stay in that order.  Within a partition
the token stream is taken in blocks of whole documents; over the cut places of a
block (document ends, sentence ends, and every ``GRID`` tokens inside a sentence)

    best(j) = min over i with place(j) - place(i) <= length of
              best(i) + length - (place(j) - place(i)) + penalty(j)

i.e. padding plus a penalty for a cut inside a document (larger inside a
sentence).  ``best(i) + place(i)`` is kept in a monotone queue, so the whole block
is solved in time linear in its cut places.  The rest at a block's end is cut into
powers of two, which need no padding.

Tokens come word by word from a table of the words met before (``subwords``).

A task holds one block (``BLOCK`` tokens, or one document if that is longer).
Window numbers are ``partition * 2**32 + n``: unique and the same when a task runs
again, but with gaps.

Edge cases: null and empty texts are the end id alone; repeated rows and ids are
packed one by one; null ids come first; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.llm.common import small_batches
from dwkit.llm.subwords import WordTable, few_texts, table, tokenizer_words

LENGTH = 2048
END = 1
SENTENCE, INSIDE = 4, 16       # penalties of a cut, in padding tokens
GRID = 32
BLOCK = 2_000_000
TABLE = 600_000                # words a process remembers, about 140 MB
_SLICE = 1_000_000             # bytes of text tokenised at once


def tokenise(words: WordTable, texts: list[str | None], end: int = END, most: int = TABLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its ids with the end id, and the places after its sentences."""
    words.trim(most)
    lists = [tokenizer_words(t) for t in texts]
    own = words.numbers(list(chain.from_iterable(lists)))
    ids, lens = words.ids(own)
    stop, ends = words.stop[own], np.cumsum(lens)
    word = 0
    for ws in lists:
        lo = int(ends[word - 1]) if word else 0
        hi = int(ends[word + len(ws) - 1]) if ws else lo
        stops = ends[word:word + len(ws)][stop[word:word + len(ws)]] - lo
        yield np.append(ids[lo:hi], np.uint32(end)).astype("<u4"), stops
        word += len(ws)


def places(sizes: list[int], stops: list[np.ndarray], grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """Cut places of a block (0 first, its end last) and their penalties."""
    ends = np.cumsum(sizes)
    inner = np.concatenate([s + (e - n) for s, e, n in zip(stops, ends, sizes, strict=True)] + [np.zeros(0, dtype=np.int64)])
    known = np.unique(np.concatenate(([0], ends, inner)))
    gaps = np.diff(known)
    more = (gaps - 1) // grid
    extra = np.repeat(known[:-1], more) + grid * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1)
    cuts = np.union1d(known, extra)
    pen = np.full(len(cuts), INSIDE)
    pen[np.searchsorted(cuts, inner)] = SENTENCE
    pen[np.searchsorted(cuts, ends)] = 0
    pen[0] = 0
    return cuts, pen


def best_cuts(cuts: np.ndarray, pen: np.ndarray, length: int = LENGTH) -> list[int]:
    """Window bounds (0 and the end included) of least padding plus penalties."""
    place, cost = cuts.tolist(), pen.tolist()
    n = len(place)
    if n < 2:
        return place
    best, back = [0] * n, [0] * n
    value = [0] * n                       # best(i) + place(i)
    queue = deque([0])
    for j in range(1, n - 1):
        here = place[j]
        while here - place[queue[0]] > length:
            queue.popleft()
        i = queue[0]
        best[j] = value[i] + length - here + cost[j]
        back[j] = i
        value[j] = v = best[j] + here
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    # The last window is cut into powers of two: no padding, a penalty for each cut.
    end, last = place[-1], n - 2
    least, start = None, last
    while last >= 0 and end - place[last] <= length:
        c = best[last] + SENTENCE * ((end - place[last]).bit_count() - 1)
        if least is None or c < least:
            least, start = c, last
        last -= 1
    out = [end]
    rest = end - place[start]
    while rest & (rest - 1):
        low = rest & -rest
        rest -= low
        out.append(place[start] + rest)
    j = start
    while j > 0:
        out.append(place[j])
        j = back[j]
    out.append(0)
    return out[::-1]


def pack_block(sizes: list[int], stops: list[np.ndarray], length: int = LENGTH) -> dict[str, np.ndarray]:
    """Pieces of a block: document number, start in it, length, window number, offset in it."""
    bounds = np.array(best_cuts(*places(sizes, stops), length), dtype=np.int64)
    ends = np.cumsum(sizes)
    cut = np.union1d(bounds, ends)
    lo, hi = cut[:-1], cut[1:]
    doc = np.searchsorted(ends, lo, side="right")
    window = np.searchsorted(bounds, lo, side="right") - 1
    return {"at": lo, "doc": doc, "start": lo - (ends[doc] - np.array(sizes)[doc]), "length": hi - lo, "window": window,
            "offset": lo - bounds[window]}


def _pack(it: Iterator[pa.RecordBatch], path: str, length: int, block: int, with_ids: bool, most: int) -> Iterator[pa.RecordBatch]:
    words, first = table(path), TaskContext.get().partitionId() << 32
    names, tokens, stops, held, ids_type = [], [], [], 0, None

    def flush() -> pa.RecordBatch:
        nonlocal names, tokens, stops, held, first
        sizes = [len(t) for t in tokens]
        p = pack_block(sizes, stops, length)
        flat = np.concatenate(tokens)
        runs = [flat[a:a + n] for a, n in zip(p["at"].tolist(), p["length"].tolist(), strict=True)]
        cols = {"id": pa.array(names, ids_type).take(pa.array(p["doc"])), "start": pa.array(p["start"]),
                "length": pa.array(p["length"]), "ids_crc32": pa.array([zlib.crc32(r.tobytes()) for r in runs], pa.int64()),
                "doc_tokens": pa.array(np.array(sizes, dtype=np.int64)[p["doc"]]), "sequence_id": pa.array(first + p["window"]),
                "offset": pa.array(p["offset"])}
        if with_ids:
            cols["ids"] = pa.array([r.astype(np.int32) for r in runs], pa.list_(pa.int32()))
        first += int(p["window"][-1]) + 1
        names, tokens, stops, held = [], [], [], 0
        pa.default_memory_pool().release_unused()
        return pa.RecordBatch.from_pydict(cols)

    for batch in it:
        ids_type = batch.column("id").type
        found = (x for _, some in few_texts(batch.column("text"), _SLICE) for x in tokenise(words, some, most=most))
        for name, (ids, ends) in zip(batch.column("id").to_pylist(), found, strict=True):
            names.append(name)
            tokens.append(ids)
            stops.append(ends)
            held += len(ids)
            if held >= block:
                yield flush()
    if names:
        yield flush()


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
         block: int = BLOCK, with_ids: bool = False, table_words: int = TABLE) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` per piece.

    ``path`` is the tokenizer's file, known to every executor; ``with_ids`` adds the
    pieces' token ids.  A process remembers ``table_words`` words, about 200 bytes
    each: more of them save encoding a word again.
    """
    rows = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("rid"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids array<int>" if with_ids else ""))
    ordered = rows.repartitionByRange("id", "rid").sortWithinPartitions("id", "rid")
    return ordered.mapInArrow(lambda it: _pack(it, path, length, block, with_ids, table_words), schema).withColumnRenamed("id", id_col)
