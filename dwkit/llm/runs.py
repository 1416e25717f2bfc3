"""Periodic runs of words by an online sparse diagonal programme.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``max(min_length, repeats * q)`` words long, that no neighbouring
word extends.  Words are read from left to right.  Lag q is a diagonal of the table
"word i equals word j"; only diagonals on which the last words matched are held, with
the word where the match began.  A word that recurs opens the diagonals of its earlier
occurrences, each further match makes them longer, and a diagonal that ends emits its
run at once if it is long enough.

What keeps the table sparse, without losing a run:

* a diagonal that ends in a run has at least ``ahead`` matches in a row (5 for the default
  bounds), so an occurrence counts only if the next ``ahead`` words recur with it (found by
  sorting hashes; the words themselves decide afterwards);
* a diagonal opens only where its match begins, so of the earlier occurrences only those
  after another word are looked at, and only if the run can still reach its length:
  there are words enough, and the last one needed agrees;
* lag q is not opened inside a stretch that a divisor of q already covers: both matches
  end at the same word, so q is not that stretch's smallest period.

Texts are handled alone, in Arrow batches; nothing is shuffled.

Edge cases: null and empty texts and texts without a word have no words and no runs (the
collapsed text of a null text is null, else empty); null ids and repeated rows are rows of
their own; other columns are ignored; an empty table gives no rows.  A text of any length
is read whole; one with the same word throughout takes time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.llm.common import small_batches
from dwkit.llm.subwords import few_texts

MIN_LENGTH, REPEATS = 6, 4
WORD = re.compile(r"[^ \t-\r]+")
_SLICE = 4_000_000
_ODD = 0x9E3779B97F4A7C15

Run = tuple[int, int, int]


def needed(q: int, min_length: int, repeats: int) -> int:
    """Matches in a row on the diagonal of lag ``q`` that make a run."""
    return max(min_length - q, (repeats - 1) * q, 1)


def runs_of(w: list[str], min_length: int = MIN_LENGTH, repeats: int = REPEATS) -> list[Run]:
    """``(start, length, period)`` of every run, by start, then period."""
    n = len(w)
    ahead = min(needed(q, min_length, repeats) for q in range(1, max(2, min_length)))
    if n <= ahead:
        return []
    # Hashes of the next ``ahead`` words; places where they recur.
    h = np.fromiter(map(hash, w), dtype=np.int64, count=n).view(np.uint64)
    key = np.zeros(n - ahead + 1, dtype=np.uint64)
    for k in range(ahead):
        key = key * np.uint64(_ODD) + h[k:n - ahead + 1 + k]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return []
    places = np.sort(order[np.concatenate((same, [False])) | np.concatenate(([False], same))])
    recurs = dict(zip(places.tolist(), key[places].tolist(), strict=True))
    coming = iter(places.tolist())

    found: list[Run] = []
    active: dict[int, int] = {}                                # lag -> word where its match began
    seen: dict[int, dict[str | None, list[int]]] = {}          # next words -> word before -> places
    i = next(coming)
    while i < n:
        if active:
            for q in [q for q in active if w[i] != w[i - q]]:
                _emit(found, q, active.pop(q), i, min_length, repeats)
        if (k := recurs.get(i)) is not None:
            before = w[i - 1] if i else None
            known = seen.setdefault(k, {})
            for other, earlier in known.items():
                if other != before:
                    for j in earlier:
                        q = i - j
                        last = i + needed(q, min_length, repeats) - 1
                        if last < n and w[last] == w[last - q] and w[i] == w[j] and not any(
                                q % d == 0 and began - d <= j for d, began in active.items()):
                            active[q] = i
            known.setdefault(before, []).append(i)
        if active:
            i += 1
        else:
            i = next((p for p in coming if p > i), n)
    for q, began in active.items():
        _emit(found, q, began, n, min_length, repeats)
    return sorted(found, key=lambda r: (r[0], r[2]))


def _emit(found: list[Run], q: int, began: int, end: int, min_length: int, repeats: int) -> None:
    start = began - q
    if end - start >= max(min_length, repeats * q):
        found.append((start, end - start, q))


def collapse(w: list[str], found: list[Run]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not found:
        return w
    keep = np.ones(len(w), dtype=bool)
    for start, length, q in found:
        keep[start + q:start + length] = False
    return [w[i] for i in np.flatnonzero(keep).tolist()]


def _batches(it: Iterator[pa.RecordBatch], alter: Callable | None, min_length: int, repeats: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for first, texts in few_texts(batch.column("text"), _SLICE):
            numbers, found, kept = [], [], []
            for text, name in zip(texts, batch.column("id").slice(first, len(texts)).to_pylist(), strict=True):
                w = WORD.findall(text or "")
                if alter is not None:
                    w = alter(name, w)
                runs = runs_of(w, min_length, repeats)
                numbers.append(len(w))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                kept.append(None if text is None else " ".join(collapse(w, runs)))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").slice(first, len(texts)), pa.array(numbers, schema.field("n_words").type),
                pa.array(found, schema.field("runs").type), pa.array(kept, pa.string())], schema=schema)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
         repeats: int = REPEATS, alter: Callable[[object, list[str]], list[str]] | None = None) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` per row of ``docs``: all runs by start, then period, and the
    words outside their repetitions, joined by spaces.  ``alter`` may change a row's words first."""
    from pyspark.sql.pandas.types import to_arrow_type
    rows = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    schema = pa.schema([("id", to_arrow_type(kind)), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])
    of = partial(_batches, alter=alter, min_length=min_length, repeats=repeats, schema=schema)
    return (rows.mapInArrow(of, f"id {kind.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
            .withColumnRenamed("id", id_col))
