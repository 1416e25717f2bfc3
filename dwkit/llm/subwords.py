"""Subword ids of texts, word by word, from a table of the words met before.

For a tokenizer that drops white space and never joins across it, a text's ids are
the ids of its words in turn.  Each worker process keeps one table per tokenizer
file, so a word is encoded once per process (until ``TABLE`` words are held).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TABLE = 500_000                # words a process remembers, about 120 MB
_STOPS = (b".", b"!", b"?", "…".encode())
_ENDED = re.compile(r"([^\W\d_]+)([!-/:-;=-@\[-`{}~]+)$")      # letters and ASCII signs but < and |
_ENDED_ASCII = re.compile(rb"([a-z]+)([!-/:-;=-@\[-`{}~]+)$")
_JOINED = 256
_tables: dict[str, "WordTable"] = {}


def table(path: str) -> "WordTable":
    """This process's table for a tokenizer file."""
    if path not in _tables:
        _tables[path] = WordTable(path)
    return _tables[path]


def folded(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def few_texts(column: pa.Array, most: int) -> Iterator[tuple[int, list[str | None]]]:
    """A column's texts in runs of ``most`` bytes (one text, if that alone is longer),
    with the first one's place; only a run at a time is Python objects."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    lo = held = 0
    for at, size in enumerate(sizes):
        if at > lo and held + size > most:
            yield lo, column.slice(lo, at - lo).to_pylist()
            lo, held = at, 0
        held += size
    if lo < len(sizes):
        yield lo, column.slice(lo).to_pylist()


def tokenizer_words(text: str | None) -> list[bytes]:
    """Words for a tokenizer that ignores case; special tokens must keep theirs."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw if b"<|" in raw else raw.lower()).split()


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return lens, np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(lens.sum()))


class WordTable:
    """Words numbered as they come, with their ids."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)       # tokens that end a word
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.used = 0
        self.flat = np.zeros(1 << 18, dtype="<u4")
        self.starts, self.lens = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)
        self.stop = np.zeros(1 << 16, dtype=bool)

    def trim(self, most: int = TABLE) -> None:
        """Forget all words once there are too many; numbers given before are void then."""
        if len(self.at) > most:
            self.clear()

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate((a, np.zeros(max(len(a), n - len(a)), dtype=a.dtype)))

    def _append(self, new: list[bytes], lens: np.ndarray, ids: np.ndarray) -> None:
        lo, hi, total = len(self.at), len(self.at) + len(new), len(ids)
        self.flat = self._room(self.flat, self.used + total)
        self.starts, self.lens, self.stop = (self._room(a, hi) for a in (self.starts, self.lens, self.stop))
        self.flat[self.used:self.used + total] = ids
        self.starts[lo:hi] = self.used + np.cumsum(lens) - lens
        self.lens[lo:hi] = lens
        self.stop[lo:hi] = [w.endswith(_STOPS) for w in new]
        self.at.update(zip(new, range(lo, hi), strict=True))
        self.used += total

    def _encode(self, letters: list[bytes], alone: list[bytes]) -> None:
        """Encode words; those of letters alone together, as each is one run of tokens up to a word's end."""
        for at in range(0, len(letters), _JOINED):
            some = letters[at:at + _JOINED]
            ids = np.array(self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False).ids, dtype=np.int64)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                self._append(some, np.diff(ends, prepend=0), ids)
            else:
                alone = alone + some
        got = [e.ids for e in self.tokenizer.encode_batch([w.decode("utf-8", "surrogatepass") for w in alone], add_special_tokens=False)]
        self._append(alone, *_flat(got))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers in the table."""
        own = np.fromiter(map(self.at.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        unknown = np.flatnonzero(own < 0).tolist()
        if unknown:
            self._learn({words[i] for i in unknown})
            own[unknown] = [self.at[words[i]] for i in unknown]
        return own

    def _learn(self, new: set[bytes]) -> None:
        # Signs after letters are a token run of their own: take the letters' ids before theirs.
        letters, alone, ended = {w for w in new if w.isalpha()}, set(), []
        for w in new - letters:
            if m := _ENDED_ASCII.match(w):
                ended.append((w, *m.groups()))
            elif w.isascii():
                alone.add(w)
            elif (s := w.decode("utf-8", "surrogatepass")).isalpha():
                letters.add(w)
            elif m := _ENDED.match(s):
                ended.append((w, m[1].encode(), m[2].encode()))
            else:
                alone.add(w)
        letters.update(e[1] for e in ended if e[1] not in self.at)
        alone.update(e[2] for e in ended if e[2] not in self.at)
        self._encode(list(letters), list(alone))
        if ended:
            ids, lens = self.ids(np.array([self.at[part] for e in ended for part in e[1:]]))
            self._append([e[0] for e in ended], lens.reshape(-1, 2).sum(axis=1), ids)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered words in turn, and how many each word has."""
        lens = self.lens[numbers]
        flat = np.repeat(self.starts[numbers] - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))
        return self.flat[flat], lens
