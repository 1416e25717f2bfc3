import random
import zlib

import numpy as np
from corpus_helpers import EDGES, docs
from tokenizers import Tokenizer

from dwkit.llm import packing, subwords
from dwkit.llm.queries import tokenizer

ODD = ["it's John's <|endoftext|> <|ENDOFTEXT|> a<|endoftext|>b don't we'll éa é.", "²½ x² ΣΑΣ İstanbul",
       "\x1c a\x1cb  x y \xa0z 中文字 a.b,c ,, 'tis '' 'S x_ _x", "ﬁx ǅa 1,000.50 $5 a\tb\r\nc\x0bd", "word, word. Word!? (word) %%% a%%% ̀b"]


def check(rows, texts):
    own = Tokenizer.from_file(tokenizer())
    want = {}
    for i, t in texts:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.setdefault(i, []).append(ids)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == want.keys()
    for i, pieces in by.items():
        if len(want[i]) == 1:                # ids on one row: the pieces tile its ids
            at, ids = 0, want[i][0]
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
                assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
    assert sum(r.length for r in rows) == sum(len(x) for xs in want.values() for x in xs)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
    for w in windows.values():
        at = 0
        for p in sorted(w, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    return [sum(p.length for p in w) for w in windows.values()]


def test_edges_and_empty(spark):
    rows = EDGES + [(20 + i, t) for i, t in enumerate(ODD)]
    check(packing.pack(docs(spark, rows), tokenizer()).collect(), rows)
    assert packing.pack(docs(spark, []), tokenizer()).count() == 0


def test_little_padding_and_ids(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["alpha", "beta.", "gamma", "delta!"]) for _ in range(r.randint(1, 1500)))) for i in range(300)]
    got = packing.pack(docs(spark, rows), tokenizer(), block=100_000, with_ids=True).collect()
    assert all(zlib.crc32(np.array(p.ids, dtype="<u4").tobytes()) == p.ids_crc32 for p in got)
    sizes = check(got, rows)
    padding = sum(2048 - s for s in sizes if s & (s - 1))
    assert padding / (sum(sizes) + padding) < 0.01


def plain_best(cuts, pen, length):
    """All cut places against all before them; the last window as powers of two."""
    n = len(cuts)
    best = [0] + [None] * (n - 1)
    for j in range(1, n - 1):
        best[j] = min(best[i] + length - (cuts[j] - cuts[i]) + pen[j] for i in range(j) if cuts[j] - cuts[i] <= length)
    return min(best[i] + packing.SENTENCE * ((cuts[-1] - cuts[i]).bit_count() - 1) for i in range(n - 1) if cuts[-1] - cuts[i] <= length)


def test_dynamic_programme_is_optimal():
    r = random.Random(7)
    for _ in range(60):
        sizes = [r.randint(1, 90) for _ in range(r.randint(1, 12))]
        stops = [np.array(sorted(r.sample(range(1, n + 1), r.randint(0, min(n, 5)))), dtype=np.int64) for n in sizes]
        cuts, pen = packing.places(sizes, stops, grid=8)
        assert np.diff(cuts).max(initial=0) <= 8 and cuts[-1] == sum(sizes)
        bounds = packing.best_cuts(cuts, pen, 64)
        at = dict(zip(cuts.tolist(), pen.tolist()))
        last = next(k for k in range(len(bounds)) if bounds[-1] - bounds[k] <= 64 and all(
            (b - a) & (b - a - 1) == 0 for a, b in zip(bounds[k:], bounds[k + 1:])))
        costs = []
        for k in range(last, len(bounds) - 1):         # where the last window began is not marked: the least is the plan's cost
            if bounds[-1] - bounds[k] <= 64 and all(b in at for b in bounds[:k + 1]):
                costs.append(sum(64 - (b - a) + at[b] for a, b in zip(bounds[:k], bounds[1:k + 1]))
                             + packing.SENTENCE * ((bounds[-1] - bounds[k]).bit_count() - 1))
        assert min(costs) == plain_best(cuts.tolist(), pen.tolist(), 64)


def test_word_table_forgets(spark):
    t = subwords.WordTable(tokenizer())
    a = t.ids(t.numbers([b"alpha", b"beta,"]))[0].tolist()
    t.trim(1)
    assert not t.at and t.ids(t.numbers([b"alpha", b"beta,"]))[0].tolist() == a
