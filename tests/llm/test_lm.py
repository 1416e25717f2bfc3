import random
import re
import zlib
from collections import Counter

import numpy as np
from corpus_helpers import EDGES, docs

from dwkit.llm import lm, subwords
from dwkit.llm.queries import tokenizer


def texts(n=120, seed=3):
    r = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in"]
    return [" ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 80))) for _ in range(n)]


def model(steps=60):
    t = subwords.table(tokenizer())
    return lm.fit([t.ids(t.numbers(subwords.folded(x)))[0] for x in texts()], steps=steps)


def check(rows, got):
    words = {}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        words.setdefault(i, []).append(re.findall(r"[^\x20\x09-\x0D]+", low))
    out = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in words}
    count, n_docs = Counter(), 0
    for i, many in words.items():
        for w in many:
            if not out[i]:
                count.update(w)
                n_docs += 1
    total, kinds = count.total() + n_docs, len(count) + (n_docs > 0)
    below = total + 0.1 * (kinds + 1)
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == out[r.doc_id] and r.train_tokens == total and r.score <= 0
        want = [(len(w) + 1, sum(count[x] > 0 for x in w) + (n_docs > 0),
                 round(sum(np.log10((count[x] + 0.1) / below) for x in w) + np.log10((n_docs + 0.1) / below), 6)) for w in words[r.doc_id]]
        assert (r.n_tokens, r.n_known, round(r.base_score, 6)) in want


def test_base_counts_over_blocks(spark):
    rows = EDGES + [(100 + i, t) for i, t in enumerate(texts())]
    check(rows, lm.score(docs(spark, rows).repartition(5), model(2), tokenizer(), block_words=300).collect())


def test_empty_tables_and_no_training_documents(spark):
    m = lm.train(docs(spark, []), tokenizer())
    assert lm.score(docs(spark, []), m, tokenizer()).count() == 0
    rows = [(i, "some words here") for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0]
    check(rows, lm.score(docs(spark, rows), m, tokenizer()).collect())


def test_windows_score_each_id_once_with_its_context():
    m, t = model(), subwords.table(tokenizer())
    ids = t.ids(t.numbers(subwords.folded(" ".join(texts(5)))))[0]
    flow = np.concatenate((ids, [lm.END])).astype(np.int64)
    before = m.entry[np.concatenate(([0], flow[:-1]))]
    before[0] = lm.KEPT
    p, total = m.p, 0.0
    for at in range(len(flow)):                      # one place at a time
        lo = max(0, at - at % lm.STRIDE - lm.CONTEXT)
        x = p["e"][before[lo:at + 1]]
        s = (x[-1] @ p["q"]) @ (x @ p["k"]).T / np.sqrt(lm.WIDTH) + p["ago"][at - np.arange(lo, at + 1)]
        a = np.exp(lm._log_softmax(s))
        h = x[-1] + (a @ (x @ p["v"])) @ p["o"]
        h = h + np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"]
        c, k = divmod(int(m.entry[flow[at]]), lm._MEMBERS)
        logs = lm._log_softmax(h @ p["c"].T + p["bc"])[c] + lm._log_softmax(h @ p["m"][c].T + p["bm"][c])[k]
        total += logs / np.log(10) + m.rare[flow[at]]
    assert abs(m.log10([ids])[0] - total) < 1e-2
    many = [ids[:n] for n in (0, 1, 15, 16, 17, 40)]
    assert np.allclose(m.log10(many), [m.log10([x])[0] for x in many], atol=1e-3)


def test_probabilities_sum_to_one():
    m = model(5)
    rare = np.flatnonzero(m.entry == m.entry[lm.BOS])
    assert abs((10.0 ** m.rare[rare]).sum() - 1) < 1e-6
    one = np.array([[m.entry[3]]])
    assert len(np.unique(m.entry)) == lm.KEPT and one.shape == (1, 1)


def test_gradients():
    m = model(3)
    r = np.random.default_rng(0)
    for k in m.p:
        m.p[k] = m.p[k].astype(np.float64)
    sizes = np.array([20, 7])
    ids = r.integers(0, lm.KEPT, 27)
    w = lm.Windows.over(ids, sizes)
    keys, seen, query, counts = w.take(np.arange(len(w.first)))
    args = keys, seen, ids[query], counts, r.integers(0, lm.KEPT, query.shape)
    _, g = m.step(*args)
    for name in ("e", "q", "k", "v", "o", "ago", "w1", "b1", "w2", "c", "bc", "m", "bm"):
        flat = np.flatnonzero(np.abs(g[name]).ravel() > 1e-4)
        for at in r.choice(flat, 3):
            x = m.p[name].reshape(-1)
            old = x[at]
            x[at] = old + 1e-5
            up = m.step(*args)[0]
            x[at] = old - 1e-5
            down = m.step(*args)[0]
            x[at] = old
            assert abs((up - down) / 2e-5 - g[name].ravel()[at]) < 2e-3 * max(1e-2, abs(g[name].ravel()[at])) + 1e-5, name


def test_attention_learns_what_follows_what():
    # Each word has one successor, so all but the first can be known.
    t, r = subwords.table(tokenizer()), random.Random(2)
    ring = [f"{a}{b}" for a in ("th", "er", "on", "an") for b in ("re", "he", "in", "at")]

    def walk():
        at, n = r.randrange(len(ring)), r.randint(10, 60)
        return t.ids(t.numbers([ring[(at + 5 * i) % len(ring)].encode() for i in range(n)]))[0]
    seen, held = [walk() for _ in range(100)], [walk() for _ in range(30)]
    plain, trained = lm.fit(seen, steps=0).log10(held).sum(), lm.fit(seen, steps=300).log10(held).sum()
    assert trained > 0.4 * plain


def test_all_training_documents_are_learned(spark):
    # The start sees 10 documents; the words of the others count, and so does their order.
    t, rows = subwords.table(tokenizer()), [(i, "the small cat sat on the mat") for i in range(400)]
    rows += [(i, " ".join(["zebra quagga okapi"] * 60)) for i in range(400, 800)]
    df = docs(spark, rows).repartition(2)
    ids = t.ids(t.numbers(subwords.folded("zebra quagga okapi")))[0].astype(int)
    flow = [t.ids(t.numbers(subwords.folded(x)))[0] for i, x in rows if zlib.crc32(str(i).encode()) % 10]
    start = df.where("doc_id < 400")
    few = lm.train(start, tokenizer(), sample=10, steps=20)
    full = lm.train(df, tokenizer(), sample=10, steps=20)
    assert len(set(full.entry[ids])) == len(set(ids)) and all((full.entry != full.entry[x]).sum() == lm.IDS - 1 for x in ids)
    assert np.array_equal(full.entry, lm._entries(flow)[0]) and np.allclose(full.rare, lm._entries(flow)[1], atol=1e-6)
    one = flow[-1]
    assert full.log10([one])[0] > 0.5 * few.log10([one])[0]
    raw = lm.fit(flow[:10], steps=20, layout=(full.entry, full.rare))
    assert full.log10([one])[0] > raw.log10([one])[0]


def test_every_window_of_the_training_texts_is_learned_from(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts())]
    df, seen = docs(spark, rows), []
    step = lm.Adam.step
    monkeypatch.setattr(lm.Adam, "step", lambda self, w, want, some, rate: (seen.extend(some.tolist()), step(self, w, want, some, rate)))
    t = subwords.table(tokenizer())
    want = sum(-(-(len(t.ids(t.numbers(subwords.folded(x)))[0]) + 1) // lm.STRIDE) for i, x in rows if zlib.crc32(str(i).encode()) % 10)
    m, n = model(2), 0
    seen.clear()
    for row in lm.corpus(df.coalesce(1), tokenizer()).where("NOT is_word").select(*lm._TEXTS).toArrow().to_pylist():
        n += lm._passed(row, m, 64, 0.001)[1]
    assert n == want == len(seen) == len(set(seen))
