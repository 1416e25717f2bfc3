import zlib

import numpy as np
from conftest import SF_SMALL
from corpus_helpers import EDGES, docs

from dwkit.llm import toxicity as X

CHAIN = {"low_quality": "1 - quality", "toxic": "toxic"}


def test_held_out_accuracy(spark):
    d = spark.read.parquet(SF_SMALL.replace("0.001", "0.1") + "/documents.parquet")
    some = d.join(spark.read.parquet(SF_SMALL.replace("0.001", "0.1") + "/labels.parquet"), "doc_id").orderBy("doc_id").toPandas()
    fit, held = some[some.doc_id % 5 != 0], some[some.doc_id % 5 == 0]
    print(len(fit), len(held))
    chain = X.fit_chain(fit.text.tolist(), np.array([zlib.crc32(str(i).encode()) % 3 for i in fit.doc_id]),
                        {"low_quality": 1 - fit.quality.to_numpy(float), "toxic": fit.toxic.to_numpy(float)})
    p = np.array([chain.score(t)[1] for t in held.text]) >= chain.cuts[1]
    y = held.toxic.to_numpy() == 1
    print((p & y).sum() / y.sum(), (p & ~y).sum() / (~y).sum(), chain.cuts)
    assert (p & y).sum() / y.sum() > 0.9 and (p & ~y).sum() / (~y).sum() < 0.01


def test_later_models_learn_from_out_of_fold_probabilities():
    # "second" is what "first" is; only the chain's own column says so for unseen words.
    r = np.random.default_rng(0)
    texts = [f"{'bad' if i % 2 else 'good'} {' '.join(f'n{x}' for x in r.integers(0, 50, 5))}" for i in range(400)]
    y = np.array([float(i % 2) for i in range(400)])
    folds = np.arange(400) // 2 % 3
    chain = X.fit_chain(texts, folds, {"first": y, "second": y})
    assert len(chain.models[1].dense_w) == X._LETTER_NUMBERS + 1
    assert chain.score("bad")[1] > 0.5 > chain.score("good")[1]


def test_edges_and_empty(spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 1), (6, 0, None), (7, None, 1), (None, 1, 1), (99, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = X.classify(docs(spark, EDGES), labels, CHAIN, "toxic").collect()
    assert len(got) == len(EDGES) and all(0 <= r.p_toxic <= 1 and r.rejected is not None for r in got)
    assert X.classify(docs(spark, []), labels, CHAIN, "toxic").count() == 0
    none = labels.where("1 = 0")
    kept = X.keep_clean(docs(spark, EDGES), none, CHAIN, "toxic")
    assert kept.count() == len(EDGES) and kept.columns == docs(spark, EDGES).columns


def test_rare_toxic_rows_are_learned(spark):
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"n{x}" for x in r.integers(0, 200, 12)) + (" vile slur awful" if i % 500 == 3 else "")) for i in range(12_000)]
    labels = spark.createDataFrame([(i, 1, int(i % 500 == 3)) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x.rejected for x in X.classify(docs(spark, rows), labels, CHAIN, "toxic", sample=500).collect()}
    assert all(got[i] == (i % 500 == 3) for i in got)


def naive_fit(x, dense, y, rounds=300, rate=0.2, l2=1e-5):
    """One model on a dense 0/1 matrix, feature by feature; returns its probability of a row."""
    n, some = len(y), []
    for j in range(x.shape[1]):
        a, c, pos = float(x[:, j] @ y), float(x[:, j].sum()), y.sum()
        chi2 = n * (a * (n - pos) - (c - a) * pos) ** 2 / (pos * (n - pos) * c * (n - c)) if 0 < c < n else 0.0
        some += [j] if chi2 >= 12 else []
    mean, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-9
    z = np.hstack((x[:, some], (dense - mean) / scale, np.ones((n, 1))))
    theta = np.zeros(z.shape[1])
    theta[-1] = np.log(y.sum() / (n - y.sum()))
    up, var = theta * 0, theta * 0
    for t in range(1, rounds + 1):
        grad = z.T @ (1 / (1 + np.exp(-z @ theta)) - y) / n + l2 * np.append(theta[:-1], 0)
        up, var = 0.9 * up + 0.1 * grad, 0.999 * var + 0.001 * grad ** 2
        theta = theta - rate * (up / (1 - 0.9 ** t)) / (np.sqrt(var / (1 - 0.999 ** t)) + 1e-8)
    return lambda f, d: 1 / (1 + np.exp(-(np.concatenate((f[some], (d - mean) / scale, [1])) @ theta)))


def test_whole_result_against_a_naive_chain(spark):
    r = np.random.default_rng(8)
    rows = []
    for i in range(260):
        bad, poor = i % 5 == 0, i % 3 == 0
        ws = [f"n{x}" for x in r.integers(0, 40, 10)] + ["awful", "vile"][:1 + i % 2] * bad + ["spammy", "click"][:1 + i % 2] * poor
        rows.append((i, " ".join(r.permutation(ws)) + "!" * int(r.integers(0, 4))))
    labels = [(i, int(i % 3 != 0), int(i % 5 == 0)) for i in range(180)]
    got = X.classify(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), CHAIN, "toxic").collect()
    own = [{f for w in X.tokens(t) for f in X.features(w)} for _, t in rows]
    slots = [f for f in sorted(set().union(*own[:180])) if sum(f in o for o in own[:180]) >= 3]
    x = np.array([[float(f in o) for f in slots] for o in own])
    dense = np.array([X.letter_numbers(t) for _, t in rows])
    folds, train, want = np.array([zlib.crc32(str(i).encode()) % 3 for i in range(180)]), slice(0, 180), []
    for y in (np.array([1.0 - q for _, q, _ in labels]), np.array([float(t) for *_, t in labels])):
        final, held_out = naive_fit(x[train], dense[train], y), np.zeros(180)
        for f in range(3):
            part = naive_fit(x[train][folds != f], dense[train][folds != f], y[folds != f])
            held_out[folds == f] = [part(x[i], dense[i]) for i in np.flatnonzero(folds == f)]
        want.append([final(x[i], dense[i]) for i in range(260)])
        # Later models are trained with held-out probabilities and score with the final ones.
        seen = dense
        dense = np.column_stack((dense, np.concatenate((held_out, want[-1][180:]))))
        scoring = np.column_stack((seen, want[-1]))
        if len(want) == 1:
            final_2 = naive_fit(x[train], dense[train], np.array([float(t) for *_, t in labels]))
            second = [final_2(x[i], scoring[i]) for i in range(260)]
    p = {g.doc_id: (g.p_low_quality, g.p_toxic) for g in got}
    assert max(abs(p[i][0] - want[0][i]) for i in p) < 1e-6 and max(abs(p[i][1] - second[i]) for i in p) < 1e-6
    assert all(g.rejected == (i % 5 == 0) for g in got for i in [g.doc_id])
