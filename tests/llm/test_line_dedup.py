import random

from corpus_helpers import EDGES, docs

from dwkit.llm import line_dedup


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(rows, min_words=10):
    first, lines = {}, []
    for i, text in rows:
        for pos, line in enumerate((text or "").split("\n")):
            w = tuple(line.lower().split())
            lines.append((i, pos, line, w))
            if w and (w not in first or (i, pos) < first[w]):
                first[w] = (i, pos)
    near = {w for w in first if len(w) >= min_words
            and any(len(v) >= min_words and first[v] < first[w] and one_edit(w, v) for v in first if v != w)}
    out = {}
    for i, pos, line, w in lines:
        if not (w and (w in near or first[w] != (i, pos))):
            out.setdefault(i, []).append(line)
    return {i: None if t is None else "\n".join(out.get(i, [])) for i, t in rows}


def test_brute_force(spark):
    r = random.Random(3)
    base = [[r.choice("abcdefgh") for _ in range(r.randint(8, 14))] for _ in range(40)]

    def line():
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            at = r.randrange(len(w))
            w = r.choice([w[:at] + w[at + 1:], [*w[:at], "Z", *w[at:]], [*w[:at], "q", *w[at + 1:]]])
        return r.choice(["", " "]) + r.choice([" ", "  ", "\t"]).join(w).capitalize()
    rows = [(i, "\n".join(line() for _ in range(r.randint(0, 6)))) for i in range(120)]
    got = {x.doc_id: x.text for x in line_dedup.dedup(docs(spark, rows)).collect()}
    assert got == brute(rows)


def test_one_common_template(spark):
    rows = [(i, f"this line is common to all but for one word here: {i}\nown line {i}") for i in range(400)]
    got = {x.doc_id: x.text for x in line_dedup.dedup(docs(spark, rows)).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"own line {i}" for i in range(1, 400))


def test_edges_and_empty(spark):
    rows = line_dedup.dedup(docs(spark, EDGES), counts=True).collect()
    assert len(rows) == len(EDGES)
    got = [(r.doc_id, r.text) for r in rows]
    assert got.count((1, EDGES[0][1])) == 2          # rows of the same id and text are alike
    assert (6, "") in got and (2, None) in got and (3, "") in got and (4, " \t\n ") in got and (5, EDGES[5][1]) in got
    assert rows[0].asDict().keys() >= {"id", "doc", "gone", "n_lines", "n_dropped"}
    assert line_dedup.dedup(docs(spark, [])).count() == 0
