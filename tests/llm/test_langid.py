import numpy as np
from conftest import SF_SMALL
from corpus_helpers import EDGES, docs

from dwkit.llm import langid as L


def test_accuracy_on_held_out_documents(spark):
    d = spark.read.parquet(SF_SMALL.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text", "lang").toPandas()
    fit, held = d[d.doc_id % 2 == 0], d[d.doc_id % 2 == 1]
    langs = L.Languages(fit.text.tolist(), fit.lang.tolist())
    got = [langs.names[int(np.argmax(langs.likelihood(t)))] for t in held.text]
    assert np.mean([a == b for a, b in zip(got, held.lang)]) > 0.97


def brute(rows, names, strength):
    """The fusion formula, row by row."""
    k = len(names)
    p = []
    for r in rows:
        e = np.exp(np.array(r[1]) - max(r[1]))
        p.append(e / e.sum())
    whole, out = sum(p), []
    for at, r in enumerate(rows):
        prior = (whole - p[at] + 1) / (len(rows) - 1 + k)
        for by in (3, 4, 5):
            if r[by] is not None:
                same = [j for j, q in enumerate(rows) if q[by] == r[by]]
                prior = (sum(p[j] for j in same) - p[at] + strength * prior) / (len(same) - 1 + strength)
        logs = np.array(r[1]) + np.log(prior)
        if r[2] is not None:
            same = [j for j, q in enumerate(rows) if q[2] == r[2]]
            logs += np.log((sum(p[j] for j in same) - p[at] + strength * len(same) / len(rows)) / (whole - p[at] + strength))
        e = np.exp(logs - logs.max())
        out.append((r[0], names[int(np.argmax(e))], round(float((e / e.sum()).max()), 9)))
    return sorted(out)


def test_fusion_against_brute_force(spark):
    r = np.random.default_rng(2)
    rows = []
    for i in range(200):
        host = f"h{i % 7}.x{i % 3}.{'de' if i % 2 else 'com'}" if i % 5 else None
        ll = (r.standard_normal(3) * 2).tolist() if i % 4 else [0.0, 0.0, 0.0]
        rows.append((i, ll, [None, "a", "b", "zz"][i % 4], host and host.split(".")[-1], host and ".".join(host.split(".")[1:]), host))
    frame = spark.createDataFrame(rows, "id long, ll array<double>, declared string, suffix string, domain string, host string")
    got = sorted((x.id, x.lang, round(x.confidence, 9)) for x in L.fuse(frame, ["a", "b", "c"], 5.0).collect())
    assert got == brute(rows, ["a", "b", "c"], 5.0)


def test_host_prior_decides_where_the_text_does_not(spark):
    rows = [(i, [0.0, -9.0], None, "com", "x.com", "a.x.com") for i in range(30)] + [(i, [-9.0, 0.0], None, "com", "y.com", "b.y.com") for i in range(30, 60)]
    rows += [(100, [0.0, 0.0], None, "com", "x.com", "a.x.com"), (101, [0.0, 0.0], None, "com", "y.com", "b.y.com"), (102, [0.0, 0.0], None, "com", "y.com", "new.y.com")]
    frame = spark.createDataFrame(rows, "id long, ll array<double>, declared string, suffix string, domain string, host string")
    got = {x.id: x.lang for x in L.fuse(frame, ["p", "q"]).collect()}
    assert (got[100], got[101], got[102]) == ("p", "q", "q")


def test_addresses_and_markup(spark):
    rows = [("http://User@Www.A.example.DE:80/x?y", "<!DOCTYPE html><HTML class=x LANG='De-AT'><script>var the='</p>'</script><p>ja &amp; nein"),
            ("nonsense", "<html><body>no language"), (None, None), ("", ""), ("ftp://1.2.3.4/", "<html lang=fr>")]
    df = spark.createDataFrame(rows, "url string, html string")
    got = df.select(L.host_of(df.url).alias("h"), L.declared_language(df.html).alias("d")).collect()
    assert [tuple(x) for x in got] == [("www.a.example.de", "de"), (None, None), (None, None), (None, None), ("1.2.3.4", "fr")]
    assert L.visible(rows[0][1]).split() == ["ja", "&", "nein"]


def test_edges_and_empty(spark):
    langs = L.Languages(["the quick brown fox", "der schnelle braune fuchs"], ["en", "de"])
    got = L.identify(L.text_rows(docs(spark, EDGES), langs), langs).collect()
    assert len(got) == len(EDGES) and all(x.lang in ("en", "de") and 0 < x.confidence <= 1 for x in got)
    assert L.identify(L.text_rows(docs(spark, []), langs), langs).count() == 0
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "http://a/", "", "y"), (1, "http://a/", "<html lang=en>the fox", "z")],
                                  "page_id long, url string, html string, host string")
    assert L.identify(L.page_rows(pages, langs), langs).count() == 3
    none = L.train(docs(spark, []))
    assert none.names == [] and {x.lang for x in L.identify(L.text_rows(docs(spark, EDGES), none), none).collect()} == {None}


def test_rare_languages_are_candidates(spark):
    words = {"en": "the quick fox and the dog", "de": "der schnelle fuchs und der hund", "is": "hinn snöggi refur og hundurinn þar"}
    rows = [(i, words["is" if i % 1000 == 7 else "en" if i % 2 else "de"], "is" if i % 1000 == 7 else "en" if i % 2 else "de", "s") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    langs = L.train(df, sample=40)
    assert langs.names == ["de", "en", "is"]
    assert langs.names[int(np.argmax(langs.likelihood("refur og hundurinn")))] == "is"
