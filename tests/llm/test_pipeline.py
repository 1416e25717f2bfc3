"""Each stage against the operator's brute force on the stage's own input."""

import shutil

from conftest import SF_SMALL
from corpus_helpers import EDGES, docs
from test_decontam import brute as leaks
from test_line_dedup import brute as lines
from test_packing import check as packed
from test_simhash import brute_components

import __spark_entry__ as E
import corpus_pipeline as P
from dwkit.llm import toxicity
from dwkit.llm.common import staged
from dwkit.llm.queries import CATEGORIES


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    steps, df = [source], source
    for name, stage in P.STAGES:
        df = staged(stage(spark, df, SF_SMALL), f"test-{name}")
        steps.append(df)
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]
    assert all(s.schema == source.schema for s in steps[:-1])
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    chain = toxicity.train(source, labels, CATEGORIES)
    assert sorted(pairs(steps[1])) == sorted((i, t) for i, t in pairs(source) if chain.score(t)[1] < chain.cuts[1])
    kept, known = {i for i, _ in pairs(steps[1])}, {r.doc_id: r.toxic for r in labels.collect()}
    clean = [i for i, _ in pairs(source) if known.get(i) == 0]
    assert sum(i in kept for i in clean) / len(clean) > 0.98
    assert dict(pairs(steps[2])) == lines(pairs(steps[1]))
    assert {i for i, _ in pairs(steps[3])} == {c for _, _, c in brute_components(pairs(steps[2]))}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    hit = {d for d, *_ in leaks([(i, t) for i, t in pairs(steps[3]) if len(t) < 3000], items)}
    assert not hit & {i for i, _ in pairs(steps[4])}
    assert {i for i, t in pairs(steps[3]) if len(t) < 3000} - hit <= {i for i, _ in pairs(steps[4])}
    packed(steps[5].collect(), pairs(steps[4]))


def test_registered_and_runs(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path)
    assert E.queries()["pipeline"](spark, str(tmp_path)).count() > 0


def test_edges_through_all_stages(spark):
    for rows in (EDGES, []):
        df = docs(spark, rows)
        for name, stage in P.STAGES:
            df = staged(stage(spark, df, SF_SMALL), f"edge-{name}")
        assert (df.count() > 0) == bool(rows)
