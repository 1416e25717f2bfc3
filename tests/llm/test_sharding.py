import hashlib
import itertools
import zlib

import pyarrow.parquet as pq
from corpus_helpers import EDGES, docs
from pyspark.sql import functions as F

from dwkit.llm import sharding


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r.text_crc32) for r in rows) == want
    return {s: sum(r["size"] for r in p) for s, p in by.items()}


def test_edges_and_empty(spark):
    check(sharding.shard(docs(spark, EDGES), 4).collect(), [t for _, t in EDGES], 4)
    assert sharding.shard(docs(spark, []), 4).count() == 0


def test_sizes_near_equal_and_equal_texts_together(spark):
    rows = [(i, f"text {i % 700} " + "x" * (i % 97)) for i in range(3000)]
    got = sharding.shard(docs(spark, rows), 8).collect()
    sizes = check(got, [t for _, t in rows], 8)
    target = sum(sizes.values()) / 8
    assert max(abs(s - target) for s in sizes.values()) <= 2 * target / 64 + 200
    text = dict(rows)
    where = {}
    for r in got:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert max(map(len, where.values())) == 1


def test_a_group_of_a_third_of_all_rows_is_split(spark):
    rows = [(i, "same text for all of them" if i % 3 == 0 else f"text number {i} of its own") for i in range(3000)]
    sizes = check(sharding.shard(docs(spark, rows), 8).collect(), [t for _, t in rows], 8)
    target = sum(sizes.values()) / 8
    assert max(abs(s - target) for s in sizes.values()) <= 2 * target / 64 + 60


def test_documents_are_placed_and_written_whole(spark, tmp_path):
    rows = [(i, None if i % 50 == 0 else f"text {i % 70} " + "y" * (i % 31)) for i in range(900)] + [(3, "again"), (3, "again"), (None, "z")]
    df = docs(spark, rows).withColumns({"shard": F.lit("mine"), "size": F.lit(1), "rid": F.lit("r"), "row": F.lit("w"), "id": F.lit("i")})
    placed = sharding.place(df, 4)
    assert placed.columns == [c for c in df.columns if c != "shard"] + ["shard", "slot"]
    got = placed.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    assert all((r["size"], r.rid, r.row, r.id) == (1, "r", "w", "i") for r in got)
    sharding.write(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(((r.doc_id, r.text, r.shard) for r in back.collect()), key=str) == sorted(((r.doc_id, r.text, r.shard) for r in got), key=str)
    for s in range(4):
        files = sorted((tmp_path / "out" / f"shard={s}").glob("*.parquet"))
        slots = [x for f in files for x in pq.read_table(f, columns=["slot"])["slot"].to_pylist()]
        assert slots == list(range(len(slots)))


def test_shards_are_the_cuts_of_the_running_sum(spark):
    """Placement again in plain Python: order by digest, groups whole, cut at equal targets."""
    rows = [(i, f"text {i % 400} " + "x" * (i % 57)) for i in range(2000)] + [(5000 + i, "") for i in range(3)] + [(6000, None)]
    size = {i: len((t or "").encode()) + 1 for i, t in rows}
    total, want, before = sum(size.values()), {}, 0
    order = sorted(rows, key=lambda r: (hashlib.md5((r[1] or "").encode()).hexdigest(), r[0]))
    for _, group in itertools.groupby(order, key=lambda r: r[1] or ""):
        group = list(group)
        large = sum(size[i] for i, _ in group) * 8 * 64 > total
        start = before
        for i, _ in group:
            want[i] = min(7, (before if large else start) * 8 // total)
            before += size[i]
    slots = {}
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard(docs(spark, rows), 8).collect()}
    for i, _ in order:
        assert got[i] == (want[i], slots.setdefault(want[i], 0))
        slots[want[i]] += 1
