"""Registered queries: oracles where there are any, and the declared columns."""

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from dwkit.llm.queries import ORACLES

COLUMNS = {
    "op1_language_id": "doc_id bigint, page_id bigint, lang string, confidence double, text_lang string, declared string",
    "op2_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op4_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5_decontamination": "doc_id bigint, item_id bigint, start bigint, similarity double",
    "op6_toxicity": "doc_id bigint, p_low_quality double, p_toxic double, rejected boolean",
    "op7_embedding_near_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op8_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op11_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
                                "audit string, repaired_sha256 string",
    "op12_nearest_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
    "op13_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                          "runs_sha256 string, collapsed_sha256 string",
    "op10_simhash_near_dedup": "doc_id bigint, fingerprint string, component_id bigint",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    df = E.queries()[name](spark, SF_SMALL).select(*cols)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_all_queries_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
