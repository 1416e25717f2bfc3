"""Registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dwkit.llm import conversations, decontam, embed_dedup, langid, line_dedup, lm, neighbours, packing, runs, sharding, simhash, toxicity, warc
from dwkit.llm.common import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, with all their evidence, and all documents, with text and source."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    languages = langid.train(docs)
    of_docs = langid.identify(langid.text_rows(docs, languages), languages)
    of_pages = langid.identify(langid.page_rows(pages, languages), languages)
    none = F.lit(None).cast("long")
    return (of_docs.withColumnRenamed("id", "doc_id").withColumn("page_id", none)
            .unionByName(of_pages.withColumnRenamed("id", "page_id").withColumn("doc_id", none))
            .select("doc_id", "page_id", "lang", "confidence", "text_lang", "declared"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs, counts=True)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The labelled categories of ``labels``, in the chain's order.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), CATEGORIES, reject="toxic")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link(table(spark, sf_dir, "embeddings"), threshold=0.93)


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Alone in its executors, so its processes may remember more words than in the pipeline.
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), table_words=1_500_000)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    blocks = lm.corpus(docs, tokenizer())                 # tokenised once, for both
    return lm.score(docs, lm.train(docs, tokenizer(), blocks=blocks), tokenizer(), blocks=blocks)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, bound=3)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fifth or so of their turns dropped, emptied, cut off, doubled or given to the user."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), space) for c in ("role", "text"))
    return (rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy"))


def _digests(it: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines; rows come in order, and only a batch of them is held."""
    name, sha = None, None
    for batch in it:
        ids, hashes = [], []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            if sha is not None and conv == name:
                sha.update(b"\n" + line)
                continue
            if sha is not None:
                ids.append(name)
                hashes.append(sha.hexdigest())
            name, sha = conv, hashlib.sha256(line)
        yield pa.RecordBatch.from_arrays([pa.array(ids, schema.field(0).type), pa.array(hashes, pa.string())], schema=schema)
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], schema.field(0).type), pa.array([sha.hexdigest()], pa.string())], schema=schema)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    fixed = conversations.repair(damaged(rows))
    kind = rows.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("sha", pa.string())])
    digests = (small_batches(fixed.turns).repartition("conv_id").sortWithinPartitions("conv_id", "block", "place").select("conv_id", "role", "text")
               .mapInArrow(lambda it: _digests(it, schema), f"conv_id {kind.simpleString()}, sha string"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (rows.select("conv_id").distinct().unionByName(fixed.report, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
            .groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
                                    F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                    F.coalesce(F.max("sha"), F.sha2(F.lit(b""), 256)).alias("repaired_sha256")))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def looped(doc_id: int | None, w: list[str]) -> list[str]:
    """A tenth of the documents, by the hash of the id (null: none of its digits), repeat their words from one on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return w[:a] + (w[a:a + p] * (1 + (len(w) - a) // p))[:len(w) - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find(table(spark, sf_dir, "documents"), alter=looped)
    # The longest, then the first, then that of the smallest period.
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (found.select("*", top.alias("top"))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.col2")).alias("start"),
                    F.col("top.length").alias("length"), (-F.col("top.col3")).alias("period"),
                    F.floor(1000 * F.col("top.length") / -F.col("top.col3")).alias("exponent_milli"),
                    F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256")))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_sharding": op2_sharding,
    "op3_line_dedup": op3_line_dedup,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_packing": op8_packing,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op3_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM documents),
norm AS (
  SELECT doc_id, pos, line, list_filter(regexp_split_to_array(
    lower(line), '[ \t-\r]+'), lambda x: x <> '') AS w FROM lines),
keyed AS (SELECT doc_id, pos, line, array_to_string(w, ' ') AS k, w, len(w) AS n FROM norm),
firsts AS (
  SELECT k, any_value(w) AS w, any_value(n) AS n, min({'d': doc_id, 'p': pos}) AS f FROM keyed WHERE n > 0 GROUP BY k),
variants AS (
  SELECT k, f, gap, array_to_string(list_concat(w[:gap - 1], w[gap + 1:]), ' ') AS v
  FROM (SELECT k, f, w, unnest(range(1, n + 1)) AS gap FROM firsts WHERE n >= 10)),
best AS (SELECT v, gap, min(f) AS f FROM variants GROUP BY v, gap),
any_gap AS (SELECT v, min(f) AS f FROM best GROUP BY v),
near AS (
  SELECT a.k FROM variants a JOIN best b ON a.v = b.v AND a.gap = b.gap WHERE b.f < a.f
  UNION SELECT a.k FROM variants a JOIN firsts b ON a.v = b.k WHERE b.n >= 10 AND b.f < a.f
  UNION SELECT b.k FROM firsts b JOIN any_gap a ON a.v = b.k WHERE b.n >= 10 AND a.f < b.f),
judged AS (
  SELECT y.doc_id, y.pos, y.line, y.n > 0 AND (r.k IS NOT NULL OR f.f <> {'d': y.doc_id, 'p': y.pos}) AS gone
  FROM keyed y LEFT JOIN firsts f ON y.k = f.k LEFT JOIN near r ON y.k = r.k)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(j.line, chr(10) ORDER BY j.pos) FILTER (WHERE NOT coalesce(j.gone, false)), '') END AS text,
  CAST(count(j.pos) AS INTEGER) AS n_lines, CAST(count(j.pos) FILTER (WHERE j.gone) AS INTEGER) AS n_dropped
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id, d.text
""",
    "op4_warc": r"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS first FROM payloads GROUP BY hex)
SELECT p.page_id, CAST(octet_length(encode(p.payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda shift:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(p.hex, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT) >> shift) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to
FROM payloads p JOIN firsts f ON p.hex = f.hex
""",
    "op5_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark WHERE text IS NOT NULL) x
  WHERE len(w) > 0),
item_shingles AS (
  SELECT item_id, n, k, shingle, count(*) AS c
  FROM (SELECT item_id, n, k, array_to_string(w[p + 1:p + k], ' ') AS shingle
        FROM (SELECT *, unnest(range(0, n - k + 1)) AS p FROM i) y) z
  GROUP BY ALL),
doc_shingles AS (
  SELECT doc_id, l, k, p, array_to_string(w[p + 1:p + k], ' ') AS shingle
  FROM (SELECT doc_id, w, len(w) AS l, k, unnest(range(0, len(w) - k + 1)) AS p
        FROM d, (SELECT DISTINCT k FROM i) ks WHERE len(w) >= k) y),
starts AS (
  SELECT DISTINCT doc_id, item_id, n, k, size, s
  FROM (SELECT h.doc_id, t.item_id, t.n, t.k, h.l, least(t.n, h.l) - t.k + 1 AS size,
               unnest(range(greatest(0, h.p - (least(t.n, h.l) - t.k)), least(h.p, h.l - least(t.n, h.l)) + 1)) AS s
        FROM doc_shingles h JOIN item_shingles t ON t.k = h.k AND t.shingle = h.shingle) y),
counted AS (
  SELECT a.doc_id, a.item_id, a.n, a.k, a.size, a.s, h.shingle, count(*) AS c
  FROM starts a JOIN doc_shingles h ON h.doc_id = a.doc_id AND h.k = a.k AND h.p BETWEEN a.s AND a.s + a.size - 1
  GROUP BY ALL),
scored AS (
  SELECT x.doc_id, x.item_id, x.s AS start, sum(least(x.c, t.c)) / CAST(x.size + x.n - x.k + 1 - sum(least(x.c, t.c)) AS DOUBLE) AS similarity
  FROM counted x JOIN item_shingles t ON t.item_id = x.item_id AND t.shingle = x.shingle
  GROUP BY x.doc_id, x.item_id, x.s, x.size, x.n, x.k)
SELECT doc_id, item_id, start, similarity
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS rank
      FROM scored WHERE similarity >= 0.8) y
WHERE rank = 1
""",
    "op7_embedding_near_dedup": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(id, r) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
""",
}
