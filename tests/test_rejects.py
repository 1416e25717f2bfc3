import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwkit.sources import rejects as R

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("price", T.DecimalType(8, 2)), T.StructField("at", T.TimestampNTZType()),
                       T.StructField("note", T.StringType())])
LINES = ["id,price,at,note", "1,2.50,2024-01-02 03:04,plain", '2,3.00,2024-01-02 03:04,"a, b ""c"""', "3,x,2024-01-02 03:04,bad price",
         "x4,1.0,2024-99-02 03:04,two wrong", "5,1.0,2024-01-02 03:04", "6,1.0,2024-01-02 03:04,too,many", "7,,,", '8,9.0,2024-01-02 03:04,"open', ""]


def test_good_and_bad_rows_in_one_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(LINES) + "\n")
    good, bad = R.read_checked(spark, str(tmp_path / "in"), SCHEMA, timestamp_format="yyyy-MM-dd HH:mm")
    assert [(r.id, str(r.price), r.note) for r in good.orderBy("id").collect()][:3] == [(1, "2.50", "plain"), (2, "3.00", 'a, b "c"'), (7, "None", None)]
    got = {r.raw_row: r.reason for r in bad.collect()}
    assert got["3,x,2024-01-02 03:04,bad price"] == "price: 'x' is no decimal(8,2)"
    assert got["x4,1.0,2024-99-02 03:04,two wrong"] == "id: 'x4' is no int; at: '2024-99-02 03:04' is no timestamp_ntz"
    assert got["5,1.0,2024-01-02 03:04"] == got["6,1.0,2024-01-02 03:04,too,many"] == "not 4 fields"
    assert all(r.file.endswith("a.csv") and r.block_start == 0 for r in bad.collect())
    empty, none = R.read_checked(spark, _file(tmp_path, "b.csv", "id,price,at,note\n"), SCHEMA)
    assert empty.count() == none.count() == 0


def _file(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_rejects_recover_stay_open_or_are_given_up(spark, tmp_path):
    box = R.Quarantine(spark, str(tmp_path / "q"), most=2)
    rows = lambda *ids: spark.createDataFrame([(i, f"raw {i}", "missing") for i in ids], "reject_id string, raw_row string, reason string")
    box.put(rows("a", "b", "c"), dt.datetime(2024, 1, 1))

    def load(known, silent=()):
        def run(raw):
            ok = raw.where(F.col("reject_id").isin(*known))
            return ok, raw.where(~F.col("reject_id").isin(*known, *silent)).select("reject_id", F.lit("still missing").alias("reason"))
        return run
    assert [r.reject_id for r in box.replay(load(["a"], ["b"]), dt.datetime(2024, 1, 2)).collect()] == ["a"]
    state = {r.reject_id: (r.state, r.tries, r.reason) for r in box.state().collect()}
    assert state == {"a": ("recovered", 1, None), "b": ("open", 1, "not loaded"), "c": ("open", 1, "still missing")}
    box.put(rows("a", "d"), dt.datetime(2024, 1, 3))                     # a later load; a is known already
    box.replay(load(["a", "b"]), dt.datetime(2024, 1, 4))
    state = {r.reject_id: (r.state, r.tries) for r in box.state().collect()}
    assert state == {"a": ("recovered", 1), "b": ("recovered", 2), "c": ("given up", 2), "d": ("open", 1)}
    assert box.attempts() == 4 and box.replay(load(["c", "d"]), dt.datetime(2024, 1, 5)).count() == 1     # what was given up is not tried


def test_attempt_that_failed_midway_is_overwritten(spark, tmp_path):
    box = R.Quarantine(spark, str(tmp_path / "q"))
    box.put(spark.createDataFrame([("a", "raw", "x")], "reject_id string, raw_row string, reason string"), dt.datetime(2024, 1, 1))
    (tmp_path / "q" / "attempt=1").mkdir()
    (tmp_path / "q" / "attempt=1" / "part-0.parquet").write_text("half a file")
    assert box.state().count() == 1 and box.replay(lambda raw: (raw, raw.limit(0).withColumn("reason", F.lit(""))), dt.datetime(2024, 1, 2)).count() == 1
    assert box.state().first().state == "recovered"
