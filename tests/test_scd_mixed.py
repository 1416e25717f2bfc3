import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dwkit.operators import scd_mixed as M

T0, T1, T2, T3 = (dt.datetime(2020 + i, 1, 1) for i in range(4))
TYPES = M.ChangeTypes(["k"], fixed=["born"], changing=["name"], historical=["tier"], inferred="guess", fail_on_fixed=False)
SCHEMA = "k string, born int, name string, tier string"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(dim):
    return sorted(((r.k, r.born, r.name, r.tier, r.guess, r.scd_effective_date.year, r.scd_expiry_date.year, r.is_current_record, r.sk)
                   for r in dim.collect()), key=str)


def first(spark):
    return M.merge(None, batch(spark, ("a", 1, "A", "x"), ("b", 2, "B", "x"), ("c", 3, "C", "x"), ("d", 4, None, None), (None, 5, "N", "x")), TYPES, "sk", T0)[0]


def test_every_output_and_what_it_does(spark):
    dim = M.add_inferred(first(spark), batch(spark, ("z", 0, "", ""), ("a", 0, "", ""), ("z", 1, "", "")), TYPES, "sk")
    assert [r for r in rows(dim) if r[0] == "z"] == [("z", None, None, None, True, 1900, 9999, True, 6)]
    new, found = M.merge(dim, batch(spark, ("a", 1, "A2", "x"), ("b", 2, "B2", "y"), ("c", 9, "C2", "y"), ("d", 4, None, None),
                                    ("z", 7, "Z", "y"), ("q", 8, "Q", "x"), (None, 5, "N", "y")), TYPES, "sk", T1)
    got = {name: sorted((str(r.k), tuple(r.changed)) for r in o.collect()) for name, o in found.outputs.items()}
    assert got == {"unchanged": [("d", ())], "new": [("q", ())], "fixed": [("c", ("born",))], "changing": [("a", ("name",)), ("b", ("name",))],
                   "historical": [("None", ("tier",)), ("b", ("tier",))], "inferred": [("z", ("born", "name", "tier"))]}
    assert rows(new) == sorted([
        ("a", 1, "A2", "x", False, 1900, 9999, True, 2),
        ("b", 2, "B2", "x", False, 1900, 2021, False, 3), ("b", 2, "B2", "y", False, 2021, 9999, True, 8),
        ("c", 3, "C", "x", False, 1900, 9999, True, 4), ("d", 4, None, None, False, 1900, 9999, True, 5),
        (None, 5, "N", "x", False, 1900, 2021, False, 1), (None, 5, "N", "y", False, 2021, 9999, True, 7),
        ("z", 7, "Z", "y", False, 1900, 9999, True, 6), ("q", 8, "Q", "x", False, 1900, 9999, True, 9)], key=str)


def test_rerun_changes_nothing(spark):
    two = batch(spark, ("a", 1, "A2", "y"), ("q", 8, "Q", "x"))
    once, _ = M.merge(first(spark), two, TYPES, "sk", T1)
    again, found = M.merge(once, two, TYPES, "sk", T2)
    assert rows(again) == rows(once)
    assert {n: o.count() for n, o in found.outputs.items() if o.count()} == {"unchanged": 2}


def test_fixed_change_stops_the_load(spark):
    with pytest.raises(M.FixedAttributeChanged, match="born"):
        M.merge(first(spark), batch(spark, ("a", 2, "A", "x")), replace(TYPES, fail_on_fixed=True), "sk", T1)
    M.merge(first(spark), batch(spark, ("a", 1, "A", "y")), replace(TYPES, fail_on_fixed=True), "sk", T1)


def test_history_is_overwritten_only_if_asked(spark):
    dim, _ = M.merge(first(spark), batch(spark, ("a", 1, "A", "y"), ("b", 2, "B", "y")), TYPES, "sk", T1)
    renamed = batch(spark, ("a", 1, "AA", "y"), ("b", 2, "B", "y"))
    for every, names in ((False, ["A", "AA"]), (True, ["AA", "AA"])):
        new, _ = M.merge(dim, renamed, replace(TYPES, update_history=every), "sk", T2)
        assert [r.name for r in new.where("k = 'a'").orderBy("sk").collect()] == names
        assert [r.name for r in new.where("k = 'b'").orderBy("sk").collect()] == ["B", "B"]


def test_key_that_was_closed_starts_at_the_run(spark):
    closed = first(spark).withColumn("is_current_record", F.col("k") != "a")
    new, found = M.merge(closed, batch(spark, ("a", 1, "A", "x")), TYPES, "sk", T3)
    assert found.outputs["new"].count() == 1
    assert [r[5:] for r in rows(new) if r[0] == "a"] == [(1900, 9999, False, 2), (2023, 9999, True, 6)]


def test_types_without_some_kinds_and_empty_batches(spark):
    only = M.ChangeTypes(["k"], historical=["tier"])
    dim, _ = M.merge(None, batch(spark, ("a", 1, "A", "x")), only, "sk", T0)
    new, found = M.merge(dim, batch(spark, ("a", 1, "A", "y"), ("a", 1, "A", "y")), only, "sk", T1)
    assert new.count() == 2 and found.outputs["inferred"].count() == 0
    same, _ = M.merge(new, batch(spark), only, "sk", T2)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, new.collect()))
    with pytest.raises(ValueError):
        M.add_inferred(dim, batch(spark), only, "sk")
