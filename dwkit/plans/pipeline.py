"""The master load as one plain function.

``run`` = entities (airlines, airports, routes; operations, delay records and
the prepared fact input from one keyed pass over the flat rows) ->
dimensions -> fact load -> completion update.  Every table is written once
(Parquet) and read back, so each step starts from stored data (lineage cut,
restartable), and dimensions are written before the fact.

A load is a folder of its own under ``out``; the manifest ``out/_manifest``
names the newest one and what it was loaded from (rows and content hashes of
all inputs, and the arguments).  A re-run with the same inputs resumes at the
first table that is not complete; with any other input it loads anew.

Command line (flat source CSV in the 35-column layout)::

    python -m dwkit.plans.pipeline --flat ops.csv --feed completions.csv \\
        --regions regions.csv --carriers carriers.csv --out /shared/warehouse
"""

from __future__ import annotations

import argparse
import datetime as _dt
import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwkit.operators.dims import add_missing_dates, airline_dim, airport_dim, date_dim_for, reason_dim, route_dim
from dwkit.operators.normalise import (OPERATION_COLS, airlines, airports, delay_records, flights,
                                      keyed_operations, route_identities)
from dwkit.operators.scd import scd1_merge
from dwkit.operators.snapshot import apply_completions, apply_completions_placed
from dwkit.operators.windows import with_surrogate
from dwkit.plans.fact import PERIODS, load_fact, prepare_keyed
from dwkit.sources.files import is_complete
from dwkit.sources.reference import DELAY_PARTS, US_FEDERAL_HOLIDAYS_2024

TABLES = ["flat", "airline", "airport", "flight", "flight_operation", "delay_record", "dim_date",
          "dim_airline", "dim_airport", "dim_route", "dim_reason", "airport_errors", "prepared",
          "fact_loaded", "fact_errors", "feed", "fact", "accum_errors"]


FACT_PARTITIONS = PERIODS


def _store(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write a table.  The rows of a partitioned one are range-partitioned
    on (partition column, ``operation_id``) already: each task writes a contiguous slice,
    so files stay few, and a month holding a third of the rows is still
    split over many tasks (equal partition values are not kept together)."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def _content(df: DataFrame | None) -> str:
    """Columns, rows and an order-free content hash of an input, from one aggregate."""
    if df is None:
        return "none"
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s")).first()
    return f"{df.dtypes}|{r.n}|{r.x}|{r.s}"


def _signature(inputs: dict[str, DataFrame | None], **args) -> str:
    text = repr(sorted((k, _content(v)) for k, v in inputs.items())) + repr(sorted((k, str(v)) for k, v in args.items()))
    return hashlib.sha256(text.encode()).hexdigest()


class _Load:
    """Tables of one load, each made only if it is not complete yet."""

    def __init__(self, spark: SparkSession, out: str, partition: str | None) -> None:
        self.spark, self.out, self.part = spark, out.rstrip("/"), FACT_PARTITIONS[partition] if partition else None
        self.tables: dict[str, DataFrame] = {}

    def open(self, inputs: dict[str, DataFrame | None], flat: str, **args) -> None:
        """Resume the load in the manifest if it was made from these inputs, else
        begin a new one.  ``flat`` is the table that stores the input of that
        name: a new load hashes the stored copy instead of computing it twice."""
        manifest = f"{self.out}/_manifest"
        if is_complete(self.spark, manifest):
            old = self.spark.read.parquet(manifest).first()
            if old is not None and old.signature == _signature(inputs, **args):
                self.root = f"{self.out}/{old.load}"
                self.table(flat, lambda: inputs["flat"])
                return
        load = f"load-{uuid.uuid4().hex[:12]}"
        self.root = f"{self.out}/{load}"
        stored = self.table(flat, lambda: inputs["flat"])
        sig = _signature(inputs | {"flat": stored.select(*inputs["flat"].columns)}, **args)
        one = self.spark.range(1).select(F.lit(load).alias("load"), F.lit(sig).alias("signature"))
        one.coalesce(1).write.mode("overwrite").parquet(manifest)

    def table(self, name: str, make) -> DataFrame:
        path = f"{self.root}/{name}"
        if not is_complete(self.spark, path):
            _store(make(), path)
        self.tables[name] = self.spark.read.parquet(path)
        return self.tables[name]

    def pair(self, names, make, partitioned: bool = False) -> None:
        """Two tables from one computation (e.g. loaded rows and rejects); the first may be ``partitioned``,
        then its rows come placed."""
        if not all(is_complete(self.spark, f"{self.root}/{n}") for n in names):
            a, b = make()
            _store(a, f"{self.root}/{names[0]}", self.part if partitioned else None)
            _store(b, f"{self.root}/{names[1]}")
        for n in names:
            self.tables[n] = self.spark.read.parquet(f"{self.root}/{n}")


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """The results of steps that do not need each other: their jobs share the cores, which one step's
    planning, listing and last tasks leave idle.  All end before an error of one is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [b.result() for b in begun]


def _complete(load: _Load, fact: DataFrame, feed: DataFrame, run_ts) -> tuple[DataFrame, DataFrame]:
    """The fact closed by a feed, placed if it is stored by period, and the feed's unknown ids."""
    stage_path = f"{load.root}/_stage_completions"
    if load.part:
        return apply_completions_placed(fact, feed, load.part, stage_path, run_ts)
    return apply_completions(fact, feed, run_ts, stage_path=stage_path)


def current_load(spark: SparkSession, out: str) -> str | None:
    """Folder of the load that the manifest under ``out`` names."""
    manifest = f"{out.rstrip('/')}/_manifest"
    row = spark.read.parquet(manifest).first() if is_complete(spark, manifest) else None
    return f"{out.rstrip('/')}/{row.load}" if row is not None else None


def run(spark: SparkSession, flat: DataFrame, feed: DataFrame | None, regions: DataFrame, out: str,
        run_ts=None, carrier_names: DataFrame | None = None, unmatched_airports: str = "quarantine",
        holidays=US_FEDERAL_HOLIDAYS_2024, fact_partition: str | None = "month") -> dict[str, DataFrame]:
    """First load.  Restarted with the same inputs it resumes at the first
    missing table; other inputs begin a new load."""
    args = {"run_ts": run_ts, "unmatched": unmatched_airports, "holidays": sorted(holidays), "partition": fact_partition}
    run_ts = run_ts or _dt.datetime.now().replace(microsecond=0)
    load = _Load(spark, out, fact_partition)
    w, st = load.tables, load.table
    load.open({"flat": flat, "feed": feed, "regions": regions, "names": carrier_names}, "source", **args)
    if "operation_id" in flat.columns:
        w["flat"] = w["source"]
    else:
        st("flat", lambda: with_surrogate(w["source"], "operation_id", list(flat.columns)))
    together(spark,
             lambda: st("airline", lambda: airlines(w["flat"], carrier_names)),
             lambda: st("airport", lambda: airports(w["flat"])),
             lambda: st("flight", lambda: flights(w["flat"])),
             lambda: st("dim_date", lambda: date_dim_for(w["flat"], "fl_date", holidays)),
             lambda: st("dim_reason", lambda: reason_dim(spark)))
    # One join keys the flat rows; operations, delay records and the
    # prepared fact input are all projections of it (JOIN-1 without a join).
    st("prepared", lambda: prepare_keyed(keyed_operations(w["flat"], w["flight"])))
    op_cols = [c for c in OPERATION_COLS if c in w["prepared"].columns]
    parts = [p for p in DELAY_PARTS if p in w["prepared"].columns]
    together(spark,
             lambda: st("flight_operation", lambda: w["prepared"].select("operation_id", "flight_id", *op_cols)),
             lambda: st("delay_record", lambda: delay_records(w["prepared"].select("operation_id", "cancelled", *parts), parts=parts)),
             lambda: st("dim_airline", lambda: airline_dim(None, w["airline"], run_ts)),
             lambda: load.pair(["dim_airport", "airport_errors"],
                               lambda: airport_dim(None, w["airport"], regions, run_ts, unmatched=unmatched_airports)),
             lambda: st("dim_route", lambda: route_dim(None, w["flight"])))
    load.pair(["fact_loaded", "fact_errors"],
              lambda: load_fact(w["prepared"], w["dim_date"], w["dim_airline"], w["dim_airport"], w["dim_route"],
                                w["dim_reason"], run_ts, partition=fact_partition,
                                stage_path=f"{load.root}/_stage_fact_lookups"), True)
    if feed is not None:
        st("feed", lambda: feed)
        load.pair(["fact", "accum_errors"],
                  lambda: _complete(load, w["fact_loaded"], w["feed"], run_ts), True)
    return w


def _next(df: DataFrame, col: str):
    """``max(col) + 1`` of a stored table, as a scalar subquery column."""
    return df.select(F.coalesce(F.max(col), F.lit(0)) + 1).scalar()


def run_increment(spark: SparkSession, prev: dict[str, DataFrame], flat: DataFrame, regions: DataFrame, out: str,
                  run_ts=None, carrier_names: DataFrame | None = None, unmatched_airports: str = "quarantine",
                  holidays=US_FEDERAL_HOLIDAYS_2024, fact_partition: str | None = "month",
                  feed: DataFrame | None = None) -> dict[str, DataFrame]:
    """Load a further flat batch into a warehouse built by ``run``.

    Dimensions are merged into new versions written under ``out``: airlines
    by SCD2 (renames expire the current row), airports and routes by SCD1,
    the calendar gains only missing days; route identities already known keep
    their ``flight_id`` (null-safe match), new ones and all new operations,
    delay records and fact rows get ids after the previous maxima.

    What is returned is the whole warehouse after the batch: ``flat``,
    ``prepared``, ``flight_operation``, ``delay_record``, the entities, the
    fact and the error tables are the earlier ones with the batch's (stored
    as ``*_batch`` and ``fact_segment``).  The fact is append-only and keeps
    earlier completions: ``fact`` is the previous completed fact and the new
    open rows; with a ``feed`` it is that with the feed applied.
    Resumes and begins anew like ``run``.
    """
    args = {"run_ts": run_ts, "unmatched": unmatched_airports, "holidays": sorted(holidays), "partition": fact_partition,
            "after": prev["fact_loaded"].agg(F.max("operation_key")).first()[0]}
    run_ts = run_ts or _dt.datetime.now().replace(microsecond=0)
    load = _Load(spark, out, fact_partition)
    w, st = load.tables, load.table
    load.open({"flat": flat, "feed": feed, "regions": regions, "names": carrier_names}, "source_batch", **args)

    def grown(name: str) -> None:
        """The previous table and the batch's."""
        w[name] = prev[name].unionByName(w[f"{name}_batch"]) if name in prev else w[f"{name}_batch"]

    if "operation_id" in flat.columns:
        w["flat_batch"] = w["source_batch"]
    else:
        st("flat_batch", lambda: with_surrogate(w["source_batch"], "operation_id", list(flat.columns),
                                                start=_next(prev["flight_operation"], "operation_id")))
    together(spark,
             lambda: st("flight", lambda: scd1_merge(prev["flight"], *route_identities(w["flat_batch"]), "flight_id")),
             lambda: st("airline_batch", lambda: airlines(w["flat_batch"], carrier_names)),
             lambda: st("airport_batch", lambda: airports(w["flat_batch"])),
             lambda: st("dim_date", lambda: add_missing_dates(prev["dim_date"], date_dim_for(w["flat_batch"], "fl_date", holidays))))
    st("prepared_batch", lambda: prepare_keyed(keyed_operations(w["flat_batch"], w["flight"])))
    op_cols = [c for c in OPERATION_COLS if c in w["prepared_batch"].columns]
    parts = [p for p in DELAY_PARTS if p in w["prepared_batch"].columns]
    together(spark,
             lambda: st("flight_operation_batch", lambda: w["prepared_batch"].select("operation_id", "flight_id", *op_cols)),
             lambda: st("delay_record_batch", lambda: delay_records(w["prepared_batch"].select("operation_id", "cancelled", *parts),
                                                                    parts=parts, start=_next(prev["delay_record"], "delay_id"))),
             lambda: st("dim_airline", lambda: airline_dim(prev["dim_airline"], w["airline_batch"], run_ts)),
             lambda: load.pair(["dim_airport", "airport_errors_batch"],
                               lambda: airport_dim(prev["dim_airport"], w["airport_batch"], regions, run_ts, unmatched=unmatched_airports)),
             lambda: st("dim_route", lambda: route_dim(prev["dim_route"], w["flight"])))
    for name in ("flat", "prepared", "flight_operation", "delay_record"):
        grown(name)
    for name, key in (("airline", "carrier_code"), ("airport", "airport_code")):
        batch = w[f"{name}_batch"]
        w[name] = batch.unionByName(prev[name].join(batch.select(key), key, "left_anti"))
    w["dim_reason"] = prev["dim_reason"]
    load.pair(["fact_segment", "fact_errors_batch"],
              lambda: load_fact(w["prepared_batch"], w["dim_date"], w["dim_airline"], w["dim_airport"], w["dim_route"],
                                w["dim_reason"], run_ts, partition=fact_partition,
                                first_key=_next(prev["fact_loaded"], "operation_key"),
                                stage_path=f"{load.root}/_stage_fact_lookups"), True)
    grown("airport_errors")
    grown("fact_errors")
    w["fact_loaded"] = prev["fact_loaded"].unionByName(w["fact_segment"])
    fact = prev.get("fact", prev["fact_loaded"]).unionByName(w["fact_segment"])
    if feed is None:
        w["fact"] = fact
        w.update({k: prev[k] for k in ("feed", "accum_errors") if k in prev})
    else:
        st("feed_batch", lambda: feed)
        load.pair(["fact", "accum_errors_batch"],
                  lambda: _complete(load, fact, w["feed_batch"], run_ts), True)
        grown("feed")
        grown("accum_errors")
    return w


def main(argv=None) -> None:
    from dwkit.session import cluster_conf, local_session
    from dwkit.sources.files import convert_types, read_csv
    from dwkit.sources.reference import COMPLETION_SCHEMA, FLAT_SCHEMA, REGION_LENGTHS, us_region_reference
    ap = argparse.ArgumentParser(description="Load the warehouse from a flat operations file.")
    ap.add_argument("--flat", required=True)
    ap.add_argument("--feed")
    ap.add_argument("--regions", help="CSV state_name,region,region_code (default: built-in US states)")
    ap.add_argument("--carriers", help="CSV carrier_code,carrier_name")
    ap.add_argument("--out", required=True)
    ap.add_argument("--input-gb", type=float, help="input size: with --cores, sets partitions and thresholds for it")
    ap.add_argument("--cores", type=int, help="cores of the cluster")
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit under spark-submit")
    a = ap.parse_args(argv)
    spark = local_session(a.master[6:-1]) if a.master else SparkSession.builder.getOrCreate()
    if a.input_gb and a.cores:
        for k, v in cluster_conf(a.input_gb * 1e9, a.cores).items():
            spark.conf.set(k, v)
    flat = read_csv(spark, a.flat, FLAT_SCHEMA, date_format="yyyy-MM-dd")
    feed = read_csv(spark, a.feed, COMPLETION_SCHEMA, timestamp_format="yyyy-MM-dd HH:mm:ss") if a.feed else None
    regions = (convert_types(read_csv(spark, a.regions, "state_name string, region string, region_code string"),
                             REGION_LENGTHS) if a.regions else us_region_reference(spark))
    names = read_csv(spark, a.carriers, "carrier_code string, carrier_name string") if a.carriers else None
    w = run(spark, flat, feed, regions, a.out, carrier_names=names)
    for k, v in w.items():
        print(k, v.count())
    unnamed = w["airline"].where("carrier_name = 'Unknown'").select("carrier_code").orderBy("carrier_code")
    if n := unnamed.count():
        print(f"{n} carrier codes without a name, the first:", *[r.carrier_code for r in unnamed.limit(20).collect()])


if __name__ == "__main__":
    main()
