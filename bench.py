"""Time the merge on local cores; prints one JSON line.

Replica and increment are stored by month first, outside the times. Every query
gets the same stored input. ``merge_*`` write the merged rows to a null sink,
``job_*`` run the whole job on storage (stage, publish), on a path or a table. ``loop_*`` is the
yardstick, outside the sum: the same work in one turn per open sub-partition, in
sequence. Median of the warm runs. ``value`` is the sum over the merges and jobs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerfold as lf
import scenarios as sc
from ledgerfold.session import MERGE_SETTINGS
from ledgerfold.sources.staging import by_month, write_replica

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session(folder: str) -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerfold-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
    )
    for key, value in MERGE_SETTINGS.items():
        builder = builder.config(key, value)
    made = builder.getOrCreate()
    made.sparkContext.setLogLevel("ERROR")
    return made


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def loop_merge(replica: DataFrame, increment: DataFrame, write) -> None:
    """One anti join and one write per open start month."""
    new = lf.conform(increment, replica).cache()
    write(new)
    closed, rows = lf.closed_keys(new), lf.open_slice(replica)
    for (month,) in lf.open_subpartitions(replica).collect():
        part = rows.filter(F.col("eff_from_month") == F.lit(month))
        keys = closed.filter(F.col("eff_from_month") == F.lit(month))
        write(part.join(keys, ["id", "eff_from_dt"], "left_anti"))
    new.unpersist()


def timed(prepare, run, runs: int = RUNS) -> float:
    """Median seconds of ``run`` after one run to warm up; ``prepare`` is not timed."""
    seconds = []
    for _ in range(runs + 1):
        given = prepare()
        start = time.perf_counter()
        run(given)
        seconds.append(time.perf_counter() - start)
    return round(median(seconds[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    folder = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    spark = session(folder)
    count = 0

    def fresh(name: str) -> str:
        nonlocal count
        count += 1
        return f"{folder}/{name}-{count}"

    def stored(replica: DataFrame, increment: DataFrame) -> tuple[str, str]:
        at, increment_at = fresh("replica"), fresh("increment")
        write_replica(by_month(replica), at, "errorifexists")
        increment.write.parquet(increment_at)
        return at, increment_at

    orders = stored(sc.orders_replica(spark, sf_dir), sc.keyed_increment(spark, sf_dir))
    lines = stored(sc.lines_replica(spark, sf_dir), sc.lines_increment(spark, sf_dir))

    def frames(paths: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
        return lf.read_replica(spark, paths[0]), lf.read_increment(spark, paths[1])

    def seeded(paths: tuple[str, str] = orders) -> str:
        target = fresh("seeded")
        lf.seed(spark, paths[0], target)
        return target

    schema = lf.read_replica(spark, orders[0]).schema

    def tabled(attach: bool):
        def make() -> lf.TableReplica:
            at = fresh("table")
            made = lf.create_replica(spark, f"bench_{count}", schema, at, attach=attach)
            lf.read_replica(spark, orders[0]).write.insertInto(made.name)
            return made

        return make

    def job(strategy: str, paths: tuple[str, str] = orders):
        return lambda at: lf.apply_increment(spark, at, paths[1], fresh("staging"), strategy)

    def loop_job(at: str) -> None:
        replica, increment = lf.read_replica(spark, at), lf.read_increment(spark, orders[1])
        staging = fresh("staging")
        loop_merge(replica, increment, lambda df: write_replica(df, staging, "append"))
        lf.publish(lf.read_replica(spark, staging, schema=replica.schema), at)

    merges = {
        "closed_key": lf.merge_closed_key,
        "closed_key_by_subpartition": lf.merge_closed_key_by_subpartition,
        "latest": lf.merge_latest,
    }
    times, yardstick = {}, {}
    for label, paths in (("", orders), ("_lines", lines)):
        for name, merge in merges.items():
            times[f"merge_{name}{label}"] = timed(
                lambda: None, lambda _: noop(merge(*frames(paths)))
            )
    for name in (*merges, "closed_key_by_file"):
        times[f"job_{name}"] = timed(seeded, job(name))
    times["job_closed_key_lines"] = timed(lambda: seeded(lines), job("closed_key", lines))
    times["job_closed_key_table"] = timed(tabled(False), job("closed_key"))
    times["job_closed_key_attached"] = timed(tabled(True), job("closed_key"))
    yardstick["loop_merge"] = timed(lambda: None, lambda _: loop_merge(*frames(orders), noop))
    yardstick["loop_job"] = timed(seeded, loop_job)
    print(
        json.dumps(
            {
                "metric": "scd2_merge_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "yardstick": yardstick,
                "runs": RUNS,
                "sf": Path(sf_dir).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
