"""Headline-query benchmark.

Runs each headline query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is timed end to end (DataFrame construction, planning and full
execution into the ``noop`` sink, which computes every row without
collecting to the driver). After one untimed warm-up query (JVM start-up,
class loading), each query runs ``$BENCH_REPEAT`` times (default 3):
``queries`` holds the median, ``cold`` the first run (which also pays code
generation and JIT for that plan shape).

The given events table is one file with one row group, which Spark reads in one
task. So the table is first copied, untimed, into as many files as there are
cores (``BENCH_FILES`` changes that; 0 reads the given file), at every scale
factor alike; the other tables are read where they are. ``BENCH_CORPUS=1`` also
times the corpus operators, one run each.

``stream_all_tables`` (unless ``BENCH_STREAM=0``): the events, landed as
files in time order (untimed), drained by the streaming job — ingest query
plus the raw, four metric and rejected-event queries — with an
``availableNow`` trigger taking the whole backlog per micro-batch (Spark's
default); one run, fresh checkpoints.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventide.config import builder, checkpoint_root  # noqa: E402
from eventide.plans.catalog import QUERIES  # noqa: E402
from eventide.plans.pipeline import table  # noqa: E402
from eventide.sources.adapter import landed_records  # noqa: E402
from eventide.sources.events import event_stream  # noqa: E402
from eventide.sources.landing import land_in_time_order  # noqa: E402
from eventide.streaming import runner  # noqa: E402

HEADLINE = [
    "raw_events",
    "dedup_events",
    "repository_metrics",
    "event_type_distribution",
    "user_activity",
    "language_trends",
    "aggregated_metrics",
    "top_repositories",
    "top_users",
    "top_languages",
    "event_type_summary",
    "panel_repository_activity",
    "panel_overall_trends",
    "validate_rejected",
    "keyed_append",
]


def dealt(spark, sf_dir: str, files: int) -> str:
    """A folder with the events in ``files`` files (equal runs of rows by time) and
    links to the other tables."""
    import tempfile
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for name in os.listdir(sf_dir):
        if name != "events.parquet":
            os.symlink(os.path.join(sf_dir, name), os.path.join(out, name))
    (table(spark, sf_dir, "events").repartitionByRange(files, "ts").sortWithinPartitions("ts")
     .write.parquet(os.path.join(out, "events.parquet")))
    return out


def main() -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = (builder(f"local[{cpus}]", shuffle_partitions=int(cpus))
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    files = int(os.environ.get("BENCH_FILES", cpus))
    sf_dir = dealt(spark, given, files) if files else given
    QUERIES["flow_check"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in (only or HEADLINE):
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        cold[name] = round(runs[0], 3)
        times[name] = round(statistics.median(runs), 3)

    corpus = {}
    if os.environ.get("BENCH_CORPUS", "0") != "0" and not only:
        from eventide.llm.queries import QUERIES as operators
        for name, query in operators.items():
            t0 = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            corpus[name] = round(time.perf_counter() - t0, 3)

    stream = {}
    if os.environ.get("BENCH_STREAM", "1") != "0" and not only:
        root = os.path.join(checkpoint_root(spark), "eventide-bench", uuid.uuid4().hex)
        events = table(spark, sf_dir, "events")
        n = events.count()
        land = os.path.join(root, "landing")
        land_in_time_order(spark, landed_records(events, keep=("ts",)), "ts", land, files=6)
        t0 = time.perf_counter()
        qs = runner.run_all(spark, event_stream(spark, "parquet", land),
                            os.path.join(root, "lake"), os.path.join(root, "ckpt"),
                            trigger={"availableNow": True})
        runner.await_all(spark, qs, bounded=True)
        secs = time.perf_counter() - t0
        times["stream_all_tables"] = round(secs, 3)
        stream = {"stream_events": n, "stream_events_per_sec": round(n / secs, 1)}

    m = re.search(r"sf([0-9.]+)", given)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "repeat": repeat,
        **stream,
        **({"corpus": corpus} if corpus else {}),
        "files": files,
        "sf": float(m.group(1)) if m else given,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
