"""Run registered queries with Spark's event log on (written to a fresh
scratch folder) and summarise every stage: task count, the largest number
of records one task read (input + shuffle) and wrote to the shuffle, and the
longest task. With ``--hot`` the queries run on a copy of the tables in which
one part, one supplier and one user hold about a third of all rows, to show
whether a hot key lands in a single task.

    python tools/stage_report.py /root/testdata/sf0.01 best_rated_inner cogroup --hot
"""

from __future__ import annotations

import glob
import json
import os
import shutil
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_hot_copy(sf_dir: str, out: str, seed: int = 11) -> str:
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = np.random.default_rng(seed)
    li = pq.read_table(f"{sf_dir}/lineitem.parquet")
    hot = rng.random(li.num_rows) < 1 / 3
    for c in ["l_partkey", "l_suppkey"]:
        v = li[c].to_numpy().copy()
        v[hot] = 0
        li = li.set_column(li.schema.get_field_index(c), c, pa.array(v, pa.int64()))
    pq.write_table(li, f"{out}/lineitem.parquet", row_group_size=max(1, li.num_rows // 8))
    ev = pq.read_table(f"{sf_dir}/events.parquet")
    u = ev["user_id"].to_numpy().copy()
    u[rng.random(ev.num_rows) < 1 / 3] = 0
    ev = ev.set_column(ev.schema.get_field_index("user_id"), "user_id", pa.array(u, pa.int64()))
    pq.write_table(ev, f"{out}/events.parquet")
    for t in ["part", "orders", "customer", "documents", "supplier", "embeddings"]:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            shutil.copy(f"{sf_dir}/{t}.parquet", f"{out}/{t}.parquet")
    return out


def summarise(log_file: str) -> list[dict]:
    stages: dict[int, dict] = {}
    with open(log_file) as f:
        for line in f:
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerTaskEnd":
                continue
            m = ev.get("Task Metrics") or {}
            read = (m.get("Input Metrics", {}).get("Records Read", 0)
                    + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
            wrote = m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
            s = stages.setdefault(ev["Stage ID"], {"stage": ev["Stage ID"], "tasks": 0, "records_in": 0,
                                                    "max_task_records_in": 0, "max_task_shuffle_out": 0,
                                                    "max_task_ms": 0})
            s["tasks"] += 1
            s["records_in"] += read
            s["max_task_records_in"] = max(s["max_task_records_in"], read)
            s["max_task_shuffle_out"] = max(s["max_task_shuffle_out"], wrote)
            s["max_task_ms"] = max(s["max_task_ms"], m.get("Executor Run Time", 0))
    return [stages[k] for k in sorted(stages)]


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir, names = args[0], args[1:]
    scratch = tempfile.mkdtemp(prefix="quarry-events-")
    if "--hot" in sys.argv:
        sf_dir = make_hot_copy(sf_dir, tempfile.mkdtemp(prefix="quarry-hot-"))
    from quarry.session import local_session
    from quarry.plans.registry import all_queries
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
             "spark.eventLog.compress": "false"}
    if "--hot" in sys.argv:
        # small splits, so the hot copy is read by several tasks as a large
        # input would be (one split per row group)
        extra["spark.sql.files.maxPartitionBytes"] = "64k"
    spark = local_session(8, 16, extra=extra)
    qs = all_queries()
    for n in names:
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    # Spark 4 rolls event logs into eventlog_v2_<app>/events_<n>_<app> files
    files = sorted(p for p in glob.glob(f"{scratch}/**/*", recursive=True)
                   if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus"))
    stages: list[dict] = []
    for f in files:
        stages += summarise(f)
    print(json.dumps({"sf_dir": sf_dir, "queries": names, "event_log": scratch, "stages": stages},
                     indent=1))


if __name__ == "__main__":
    main()
