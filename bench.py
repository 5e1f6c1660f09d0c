"""Headline timings: prints one JSON line.

Each query is run in full into Spark's no-op sink, once to warm up and then three times; the
median counts. Training and the streams run once. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and threads.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from caudal.operators import scoring
from caudal.plans import sample_bank, sample_queries, training
from caudal.session import local_session, scratch_dir
from caudal.sources import tables
from caudal.operators import entities
from caudal.streaming import ingest, scoring as stream_scoring

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = [
    "p9_gold_projection_accounts", "p9_gold_projection_tx", "a1_tx_per_account", "j1_accounts_tx",
    "j4_pick_account", "j5_feature_table", "risk_share_by_employment", "a6_frequencies",
    "a7_risk_crosstab", "a8_histogram", "a12_auc", "m7_split", "r3_r4_request_features",
    "g4_transactions", "g5_loans",
]


def timed(action) -> float:
    action()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS) if CPUS.isdigit() else 8,
                          **{"spark.driver.memory": "20g"})

    def noop(name):
        sample_queries.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    results = {name: timed(lambda name=name: noop(name)) for name in HEADLINE}

    raw = scratch_dir(spark, "bench") + "/transacciones.csv"
    tables.write_bronze(sample_bank.transacciones(spark, SF_DIR), raw)

    def csv_to_gold():
        df = entities.refine(tables.read_raw(spark, raw), "transacciones", sample_bank.AS_OF)
        df.write.format("noop").mode("overwrite").save()

    results["csv_to_gold_transactions"] = timed(csv_to_gold)
    def once(action):
        start = time.perf_counter()
        done = action()
        return round(time.perf_counter() - start, 3), done

    table = training.materialise(spark, sample_queries.labelled(spark, SF_DIR).drop("regla"), "bench-features")
    results["m8_training"], done = once(lambda: training.fit_and_evaluate(spark, table))
    requests = sample_bank.requests(spark, SF_DIR)
    results["r6_batch_scoring"] = timed(
        lambda: scoring.score_requests(done.model, requests).write.format("noop").mode("overwrite").save())
    base = scratch_dir(spark, "bench-streams")
    results["t1_stream_ingest"], _ = once(lambda: ingest.ingest(
        spark, "transacciones", raw, f"{base}/silver", f"{base}/gold", f"{base}/t1", sample_bank.AS_OF).awaitTermination())
    requests.selectExpr("translate(coalesce(body, ''), '\r\n', '  ') as value").write.text(f"{base}/in")
    results["t2_stream_scoring"], _ = once(lambda: stream_scoring.score_stream(
        done.model, stream_scoring.read_requests(spark, f"{base}/in"), f"{base}/out", f"{base}/t2").awaitTermination())

    spark.stop()
    print(json.dumps({
        "metric": "banking_jobs_total", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
