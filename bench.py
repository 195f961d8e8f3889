"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional) a
comma-separated choice of query names.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskframe.plans import catalog, detectors  # noqa: E402
from riskframe.session import materialise  # noqa: E402

HEADLINE = (
    "scan_transactions",
    "merge_identity",
    "quality_report",
    "missing_profile",
    "sample_exact",
    "temporal_split",
    "walk_forward",
    "fit_amount_stats",
    "amount_features",
    "model_matrix",
    "category_codes",
    "hourly_risk",
    "roc_auc",
    "auprc",
    "comprehensive_evaluation",
    "numeric_profile",
    "drift_mean_shift",
    "drift_ks",
    "drift_psi",
    "graph_nodes",
    "graph_edges",
    "graph_features_2hop",
    "user_sequences",
    "trailing_sequences",
    "sequence_features",
    "evasion_rate",
    "score_json_batch",
    "score_stream",
    "stream_prediction_counts",
    "gbt_scores",
    "isolation_forest_flags",
    "ensemble_flags",
    "feature_importance",
    "explain_scores",
    "graph_scores",
    "sequence_scores",
    "hybrid_scores",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def throughput(spark: SparkSession, sf_dir: str) -> dict:
    """Rows scored per second by fitted boosted trees, scoring time only."""
    model, train, test, _ = detectors.fitted(spark, sf_dir)
    rows = materialise(train.unionByName(test), "score-me")
    n = rows.count()
    run(model.score(rows))
    started = time.time()
    run(model.score(rows))
    seconds = time.time() - started
    return {"rows": n, "rows_per_second": round(n / seconds), "latency_ms": seconds / n * 1000}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()  # start-up
    times = {}
    for name in names:
        started = time.time()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - started, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    if not chosen:
        out["scoring"] = throughput(spark, sf_dir)
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
