"""Times the headline queries and prints one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402

HEADLINE = [
    "with_doc_id", "tokenize_whitespace", "extract_nouns", "apply_dictionary", "hash_documents",
    "topic_term_counts", "ctfidf", "top_words", "representative_docs", "keybert_words", "mmr_words",
    "topic_coherence", "trial_metrics", "knn_cosine", "fuzzy_graph", "silhouette", "reduce_dimensions",
    "hdbscan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's and Python's workers outside the measurement
    QUERIES["encode_documents"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps({
            "metric": "total time of headline queries",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
