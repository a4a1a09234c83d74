"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lexispark.session import build_session  # noqa: E402
from verification.queries import QUERIES  # noqa: E402

HEADLINE = [
    "corpus_label_counts",
    "normalize_documents",
    "normalize_pages",
    "processed_text",
    "word_frequency",
    "word_frequency_by_class",
    "doc_length_stats",
    "doc_length_density",
    "document_frequency",
    "vocabulary_topk",
    "tfidf_weights",
    "tfidf_transform_test",
    "feature_means",
    "feature_correlation",
    "nb_multinomial_model",
    "nb_predict",
    "class_report",
    "roc_auc",
    "ovr_auc",
    "stratified_folds",
    "stratified_sample",
    "nb_grid_search",
    "nb_learning_curve",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # one short query starts the JVM's compiler and the parquet reader
    QUERIES["class_report"](spark, folder.rsplit("/", 1)[0] + "/sf0.001").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        spark.catalog.clearCache()
    total = round(sum(seconds.values()), 3)
    sf = float(Path(folder).name.removeprefix("sf"))
    print(json.dumps({"metric": "total seconds of headline queries", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
