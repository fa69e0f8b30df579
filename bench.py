"""Times the headline queries and prints one JSON line.

Every query is run to completion into a sink that discards its rows, after one small
query that starts the Python workers and compiles nothing of the measured plans.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from textgrain.plans import QUERIES  # noqa: E402
from textgrain.session import local_session  # noqa: E402

HEADLINES = (
    "class_top_ngrams",
    "char_ngrams",
    "word_ngrams",
    "corpus_ngram_totals",
    "lemma_pos_ngrams",
    "feature_vocab",
    "surface_profile",
    "unigram_prob",
    "mean_pool",
    "mean_std_pool",
    "sif_pool",
    "balanced_head",
    "stratified_folds",
    "binary_metrics",
    "linear_score",
    "svm_fit_eval",
    "ngram_profile",
    "learning_curve",
    "representation_compare",
    "epoch_losses",
    "grid_cv",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, "textgrain-bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["normalized_text"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}

    def report(**more) -> str:
        total = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec"}
        return json.dumps(total | {"queries": seconds, "sf": Path(folder).name.removeprefix("sf")} | more)

    try:
        for name in sys.argv[1:] or HEADLINES:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            print(name, seconds[name], file=sys.stderr, flush=True)
    except BaseException:
        # A run that is cut short leaves the times of the finished queries.
        print(report(unfinished=name), flush=True)
        raise
    print(report(), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
