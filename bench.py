"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (whole plan
executed, nothing collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sifter.plans import catalog  # noqa: E402
from sifter.session import get_spark  # noqa: E402

# bench name -> registered query (what the reference's run log times)
HEADLINE = {
    "reduce": "label_filter_group",          # Reduce
    "find_duplicates": "duplicate_ids",      # Shorten + find duplicates
    "dups_distribution": "dups_distribution",
    "split": "splits_balanced",              # Split
    "word_counts": "word_counts_stemmed",    # Word counts (stemmed)
    "vocab_cut": "vocab_cut",                # Vocabulary cut
    "summarize": "article_summary_stemmed",  # Summarise
    "prepare_validation": "eval_set",        # Prepare validation
    "lexicon_model": "lexicon_model",        # Lexicon model
    "lexicon_scoring": "lexicon_scores",     # Lexicon scoring
    "evaluate": "evaluate",                  # Lexicon evaluation
    "multi_nb": "nb_multinomial",            # Multinomial NB train + score
    "logreg": "logreg",                      # Logistic regression train + score
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if a in HEADLINE]
    spark = get_spark(f"local[{cpus}]", app="sifter-bench", shuffle_partitions=4 * cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm the JVM (not timed)
    catalog.REGISTRY["null_counts"].fn(spark, sf_dir).collect()
    times = {}
    for name, query in HEADLINE.items():
        if only and name not in only:
            continue
        spark.catalog.clearCache()  # every query timed standalone
        t0 = time.perf_counter()
        df = catalog.REGISTRY[query].fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    n_docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    n_labelled = spark.read.parquet(f"{sf_dir}/labels.parquet").count()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "input_rows": {"documents": n_docs, "labelled": n_labelled},
                      "docs_per_sec": {k: round(n_docs / v, 1) for k, v in times.items() if v}}))
    spark.stop()


if __name__ == "__main__":
    main()
