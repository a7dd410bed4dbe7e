"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs over
the whole tables into a sink that drops the rows. The stored passages and indexes are
built twice, the second time on the clock as ``build_*``; the queries read them,
as a user's would, so ``scan_*`` steps only read what a build has stored. Each query runs once to warm up and once on the clock."""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame

from lectern.catalog import QUERIES
from lectern.catalog import fixtures as fx
from lectern.operators.corpus import dedup_in_order
from lectern.operators.sparse import INDEXES, IndexTables, build_index
from lectern.session import build_session
from lectern.sources.index_store import TableStore

HEADLINE = (
    "r1_ordered_dedup t2_special_characters t5_prompt_cleaning t7_answer_normalisation t8_tokens c1_feature_windows "
    "c4_fixed_chunks c5_recursive_chunks c5_word_chunks p1_postings p3_tfidf_weights p4_tfidf_topk p7_bm25_fit p8_bm25_topk "
    "p10_zero_score_fill p12_dataset_retrieval r7_gather d3_inner_product_topk d5_cosine_topk d7_cell_assignment "
    "d8_clustered_topk d9_scalar_quantisation n3_triplets n5_shuffled_batches a4_nbest a8_best_answer a11_score_mixture "
    "e2_token_f1 e4_corpus_scores e7_hit_rate_contains flow_extractive flow_generative"
).split()

SCANS = ("p3_tfidf_weights", "p7_bm25_fit")


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", tempfile.mkdtemp(prefix="run-", dir="/tmp"), spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def clock(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    for method in INDEXES:
        fx.index(spark, sf_dir, method)  # warms up, and is what the queries read
    store, key = TableStore(spark), {"bench": uuid.uuid4().hex}
    docs, passages = fx.table(spark, sf_dir, "documents"), fx.passages(spark, sf_dir)
    clock("build_passages", lambda: store.load_or_build_passages(key, lambda: dedup_in_order(docs)))
    for method in INDEXES:
        clock(f"build_{method}", lambda: build_index(method, passages, tables=IndexTables(store, key)))
        clock(f"build_{method}_blocks", lambda: build_index(method, passages, tables=IndexTables(store, key)).blocks())
    for name in HEADLINE:
        drain(QUERIES[name](spark, sf_dir))
        clock(f"scan_{name}" if name in SCANS else name, lambda: drain(QUERIES[name](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
