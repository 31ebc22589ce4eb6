"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``cold`` queries start from the source tables and include every layer they need. The
others run on the layers of one session, whose building is timed as ``build_*``. All
rows of a result are made and thrown away.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from fiscalake.checks.binding import RULES, Layers, layers
from fiscalake.checks.queries import QUERIES
from fiscalake.plans import features, mart, serving
from fiscalake.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _rows(built: Layers):
    return mart.with_kpis(built.trusted_plan, RULES)


COLD = {
    "fact": lambda built: mart.published(built.star.fato_emendas),
    "rank_authors": lambda built: mart.ranking_by_author(_rows(built), RULES),
    "exec_function_place": lambda built: mart.budget_execution(_rows(built), RULES),
    "modal_attribute": lambda built: QUERIES["modal_attribute"](built.spark, built.folder),
    "features": lambda built: features.features(built.serving, RULES),
    "label_correlation": lambda built: features.feature_ranking(features.features(built.serving, RULES), 6),
    "dedupe_latest": lambda built: QUERIES["dedupe_latest"](built.spark, built.folder),
    "rate_histogram": lambda built: serving.rate_histogram(_rows(built)),
}

WARM = [
    "fact",
    "rank_authors",
    "dist_function_region",
    "exec_function_place",
    "fact_joins",
    "star_denormalised",
    "features",
    "label_correlation",
    "correlation_matrix",
    "kpis",
    "coverage",
    "top_functions",
    "top_authors",
    "uf_totals",
    "uf_share",
    "showcase_table",
    "showcase_totals",
    "rate_histogram",
    "scatter_set",
    "filtered_working_set",
    "quality_summary",
    "quality_report_null",
    "quarantine",
    "trusted_null",
    "contract_violations",
    "field_profile",
    "dedupe_first",
    "surrogate_key",
    "global_rank",
    "group_join_back",
    "group_aggregates",
]


def main() -> None:
    spark = local_session(CPUS)
    times: dict[str, float] = {}

    def consume(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def clock(name: str, make) -> None:
        start = time.perf_counter()
        make()
        times[name] = round(time.perf_counter() - start, 3)

    # The first job pays for starting the engine.
    consume(QUERIES["fact"](spark, FOLDER))
    for name, make in COLD.items():
        clock(f"cold_{name}", lambda: consume(make(Layers(spark, FOLDER))))
    built = layers(spark, FOLDER, fresh=True)
    clock("build_trusted", lambda: built.trusted)
    clock("build_dimensions", lambda: built.star)
    clock("build_cube", lambda: built.cube)
    for name in WARM:
        clock(name, lambda: consume(QUERIES[name](spark, FOLDER)))
    report = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(Path(FOLDER).name.removeprefix("sf") or 0),
    }
    print(json.dumps(report), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
