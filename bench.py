"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1).
Results go to Spark's ``noop`` sink: every row is computed, none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "clean_derive", "invalid_range_impute", "outlier_flag_summary", "zscore_rows", "customer_frequency",
    "missingness_chi2", "describe_population", "describe_sample", "quantiles_exact", "boxplot_stats",
    "hist_density", "chi2_independence", "spearman_pair", "spearman_matrix", "anova_oneway", "kruskal_wallis",
    "mann_whitney", "welch_t", "simple_regression", "normality_report", "daily_series_filled",
    "seasonal_decompose_7", "acf_30", "pacf_30", "event_impact", "ols_coefficients", "ols_holdout",
    "breusch_pagan", "durbin_watson", "vif",
)


def study(spark, sf_dir: str) -> float:
    """The whole analysis over the stored sales view, every result table computed."""
    from sparkinfer.plans.queries import EVENTS, LOW, SERIES_START, URGENT
    from sparkinfer.plans.sales import sales
    from sparkinfer.plans.suites import SalesColumns, StudyConfig, run_study
    from sparkinfer.sources.landing import cut

    stored = cut(sales(spark, sf_dir).drop("age_years"))
    config = StudyConfig(columns=SalesColumns(birth="birth_text", ts="shipped"), app_channel=URGENT, web_channel=LOW,
                         channels=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), store_range=(0, 2**31 - 1),
                         genders=("F", "O"), events=EVENTS, series_start=SERIES_START, seed=42)
    start = time.perf_counter()
    for result in run_study(stored, config).values():
        result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from pyspark.sql import SparkSession

    from sparkinfer.plans.queries import REGISTRY

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    REGISTRY["group_sizes"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    times: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name}: {best:.2f}", file=sys.stderr, flush=True)
    whole = None  # comparable to the published full run; not part of the sum of queries
    if not only or "run_study" in only:
        whole = round(study(spark, sf_dir), 3)
        print(f"run_study: {whole:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "run_study": whole, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
