"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query derives its tables from the raw test tables. "stored_model" has the same questions
on a model that was written once before, outside the measured time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parcelsight.plans.catalog import QUESTIONS  # noqa: E402
from parcelsight.plans.model import read_model, write_model  # noqa: E402
from parcelsight.session import local_session, tune  # noqa: E402
from parcelsight.testbed import queries as testbed  # noqa: E402


# The questions, the export tables and the cleaning steps.
HEADLINE = """
late_rate_baseline stage_medians late_by_state late_by_seller_volume late_by_seller_rate
late_by_category late_by_distance_band median_distance_by_state late_by_month
promised_vs_actual_by_month late_rate_by_month_pivot entity_vs_rest_by_month
states_at_same_distance episode_size review_by_delay_band review_cost_of_lateness
excess_by_month alerts alert_episodes alert_runs excess_after_alert
fact_orders fact_stage_hours dim_date dim_state seller_rates entity_excess
clean_orders clean_order_items clean_products clean_reviews geo_by_prefix item_distances
order_items_model table_counts violations
""".split()


def timed(spark, name: str, sf_dir: str) -> float:
    """Seconds to plan a query and produce all its rows (written nowhere)."""
    start = time.perf_counter()
    testbed.run(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored_model(spark, sf_dir: str) -> dict[str, float]:
    """Seconds per question on a stored model, each run a second time as above."""
    tables = testbed.Clean(tune(spark), sf_dir)
    folder = tables.new_folder("bench-model")
    write_model(tables.model(), folder)
    model, seconds = read_model(spark, folder), {}
    for name, question in QUESTIONS.items():
        run(question(model))
        seconds[name] = round(run(question(model)), 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)  # compiles the plan's code, as in a running session
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    stored = {} if sys.argv[1:] else stored_model(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "stored_model": {"value": round(sum(stored.values()), 3), "queries": stored},
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
