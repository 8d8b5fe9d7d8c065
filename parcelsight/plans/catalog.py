"""The questions by name, with their default parameters, on a stored model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from parcelsight.plans import alerts as A
from parcelsight.plans import kpis as K
from parcelsight.plans.model import Model

QUESTIONS: dict[str, Callable[[Model], DataFrame]] = {
    "late_rate_baseline": lambda m: K.late_rate_baseline(m["orders"]),
    "stage_medians": lambda m: K.stage_medians(m["orders"]),
    "late_by_state": lambda m: K.late_by_state(m["orders"], m["customers"]),
    "late_by_seller_volume": lambda m: K.late_by_seller_volume(m["orders"], m["order_items"]),
    "late_by_seller_rate": lambda m: K.late_by_seller_rate(m["orders"], m["order_items"]),
    "late_by_category": lambda m: K.late_by_category(
        m["orders"], m["order_items"], m["products"]
    ),
    "late_by_distance_band": lambda m: K.late_by_distance_band(m["orders"], m["order_items"]),
    "median_distance_by_state": lambda m: K.median_distance_by_state(
        m["orders"], m["customers"], m["order_items"]
    ),
    "late_by_month": lambda m: K.late_by_month(m["orders"]),
    "promised_vs_actual_by_month": lambda m: K.promised_vs_actual_by_month(m["orders"]),
    "late_rate_by_month_pivot": lambda m: K.late_rate_by_month_pivot(m["orders"], m["customers"]),
    "entity_vs_rest_by_month": lambda m: K.entity_vs_rest_by_month(m["orders"], m["customers"]),
    "states_at_same_distance": lambda m: K.states_at_same_distance(
        m["orders"], m["customers"], m["order_items"]
    ),
    "episode_size": lambda m: K.episode_size(m["orders"], m["customers"]),
    "review_by_delay_band": lambda m: K.review_by_delay_band(m["orders"], m["reviews"]),
    "review_cost_of_lateness": lambda m: K.review_cost_of_lateness(
        m["orders"], m["customers"], m["reviews"]
    ),
    "excess_by_month": lambda m: K.excess_by_month(m["orders"], m["customers"]),
    "alerts": lambda m: A.alerts(m["orders"], m["customers"]),
    "alert_episodes": lambda m: A.alert_episodes(m["orders"], m["customers"]),
    "alert_runs": lambda m: A.alert_runs(A.alert_episodes(m["orders"], m["customers"])),
    "excess_after_alert": lambda m: A.excess_after_alert(
        m["orders"], m["customers"], m["reviews"]
    ),
}
