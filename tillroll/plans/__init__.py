"""The user-level API: cleaning rules, metrics, reports and the jobs."""

from tillroll.plans.gold import customer_metrics, product_metrics
from tillroll.plans.jobs import Config, run_discovery, run_gold, run_reports, run_silver
from tillroll.plans.reports import (
    category_performance_analysis,
    customer_activity_analysis,
    customer_purchase_frequency,
    customer_segment_value,
    top_performing_subcategories,
)
from tillroll.plans.silver import process_customers, process_products, process_transactions

__all__ = [
    "Config",
    "category_performance_analysis",
    "customer_activity_analysis",
    "customer_metrics",
    "customer_purchase_frequency",
    "customer_segment_value",
    "process_customers",
    "process_products",
    "process_transactions",
    "product_metrics",
    "run_discovery",
    "run_gold",
    "run_reports",
    "run_silver",
    "top_performing_subcategories",
]
