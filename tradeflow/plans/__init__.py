"""Plan inspection (T1) and the layered batch job."""

from tradeflow.plans.inspect import explain_text, partition_filters, plan_has

__all__ = ["explain_text", "partition_filters", "plan_has"]
