"""Jobs made of the operators, sources and streams."""

from rollcall.plans.daily import DailyPaths, run_daily
from rollcall.plans.produce import run_produce, run_rejects

__all__ = ["DailyPaths", "run_daily", "run_produce", "run_rejects"]
