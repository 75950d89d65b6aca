"""Layered batch analytics on Spark: ingest, clean, gate, summarise.

Every operator is a plain function on Spark DataFrames. None of them creates
or stops a session; the caller passes the DataFrame (or the session) in.
"""

from siltstone.config import DatasetSpec, GoldColumns, Layout, RunConfig
from siltstone.plans.run import run_pipeline, run_report
from siltstone.presets import LINEITEM, TAXI

__all__ = [
    "DatasetSpec",
    "GoldColumns",
    "LINEITEM",
    "Layout",
    "RunConfig",
    "TAXI",
    "run_pipeline",
    "run_report",
]
