"""tankflow: hourly tank-outflow, baseline, forecast and depletion analytics on Spark.

Every operator is a function from DataFrames to a DataFrame keyed by
(station, product, tank); per-series parameters come from a config frame.
"""

from .session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
