"""Sources and sinks (Parquet, CSV, adjacency text, fixed width, stages)."""

from leadtime.sources.io import *  # noqa: F401,F403
