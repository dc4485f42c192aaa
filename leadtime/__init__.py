"""leadtime: lead-time feature engineering on Spark DataFrames.

Every public function takes DataFrames and column names and returns a
DataFrame (or a Column expression); nothing is collected to the driver
except small, size-bounded results (fold bounds, metric scalars).
"""

from leadtime.session import get_session, checkpoint_dir, use_utc

__all__ = ["get_session", "checkpoint_dir", "use_utc"]
