"""harvestline: commodity price analytics as Spark DataFrame operators.

Every public operator takes DataFrames (plus column-name parameters) and
returns a DataFrame. Nothing is collected to the driver; the plans are left to
Catalyst and AQE.
"""

from harvestline.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
