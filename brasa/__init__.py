"""brasa — Spark-native analytics for wildfire incident and dispatch records.

Every operator is a ``DataFrame -> DataFrame`` function (compose them with
``DataFrame.transform``); planning is left to Catalyst and AQE.
"""

from brasa.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
