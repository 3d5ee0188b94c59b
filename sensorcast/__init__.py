"""sensorcast: many-series sensor time-series analytics on Spark.

Raw readings are regularised into hourly series (bucketed means, gap grids,
linear interpolation), turned into calendar / lag / window features, split in
time order, normalised, fitted with climatology, autoregressive, window
regression and forest forecasters, rolled out over a horizon for every series
at once, evaluated, and described with summaries and profiles.  Every public
operator is ``DataFrame -> DataFrame`` and runs on Spark.
"""

from sensorcast.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
