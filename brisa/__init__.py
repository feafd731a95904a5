"""brisa: hourly sensor observations on Spark.

Every operator takes and returns DataFrames, so pipelines are written with ``df.transform`` and
planned as a whole by Spark.  See README.md for the layout.
"""

from brisa.session import configure, shared_folder

__all__ = ["configure", "shared_folder"]
