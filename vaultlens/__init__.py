"""vaultlens: manifest-migration analytics on Spark DataFrames.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; jobs in :mod:`vaultlens.plans.jobs` compose them.
"""

from vaultlens.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
