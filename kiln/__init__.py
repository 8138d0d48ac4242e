"""kiln: Spark-first text, time-series and vector analytics operators.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Spark SQL expressions, joins, windows and
aggregates. See ``kiln.plans`` for the catalogue of registered queries.
"""

from kiln.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
