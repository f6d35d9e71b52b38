"""moodindex: market-mood indicators from short user comments, on Spark.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column``) and stays lazy; nothing is collected to the driver except
size-checked lexicons and single scalars.
"""

from moodindex.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
