"""shopscope: merchant analytics on PySpark.

Shops, payments and page views are read into typed DataFrames, selected by
city and category keyword, counted per shop and per day, scored, and ranked.
Every operator is a plain function from DataFrame (or Column) to DataFrame
(or Column), built from Spark's own expressions, joins, aggregates and
windows, so Catalyst plans a whole job as one query.
"""

from shopscope.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
