"""recspark: the data side of a recommender system as Spark jobs.

Every operator takes DataFrames and returns DataFrames; see the README for the
map from operator to module.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from recspark.session import build_session, freeze, shared_dir

# The functions that run in Python tasks travel with the tasks: executors need
# numpy and pyarrow, but not this package.
register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "freeze", "shared_dir"]
