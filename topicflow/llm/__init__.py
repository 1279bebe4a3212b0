"""Operators for preparing training data.

Nothing else in the library imports this package. Each operator takes and returns DataFrames;
``queries`` registers one query for each.
"""

from pyspark import cloudpickle

import topicflow

# Functions go to the executors by value, so that these need not have the package installed.
cloudpickle.register_pickle_by_value(topicflow)
