"""Case-surveillance analytics as Spark DataFrame operators."""

from pyspark.cloudpickle import register_pickle_by_value

from casebeacon.functions import folds

# The few functions that run inside Python workers travel with the job, so executors
# need no copy of this package.
register_pickle_by_value(folds)
