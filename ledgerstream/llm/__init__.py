"""Operations of a training-data pipeline on tables of documents, pages and vectors."""

import sys

from pyspark import cloudpickle

# Tasks are sent the functions themselves, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
