"""Operations of a training-data pipeline over tables of documents and pages."""

import sys

from pyspark import cloudpickle

# Functions travel with their query: executors need the libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
