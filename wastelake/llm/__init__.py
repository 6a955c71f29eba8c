"""Operators for preparing text corpora, one module per operator."""

import sys

from pyspark import cloudpickle

# Workers need not have the package installed: its functions, and those of the library that they use, travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__package__.rpartition(".")[0]])
cloudpickle.register_pickle_by_value(sys.modules[__name__])
