"""Training-data operators on Spark DataFrames.

Nothing outside this subpackage imports it. Functions that run inside tasks
are pickled by value, so executors need no copy of the package.
"""

from pyspark import cloudpickle

import emberledger.llm as _self

cloudpickle.register_pickle_by_value(_self)
