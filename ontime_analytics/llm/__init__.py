"""Operators for preparing training text at scale.

Nothing else in the library imports this package.  Each module holds one
operator with a general DataFrame interface; :mod:`ontime_analytics.llm.catalog`
holds the thin queries over the driver's tables and their DuckDB SQL.
"""

import sys

from pyspark import cloudpickle

# functions sent to Python workers carry their code: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
