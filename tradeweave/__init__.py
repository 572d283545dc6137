"""tradeweave: product-catalog and influencer data integration on Spark.

Every operator takes DataFrames and returns DataFrames.  Subpackages:

``sources``    readers, union views over drifting tables, catalog metadata
``functions``  Column helpers and the two Arrow-batched string similarities
``operators``  matching, overlap, partner, ranking and schema operators
``sinks``      loads with contracts, surrogate keys and row counts
``plans``      the domain views and queries used by ``__spark_entry__``
"""

import sys

from pyspark import cloudpickle

# Executors need no installed copy: UDF code travels with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
