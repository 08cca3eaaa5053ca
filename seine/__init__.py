"""seine: captured-web-page analytics as Spark jobs.

Captures, link edges, robots and sitemap documents and fetch logs are
DataFrames; extraction, filtering, crawling over the captured link graph, fetch
analytics, sinks and reports are DataFrame programs over them.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Tasks carry these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
