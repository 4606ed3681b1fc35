"""Tables and schema documents from corpora of web pages and CSV files, on Spark.

A document is one row from the moment it is read until its schema is written: the page's
markup becomes an array of nodes, the nodes become an array of tables, a table becomes an
array of columns.  Everything that concerns one document is therefore a projection, and
data moves between executors only where rows of different documents meet (patches,
metrics, whole-table profiles).
"""

import sys

from pyspark import cloudpickle

from pagetables.session import get_session

# What runs in Python tasks is sent by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session"]
