"""Quadrille: RDF datasets as tables of quads, queried and updated with Spark DataFrames.

Functions of this package travel to the executors by value, so workers need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
