"""Vector collections on Spark: records with embeddings, metadata and text."""

import sys

from pyspark import cloudpickle

from kinfold.collection import Collection, Workspace
from kinfold.functions.filters import Where
from kinfold.sources.records import Record

# Functions that run inside tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Collection", "Record", "Where", "Workspace"]
