"""Training-data operators (language id, quality, dedup, packing, ...).

The rest of the library imports only ``common`` of it; ``llm/queries.py`` holds
its registered queries and ``corpus_pipeline.py`` chains five of them.

Functions that run in Spark tasks are pickled by value, so executors need the
public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
