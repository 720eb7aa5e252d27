"""verbena: build, check and score labelled comment data with Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame
operators), ``sources`` (readers, writers, derived test tables), ``plans``
(labelling, training, scoring jobs) and ``streaming`` (Structured Streaming).
"""

__version__ = "0.1.0"
