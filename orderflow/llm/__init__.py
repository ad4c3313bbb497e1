"""Operators of a training-data pipeline: scoring, formatting, archives,
deduplication, decontamination, extraction, fingerprints, tokenization and
language identification.

One module per operator; :mod:`orderflow.llm.queries` holds the registered
queries and :mod:`orderflow.llm.oracle` their SQL. Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job by value, so executors
# need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
