"""Operators for preparing training corpora (documents, pages, embeddings).

One module per operator; ``queries`` holds the registered ``opN_<name>``
queries and ``oracle`` their DuckDB SQL. Nothing outside this subpackage
(and ``corpus_pipeline.py``) imports it.

Functions that run in Python workers are sent by value, so the executors do
not need the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
