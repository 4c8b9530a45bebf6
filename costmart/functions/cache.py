"""Per-session memoization of Column builders.

Building an expression tree in classic PySpark costs one JVM round trip per
node; the label and measure expressions have hundreds of nodes. A Column is
an immutable, unresolved expression, so a builder that depends only on its
(hashable) arguments can return the same Column for every plan of the
session. The cache is tied to the active SparkContext; a new context
rebuilds it. Without a JVM context (e.g. Spark Connect) nothing is cached.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def per_session(fn):
    store: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        if sc is None:
            return fn(*args)
        hit = store.get(args)
        if hit is None or hit[0] is not sc:
            hit = (sc, fn(*args))
            store[args] = hit
        return hit[1]

    return wrapper
