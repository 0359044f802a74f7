"""Column expressions that are built once per session.

A nested column expression takes one call into the JVM for every function in it, thousands for a whole
article. Expressions name their columns and do not depend on any DataFrame, so one that was built can be
used in every later plan of the session.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import SparkContext


def per_session(build: Callable) -> Callable:
    """Remember what ``build(*args)`` returned (expressions, or lists of them) for as long as the Spark context lives."""
    held: dict = {}

    @functools.wraps(build)
    def call(*args):
        context = SparkContext._active_spark_context
        if held.get("context") is not context:
            held.clear()
            held["context"] = context
        if args not in held:
            held[args] = build(*args)
        return held[args]
    return call
