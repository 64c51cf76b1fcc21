"""Reuse of built Column expressions.

Building a large expression (a 12k-character ``translate``, a long CASE
chain) costs many Py4J round trips; a Column is immutable, so the same
expression over the same input column names can be shared by every
DataFrame of a session.  Only calls whose arguments are all plain values
(column names, numbers, tuples) are cached, for the running application, up to
``MAX_ENTRIES`` per rule.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext

MAX_ENTRIES = 256
_PLAIN = (str, int, float, bool, type(None))


def _plain(x) -> bool:
    return isinstance(x, _PLAIN) or (isinstance(x, tuple) and all(_plain(i) for i in x))


def _freeze(x):
    """Lists (e.g. a station map of pairs) become tuples so they can be keys."""
    return tuple(_freeze(i) for i in x) if isinstance(x, (list, tuple)) else x


def memo_column(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        key_args = _freeze(args)
        if not kwargs and _plain(key_args):
            sc = SparkContext._active_spark_context
            key = (sc.applicationId if sc else None, key_args)
            hit = cache.get(key)
            if hit is None:
                if len(cache) >= MAX_ENTRIES:
                    cache.clear()
                hit = cache[key] = fn(*args)
            return hit
        return fn(*args, **kwargs)

    return wrapper
