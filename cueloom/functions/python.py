"""How Python column functions take part in a plan."""

from __future__ import annotations


def once(udf):
    """Keep the optimizer from evaluating a costly Python function twice.

    A filter on a computed column is otherwise pushed below the computation as a
    second copy of it, and the data crosses to Python two times. Declared
    non-deterministic, the function stays where it is written, so cheap filters
    have to be written before it.
    """
    return udf.asNondeterministic()
