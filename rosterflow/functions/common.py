"""Small column helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Column expressions have no local binding: a sub-expression referenced
    several times is evaluated several times (and chained steps that each
    read their input more than once multiply the work).  Wrapping the value
    in a one-element array and transforming it binds it to a variable that
    ``body`` may reference freely; the result stays a native expression.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
