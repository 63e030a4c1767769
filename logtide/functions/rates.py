"""The error rates in use. They differ on purpose; each has its own name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; null when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole)


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; zero when ``whole`` is zero."""
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def overlap_rate(server: Column, client: Column, events: Column) -> Column:
    """5xx counted in both parts, so the rate runs from 0 to 2."""
    return F.round(ratio(server + client, events), 4)


def disjoint_rate(server: Column, client: Column, events: Column) -> Column:
    """``client`` includes 5xx; taking it once gives a rate from 0 to 1."""
    return F.round(ratio(server + (client - server), events), 4)


def server_rate(server: Column, events: Column) -> Column:
    return F.round(ratio(server, events), 4)
