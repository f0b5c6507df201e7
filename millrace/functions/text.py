"""Tolerant string helpers: a missing piece is NULL, never an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item(text: Column, pattern: str, position: int) -> Column:
    """The piece of ``text`` at ``position`` (from 0) after splitting by the regex ``pattern``."""
    return F.get(F.split(text, pattern), position)


def item_from_end(text: Column, pattern: str, back: int) -> Column:
    """The piece ``back`` places from the end; 1 is the last one."""
    return F.try_element_at(F.split(text, pattern), F.lit(-back))


def host_domain(host: Column | str, n_labels: int) -> Column:
    """The last ``n_labels`` dot separated labels of a host name.

    A host with fewer labels gives the shorter domain, as ``concat_ws`` skips NULL.
    """
    host = F.col(host) if isinstance(host, str) else host
    return F.concat_ws(".", *[item_from_end(host, r"\.", n) for n in range(n_labels, 0, -1)])
