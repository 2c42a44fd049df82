"""Press site of an article: host spelling reduced to the form of ``press_sites``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Host of a URL in lower case without ``www.``, ``m.``, user part or port.

    NULL, empty or schemeless input gives NULL.
    """
    raw = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\s]*@)?([^/?#:\s]+)", 1))
    bare = F.regexp_replace(raw, r"^(?:(?:www|m)\.)+", "")
    return F.when(F.length(bare) > 0, bare)


def link_key(url: Column) -> Column:
    """Identity of an article link: host and path.

    Scheme, host spelling, port, query, fragment and closing slashes are left out.
    NULL, blank or schemeless links give NULL and so match nothing.
    """
    path = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*([^?#\s]*)", 1)
    return F.concat(host_of(url), F.regexp_replace(path, r"/+$", ""))
