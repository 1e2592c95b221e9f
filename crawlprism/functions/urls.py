"""URL expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
DEFAULT_TLDS = ("com", "org", "edu", "gov")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def authority(c: Column | str) -> Column:
    """Everything between ``//`` and the path, with user info and port; '' when absent."""
    return F.regexp_extract(_col(c), AUTHORITY, 1)


def root_url(c: Column | str) -> Column:
    """Authority with every ``www.`` removed."""
    return F.replace(authority(c), F.lit("www."), F.lit(""))


def top_level_domain(root: Column | str) -> Column:
    """Trailing ``.letters`` of a root URL; NULL when there is none (a port, for example)."""
    return F.nullif(F.regexp_extract(_col(root), r"\.[a-zA-Z]{2,}$", 0), F.lit(""))


def in_domains(c: Column | str, tlds: Iterable[str] = DEFAULT_TLDS) -> Column:
    """Host ends in one of ``tlds`` directly before a slash or the end. Case-sensitive."""
    return _col(c).rlike(rf"://[^/]*\.({'|'.join(tlds)})(/|$)")
