"""Link addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute(href: Column, base: Column) -> Column:
    """Anything that does not start with ``http`` is put under the site root ``base``."""
    joined = F.concat(
        F.regexp_replace(base, r"/+\z", ""), F.lit("/"), F.regexp_replace(href, r"\A/+", "")
    )
    return F.when(href.startswith("http"), href).otherwise(joined)


def requested(url: Column) -> Column:
    """The address a client asks for: without fragment, and with ``/`` for an empty path."""
    whole = F.regexp_replace(url, r"(?s)#.*", "")
    return F.regexp_replace(whole, r"\A(https?://[^/?]+)(?=\?|\z)", "$1/")
