"""URLs as columns. All are null for null."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_NETLOC = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def normalize_url(url: Column) -> Column:
    """Fragment and all trailing slashes dropped; a URL of slashes only stays as it is."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    cut = F.regexp_replace(bare, r"/+$", "")
    return F.when(cut == "", bare).otherwise(cut)


def is_valid_url(url: Column) -> Column:
    """Scheme http or https and a host."""
    return url.rlike(r"^[hH][tT][tT][pP][sS]?://[^/?#]+")


def netloc(url: Column) -> Column:
    """Host with port and user, as written; empty if there is none."""
    return F.regexp_extract(url, _NETLOC, 1)


def same_domain(a: Column, b: Column) -> Column:
    return netloc(a) == netloc(b)


def sitemap_root(url: Column) -> Column:
    """Address of the sitemap at the root of the URL's host."""
    return F.concat(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1), F.lit("/sitemap.xml"))


def content_type_base(content_type: Column) -> Column:
    """Media type without parameters."""
    return F.trim(F.split(content_type, ";")[0])


@F.pandas_udf(StringType())
def join_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """A link resolved against the address of its page; null if either is null or it cannot be resolved."""

    def one(b: str | None, h: str | None) -> str | None:
        try:
            return None if b is None or h is None else urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)])
