"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from loamworks.functions.text import content_hash
from loamworks.operators.lineage import cut_lineage, shared_folder, written

__all__ = ["content_hash", "cut_lineage", "normalised_url", "shared_folder", "shuffle_partitions", "site_of", "written"]

SITE = r"^[hH][tT][tT][pP][sS]?://([^/?#]+)"


def normalised_url(url: Column) -> Column:
    """Fragment dropped, then all trailing slashes."""
    return F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"/+$", "")


def site_of(url: Column) -> Column:
    """Lower-cased host of an http(s) URL, else null."""
    return F.nullif(F.lower(F.regexp_extract(url, SITE, 1)), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
