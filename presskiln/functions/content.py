"""Content hash and storage path of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(html: Column) -> Column:
    return F.sha2(html, 256)


def raw_path(source_id: Column, day: Column, digest: Column) -> Column:
    """``raw/<source>/<day>/<hash>.html``; equal content of one source and day shares it."""
    return F.concat(
        F.lit("raw/"), source_id.cast("string"), F.lit("/"), F.date_format(day, "yyyy-MM-dd"),
        F.lit("/"), digest, F.lit(".html"),
    )
