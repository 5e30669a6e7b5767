"""Small scalar and set functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_secret(value: Column) -> Column:
    """First four characters and four stars; short values keep all characters."""
    return F.concat(F.left(value, F.lit(4)), F.lit("****"))


def mask_secret_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Show the named columns masked."""
    return df.withColumns({n: mask_secret(F.col(n).cast("string")) for n in names})


def mask_by_key(settings: Column, prefix: str = "AWS_") -> Column:
    """Mask the values of a map whose key starts with ``prefix``."""
    return F.transform_values(
        settings, lambda k, v: F.when(F.startswith(k, F.lit(prefix)), mask_secret(v)).otherwise(v)
    )


# Where the sensitive part of a storage error message begins (fixed values).
ERROR_MARKERS = ("aws_request_id", "s3_extended_request_id")


def cut_at_marker(text: Column, markers: Sequence[str] = ERROR_MARKERS) -> Column:
    """Cut at the earliest marker and append ``...``; unmarked text stays."""
    found = [F.nullif(F.instr(text, m), F.lit(0)) for m in markers]
    first = F.least(*found) if len(found) > 1 else found[0]
    return F.when(first.isNull(), text).otherwise(
        F.concat(F.left(text, first - 1), F.lit("..."))
    )


def preview(text: Column, length: int = 80) -> Column:
    """The first ``length`` characters, for logs and quarantine tables."""
    return F.left(text, F.lit(length))


def preview_bytes(data: Column, length: int = 80) -> Column:
    return F.substring(data.cast("binary"), 1, length)


def url_bucket(url: Column, scheme: str = "s3") -> Column:
    """Host of an object-store URL; NULL for every other URL."""
    # ``try_parse_url`` keeps the case of the scheme; a scheme is case-insensitive.
    is_store = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) == scheme
    return F.when(is_store, F.nullif(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def merge_unique(left: Column, right: Column) -> Column:
    """Union of two arrays without duplicates."""
    return F.array_union(left, right)


def missing_items(required: Column, present: Column) -> Column:
    """The required items that are not present."""
    return F.array_except(required, present)


def missing_rows(required: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Row form of :func:`missing_items`."""
    return required.join(present.select(*on), list(on), "left_anti")


def not_ready(status: DataFrame, name: str = "component", ready: str = "ready") -> DataFrame:
    """Names of the components that are not ready, each once."""
    return status.where(~F.coalesce(F.col(ready), F.lit(False))).select(name).distinct()
