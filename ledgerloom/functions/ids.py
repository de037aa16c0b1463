"""Stable identifiers: hashes of parts and canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def candidate_id(*parts: Column, length: int = 16) -> Column:
    """The first hex digits of the SHA-256 of the parts, one a line; null is an empty line."""
    lines = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.substring(F.sha2(F.concat_ws("\n", *lines), 256), 1, length)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with its keys in alphabetical order, nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def review_id(prefix: str, label: Column, identity: Column) -> Column:
    from ledgerloom.functions.text import slug

    return F.concat(F.lit(f"{prefix}_"), slug(label), F.lit("_"), F.substring(F.sha2(identity, 256), 1, 16))
