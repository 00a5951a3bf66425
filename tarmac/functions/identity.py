"""Content identity of an observation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Never part of an identity: when and by whom the fact was seen.
NOT_IDENTITY = {
    "ingested_at", "poll_id", "payload_hash", "response_time", "observed_at", "date", "hour"
}


def payload_hash(cols: Iterable[str]) -> Column:
    """128-bit content hash that does not depend on column order.

    Nulls are kept in the text, so a null field differs from an absent one.
    """
    fields = [F.col(c) for c in sorted(cols)]
    return F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def identity_columns(columns: Iterable[str], exclude: Iterable[str] = ()) -> list[str]:
    drop = NOT_IDENTITY | set(exclude)
    return sorted(c for c in columns if c not in drop)
