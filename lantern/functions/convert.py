"""Values at the edge of the DB-API surface."""

from __future__ import annotations

import base64
import decimal
import uuid
from typing import Any

from pyspark.sql import Row


def to_client(v: Any) -> Any:
    """decimal and UUID as text, bytes as base64 text, rows as dicts; the rest as it is, time zones included."""
    if isinstance(v, bytes | bytearray):
        return base64.b64encode(bytes(v)).decode("ascii")
    if isinstance(v, decimal.Decimal | uuid.UUID):
        return str(v)
    if isinstance(v, Row):
        return {k: to_client(x) for k, x in v.asDict().items()}
    if isinstance(v, list):
        return [to_client(x) for x in v]
    return v
