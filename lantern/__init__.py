"""A Spark-native analytics engine with a DB-API surface, and operators for training-data pipelines."""

from lantern.aio import connect_async
from lantern.dbapi import Connection, Cursor, Error, apilevel, connect, paramstyle, threadsafety
from lantern.errors import LanternError

__all__ = ["Connection", "Cursor", "Error", "LanternError", "apilevel", "connect", "connect_async", "paramstyle", "threadsafety"]
