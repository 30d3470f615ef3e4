"""A dialect for SQLAlchemy, where that is installed: create_engine("lantern:////folder/database")."""

from __future__ import annotations

import importlib.util

if importlib.util.find_spec("sqlalchemy"):
    from sqlalchemy import pool
    from sqlalchemy.dialects import registry
    from sqlalchemy.engine import default

    class LanternDialect(default.DefaultDialect):
        name, driver, paramstyle = "lantern", "lantern", "pyformat"
        supports_statement_cache = False
        supports_native_boolean = True
        poolclass = pool.SingletonThreadPool

        @classmethod
        def import_dbapi(cls):
            import lantern.dbapi

            return lantern.dbapi

        def create_connect_args(self, url):
            folder, _, database = (url.database or "").rpartition("/")
            return (f"/{folder.lstrip('/')}" if folder else "", database or "default"), dict(url.query)

        def has_table(self, connection, table_name, schema=None, **kw) -> bool:
            return connection.connection.has_table(table_name)

        def do_begin(self, connection) -> None:
            connection.begin()

        def _check_unicode_returns(self, *_) -> bool:
            return True

    registry.register("lantern", "lantern.dialect", "LanternDialect")
else:
    LanternDialect = None
