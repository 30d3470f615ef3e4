"""A DB-API surface over Spark SQL and a store of mutable tables.

Queries stay lazy: `execute` plans, fetching runs. Tables of the store and views of the session are seen by one name
space of the connection.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lantern.errors import LanternError
from lantern.functions.convert import to_client
from lantern.params import adapted, bind, commas, first_values, split_at, tokens
from lantern.plans import guard
from lantern.session import isolated, session
from lantern.sources.store import PART, Store

log = logging.getLogger(__name__)
apilevel, threadsafety, paramstyle = "2.0", 1, "pyformat"
Error = LanternError
_NAME = r"[`\"]?(\w+)[`\"]?"
_INDEX = re.compile(rf"\s*CREATE\s+(UNIQUE\s+)?INDEX\s+(?:IF\s+NOT\s+EXISTS\s+)?{_NAME}\s+ON\s+{_NAME}\s*\((.+)\)\s*;?\s*$", re.I | re.S)
_DROP_INDEX = re.compile(rf"\s*DROP\s+INDEX\s+(?:IF\s+EXISTS\s+)?{_NAME}(?:\s+ON\s+{_NAME})?\s*;?\s*$", re.I)
_TABLE = re.compile(rf"\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?{_NAME}\s*(?:\((.*)\))?\s*;?\s*$", re.I | re.S)
_AS = re.compile(rf"\s*CREATE\s+(?:(OR\s+REPLACE)\s+)?(TABLE|VIEW)\s+(?:IF\s+NOT\s+EXISTS\s+)?{_NAME}\s+AS\s+(.*?);?\s*$", re.I | re.S)
_DROP_VIEW = re.compile(rf"\s*DROP\s+VIEW\s+(?:IF\s+EXISTS\s+)?{_NAME}\s*;?\s*$", re.I)
_DROP = re.compile(rf"\s*DROP\s+TABLE\s+(?:IF\s+EXISTS\s+)?{_NAME}\s*;?\s*$", re.I)
_TYPES = {"INTEGER": "INT", "TEXT": "STRING", "VARCHAR": "STRING", "CHAR": "STRING", "DATETIME": "TIMESTAMP", "REAL": "DOUBLE", "BOOL": "BOOLEAN", "BLOB": "BINARY", "SERIAL": "BIGINT", "NUMERIC": "DECIMAL"}
_UNNAMED = re.compile(r"^(sum|avg|min|max|count)\((distinct )?(?:\w+\.)?(\w+)\)$", re.I)


def _spark_error(e: Exception) -> LanternError:
    return e if isinstance(e, LanternError) else guard.of_analysis(e)


class Cursor:
    """dataframe holds the lazy result of a query."""

    arraysize = 1

    def __init__(self, connection: Connection):
        self.connection = connection
        self._closed = False
        self._reset()

    def _reset(self) -> None:
        if getattr(self, "_kept", None) is not None:
            self._kept.unpersist()
        self._kept: DataFrame | None = None
        self.dataframe: DataFrame | None = None
        self.lastrowid: Any = None
        self._count = -1
        self._rows: Iterator | None = None

    def _open(self) -> None:
        if self._closed:
            raise LanternError("E5", "the cursor is closed")

    def execute(self, sql: str, params: Sequence | Mapping | None = None) -> Cursor:
        self._open()
        self._reset()
        self.dataframe, self._count, self.lastrowid = self.connection._run(sql, params)
        return self

    def executemany(self, sql: str, seq_of_params: Sequence) -> Cursor:
        """An INSERT of VALUES goes in one write; other statements run in turn. rowcount is the sum."""
        self._open()
        self._reset()
        seq = list(seq_of_params)
        done = self.connection._insert_many(sql, seq) if seq and guard.kind(sql) == "insert" else None
        if done is None:
            total = 0
            for p in seq:
                self.execute(sql, p)
                total += max(self.rowcount, 0)
            done = (total, self.lastrowid)
        self._count, self.lastrowid = done
        return self

    @property
    def rowcount(self) -> int:
        """Of a query: counted when asked for; rows that were not fetched before are kept for that."""
        if self._count < 0 and self.dataframe is not None:
            if self._rows is None:
                self.dataframe = self._kept = self.dataframe.persist()
            self._count = self.dataframe.count()
        return self._count

    @property
    def description(self) -> list[tuple] | None:
        if self.dataframe is None:
            return None
        return [(f.name, f.dataType.simpleString(), None, None, None, None, f.nullable) for f in self.dataframe.schema.fields]

    def _next(self) -> Iterator:
        self._open()
        if self._rows is None:
            rows = self.dataframe.toLocalIterator(prefetchPartitions=True) if self.dataframe is not None else iter(())
            self._rows = (tuple(to_client(v) for v in r) for r in rows)
        return self._rows

    def fetchone(self) -> tuple | None:
        return next(self._next(), None)

    def fetchmany(self, size: int | None = None) -> list[tuple]:
        return [r for _, r in zip(range(size or self.arraysize), self._next(), strict=False)]

    def fetchall(self) -> list[tuple]:
        if self._rows is None and self.dataframe is not None:
            self._open()
            self._rows = iter(())
            rows = [tuple(to_client(v) for v in r) for r in self.dataframe.collect()]
            self._count = len(rows)
            return rows
        return list(self._next())

    def __iter__(self) -> Iterator[tuple]:
        return self._next()

    def close(self) -> None:
        self._reset()
        self._closed = True

    def __enter__(self) -> Cursor:
        return self

    def __exit__(self, *_) -> None:
        self.close()


class Connection:
    def __init__(self, path: str, database: str = "default", spark: SparkSession | None = None, profile: str = "extended", implicit_ids: bool = False):
        if not path:
            raise LanternError("E1")
        self.spark = isolated(spark or session())
        self.profile, self.implicit_ids = profile, implicit_ids
        self.store = Store(self.spark, f"{path.rstrip('/')}/{database}")
        self._views: dict[str, str] = {}

    def cursor(self) -> Cursor:
        return Cursor(self)

    def begin(self) -> None:
        log.debug("begin")
        self.store.begin()

    def commit(self) -> None:
        log.debug("commit")
        self.store.commit()

    def rollback(self) -> None:
        log.debug("rollback")
        self.store.rollback()

    def close(self) -> None:
        self.store.rollback()

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, kind, *_) -> None:
        self.rollback() if kind else self.commit()
        self.close()

    def list_tables(self) -> list[str]:
        views = [t.name for t in self.spark.catalog.listTables() if t.name not in self._views]
        return sorted({*self.store.tables(), *self.store.manifest().get("views", {}), *views})

    def has_table(self, name: str) -> bool:
        return name in self.list_tables()

    # statements

    def _refresh(self) -> None:
        """Views of the store's tables as this connection sees them now; the manifest that they show is kept."""
        self._seen = self.store.manifest()
        now = {name: str(t) for name, t in self._seen["tables"].items()} | {name: sql for name, sql in self._seen.get("views", {}).items()}
        for name in set(self._views) - set(now):
            self.spark.catalog.dropTempView(name)
        changed = False
        for name, state in now.items():
            view = name in self._seen.get("views", {})
            if self._views.get(name) != state or view and changed:
                (self.spark.sql(state) if view else self.store.read(name, self._seen)).createOrReplaceTempView(name)
                changed = True
        self._views = now

    def _query(self, sql: str, args: dict) -> DataFrame:
        self._refresh()
        return self._planned(sql, args)

    def _planned(self, sql: str, args: dict) -> DataFrame:
        try:
            return self.spark.sql(sql, args=args)
        except PySparkException as e:
            raise _spark_error(e) from e

    def _run(self, sql: str, params) -> tuple[DataFrame | None, int, Any]:
        log.debug("execute %s", sql)
        text, args = bind(sql, params)
        kind = guard.kind(text)
        if kind != "insert":
            text, args = adapted(text, args)
        if kind == "create":
            return self._create(text)
        if kind == "drop":
            return self._drop(text)
        plan = guard.parse(self.spark, text)
        if kind == "query":
            guard.check(plan, self.profile)
            return self._shaped(text, args), -1, None
        if kind == "insert":
            return (None, *self._insert(text, args))
        if kind == "update":
            return None, self._update(text, args), None
        if kind == "delete":
            return None, self._delete(text, args), None
        raise LanternError("E2", "STATEMENT")

    def _shaped(self, sql: str, args: dict) -> DataFrame:
        """Columns as clients expect them: `*` is alphabetical, of joins table by table; aggregates have plain names."""
        try:
            df = self._query(sql, args)
        except LanternError as e:
            grouped = first_values(sql) if self.profile != "strict" and "MISSING_AGGREGATION" in str(e) else None
            if grouped is None:
                raise
            try:
                df = self._query(grouped, args)
            except LanternError:
                raise e from None
        m = re.match(r"\s*SELECT\s+\*\s+FROM\s", sql, re.I)
        sides = self._sides(sql) if m else []
        if m and len(sides) > 1:
            columns = []
            for k, (name, alias) in enumerate(sides):
                columns += [f"{alias}.`{c}` AS `{c if not k else f'__join{k}.{c}'}`" for c in sorted(self.spark.table(name).columns)]
            return self._query(re.sub(r"\*", lambda _: ", ".join(columns), sql, count=1), args)
        if m:
            return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])
        items = commas(split_at(sql, "SELECT", "FROM")[1])
        names: list[str] = []
        for k, c in enumerate(df.columns):
            agg = _UNNAMED.match(c)
            if agg:
                name = "count" if agg[3] == "1" else "_".join(filter(None, (agg[1].lower(), "distinct" if agg[2] else "", agg[3])))
                name += f"_{names.count(name) + 1 + sum(n.startswith(f'{name}_') and n[len(name) + 1 :].isdigit() for n in names)}" if name in names else ""
            else:
                path = re.fullmatch(r"`\w+`(?:\.`\w+`)+", items[k]) if len(items) == len(df.columns) else None
                name = path[0].replace("`", "") if path else c
            names.append(name)
        return df.toDF(*names) if names != df.columns else df

    def _sides(self, sql: str) -> list[tuple[str, str]]:
        """(table, alias) of FROM and JOIN, if they are all plain tables."""
        _, tail = split_at(sql, "FROM")
        tail = re.split(r"\b(?:WHERE|GROUP|ORDER|LIMIT|OFFSET|UNION|HAVING)\b", tail, maxsplit=1, flags=re.I)[0]
        if "(" in re.sub(r"\bON\b.*", "", tail, flags=re.I | re.S):
            return []
        out = []
        for part in re.split(r"\b(?:INNER|LEFT|RIGHT|FULL|CROSS)?\s*(?:OUTER\s+)?JOIN\b", tail, flags=re.I):
            m = re.match(rf"\s*{_NAME}(?:\s+(?:AS\s+)?(?!ON\b|USING\b)(\w+))?", part, re.I)
            if not m:
                return []
            out.append((m[1], m[2] or m[1]))
        return out

    def _target(self, text: str) -> str:
        m = re.match(rf"\s*{_NAME}(?:\s+(?:AS\s+)?(\w+))?\s*$", text, re.I)
        if not m:
            raise LanternError("E5", "table name")
        return m[1]

    # rows

    def _insert(self, sql: str, args: dict) -> tuple[int, Any]:
        m = re.match(rf"\s*INSERT\s+INTO\s+(?:TABLE\s+)?{_NAME}\s*(?:\(([^()]*)\))?\s*(.*)$", sql, re.I | re.S)
        if not m:
            raise LanternError("E5")
        table, columns, body = m[1], m[2], m[3].rstrip("; \n")
        known = table in self.store.manifest()["tables"]
        names = [c.strip(' `"') for c in commas(columns)] if columns else [f.name for f in self.store.schema(table).fields] if known else None
        if (given := re.match(r"VALUES\b", body, re.I)) and any(k == "word" and w.upper() == "SELECT" for k, w, _ in tokens(body)):
            body, given = " UNION ALL ".join(f"SELECT {row[1:-1]}" for row in commas(body[6:])), None  # subqueries as values
        try:
            rows = self._query(f"SELECT * FROM {body}" if given else body, args)
        except LanternError as e:
            raise LanternError("E4", cause=e) if "INVALID_INLINE_TABLE" in str(e.__cause__) or "INLINE_TABLE" in str(e) else e
        if names is None:
            raise LanternError("E5", f"no table {table}, and no column names")
        if len(names) != len(rows.columns):
            raise LanternError("E4")
        rows, last = rows.toDF(*names), None
        if self.implicit_ids and "_id" not in names:
            last = uuid.uuid4().hex
            rows = rows.withColumn("_id", F.lit(last) if re.match(r"VALUES", body, re.I) and len(commas(body[6:])) == 1 else F.expr("replace(uuid(), '-', '')"))
        return self.store.insert(table, rows), last

    def _insert_many(self, sql: str, seq: list) -> tuple[int, Any] | None:
        """All parameter sets as rows of one INSERT; None if the statement isn't a single row of VALUES."""
        text, _ = bind(sql, seq[0])
        head, body = split_at(text, "VALUES")
        if not body or len(commas(body)) != 1:
            return None
        rows, args = [], {}
        for i, p in enumerate(seq):
            own, values = bind(sql, p)
            row = split_at(own, "VALUES")[1].rstrip("; \n")
            marked, after = [], ""
            for kind, t, _ in tokens(row):
                marked.append(f"r{i}_{t}" if kind == "word" and after == ":" else t)
                after = t
            rows.append("".join(marked))
            args |= {f"r{i}_{k}": v for k, v in values.items()}
        return self._insert(f"{head} VALUES {', '.join(rows)}", args)

    def _update(self, sql: str, args: dict) -> int:
        head, sets, where = split_at(sql, "SET", "WHERE")
        if not where:
            raise LanternError("E3")
        table = self._target(re.sub(r"^\s*UPDATE\s", "", head, flags=re.I))
        alias = re.match(rf"\s*UPDATE\s+{_NAME}\s+(?:AS\s+)?(\w+)", head, re.I)
        changes = {}
        for part in commas(sets):
            name, _, expr = part.partition("=")
            changes[name.strip().strip('`"').split(".")[-1]] = expr.strip()
        seen = self._matching(table, where, args)
        fields = T.StructType.fromJson(json.loads(seen["schema"])).fields
        if missing := set(changes) - {f.name for f in fields}:
            raise LanternError("E2", f"unknown column {', '.join(sorted(missing))}")
        new = ", ".join(f"CAST(({changes[f.name]}) AS {f.dataType.simpleString()}) AS `__new_{f.name}`" for f in fields if f.name in changes)
        differs = F.lit(False)
        for c in changes:
            differs = differs | ~F.col(f"`{c}`").eqNullSafe(F.col(f"`__new_{c}`"))
        after = [(F.when(F.col("__hit"), F.col(f"`__new_{f.name}`")).otherwise(F.col(f"`{f.name}`")) if f.name in changes else F.col(f"`{f.name}`")).alias(f.name) for f in fields]
        marked = lambda rows: self._planned(f"SELECT *, {new} FROM {rows}", args).withColumn("__hit", F.col("__hit") & differs)
        return self._rewritten(table, alias[2] if alias else None, where, seen, marked, lambda df: df.select(*after, "__hit"), "__hit")

    def _delete(self, sql: str, args: dict) -> int:
        head, rest, where = split_at(sql, "FROM", "WHERE")
        if not where:
            raise LanternError("E3")
        table = self._target(rest)
        alias = re.match(rf"\s*{_NAME}(?:\s+(?:AS\s+)?(\w+))?", rest, re.I)[2]
        seen = self._matching(table, where, args)
        marked = lambda rows: self._planned(f"SELECT * FROM {rows}", args)
        return self._rewritten(table, alias, where, seen, marked, lambda df: df.filter("not __hit").drop("__hit", PART), None)

    def _matching(self, table: str, where: str, args: dict) -> dict:
        """The table as this statement sees it; E3 for a condition that holds for every row."""
        if guard.always(self.spark, where, args):
            raise LanternError("E3")
        self._refresh()
        return self.store.table(table, self._seen)

    def _rewritten(self, table: str, alias: str | None, where: str, seen: dict, marked, after, counted: str | None) -> int:
        """Writes the parts that have hits anew, in one pass over them alone; returns how many rows that changed. marked:
        from SQL of rows with the part they are in and whether the condition holds; after: what is written of them."""
        name, view = alias or table, f"__rows_{table}"
        rows = f"(SELECT {name}.*, coalesce(({where}), false) AS `__hit` FROM `{view}` AS {name}) AS {name}"
        try:
            self.store.rows(seen, marked=True).createOrReplaceTempView(view)
            hit = {r[0] for r in marked(rows).filter("__hit").select(PART).distinct().collect()}
            old = [p for p in seen["parts"] if p["path"].rpartition("/")[2] in hit]
            if not old:
                return 0
            self.store.rows(seen, old, marked=True).createOrReplaceTempView(view)
            return self.store.replace(table, seen, old, after(marked(rows)), counted)
        except PySparkException as e:
            raise _spark_error(e) from e
        finally:
            self.spark.catalog.dropTempView(view)

    # definitions

    def _create(self, sql: str) -> tuple[None, int, None]:
        if m := _INDEX.match(sql):
            columns = []
            for c in commas(m[4]):
                name, *way = c.split()
                columns.append((name.strip('`"'), -1 if way and way[0].upper() == "DESC" else 1))
            self.store.create_index(m[2], m[3], columns, bool(m[1]))
            return None, 0, None
        if m := _AS.match(sql):
            if m[2].upper() == "VIEW":
                self._query(m[4], {})
                self.store.create_view(m[3], m[4], bool(m[1]))
            elif not self.store.manifest()["tables"].get(m[3]):
                self.store.insert(m[3], self._shaped(m[4], {}))
            return None, 0, None
        m = _TABLE.match(sql)
        if not m:
            raise LanternError("E2" if re.match(r"\s*CREATE\s+(OR\s+REPLACE\s+)?(TEMP\w*\s+)?VIEW|\s*CREATE\s+TABLE", sql, re.I) else "E5", "STATEMENT")
        fields = []
        for part in commas(m[2] or ""):
            if not part or re.match(r"(PRIMARY|UNIQUE|CONSTRAINT|FOREIGN|CHECK|INDEX|KEY)\b", part, re.I):
                continue
            c = re.match(rf"{_NAME}\s+(\w+)\s*(\([\d\s,]+\))?", part)
            if not c:
                raise LanternError("E5", part)
            kind = _TYPES.get(c[2].upper(), c[2].upper())
            fields.append(T.StructField(c[1], T._parse_datatype_string(kind + (c[3] or "" if kind == "DECIMAL" else ""))))
        self.store.create(m[1], T.StructType(fields))
        return None, 0, None

    def _drop(self, sql: str) -> tuple[None, int, None]:
        if m := _DROP_INDEX.match(sql):
            self.store.drop_index(m[1])
        elif m := _DROP_VIEW.match(sql):
            self.store.drop_view(m[1])
        elif m := _DROP.match(sql):
            self.store.drop(m[1])
        else:
            raise LanternError("E2", "STATEMENT")
        return None, 0, None


def connect(path: str, database: str = "default", **options) -> Connection:
    """path: a folder that the session's cluster can reach. options: spark, profile ("extended" or "strict"), implicit_ids."""
    return Connection(path, database, **options)
