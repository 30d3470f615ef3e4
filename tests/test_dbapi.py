"""The DB-API surface: golden cases, rejections, transactions, the async wrapper."""

import asyncio
import datetime
import decimal
import uuid

import pytest

import lantern
from lantern import LanternError, connect, connect_async
from lantern.params import bind, commas, split_at


@pytest.fixture
def db(spark, tmp_path):
    return connect(str(tmp_path / "db"), "main", spark=spark)


def run(db, sql, *params):
    return db.cursor().execute(sql, *params).fetchall()


def users(db, *rows, names="id, name"):
    cur = db.cursor()
    n = len(rows[0])
    cur.executemany(f"INSERT INTO users ({names}) VALUES ({', '.join(['%s'] * n)})", rows)
    return cur


def test_module():
    assert (lantern.apilevel, lantern.threadsafety, lantern.paramstyle) == ("2.0", 1, "pyformat")


def test_crud(db):
    assert users(db, (1, "Alice"), (2, "Bob")).rowcount == 2
    cur = db.cursor().execute("SELECT id, name FROM users WHERE id = %s", (1,))
    assert cur.rowcount == 1 and cur.description[0][0] == "id" and cur.fetchall() == [(1, "Alice")] and cur.fetchall() == []
    assert cur.execute("UPDATE users SET name = %s WHERE id < 3 OR name = 'x'", ("Bob",)).rowcount == 1  # the other has it already
    assert cur.execute("UPDATE users SET name = upper(name), id = id + 10 WHERE id = 1").rowcount == 1
    assert sorted(run(db, "SELECT * FROM users")) == [(2, "Bob"), (11, "BOB")]
    assert cur.execute("DELETE FROM users WHERE name = 'BOB'").rowcount == 1
    cur.execute("SELECT id FROM users")
    assert cur.fetchone() == (2,) and cur.fetchone() is None


def test_schema_grows_and_widens(db):
    users(db, (1, "a"))
    db.cursor().execute("INSERT INTO users (id, score) VALUES (2, 1.5)")
    db.cursor().execute("INSERT INTO users (id) VALUES (%s)", (2**40,))
    assert sorted(run(db, "SELECT id, name, CAST(score AS DOUBLE) FROM users"), key=str) == [(1, "a", None), (1 << 40, None, None), (2, None, 1.5)]
    with pytest.raises(LanternError) as e:
        db.cursor().execute("INSERT INTO users (id) VALUES ('text')")
    assert e.value.code == "E5"


def test_golden_selects(db):
    users(db, (1, "A", 5), (2, "A", 7), (3, "B", 10), (4, "B", 12), names="id, name, score")
    assert run(db, "SELECT name, SUM(score) AS total FROM users GROUP BY name HAVING total > 15 ORDER BY name") == [("B", 22)]
    assert run(db, "SELECT id FROM users ORDER BY id ASC LIMIT 2 OFFSET 1") == [(2,), (3,)]
    assert run(db, "SELECT name, COUNT(*) FROM users WHERE name LIKE '%A%' AND score BETWEEN 5 AND 6 GROUP BY name") == [("A", 1)]
    assert run(db, "SELECT id FROM users WHERE id = 1 UNION ALL SELECT id FROM users WHERE id = 3 ORDER BY id DESC") == [(3,), (1,)]
    assert run(db, "SELECT id FROM users WHERE id IN (SELECT id FROM users WHERE id >= 3) ORDER BY id") == [(3,), (4,)]
    assert run(db, "SELECT id FROM users WHERE EXISTS (SELECT 1 FROM users WHERE id = 9)") == []
    assert run(db, "SELECT id, name FROM (SELECT id, name FROM users WHERE id >= 2) AS t WHERE id < 3 ORDER BY id DESC") == [(2, "A")]
    assert run(db, "SELECT id FROM users WHERE name ILIKE 'b%' ORDER BY id") == [(3,), (4,)]
    assert run(db, "SELECT id, name, ROW_NUMBER() OVER (PARTITION BY name ORDER BY id) AS rn FROM users WHERE id < 4 ORDER BY id") == [(1, "A", 1), (2, "A", 2), (3, "B", 1)]
    cur = db.cursor().execute("SELECT name, SUM(score), COUNT(*) FROM users GROUP BY name")
    assert [d[0] for d in cur.description] == ["name", "sum_score", "count"]
    assert [d[0] for d in cur.execute("SELECT * FROM users").description] == ["id", "name", "score"]


def test_joins(db):
    users(db, (1, "Alice"), (2, "Zed"))
    db.cursor().executemany("INSERT INTO orders (id, user_id, total) VALUES (%s, %s, %s)", [(10, 1, 100)])
    db.cursor().execute("INSERT INTO addresses (id, order_id, city_id) VALUES (5, 10, 7)")
    db.cursor().execute("INSERT INTO cities (id, name) VALUES (7, 'City')")
    assert run(db, "SELECT u.id, o.total FROM users u JOIN orders o ON u.id = o.user_id WHERE o.total = 100") == [(1, 100)]
    assert run(db, "SELECT u.id, o.total FROM users u LEFT OUTER JOIN orders o ON o.user_id = u.id ORDER BY u.id") == [(1, 100), (2, None)]
    assert run(db, "SELECT u.id, c.name FROM users u JOIN orders o ON u.id = o.user_id JOIN addresses a ON o.id = a.order_id JOIN cities c ON a.city_id = c.id WHERE c.name = 'City'") == [(1, "City")]
    cur = db.cursor().execute("SELECT * FROM users u JOIN orders o ON u.id = o.user_id")
    assert [d[0] for d in cur.description] == ["id", "name", "__join1.id", "__join1.total", "__join1.user_id"] and cur.fetchall() == [(1, "Alice", 10, 100, 1)]


def test_types(db):
    now = datetime.datetime(2024, 5, 1, 12, 30)
    uid = uuid.uuid4()
    db.cursor().execute("INSERT INTO users (id, at, dec, uid, bin) VALUES (%s, %s, %s, %s, %s)", (1, now, decimal.Decimal("1.23"), uid, b"\x01\x02\x03"))
    ((at, dec, u, b),) = run(db, "SELECT at, dec, uid, bin FROM users")
    assert (dec, u, b) == ("1.23", str(uid), "AQID") and at == now
    assert run(db, "SELECT id FROM users WHERE uid = %s", (uid,)) == [(1,)]


def test_definitions(db):
    cur = db.cursor()
    cur.execute("CREATE TABLE items (id INTEGER PRIMARY KEY, name VARCHAR(50), price DECIMAL(10, 2))")
    cur.execute("CREATE TABLE items (id INT)")
    assert db.list_tables() == ["items"] and db.has_table("items") and run(db, "SELECT * FROM items") == []
    cur.execute("CREATE UNIQUE INDEX ix ON items(id DESC, name)")
    assert db.store.indexes()["ix"] == {"table": "items", "columns": [["id", -1], ["name", 1]], "unique": True}
    cur.execute("INSERT INTO items (id, name) VALUES (1, 'a')")
    with pytest.raises(LanternError):
        cur.execute("INSERT INTO items (id, name) VALUES (1, 'a')")
    assert run(db, "SELECT COUNT(*) FROM items") == [(1,)]
    cur.execute("DROP INDEX ix ON items")
    cur.execute("DROP INDEX items")  # an index of that name, never the table
    assert db.list_tables() == ["items"]
    cur.execute("DROP TABLE items")
    cur.execute("DROP TABLE items")
    assert db.list_tables() == []


def test_transactions(db, spark):
    users(db, (1, "a"))
    db.begin()
    db.cursor().execute("INSERT INTO users (id, name) VALUES (999, 'Tx')")
    assert run(db, "SELECT id FROM users WHERE id = 999") == [(999,)]
    other = connect(db.store.root.rpartition("/")[0], "main", spark=spark)
    assert run(other, "SELECT id FROM users WHERE id = 999") == []
    db.commit()
    assert run(other, "SELECT id FROM users WHERE id = 999") == [(999,)]
    db.begin()
    db.cursor().execute("DELETE FROM users WHERE id = 999")
    db.rollback()
    assert run(db, "SELECT id FROM users WHERE id = 999") == [(999,)]
    db.begin()
    db.cursor().execute("DELETE FROM users WHERE id = 1")
    other.cursor().execute("DELETE FROM users WHERE id = 1")
    with pytest.raises(LanternError):
        db.commit()


@pytest.mark.parametrize("code, sql, params", [
    ("E5", "SELCT * FROM users", None), ("E3", "DELETE FROM users", None), ("E3", "UPDATE users SET name = 'x'", None),
    ("E4", "SELECT id FROM users WHERE id = %s", ()), ("E4", "SELECT id FROM users WHERE id = %s", (1, 2)), ("E4", "SELECT id FROM users WHERE id = %(a)s", {"b": 1}),
    ("E4", "SELECT id FROM users WHERE id = %(a)s", {"a": 1, "b": 2}), ("E4", "INSERT INTO users (id, name) VALUES (1)", None),
    ("E3", "DELETE FROM users WHERE true", None), ("E3", "UPDATE users SET name = 'x' WHERE 1 = 1 OR 2 = 3", None), ("E3", "DELETE FROM users WHERE %s", (True,)),
    ("E2", "MERGE INTO users USING users AS s ON users.id = s.id WHEN MATCHED THEN DELETE", None), ("E2", "SELECT name, COUNT(*) AS c FROM users GROUP BY name HAVING score > 1", None),
    ("E2", "SELECT ROW_NUMBER() OVER (PARTITION BY name) AS r FROM users", None), ("E5", "UPDATE nothing SET a = 1 WHERE a = 2", None),
])
def test_rejections(db, code, sql, params):
    users(db, (1, "a"))
    with pytest.raises(LanternError) as e:
        db.cursor().execute(sql, params).fetchall()
    assert e.value.code == code and str(e.value).startswith(f"[ltn][{code}]")


@pytest.mark.parametrize("detail, sql", [
    ("JOIN", "SELECT u.id FROM users u FULL OUTER JOIN users o ON u.id = o.id"), ("JOIN_ON", "SELECT u.id FROM users u JOIN users o ON u.id > o.id"),
    ("UNION DISTINCT", "SELECT id FROM users UNION SELECT id FROM users"), ("STATEMENT", "SELECT id FROM users INTERSECT SELECT id FROM users"),
    ("JOIN_DEPTH", "SELECT a.id FROM users a" + "".join(f" JOIN users x{i} ON a.id = x{i}.id" for i in range(4))),
])
def test_strict_profile(spark, tmp_path, detail, sql):
    db = connect(str(tmp_path / "db"), spark=spark, profile="strict")
    users(db, (1, "a"))
    with pytest.raises(LanternError) as e:
        db.cursor().execute(sql)
    assert e.value.code == "E2" and e.value.message.endswith(f": {detail}")
    assert run(db, "SELECT id, RANK() OVER (ORDER BY id) AS r FROM users") == [(1, 1)]
    assert run(db, "SELECT a.id FROM users a JOIN users b ON a.id = b.id AND a.name = b.name") == [(1,)]


def test_closed_and_empty():
    with pytest.raises(LanternError) as e:
        connect("")
    assert e.value.code == "E1"


def test_closed_cursor(db):
    cur = db.cursor()
    cur.close()
    with pytest.raises(LanternError):
        cur.execute("SELECT 1")


def test_tokens():
    assert bind("SELECT '%s', \"%s\" -- %s\n FROM t WHERE a = %s AND b LIKE '%x%'", [1])[0].count(":_p0") == 1
    assert bind("SELECT %(a)s, %(a)s", {"a": 1}) == ("SELECT :a, :a", {"a": 1})
    assert split_at("UPDATE t SET a = (SELECT 1 WHERE 2), b = 'WHERE' WHERE c", "SET", "WHERE") == ["UPDATE t", "a = (SELECT 1 WHERE 2), b = 'WHERE'", "c"]
    assert commas("a, f(b, c), 'd,e'") == ["a", "f(b, c)", "'d,e'"]


def test_implicit_ids(spark, tmp_path):
    db = connect(str(tmp_path / "db"), spark=spark, implicit_ids=True)
    cur = db.cursor().execute("INSERT INTO t (a) VALUES (1)")
    assert run(db, "SELECT * FROM t") == [(cur.lastrowid, 1)]


def test_regexp_takes_slashes(db):
    users(db, (1, "alice"), (2, "bob"), (3, "bobby"))
    for sql, params in (("'/^bo/'", None), ("%s", ("/^bo/",)), ("'^bo'", None), ("%(p)s", {"p": "/^bo/"})):
        assert run(db, f"SELECT id FROM users WHERE name REGEXP {sql} ORDER BY id", params) == [(2,), (3,)]
    assert run(db, "SELECT id FROM users WHERE name = '/^bo/'") == []
    assert db.cursor().execute("DELETE FROM users WHERE name RLIKE '/y$/'").rowcount == 1


def test_first_values_and_names(db):
    users(db, (1, "A", 5), (1, "A", 7), (2, "B", 9), names="id, name, score")
    cur = db.cursor().execute("SELECT id, u.name, COUNT(*), COUNT(*), COUNT(DISTINCT score), COUNT(score) FROM users u GROUP BY id ORDER BY id")
    assert [d[0] for d in cur.description] == ["id", "name", "count", "count_2", "count_distinct_score", "count_score"]
    assert cur.fetchall() == [(1, "A", 2, 2, 2, 2), (2, "B", 1, 1, 1, 1)]


def test_views_and_tables_of_queries(db, spark):
    users(db, (1, "A"), (2, "B"))
    cur = db.cursor()
    cur.execute("CREATE TABLE copy AS SELECT id, name FROM users WHERE id > 1")
    cur.execute("CREATE VIEW v AS SELECT id FROM copy")
    cur.execute("INSERT INTO copy (id, name) VALUES ((SELECT max(id) + 1 FROM users), 'C')")
    other = connect(db.store.root.rpartition("/")[0], "main", spark=spark)
    assert sorted(run(other, "SELECT id FROM v")) == [(2,), (3,)] and sorted(other.list_tables()) == ["copy", "users", "v"]
    cur.execute("DROP VIEW v")
    assert db.list_tables() == ["copy", "users"] and len(run(db, "SELECT * FROM copy")) == 2


def test_no_update_is_lost(db, spark, monkeypatch):
    """Another connection commits after the statement was planned and its part written."""
    users(db, (1, "a"), (2, "b"))
    other = connect(db.store.root.rpartition("/")[0], "main", spark=spark)

    def between(sql):
        def write(*args, put=type(db.store)._write, **options):
            part = put(db.store, *args, **options)
            monkeypatch.undo()
            other.cursor().execute(sql)
            return part

        monkeypatch.setattr(db.store, "_write", write)

    between("INSERT INTO users (id, name) VALUES (3, 'c')")
    with pytest.raises(LanternError) as e:
        db.cursor().execute("UPDATE users SET name = 'x' WHERE id = 1")
    assert e.value.code == "E5" and sorted(run(db, "SELECT id, name FROM users")) == [(1, "a"), (2, "b"), (3, "c")]
    between("INSERT INTO users (id, score) VALUES (4, 9)")
    assert db.cursor().execute("INSERT INTO users (id, name) VALUES (5, 'e')").rowcount == 1
    assert sorted(run(db, "SELECT id, name, score FROM users"))[3:] == [(4, None, 9), (5, "e", None)]
    between("INSERT INTO other (id) VALUES (1)")  # another table
    assert db.cursor().execute("DELETE FROM users WHERE id < 3").rowcount == 2
    assert [r[0] for r in sorted(run(other, "SELECT id FROM users"))] == [3, 4, 5]


def test_only_parts_with_hits_are_written_anew(db):
    for i in range(4):
        users(db, (i, "n"), (i + 10, "n"))
    before = [p["path"] for p in db.store.table("users")["parts"]]
    assert db.cursor().execute("UPDATE users SET name = 'x' WHERE id = 2").rowcount == 1
    after = [p["path"] for p in db.store.table("users")["parts"]]
    assert len(set(before) & set(after)) == 3 and len(after) == 4
    assert db.cursor().execute("DELETE FROM users WHERE id = 77").rowcount == 0 and [p["path"] for p in db.store.table("users")["parts"]] == after
    rows = sorted(run(db, "SELECT id, name FROM users"))
    db.store.compact("users")
    assert len(db.store.table("users")["parts"]) == 1 and sorted(run(db, "SELECT id, name FROM users")) == rows
    assert db.store.vacuum(keep=1, age=-60) >= 4 and sorted(run(db, "SELECT id, name FROM users")) == rows
    db.cursor().execute("DELETE FROM users WHERE id > 2")
    assert sorted(run(db, "SELECT id FROM users")) == [(0,), (1,), (2,)]


def test_a_manifest_has_one_writer(db, monkeypatch):
    users(db, (1, "a"))
    store = db.store
    base = store._latest()
    assert store._publish(base, store.manifest()) and not store._publish(base, store.manifest())
    store._fs.create(store._path(f"{store.root}/x")).close()
    with pytest.raises(Exception, match="exists"):
        store._renamed(store._path(f"{store.root}/x"), store._entry(base))
    store._renamed(store._path(f"{store.root}/x"), store._entry(base + 5))
    assert store._fs.exists(store._entry(base + 5))


def test_fetching(db):
    users(db, *[(i, "n") for i in range(7)])
    cur = db.cursor().execute("SELECT id FROM users ORDER BY id")
    assert cur.fetchmany(2) == [(0,), (1,)] and cur.fetchmany() == [(2,)] and [r for r in cur] == [(3,), (4,), (5,), (6,)] and cur.fetchmany(3) == []
    with db.cursor() as cur:
        assert cur.execute("SELECT id FROM users WHERE id > 3").rowcount == 3 and len(cur.fetchall()) == 3


def test_dialect_with_a_stub_of_the_toolkit(monkeypatch):
    """The toolkit is absent here: its base class is stood in for."""
    import importlib
    import importlib.machinery
    import sys
    import types

    registered = []
    names = ["sqlalchemy", "sqlalchemy.dialects", "sqlalchemy.engine", "sqlalchemy.engine.default"]
    mods = {n: types.ModuleType(n) for n in names}
    for n, m in mods.items():
        m.__spec__ = importlib.machinery.ModuleSpec(n, None)
        monkeypatch.setitem(sys.modules, n, m)
    mods["sqlalchemy"].pool = types.SimpleNamespace(SingletonThreadPool=object)
    mods["sqlalchemy.dialects"].registry = types.SimpleNamespace(register=lambda *a: registered.append(a))
    mods["sqlalchemy.engine"].default = mods["sqlalchemy.engine.default"]
    mods["sqlalchemy.engine.default"].DefaultDialect = object
    import lantern.dialect

    try:
        cls = importlib.reload(lantern.dialect).LanternDialect
        own, calls = cls(), []
        assert own.create_connect_args(types.SimpleNamespace(database="/data/db/main", query={"profile": "strict"})) == (("/data/db", "main"), {"profile": "strict"})
        assert cls.import_dbapi().paramstyle == "pyformat" and set(registered) == {("lantern", "lantern.dialect", "LanternDialect")}
        own.do_begin(types.SimpleNamespace(begin=lambda: calls.append(1)))
        assert calls == [1] and own.has_table(types.SimpleNamespace(connection=types.SimpleNamespace(has_table=lambda n: n == "t")), "t")
    finally:
        monkeypatch.undo()
        importlib.reload(lantern.dialect)


def test_async_tasks_do_not_enter_each_others_transactions(spark, tmp_path):
    async def main():
        async with await connect_async(str(tmp_path / "db"), spark=spark) as db:
            async with await db.cursor() as cur:
                await cur.execute("CREATE TABLE t (k INT)")
            started = asyncio.Event()

            async def one():
                cur = await db.cursor()
                await db.begin()
                started.set()
                await asyncio.gather(cur.execute("INSERT INTO t (k) VALUES (1)"))  # a task of its own
                await asyncio.sleep(0.2)
                await db.rollback()

            async def two():
                await started.wait()
                await (await db.cursor()).execute("INSERT INTO t (k) VALUES (2)")

            await asyncio.gather(one(), two())
            cur = await (await db.cursor()).execute("SELECT k FROM t")
            return [r async for r in cur], cur.description[0][0], await db.has_table("t")

    assert asyncio.run(main()) == ([(2,)], "k", True)


def test_async(spark, tmp_path):
    async def main():
        db = await connect_async(str(tmp_path / "db"), spark=spark)
        cur = await db.cursor()
        await cur.executemany("INSERT INTO users (id, name) VALUES (%(i)s, %(n)s)", [{"i": 999, "n": "Async"}, {"i": 1, "n": "b"}])
        assert cur.rowcount == 2
        await db.begin()
        await cur.execute("DELETE FROM users WHERE id = 1")
        await db.commit()
        await cur.execute("SELECT id, name FROM users")
        rows = await cur.fetchall()
        tables = await db.list_tables()
        await cur.close()
        await db.close()
        return rows, tables

    assert asyncio.run(main()) == ([(999, "Async")], ["users"])
    with pytest.raises(LanternError):
        asyncio.run(connect_async(""))
