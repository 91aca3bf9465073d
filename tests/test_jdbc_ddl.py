"""JdbcWarehouse's driver-side statements, against a stand-in JDBC connection
(no database may be started here)."""

import re

from tablemover import JdbcWarehouse, TableName


class ResultSet:
    def __init__(self, rows):
        self.rows, self.i = rows, -1

    def next(self):
        self.i += 1
        return self.i < len(self.rows)

    def getString(self, k):
        return self.rows[self.i][k]

    getShort = getInt = getString

    def close(self):
        pass


class Meta:
    def __init__(self, db):
        self.db = db

    def getSearchStringEscape(self):
        return "\\"

    def like(self, pattern, value):
        """A metadata pattern: ``_`` and ``%`` are wildcards unless escaped."""
        parts = re.findall(r"\\.|.", pattern or "")
        return re.fullmatch("".join({"_": ".", "%": ".*"}.get(x, re.escape(x[-1])) for x in parts), value or "") is not None

    def getTables(self, cat, schema, name, types):
        return ResultSet([{} for s, n in self.db.tables if self.like(schema, s) and self.like(name, n)])

    def getPrimaryKeys(self, cat, schema, name):
        return ResultSet(self.db.keys.get((schema, name), []))

    def getColumns(self, cat, schema, name, pattern):
        return ResultSet([c for (s, n), found in self.db.columns.items() if self.like(schema, s) and self.like(name, n) for c in found])


class Statement:
    def __init__(self, db):
        self.db = db

    def execute(self, sql):
        self.db.log.append(sql)

    def executeUpdate(self, sql):
        self.db.log.append(sql)
        return 42


class Connection:
    def __init__(self, db):
        self.db = db

    def getMetaData(self):
        return Meta(self.db)

    def createStatement(self):
        return Statement(self.db)

    def setAutoCommit(self, flag):
        self.db.log.append(f"autocommit={flag}")

    def commit(self):
        self.db.log.append("commit")

    def close(self):
        self.db.log.append("close")


class FakeDb:
    def __init__(self):
        self.tables = {("DB", "TARGET_ERR_1")}
        self.keys = {("DB", "TARGET"): [{"KEY_SEQ": 2, "COLUMN_NAME": "B"}, {"KEY_SEQ": 1, "COLUMN_NAME": "A"}]}
        self.columns = {("db", "target"): [{"TYPE_NAME": "varchar", "COLUMN_NAME": "name", "COLUMN_SIZE": 10},
                                           {"TYPE_NAME": "INTEGER", "COLUMN_NAME": "n", "COLUMN_SIZE": 10}]}
        self.log = []


class Warehouse(JdbcWarehouse):
    def __init__(self, db):
        super().__init__(None, "jdbc:x://h", driver="D", user="u", password="pw")
        self.db = db

    def _connect(self):
        return Connection(self.db)


def test_exists_tries_upper_case_names():
    wh = Warehouse(FakeDb())
    assert wh.exists(TableName("target_ERR_1", "db"))
    assert not wh.exists(TableName("target_ERR_2", "db"))


def test_names_are_not_patterns():
    db = FakeDb()
    db.tables, db.columns = {("DB", "TXERR_1")}, {("db", "taxget"): [{"TYPE_NAME": "CHAR", "COLUMN_NAME": "c", "COLUMN_SIZE": 3}]}
    wh = Warehouse(db)
    assert wh.exists(TableName("TXERR_1", "DB")) and not wh.exists(TableName("T_ERR_1", "DB"))
    wh.drop(TableName("T_ERR_1", "DB"))
    assert not [x for x in db.log if x.startswith("DROP")]
    assert wh.text_limits(TableName("ta_get", "db")) == {} and wh.text_limits(TableName("taxget", "db")) == {"c": 3}


def test_drop_only_what_exists():
    db = FakeDb()
    wh = Warehouse(db)
    wh.drop(TableName("target_ERR_2", "db"))
    wh.drop(TableName("target_ERR_1", "db"))
    assert [s for s in db.log if s.startswith("DROP")] == ["DROP TABLE db.target_ERR_1"]


def test_delete_all_counts_and_commits():
    db = FakeDb()
    assert Warehouse(db).delete_all(TableName("target", "db")) == 42
    assert db.log[:3] == ["autocommit=False", "DELETE FROM db.target", "commit"] and db.log[-1] == "close"


def test_primary_key_in_key_order():
    assert Warehouse(FakeDb()).primary_key(TableName("target", "db")) == ("A", "B")
    assert Warehouse(FakeDb()).primary_key(TableName("other", "db")) == ()


def test_text_limits_from_column_metadata():
    assert Warehouse(FakeDb()).text_limits(TableName("target", "db")) == {"name": 10}
