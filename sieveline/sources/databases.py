"""Databases by JDBC: the database's own description of a table decides what is read as text, its counts decide the parts.

A part is a predicate that the database evaluates; Spark reads one part a task. Counts by ranges of a key are grouped by the
database, so that of a table of any size only a bounded number of counts reaches the driver.
"""

from __future__ import annotations

import re
import shutil
import zipfile
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Names in java.sql.Types that Spark reads without loss.
NATIVE = ("BIT", "BOOLEAN", "TINYINT", "SMALLINT", "INTEGER", "BIGINT", "REAL", "FLOAT", "DOUBLE", "DECIMAL", "NUMERIC", "CHAR", "VARCHAR", "LONGVARCHAR", "NCHAR", "NVARCHAR", "LONGNVARCHAR", "CLOB", "NCLOB", "DATE", "TIMESTAMP", "BINARY", "VARBINARY", "LONGVARBINARY", "BLOB")
INTEGERS = ("TINYINT", "SMALLINT", "INTEGER", "BIGINT")
#: How a column of a type that Spark can't read becomes text, by the product's name; "" stands for any other product or type.
TEXT_CASTS: dict[str, dict[str, str]] = {
    "apache derby": {"XML": "XMLSERIALIZE({c} AS CLOB)", "TIME": "CAST({c} AS CHAR(8))", "": "CAST({c} AS VARCHAR(32672))"},
    "postgresql": {"": "{c}::text"}, "mysql": {"": "CAST({c} AS CHAR)"}, "oracle": {"": "TO_CHAR({c})"}, "": {"": "CAST({c} AS VARCHAR(32672))"},
}
#: Cells of counts per part: a part differs from the mean by about one cell.
CELLS = 16
#: Ranges that one query counts at most.
RANGES = 1024
#: Connections that fill an embedded database at once.
LOADERS = 8


@dataclass(frozen=True)
class Column:
    """A column as the database tells it: its name, its own type's name, the JDBC type, precision and scale."""

    name: str
    type_name: str
    jdbc: str
    precision: int
    scale: int

    @property
    def native(self) -> bool:
        """Whether Spark reads the type without loss; numbers without a declared precision, or a wider one, don't fit a decimal."""
        return self.jdbc in NATIVE and not (self.jdbc in ("DECIMAL", "NUMERIC") and not 0 < self.precision <= 38)


@dataclass(frozen=True)
class Cell:
    """Rows by a range of a column, below what ``prefix`` says of others; None is an open end."""

    prefix: str
    column: str
    low: int | None
    high: int | None
    rows: int
    null: bool = False


@dataclass
class Database:
    """A table (or a query in parentheses with an alias) of a database."""

    spark: SparkSession
    url: str
    table: str
    properties: Mapping[str, str]
    where: str | None = None
    _columns: list[Column] = field(default_factory=list)
    _said: tuple[str, str] = ("", "")

    def _describe(self) -> None:
        jvm = self.spark.sparkContext._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        given = jvm.java.util.Properties()
        for k, v in self.properties.items():
            given.setProperty(k, v)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, given)
        try:
            about = connection.getMetaData()
            self._said = about.getDatabaseProductName().lower(), (about.getIdentifierQuoteString() or "").strip()
            for name, code, type_name, precision, scale in self._catalogued(about) or self._shaped(connection):
                try:
                    kind = jvm.java.sql.JDBCType.valueOf(code).getName()
                except Exception:  # noqa: BLE001  a type of the vendor's own
                    kind = "OTHER"
                self._columns.append(Column(name, type_name, kind, precision, scale))
        finally:
            connection.close()

    def _catalogued(self, about) -> list[tuple]:
        """A table's columns by the catalogue; none of a query, which has no entry."""
        names = re.findall(r'"(?:[^"]|"")*"|[^."]+', self.table)
        if self.table.lstrip().startswith("(") or not names:
            return []
        fold = str.upper if about.storesUpperCaseIdentifiers() else str.lower if about.storesLowerCaseIdentifiers() else str
        names = [n[1:-1].replace('""', '"') if n.startswith('"') else fold(n) for n in names]
        rows = about.getColumns(None, names[-2] if len(names) > 1 else None, names[-1], None)
        found = []
        while rows.next():
            if rows.getString("TABLE_NAME") == names[-1]:  # the name is a pattern to JDBC
                found.append((rows.getInt("ORDINAL_POSITION"), rows.getString("COLUMN_NAME"), rows.getInt("DATA_TYPE"), rows.getString("TYPE_NAME"), rows.getInt("COLUMN_SIZE"), rows.getInt("DECIMAL_DIGITS")))
        return [r[1:] for r in sorted(found)]

    def _shaped(self, connection) -> list[tuple]:
        """A query's columns by its empty result."""
        shape = connection.createStatement().executeQuery(f"select * from {self.table} where 1 = 0").getMetaData()
        return [(shape.getColumnName(i), shape.getColumnType(i), shape.getColumnTypeName(i), shape.getPrecision(i), shape.getScale(i)) for i in range(1, shape.getColumnCount() + 1)]

    def columns(self) -> list[Column]:
        if not self._columns:
            self._describe()
        return self._columns

    def quoted(self, name: str) -> str:
        self.columns()
        mark = self._said[1]
        return f"{mark}{name.replace(mark, mark * 2)}{mark}" if mark else name

    def select_list(self) -> str:
        """All columns, those of types that Spark can't read as the database's own text of them."""
        columns = self.columns()
        casts = TEXT_CASTS[next((p for p in TEXT_CASTS if p and p in self._said[0]), "")]
        one = lambda c: (casts.get(c.type_name.upper()) or casts[""]).format(c=self.quoted(c.name)) + f" AS {self.quoted(c.name)}"
        return ", ".join(self.quoted(c.name) if c.native else one(c) for c in columns)

    def query(self, sql: str) -> DataFrame:
        """A query's rows, read by one task."""
        return self.spark.read.format("jdbc").options(url=self.url, dbtable=f"({sql}) q", **self.properties).load()

    def _if(self, *conditions: str) -> str:
        some = [f"({c})" for c in (self.where, *conditions) if c]
        return f" where {' and '.join(some)}" if some else ""

    def cells(self, key: str, limit: int, prefix: str = "", within: str | None = None) -> list[Cell]:
        """Disjoint cells that cover all rows, in the key's order; each holds ``limit`` rows at most.

        The database counts equal ranges of the key, and of a range that holds more its ranges in turn. A single value with more rows,
        or NULL, is cut by the column ``within``, if there is one. Rows that come while parts are read fall into the outer cells.
        """
        kinds = {c.name: c.jdbc for c in self.columns()}
        if kinds.get(key) not in INTEGERS:
            raise ValueError(f"{key} has to be an integer column of {self.table} to cut it by")
        k = self.quoted(key)
        low, high, known, every = self.query(f"select min({k}) a, max({k}) b, count({k}) n, count(*) m from {self.table}{self._if(prefix)}").first()
        found = [(int(low), int(high), known)] if known else []
        ready: list[tuple[int, int, int]] = []
        while found:
            lo, hi, n = found.pop()
            if n <= limit or lo == hi:
                ready.append((lo, hi, n))
            elif hi - lo >= 2**62:  # what the database subtracts would overflow
                middle = (lo + hi) // 2
                found += [(a, b, self.query(f"select count(*) n from {self.table}{self._if(prefix, f'{k} between {a} and {b}')}").first()[0]) for a, b in ((lo, middle), (middle + 1, hi))]
            else:
                width = -(-(hi - lo + 1) // min(hi - lo + 1, RANGES))
                ranges = self.query(f"select c, count(*) n from (select ({k} - {lo}) / {width} c from {self.table}{self._if(prefix, f'{k} between {lo} and {hi}')}) r group by c").collect()
                counts = {int(c): m for c, m in ranges}
                found += [(lo + c * width, min(hi, lo + (c + 1) * width - 1), counts.get(c, 0)) for c in range(-(-(hi - lo + 1) // width))]
        ready.sort()
        out: list[Cell] = []
        for i, (lo, hi, n) in enumerate(ready):
            first, last = i == 0, i == len(ready) - 1
            if n > limit and within:
                outer = [Cell(prefix, key, None, lo - 1, 0)] * first, [Cell(prefix, key, hi + 1, None, 0)] * last
                out += [*outer[0], *self.cells(within, limit, " and ".join(x for x in (prefix, f"{k} = {lo}") if x)), *outer[1]]
            else:
                out.append(Cell(prefix, key, None if first else lo, None if last else hi, n))
        if every - known > limit and within:
            out += self.cells(within, limit, " and ".join(x for x in (prefix, f"{k} is null") if x))
        elif every > known or not out:
            out.append(Cell(prefix, key, None, None, every - known, null=True))
        return out

    def _told(self, cells: list[Cell]) -> str:
        """One predicate of neighbouring cells; ranges that touch are one range."""
        merged: list[Cell] = []
        for c in cells:
            last = merged[-1] if merged else None
            if last and (last.prefix, last.column) == (c.prefix, c.column) and not (last.null or c.null):
                merged[-1] = Cell(c.prefix, c.column, last.low, c.high, last.rows + c.rows)
            else:
                merged.append(c)
        told = []
        for c in merged:
            k = self.quoted(c.column)
            bounds = [f"{k} is null"] if c.null else [f"{k} >= {c.low}"] * (c.low is not None) + [f"{k} <= {c.high}"] * (c.high is not None) or [f"{k} is not null"]
            told.append(" and ".join([c.prefix] * bool(c.prefix) + bounds))
        return " or ".join(f"({x})" for x in told)

    def parts(self, key: str, n: int, within: str | None = None) -> list[tuple[str, int]]:
        """(predicate, rows) of ``n`` parts at most, nearly equal in rows whatever the key's distribution."""
        total = self.query(f"select count(*) n from {self.table}{self._if()}").first()[0]
        out: list[list[Cell]] = [[]]
        rows, left = 0, total
        for cell in self.cells(key, max(1, total // (n * CELLS)), within=within):
            if len(out) < n and rows and rows + cell.rows / 2 > left / (n - len(out) + 1):
                left, rows = left - rows, 0
                out.append([])
            out[-1].append(cell)
            rows += cell.rows
        return [(self._told(part), sum(c.rows for c in part)) for part in out]

    def read(self, key: str | None = None, parts: int = 8, within: str | None = None) -> DataFrame:
        """All rows; with a key in ``parts`` parallel parts of nearly equal size. Filters on top are pushed down."""
        source = f"(select {self.select_list()} from {self.table}{self._if()}) t"
        if key is None:
            return self.spark.read.format("jdbc").options(url=self.url, dbtable=source, **self.properties).load()
        return self.spark.read.jdbc(self.url, source, predicates=[p for p, _ in self.parts(key, parts, within)], properties=dict(self.properties))


def packed_derby(spark: SparkSession, folder: str, table: str, create: Callable[[str], None]) -> str:
    """The URL of a read-only database that any process opens which sees ``folder``, with one table filled from the texts in folder/rows.

    ``create`` makes the empty table at the URL it gets. Texts are imported file by file as a stream, several files at once: since an
    import locks its table, each connection fills one of its own, and the table becomes a view of these. Pages lie uncompressed in the
    archive, so that a reader seeks to each. The folder has to be on a file system that all processes mount.
    """
    if "://" in folder and not folder.startswith("file:"):
        raise RuntimeError(f"an embedded database can't be opened in {folder}: set spark.checkpoint.dir to a folder on a shared file system")
    at = Path("/" + folder.removeprefix("file:").lstrip("/"))
    jvm, base = spark.sparkContext._jvm, f"jdbc:derby:{at}/open"
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register("org.apache.derby.jdbc.EmbeddedDriver")
    connection = jvm.java.sql.DriverManager.getConnection(f"{base};create=true")
    try:
        call = connection.createStatement()
        call.execute("call syscs_util.syscs_set_database_property('derby.storage.pageSize', '32768')")
        create(base)
        files = sorted((at / "rows").glob("part-*"))
        tables = [table]
        if (n := min(LOADERS, len(files))) > 1:
            tables = [f"{table}_{i}" for i in range(n)]
            call.execute(f'rename table "{table}" to "{tables[0]}"')
            for other in tables[1:]:
                call.execute(f'create table "{other}" as select * from "{tables[0]}" with no data')
            call.execute(f'create view "{table}" as ' + " union all ".join(f'select * from "{x}"' for x in tables))

        def fill(i: int) -> None:
            own = jvm.java.sql.DriverManager.getConnection(base)
            try:
                for file in files[i :: len(tables)]:
                    own.createStatement().execute(f"call syscs_util.syscs_import_table(null, '{tables[i]}', '{file}', ',', '\"', 'UTF-8', 0)")
            finally:
                own.close()

        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(fill, range(len(tables))))
    finally:
        connection.close()
        try:
            jvm.java.sql.DriverManager.getConnection(f"{base};shutdown=true")
        except Exception as e:  # noqa: BLE001  a shutdown is told by an exception
            if "08006" not in str(e.java_exception.getSQLState() if hasattr(e, "java_exception") else e):
                raise
    with zipfile.ZipFile(at / "packed.jar", "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
        for part in sorted((at / "open").rglob("*")):
            inner = part.relative_to(at)
            if part.is_file() and inner.parts[1] != "tmp" and not part.name.endswith(".lck"):
                archive.write(part, inner.as_posix())
    for done in ("open", "rows"):
        shutil.rmtree(at / done)
    return f"jdbc:derby:jar:({at}/packed.jar)open"
