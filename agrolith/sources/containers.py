"""Files that hold tables in another wrapping: Arrow IPC, SQLite, XLSX, ZIP, encrypted parquet."""

from __future__ import annotations

import hashlib
import io
import re
import secrets
import sqlite3
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the encrypted container: magic, mode byte (0: raw key, 1: password), salt, iv, then data and tag.
MAGIC, SALT, IV, ROUNDS = b"KEP1", 16, 12, 200_000


#: Bytes of a file up to which it is read on the driver.
MOST_BYTES = 256_000_000


def content(spark: SparkSession, path: str, most: int = MOST_BYTES) -> bytes:
    """The bytes of one file, through Spark's readers, so any store that Spark can read will do. A larger file raises:
    its size is looked up before its bytes are fetched."""
    files = spark.read.format("binaryFile").load(path)
    sizes = [row[0] for row in files.select("length").limit(2).collect()]
    if len(sizes) != 1:
        raise ValueError(f"one file is needed at {path}")
    if sizes[0] > most:
        raise ValueError(f"{path} has {sizes[0]} bytes; at most {most} are read on the driver")
    return bytes(files.select("content").first()[0])


def read_arrow(spark: SparkSession, path: str) -> DataFrame:
    """IPC files or streams of any version that the Arrow library reads. The bytes stay on the executors, which decode a
    file each; the driver sees the schema of one of them alone."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def opened(data: bytes):
        return pa.ipc.open_file(pa.BufferReader(data)) if data[:6] == b"ARROW1" else pa.ipc.open_stream(pa.BufferReader(data))

    def heads(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            schemas = [opened(data.as_py()).schema.serialize().to_pybytes() for data in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(schemas, pa.binary())], ["schema"])

    head = files.limit(1).mapInArrow(heads, "schema binary").first()
    if head is None:
        raise ValueError(f"no file at {path}")
    schema = pa.ipc.read_schema(pa.BufferReader(bytes(head[0])))

    def decode(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for data in batch.column(0):
                source = opened(data.as_py())
                parts = (source.get_batch(at) for at in range(source.num_record_batches)) if hasattr(source, "num_record_batches") else source
                yield from parts

    return files.mapInArrow(decode, from_arrow_schema(schema))


def container_key(key_hex: str | None = None, password: str | None = None, salt: bytes = b"") -> bytes:
    if (key_hex is None) == (password is None):
        raise ValueError("either a key or a password is needed")
    if key_hex is not None:
        key = bytes.fromhex(key_hex)
        if len(key) != 32:
            raise ValueError("a key has 32 bytes")
        return key
    return hashlib.pbkdf2_hmac("sha256", password.encode(), salt, ROUNDS, 32)


def read_encrypted(spark: SparkSession, path: str, key_hex: str | None = None, password: str | None = None) -> DataFrame:
    """Parquet within AES-256-GCM with the magic as additional data, of at most MOST_BYTES. A wrong key or a changed byte
    raises."""
    if not path.endswith((".kep", ".parquet.enc", ".enc")):
        raise ValueError(f"not an encrypted container by its name: {path}")
    data = content(spark, path)
    head = data[: len(MAGIC) + 1 + SALT + IV]
    if len(head) < len(MAGIC) + 1 + SALT + IV:
        raise ValueError("the container is too short")
    if head[: len(MAGIC)] != MAGIC or head[4] not in (0, 1):
        raise ValueError("unknown container")
    if head[4] == (key_hex is not None):
        raise ValueError("this container takes a " + ("password" if head[4] else "key"))
    key = container_key(key_hex, password, head[5 : 5 + SALT])
    plain = cipher(spark, "decrypt", data[len(MAGIC) + 1 + SALT :], key)
    return spark.createDataFrame(pq.read_table(io.BytesIO(plain)))


def cipher(spark: SparkSession, way: str, data: bytes, key: bytes) -> bytes:
    """AES-256-GCM with the magic as additional data, data beginning with the iv, by the driver's JVM: neither key nor
    data become part of a plan or an event log."""
    jvm = spark.sparkContext._jvm
    coder = jvm.javax.crypto.Cipher.getInstance("AES/GCM/NoPadding")
    mode = jvm.javax.crypto.Cipher.DECRYPT_MODE if way == "decrypt" else jvm.javax.crypto.Cipher.ENCRYPT_MODE
    coder.init(mode, jvm.javax.crypto.spec.SecretKeySpec(bytearray(key), "AES"), jvm.javax.crypto.spec.GCMParameterSpec(128, bytearray(data[:IV])))
    coder.updateAAD(bytearray(MAGIC))
    return bytes(coder.doFinal(bytearray(data[IV:])))


def seal(spark: SparkSession, table: pa.Table, key_hex: str | None = None, password: str | None = None, salt: bytes | None = None) -> bytes:
    """The container of a table, under a random iv and, unless one is given, a random salt."""
    out, salt, iv = io.BytesIO(), secrets.token_bytes(SALT) if salt is None else salt, secrets.token_bytes(IV)
    pq.write_table(table, out)
    key = container_key(key_hex, password, salt)
    return MAGIC + bytes([password is not None]) + salt + iv + cipher(spark, "encrypt", iv + out.getvalue(), key)


class SqlitePart(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.table, self.parts = options["path"], options["table"], int(options.get("partitions", 4))

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(self.path) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return [SqlitePart(0, -1)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [SqlitePart(at, min(at + step - 1, high)) for at in range(low, high + 1, step)]

    def read(self, part: SqlitePart) -> Iterator[tuple]:
        with sqlite3.connect(self.path) as db:
            yield from db.execute(f'SELECT * FROM "{self.table}" WHERE rowid BETWEEN ? AND ?', (part.low, part.high))


class Sqlite(DataSource):
    """A table of a SQLite file, in ranges of its row ids. The file must be readable on every executor."""

    @classmethod
    def name(cls) -> str:
        return "agrolith_sqlite"

    def schema(self) -> str:
        kinds = {"INT": "bigint", "CHAR": "string", "CLOB": "string", "TEXT": "string", "BLOB": "binary", "REAL": "double", "FLOA": "double", "DOUB": "double", "NUME": "double", "DECI": "double", "BOOL": "bigint", "DATE": "string"}
        with sqlite3.connect(self.options["path"]) as db:
            columns = db.execute(f'PRAGMA table_info("{self.options["table"]}")').fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']}")
        return ", ".join(f"`{c[1]}` {next((k for mark, k in kinds.items() if mark in (c[2] or '').upper()), 'string')}" for c in columns)

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(self.options)


def read_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    spark.dataSource.register(Sqlite)
    return spark.read.format("agrolith_sqlite").option("path", path).option("table", table).load()


def column_number(letters: str) -> int:
    out = 0
    for letter in letters.upper():
        out = out * 26 + ord(letter) - 64
    return out - 1


def cell_range(text: str | None) -> tuple[int, int, int | None, int | None]:
    """`A1:C9` to (first column, first row, last column, last row), numbered from 0; parts may be left open."""
    if not text:
        return 0, 0, None, None
    first, _, last = text.partition(":")

    def cell(part: str, name: str) -> tuple[int | None, int | None]:
        match = re.fullmatch(r"([A-Za-z]*)(\d*)", part)
        if not match:
            raise ValueError(f"bad {name} of a range: {part!r}")
        return (column_number(match[1]) if match[1] else None), (int(match[2]) - 1 if match[2] else None)

    (c0, r0), (c1, r1) = cell(first, "start"), cell(last, "end")
    return c0 or 0, r0 or 0, c1, r1


LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def hyperlinks(book: zipfile.ZipFile, at: int) -> dict[str, str]:
    """Cell -> address of a sheet's hyperlinks."""
    named = f"xl/worksheets/_rels/sheet{at + 1}.xml.rels"
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read(named))} if named in book.namelist() else {}
    sheet = ElementTree.fromstring(book.read(f"xl/worksheets/sheet{at + 1}.xml"))
    return {link.get("ref"): targets[link.get(LINK)] for link in sheet.iter(f"{{{NS['m']}}}hyperlink") if link.get(LINK) in targets}


NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def sheet_rows(data: bytes, sheet: str | int = 0, cells: str | None = None, headers: bool = True) -> tuple[list[str], list[list]]:
    """Names and rows of a sheet: `#` is the row number, repeated headers get underscores, a formula is its stored
    result, an error is NaN, rich text is flattened, and a hyperlink's address follows the cell's text."""
    book = zipfile.ZipFile(io.BytesIO(data))
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    names = [s.get("name") for s in root.find("m:sheets", NS)]
    at = sheet if isinstance(sheet, int) else names.index(sheet)
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in item.iter(f"{{{NS['m']}}}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
    c0, r0, c1, r1 = cell_range(cells)
    links = hyperlinks(book, at)
    grid: dict[int, dict[int, object]] = {}
    for cell in ElementTree.fromstring(book.read(f"xl/worksheets/sheet{at + 1}.xml")).iter(f"{{{NS['m']}}}c"):
        match = re.fullmatch(r"([A-Z]+)(\d+)", cell.get("r"))
        column, row = column_number(match[1]), int(match[2]) - 1
        if column < c0 or row < r0 or (c1 is not None and column > c1) or (r1 is not None and row > r1):
            continue
        kind, value = cell.get("t"), cell.find("m:v", NS)
        if kind == "inlineStr":
            found: object = "".join(t.text or "" for t in cell.iter(f"{{{NS['m']}}}t"))
        elif kind == "e":
            found = float("nan")
        elif value is None or value.text is None:
            found = None
        elif kind == "s":
            found = shared[int(value.text)]
        elif kind == "b":
            found = value.text == "1"
        else:
            found = value.text if kind == "str" else float(value.text)
        if link := links.get(cell.get("r")):
            found = link if found is None or found == link else f"{found} {link}"
        grid.setdefault(row, {})[column] = found
    last = c1 if c1 is not None else max((c for row in grid.values() for c in row), default=c0)
    rows = sorted(grid)
    titles: list[str] = []
    if headers and rows:
        top = grid[rows.pop(0)]
        for column in range(c0, last + 1):
            title = str(top.get(column) or letters_of(column))
            while title in titles or title == "#":
                title += "_"
            titles.append(title)
    else:
        titles = [letters_of(column) for column in range(c0, last + 1)]
    return ["#", *titles], [[row + 1, *(grid[row].get(column) for column in range(c0, last + 1))] for row in rows]


def letters_of(column: int) -> str:
    out = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        out = chr(65 + rest) + out
    return out


def read_xlsx(spark: SparkSession, path: str, sheet: str | int = 0, range: str | None = None, headers: bool = True) -> DataFrame:
    """A sheet; a column whose cells are not all numbers or all booleans is text."""
    names, rows = sheet_rows(content(spark, path), sheet, range, headers)
    columns = {}
    for at, name in enumerate(names):
        values = [row[at] for row in rows]
        kinds = {type(v) for v in values if v is not None}
        columns[name] = values if len(kinds) <= 1 else [None if v is None else "NaN" if v != v else str(v) for v in values]
    return spark.createDataFrame(pa.Table.from_pydict(columns))


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, content) of all members of ZIP files, unpacked on the executors."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as opened:
                    for name in opened.namelist():
                        yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([name]), pa.array([opened.read(name)], pa.binary())], ["archive", "name", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(unpack, "archive string, name string, content binary")
