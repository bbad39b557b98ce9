"""Tables and links out of HTML, as table functions over a column of pages."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ROW = re.compile(r"<tr\b.*?</tr>", re.S | re.I)
CELL = re.compile(r"<(t[hd])\b[^>]*>(.*?)</\1>", re.S | re.I)
ANCHOR = re.compile(r'<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', re.S | re.I)
DATE = re.compile(r"\b(\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4})\b")


def plain(fragment: str) -> str:
    return " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", fragment)).split())


def table_rows(page: str, columns: list[str]) -> list[tuple]:
    """Rows of the first table whose header has all columns, by header name, so swapped columns do no harm. A leading
    <th> in the body counts as the first column. Rows with the same first column are given once."""
    places: list[int] | None = None
    out, seen = [], set()
    for row in ROW.findall(page):
        cells = [plain(text) for _, text in CELL.findall(row)]
        if places is None:
            lower = [cell.lower() for cell in cells]
            if all(any(name.lower() in cell for cell in lower) for name in columns):
                places = [next(at for at, cell in enumerate(lower) if name.lower() in cell) for name in columns]
        elif len(cells) > max(places):
            values = tuple(cells[at] for at in places)
            if values[0] not in seen:
                seen.add(values[0])
                out.append(values)
    return out


#: Fixed value: characters behind a link in which its date is looked for.
LOOK_AHEAD = 900


def link_rows(page: str, look_ahead: int = LOOK_AHEAD) -> list[tuple]:
    """(href, title, date) of links; the date is the first one within so many characters behind the link."""
    out = []
    for match in ANCHOR.finditer(page):
        date = DATE.search(page, match.end(), match.end() + look_ahead)
        out.append((entities.unescape(match[1]), plain(match[2]), date[1] if date else None))
    return out


def exploded(pages: DataFrame, key: str, html: str, function, names: list[str]) -> DataFrame:
    """One row for each tuple that a function finds in a page; key is a number."""
    schema = f"{key} bigint, " + ", ".join(f"`{n}` string" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for own, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = function(page or "")
                keys += [own] * len(found)
                rows += found
            columns = [pa.array([row[at] for row in rows], pa.string()) for at in range(len(names))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *columns], [key, *names])

    return pages.select(pages[key].cast("long"), html).mapInArrow(run, schema)
