"""Reads tables from SQL dump files (test data only): `CREATE TABLE` for the columns, `INSERT` for the rows."""

from __future__ import annotations

import re
from pathlib import Path

_VALUE = re.compile(r"\s*(?:'((?:[^'\\]|\\.|'')*)'|([^,()']+))\s*([,)])")


def _rows(text: str):
    at = text.index("VALUES") + len("VALUES")
    while (at := text.find("(", at)) >= 0:
        at += 1
        row, end = [], ","
        while end == ",":
            m = _VALUE.match(text, at)
            quoted, plain, end = m.groups()
            row.append(re.sub(r"\\(.)", r"\1", quoted).replace("''", "'") if quoted is not None else None if plain == "NULL" else plain)
            at = m.end()
        yield row


def load_dumps(folder: str) -> dict[str, tuple[list[str], list[list[str | None]]]]:
    tables = {}
    for path in sorted(Path(folder).glob("*.sql")):
        text = path.read_text(encoding="utf-8")
        name, body = re.search(r"CREATE TABLE `(\w+)` \((.*?)\n\)", text, re.S).groups()
        columns = re.findall(r"^\s+`(\w+)`", body, re.M)
        rows = [r for line in text.splitlines() if line.startswith("INSERT INTO") for r in _rows(line)]
        tables[name] = (columns, rows)
    return tables
