"""Workbook parsing, one event at a time.

A worksheet is never a tree: rows are yielded as their elements end, and each is
dropped afterwards. Shared strings are kept as bytes and looked up by offset, so
memory follows the distinct strings, not the rows. Cells become text as a reader
would see them: numbers without a needless ``.0``, dates and times (told by
their number format) as ISO text, booleans ``True`` / ``False``, errors missing."""

from __future__ import annotations

import io
import re
import zipfile
from array import array
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET


class UnreadableFile(ValueError):
    """Why a metadata file is rejected."""


# Number formats every workbook knows without declaring them (dates, times, elapsed times).
BUILTIN_DATES = {14, 15, 16, 17, 22, *range(27, 32), 34, 35, 36, *range(50, 55), 57, 58}
BUILTIN_TIMES = {18, 19, 20, 21, 32, 33, 45, 47, 55, 56}
BUILTIN_ELAPSED = {46}
DATE, TIME, ELAPSED = "date", "time", "elapsed"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def format_kind(code: str) -> str | None:
    """Whether a number format shows dates, times or elapsed times."""
    code = re.sub(r'"[^"]*"|\\.|_.|\*.', "", code.split(";")[0]).lower()
    if re.search(r"\[(h+|m+|s+)\]", code):
        return ELAPSED
    code = re.sub(r"\[[^\]]*\]", "", code).replace("general", "")
    if re.search(r"[yd]", code) or ("m" in code and not re.search(r"[hs]", code)):
        return DATE
    return TIME if re.search(r"[hs]", code) else None


def date_text(serial: float, kind: str, from_1904: bool) -> str:
    """The moment that a serial number stands for."""
    if kind == ELAPSED:
        seconds = round(serial * 86_400)
        return f"{'-' if seconds < 0 else ''}{abs(seconds) // 3600}:{abs(seconds) // 60 % 60:02d}:{abs(seconds) % 60:02d}"
    days, part = divmod(serial, 1)
    moment = timedelta(days=days, milliseconds=round(part * 86_400_000))
    if kind == TIME and 0 <= serial < 1:
        return str((datetime(2000, 1, 1) + moment).time())
    if from_1904:
        return str(datetime(1904, 1, 1) + moment)
    # serial 60 is a day that never was
    return str(datetime(1899, 12, 31 if serial < 60 else 30) + moment)


def number_text(raw: str) -> str:
    """A number as its shortest text; whole numbers without a fraction."""
    if re.fullmatch(r"-?\d+", raw):
        return raw
    value = float(raw)
    return str(int(value)) if value.is_integer() and abs(value) < 1e16 else repr(value)


class SharedStrings:
    """Text by number: one buffer and the offsets of its parts."""

    def __init__(self):
        self.buffer, self.ends = bytearray(), array("Q")

    def add(self, text: str) -> None:
        self.buffer += text.encode("utf-8", "surrogatepass")
        self.ends.append(len(self.buffer))

    def __getitem__(self, at: int) -> str:
        if not 0 <= at < len(self.ends):
            raise UnreadableFile(f"shared string {at} of {len(self.ends)}")
        return self.buffer[self.ends[at - 1] if at else 0: self.ends[at]].decode("utf-8", "surrogatepass")


def _text(element: ET.Element) -> str:
    """The text of a rich or plain string, without phonetic runs."""
    parts = []
    for child in element:
        name = _local(child.tag)
        if name == "t":
            parts.append(child.text or "")
        elif name == "r":
            parts += [t.text or "" for t in child if _local(t.tag) == "t"]
    return "".join(parts)


def _elements(z: zipfile.ZipFile, part: str, name: str) -> Iterator[ET.Element]:
    """The elements called ``name``, each dropped after use."""
    stack: list[ET.Element] = []
    with z.open(part) as raw:
        for event, element in ET.iterparse(raw, ("start", "end")):
            if event == "start":
                stack.append(element)
                continue
            stack.pop()
            if _local(element.tag) == name:
                yield element
                element.clear()
                if stack:
                    stack[-1].remove(element)


def _kinds(z: zipfile.ZipFile) -> list[str | None]:
    """What the number format of every cell style shows."""
    if "xl/styles.xml" not in z.namelist():
        return []
    codes, kinds = {}, []
    root = ET.fromstring(z.read("xl/styles.xml"))
    for e in root.iter():
        if _local(e.tag) == "numFmt" and e.get("numFmtId"):
            codes[int(e.get("numFmtId"))] = e.get("formatCode") or ""
    for group in root:
        if _local(group.tag) == "cellXfs":
            for xf in group:
                n = int(xf.get("numFmtId") or 0)
                kinds.append(DATE if n in BUILTIN_DATES else TIME if n in BUILTIN_TIMES else ELAPSED if n in BUILTIN_ELAPSED
                             else format_kind(codes[n]) if n in codes else None)
    return kinds


def _sheets(z: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    """``(name, part)`` of every worksheet, and whether dates count from 1904."""
    names, targets = set(z.namelist()), {}
    if "xl/_rels/workbook.xml.rels" in names:
        for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")):
            target = r.get("Target") or ""
            targets[r.get("Id")] = target.lstrip("/") if target.startswith("/") else "xl/" + target
    found, from_1904 = [], False
    for e in ET.fromstring(z.read("xl/workbook.xml")).iter():
        name = _local(e.tag)
        if name == "workbookPr":
            from_1904 = e.get("date1904") in ("1", "true")
        elif name == "sheet":
            part = next((targets.get(v) for k, v in e.attrib.items() if _local(k) == "id"), None)
            if part in names:  # chart sheets have none
                found.append((e.get("name") or "", part))
    return found, from_1904


def column_of(ref: str) -> int:
    """0 for ``A1``; cells without letters are not cells."""
    letters = re.match(r"[A-Z]+", ref)
    if letters is None:
        raise UnreadableFile(f"cell reference {ref!r}")
    n = 0
    for x in letters.group(0):
        n = n * 26 + ord(x) - 64
    return n - 1


def worksheets(data: bytes) -> Iterator[tuple[str, Iterator[list[str | None]]]]:
    """``(name, rows)`` of every worksheet; a row is a list of texts. Blank rows are
    left out. Cells and rows without a reference follow their predecessor."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        kinds = _kinds(z)
        sheets, from_1904 = _sheets(z)
        shared = SharedStrings()
        if "xl/sharedStrings.xml" in z.namelist():
            for si in _elements(z, "xl/sharedStrings.xml", "si"):
                shared.add(_text(si))

        def text(cell: ET.Element) -> str | None:
            kind, raw = cell.get("t") or "n", None
            for child in cell:
                name = _local(child.tag)
                if name == "v":
                    raw = child.text
                elif name == "is":
                    return _text(child)
            if raw is None or kind == "e":
                return None
            if kind == "s":
                return shared[int(raw)]
            if kind == "b":
                return "True" if raw.strip() in ("1", "true") else "False"
            if kind == "d":
                return str(datetime.fromisoformat(raw.strip()))
            if kind != "n":
                return raw
            style = int(cell.get("s") or 0)
            shown = kinds[style] if 0 <= style < len(kinds) else None
            return date_text(float(raw), shown, from_1904) if shown else number_text(raw.strip())

        def rows(part: str) -> Iterator[list[str | None]]:
            for row in _elements(z, part, "row"):
                values: list[str | None] = []
                for cell in row:
                    if _local(cell.tag) != "c":
                        continue
                    at = column_of(cell.get("r")) if cell.get("r") else len(values)
                    if at < len(values):
                        raise UnreadableFile(f"cell {cell.get('r')} out of order")
                    values += [None] * (at - len(values)) + [text(cell)]
                if any(v is not None for v in values):
                    yield values

        for name, part in sheets:
            yield name, rows(part)
