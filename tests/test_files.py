"""Reading metadata files: split CSV, workbooks, and faults that stay in their file."""

import io
import os
import random
import zipfile
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.sinks.workbook import to_workbooks
from tessera.sources import xlsx
from tessera.sources.rows import metadata_rows, parsed_rows, text_rows
from tessera.sources.split_csv import split_csv_rows
from xlsx_fixture import make_xlsx


def _post(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as fh:
        fh.write(content if isinstance(content, bytes) else content.encode())
    return f"{folder}/{name}"


def _as_lists(df):
    out = {}
    for r in df.orderBy("_file_name", "_row_seq").collect():
        out.setdefault(r["_file_name"], []).append("error" if r["_error"] else r["row"])
    return {name: ["error"] if "error" in got else got for name, got in out.items()}


def _random_csv(rng, n):
    def field():
        kind = rng.random()
        text = "".join(rng.choice('ab;"\n é1') for _ in range(rng.randrange(0, 9)))
        if kind < 0.5:
            return '"' + text.replace('"', '""') + '"' + rng.choice(["", "", "", "x", 'y"'])
        if kind < 0.6:
            return "NULL"
        return 'p"q' if kind < 0.65 else text.replace(";", "").replace("\n", "").replace('"', "")
    end = rng.choice(["\n", "\r\n"])
    lines = [";".join(field() for _ in range(rng.choice([1, 3, 3, 3]))) for _ in range(n)]
    return rng.choice(["", "﻿"]) + rng.choice(["", end]) + 'k;"v\n2";w' + end + end.join(lines) + rng.choice(["", end])


@pytest.mark.parametrize("size,most_ranges", [("13", 100_000), ("64", 100_000), ("33", 1)])
def test_split_csv_equals_the_row_parser_at_any_border(spark, tmp_path, size, most_ranges):
    rng = random.Random(int(size))
    paths = [_post(str(tmp_path), f"f{i}.csv", _random_csv(rng, rng.choice([0, 3, 25]))) for i in range(6)]
    paths.append(_post(str(tmp_path), "long.csv", "k;v\n1;" + "x" * 500 + '\n2;"' + "y\n" * 40 + '"\n'))
    paths.append(_post(str(tmp_path), "wide.csv", "k;v\n1;2;;\n1;2;3\n"))
    paths.append(_post(str(tmp_path), "twice.csv", "k;k\n1;2\n"))
    paths.append(_post(str(tmp_path), "open.csv", 'k;v\n1;"never closed\n2;3'))
    paths.append(_post(str(tmp_path), "empty.csv", ""))
    want = _as_lists(text_rows(spark, paths, ";"))
    paths.append(_post(str(tmp_path), "latin.csv", "k;v\n1;é\n".encode("latin-1")))
    want["latin.csv"] = ["error"]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = _as_lists(split_csv_rows(spark, paths, ";", most_ranges))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want


def test_scan_csv_split_is_written_by_more_tasks_as_the_table_grows(spark, tmp_path, monkeypatch):
    from tessera import suite

    texts = [f'line "{i}"\n;next' + "é\n" * (i % 7) for i in range(40)] + [None, "", "NULL"]
    docs = spark.createDataFrame([(i, t, None if i % 5 else "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    docs.repartition(6, "doc_id").write.parquet(f"{tmp_path}/sf/documents.parquet")
    monkeypatch.setattr(suite, "work_path", lambda _, name: f"{tmp_path}/{name}")
    n_bytes = sum(f.stat().st_size for f in (tmp_path / "sf/documents.parquet").glob("*.parquet"))
    monkeypatch.setattr(suite, "SPLIT_CSV_BYTES", n_bytes // 3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # the files are cut inside records
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = suite.scan_csv_split(spark, f"{tmp_path}/sf").select("doc_id", "lang", "n_chars").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = sorted((int(r.doc_id), r.lang, r.n_chars) for r in got)
    assert found == [(i, None if i % 5 else "en", len(t) if t not in (None, "", "NULL") else None) for i, t in enumerate(texts)]
    assert len(list((tmp_path / "scan_csv_split").glob("*.csv"))) > 2


def _styled(cells, styles="", shared="", prologue=""):
    """A one-sheet workbook around raw cell XML."""
    buf = io.BytesIO()
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">{prologue}'
                                      '<sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{cells}</sheetData></worksheet>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {main}>{styles}</styleSheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {main}>{shared}</sst>")
    return buf.getvalue()


def _grid(data):
    return {name: list(rows) for name, rows in xlsx.worksheets(data)}


STYLES = ('<numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy;@"/><numFmt numFmtId="171" formatCode="0.0&quot;d&quot;"/>'
          '<numFmt numFmtId="172" formatCode="[h]:mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/>'
          '<xf numFmtId="171"/><xf numFmtId="20"/><xf numFmtId="172"/><xf numFmtId="22"/></cellXfs>')


def test_dates_are_text_by_their_number_format():
    cells = "<row>" + "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in (
        (0, "45292"), (1, "45292"), (2, "45292.5"), (3, "45292"), (4, "0.75"), (5, "1.5"), (6, "45292.000011574"), (1, "59"), (1, "61"), (9, "7.50"))) + "</row>"
    assert _grid(_styled(cells, STYLES)) == {"S": [[
        "45292", "2024-01-01 00:00:00", "2024-01-01 12:00:00", "45292", "18:00:00", "36:00:00", "2024-01-01 00:00:01",
        "1900-02-28 00:00:00", "1900-03-01 00:00:00", "7.5"]]}
    from_1904 = _grid(_styled('<row><c s="1"><v>0</v></c></row>', STYLES, prologue='<workbookPr date1904="1"/>'))
    assert from_1904 == {"S": [["1904-01-01 00:00:00"]]}


def test_cells_without_references_strings_and_errors():
    shared = "<si><t>one</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si>"
    cells = ('<row><c t="s"><v>1</v></c><c r="C1" t="s"><v>0</v></c><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c t="str"><v>f</v></c></row>'
             '<row/><row><c/></row><row><c r="B9"><v>1e3</v></c><c t="d"><v>2024-01-02T03:04:05</v></c></row>')
    assert _grid(_styled(cells, shared=shared)) == {"S": [["rich", None, "one", "True", None, "f"], [None, "1000", "2024-01-02 03:04:05"]]}
    with pytest.raises(xlsx.UnreadableFile, match="shared string 2 of 2"):
        _grid(_styled('<row><c t="s"><v>2</v></c></row>', shared=shared))


def test_memory_does_not_grow_with_rows():
    import tracemalloc
    peaks = []
    for n in (2_000, 40_000):
        data = _styled("".join(f'<row><c><v>{i}</v></c><c t="inlineStr"><is><t>text {i}</t></is></c></row>' for i in range(n)))
        tracemalloc.start()
        assert sum(1 for _, grid in xlsx.worksheets(data) for _ in grid) == n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] * 1.5 + 200_000


def test_workbooks_round_trip(spark):
    data = [(1, "a<b>&\"c\"", date(2024, 2, 29), datetime(2024, 2, 29, 13, 14, 15), 1.5, True),
            (2, None, None, None, None, None), (3, " x\ny ", date(1970, 1, 1), datetime(1999, 12, 31, 23, 59, 59), -0.25, False)]
    df = spark.createDataFrame(data, "id int, t string, d date, m timestamp, f double, b boolean").repartition(1).sortWithinPartitions("id")
    books = to_workbooks(df, "Sheet & Co", rows_per_book=2)
    assert books.count() == 2
    files = books.withColumn("modificationTime", F.current_timestamp())
    got = parsed_rows(files, ";").orderBy("_file_name", "_row_seq").collect()
    assert {r.tbl for r in got} == {"Sheet & Co"}
    assert [r.row for r in got] == [
        {"id": "1", "t": "a<b>&\"c\"", "d": "2024-02-29 00:00:00", "m": "2024-02-29 13:14:15", "f": "1.5", "b": "True"},
        {"id": "2", "t": None, "d": None, "m": None, "f": None, "b": None},
        {"id": "3", "t": " x\ny ", "d": "1970-01-01 00:00:00", "m": "1999-12-31 23:59:59", "f": "-0.25", "b": "False"}]


def test_a_bad_parquet_or_workbook_loses_only_itself(spark, tmp_path):
    folder = str(tmp_path / "p")
    os.makedirs(folder)
    pd.DataFrame({"id": [1, 2], "v": ["a", None]}).to_parquet(f"{folder}/whole.parquet")
    pd.DataFrame({"id": ["x"], "w": [1.5]}).to_parquet(f"{folder}/text id+.parquet")
    pd.DataFrame({"id": [3], "t": [pd.Timedelta(5, "s")]}).to_parquet(f"{folder}/odd.parquet")
    pd.DataFrame({"id": [1], "ID": [2]}).to_parquet(f"{folder}/both.parquet")
    _post(folder, "broken.parquet", "no parquet")
    data = open(f"{folder}/whole.parquet", "rb").read()
    _post(folder, "cut.parquet", data[:4] + b"\0" * 60 + data[64:])
    _post(folder, "fine.csv", "id;v\n9;z\n")
    _post(folder, "noref.xlsx", _styled("<row><c t='inlineStr'><is><t>id</t></is></c></row><row><c><v>4</v></c></row>"))
    _post(folder, "badindex.xlsx", _styled('<row><c t="s"><v>7</v></c></row>'))
    _post(folder, "badxml.xlsx", _styled("<row><c"))
    _post(folder, "sheet.xlsx", make_xlsx({"T": [["id"], ["5"]]}))
    got = metadata_rows(spark, [f"{folder}/{n}" for n in sorted(os.listdir(folder))], ["T"], ";")
    bad = {r["_file_name"] for r in got.where("_error IS NOT NULL").collect()}
    good = {(r["_file_name"], r["row"]["id"]) for r in got.join(got.where("_error IS NOT NULL").select("_file_path"), "_file_path", "left_anti").collect()}
    assert {"broken.parquet", "cut.parquet", "both.parquet", "badindex.xlsx", "badxml.xlsx"} <= bad <= {
        "broken.parquet", "cut.parquet", "both.parquet", "badindex.xlsx", "badxml.xlsx", "odd.parquet"}
    assert {("whole.parquet", "1"), ("whole.parquet", "2"), ("text id+.parquet", "x"), ("fine.csv", "9"), ("noref.xlsx", "4"), ("sheet.xlsx", "5")} <= good
