import io
import os
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from bazaar.checks.fixtures import workbook
from bazaar.session import work_folder
from bazaar.sources import files, payloads, reports
from bazaar.sources.workbooks import read_workbook_grid


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    mode = "wb" if isinstance(text, bytes) else "w"
    with open(os.path.join(folder, name), mode) as f:
        f.write(text)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_are_numbered_across_splits(spark, tmp_path, small_splits):
    want = set()
    for name, count in (("a.csv", 400), ("b.csv", 37), ("c.csv", 1)):
        lines = [f"{name}-{i}-{'x' * (i % 13)}" for i in range(count)]
        put(tmp_path, name, "\n".join(lines) + "\n")
        want |= {(name, i, line) for i, line in enumerate(lines)}
    numbered = reports.number_lines(spark, str(tmp_path))
    got = [(os.path.basename(r.path), r.row_no, r.line) for r in numbered.collect()]
    assert len(got) == len(want) and set(got) == want
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4


def test_preamble_files_of_one_type(spark, tmp_path, small_splits):
    for i in range(3):
        body = "".join(f'{i}{n},"nama, {n}"\n' for n in range(30))
        put(tmp_path, f"f{i}.csv", f"Judul\nPeriode,{i} Mei 2024 - 7 Mei 2024\nkode, nama \n{body}")
    grid = reports.read_preamble_grid(spark, str(tmp_path))
    assert reports.grid_header(grid, 2) == ["kode", "nama"]
    table = reports.grid_to_table(grid, ["kode", "nama"], 3)
    dated = reports.with_preamble_value(table, reports.preamble_value(grid, 1, 1, "period"))
    assert dated.count() == 90
    assert {(r.kode[0], r.period[0]) for r in dated.collect()} == {("0", "0"), ("1", "1"), ("2", "2")}
    assert dated.filter("nama = 'nama, 7'").count() == 3
    assert reports.grid_to_table(grid, ["kode"], 3, last_row=5).count() == 6


def test_differing_headers_are_refused(spark, tmp_path):
    put(tmp_path, "a.csv", "x,y\n1,2\n")
    put(tmp_path, "b.csv", "x,z\n1,2\n")
    with pytest.raises(ValueError):
        reports.grid_header(reports.read_preamble_grid(spark, str(tmp_path)), 0)


def test_multi_line_records_are_found_by_looking(spark, tmp_path):
    put(tmp_path / "plain", "a.csv", " id , name \n1,a\n2,\"b, c\"\n")
    put(tmp_path / "wrapped", "a.csv", 'id,name\n1,"a\nb ""q"""\n2,c\n')
    plain = reports.read_report_csv(spark, str(tmp_path / "plain"))
    assert plain.columns == ["id", "name"] and plain.count() == 2
    assert not reports._open_quotes(spark, str(tmp_path / "plain"))
    wrapped = reports.read_report_csv(spark, str(tmp_path / "wrapped"))
    assert {r.name for r in wrapped.collect()} == {'a\nb "q"', "c"}


def test_workbooks(spark, tmp_path):
    rows = [["Judul"], [], ["kode", "nama", None, "x & <y>"], [1, None, None, "z"]]
    put(tmp_path, "a.xlsx", workbook({"Satu": rows, "Dua": [["lain"]]}))
    put(tmp_path, "b.xlsx", workbook({"Satu": rows}))
    put(tmp_path, "notes.txt", "no workbook")
    every = read_workbook_grid(spark, str(tmp_path))
    assert every.filter("sheet = 'Dua'").count() == 1 and every.count() == 9
    by_name, by_index = (read_workbook_grid(spark, str(tmp_path), s) for s in ("Satu", 0))
    assert by_name.count() == by_index.count() == 8
    row = by_name.filter("row_no = 3").first()
    assert list(row.cells) == ["1", None, None, "z"]
    assert reports.grid_header(by_name, 2) == ["kode", "nama", None, "x & <y>"]


def test_workbook_cell_kinds(spark, tmp_path):
    book = workbook({"S": [["a"]]})
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            if "sheet1" not in name:
                new.writestr(name, old.read(name))
        main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        new.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>he</t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>")
        new.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet {main}><sheetData><row r="2"><c r="B2" t="s"><v>1</v></c><c r="D2"><v>1.5</v></c>'
            '<c r="AA2" t="b"><v>1</v></c></row><row r="5"><c r="A5" t="s"><v>0</v></c></row></sheetData></worksheet>',
        )
    put(tmp_path, "k.xlsx", out.getvalue())
    first, second = read_workbook_grid(spark, str(tmp_path)).orderBy("row_no").collect()
    assert first.row_no == 1 and second.row_no == 4 and list(second.cells) == ["he"]
    assert first.cells[1] == "ab" and first.cells[3] == "1.5" and first.cells[26] == "true" and first.cells[0] is None


def test_workbook_dates():
    from bazaar.sources import workbooks as W

    assert W._date_text("45139", False) == "2023-08-01"
    assert W._date_text("45139.5", False) == "2023-08-01 12:00:00"
    assert W._date_text("0.25", False) == "06:00:00" and W._date_text("1", False) == "1900-01-01"
    assert W._date_text("1e12", False) == "1e12" and W._date_text("x", False) == "x"
    assert W._date_text("43677", True) == "2023-08-01"
    out = io.BytesIO()
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    codes = ["dd/mm/yyyy", '0.0 "days"', "[Red]0", "[h]:mm", "General"]
    with zipfile.ZipFile(out, "w") as book:
        listed = "".join(f"<numFmt numFmtId='{164 + i}' formatCode='{c}'/>" for i, c in enumerate(codes))
        used = "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 164, 165, 166, 167, 168))
        book.writestr("xl/styles.xml", f"<styleSheet {main}><numFmts>{listed}</numFmts><cellXfs>{used}</cellXfs></styleSheet>")
    with zipfile.ZipFile(out) as book:
        assert W._date_styles(book) == {1, 2, 5}


def test_payload_files(spark, tmp_path):
    put(tmp_path / "d", "a.json", '{\n "k": 1\n}')
    put(tmp_path / "d", "b.json", "not json")
    docs = payloads.parse_payload(payloads.read_json_payloads(spark, str(tmp_path / "d")), "payload", "k int")
    assert {r.doc.k if r.doc else None for r in docs.collect()} == {1, None}


def test_file_metadata_segments(spark, tmp_path):
    put(tmp_path / "assets/excel/market/orders/toko_a/2024-01-01", "r.csv", "x\n")
    raw = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "assets"))
    row = files.with_file_metadata(raw, str(tmp_path)).first()
    assert row.store_folder == "toko_a" and row.file_name == "r.csv" and row.target_filepath.endswith("r.csv")
    assert row.upload_tstamp is not None


def test_seed_and_kinds(spark, tmp_path):
    put(tmp_path / "s", "seed.csv", "id,name\n1,a\n,b\n")
    assert files.load_seed(spark, str(tmp_path / "s"), "id int, name string", "id").count() == 1
    put(tmp_path / "m", "Live-1.csv", "x\n")
    put(tmp_path / "m", "Other.csv", "y\n")
    assert [r.value for r in files.read_kind(spark, str(tmp_path / "m"), "Live*").collect()] == ["x"]


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", (F.col("id") % 3).cast("string").alias("run_date")).write.partitionBy("run_date").parquet(path)
    plan = files.select_partition(spark, path, "1")
    assert plan.count() == 3
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in text


def test_work_folder_uses_the_named_shared_folder(spark):
    class Named:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": "hdfs://shared/dir/"}.get(key, default)

    assert work_folder(Named, "x").startswith("hdfs://shared/dir/bazaar/x-")
    assert work_folder(spark, "x") != work_folder(spark, "x")
    assert os.path.dirname(work_folder(spark, "x")) == os.path.dirname(work_folder(spark, "y"))


def test_one_parse_gives_header_period_and_body(spark, tmp_path, monkeypatch):
    from bazaar.sources import workbooks as W

    table = [["t"], ["kode", "Nama", "x"], ["1", "a", "p"], ["2", None, "q"], ["3", "c", "r"]]
    put(tmp_path, "a.xlsx", workbook({"Satu": table, "Meta": [["-"], ["Mei"]]}))
    put(tmp_path, "b.xlsx", workbook({"Meta": [["-"], ["Juni"]], "SATU": [["t"], ["Nama", "kode"], ["z", "9"]]}))

    def resolve(header):
        return [[header.index(h)] if h in header else [] for h in ("kode", "Nama", "x")]

    rule = W.SheetRule("Satu", 1, ("k", "n", "x"), resolve, ("Meta", 1, 0), last_row=4)
    every = W.SheetRule(0, 0, ("first",), lambda header: [[0]])
    rows = W.sheet_rows(W.workbook_files(spark, str(tmp_path)), {"one": rule, "two": every})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Scan") == 1
    one = W.rule_table(rows, "one", rule).drop("path").orderBy("k").collect()
    assert [tuple(r) for r in one] == [("Mei", "1", "a", "p"), ("Mei", "2", None, "q"), ("Juni", "9", "z", None)]
    assert W.rule_table(rows, "two", every).count() == 4 + 1
    for bad, why in ((W.SheetRule("Tiga", 0, (), resolve), "no sheet Tiga"), (W.SheetRule("Satu", 9, ("k",), resolve, data_row=0), "no header at row 9")):
        with pytest.raises(Exception, match=f"refused: it has {why}"):
            W.sheet_rows(W.workbook_files(spark, str(tmp_path)), {"r": bad}).collect()


def sheet(*rows, head="", tail="", attributes=""):
    """A sheet's text and a workbook that holds it."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    text = f'<?xml version="1.0"?><worksheet {main} {attributes}>{head}<sheetData>{"".join(rows)}</sheetData>{tail}</worksheet>'
    out = io.BytesIO(workbook({"S": []}))
    with zipfile.ZipFile(out) as book, zipfile.ZipFile(made := io.BytesIO(), "w") as new:
        for name in book.namelist():
            new.writestr(name, text if name.endswith("sheet1.xml") else book.read(name))
    return made


PLAIN = [
    '<row/><row r="3" spans="1:3"><c r="B3" s="1" t="s"><v>1</v></c><c r="D3"/></row>',
    '<row><c t="inlineStr"><is><t>a &lt;&amp;amp; b\r\nc</t></is></c><c/><c><v>1.5</v></c><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c></row>',
    '<row></row><row r="9"/><row><c t="inlineStr"/><c t="str"><v></v></c><c t="inlineStr"><is><t xml:space="preserve"> é&#10;x</t></is></c></row><row/>',
]
ODD = [
    '<row><c t="inlineStr"><is><r><t>ri</t></r><r><t>ch</t></r></is></c></row>',
    "<row><c><f>1+1</f><v>2</v></c></row>",
    "<row><!-- <row> </row> --><c><v>3</v></c></row>",
    '<row><c t="inlineStr"><is><t><![CDATA[</row><c/>]]></t></is></c></row>',
    "<row>\n <c><v>4</v></c>\n</row>",
    '<row><c t="inlineStr"><is><t>&#x41;</t></is></c></row>',
]


@pytest.mark.parametrize("rows", [PLAIN, [], [*PLAIN, ODD[0], *PLAIN], *[[PLAIN[1], odd, PLAIN[2]] for odd in ODD], PLAIN * 3000])
def test_rows_cut_from_the_text_are_those_of_the_xml_reader(rows):
    from bazaar.sources import workbooks as W

    shared = ["x", "y"]
    with zipfile.ZipFile(sheet(*rows, head="<cols><col/></cols>", tail='<pageMargins left="1"/>')) as book:
        part = "xl/worksheets/sheet1.xml"
        want = list(W._element_rows(book, part, shared, set(), False))
        assert list(W._sheet_rows(book, part, shared)) == want
        if not any(odd in rows for odd in ODD):
            assert list(W._plain_rows(book, part, shared, set(), False)) == want


def test_plain_rows_take_no_elements(monkeypatch):
    """The XML reader, which costs several times more for a cell, sees only what stands around plain rows."""
    from bazaar.sources import workbooks as W

    monkeypatch.setattr(W, "_element_rows", None)
    with zipfile.ZipFile(sheet(*PLAIN)) as book:
        assert len(list(W._sheet_rows(book, "xl/worksheets/sheet1.xml", ["x", "y"]))) == 7


@pytest.mark.parametrize("rows", [["<row><c><v>1</v></c>"], ["<row><c><v>&no;</v></c></row>"], ["<row><c><v>\x01</v></c></row>"], [*PLAIN, "</x>"]])
def test_broken_sheets_fail(rows):
    from bazaar.sources import workbooks as W

    with zipfile.ZipFile(sheet(*rows)) as book, pytest.raises(ElementTree.ParseError):
        list(W._sheet_rows(book, "xl/worksheets/sheet1.xml", ["x", "y"]))


def test_a_column_that_the_header_lacks_is_empty():
    from bazaar.sources import workbooks as W

    content = workbook({"S": [["a", "b", "c"], ["1", "2", "3"], ["4"]]})
    rule = W.SheetRule("S", 0, ("b", "x", "a"), lambda header: [[header.index(n)] if n in header else [] for n in ("b", "x", "a")])
    (found,) = W._ruled_batches("p", content, {"r": rule})
    assert found.column("values").to_pylist() == [["2", None, "1"], [None, None, "4"]]
