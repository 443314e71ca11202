import pytest
from tillroll import schemas
from tillroll.operators import cleaning, profiling
from tillroll.sources import invoice_csv

HEADER = ",".join(schemas.RAW_COLUMNS)

EDGE = (
    HEADER + "\n"
    '489434,85048,"A, ""B""",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n'
    "489435,22350,NA,12,2009-12-01 7:46:00,2.55,,United Kingdom\n"
    "489436,22349,short,12\n"
    "489437,22195,long,24,2009-12-01 09:06:00,1.65,13078.0,UK,EXTRA\n"
    "489438,48173C, DOOR MAT ,x10,2009-12-01 09:08:00,5.95,15362.0,EIRE\n"
    '489439,1,"multi\nline",1,bad,1.0,1.0,EIRE\n'
    "C489440,22349,return,-1,2009-12-01 09:10:00,3.75,15362.0,EIRE\n"
)


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def by_invoice(df):
    return {row.Invoice: row for row in df.collect()}


@pytest.mark.parametrize("multi_line", [None, True])
def test_edge_file(spark, tmp_path, multi_line):
    path = put(tmp_path, "lines.csv", EDGE)
    rows = by_invoice(invoice_csv.read_lines(spark, path, multi_line))
    assert set(rows) == {"489434", "489435", "489436", "489438", "489439", "C489440"}
    assert rows["489434"].Description == 'A, "B"'
    assert rows["489435"].Description == "NA"
    assert rows["489435"]["Customer ID"] is None
    assert rows["489436"].Quantity == "12"
    assert rows["489436"].InvoiceDate is None and rows["489436"].Country is None
    assert rows["489438"].Description == " DOOR MAT "
    assert rows["489439"].Description == "multi\nline"


def test_edge_file_cleaned(spark, tmp_path):
    raw = invoice_csv.read_lines(spark, put(tmp_path, "lines.csv", EDGE))
    typed = by_invoice(cleaning.fix_types(raw))
    assert str(typed["489435"].InvoiceDate) == "2009-12-01 07:46:00"
    assert typed["489439"].InvoiceDate is None
    assert typed["489438"].Quantity is None
    assert set(by_invoice(cleaning.clean(raw))) == {"489434", "489435"}


def test_only_files_that_need_it_use_the_multi_line_reader(spark, tmp_path):
    put(tmp_path, "plain.csv", HEADER + "\n1,A,x,1,2010-01-01 8:00:00,1.0,1.0,UK\n")
    path = put(tmp_path, "broken.csv", HEADER + '\n2,B,"x\ny",1,,1.0,1.0,UK\n')
    files = invoice_csv.find_csv(spark, path)
    kinds = invoice_csv._kinds(spark, files)
    assert [f.rsplit("/", 1)[1] for f in files] == ["broken.csv", "plain.csv"]
    assert {k.files[0].rsplit("/", 1)[1]: k.line_breaks for k in kinds} == {
        "broken.csv": True, "plain.csv": False
    }
    rows = by_invoice(invoice_csv.read_lines(spark, path))
    assert rows["1"].Description == "x" and rows["2"].Description == "x\ny"


def test_files_with_other_column_order_are_read_by_name(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER + "\n1,A,x,1,2010-01-01 8:00:00,1.0,1.0,UK\n")
    turned = ",".join(reversed(schemas.RAW_COLUMNS))
    path = put(tmp_path, "b.csv", turned + "\nUK,1.0,2.5,2010-01-01 8:00:00,3,y,B,2\n")
    rows = by_invoice(invoice_csv.read_lines(spark, path))
    assert rows["2"].Price == "2.5" and rows["2"].Country == "UK"
    assert rows["1"].Price == "1.0"


def test_path_with_a_space_and_quoted_empty_field(spark, tmp_path):
    folder = tmp_path / "my files"
    folder.mkdir()
    put(folder, "a b.csv", HEADER + '\n1,A,"",1,2010-01-01 8:00:00,1.0,1.0,UK\n')
    rows = by_invoice(invoice_csv.read_lines(spark, str(folder / "*.csv")))
    assert rows["1"].Description is None


def test_no_file(spark, tmp_path):
    put(tmp_path, "lines.txt", EDGE)
    with pytest.raises(FileNotFoundError):
        invoice_csv.read_lines(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        invoice_csv.read_lines(spark, str(tmp_path / "nowhere"))


def test_missing_column_is_named(spark, tmp_path):
    path = put(tmp_path, "lines.csv", EDGE.replace("Country", "Land", 1))
    with pytest.raises(invoice_csv.MissingColumnsError, match="Country"):
        invoice_csv.read_lines(spark, path)


def test_header_only(spark, tmp_path):
    raw = invoice_csv.read_lines(spark, put(tmp_path, "lines.csv", HEADER + "\n"))
    shape = profiling.profile_shape(raw).first()
    assert shape.total_rows == 0 and shape.duplicate_pct is None
    assert profiling.profile_nulls(raw).first().null_pct is None
    assert profiling.profile_cancellations(raw).first().cancellation_rate is None
    quantity = profiling.profile_quantity(raw).first()
    assert quantity.negative == 0 and quantity.p99 is None and quantity["mean"] is None
    assert profiling.top_countries(raw).count() == 0
    assert [r.rows_out for r in cleaning.step_counts(cleaning.distinct_lines(raw)).collect()] == [0] * 5


LINE = "1,A,x,1,2010-01-01 8:00:00,1.0,1.0,UK"


def test_a_repeated_header_line_does_not_decide_the_columns(spark, tmp_path):
    put(tmp_path, "a.csv", HEADER + "\n" + LINE + "\n")
    turned = ",".join(reversed(schemas.RAW_COLUMNS))
    path = put(tmp_path, "b.csv", f"{turned}\n{HEADER}\nUK,1.0,2.5,2010-01-01 8:00:00,3,y,B,2\n")
    rows = by_invoice(invoice_csv.read_lines(spark, path))
    assert rows["2"].Price == "2.5" and rows["2"].StockCode == "B"


def test_even_quotes_in_a_field_that_crosses_lines(spark, tmp_path):
    text = HEADER + '\n1,S5"y,"abc\ndef",5" pipe,,1.0,1.0,UK\n' + LINE.replace("1,", "2,", 1) + "\n"
    path = put(tmp_path, "a.csv", text)
    rows = by_invoice(invoice_csv.read_lines(spark, path))
    assert set(rows) == {"1", "2"} and rows["1"].Description == "abc\ndef"


def test_an_inch_mark_leaves_a_file_splittable(spark, tmp_path):
    path = put(tmp_path, "a.csv", HEADER + '\n1,A,5" pipe,1,,1.0,1.0,UK\n')
    kinds = invoice_csv._kinds(spark, invoice_csv.find_csv(spark, path))
    assert [k.line_breaks for k in kinds] == [False]
    assert by_invoice(invoice_csv.read_lines(spark, path))["1"].Description == '5" pipe'


@pytest.mark.parametrize("multi_line", [False, True])
def test_fields_beyond_the_header(spark, tmp_path, multi_line):
    lines = [LINE.replace("1,", f"{i},", 1) + more for i, more in enumerate(["", ",", ",,junk", ",x"])]
    quoted = '9,A,"a, b",1,"2010-01-01 8:00:00",1.0,1.0,"U,K"'
    path = put(tmp_path, "a.csv", "\n".join([HEADER, *lines, quoted, "8,short,x", ""]))
    read = invoice_csv.read_lines(spark, path, multi_line)
    assert {r.Invoice for r in read.select("Invoice").collect()} == {"0", "8", "9"}
    assert read.count() == 3
    assert by_invoice(read)["9"].Description == "a, b"


def test_one_scan_for_each_header(spark, tmp_path):
    turned = ",".join(reversed(schemas.RAW_COLUMNS))
    for i in range(30):
        header = HEADER if i % 2 else turned
        path = put(tmp_path, f"f{i}.csv", f"{header}\n{LINE}\n")
    plan = invoice_csv.read_lines(spark, path)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_words_for_missing_values(spark, tmp_path):
    path = put(tmp_path, "a.csv", HEADER + "\n1,A,NA,1,null,1.0,n/a,UK\n")
    assert by_invoice(invoice_csv.read_lines(spark, path))["1"].Description == "NA"
    row = by_invoice(invoice_csv.read_lines(spark, path, missing=invoice_csv.MISSING_WORDS))["1"]
    assert row.Description is None and row.InvoiceDate is None and row["Customer ID"] is None
    assert row.Country == "UK"
