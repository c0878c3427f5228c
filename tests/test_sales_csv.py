import csv
import io
import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from dwellmart.schemas import HEADERS
from dwellmart.session import session_conf
from dwellmart.sources.sales_csv import PARSERS, PLAIN, every_record_on_one_line, scan_sales_csv, write_sales_csv
from dwellmart.sources.surrogate import raw_sales
from tests.comparison import spark_bag


@pytest.fixture
def folder(tmp_path):
    """These tests write bytes themselves, so they need a folder of this machine."""
    return str(tmp_path / "csv")


HEADER = ",".join(f'"{h}"' for h in HEADERS)


def cell_line(address, price="€1,000.00"):
    return f'01/02/2020,{address},Dublin,,"{price}",No,No,House,'


def put(folder, name, lines, ending="\r\n"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as file:
        file.write(ending.join([*lines, ""]).encode("cp1252"))
    return f"{folder}/{name}"


def addresses(frame):
    return sorted(r["Address"] for r in frame.collect())


@pytest.mark.parametrize("split", PARSERS)
def test_cp1252_header_cells_and_empty_cells(spark, folder, split):
    path = put(folder, "a.csv", [HEADER, cell_line("1 Café – Rua"), "", cell_line("Two")])
    rows = scan_sales_csv(spark, path, split).orderBy("Address").collect()
    assert [r["Address"] for r in rows] == ["1 Café – Rua", "Two"]
    assert rows[0]["Price (€)"] == "€1,000.00"
    assert rows[0]["Eircode"] == "" and rows[0]["Property Size Description"] == ""


@pytest.mark.parametrize("split", PARSERS)
def test_doubled_quotes_and_commas_in_cells(spark, folder, split):
    path = put(folder, "a.csv", [HEADER, cell_line('"The ""Old"" House, Main St"')])
    assert every_record_on_one_line(spark, path)
    assert addresses(scan_sales_csv(spark, path, split)) == ['The "Old" House, Main St']


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_line_breaks_in_cells_are_found_and_kept(spark, folder, ending):
    path = put(folder, "a.csv", [HEADER, cell_line(f'"Flat 1{ending}Main St"'), cell_line("Two")], ending)
    assert not every_record_on_one_line(spark, path)
    assert addresses(scan_sales_csv(spark, path)) == [f"Flat 1{ending}Main St", "Two"]


def test_line_break_next_to_well_formed_quotes_is_found(spark, folder):
    path = put(folder, "a.csv", [HEADER, cell_line('"He said ""x"",'), 'then left"', cell_line('"fine, here"')])
    assert not every_record_on_one_line(spark, path)


def test_short_and_long_rows(spark, folder):
    path = put(folder, "a.csv", [HEADER, "01/02/2020,Short", cell_line("Long") + ",extra,more"])
    rows = {r["Address"]: r for r in scan_sales_csv(spark, path).collect()}
    assert set(rows) == {"Short", "Long"}
    assert rows["Long"]["Description of Property"] == "House"


def test_columns_go_by_header_name(spark, folder):
    path = put(folder, "a.csv", ["County,Other,Address", "Dublin,x,Here"])
    row = scan_sales_csv(spark, path).first()
    assert (row["County"], row["Address"], row["Eircode"]) == ("Dublin", "Here", None)
    assert list(row.asDict()) == list(HEADERS)


def test_files_with_different_headers_are_not_mixed(spark, folder):
    put(folder, "a.csv", ["County,Address", "Dublin,Here"])
    put(folder, "b.csv", ["Address,County", "There,Cork"])
    with pytest.raises(Exception, match="(?i)header"):
        scan_sales_csv(spark, folder).collect()
    with pytest.raises(Exception, match="(?i)header"):
        scan_sales_csv(spark, folder, "records").collect()


def by_python(data):
    reader = csv.DictReader(io.StringIO(data.decode("cp1252"), newline=""))
    return Counter(tuple(row.get(h) for h in HEADERS) for row in reader)


ROW = "a,b,c,d,e,f,g,h,i"
FILES = [
    [HEADER, ROW, "   "], [HEADER, ROW, "\t", ""], [HEADER, ROW + "\r" + ROW], [HEADER, ROW, "short,row", ROW + ",extra"],
    [HEADER, '"in\r\n""cell""","x\ny"tail,5" pipe', ROW], [HEADER, ROW, ROW],
]


@pytest.mark.parametrize("parser", PARSERS)
@pytest.mark.parametrize("block", ["128m", "64"])
def test_rows_are_those_of_a_character_wise_reader(spark, folder, parser, block):
    want = Counter()
    for i, lines in enumerate(FILES):
        with open(put(folder, f"{i} é.csv", lines, "\n" if i % 2 else "\r\n"), "rb") as file:
            want += by_python(file.read())
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "1"}):
        assert Counter(map(tuple, scan_sales_csv(spark, folder, parser).collect())) == want


def test_a_file_with_line_breaks_in_cells_is_read_by_several_tasks(spark, folder):
    path = put(folder, "a.csv", [HEADER, *(cell_line(f'"{n}\nMain St"') for n in range(3000))], "\n")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "16k"}):
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 3
        assert addresses(scan_sales_csv(spark, path)) == sorted(f"{n}\nMain St" for n in range(3000))


def test_missing_file_fails(spark, folder):
    with pytest.raises(AnalysisException) as missing:
        scan_sales_csv(spark, f"{folder}/absent.csv")
    assert missing.value.getCondition() == "PATH_NOT_FOUND"


def test_every_cp1252_character_survives(spark, folder):
    defined = [bytes([b]).decode("cp1252") for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    path = put(folder, "a.csv", [HEADER, cell_line("".join(defined))])
    assert addresses(scan_sales_csv(spark, path)) == ["".join(defined)]


def test_written_files_read_back(spark, folder, sf_dir):
    raw = raw_sales(spark, sf_dir).na.fill("")
    write_sales_csv(raw, folder)
    assert spark_bag(scan_sales_csv(spark, folder)) == spark_bag(raw)


def test_one_line_files_are_split_between_tasks(spark, folder):
    path = put(folder, "a.csv", [HEADER, *(cell_line(f"{n} Main St") for n in range(20000))])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        scan = scan_sales_csv(spark, path)
        assert scan.rdd.getNumPartitions() > 3
        assert scan.count() == 20000
        assert scan.distinct().count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


PLAIN_FILES = [
    [HEADER, ROW, "", '"quoted","with ""marks""",,"a,b",,,,,"é – €"'], [HEADER, ROW, ROW], [HEADER], [HEADER, ",,,,,,,,", ROW.upper()],
]


def test_one_pass_over_plain_files_gives_the_rows_of_the_others(spark, folder):
    want = Counter()
    for i, lines in enumerate(PLAIN_FILES):
        with open(put(folder, f"{i} é.csv", lines, "\n" if i % 2 else "\r\n"), "rb") as file:
            want += by_python(file.read())
    for parser in (PLAIN, *PARSERS):
        assert Counter(map(tuple, scan_sales_csv(spark, folder, parser).collect())) == want
    plan = scan_sales_csv(spark, folder, PLAIN)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan text") == 1


@pytest.mark.parametrize("lines", [FILES[i] for i in (0, 1, 2, 3, 4)])
def test_one_pass_fails_on_files_that_are_not_plain(spark, folder, lines):
    path = put(folder, "a.csv", lines)
    with pytest.raises(Exception, match="not a plain line"):
        scan_sales_csv(spark, path, PLAIN).collect()


def test_an_unknown_parser_is_named(spark, folder):
    with pytest.raises(ValueError, match="plain"):
        scan_sales_csv(spark, folder, "other")
