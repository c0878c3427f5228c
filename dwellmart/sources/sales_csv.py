"""Scan of the sales register as CSV: cp1252 text, a header row, doubled quotes, line breaks in cells.

The rows are those of a reader that goes through a file character by character: a record ends at LF, CR or
CRLF outside quotes, a quote opens a cell only as its first character, text after a closing quote belongs to
the cell, and only lines without any character are skipped. Only a quote that is never closed differs: the last line break of the file is not in its cell.
Spark's own CSV reader gives the same rows for
plain files, and takes them in splits. A file is plain if all its lines are whole records of well-formed
cells, all equally many, with something else than white space. One look at the text in parallel tells
which files are. All others are read by records, also in parallel: whether a line starts inside quotes
depends on the lines before it, but each line is a function of that one bit, and such functions can be
put together per block of a file first and then over the blocks.

Spark 4 reads a fixed list of charsets and cp1252 is not on it. ISO-8859-1 is, and it maps every byte to
the code point of the same number, so the two charsets differ only in bytes 0x80-0x9F. ``translate``
puts those right inside the scan's own projection, for cells and for the header.
"""

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from dwellmart.schemas import HEADERS

# The five bytes cp1252 leaves undefined keep their code point.
_C1_BYTES = bytes(range(0x80, 0xA0))
_CP1252_OF_LATIN1 = {
    latin1: byte.decode("cp1252")
    for byte, latin1 in ((bytes([b]), chr(b)) for b in _C1_BYTES)
    if byte.decode("cp1252", errors="ignore")
}
_LATIN1_CHARS = "".join(_CP1252_OF_LATIN1)
_CP1252_CHARS = "".join(_CP1252_OF_LATIN1.values())

_TO_CP1252 = str.maketrans(_CP1252_OF_LATIN1)
_TO_LATIN1 = str.maketrans({cp: latin1 for latin1, cp in _CP1252_OF_LATIN1.items()})

#: Parsers that read any file.
PARSERS = ("auto", "records")
#: One that reads plain files only, once, and fails on all others.
PLAIN = "plain"

# Inside of a quoted cell; a cell that is closed; any cell, which at the end of a file may be open.
_INNER = r'[^"]*+(?:""[^"]*+)*+'
_CLOSED = rf'(?:"{_INNER}"[^,\r]*+|[^",\r][^,\r]*+|)'
_CELL = rf'(?:"{_INNER}(?:"[^,\r]*+|\z)|[^",\r][^,\r]*+|)'
_PLAIN_CELL = rf'(?:"{_INNER}"|[^",\r]*+)'
_LEFT_OPEN = rf'(?:{_CLOSED}[,\r])*+"{_INNER}\z'


def _cp1252_text(cell: Column) -> Column:
    # Plain ASCII, by far the most cells, has one byte per character and needs no look at each of them.
    ascii_only = F.octet_length(cell) == F.char_length(cell)
    return F.when(ascii_only, cell).otherwise(F.translate(cell, _LATIN1_CHARS, _CP1252_CHARS))


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines as LF ends them, with their file, their block of it and their order in the block."""
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value"),
        )
    )


def _header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Names in the first header line there is, as ISO-8859-1. Reads that line only."""
    return _csv_reader(spark).csv(path).columns


def _plain_files(spark: SparkSession, path: str) -> dict[str, bool]:
    """For each file, whether it is plain: no line but empty ones and whole records of as many cells as the header.

    One match per line, which needs no character set: what it looks for is ASCII.
    """
    more = max(len(_header(spark, path)) - 1, 0)
    whole = rf"\A(?:(?=.*[^\x00-\x20]){_PLAIN_CELL}(?:,{_PLAIN_CELL}){{{more}}})?\r?\z"
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    looks = lines.groupBy("file").agg(F.bool_and(F.col("value").rlike(whole)).alias("plain"))
    return {r.file: r.plain for r in looks.collect()}


def every_record_on_one_line(spark: SparkSession, path: str) -> bool:
    """Whether all files are plain, so that Spark's own reader takes them in splits."""
    return all(_plain_files(spark, path).values())


def _flag(value: Column) -> Column:
    return value.cast("int")


def _records(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, block, line, place, cells) of every record that is not empty, in any order."""
    value = F.col("value")
    opens = _flag(value.rlike(rf"\A{_LEFT_OPEN}"))
    stays = _flag(value.rlike(rf'\A{_INNER}\z') | value.rlike(rf'\A{_INNER}"[^,\r]*+[,\r]{_LEFT_OPEN}'))
    lines = _lines(spark, files).withColumn("opens", opens).withColumn("stays", stays)
    # A line sets the bit, keeps it or turns it. After turns are counted, what was set last is all one needs.
    lines = lines.withColumn("turns", F.when((F.col("opens") == 1) & (F.col("stays") == 0), 1).otherwise(0))
    in_block = Window.partitionBy("file", "block").orderBy("line")
    upto, before = in_block.rowsBetween(Window.unboundedPreceding, 0), in_block.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("turned", F.sum("turns").over(upto))
    sets = F.when(F.col("opens") == F.col("stays"), F.col("opens").bitwiseXOR((F.col("turned") % 2).cast("int")))
    lines = lines.withColumn("set", sets)
    lines = lines.withColumn("set_before", F.last("set", True).over(before)).withColumn(
        "turned_before", F.col("turned") - F.col("turns")
    )
    blocks = lines.groupBy("file", "block").agg(
        F.max_by("set", F.when(F.col("set").isNotNull(), F.col("line"))).alias("set"), F.max("turned").alias("turned")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("turned").over(earlier), F.lit(0))
    blocks = blocks.withColumn("turned_earlier", turned)
    # What a block sets last, as if no line of the file up to there had turned it.
    after = F.col("set").bitwiseXOR((F.col("turned_earlier") % 2).cast("int"))
    blocks = blocks.withColumn("plain_set", after)
    inside = F.coalesce(F.last("plain_set", True).over(earlier), F.lit(0)).bitwiseXOR(
        (F.col("turned_earlier") % 2).cast("int")
    )
    starts = blocks.select("file", "block", inside.alias("block_inside"))
    lines = lines.join(starts, ["file", "block"])
    bit = F.coalesce("set_before", "block_inside").bitwiseXOR((F.col("turned_before") % 2).cast("int"))
    lines = lines.select("file", "block", "line", "value", F.when(bit == 0, F.col("line")).alias("begins"))
    lines = lines.withColumn("record", F.last("begins", True).over(upto))
    ends = lines.groupBy("file", "block").agg(F.max("begins").alias("last"))
    last = F.last(F.when(F.col("last").isNotNull(), F.struct("block", "last")), True).over(earlier)
    carried = ends.select("file", "block", last.alias("carried"))
    own = F.when(F.col("record").isNotNull(), F.struct(F.col("block"), F.col("record").alias("last")))
    lines = lines.join(carried, ["file", "block"]).withColumn("of", F.coalesce(own, F.col("carried")))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    whole = lines.groupBy("file", "of").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"))
    texts = F.regexp_extract_all("text", F.lit(rf"({_CELL}(?:,{_CELL})*+)(?:\r|\z)"), F.lit(1))
    records = whole.select("file", "of", F.posexplode(texts).alias("place", "record")).where("record <> ''")
    cells = F.regexp_extract_all(F.concat(F.lit(","), "record"), F.lit(rf",({_CELL})"), F.lit(1))
    return records.select(
        "file", F.col("of.block").alias("block"), F.col("of.last").alias("line"), "place", F.transform(cells, _unquoted).alias("cells")
    )


def _unquoted(cell: Column) -> Column:
    inner = F.replace(F.regexp_extract(cell, rf'\A"({_INNER})', 1), F.lit('""'), F.lit('"'))
    rest = F.regexp_extract(cell, rf'\A"{_INNER}"([^,]*+)\z', 1)
    return F.when(cell.startswith('"'), F.concat(inner, rest)).otherwise(cell)


def _by_header(names: list[str], cell) -> list[Column]:
    """The nine columns; ``cell`` gives that of a place in the header. Of equal names the last one counts."""
    places = {name.translate(_TO_CP1252): i for i, name in enumerate(names)}
    return [
        (_cp1252_text(cell(places[h])) if h in places else F.lit(None).cast("string")).alias(h) for h in HEADERS
    ]


def _scan_records(spark: SparkSession, files: list[str]) -> tuple[DataFrame, list[list[str]]]:
    """Rows of the files after their header records, and the headers there are."""
    records = _records(spark, files)
    place = F.struct("block", "line", "place")
    first = records.groupBy("file").agg(F.min_by("cells", place).alias("header"), F.min(place).alias("first"))
    headers = [r.header for r in first.select("header").distinct().collect()]
    rows = records.join(first.select("file", "first"), "file").where(place > F.col("first"))
    return rows.select(*_by_header(headers[0] if headers else [], lambda i: F.get("cells", i))), headers


def _csv_reader(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )


def _scan_splits(spark: SparkSession, files: list[str]) -> tuple[DataFrame, list[str]]:
    reader = _csv_reader(spark)
    # Without inference this reads the header line only. Declaring its columns and switching enforcement
    # off makes any other file fail when its header differs, instead of mixing columns up.
    found = reader.csv(files)
    cells = reader.schema(found.schema).option("enforceSchema", False).csv(files)
    columns = _by_header(cells.columns, lambda i: F.coalesce(cells[f"`{cells.columns[i]}`"], F.lit("")))
    return cells.select(*columns), cells.columns


def _scan_plain(spark: SparkSession, path: str) -> DataFrame:
    """Rows of plain files in one pass, which judges every line that it takes apart."""
    names = _header(spark, path)
    text = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    lines = spark.read.option("lineSep", "\n").text(path)
    first = lines.where(F.col("_metadata.file_block_start") == 0).select(text.alias("line")).first()
    header = first.line.removesuffix("\r") if first else ""
    bodies = lines.select(F.regexp_replace(text, r"\r\z", "").alias("body"), F.col("_metadata.file_path").alias("file"))
    bodies = bodies.where((F.col("body") != "") & (F.col("body") != header))
    cells = F.regexp_extract_all(F.concat(F.lit(","), "body"), F.lit(f",({_PLAIN_CELL})"), F.lit(1))
    taken = bodies.withColumn("cells", cells)
    # The cells are the whole line if nothing between them was passed over.
    plain = (F.array_join("cells", ",") == F.col("body")) & (F.size("cells") == len(names))
    plain = plain & F.col("body").rlike(r"[^\x00-\x20]")
    fails = F.raise_error(F.concat(F.lit("not a plain line: "), "body", F.lit(" in "), "file")).cast("array<string>")
    checked = taken.select(F.when(plain, F.col("cells")).otherwise(fails).alias("cells"))
    return checked.select(*_by_header(names, lambda i: _unquoted_plain(F.col("cells")[i])))


def _unquoted_plain(cell: Column) -> Column:
    inner = F.replace(F.substring(cell, F.lit(2), F.char_length(cell) - 2), F.lit('""'), F.lit('"'))
    return F.when(cell.startswith('"'), inner).otherwise(cell)


def scan_sales_csv(spark: SparkSession, path: str, parser: str = "auto") -> DataFrame:
    """Read a file or folder into the nine raw columns, by header name, all strings.

    An empty cell is an empty string; a cell that a short row lacks and a column that the header lacks are
    NULL; extra cells are left out. Files whose headers differ and a missing path fail. ``parser="auto"``
    looks at every file first and reads plain ones in splits; ``"records"`` reads all by records and saves
    the look. The rows are the same. ``"plain"`` reads the text once and takes it that all files are plain: a
    line that is not a whole record of as many cells as the header fails the query when it is run, and a line
    that repeats the header is passed over wherever it stands.
    """
    if parser == PLAIN:
        return _scan_plain(spark, path)
    if parser not in PARSERS:
        raise ValueError(f"parser must be one of {(*PARSERS, PLAIN)}")
    if parser == "auto":
        looks = _plain_files(spark, path)
    else:
        names = spark.read.option("lineSep", "\n").text(path).select("_metadata.file_path").distinct().collect()
        looks = {r.file_path: False for r in names}
    by_kind = {kind: sorted(unquote(f) for f, plain in looks.items() if plain is kind) for kind in (True, False)}
    parts, headers = [], []
    if by_kind[True]:
        rows, header = _scan_splits(spark, by_kind[True])
        parts.append(rows)
        headers.append(header)
    if by_kind[False]:
        rows, found = _scan_records(spark, by_kind[False])
        parts.append(rows)
        headers += found
    if any(header != headers[0] for header in headers):
        raise ValueError(f"files with different header rows: {headers}")
    empty = spark.createDataFrame([], ", ".join(f"`{h}` string" for h in HEADERS))
    return reduce(DataFrame.union, parts) if parts else empty


def write_sales_csv(raw: DataFrame, path: str) -> None:
    """Write raw rows as cp1252 CSV files, the form ``scan_sales_csv`` reads. Used by tests and samples."""
    (
        raw.select(
            *(
                F.translate(raw[f"`{name}`"], _CP1252_CHARS, _LATIN1_CHARS).alias(name.translate(_TO_LATIN1))
                for name in raw.columns
            )
        )
        .write.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
