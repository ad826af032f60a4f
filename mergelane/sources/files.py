"""File sources: parquet, csv, csv with layout quirks, file listings, section filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergelane.operators.lookups import lookup
from mergelane.operators.mapping import header_names


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A parquet directory, schema as it is; with `merge_schema`, the union of its files' columns."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header. Without `schema` the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


# Encoding names as people write them.
CHARSETS = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "utf8": "UTF-8", "ascii": "US-ASCII"}


# Lines whose quotes are summed up in one piece.
BLOCK_LINES = 65_536


# Different header lines that the files of one layout may have.
MAX_LAYOUTS = 10_000


def read_lines(
    spark: SparkSession, path: str, encoding: str = "UTF-8", glob: str | None = None, number_all: bool = False
) -> DataFrame:
    """full_file_path, line and line_no (from 0 in its file) of text files.

    Large files are read in blocks by many tasks, and only the lines of a file's first block have a
    number; with `number_all` all have, by a count of the lines of every block. No line is shuffled or sorted for it.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = F.decode(F.col("value").cast("binary"), CHARSETS.get(encoding.lower(), encoding))
    # Row ids grow by one from line to line of a block.
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("full_file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.regexp_replace(text, "[\\r\\x{FEFF}]", "").alias("line"),
    )
    if number_all:
        counts = raw.groupBy("full_file_path", "block").agg(F.min("row").alias("first"), F.count("*").alias("lines"))
        blocks = counts.withColumn("before", _sum_before("lines", ["full_file_path"], "block"))
        placed = lookup(raw, blocks, ["full_file_path", "block"], ["first", "before"])
        number = F.col("before") + F.col("row") - F.col("first")
        return placed.select("full_file_path", "line", number.alias("line_no"))
    first = raw.filter("block = 0").groupBy("full_file_path").agg(F.min("row").alias("first"))
    number = F.when(F.col("block") == 0, F.col("row") - F.col("first"))
    return lookup(raw, first, ["full_file_path"], ["first"]).select("full_file_path", "line", number.alias("line_no"))


def _sum_before(values: Column | str, keys: Sequence[str], order: str) -> Column:
    """The sum of `values` over the rows before this one; 0 in the first one."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(values).over(earlier), F.lit(0))


def read_csv_layout(
    spark: SparkSession,
    path: str,
    header_row: int = 0,
    sep: str = ",",
    encoding: str = "UTF-8",
    on_bad: str = "skip",
    glob: str | None = None,
    multi_line: bool = False,
    on_short: str = "fail",
) -> DataFrame:
    """CSV files whose header is line `header_row` (from 0) and may differ from file to file.

    See `parse_csv_lines` for the result. A file without a line `header_row` is an error that names it; with
    ``on_short="skip"`` it gives no rows. With `multi_line`, quoted cells may hold line breaks; large files are
    read in blocks all the same.
    """
    lines = read_lines(spark, path, encoding, glob, number_all=multi_line)
    if on_short == "fail":
        headed = _records(lines, multi_line).filter(F.col("line_no") == header_row).select("full_file_path")
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = (files.option("pathGlobFilter", glob) if glob else files).load(path)
        every = files.select(F.col("_metadata.file_path").alias("full_file_path"))
        short = [r.full_file_path for r in every.join(headed, "full_file_path", "left_anti").limit(5).collect()]
        if short:
            raise ValueError(f"no line {header_row} in {', '.join(short)}")
    return parse_csv_lines(lines, header_row, sep, on_bad, multi_line)


def _records(lines: DataFrame, multi_line: bool) -> DataFrame:
    """Lines as csv records: with `multi_line`, a line that ends inside quotes goes on in the next one.

    A line starts a record where an even number of quotes stands before it in its file. Quotes are summed up in
    blocks of BLOCK_LINES lines. As a block does not know whether it begins inside a cell, it counts the
    records that start in it for both cases; one row a block then settles the case and the number of records before it. A
    record that runs over the end of a block thus has the same number on either side. A quote that is never closed makes the
    rest of its file one record.
    """
    if not multi_line:
        return lines
    place = ["full_file_path", "__block"]
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    split = lines.withColumns({"__block": F.floor(F.col("line_no") / BLOCK_LINES), "__quotes": quotes})
    split = split.withColumn("__odd", _sum_before("__quotes", place, "line_no") % 2)
    upto = Window.partitionBy(*place).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cases = {f"__starts{odd}": F.sum((F.col("__odd") == odd).cast("long")).over(upto) for odd in (0, 1)}
    split = split.withColumns(cases)
    blocks = split.groupBy(*place).agg(F.sum("__quotes").alias("__quotes"), *[F.max(c).alias(c) for c in cases])
    blocks = blocks.withColumn("__inside", _sum_before("__quotes", ["full_file_path"], "__block") % 2)
    blocks = blocks.withColumn("__starts", F.when(F.col("__inside") == 0, F.col("__starts0")).otherwise(F.col("__starts1")))
    blocks = blocks.withColumn("__before", _sum_before("__starts", ["full_file_path"], "__block"))
    known = lookup(split, blocks, place, ["__inside", "__before"])
    started = F.when(F.col("__inside") == 0, F.col("__starts0")).otherwise(F.col("__starts1"))
    numbered = known.withColumn("__record", F.col("__before") + started - 1)
    parts = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    return numbered.groupBy("full_file_path", F.col("__record").alias("line_no")).agg(
        F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line")
    )


def parse_csv_lines(
    lines: DataFrame, header_row: int = 0, sep: str = ",", on_bad: str = "skip", multi_line: bool = False
) -> DataFrame:
    """Numbered lines of csv files (full_file_path, line, line_no) to one table.

    The header of a file is its line `header_row`; lines before it are left out, as are files without it. Lines far behind
    the header need no number, unless `multi_line` joins lines inside quotes. The result has the union
    of all normalised header names as text columns, null where a file lacks the column, plus
    ``full_file_path``. Blank lines are skipped. A line with more filled cells than its header is
    skipped, or with ``on_bad="fail"`` fails the job; a shorter line ends in nulls.

    One small job reads the distinct header lines, at most MAX_LAYOUTS, which become the column names.
    """
    if on_bad not in ("skip", "fail"):
        raise ValueError(f"on_bad is 'skip' or 'fail', not {on_bad!r}")
    spark = lines.sparkSession
    lines = _records(lines, multi_line)
    header_lines = lines.filter(F.col("line_no") == header_row).select("full_file_path", "line")
    layouts = [r.line for r in header_lines.select("line").distinct().limit(MAX_LAYOUTS + 1).collect()]
    if not layouts:
        raise ValueError(f"no file has a line {header_row}")
    if len(layouts) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different lines {header_row}: is that the header?")
    # A quote inside a quoted cell is doubled.
    options = {"sep": sep, "mode": "PERMISSIVE", "escape": '"', **({"multiLine": "true"} if multi_line else {})}

    def cells(line: Column, width: int) -> Column:
        parsed = F.from_csv(line, ", ".join(f"c{i} string" for i in range(width)), options)
        return F.array(*[parsed[f"c{i}"] for i in range(width)])

    # Header cells are parsed by the same csv parser as the data; a quoted separator only leaves
    # empty cells at the end, which are cut off.
    widest = max(line.count(sep) + 1 for line in layouts)
    parsed = spark.createDataFrame([(x,) for x in layouts], "line string").select(
        "line", cells(F.col("line"), widest).alias("cells")
    )
    names = {r.line: _trimmed_header(r.line, r.cells, sep) for r in parsed.collect()}
    known = list(dict.fromkeys(n for header in names.values() for n in header))

    layout = spark.createDataFrame(list(names.items()), "header string, names array<string>")
    by_file = header_lines.withColumnRenamed("line", "header").join(layout, "header").drop("header")
    data = lines.filter(
        (F.coalesce(F.col("line_no"), F.lit(header_row + 1)) > header_row) & (F.trim("line") != "")
    )
    data = lookup(data, by_file, ["full_file_path"], ["names"]).filter(F.col("names").isNotNull())
    # One cell more than the widest header shows up lines that are too long.
    data = data.withColumn("cells", cells(F.col("line"), widest + 1))
    overflow = F.exists(
        F.slice(F.col("cells"), F.size("names") + 1, widest + 1), lambda c: c.isNotNull()
    )
    if on_bad == "skip":
        data = data.filter(~overflow)
    else:
        problem = F.raise_error(F.concat(F.lit("more cells than the header in "), F.col("full_file_path")))
        data = data.withColumn("cells", F.when(overflow, problem.cast("array<string>")).otherwise(F.col("cells")))

    def column(name: str) -> Column:
        # Where a name stands differs per layout; the position is 0 (so null) where it is missing.
        at = F.array_position(F.col("names"), name)
        return F.when(at > 0, F.get(F.col("cells"), (at - 1).cast("int"))).alias(name)

    return data.select(*[column(n) for n in known], "full_file_path")


def _trimmed_header(line: str, cells: Sequence[str | None], sep: str) -> list[str]:
    width = line.count(sep) + 1
    if '"' in line:
        width = max((i + 1 for i, c in enumerate(cells) if c is not None), default=0)
    return header_names(cells[:width])


def list_files(
    spark: SparkSession, root: str, glob: str = "*", skip_folders: Sequence[str] = ()
) -> DataFrame:
    """Path, length and modification time of all files under `root` whose name matches `glob`.

    Files below a folder whose name contains one of `skip_folders`, in any case, are left out.
    File contents are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    return files.filter(~in_folder(F.col("path"), skip_folders, root))


def in_folder(path: Column, folders: Sequence[str], root: str = "") -> Column:
    """Whether a folder of `path` (below `root`, without the file name) contains one of `folders`."""
    below = F.substring_index(F.lower(path), root.lower().rstrip("/"), -1) if root else F.lower(path)
    parents = F.left(below, F.length(below) - F.length(F.substring_index(below, "/", -1)))
    hit = F.lit(False)
    for name in folders:
        hit = hit | parents.contains(name.lower())
    return hit


def select_sections(
    df: DataFrame, col: str, allow: str | Sequence[str] | None = None, deny: str | Sequence[str] | None = None
) -> DataFrame:
    """Rows of the allowed sections (sheets); without an allow list, all but the denied ones."""

    def listed(value: str | Sequence[str] | None) -> list[str]:
        return [value] if isinstance(value, str) else list(value or [])

    if listed(allow):
        return df.filter(F.col(col).isin(listed(allow)))
    if listed(deny):
        return df.filter(~F.coalesce(F.col(col).isin(listed(deny)), F.lit(False)))
    return df
