"""CSV reports, preamble files, report grids and per-file metadata cells."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.sources.records import read_records, record_cells


#: Tasks that a file's rows are dealt to where its header is joined to them.
_SPREAD = 16


def _open_quotes(spark: SparkSession, paths: list[str] | str) -> bool:
    """Whether any physical line leaves a quote open, so records span lines."""
    lines = spark.read.text(paths)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return bool(lines.filter(quotes % 2 == 1).limit(1).count())


def read_report_csv(
    spark: SparkSession, paths: list[str] | str, multi_line: bool | None = None, sep: str = ",",
    columns: list[str] | None = None,
) -> DataFrame:
    """CSV reports with a header record: all columns text, headers trimmed.

    Every file is read by its own header, so files may order their columns
    differently. With ``columns`` nothing runs while the plan is built, a column
    that a file lacks is NULL and other columns are not taken. Without them the
    first header line found names the columns, and a file with other headers
    is refused when it is read. Blank lines are no records. Line breaks inside
    quoted cells need nothing special; ``multi_line=False`` says that every line
    is a record.
    """
    grid = read_grid(spark, paths, sep, quoted=multi_line is not False, blank_lines=False)
    if columns is not None:
        return table_by_header(grid, 0, 1, columns, keep=())
    names = _safe_names(_first_cells(spark, paths, sep))
    if len(set(names)) < len(names):
        names = [f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names)]
    safe = F.transform("cells", lambda c, i: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.concat(F.lit("_c"), i)))
    headers = grid.where(F.col("row_no") == 0).select(F.col("path").alias("of"), safe.alias("headers"))
    plain = F.array(*[F.lit(n) for n in _safe_names(names)])
    again = F.transform(
        "headers", lambda h, i: F.when(F.size(F.filter("headers", lambda x: x == h)) > 1, F.concat(h, i)).otherwise(h)
    )
    differs = F.array_sort(again) != F.array_sort(plain)
    said = F.concat(F.lit("differing headers in "), "of", F.lit(": "), F.to_json("headers"))
    places = [F.array_position(again, name).alias(f"place{i}") for i, name in enumerate(names)]
    laid = headers.select("of", F.when(differs, F.raise_error(said)).otherwise(F.array(*places)).alias("places"))
    body = grid.where(F.col("row_no") > 0)
    cell = lambda i: F.get("cells", F.get("places", F.lit(i)).cast("int") - 1)
    rows = _with_headers(body, laid, F.col("path") == F.col("of"), "inner")
    return rows.select(*[cell(i).alias(name) for i, name in enumerate(names)])


def _with_headers(body: DataFrame, laid: DataFrame, same: Column, how: str) -> DataFrame:
    """Body rows with what ``laid`` says of their file; the rows of a file meet it in several places, so no task gets a file whole."""
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_SPREAD - 1).cast("bigint")))
    return body.join(laid.withColumn("of_part", part), same & (F.pmod("row_no", F.lit(_SPREAD)) == F.col("of_part")), how)


def _first_cells(spark: SparkSession, paths: list[str] | str, sep: str) -> list[str | None]:
    """Cells of the first line of the files, or none."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).where("value <> ''")
    found = lines.select(record_cells(F.ltrim("value", F.lit("\ufeff")), sep).alias("cells")).take(1)
    return list(found[0][0]) if found else []


def _safe_names(cells: list[str | None]) -> list[str]:
    return [(c or "").strip() or f"_c{i}" for i, c in enumerate(cells)]


def number_lines(spark: SparkSession, paths: list[str] | str, glob: str | None = None) -> DataFrame:
    """(path, row_no, line) for text files, lines numbered from 0 within a file. No file passes through one task."""
    return read_records(spark, paths, glob=glob, quoted=False).withColumnRenamed("record", "line")


def read_grid(
    spark: SparkSession, paths: list[str] | str, sep: str = ",", glob: str | None = None, quoted: bool = True,
    blank_lines: bool = True,
) -> DataFrame:
    """Text reports as a grid: (path, sheet, row_no, cells), with as many cells as a record has.

    Without ``blank_lines`` empty records are left out and an empty quoted cell
    is an empty text; else both are NULL cells. Records keep their numbers.
    """
    records = read_records(spark, paths, sep, glob, quoted)
    if not blank_lines:
        records = records.where("record <> ''")
    return records.select(
        "path",
        F.lit(None).cast("string").alias("sheet"),
        "row_no",
        record_cells(F.col("record"), sep, null_quoted=blank_lines).alias("cells"),
    )


def read_preamble_grid(
    spark: SparkSession, paths: list[str] | str, sep: str = ",", glob: str | None = None
) -> DataFrame:
    """Text reports as a grid: (path, sheet, row_no, cells), with as many cells as a record has.

    Quoted cells lose their quotes, doubled quotes count once and line breaks
    stay; empty cells are NULL.
    """
    return read_grid(spark, paths, sep, glob)


def grid_header(grid: DataFrame, header_row: int) -> list[str]:
    """Header texts of a grid; all files of one report type have to agree."""
    found = (
        grid.filter(F.col("row_no") == header_row)
        .select(F.transform("cells", lambda c: F.trim(c)).alias("cells"))
        .distinct()
        .take(2)
    )
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'differing'} header rows at row {header_row}")
    return list(found[0][0])


def grid_to_table(
    grid: DataFrame,
    names: list[str],
    data_row: int,
    last_row: int | None = None,
    first_col: int = 0,
    keep: tuple[str, ...] = ("path",),
) -> DataFrame:
    """Body rows and columns of a grid under the given names.

    A row filter and a projection only; ``names`` comes from ``grid_header`` or
    from a contract. Rows past ``last_row`` (exclusive) are the caller's slice.
    """
    body = grid.filter(F.col("row_no") >= data_row)
    if last_row is not None:
        body = body.filter(F.col("row_no") < last_row)
    return body.select(
        *keep,
        *[
            F.try_element_at("cells", F.lit(first_col + i + 1)).alias(name)
            for i, name in enumerate(names)
            if name
        ],
    )


def table_by_header(
    grid: DataFrame,
    header_row: int,
    data_row: int,
    columns: list[str],
    name_of: Callable[[Column], Column] | None = None,
    rank_of: Callable[[Column], Column] | None = None,
    refuse: Callable[[Column], Column] | None = None,
    keep: tuple[str, ...] = ("path",),
) -> DataFrame:
    """Body rows of a grid whose files (and sheets) each have a header row of their own.

    The headers are a table of one row a file and sheet: where each wanted
    column stands there. ``name_of`` turns the trimmed header text into a column
    name; if several headers give one name, the first cell that is not NULL by
    ``rank_of`` counts. A column that a file lacks is NULL. ``refuse`` gets the
    names of a file's headers and says why it is refused, or NULL; a sheet that
    has rows but no header is refused. Nothing runs while the plan is built.
    """
    headers = F.transform("cells", lambda c: F.coalesce(F.trim(c), F.lit("")))
    headers = F.slice(headers, 1, F.greatest(F.lit(0), F.array_max(F.transform(headers, lambda h, i: F.when(h != "", i + 1).otherwise(0)))))
    laid = grid.where(F.col("row_no") == header_row).select(F.col("path").alias("of"), F.col("sheet").alias("of_sheet"), headers.alias("headers"))
    named = F.transform(
        "headers",
        lambda h, i: F.struct(
            (name_of(h) if name_of else h).alias("name"),
            (F.coalesce(rank_of(h), F.lit(1 << 30)) if rank_of else F.lit(0)).alias("rank"),
            i.alias("place"),
        ),
    )
    laid = laid.select("of", "of_sheet", "headers", named.alias("named"))
    why = refuse(F.transform("named", lambda x: x["name"])) if refuse else F.lit(None).cast("string")
    laid = laid.withColumn("why", why)
    place = lambda c: F.transform(
        F.array_sort(F.transform(F.filter("named", lambda x: x["name"] == c), lambda x: F.struct(x["rank"], x["place"]))),
        lambda x: x["place"],
    )
    places = F.struct(*[place(c).alias(f"p{i}") for i, c in enumerate(columns)]) if columns else F.struct(F.lit(0).alias("p"))
    said = F.concat(F.lit("report "), "of", F.lit(" is refused: "), "why")
    laid = laid.select("of", "of_sheet", F.when(F.col("why").isNotNull(), F.raise_error(said)).otherwise(places).alias("places"))
    body = grid.where(F.col("row_no") >= data_row)
    same = (F.col("path") == F.col("of")) & F.col("sheet").eqNullSafe(F.col("of_sheet"))
    lost = F.concat(F.lit("report "), "path", F.lit(f" has no header at row {header_row}"))
    rows = _with_headers(body, laid, same, "left").withColumn("places", F.when(F.col("of").isNull(), F.raise_error(lost)).otherwise(F.col("places")))

    def cell(i: int) -> Column:
        own = F.col(f"places.p{i}")
        every = F.filter(F.transform(own, lambda p: F.get("cells", p)), lambda c: c.isNotNull())
        return F.when(F.size(own) <= 1, F.get("cells", F.get(own, F.lit(0)))).otherwise(F.get(every, F.lit(0)))

    return rows.select(*keep, *[cell(i).alias(c) for i, c in enumerate(columns)])


def table_by_place(
    grid: DataFrame, header_row: int, data_row: int, layouts: list[list[str]], keep: tuple[str, ...] = ("path",)
) -> DataFrame:
    """Body rows of a grid whose columns are known by their places.

    A file (or sheet) has one of the layouts, by the number of its header cells;
    with any other number it is refused when it is read. Columns that its layout
    lacks are NULL.
    """
    width = F.coalesce(F.array_max(F.transform("cells", lambda c, i: F.when(F.trim(c) != "", i + 1))), F.lit(0))
    laid = grid.where(F.col("row_no") == header_row).select(F.col("path").alias("of"), F.col("sheet").alias("of_sheet"), width.alias("width"))
    fits = F.col("width").isin([len(names) for names in layouts])
    said = F.concat(
        F.lit("report "), "of", F.lit(" is refused: it has "), "width",
        F.lit(f" columns, its contract names {' or '.join(str(len(names)) for names in layouts)}"),
    )
    laid = laid.select("of", "of_sheet", F.when(fits, F.col("width")).otherwise(F.raise_error(said).cast("int")).alias("width"))
    same = (F.col("path") == F.col("of")) & F.col("sheet").eqNullSafe(F.col("of_sheet"))
    lost = F.raise_error(F.concat(F.lit("report "), "path", F.lit(f" has no header at row {header_row}"))).cast("int")
    body = _with_headers(grid.where(F.col("row_no") >= data_row), laid, same, "left")
    body = body.withColumn("width", F.when(F.col("of").isNull(), lost).otherwise(F.col("width")))

    def cell(name: str) -> Column:
        places = [(len(names), names.index(name)) for names in layouts if name in names]
        found = F.coalesce(*[F.when(F.col("width") == n, F.lit(i)) for n, i in places])
        return F.get("cells", found)

    return body.select(*keep, *[cell(name).alias(name) for name in layouts[0]])


def preamble_value(grid: DataFrame, row: int, col: int, name: str) -> DataFrame:
    """(path, name): one metadata cell per file."""
    return grid.filter(F.col("row_no") == row).select(
        "path", F.try_element_at("cells", F.lit(col + 1)).alias(name)
    )


def with_preamble_value(table: DataFrame, cells: DataFrame) -> DataFrame:
    """Body rows with their file's metadata cell (one cell row per file)."""
    return table.join(cells, "path", "left")


def first_per_file(df: DataFrame, path: str, order: str) -> DataFrame:
    """First row of every report file."""
    from bazaar.operators.dedupe import first_by_ordinal

    return first_by_ordinal(df, [path], order)


def union_reports(*frames: DataFrame) -> DataFrame:
    """Reports of one type to one table; columns a report lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def cells_of(line: Column, sep: str = ",") -> Column:
    """Cells of a plain separated line without quoting."""
    return F.split(line, f"\\Q{sep}\\E", -1)
