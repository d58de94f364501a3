"""Readers.  All of them return lazy DataFrames; a header or a directory
listing is the most that is read on the driver."""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.labels import model_from_filename
from weekloom.functions.numbers import parse_grouped_int, to_number
from weekloom.session import stored
from weekloom.sources.records import csv_records, lines, quote_parity

# Header and types of the raw chart file.
CHART_TYPES = {
    "Position": "int",
    "Song Title": "string",
    "Artists": "string",
    "Last Week": "string",
    "Peak Position": "string",
    "Weeks on Chart": "string",
    "Streams": "bigint",
    "Date": "string",
}
CHART_REQUIRED = ("Song Title", "Artists", "Date")

# Quotes inside quoted fields are doubled; blanks at the ends of a field count.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Text columns of result files; others are numbers if all their values are.
RESULT_TEXT = {"genre", "best_params", "sarima_order"}


class MissingColumns(ValueError):
    """An input lacks columns the job cannot do without."""


def require_columns(df_columns: list[str], required) -> None:
    missing = [c for c in required if c not in df_columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")


def _csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(**CSV_OPTIONS, multiLine=True).csv(path).columns


def _typed_csv(spark: SparkSession, paths: list[str] | str, header: list[str], types: dict[str, str], default: str, **options):
    schema = ", ".join(f"`{c}` {types.get(c, default)}" for c in header)
    return spark.read.schema(schema).options(**CSV_OPTIONS, **options).csv(paths)


def read_csv_chart(spark: SparkSession, path: str, required=CHART_REQUIRED) -> DataFrame:
    """Raw chart rows with fixed types.  An absent path raises Spark's own
    error, an absent required column raises :class:`MissingColumns`; a folder of
    files whose columns differ in order is refused when it is read.

    A scan of the quotes tells whether titles hold line breaks.  Where none does the
    files are split as they are, else records are found in parallel (see
    ``records``); a large file is read by many tasks either way."""
    header = _csv_header(spark, path)
    require_columns(header, required)
    parity = quote_parity(lines(spark, path))
    if parity.filter("broken > 0").isEmpty():
        return _typed_csv(spark, path, header, CHART_TYPES, "string", enforceSchema=False)
    types = ", ".join(f"`{c}` {CHART_TYPES.get(c, 'string')}" for c in header)
    names = ", ".join(f"`{i}` string" for i in range(len(header)))
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items() if k != "header"}
    records = csv_records(spark, path, stored(parity, "parity"))
    cells = F.array(*[F.col(f"cells.`{i}`") for i in range(len(header))])
    parsed = records.select(F.from_csv("text", F.lit(types), options).alias("row"), F.from_csv("text", F.lit(names), options).alias("cells"))
    # a header has the names of the columns, each in its place; one with the same names elsewhere is of another file
    is_header = cells == F.array(*map(F.lit, header))
    other = F.sort_array(F.transform(cells, lambda c: F.coalesce(c, F.lit("")))) == F.sort_array(F.array(*map(F.lit, header)))
    refused = F.raise_error(F.lit("CSV header does not conform to the schema: the columns of a file are in another order"))
    kept = F.when(is_header, F.lit(False)).when(other, refused.cast("boolean")).otherwise(F.lit(True))
    return parsed.filter(kept).select("row.*")


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """The table, or ``None`` when the path does not exist."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_with_enrichments(
    spark: SparkSession, base: str, enrichments: dict[str, str], fmt: str = "parquet", **options
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Required base table and those enrichment tables that are there."""
    found = {name: read_optional(spark, path, fmt, **options) for name, path in enrichments.items()}
    return (
        spark.read.format(fmt).options(**options).load(base),
        {name: df for name, df in found.items() if df is not None},
    )


INGEST_ORDER = "ingest_seq"


def with_ingest_order(df: DataFrame) -> DataFrame:
    """Adds the place of each row in the files it was read from, for steps that
    keep the first of several rows."""
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")
    )
    return df.withColumn(INGEST_ORDER, place)


def row_order(df: DataFrame) -> list[str]:
    """What "first" means for a table: its ingest order, else all its columns."""
    return [INGEST_ORDER] if INGEST_ORDER in df.columns else list(df.columns)


def nonnull_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias(key)).dropna()


def projected(df: DataFrame, date: str, target: str) -> DataFrame:
    """Only the date and the target reach the scan."""
    return df.select(date, target)


def load_model_dataset(df: DataFrame) -> DataFrame:
    """Parsed dates and the dataset's order: by track and date where the track
    columns exist, else by date."""
    out = df.withColumn("date", F.to_date("date")) if "date" in df.columns else df
    order = [c for c in ("artist", "song", "date") if c in out.columns]
    if len(order) == 3:
        return out.orderBy(*order)
    return out.orderBy("date") if "date" in out.columns else out


def result_headers(spark: SparkSession, folder: str, kind: str) -> list[tuple[list[str], list[str]]]:
    """(columns, files) of every header among the files directly below ``folder``
    whose set's name contains ``kind`` and not ``combined``.  A set is a file or a
    directory of part files.  One scan of the first lines of all files finds them, so the
    number of jobs does not grow with the files; what reaches the driver is of the size
    of the directory listing."""
    read = read_optional(spark, f"{folder}/*{kind}*", "text")
    if read is None:
        return []
    path = F.col("_metadata.file_path")
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    first = read.select(path.alias("file"), place.alias("place"), "value").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    named = first.filter(~F.contains(_set_name(F.col("file")), F.lit("combined"))).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    # file paths come URL-encoded
    return sorted((next(csv.reader([r["header"]])), [unquote(f) for f in r["files"]]) for r in named.collect())


def _set_name(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"/part-[^/]*$", ""), r"^.*/", "")


def scan_result_files(spark: SparkSession, folder: str, kind: str = "metrics") -> DataFrame | None:
    """All result sets of one kind as one table with ``source_file`` and
    ``model``.  Files with the same header share one scan; missing columns are null."""
    types = {"date": "date"}
    result: DataFrame | None = None
    for header, files in result_headers(spark, folder, kind):
        part = _typed_csv(spark, files, header, types, "string").withColumn("source_file", _set_name(F.col("_metadata.file_path")))
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    if result is None:
        return None
    open_ = [c for c in result.columns if c not in {*RESULT_TEXT, *types, "source_file"}]
    if open_:
        words = [F.count_if(F.col(f"`{c}`").isNotNull() & to_number(F.col(f"`{c}`")).isNull()).alias(c) for c in open_]
        odd = result.agg(*words).first()
        result = result.withColumns({c: to_number(F.col(f"`{c}`")) for c in open_ if not odd[c]})
    return result.withColumn("model", model_from_filename(F.col("source_file"), kind))


# --- chart pages -----------------------------------------------------------

# Where a chart page keeps its rows, cells, title and artists.
CHART_ROW = r"<tr\b[^>]*data-encore-id=['\"]tableRow['\"][^>]*>(.*?)</tr>"
CHART_CELL = r"<td\b[^>]*data-encore-id=['\"]tableCell['\"][^>]*>(.*?)</td>"
CHART_TITLE = r'class="[^"]*StyledTruncatedTitle[^"]*"[^>]*>(.*?)</'
CHART_ARTISTS = r'class="[^"]*StyledArtistsTruncatedDiv[^"]*"[^>]*>(.*?)</div>'
CHART_ARTIST = r"<a\b[^>]*>(.*?)</a>"
CHART_MIN_CELLS = 7


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)" + pattern), F.lit(1))


def cell_text(c: Column) -> Column:
    """Text of a markup fragment: tags out, trimmed, the common entities decoded."""
    text = F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", ""))
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def page_rows(
    pages: DataFrame, html: str, keys: list[str], row: str = CHART_ROW, cell: str = CHART_CELL, min_cells: int = 7
) -> DataFrame:
    """One row per table row of each page that has enough cells.  ``position``
    counts all rows that match ``row``, also those with too few cells."""
    return (
        pages.select(*keys, F.posexplode(_all(F.col(html), row)).alias("pos", "row_html"))
        .withColumn("cells", _all(F.col("row_html"), cell))
        .filter(F.size("cells") >= min_cells)
        .select(*keys, (F.col("pos") + 1).alias("position"), "row_html", "cells")
    )


def chart_page_rows(pages: DataFrame, html: str, keys: list[str]) -> DataFrame:
    """Chart rows of saved chart pages."""
    cells = page_rows(pages, html, keys, CHART_ROW, CHART_CELL, CHART_MIN_CELLS)
    cell = F.col("cells")
    artists = _all(F.regexp_extract(cell[2], "(?s)" + CHART_ARTISTS, 1), CHART_ARTIST)
    return cells.select(
        *keys,
        F.col("position").alias("Position"),
        cell_text(F.regexp_extract(cell[2], "(?s)" + CHART_TITLE, 1)).alias("Song Title"),
        F.array_join(F.transform(artists, cell_text), ", ").alias("Artists"),
        cell_text(cell[3]).alias("Last Week"),
        cell_text(cell[4]).alias("Peak Position"),
        cell_text(cell[5]).alias("Weeks on Chart"),
        parse_grouped_int(cell_text(cell[6])).alias("Streams"),
    )


def week_schedule(bounds: DataFrame, start: str, end: str, out: str = "week") -> DataFrame:
    """Weekly dates from ``start`` back to ``end`` inclusive, latest first, for
    each row of ``bounds``."""
    weeks = F.sequence(F.col(start), F.col(end), F.expr("interval -7 days"))
    ordered = F.col(start) >= F.col(end)
    return bounds.filter(ordered).select(F.posexplode(weeks).alias("step", out))
