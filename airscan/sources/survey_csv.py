"""Folders of survey logs as one table.

A log is a CSV file whose first line is free-form metadata and whose second line is
the header.  Files differ in their columns and are merged by column name.  A census
finds the header of every file and is written once; then one scan reads all files by
position, whatever their headers, and the census says which position of a file is which
column.  All files are opened by Spark's readers, so any store that Spark knows will do.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airscan import schema
from airscan.schema import FILE, LOG, MAC, REQUIRED, TYPE
from airscan.sources.local import bounded, helper, small_table, staged

CORRUPT = "_corrupt"
NO_SEPARATOR = "\x01\x02\x03"  # stands in no line, so a line is one field
LEAST_WIDE = 64  # columns up to which rows are never called wide
MOST_PLANNED = 4000  # columns of all scans up to which logs of different widths are scanned apart; planning grows with their square
#: A field after its comma: inside quotes, which are doubled within, or up to the next comma.
QUOTED_FIELDS = r',("[^"]*+(?:""[^"]*+)*+"(?=,|$)|[^,]*+)'
#: Spelled like this where files differ in case only.
KNOWN = tuple(value for name, value in vars(schema).items() if name.isupper() and isinstance(value, str))


class SurveyLogs(NamedTuple):
    """Merged rows, the rows set aside, and the files that were not used."""

    rows: DataFrame
    rejected_rows: DataFrame
    rejected_files: DataFrame


# -- census -------------------------------------------------------------------


def own_files(spark: SparkSession, path: str) -> list[str]:
    """The files that ``path`` itself names (none where it names folders), as Spark's storage qualifies them."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = named.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [status.getPath().toString() for status in store.globStatus(named) or [] if status.isFile()]


def list_files(spark: SparkSession, path: str, suffix: str = ".csv", own: Sequence[str] = ()) -> DataFrame:
    """Files below a folder that end in ``suffix``, or the files given: path, and uri as scans name it; not contents."""
    files = _listing(spark, path).select("path", F.col("_metadata.file_path").alias("uri"))
    return files if own else files.filter(F.endswith("path", F.lit(suffix)))


def _listing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def empty_files(spark: SparkSession, path: str, census: DataFrame, counted: int, suffix: str, own: Sequence[str]) -> DataFrame:
    """Files of no bytes, which Spark's readers pass over; their names are fetched only if the index holds more files."""
    paths = pa.schema([("path", pa.string())])
    listing = _listing(spark, path)
    if len(listing._jdf.inputFiles()) <= counted:
        return small_table(spark, [], paths)
    indexed = [re.sub(r"^file:/+", "file:/", unquote(uri)) for uri in listing.inputFiles()]
    named = [(uri,) for uri in indexed if own or uri.endswith(suffix)]
    return small_table(spark, named, paths).join(census.select("path"), "path", "left_anti")


def _reader(spark: SparkSession, suffix: str):
    """Files below a folder; an empty suffix takes all."""
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", f"*{suffix}") if suffix else reader


def read_lines(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """All lines but the first of every file, and no blank ones: uri, ``_start`` of the file's block, and ``_text``.

    This is the CSV reader with one column, so lines are dropped by position and decoded as in a scan by position.
    """
    lines = (
        _reader(spark, suffix)
        .schema("_text string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", NO_SEPARATOR)
        .option("quote", "")
        .csv(path)
    )
    return lines.select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("_start"), "_text")


def header_census(spark: SparkSession, files: DataFrame, lines: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Header line of every file, null where it cannot name the required columns, or why there is none; a written table.

    Spark reads the lead lines itself, so any store it opens will do. Of all lines only those that hold the required names
    are kept until the first line of each file is known; no line is sorted or leaves its task otherwise.
    """
    may_be = F.lit(True)
    for name in required:
        may_be = may_be & F.contains("_text", F.lit(name))
    numbered = lines.filter(F.col("_start") == 0).withColumn("_line", F.monotonically_increasing_id())
    heads = numbered.groupBy(F.col("uri").alias("_uri")).agg(
        F.min("_line").alias("_first"), F.collect_list(F.when(may_be, F.struct("_line", "_text"))).alias("_heads")
    )
    header = F.get(F.filter("_heads", lambda line: line["_line"] == F.col("_first")), F.lit(0))["_text"]
    reason = F.when(F.col("_first").isNull(), "error: no header line").when(header.isNull(), "bad headers")
    found = files.join(heads, F.col("uri") == F.col("_uri"), "left")
    return staged(found.select("path", "uri", header.alias("header"), reason.alias("reason")), "census")


def parsed_headers(census: DataFrame, required: Sequence[str] = REQUIRED) -> tuple[dict[str, list[str]], list[tuple[str, str]]]:
    """Fields of every distinct header line that has the required names, and the other lines with the reason."""
    csv.field_size_limit(2**31 - 1)
    good, bad = {}, []
    for row in census.filter("header is not null").select("header").distinct().sort("header").toLocalIterator():
        try:
            fields = next(csv.reader([row.header]))
        except csv.Error as fault:
            bad.append((row.header, f"error: {fault}"))
            continue
        if set(required) <= set(fields):
            good[row.header] = fields
        else:
            bad.append((row.header, "bad headers"))
    return good, bad


# -- names --------------------------------------------------------------------


def unique_names(header: Sequence[str]) -> list[str]:
    """Header names made unique without regard to case.

    Blanks are named by position.  Of names that are equal but for case, a known spelling or
    else the first keeps its name and the others are numbered (``x``, ``x.1``).
    """
    names = [name or f"Unnamed: {position}" for position, name in enumerate(header)]
    first = {name.lower(): name for name in reversed(names)} | {name.lower(): name for name in names if name in KNOWN}
    out: list[str] = []
    taken: set[str] = {FILE, LOG, CORRUPT}
    kept: set[str] = set()
    for name in names:
        low = name.lower()
        if first[low] == name and low not in kept and low not in taken:
            kept.add(low)
            out.append(name)
            continue
        count = 1
        while f"{low}.{count}" in taken or f"{low}.{count}" in first:
            count += 1
        taken.add(f"{low}.{count}")
        out.append(f"{name}.{count}")
    return out


def merged_names(headers: Sequence[Sequence[str]]) -> list[str]:
    """Columns of all files: known spellings, else the first in order; equal but for case is one column."""
    spelled: dict[str, str] = {}
    for header in headers:
        for name in header:
            low = name.lower()
            if low not in spelled or name in KNOWN:
                spelled[low] = name
    return list(spelled.values())


# -- reading ------------------------------------------------------------------


def is_long_row(text: Column, width: Column) -> Column:
    """More fields than the header has: at least ``width`` commas, not counting those inside quotes."""

    def commas(of: Column) -> Column:
        return F.length(of) - F.length(F.replace(of, F.lit(","), F.lit("")))

    bare = F.regexp_replace(text, r'"(?:[^"]|"")*"', "")
    return F.when(commas(text) < width, F.lit(False)).otherwise(commas(bare) >= width)


def _positions_of(width: int) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in [*(f"_{i}" for i in range(width)), CORRUPT]])


#: A quote inside quotes is doubled; a pruned parse would not count the fields of a row.
CSV_OPTIONS = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": CORRUPT}


def read_positions(spark: SparkSession, path: str, width: int, multiline: bool, suffix: str) -> DataFrame:
    """All rows below a folder as ``_fields`` (array of texts), ``_text`` (the row) and ``uri``, in one scan.

    The reader's own header handling drops line 1 by position.  The schema has one position more
    than the longest header, so the reader keeps the text of every row that is not too long by two or more.
    """
    fields = [f"_{i}" for i in range(width)]
    raw = (
        _reader(spark, suffix)
        .schema(_positions_of(width))
        .options(**CSV_OPTIONS)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", multiline)
        .option("columnPruning", False)
        .csv(path)
    )
    text = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*fields)))
    return raw.select(
        F.col("_metadata.file_path").alias("uri"), F.array(*fields).alias("_fields"), text.alias("_text"), F.col(CORRUPT).isNull().alias("_full")
    )


def cut(line: Column) -> Column:
    """Fields of a line as an array of its own length, without their quotes."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(QUOTED_FIELDS), F.lit(1))
    bare = F.transform(
        quoted,
        lambda x: F.when(
            x.startswith('"') & x.endswith('"') & (F.length(x) > 1),
            F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(x),
    )
    return F.when(F.contains(line, F.lit('"')), bare).otherwise(F.split(line, ",", -1))


def fields_of(line: Column) -> Column:
    """Fields of a line as an array of its own length: quotes are removed, an empty field is null, as the reader has it."""
    return F.transform(cut(line), lambda x: F.nullif(x, F.lit("")))


def read_ragged(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of files of very different widths in one scan, each line cut into as many fields as it has.

    A wide log makes no other log's rows wider. ``files`` (uri) are joined to the lines before they are cut.
    """
    rows = lines.drop("_start").join(files, "uri").withColumn("_fields", fields_of(F.col("_text")))
    return rows.withColumn("_long", F.size(cut(F.col("_text"))) > F.col("_width"))


def width_class(width: int) -> int:
    """Class of a header's width: 0 up to ``LEAST_WIDE`` fields, then one class per doubling."""
    return ((width - 1) // LEAST_WIDE).bit_length()


def invalid_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """uri of every file with bytes that are not UTF-8; lines are looked at as the bytes they are."""
    lines = _reader(spark, suffix).text(path)
    broken = lines.filter(~F.is_valid_utf8("value"))
    return broken.select(F.col("_metadata.file_path").alias("uri")).distinct()


def read_logs(
    spark: SparkSession,
    path: str,
    suffix: str = ".csv",
    multiline: bool = False,
    strict_files: bool = False,
    strict_encoding: bool = False,
    na_tokens: tuple[str, ...] = (),
) -> SurveyLogs:
    """Merge all logs below a folder (or one file) by column name.

    Files without ``MAC`` and ``Type`` on line 2 are rejected.  Rows with more fields than
    their header are set aside; with ``strict_files`` one such row rejects its whole
    file.  Bytes that are not UTF-8 become replacement characters; with
    ``strict_encoding`` they reject their file (the bytes count: a file that holds the replacement character itself is
    valid).  ``multiline`` allows line breaks inside quotes but makes files unsplittable.
    ``na_tokens`` are texts to read as missing.  Columns whose names differ only in case are
    one column, unless one file has both; then the second is numbered.

    Only distinct header lines come to the driver; each file's positions join the scan by its path, broadcast where the
    files are few enough. Where the headers' widths differ much, each line is cut into its own fields and there is one scan per
    class of widths (one of all files beyond ``MOST_PLANNED`` columns), in which columns of other classes are plain nulls.
    """
    own = own_files(spark, path)
    globbed = "" if own else suffix
    lines = read_lines(spark, path, globbed)
    census = header_census(spark, list_files(spark, path, suffix, own), lines)
    counted = census.count()
    if not counted:
        raise ValueError(f"no {suffix} files under {path}")
    good, bad = parsed_headers(census)
    if not good:
        raise ValueError(f"no valid logs under {path}: {counted} files rejected")
    named = [(header, fields, unique_names(fields)) for header, fields in good.items()]
    names = merged_names([own_names for _, _, own_names in named])
    files = staged(census.join(_positions(spark, named, names), "header").drop("reason", "header"), "census-positions")
    files = bounded(files, 5_000_000 // (len(names) + 10))
    widths = [len(fields) for fields in good.values()]

    def columns(rows: DataFrame, long_row: Column, held: Sequence[str], may_be_header: Column | None = None) -> DataFrame:
        """The merged columns of rows cut into ``_fields``; those that no header of theirs names are a plain null."""
        absent, own_names = F.lit(None).cast("string"), {name.lower() for name in held}
        of = {name: F.get("_fields", F.get("_at", F.lit(i))) if name.lower() in own_names else absent for i, name in enumerate(names)}
        is_header = (of[MAC] == MAC) & (of[TYPE] == TYPE)
        is_header = is_header if may_be_header is None else may_be_header & is_header
        texts = [value.alias(name) for name, value in of.items()]
        return rows.filter(~F.coalesce(is_header, F.lit(False))).select(
            *texts, helper(F.col("path"), FILE), helper(F.col("path"), LOG), F.when(long_row, F.col("_text")).alias(CORRUPT)
        )

    if multiline or max(widths) <= max(LEAST_WIDE, 2 * min(widths)):
        rows = read_positions(spark, path, max(widths) + 1, multiline, globbed).join(files, "uri")
        long_row = F.when(F.col("_full"), F.lit(True)).otherwise(is_long_row(F.col("_text"), F.col("_width")))
        merged = columns(rows, long_row, names)
    else:
        held: dict[int, list[str]] = {}
        for _, fields, own_names in named:
            held.setdefault(width_class(len(fields)), []).extend(own_names)
        named_in = F.contains("_text", F.lit(MAC)) & F.contains("_text", F.lit(TYPE))  # few lines are cut to tell headers
        if len(held) * len(names) <= MOST_PLANNED:
            kinds = [(files.filter(F.col("_class") == kind), held[kind]) for kind in sorted(held)]
        else:
            kinds = [(files, names)]
        scans = [columns(read_ragged(lines, of_kind), F.col("_long"), own_names, named_in) for of_kind, own_names in kinds]
        merged = reduce(DataFrame.union, scans)
    empty = empty_files(spark, path, census, counted, suffix, own)
    not_logs = small_table(spark, bad, pa.schema([("header", pa.string()), ("_why", pa.string())]))
    judged = census.join(not_logs, "header", "left").withColumn("reason", F.coalesce("reason", "_why"))
    rejected_files = judged.filter(F.col("reason").isNotNull()).select("path", "reason").unionByName(
        empty.withColumn("reason", F.lit("error: no header line"))
    )
    surplus = F.col(CORRUPT).isNotNull()
    rejected_rows = merged.filter(surplus).select(FILE, F.col(CORRUPT).alias("row"))
    rows = merged.filter(~surplus).drop(CORRUPT)
    failures = []
    if strict_files:
        failures.append(("error: row with more fields than the header", rejected_rows))
    if strict_encoding:
        broken = census.filter("header is not null").join(invalid_files(spark, path, globbed), "uri", "left_semi")
        failures.append(("error: invalid UTF-8", staged(broken.select(F.col("path").alias(FILE)), "invalid-files")))
    for reason, found in failures:
        failed = found.select(FILE).distinct()
        rows = rows.join(failed, FILE, "left_anti")
        rejected_files = rejected_files.unionByName(failed.select(F.col(FILE).alias("path"), F.lit(reason).alias("reason")))
    if na_tokens:
        rows = rows.replace(list(na_tokens), None, [n for n in rows.columns if n not in (FILE, LOG)])
    return SurveyLogs(rows, rejected_rows, rejected_files)


def _positions(spark: SparkSession, named: list[tuple[str, list[str], list[str]]], names: list[str]) -> DataFrame:
    """Per distinct header: its width and the class of it, and for every merged column the position that holds it, or null."""
    rows = []
    for header, fields, own in named:
        place = {name.lower(): position for position, name in enumerate(own)}
        rows.append((header, [place.get(name.lower()) for name in names], len(fields), width_class(len(fields))))
    kinds = [("header", pa.string()), ("_at", pa.list_(pa.int32())), ("_width", pa.int32()), ("_class", pa.int32())]
    return small_table(spark, rows, pa.schema(kinds))


def log_name(file: Column) -> Column:
    """Folder and file name of a log path."""
    return F.substring_index(file, "/", -2)
