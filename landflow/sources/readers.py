"""Readers: delimited text as all-string rows, manifests, landing listings."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landflow.config import EntityConfig
from landflow.operators.admission import MANIFEST_PREFIX, file_name
from landflow.operators.projection import cols, quoted
from landflow.operators.rules import HEADER_FAULTS
from landflow.session import scratch_path
from landflow.sources.landing import landed_files

SOURCE_FILE, SOURCE_PATH = "_source_file", "_source_path"
#: Column with the text of a record that has more or fewer fields than declared.
MALFORMED = "_malformed"

#: Pieces that a file's lines are dealt into where they meet what is known of the file.
PIECES = 64

# How missing values print in extracts made by dataframe tools.
MISSING_TEXTS = ("nan", "NaT")


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def missing_to_blank(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """``nan``, ``NaT`` and missing values become blank text."""
    chosen = set(names or [n for n, kind in df.dtypes if kind == "string"])

    def fix(name: str) -> Column:
        c = F.col(f"`{name}`")
        if name not in chosen:
            return c
        return F.when(c.isNull() | c.isin(*MISSING_TEXTS), "").otherwise(c).alias(name)

    return df.select(*[fix(n) for n in df.columns])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str],
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    with_source: bool = False,
    multi_line: bool = False,
    malformed: str | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Delimited text with declared columns, everything read as text.

    Quotes within quoted text are doubled; with ``multi_line`` quoted text may hold line breaks.
    With ``malformed`` a column of that name holds the text of records with more or fewer fields than
    declared, for the row rules to reject, and null for sound ones; without it such records fail the read.
    ``only`` (``path``) names the files that are wanted.
    """
    schema = text_schema([*names, malformed] if malformed else names)
    reader = (
        spark.read.schema(schema)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("sep", sep)
        .option("header", header)
        .option("enforceSchema", True)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE" if malformed else "FAILFAST")
    )
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    raw = reader.csv(path)
    if with_source or only is not None:
        raw = raw.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE), file_path().alias("_path"))
        raw = raw.join(only.withColumnRenamed("path", "_path"), "_path", "left_semi") if only is not None else raw
        raw = raw.withColumnRenamed("_path", SOURCE_PATH) if with_source else raw.drop("_path", SOURCE_FILE)
    return missing_to_blank(raw, names)


def read_tsv_legacy(
    spark: SparkSession, path: str | list[str], names: Sequence[str], region: str = "", **more
) -> DataFrame:
    """Tab-separated text with a spreadsheet extension; one region writes Latin-1."""
    encoding = "ISO-8859-1" if region.upper() == "APJ" else "UTF-8"
    return read_delimited(spark, path, names, sep="\t", encoding=encoding, **more)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with their position in the file: ``path, value, line, line_count``; see :func:`number_lines`."""
    return number_lines(spark.read.text(path).select(*line_columns()))


def number_lines(lines: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Lines (and further columns, ``also``) as :func:`line_columns` selects them, from files or a micro-batch of them, with their positions.

    One scan of the text writes every line with its file, its block and a running number to the shared
    folder.  What is stored is then the index as well: a block's lines, summed along the file, give each
    block its first line number.  Only these sums are windowed, never the lines, and a task that runs
    again reads the same numbers.
    """
    spark = lines.sparkSession
    lines = lines.select("path", "_block", F.monotonically_increasing_id().alias("_seq"), "value", *also)
    stored = scratch_path(spark, "lines")
    lines.write.parquet(stored)
    lines = spark.read.schema(lines.schema).parquet(stored)
    blocks = lines.groupBy("path", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first")
    )
    whole = Window.partitionBy("path")
    before = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select(
        "path", "_block", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias("line_count"),
    )
    return lines.join(placed, ["path", "_block"]).select(
        "path",
        "value",
        (F.col("_offset") + F.col("_seq") - F.col("_first")).alias("line"),
        "line_count",
        *also,
    )


def join_files(lines: DataFrame, files: DataFrame, how: str) -> DataFrame:
    """Lines (``path, value``) joined to a row a file, in pieces: no task gets the whole of a large file.

    Joined by the path alone, the lines would stay dealt by file for what follows, such as their de-duplication.
    """
    piece = F.pmod(F.xxhash64("value"), F.lit(PIECES)).cast("int")
    pieces = files.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    return lines.withColumn("_piece", piece).join(pieces, ["path", "_piece"], how).drop("_piece")


def skip_header_rows(lines: DataFrame, header_row: int) -> DataFrame:
    """Lines after the header in line ``header_row`` (counted from 0)."""
    return lines.filter(F.col("line") > header_row)


def trailer_rows(lines: DataFrame, keep: int, header_row: int = -1) -> DataFrame:
    """Negative ``keep`` drops that many last lines, positive keeps the first ones, 0 is off."""
    data_line = F.col("line") - header_row - 1
    data_count = F.col("line_count") - header_row - 1
    if keep < 0:
        return lines.filter(data_line < data_count + keep)
    return lines.filter(data_line < keep) if keep > 0 else lines


def parse_lines(lines: DataFrame, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Lines (``path, value``) as columns in the declared order."""
    rows = lines.select(_parsed(names, sep).alias("_r"), *_origin())
    return missing_to_blank(rows.select("_r.*", SOURCE_FILE, SOURCE_PATH), names)


def _origin() -> list[Column]:
    return [file_name(F.col("path")).alias(SOURCE_FILE), F.col("path").alias(SOURCE_PATH)]


def _parsed(names: Sequence[str], sep: str) -> Column:
    schema = ", ".join(f"{quoted(n)} string" for n in [*names, MALFORMED])
    return F.from_csv("value", schema, {"sep": sep, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": MALFORMED})


# ------------------------------------------------------------------ columns by the names in a file's header


def fields_of(line: Column, sep: str) -> Column:
    """The fields of a line, however many, as an array; quoted ones without their quotes."""
    mark = re.escape(sep)
    pattern = f'{mark}("[^"]*+(?:""[^"]*+)*+"(?={mark}|$)|[^{mark}]*)'
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(pattern), F.lit(1))
    bare = lambda f: F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
    is_quoted = lambda f: (F.length(f) > 1) & f.startswith('"') & f.endswith('"')
    return F.transform(found, lambda f: F.when(is_quoted(f), bare(f)).otherwise(f))


def text_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """``path, value`` of every line after a file's first, blank ones left out, in any encoding."""
    raw = (
        spark.read.schema("value string, _whole string")
        .option("sep", "\x01").option("quote", "").option("header", True).option("enforceSchema", True)
        .option("encoding", encoding).option("columnNameOfCorruptRecord", "_whole")
        .csv(path)
    )
    return raw.select(file_path().alias("path"), F.coalesce("_whole", "value").alias("value"))


def header_names(
    spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8", slices: int = 1
) -> DataFrame:
    """``path, header``: the names in each file's first line, none for an empty file."""
    found = landed_files(spark, path, head=True, sep=sep, encoding=encoding, slices=slices)
    return found.select(_same_path(F.col("path")).alias("path"), F.transform("header", lambda h: F.trim(h)).alias("header"))


def header_columns(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Number of columns in each file's first line: ``path, header_columns``."""
    return header_names(spark, path, sep, encoding).select("path", F.size("header").alias("header_columns"))


def named(header: Column) -> Column:
    """The names of a header that name something: neither blank nor made up for a column without a name."""
    return F.filter(header, lambda h: (h != "") & ~h.startswith("Unnamed"))


def header_faults(header: Column, names: Sequence[str], unknown: str = "reject") -> Column:
    """What is wrong with a header, as failures (reason and column): names that lack, repeat or are not declared."""
    header = named(header)
    declared = F.array(*[F.lit(n) for n in names])
    failure = lambda said: lambda n: F.struct(F.concat(n, F.lit(said)).alias("reason"), n.alias("column"))
    missing = F.transform(F.array_except(declared, header), failure("_missing_in_header"))
    repeated = F.filter(declared, lambda n: F.size(F.filter(header, lambda h: h == n)) > 1)
    found = [missing, F.transform(repeated, failure("_repeated_in_header"))]
    if unknown == "reject":
        found.append(F.transform(F.array_except(header, declared), failure("_not_declared")))
    return F.concat(*found)


def by_header(
    lines: DataFrame, headers: DataFrame, names: Sequence[str], sep: str = ",", unknown: str = "reject", first: int = 0
) -> DataFrame:
    """Lines (``path, value``) as the declared columns, found by each file's own header (``path, header``).

    Files whose header is as declared are parsed as they are, so only the other headers are joined to the
    lines.  Their fields are put in the declared order; a declared name that a header lacks gives nulls.
    ``HEADER_FAULTS`` holds what is wrong with a file's header for the row rules to report, and
    ``MALFORMED`` the text of a record with more or fewer fields than its own header.  With ``unknown``
    as ``drop``, columns that are not declared are left out and are no fault; with ``first`` only so many
    columns of a file count.
    """
    declared = F.array(*[F.lit(n) for n in names])
    counted = F.slice("header", 1, first) if first else F.col("header")
    other = headers.where(~F.col("header").eqNullSafe(declared)).select(
        "path", "header", header_faults(counted, names, unknown).alias(HEADER_FAULTS),
        *[F.array_position(counted, F.lit(n)).cast("int").alias(f"_at{k}") for k, n in enumerate(names)],
    )
    joined = join_files(lines, other, "left")
    as_declared = F.col("header").isNull()
    rows = joined.select(
        F.when(as_declared, _parsed(names, sep)).alias("_r"),
        F.when(~as_declared, fields_of(F.col("value"), sep)).alias("_f"),
        "value", "header", HEADER_FAULTS, *_origin(), *[f"_at{k}" for k in range(len(names))],
    )
    own = lambda k: F.when(F.col(f"_at{k}") > 0, F.get("_f", F.col(f"_at{k}") - 1))
    mapped = [F.coalesce(F.col("_r")[n], own(k)).alias(n) for k, n in enumerate(names)]
    ragged = F.when(F.size("_f") != F.size("header"), F.col("value"))
    empty = F.array().cast("array<struct<reason:string,column:string>>")
    found = rows.select(
        *mapped, F.coalesce(F.col("_r")[MALFORMED], ragged).alias(MALFORMED),
        F.coalesce(HEADER_FAULTS, empty).alias(HEADER_FAULTS), SOURCE_FILE, SOURCE_PATH,
    )
    return missing_to_blank(found, names)


def read_by_header(
    spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str = ",", encoding: str = "UTF-8",
    unknown: str = "reject", first: int = 0,
) -> DataFrame:
    """Files whose columns may stand in any order; see :func:`by_header`.  One scan of the text."""
    lines, headers = text_lines(spark, path, encoding), header_names(spark, path, sep, encoding)
    return by_header(lines, headers, names, sep, unknown, first)


def read_entity(
    spark: SparkSession, path: str | list[str], config: EntityConfig, only: DataFrame | None = None
) -> DataFrame:
    """Raw text rows of one entity, empty rows dropped; ``only`` (``path``) names the files that are wanted.

    Columns are found by the names in each file's header line, or with ``force_column_names`` taken in the
    declared order whatever the header says.  ``columns_to_select`` lets only the first columns of a file
    count; ``unknown_columns`` says whether one that is not declared is a fault (``reject``) or left out (``drop``).
    """
    wanted = lambda lines: lines if only is None else join_files(lines, only, "left_semi")
    names, sep, encoding = config.columns, config.delimiter, config.encoding
    if config.header_row_number_to_select or config.remove_trailer_rows:
        return rows_of_lines(wanted(numbered_lines(spark, path)), config)
    if config.force_column_names:
        raw = read_delimited(spark, path, names, sep, encoding=encoding, with_source=True, malformed=MALFORMED, only=only)
        return _filled_rows(raw, names)
    lines, headers = text_lines(spark, path, encoding), header_names(spark, path, sep, encoding)
    return _filled_rows(by_header(wanted(lines), headers, names, sep, config.unknown_columns, config.columns_to_select), names)


def rows_of_lines(numbered: DataFrame, config: EntityConfig) -> DataFrame:
    """The rows of :func:`read_entity` from numbered lines."""
    names, sep, row = config.columns, config.delimiter, config.header_row_number_to_select
    lines = trailer_rows(skip_header_rows(numbered, row), config.remove_trailer_rows, row)
    if config.force_column_names:
        return _filled_rows(parse_lines(lines, names, sep), names)
    headers = numbered.where(F.col("line") == row).select("path", F.transform(fields_of(F.col("value"), sep), lambda h: F.trim(h)).alias("header"))
    return _filled_rows(by_header(lines, headers, names, sep, config.unknown_columns, config.columns_to_select), names)


def _filled_rows(raw: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without rows that hold nothing; those of a file whose header is at fault stay, to be rejected."""
    kept = _any_filled([*names, MALFORMED])
    return raw.filter(kept | (F.size(HEADER_FAULTS) > 0) if HEADER_FAULTS in raw.columns else kept)


def _any_filled(names: Sequence[str]) -> Column:
    texts = [F.nullif(F.trim(c), F.lit("")) for c in cols(names)]
    return F.coalesce(*texts).isNotNull()


def read_tables(
    spark: SparkSession, path: str | list[str], tables: Mapping[str, EntityConfig]
) -> dict[str, DataFrame]:
    """One DataFrame per logical table of a file, each by its own configuration."""
    return {name: read_entity(spark, path, config) for name, config in tables.items()}


def list_landing(spark: SparkSession, path: str | list[str], glob: str = "*", slices: int = 1) -> DataFrame:
    """``path, length, modificationTime`` of landed files, empty ones too; contents are not read."""
    found = landed_files(spark, path, glob, slices=slices)
    return found.withColumn("path", _same_path(F.col("path")))


def file_path() -> Column:
    """The file a row was read from, named as listings name it."""
    path = F.col("_metadata.file_path")
    # asked for each line: most names hold no coded character
    return _same_path(F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path))


def line_columns() -> list[Column]:
    """What a text line is numbered by: its file and block."""
    return [file_path().alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.col("value")]


def _same_path(c: Column) -> Column:
    """Local paths are written with one or three slashes; settle for one."""
    three = c.startswith("file:///") & ~c.startswith("file:////")  # what Spark writes, without a pattern
    return F.when(three, F.concat(F.lit("file:/"), c.substr(F.lit(9), F.length(c)))).otherwise(F.regexp_replace(c, "^file:/+", "file:/"))


def read_manifest(
    spark: SparkSession, path: str | list[str], prefix: str = MANIFEST_PREFIX
) -> DataFrame:
    """First non-empty ``name|size`` line of each manifest: ``manifest_name, listed_name, declared_size``."""
    lines = (
        spark.read.option("pathGlobFilter", f"{prefix}*").text(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("manifest_name"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seq"),
            F.split(F.split("value", ",")[0], r"\|").alias("_parts"),
            "value",
        )
        .filter(F.trim("value") != "")
    )
    first = lines.groupBy("path", "manifest_name").agg(
        F.min_by("_parts", F.struct("_block", "_seq")).alias("_parts")
    )
    return first.select(
        "manifest_name",
        F.get("_parts", F.lit(0)).alias("listed_name"),
        F.get("_parts", F.lit(1)).try_cast("bigint").alias("declared_size"),
    )

