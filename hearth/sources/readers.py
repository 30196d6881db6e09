"""Readers: CSV / tab scans, required-column checks, drift-tolerant union.

Drifting file sets (many files, several header layouts, columns at different
positions) cannot be read with one glob: Spark would bind columns by the
first file's header. Instead a Spark job reads the first line of each file,
which gives a catalogue of headers (file, position, column); layouts and the
availability matrix are queries on it. Each layout is read by one scan with an
explicit all-string schema (no inference pass), aligned by column *name* and
unioned. There is one Spark scan per header layout, not one job per file, and
no per-file ``head``/``count`` probes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def validate_columns(actual: Iterable[str], required: Iterable[str], name: str = "") -> None:
    """Raise listing the missing required columns, sorted."""
    missing = set(required) - set(actual)
    if missing:
        label = f"[{name}] " if name else ""
        raise ValueError(f"{label}missing required columns: {sorted(missing)}")


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_strings(spark: SparkSession, paths: str | list[str], sep: str = ",",
                     columns: list[str] | None = None, glob_filter: str | None = None) -> DataFrame:
    """CSV/tab scan with a header, every column a string.

    With ``columns`` the schema is explicit, so Spark skips the header-probing
    pass; ``glob_filter`` keeps one prefix of a mixed folder (S2).
    """
    reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
    if columns is not None:
        reader = reader.schema(string_schema(columns))
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    return reader.csv(paths)


def read_csv_typed(spark: SparkSession, paths: str | list[str], schema: T.StructType,
                   sep: str = ",") -> DataFrame:
    """Typed CSV scan with a declared schema instead of inference."""
    return spark.read.option("header", True).option("sep", sep).schema(schema).csv(paths)


def read_csv_named(spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = ",",
                   name: str = "") -> DataFrame:
    """The columns of ``schema`` out of a wider CSV, bound by header name and cast; other columns are not parsed.

    Raises if one is missing; text that does not cast is NULL.
    """
    raw = read_csv_strings(spark, paths, sep)
    validate_columns(raw.columns, schema.fieldNames(), name)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """``df``, or an error if no input file holds a row in scope."""
    if df.isEmpty():
        raise ValueError(f"[{name}] no input file holds a row in scope")
    return df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_files(spark: SparkSession, pattern: str, suffix: str = "") -> list[str]:
    """Data files under a folder or glob (hidden and marker files skipped)."""
    fs, hpath = _fs(spark, pattern)
    statuses = fs.globStatus(hpath) or []
    out = []
    for st in statuses:
        stack = [st]
        while stack:
            s = stack.pop()
            if s.isDirectory():
                stack.extend(fs.listStatus(s.getPath()))
                continue
            name = s.getPath().getName()
            if name.startswith(("_", ".")) or not name.endswith(suffix):
                continue
            out.append(s.getPath().toString())
    return sorted(out)


def file_path() -> Column:
    """The file that a row is read from, as ``list_files`` names it (the metadata column is percent-encoded)."""
    return F.regexp_replace(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), "^file:/+", "file:/")


def file_catalogue(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file)``: every file listed, also empty ones, which a scan would not show."""
    return spark.createDataFrame([(re.sub("^file:/+", "file:/", p),) for p in paths], "file string")


def header_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file, header)``: the first line of every file that has one, found by Spark tasks.

    Rows of a file's first block are numbered as they are read; the least number of each file is found by a hash
    aggregate on numbers alone, and only those lines are kept. No file is opened on the driver.
    """
    lines = (spark.read.text(paths)
             .select("value", file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at")).where("block = 0"))
    first = lines.groupBy("file").agg(F.min("at").alias("at")).select("at")
    text = F.regexp_replace("value", r"^\uFEFF|\r$", "")
    return lines.join(first, "at", "left_semi").select("file", text.alias("header"))


def _names(header: str | Column, sep: str) -> Column:
    """The column names of a header line."""
    return F.transform(F.split(header, re.escape(sep)), lambda c: F.trim(F.regexp_replace(c, r'^\s*"+|"+\s*$', "")))


def header_catalogue(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """``(file, position, column_name)`` of every file of a drifting set (S4, S12); files without a header have no row."""
    heads = header_lines(spark, paths).where(F.col("header") != "")
    return heads.select("file", F.posexplode(_names("header", sep)).alias("position", "column_name"))


def header_layouts(spark: SparkSession, paths: list[str], sep: str) -> dict[tuple[str, ...], list[str]]:
    """The files of each layout. The driver gets a row per layout: names of columns, and of files as it has listed them."""
    rows = (header_lines(spark, paths).where(F.col("header") != "").groupBy(_names("header", sep).alias("names"))
            .agg(F.collect_list("file").alias("files")).collect())
    return {tuple(r["names"]): sorted(r["files"]) for r in rows}


def read_drifting(spark: SparkSession, paths: list[str], sep: str,
                  standardise: Callable[[DataFrame, set[str]], DataFrame]) -> DataFrame:
    """Read a drifting file set: one scan per header layout, aligned by name, unioned (S4, U1); files without a line have no rows.

    ``standardise(df, present_columns)`` maps one layout onto the target
    schema (typed NULLs for absent columns, first-present alternate names).
    """
    groups = header_layouts(spark, paths, sep) if paths else {}
    if not groups:
        raise ValueError("no input files")
    frames = [standardise(read_csv_strings(spark, files, sep, list(header)), set(header))
              for header, files in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_present(present: set[str], *names: str) -> str | None:
    """First of ``names`` present in a layout."""
    return next((n for n in names if n in present), None)


def column_or_null(present: set[str], name: str | None, dtype: str = "string", expr=None):
    """``expr(col)`` when the column exists in this layout, else a typed NULL."""
    if name is None or name not in present:
        return F.lit(None).cast(dtype)
    c = F.col(f"`{name}`")
    return expr(c) if expr is not None else c


def column_availability(catalogue: DataFrame, group: Column, groups: list[str]) -> DataFrame:
    """Column-by-group matrix of 1 and 0 out of ``header_catalogue`` (S12), for a known, short list of groups."""
    pairs = catalogue.select(group.alias("source"), "column_name").distinct()
    return pairs.groupBy("column_name").pivot("source", groups).agg(F.count(F.lit(1))).na.fill(0, subset=groups)


def rows_by_file(files: DataFrame, rows: DataFrame) -> DataFrame:
    """``(file, rows)`` of every file of ``file_catalogue``, zero where ``rows``, which carry their ``file``, has none."""
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    return files.select("file").join(counts, "file", "left").na.fill(0, subset=["rows"])
