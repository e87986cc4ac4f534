"""Locate and scan the yearly `|`-delimited raw files.

Every column is read as text so that leading zeros in codes survive. Files are read as
lines of bytes: a line that is no UTF-8, or has another number of fields than its header,
is set aside with its file and the reason, and no part of it is loaded. Files with equal
headers are one scan, however many they are; columns are taken by name, so files may
order them differently.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landsales.schemas import RAW_COLUMNS
from landsales.sources.fs import data_files, exists, first_line, list_dir

# Columns of a line that is set aside: why, its file, and its text (bad bytes as U+FFFD).
REASON, FILE, LINE = "_reason", "_file", "_line"
BAD_BYTES, BAD_FIELDS = "encoding", "fields"

# Fixed value: the word every yearly raw file name contains (any case).
RAW_FILE_WORD = "valeursfoncieres"


def year_marker(year: int) -> str:
    """Canonical manifest name of a year's raw file (fixed naming scheme)."""
    return f"{RAW_FILE_WORD}-{year}.txt"


def find_year_file(folder: str, year: int) -> str | None:
    """S3: first `*.txt` entry whose name has the year and the raw-file word."""
    for entry in list_dir(folder):
        if entry.name.endswith(".txt") and str(year) in entry.name \
                and RAW_FILE_WORD in entry.name.lower():
            return entry.path
    return None


def collect_year_files(folder: str, years: list[int], log=print) -> dict[int, str]:
    """{year: path} for the years found; missing years are reported and skipped."""
    found = {}
    for year in years:
        path = find_year_file(folder, year)
        if path is None:
            log(f"[ERROR] no raw file for {year}, skipping")
        else:
            found[year] = path
    return found


def header_of(path: str, quote: str | None = None) -> list[str]:
    """Column names from a file's first line (read on the driver: one line)."""
    line = first_line(path)
    if line is None:
        raise FileNotFoundError(path)
    names = line.split("|")
    if quote:
        names = [n[1:-1] if len(n) > 1 and n[0] == n[-1] == quote else n for n in names]
    missing = [c for c in RAW_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{path}: missing required column(s) {missing}")
    return names


def by_header(paths: list[str], quote: str | None = None) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header; a folder is its files, or stands for them if they agree."""
    files = {path: [e.path for e in data_files(path) if e.size] for path in paths}
    missing = [path for path in paths if not files[path] and not exists(path)]
    if missing:
        raise FileNotFoundError(missing[0])
    with ThreadPoolExecutor(max_workers=16) as pool:
        each = [f for found in files.values() for f in found]
        headers = dict(zip(each, pool.map(lambda f: tuple(header_of(f, quote)), each)))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, found in files.items():
        own = {headers[f] for f in found}
        for f in [path] if len(own) == 1 else found:
            groups.setdefault(next(iter(own)) if len(own) == 1 else headers[f], []).append(f)
    return groups


def with_file(lines: DataFrame) -> DataFrame:
    """Lines (value) with the file that each comes from."""
    return lines.select("value", F.col("_metadata.file_path").alias(FILE))


def parse_lines(lines: DataFrame, header: list[str], quote: str | None = None) -> DataFrame:
    """S1+S2: the 18 used columns by name, and REASON, FILE and LINE of lines set aside (null
    otherwise). ``lines`` has value and FILE. Header and blank lines are no rows."""
    text = F.when(F.col("value").startswith("\ufeff"), F.expr("substring(value, 2)")).otherwise(F.col("value"))
    names = "|".join(header)
    quoted = "|".join(f"{quote}{n}{quote}" for n in header) if quote else names
    rows = lines.where(~text.isin(names, quoted) & (F.trim("value") != ""))
    if quote:
        schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(header))]
                              + [T.StructField("bad", T.StringType())])
        options = {"sep": "|", "quote": quote, "escape": "\\", "columnNameOfCorruptRecord": "bad"}
        rows = rows.withColumn("_f", F.from_csv(text, schema.simpleString()[7:-1].replace(":", " "), options))
        ragged = F.col("_f.bad").isNotNull()

        def field(k: int) -> Column:
            return F.col(f"_good.c{k}")
    else:
        rows = rows.withColumn("_f", F.split(text, r"\|", -1))
        # counted in bytes, not in the split line: a filter on REASON is pushed below the split, and
        # would split every line once more
        bars = F.octet_length("value") - F.octet_length(F.replace("value", F.lit("|"), F.lit("")))
        ragged = bars != len(header) - 1

        def field(k: int) -> Column:
            return F.nullif(F.get(F.col("_good"), F.lit(k)), F.lit(""))

    reason = F.when(~F.is_valid_utf8("value"), BAD_BYTES).when(ragged, BAD_FIELDS)
    rows = rows.withColumn(REASON, reason)
    good = F.col(REASON).isNull()
    rows = rows.withColumn("_good", F.when(good, F.col("_f")))
    return rows.select(*[field(header.index(c)).alias(c) for c in RAW_COLUMNS], REASON,
                       F.when(~good, F.col(FILE)).alias(FILE),
                       F.when(~good, F.make_valid_utf8("value")).alias(LINE))


def read_lines(spark: SparkSession, paths: list[str], quote: str | None = None) -> DataFrame:
    """S1 + U1: all files, one scan per group of equal headers, unioned by column name, with
    the lines set aside (see ``parse_lines``)."""
    if not paths:
        raise ValueError("no raw file to read")
    out = None
    for header, group in by_header(paths, quote).items():
        frame = parse_lines(with_file(spark.read.text(group)), list(header), quote)
        out = frame if out is None else out.unionByName(frame)
    return out


def read_raw_files(spark: SparkSession, paths: list[str], quote: str | None = None) -> DataFrame:
    """The raw rows of all files, without the lines set aside."""
    return read_lines(spark, paths, quote).where(F.col(REASON).isNull()).select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])
