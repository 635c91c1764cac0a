"""Delimited extracts: lab results (S1, T4, P1-P3), visit table (S2), rater sheet."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import DEFAULT_TIME, date_and_time, parse_date, parse_timestamp, safe_double

NAMELESS = re.compile(r"^(_c\d+|Unnamed.*)$")

# Identifying or unused extract columns that are dropped.
DROPPED_LAB_COLUMNS = ("Naam", "Geboortedatum", "Partnernaam", "Geslacht", "Overleden",
                       "Artscode", "Afdeling", "Opmerkingrapport", "Artsnaam", "Labnummer")
# Source column -> canonical name of the lab operators.
LAB_RENAMES = {"Patientnummer": "patient", "UniekLabnummer": "labno", "Datum_tijd": "ts",
               "Testcode": "code", "Resultaat": "result"}


def _header(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    return (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
            .csv(path).columns)


#: Why a line is not used (``scan_delimited``).
TOO_MANY_FIELDS, TOO_FEW_FIELDS = "too many fields", "too few fields"


def scan_delimited(spark: SparkSession, path: str, *, sep: str, encoding: str, file_no: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of an extract, all columns as text.

    Lines with more fields than the header, empty ones included, are not used (as the source's ``error_bad_lines=False``); lines
    with fewer fields keep NULLs.  ``seq`` = file number and position in one number keeps the file order for "first row" rules.
    The quarantine has (file, seq, line, n_fields, reason, used) of each line whose field count differs from the header's; ``used`` ones are
    in the rows too.  Both are read in one kind of scan; nothing is written."""
    names = _header(spark, path, sep, encoding)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])
    df = (spark.read.schema(schema).option("header", True).option("sep", sep)
          .option("columnNameOfCorruptRecord", "_line")   # the raw line, if its field count differs;
          .option("columnPruning", "false")                # fields are counted whatever is read later
          .option("encoding", encoding).option("mode", "PERMISSIVE").csv(path))
    fields = F.size(F.split(F.regexp_replace("_line", '"[^"]*"', ""), re.escape(sep)))
    seq = F.lit(file_no).cast("bigint") * F.lit(1 << 53) + F.monotonically_increasing_id()
    df = df.select(*[F.col(f"`{n}`") for n in names], "_line", seq.alias("seq"), F.col("_metadata.file_name").alias("_file"))
    rows = df.where(F.col("_line").isNull() | (fields <= len(names))).drop("_line", "_file")
    # Spark refuses a scan that needs the raw line only; the second test always holds and needs a field
    odd = df.where(F.col("_line").isNotNull() & (F.length(F.concat_ws("", F.col(f"`{names[0]}`"), "_line")) >= 0)).select(
        F.col("_file").alias("file"), "seq", F.col("_line").alias("line"), fields.alias("n_fields"),
        F.when(fields > len(names), TOO_MANY_FIELDS).otherwise(TOO_FEW_FIELDS).alias("reason"), (fields <= len(names)).alias("used"))
    return rows, odd


def read_delimited(spark: SparkSession, path: str, *, sep: str, encoding: str, file_no: int = 0) -> DataFrame:
    """The rows of ``scan_delimited``."""
    return scan_delimited(spark, path, sep=sep, encoding=encoding, file_no=file_no)[0]


def lab_quarantine(spark: SparkSession, paths: Sequence[str], *, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """The quarantine of all extracts of ``read_lab_extract``."""
    out = None
    for i, p in enumerate(paths):
        q = scan_delimited(spark, p, sep=sep, encoding=encoding, file_no=i)[1]
        out = q if out is None else out.unionByName(q)
    return out


def read_lab_extract(spark: SparkSession, paths: Sequence[str], *, sep: str = ";",
                     encoding: str = "ISO-8859-1", ts_format: str = "dd-MM-yyyy HH:mm",
                     date_format: str = "dd-MM-yyyy") -> DataFrame:
    """S1 + T4 + F1 + P1 + P2 + P3: yearly extracts -> (seq, patient, labno, ts, code, result)."""
    frames = [read_delimited(spark, p, sep=sep, encoding=encoding, file_no=i)
              for i, p in enumerate(paths)]
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f, allowMissingColumns=True)
    df = df.select([c for c in df.columns if not NAMELESS.match(c)])                     # P1
    if "Datum_tijd" in df.columns:
        df = df.withColumn("Datum_tijd", parse_timestamp("Datum_tijd", ts_format))       # F1
    for c in ("Geboortedatum", "Overleden"):
        if c in df.columns:
            df = df.withColumn(c, parse_date(c, date_format))
    df = df.drop(*[c for c in DROPPED_LAB_COLUMNS if c in df.columns])                   # P2
    df = df.withColumn("Patientnummer", safe_double("Patientnummer").cast("bigint"))
    df = df.na.drop(subset=["Patientnummer"])                                             # P3
    return df.withColumnsRenamed({k: v for k, v in LAB_RENAMES.items() if k in df.columns})


def read_visits(spark: SparkSession, path: str, *, numeric: Sequence[str] = (),
                date_col: str = "Datum_SEH", time_col: str = "Uur_Binnenkomst_SEH",
                key: str = "nummer", visit_key: str = "visit_id",
                dates: Sequence[str] = ("Geboortedatum", "Datum_overlijden")) -> DataFrame:
    """S2 + F2: comma CSV (UTF-8); a missing clock time becomes 07:00:00, arrival = date + clock
    time; ``numeric`` columns parsed as doubles, ``dates`` as dates; ``visit_id`` numbers the rows
    from 0 in file order."""
    from ..operators.ordinal import global_ordinal
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    df = df.withColumn("_pos", F.monotonically_increasing_id())
    df = global_ordinal(df, order_by=["_pos"], name=visit_key).drop("_pos")
    df = df.withColumn(time_col, F.coalesce(F.col(time_col), F.lit(DEFAULT_TIME)))
    df = df.withColumn(date_col, date_and_time(date_col, time_col))
    df = df.withColumns({c: F.coalesce(F.to_date(F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd"))), parse_date(c))
                         for c in dates if c in df.columns})
    df = df.withColumn(key, safe_double(key).cast("bigint"))
    return df.withColumns({c: safe_double(c) for c in numeric if c in df.columns})


# Rater sheet layout (two targets per rater, four raters).
RATER_SHEET_COLUMNS = ["Patient", "Shock", "Death"] + list(chain.from_iterable(
    [f"Shock_Int_{x}", f"Mortality_Int_{x}"] for x in range(1, 5)))


def read_rater_sheet(spark: SparkSession, path: str, *, n_rows: int | None = None,
                     skip_rows: int = 1) -> DataFrame:
    """S4 + T3: skip ``skip_rows`` lines and the header, name the columns, keep
    the first ``n_rows`` data rows by position (all of them by default)."""
    from ..operators.ordinal import global_ordinal
    raw = (spark.read.option("header", False).csv(path)
           .withColumn("_pos", F.monotonically_increasing_id()))
    raw = global_ordinal(raw, order_by=["_pos"], name="_row")
    data = raw.where(F.col("_row") > skip_rows)
    if n_rows is not None:
        data = data.where(F.col("_row") <= skip_rows + n_rows)
    cols = [c for c in data.columns if c not in ("_pos", "_row")][:len(RATER_SHEET_COLUMNS)]
    return data.select(*[safe_double(c).cast("int").alias(n)
                         for c, n in zip(cols, RATER_SHEET_COLUMNS)])
