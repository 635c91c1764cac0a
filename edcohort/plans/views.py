"""Stand-in views over the driver tables.

The driver tables are TPC-H-like; these views give them the shape of the
clinical inputs, so every operator runs over the whole tables:

  lab      <- events    long lab results (seq, patient, ts, code, result)
  visits   <- events    signups as ED visits (visit_id, nummer, Datum_SEH)
  cases    <- orders    visit registry with outcomes, vitals and history
  cohort   <- orders    validation cohort key pairs (nummer, Datum_SEH date)
  scored   <- lineitem  scored table (model, fold, y, p)
  raters   <- orders    two targets and four raters' binary calls

The same definitions exist as SQL text in ``oracle.VIEW_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

# The code catalogue of the lab stand-in, most frequent first.
LAB_CODES = (
    "HB", "LEUC", "TRC", "NA", "K", "KREA", "URESE", "CRP", "MREB", "BG",
    "GLUC", "ATYL", "KETUP", "DAT", "TOXK", "ARCHSE", "KP01", "ALAT", "CYTO", "LACT",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _fmt2(c):
    return F.format_string("%.2f", c)


def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    eid, val, et = F.col("event_id"), F.col("value"), F.col("event_type")
    idx = F.least(eid % 20, eid % 23)
    code = F.element_at(F.array(*[F.lit(c) for c in LAB_CODES]), (idx + 1).cast("int"))
    result = (
        F.when((et == "error") & (val < 60), F.lit(None).cast("string"))
        .when(code == "MREB", F.element_at(F.array(*[F.lit(x) for x in
                                                      ("Oke", "Positief", "Negatief", "troebel")]),
                                           (eid % 4 + 1).cast("int")))
        .when(code == "BG", F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("O")),
                                         (eid % 3 + 1).cast("int")))
        .when(code == "KETUP", F.element_at(F.array(F.lit("neg"), F.lit("+"), F.lit("++")),
                                            (eid % 3 + 1).cast("int")))
        .when(code.isin("ATYL", "TOXK"), F.repeat(F.lit("+"), (eid % 4).cast("int")))
        .when((et == "click") & (val < 40), F.concat(F.lit("< "), _fmt2(val)))
        .when((et == "view") & (val > 420), F.concat(F.lit(">"), _fmt2(val)))
        .when((et == "view") & (val < 10), F.concat(F.lit("< -"), _fmt2(val)))
        .when((et == "purchase") & (val < 15), F.lit("volgt"))
        .when((et == "signup") & (val < 8), F.concat(F.floor(val).cast("bigint").cast("string"),
                                                       F.lit("d")))
        .otherwise(_fmt2(val))
    )
    return ev.select(
        eid.alias("seq"), F.col("user_id").alias("patient"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"),
        code.alias("code"), result.alias("result"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("visit_id"), F.col("user_id").alias("nummer"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("Datum_SEH"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k, ck, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    day = F.to_date("o_orderdate")
    o2 = (F.when(k % 5 == 0, F.lit(None).cast("string"))
          .when(k % 5 == 1, F.concat((k % 15).cast("string"), F.lit("L per min")))
          .when(k % 5 == 2, F.lit("geen"))
          .when(k % 5 == 3, F.concat((k % 6).cast("string"), F.lit(" L/min")))
          .otherwise(F.lit("")))
    return o.select(
        k.alias("case_id"),
        ck.alias("nummer"),
        F.timestamp_add("MINUTE", k % 1440, F.col("o_orderdate")).alias("Datum_SEH"),
        F.date_sub(day, (((ck % 75) + 20) * 365 + ck % 365).cast("int")).alias("Geboortedatum"),
        (ck % 2).cast("int").alias("Geslacht"),
        F.when(k % 3 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(day, ((k % 60) - 3).cast("int"))).alias("Datum_overlijden"),
        (k % 7 == 0).cast("int").alias("septischeshock"),
        ((F.col("o_orderstatus") == "F") & (k % 4 == 0)).cast("int").alias("Sterfte_in_ziekenhuis"),
        (ck % 9 == 0).cast("int").alias("Comorb_dementie_Psychiatrisch"),
        (ck % 5 == 0).cast("int").alias("Comorb_infarct"),
        (ck % 6 == 0).cast("int").alias("Comorb_Hartfalen"),
        (ck % 4).cast("int").alias("Woonsituatie"),
        (ck % 11 == 0).cast("int").alias("metastase_of_chronische_ziekte_met_hoge_mortaliteit"),
        (ck % 12).cast("double").alias("Thuismedicatie_aantal"),
        (30 + k % 170).cast("double").alias("Pols"),
        (50 + (k * 7) % 150).cast("double").alias("RR_syst"),
        (25 + (k * 3) % 90).cast("double").alias("RR_diast"),
        (3 + k % 50).cast("double").alias("AF_berekend"),
        F.when(k % 13 == 0, F.lit(0.0)).otherwise((70 + k % 31).cast("double")).alias("Saturatie"),
        (35 + (k % 60) / 10.0).alias("Temperatuur"),
        (3 + k % 13).cast("double").alias("GCS_afgeleid"),
        (k % 3).cast("double").alias("WD"),
        o2.alias("zuurstoftherapie"),
        (price % 400).alias("TRC"),
        ((k % 300) / 10.0).alias("URESE"),
    )


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return (o.where(F.col("o_orderkey") % 150 == 0)
            .select(F.col("o_custkey").alias("nummer"), F.to_date("o_orderdate").alias("Datum_SEH"))
            .distinct())


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    p = (F.floor(F.col("l_extendedprice") * 100).cast("bigint") % 97) / F.lit(96.0)
    return li.select(
        F.col("l_linestatus").alias("model"),
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        p.alias("p"))


def scored_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored table with the price itself as the score."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_linestatus").alias("model"), (F.col("l_orderkey") % 5).cast("int").alias("fold"),
                     (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_extendedprice").cast("double").alias("p"))


RATERS = ("1", "2", "3", "4")
TARGETS = ("Shock", "Mortality")


def raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k, price, pri, st = (F.col("o_orderkey"), F.col("o_totalprice"),
                         F.col("o_orderpriority"), F.col("o_orderstatus"))
    b = lambda c: c.cast("int")
    return o.select(
        k.alias("Patient"),
        b(k % 7 == 0).alias("Shock"),
        b(st == "F").alias("Death"),
        b(price > 250000).alias("Shock_Int_1"),
        b(price > 300000).alias("Mortality_Int_1"),
        b(pri.isin("1-URGENT", "2-HIGH")).alias("Shock_Int_2"),
        b(pri == "1-URGENT").alias("Mortality_Int_2"),
        b(st == "O").alias("Shock_Int_3"),
        b((st == "F") & (k % 3 != 0)).alias("Mortality_Int_3"),
        b(k % 2 == 0).alias("Shock_Int_4"),
        b(F.col("o_custkey") % 2 == 0).alias("Mortality_Int_4"),
    )


# The header of a lab extract file.
EXTRACT_HEADER = ("Patientnummer", "UniekLabnummer", "Datum_tijd", "Testcode", "Resultaat", "Naam", "Geboortedatum")


def lab_extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, line): the lab stand-in as lines of yearly extract files, a few of them with a field too many (a second result),
    a field too few (no birth date), no patient, or a name with a Latin-1 letter."""
    d = lab(spark, sf_dir)
    k = F.col("seq")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    name = F.when(k % 5 == 0, "Müller").otherwise("Jansen")
    patient = F.when(k % 41 == 0, "").otherwise(text(F.col("patient")))
    fields = [patient, F.concat(F.lit("L"), k.cast("string")), F.date_format("ts", "dd-MM-yyyy HH:mm"), text(F.col("code")),
              text(F.col("result")), name]
    line = F.concat_ws(";", *fields)
    line = F.when(k % 97 == 0, line).when(k % 89 == 0, F.concat(line, F.lit(";01-01-1950;extra"))).otherwise(F.concat(line,
        F.lit(";01-01-1950")))
    return d.select(F.year("ts").alias("year"), line.alias("line"))


def write_lab_extracts(spark: SparkSession, sf_dir: str, out: str) -> list[str]:
    """The lines of ``lab_extract_lines`` as Latin-1 text files with headers, a folder per year; the folders, by year."""
    lines = lab_extract_lines(spark, sf_dir)
    years = sorted(r[0] for r in lines.select("year").distinct().collect())  # a row per calendar year
    for y in years:
        rows = lines.where(F.col("year") == y).select(F.col("line").alias(";".join(EXTRACT_HEADER)))
        # one column whose name is the header line; the separator of these files is a character that no line holds
        rows.write.option("header", True).option("sep", "\u0001").option("quote", "").option("encoding",
            "ISO-8859-1").csv(f"{out}/year={y}")
    return [f"{out}/year={y}" for y in years]


def write_visit_table(spark: SparkSession, sf_dir: str, out: str) -> str:
    """The visit stand-in as comma-separated UTF-8 files: date and clock time in two columns, every eleventh visit without a time, and a
    pulse that is a number for most; the folder."""
    v = visits(spark, sf_dir)
    k = F.col("visit_id")
    v.select("visit_id", F.col("nummer"), F.date_format("Datum_SEH", "yyyy-MM-dd").alias("Datum_SEH"),
             F.when(k % 11 != 0, F.date_format("Datum_SEH", "HH:mm")).alias("Uur_Binnenkomst_SEH"),
             F.when(k % 7 == 0, F.lit("onbekend")).otherwise((40 + k % 90).cast("string")).alias("Pols")
             ).withColumnRenamed("visit_id", "visit_no").write.option("header", True).csv(out)
    return out
