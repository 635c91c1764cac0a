"""Visit matching, cohort split and clinical derivations."""

import datetime as dt

from pyspark.sql import functions as F

from edcohort.functions import clinical as cl
from edcohort.functions import scores as sc
from edcohort.functions.parsing import leading_token_number
from edcohort.operators import cohort as co

A = dt.datetime(2020, 3, 1, 22, 0)


def test_visit_match_strict_range_and_uniqueness(spark):
    visits = spark.createDataFrame([(1, 10, A), (2, 11, A), (3, 12, A)],
                                   "visit_id long, nummer long, Datum_SEH timestamp_ntz")
    pres = spark.createDataFrame([
        (10, A + dt.timedelta(minutes=899), 1.0),          # inside, next day
        (11, A + dt.timedelta(minutes=900), 2.0),          # end is exclusive
        (11, A, 3.0),                                      # start is exclusive
        (12, A + dt.timedelta(minutes=5), 4.0), (12, A + dt.timedelta(minutes=6), 5.0),  # two hits
    ], "patient long, anchor timestamp_ntz, lab_HB double")
    out = co.match_visits(visits, pres).collect()
    assert [(r.visit_id, r.lab_HB) for r in out] == [(1, 1.0)]
    audit = {r.visit_id: r.hits for r in co.match_audit(visits, pres).collect()}
    assert audit == {1: 1, 2: 0, 3: 2}


def test_validation_split_pair_key(spark):
    df = spark.createDataFrame([(1, 7, dt.datetime(2020, 1, 1, 9)), (2, 7, dt.datetime(2020, 1, 5, 9)),
                                (3, 8, dt.datetime(2020, 1, 1, 9))],
                               "case_id long, nummer long, Datum_SEH timestamp_ntz")
    cohort = spark.createDataFrame([(7, dt.date(2020, 1, 1))], "nummer long, Datum_SEH date")
    main, val = co.validation_split(df, cohort)
    assert sorted(r.case_id for r in val.collect()) == [1]
    assert sorted(r.case_id for r in main.collect()) == [2, 3]


def test_outcome_horizon_boundaries(spark):
    arr = dt.datetime(2020, 1, 10, 15, 0)
    deaths = [None, dt.date(2020, 1, 10), dt.date(2020, 1, 9), dt.date(2020, 2, 10),
              dt.date(2020, 2, 11), dt.date(2020, 2, 12)]
    df = spark.createDataFrame([(i, arr, d) for i, d in enumerate(deaths)],
                               "i int, Datum_SEH timestamp_ntz, Datum_overlijden date")
    got = [r.y for r in df.orderBy("i").select(
        "i", cl.outcome_within("Datum_overlijden", "Datum_SEH", 31).alias("y")).collect()]
    # same day -0.6 d -> -1 (in), day before -1.6 -> -2 (out), +30.4 -> 30, +31.4 -> 31 (in), +32.4 out
    assert got == [0, 1, 0, 1, 1, 0]


def test_age_hour_and_oxygen(spark):
    df = spark.createDataFrame([(dt.date(1950, 6, 15), dt.datetime(2020, 1, 1, 13, 30), "2L per min"),
                                (dt.date(1950, 6, 16), dt.datetime(2020, 1, 1, 0, 0), "geen")],
                               "b date, t timestamp_ntz, o string")
    r = df.select(cl.age_years("b", "2000-06-15").alias("age"), cl.hour_fraction("t").alias("h"),
                  cl.hour_fraction("t", corrected=True).alias("hc"),
                  leading_token_number("o").alias("o2")).collect()
    # 18263 days = 50.003 years -> 50; one day less = 49.9999 -> 49
    assert r[0].age == 50 and r[1].age == 49
    assert r[0].h == (13 + 30) / 60 and r[0].hc == 13.5 and r[0].o2 == 2.0
    assert r[1].o2 is None


def test_scores_band_edges(spark):
    row = dict(Geboortedatum=65, Comorb_dementie_Psychiatrisch=0, URESE=7.5, AF_berekend=30,
               RR_syst=89, RR_diast=60, Woonsituatie=2, TRC=150, septischeshock=1,
               metastase_of_chronische_ziekte_met_hoge_mortaliteit=0, Pols=110, Saturatie=0,
               GCS_afgeleid=13, WD=2)
    df = spark.createDataFrame([row])
    r = df.select(sc.curb().alias("curb"), sc.meds().alias("meds"), sc.abbmeds().alias("abb"),
                  sc.mrems().alias("mrems"), sc.risk_score("CURB").alias("cr")).first()
    assert r.curb == 3          # urea, age, syst (diast 60 is not < 60)
    assert r.meds == 3 + 3 + 2 + 3
    assert r.abb == 3 + 3 + 3 + 2 + 2
    # age 65 -> 5, pulse 110 -> 2, resp 30 -> 1, MAP 69.67 -> 2, sat 0 -> 0, GCS 13 -> 1
    assert r.mrems == 5 + 2 + 1 + 2 + 0 + 1
    assert r.cr == 0.22
