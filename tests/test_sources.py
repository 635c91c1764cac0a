"""Extract scans and dataset layout."""

import os
import tempfile

from pyspark.sql import functions as F

from edcohort.sources import datasets as ds
from edcohort.sources import extracts as ex


def _write(path, text, encoding):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_lab_extract_rules(spark):
    d = tempfile.mkdtemp(prefix="edcohort-test-")
    head = "Patientnummer;UniekLabnummer;Datum_tijd;Testcode;Resultaat;Naam;Geboortedatum;\n"
    body = ("1;A1;01-03-2020 08:00;HB;7.5;Jansen;01-01-1950;\n"
            "1;A2;01-03-2020 08:10;NA;140;Müller;01-01-1950;\n"    # Latin-1 letter
            "2;A3;31-02-2020 08:00;HB;7;X;01-01-1950;\n"           # invalid date -> NULL time
            ";A4;01-03-2020 08:00;HB;7;X;01-01-1950;\n"            # empty patient -> dropped
            "3;A5;01-03-2020 08:00;HB;;X;01-01-1950;\n"            # empty result kept
            "4;A6;01-03-2020 08:00;HB;1;X;01-01-1950;;extra\n"     # too many fields -> skipped
            "5;A7;01-03-2020 08:00\n")                             # too few -> kept, NULLs
    p1 = os.path.join(d, "y1.txt")
    _write(p1, head + body, "latin-1")
    p2 = os.path.join(d, "y2.txt")
    _write(p2, head + "6;B1;02-03-2020 09:00;K;4;Y;01-01-1960;\n", "latin-1")
    df = ex.read_lab_extract(spark, [p1, p2])
    assert {"seq", "patient", "labno", "ts", "code", "result"} <= set(df.columns)
    assert "Naam" not in df.columns and not any(c.startswith("_c") for c in df.columns)
    rows = {r.labno: r for r in df.collect()}
    assert set(rows) == {"A1", "A2", "A3", "A5", "A7", "B1"}
    assert rows["A3"].ts is None and rows["A5"].result is None and rows["A7"].code is None
    order = [r.labno for r in df.orderBy("seq").collect()]
    assert order == ["A1", "A2", "A3", "A5", "A7", "B1"]


def test_versioned_dataset_roundtrip(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="edcohort-test-"), "models")
    assert ds.latest_version_number(spark, root) == 0
    a = spark.createDataFrame([(1, 0, 1.0)], "case_id long, y_var int, x double")
    ds.write_data_model({"main": a, "validation": a.limit(0)}, root, version=1, model=1, out=3)
    ds.commit_version(spark, root, 1)
    b = spark.createDataFrame([(2, 1, 2.0)], "case_id long, y_var int, x double")
    ds.write_data_model({"main": b}, root, version=2, model=1, out=3)
    ds.commit_version(spark, root, 2)
    assert ds.latest_version_number(spark, root) == 2
    assert [r.case_id for r in ds.read_data_model(spark, root, model=1, out=3).collect()] == [2]
    assert [r.case_id for r in ds.read_data_model(spark, root, model=1, out=3, version=1).collect()] == [1]


def test_parameter_lookup(spark):
    t = spark.createDataFrame([("gbt", 1, 1, 3, 3, "a"), ("gbt", 2, 1, 3, 3, "b"), ("gbt", 1, 2, 3, 3, "c")],
                              "algorithm string, algo_version int, model_version int, data_model int, "
                              "out int, params string")
    r = ds.hyper_parameters(t, algorithm="gbt", model_version=1, data_model=3, out=3).first()
    assert r.params == "b"
    r = ds.hyper_parameters(t, algorithm="gbt", model_version=1, data_model=3, out=3, algo_version=1).first()
    assert r.params == "a"


def test_rater_sheet(spark):
    d = tempfile.mkdtemp(prefix="edcohort-test-")
    p = os.path.join(d, "raters.csv")
    lines = ["title,,,,,,,,,,", ",".join(f"h{i}" for i in range(11))]
    lines += [",".join(str((i + j) % 2) if j else str(i) for j in range(11)) for i in range(150)]
    _write(p, "\n".join(lines) + "\n", "utf-8")
    assert ex.read_rater_sheet(spark, p).count() == 150   # whole sheet by default
    df = ex.read_rater_sheet(spark, p, n_rows=100)
    assert df.columns == ex.RATER_SHEET_COLUMNS
    assert df.count() == 100
    assert df.agg(F.max("Patient")).first()[0] == 99


def test_visit_scan_default_time(spark):
    import datetime as dt
    d = tempfile.mkdtemp(prefix="edcohort-test-")
    p = os.path.join(d, "visits.csv")
    _write(p, "nummer,Datum_SEH,Uur_Binnenkomst_SEH,Pols\n"
              "7,2020-01-02,13:45,88\n8,2020-01-03,,x\n9,2020-01-04,08:15:30,70.5\n", "utf-8")
    rows = {r.nummer: r for r in ex.read_visits(spark, p, numeric=["Pols"]).collect()}
    assert rows[7].Datum_SEH == dt.datetime(2020, 1, 2, 13, 45) and rows[7].Pols == 88.0
    assert rows[8].Datum_SEH == dt.datetime(2020, 1, 3, 7, 0) and rows[8].Pols is None
    assert rows[9].Datum_SEH == dt.datetime(2020, 1, 4, 8, 15, 30)


def test_derive_export_and_evaluate(spark):
    from edcohort.plans import views as V
    from edcohort.plans.derive import derive_and_export
    from edcohort.plans.evaluate import cross_validate
    from edcohort.plans.queries import AS_OF, CASE_FEATURES, CASE_LABS
    from edcohort.operators import learn as le
    sf = "/root/testdata/sf0.001"
    root = os.path.join(tempfile.mkdtemp(prefix="edcohort-test-"), "models")
    cases = V.cases(spark, sf)
    v = derive_and_export(cases, V.cohort(spark, sf), root, models=(1, 3), out=3, as_of=AS_OF,
                          lab_columns=CASE_LABS, features=CASE_FEATURES)
    assert v == 1
    main = ds.read_data_model(spark, root, model=3, out=3, split="main")
    val = ds.read_data_model(spark, root, model=3, out=3, split="validation")
    assert main.count() + val.count() == cases.count()
    assert "nummer" not in main.columns and "y_var" in main.columns
    feats = [c for c in main.columns if c not in ("case_id", "y_var")]
    res = cross_validate(main, feats, le.logistic, name="logistic", k=3)
    s = res["summary"].first()
    assert 0.0 <= s.mean_auc <= 1.0


def test_versions_are_claimed_and_committed(spark):
    """An export that died is never read, its number is not used again, and two writers get two numbers."""
    import pytest
    root = os.path.join(tempfile.mkdtemp(prefix="edcohort-test-"), "models")
    df = spark.createDataFrame([(1, 0)], "case_id long, y_var int")
    one, two = ds.claim_version(spark, root), ds.claim_version(spark, root)
    assert (one, two) == (1, 2)
    ds.write_data_model({"main": df}, root, version=two, model=1, out=3)   # and dies before the second model
    assert ds.latest_version_number(spark, root) == 0 and ds.abandoned_versions(spark, root) == [1, 2]
    ds.write_data_model({"main": df}, root, version=one, model=1, out=3)
    ds.commit_version(spark, root, one)
    assert ds.committed_versions(spark, root) == [1] and ds.read_data_model(spark, root, model=1, out=3).count() == 1
    with pytest.raises(FileNotFoundError, match="no committed version 2"):
        ds.read_data_model(spark, root, model=1, out=3, version=2)
    assert ds.claim_version(spark, root) == 3
    for taken in (1, 2, 3):
        with pytest.raises(FileExistsError):
            ds.claim_version(spark, root, taken)
    with pytest.raises(FileExistsError, match="committed already"):
        ds.commit_version(spark, root, 1)


def test_two_writers_at_once(spark):
    from concurrent.futures import ThreadPoolExecutor
    root = os.path.join(tempfile.mkdtemp(prefix="edcohort-test-"), "p")
    df = spark.createDataFrame([(1, 0)], "case_id long, y_var int")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: ds.write_processed(df, root), range(4)))
    assert sorted(got) == [1, 2, 3, 4] == ds.committed_versions(spark, root)


def test_step_audit(spark):
    """Counts of each step equal separate counts, and are kept with the version."""
    from edcohort.operators import presentations as pr
    from edcohort.operators.audit import StepAudit
    from edcohort.plans import views as V
    from edcohort.plans.build import build_processed_table
    sf = "/root/testdata/sf0.001"
    lab, visits = V.lab(spark, sf), V.visits(spark, sf)
    root = os.path.join(tempfile.mkdtemp(prefix="edcohort-test-"), "p")
    audit = StepAudit()
    ds.write_processed(build_processed_table(lab, visits, audit=audit), root, audit=audit)
    got = {r.step: r for r in ds.read_steps(spark, root).collect()}
    allowed = pr.deny_filter(lab)
    frequent = pr.top_fraction_filter(allowed, fraction=0.80)
    grouped = pr.anchor_times(frequent)
    first = pr.dedup_first(pr.normalise(grouped))
    wide = pr.build_presentations(lab)
    want = {"lab results": lab, "allowed codes": allowed, "frequent codes": frequent, "grouped times": grouped, "first results": first,
            "presentations": wide, "visits": visits, "written": ds.read_processed(spark, root)}
    assert [r.step for r in sorted(got.values(), key=lambda r: r.position)] == list(want)
    for name, df in want.items():
        assert (got[name].n_rows, got[name].n_columns) == (df.count(), len(df.columns)), name


def test_quarantine(spark):
    d = tempfile.mkdtemp(prefix="edcohort-test-")
    p = os.path.join(d, "y1.txt")
    _write(p, "A;B;C\n1;2;3\n4;5;6;\n7;é;9;10\n11;12\n13;;15\n14;\"x;y\";16\n", "latin-1")
    rows, odd = ex.scan_delimited(spark, p, sep=";", encoding="ISO-8859-1")
    assert [(r.A, r.B, r.C) for r in rows.orderBy("seq").collect()] == [("1", "2", "3"), ("11", "12", None), ("13", None, "15"), ("14", "x;y", "16")]
    got = [(r.file, r.line, r.n_fields, r.reason, r.used) for r in odd.orderBy("seq").collect()]
    assert got == [("y1.txt", "4;5;6;", 4, ex.TOO_MANY_FIELDS, False), ("y1.txt", "7;é;9;10", 4, ex.TOO_MANY_FIELDS, False),
                   ("y1.txt", "11;12", 2, ex.TOO_FEW_FIELDS, True)]
    assert ex.lab_quarantine(spark, [p, p]).groupBy("reason").count().count() == 2
