"""DuckDB SQL for the correctness oracle.

Independent SQL formulations of every registered query over the same driver
tables.  ``VIEW_SQL`` mirrors ``views.py``; each query is a WITH-list of the
views it needs followed by its own SQL.  Timestamps are compared as
'yyyy-MM-dd HH:mm:ss' text and doubles are rounded to 6 places in both engines.
"""

from __future__ import annotations

from .views import LAB_CODES

# Fixed values of the source, written here once more so that a wrong entry in the library shows:
# codes that are dropped, codes with texts, texts that mean negative, codes whose presence is 1, codes that count
# plus signs, and the patterns of a number and of the first number in a text.
DENY_CODES = ("ARCHSE", "ARCHFL", "ARCHDA", "ARCHUR", "ARCHZE", "ATLAS", "TRE", "STOL", "CARDIOPL", "CARDIOSE", "ALLSTR", "ARCHDA2",
              "ARCHEP", "ARCHZE2", "ASFAC", "ASTEKST", "BSPTX", "CYTO", "EXTRA1", "MATPOC", "WOPM")
CATEGORICAL_CODES = ("ASTYP", "ALLIND", "ASNMA", "BG", "BRC", "BGRH", "RH", "DIF", "IRA", "KETUP", "GRTUP", "SLEUUP", "UGLUP",
                     "SERYUP", "NITUP", "PROUP", "BACUP", "MREB", "Afdeling", "Geslacht", "ISE", "LSE", "HSE", "LASP", "RHFK")
MAPPED_NEGATIVE_TEXTS = ("Oke", "Niet afwijkend", "Negatief")
PRESENCE_CODES = ("DAT", "SEDUP", "DYSEUP", "KP01", "KP02", "LASLI", "POIK")
PLUS_COUNT_CODES = ("ATYL", "FRAG", "TOXK")
NUMERIC_PATTERN = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
FIRST_NUMBER_PATTERN = r"[-+]?\d*\.\d+|\d+"


def _list(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


def ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


VIEW_SQL = {
    "lab": f"""
SELECT event_id AS seq, user_id AS patient, date_trunc('minute', ts) AS ts,
  ([{_list(LAB_CODES)}])[least(event_id % 20, event_id % 23) + 1] AS code,
  CASE
    WHEN event_type = 'error' AND value < 60 THEN NULL
    WHEN ([{_list(LAB_CODES)}])[least(event_id % 20, event_id % 23) + 1] = 'MREB'
      THEN (['Oke', 'Positief', 'Negatief', 'troebel'])[event_id % 4 + 1]
    WHEN ([{_list(LAB_CODES)}])[least(event_id % 20, event_id % 23) + 1] = 'BG'
      THEN (['A', 'B', 'O'])[event_id % 3 + 1]
    WHEN ([{_list(LAB_CODES)}])[least(event_id % 20, event_id % 23) + 1] = 'KETUP'
      THEN (['neg', '+', '++'])[event_id % 3 + 1]
    WHEN ([{_list(LAB_CODES)}])[least(event_id % 20, event_id % 23) + 1] IN ('ATYL', 'TOXK')
      THEN repeat('+', CAST(event_id % 4 AS INTEGER))
    WHEN event_type = 'click' AND value < 40 THEN '< ' || printf('%.2f', value)
    WHEN event_type = 'view' AND value > 420 THEN '>' || printf('%.2f', value)
    WHEN event_type = 'view' AND value < 10 THEN '< -' || printf('%.2f', value)
    WHEN event_type = 'purchase' AND value < 15 THEN 'volgt'
    WHEN event_type = 'signup' AND value < 8 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || 'd'
    ELSE printf('%.2f', value)
  END AS result
FROM events""",
    "visits": """
SELECT event_id AS visit_id, user_id AS nummer, date_trunc('minute', ts) AS Datum_SEH
FROM events WHERE event_type = 'signup'""",
    "cases": """
SELECT o_orderkey AS case_id, o_custkey AS nummer,
  o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS Datum_SEH,
  CAST(o_orderdate AS DATE) - CAST(((o_custkey % 75) + 20) * 365 + o_custkey % 365 AS INTEGER) AS Geboortedatum,
  CAST(o_custkey % 2 AS INTEGER) AS Geslacht,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL
       ELSE CAST(o_orderdate AS DATE) + CAST((o_orderkey % 60) - 3 AS INTEGER) END AS Datum_overlijden,
  CAST(o_orderkey % 7 = 0 AS INTEGER) AS septischeshock,
  CAST(o_orderstatus = 'F' AND o_orderkey % 4 = 0 AS INTEGER) AS Sterfte_in_ziekenhuis,
  CAST(o_custkey % 9 = 0 AS INTEGER) AS Comorb_dementie_Psychiatrisch,
  CAST(o_custkey % 5 = 0 AS INTEGER) AS Comorb_infarct,
  CAST(o_custkey % 6 = 0 AS INTEGER) AS Comorb_Hartfalen,
  CAST(o_custkey % 4 AS INTEGER) AS Woonsituatie,
  CAST(o_custkey % 11 = 0 AS INTEGER) AS metastase_of_chronische_ziekte_met_hoge_mortaliteit,
  CAST(o_custkey % 12 AS DOUBLE) AS Thuismedicatie_aantal,
  CAST(30 + o_orderkey % 170 AS DOUBLE) AS Pols,
  CAST(50 + (o_orderkey * 7) % 150 AS DOUBLE) AS RR_syst,
  CAST(25 + (o_orderkey * 3) % 90 AS DOUBLE) AS RR_diast,
  CAST(3 + o_orderkey % 50 AS DOUBLE) AS AF_berekend,
  CASE WHEN o_orderkey % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(70 + o_orderkey % 31 AS DOUBLE) END AS Saturatie,
  35 + CAST(o_orderkey % 60 AS DOUBLE) / 10 AS Temperatuur,
  CAST(3 + o_orderkey % 13 AS DOUBLE) AS GCS_afgeleid,
  CAST(o_orderkey % 3 AS DOUBLE) AS WD,
  CASE o_orderkey % 5 WHEN 0 THEN NULL
    WHEN 1 THEN CAST(o_orderkey % 15 AS VARCHAR) || 'L per min'
    WHEN 2 THEN 'geen'
    WHEN 3 THEN CAST(o_orderkey % 6 AS VARCHAR) || ' L/min'
    ELSE '' END AS zuurstoftherapie,
  o_totalprice % 400 AS TRC,
  CAST(o_orderkey % 300 AS DOUBLE) / 10 AS URESE
FROM orders""",
    "cohort": """
SELECT DISTINCT o_custkey AS nummer, CAST(o_orderdate AS DATE) AS Datum_SEH
FROM orders WHERE o_orderkey % 150 = 0""",
    "scored": """
SELECT l_linestatus AS model, CAST(l_orderkey % 5 AS INTEGER) AS fold,
  CAST(l_returnflag = 'R' AS INTEGER) AS y,
  CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) % 97 AS DOUBLE) / CAST(96 AS DOUBLE) AS p
FROM lineitem""",
    "raters": """
SELECT o_orderkey AS Patient,
  CAST(o_orderkey % 7 = 0 AS INTEGER) AS Shock,
  CAST(o_orderstatus = 'F' AS INTEGER) AS Death,
  CAST(o_totalprice > 250000 AS INTEGER) AS Shock_Int_1,
  CAST(o_totalprice > 300000 AS INTEGER) AS Mortality_Int_1,
  CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS Shock_Int_2,
  CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS Mortality_Int_2,
  CAST(o_orderstatus = 'O' AS INTEGER) AS Shock_Int_3,
  CAST(o_orderstatus = 'F' AND o_orderkey % 3 <> 0 AS INTEGER) AS Mortality_Int_3,
  CAST(o_orderkey % 2 = 0 AS INTEGER) AS Shock_Int_4,
  CAST(o_custkey % 2 = 0 AS INTEGER) AS Mortality_Int_4
FROM orders""",
}

# ---------------------------------------------------------------- build CTEs
NUMERIC_SQL = NUMERIC_PATTERN
FIRST_NUMBER_SQL = FIRST_NUMBER_PATTERN


def guarded_double(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{NUMERIC_SQL}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"


BUILD_CTES = {
    "lab_f": f"""
SELECT * FROM lab WHERE code NOT IN ({_list(DENY_CODES)})""",
    "top": """
SELECT code FROM (
  SELECT code, row_number() OVER (ORDER BY n DESC, code) AS rk, count(*) OVER () AS nc
  FROM (SELECT code, count(*) AS n FROM lab_f GROUP BY code))
WHERE rk <= round_even(nc * 0.8, 0)""",
    "lab_t": """
SELECT * FROM lab_f WHERE code IN (SELECT code FROM top)""",
    "t": """
SELECT patient, ts, row_number() OVER (PARTITION BY patient ORDER BY ts) AS rn
FROM (SELECT DISTINCT patient, ts FROM lab_t WHERE patient IS NOT NULL AND ts IS NOT NULL)""",
    "r": """
SELECT patient, rn, ts, ts AS anchor, 1 AS keep FROM t WHERE rn = 1
UNION ALL
SELECT t.patient, t.rn, t.ts,
  CASE WHEN date_diff('minute', r.anchor, t.ts) > 1440 THEN t.ts ELSE r.anchor END,
  CASE WHEN date_diff('minute', r.anchor, t.ts) <= 120
         OR date_diff('minute', r.anchor, t.ts) > 1440 THEN 1 ELSE 0 END
FROM r JOIN t ON t.patient = r.patient AND t.rn = r.rn + 1""",
    "anchored": """
SELECT l.*, r.anchor FROM lab_t l JOIN r ON l.patient = r.patient AND l.ts = r.ts WHERE r.keep = 1""",
    "norm0": f"""
SELECT *,
  CASE WHEN result IS NULL THEN NULL
       WHEN code = 'MREB' THEN CASE WHEN result IN ({_list(MAPPED_NEGATIVE_TEXTS)}) THEN 'Negatief'
                                    WHEN result = 'Positief' THEN 'Positief' ELSE 'Bijzonder' END
       WHEN code IN ({_list(CATEGORICAL_CODES)}) THEN result END AS txt,
  CASE WHEN result IS NULL OR code IN ({_list(CATEGORICAL_CODES)}) THEN NULL
       WHEN code IN ({_list(PRESENCE_CODES)}) THEN CAST(1 AS DOUBLE)
       WHEN code IN ({_list(PLUS_COUNT_CODES)}) THEN CAST(length(result) - length(replace(result, '+', '')) AS DOUBLE)
       WHEN contains(result, '<') OR contains(result, '>')
         THEN TRY_CAST(NULLIF(regexp_extract(result, '{FIRST_NUMBER_SQL}', 0), '') AS DOUBLE)
       ELSE {guarded_double('result')} END AS num
FROM anchored""",
    "norm": f"""
SELECT *, CASE WHEN result IS NULL THEN 1 WHEN code IN ({_list(CATEGORICAL_CODES)}) THEN 0
               WHEN num IS NULL THEN 1 ELSE 0 END AS marker
FROM norm0""",
    "dedup": """
SELECT patient, anchor, code, seq, num, txt, marker FROM (
  SELECT *, row_number() OVER (PARTITION BY patient, anchor, code ORDER BY seq) AS rk FROM norm)
WHERE rk = 1""",
    "kept0": """
SELECT * FROM dedup WHERE (patient, anchor) IN (
  SELECT (patient, anchor) FROM dedup GROUP BY patient, anchor HAVING count(*) >= 2)""",
    "means": f"""
SELECT code, avg(COALESCE(num, {guarded_double('txt')})) AS mean FROM kept0 GROUP BY code""",
    "kept": f"""
SELECT k.patient, k.anchor, k.code, k.seq,
  CASE WHEN k.marker = 1 AND k.code NOT IN ({_list(CATEGORICAL_CODES)}) THEN m.mean ELSE k.num END AS num,
  CASE WHEN k.marker = 1 AND k.code IN ({_list(CATEGORICAL_CODES)}) THEN CAST(m.mean AS VARCHAR) ELSE k.txt END AS txt,
  k.marker
FROM kept0 k LEFT JOIN means m ON k.code = m.code""",
}

BUILD_ORDER = ["lab_f", "top", "lab_t", "t", "r", "anchored", "norm0", "norm", "dedup",
               "kept0", "means", "kept"]


def with_ctes(views, ctes: dict[str, str], body: str, recursive: bool = False) -> str:
    parts = [f"{v} AS ({VIEW_SQL[v]})" for v in views]
    parts += [f"{k} AS ({v})" for k, v in ctes.items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body


def build_ctes(upto: str) -> dict[str, str]:
    out = {}
    for k in BUILD_ORDER:
        out[k] = BUILD_CTES[k]
        if k == upto:
            break
    return out


def wide_cte(codes, category_vals) -> tuple[str, list[str]]:
    """SQL of the wide presentation table; returns (sql, output column list)."""
    cols, aggs = [], []
    for c in codes:
        v = "txt" if c in CATEGORICAL_CODES else "num"
        aggs.append(f'max(CASE WHEN code = \'{c}\' THEN {v} END) AS "lab_{c}"')
    pivot = ("SELECT patient, anchor, min(seq) AS seq, " + ", ".join(aggs)
             + " FROM kept GROUP BY patient, anchor")
    sel = ["patient", "anchor", "seq", "(hour(anchor) + minute(anchor)) / 60 AS Tijd"]
    numeric = [f"lab_{c}" for c in codes if c not in CATEGORICAL_CODES]
    hot = []
    for c in codes:
        if c in CATEGORICAL_CODES:
            for v in category_vals.get(c, []):
                name = f"lab_{c}{v}"
                hot.append(name)
                sel.append(f"COALESCE(CAST(\"lab_{c}\" = '{v}' AS INTEGER), 0) AS \"{name}\"")
    for n in numeric:
        sel.append(f'CAST(COALESCE("{n}", 0) AS DOUBLE) AS "{n}"')
    ind = []
    for c in codes:
        name = f"lab_{c}binary"
        ind.append(name)
        sel.append(f'CAST("lab_{c}" IS NOT NULL AS INTEGER) AS "{name}"')
    terms = [f'CAST(COALESCE("{n}", 0) > 0 AS INTEGER)' for n in numeric]
    terms += [f'CAST("lab_{c}" IS NOT NULL AS INTEGER)' for c in codes]
    terms += [f'"{h}"' for h in hot]
    terms += ["CAST((hour(anchor) + minute(anchor)) / 60 > 0 AS INTEGER)"]
    sel.append("CAST(" + " + ".join(terms) + " AS INTEGER) AS Num_vars")
    sql = "SELECT " + ",\n  ".join(sel) + f" FROM ({pivot})"
    out_cols = ["patient", "anchor", "seq", "Tijd"] + hot + numeric + ind + ["Num_vars"]
    return sql, out_cols


# ------------------------------------------------------------------ queries
ORACLE: dict[str, str] = {}

_CATALOGUE = [c for c in LAB_CODES if c not in DENY_CODES]
_CATS = {"MREB": ["Bijzonder", "Negatief", "Positief"], "BG": ["A", "B", "O"],
         "KETUP": ["+", "++", "neg"]}
_WIDE_SQL, _WIDE_COLS = wide_cte(_CATALOGUE, _CATS)


def _build(body: str, upto: str = "kept", extra: dict[str, str] | None = None,
           views=("lab",)) -> str:
    ctes = build_ctes(upto)
    if extra:
        ctes.update(extra)
    return with_ctes(views, ctes, body, recursive=True)


ORACLE["deny_filter"] = with_ctes(["lab"], {"lab_f": BUILD_CTES["lab_f"]},
                                  "SELECT code, count(*) AS n FROM lab_f GROUP BY code")
ORACLE["code_filter_top"] = with_ctes(["lab"], {"lab_f": BUILD_CTES["lab_f"]}, """
SELECT code, n FROM (
  SELECT code, n, row_number() OVER (ORDER BY n DESC, code) AS rk, count(*) OVER () AS nc
  FROM (SELECT code, count(*) AS n FROM lab_f GROUP BY code))
WHERE rk <= round_even(nc * 0.8, 0)""")
ORACLE["pilot_slice"] = with_ctes(["lab"], {}, """
SELECT seq, patient, code, result FROM lab WHERE seq BETWEEN 1 AND 9999""")
ORACLE["result_normalise"] = with_ctes(["lab"], {
    "anchored": "SELECT * FROM lab", "norm0": BUILD_CTES["norm0"], "norm": BUILD_CTES["norm"]},
    "SELECT seq, code, round(num, 6) AS num, txt, marker FROM norm")
ORACLE["anchor_times"] = _build(
    f"SELECT seq, patient, code, {ts_text('anchor')} AS anchor FROM anchored", upto="anchored")
ORACLE["dedup_first"] = _build(
    f"SELECT patient, {ts_text('anchor')} AS anchor, code, seq, round(num, 6) AS num, txt, marker "
    "FROM dedup", upto="dedup")
ORACLE["sparse_rows"] = _build(
    f"SELECT patient, {ts_text('anchor')} AS anchor, count(*) AS n_present FROM dedup "
    "GROUP BY patient, anchor HAVING count(*) >= 2", upto="dedup")
ORACLE["marker_mean"] = _build("SELECT code, round(mean, 6) AS mean FROM means", upto="means")


def _wide_select(cols) -> str:
    out = []
    for c in cols:
        if c == "anchor":
            out.append(f"{ts_text('anchor')} AS anchor")
        elif c == "Tijd" or (c.startswith("lab_") and c[4:] in _CATALOGUE
                             and c[4:] not in CATEGORICAL_CODES):
            out.append(f'round("{c}", 6) AS "{c}"')
        else:
            out.append(f'"{c}"')
    return ", ".join(out)


# The columns come from the data: kept codes, and texts of the categorical ones.
_IS_CAT = f"code IN ({_list(CATEGORICAL_CODES)})"
_CELLS = {
    "hot": f"SELECT patient, anchor, 'lab_' || code || txt AS col, 1 AS v FROM kept WHERE {_IS_CAT} AND txt IS NOT NULL",
    "cells": f"""
SELECT patient, anchor, 'lab_' || code AS col, round(COALESCE(num, 0), 6) AS v FROM kept WHERE NOT {_IS_CAT}
UNION ALL SELECT patient, anchor, 'lab_' || code || 'binary', CAST(CASE WHEN {_IS_CAT} THEN txt IS NOT NULL ELSE num IS NOT NULL END AS INTEGER)
  FROM kept
UNION ALL SELECT * FROM hot""",
    "cols": f"""
SELECT 'lab_' || code AS col FROM top WHERE NOT {_IS_CAT}
UNION ALL SELECT 'lab_' || code || 'binary' FROM top UNION ALL SELECT DISTINCT col FROM hot""",
    "base": """
SELECT patient, anchor, min(seq) AS seq, any_value((hour(anchor) + minute(anchor)) / 60) AS Tijd FROM kept GROUP BY patient, anchor""",
    "positive": "SELECT patient, anchor, count(*) FILTER (v > 0) AS n FROM cells GROUP BY patient, anchor",
}
ORACLE["presentation_wide"] = _build(f"""
SELECT b.patient, {ts_text('b.anchor')} AS anchor, b.seq, round(b.Tijd, 6) AS Tijd, CAST(p.n + CAST(b.Tijd > 0 AS INTEGER) AS INTEGER) AS Num_vars,
  c.col AS "column", CAST(COALESCE(x.v, 0) AS DOUBLE) AS value
FROM base b JOIN positive p ON p.patient = b.patient AND p.anchor = b.anchor CROSS JOIN cols c
LEFT JOIN cells x ON x.patient = b.patient AND x.anchor = b.anchor AND x.col = c.col""", extra=_CELLS)
ORACLE["num_vars"] = _build(f"""
SELECT b.patient, {ts_text('b.anchor')} AS anchor, CAST(p.n + CAST(b.Tijd > 0 AS INTEGER) AS INTEGER) AS Num_vars
FROM base b JOIN positive p ON p.patient = b.patient AND p.anchor = b.anchor""", extra=_CELLS)
ORACLE["one_hot"] = _build(f"""
SELECT b.patient, {ts_text('b.anchor')} AS anchor, c.col AS "column", CAST(COALESCE(x.v, 0) AS DOUBLE) AS value
FROM base b CROSS JOIN (SELECT DISTINCT col FROM hot) c LEFT JOIN hot x ON x.patient = b.patient AND x.anchor = b.anchor AND x.col = c.col""",
    extra=_CELLS)
_HITS = """
SELECT v.visit_id, v.nummer, v.Datum_SEH, w.* EXCLUDE (patient) FROM visits v JOIN wide w
  ON w.patient = v.nummer AND w.anchor > v.Datum_SEH AND w.anchor < v.Datum_SEH + INTERVAL 900 MINUTE"""
ORACLE["visit_lab_match"] = _build(f"""
SELECT visit_id, nummer, {ts_text('Datum_SEH')} AS Datum_SEH, {ts_text('anchor')} AS anchor, Num_vars,
  round(lab_HB, 6) AS lab_HB, round(lab_TRC, 6) AS lab_TRC, "lab_MREBNegatief"
FROM hits WHERE visit_id IN (SELECT visit_id FROM hits GROUP BY visit_id HAVING count(*) = 1)""",
    extra={"wide": _WIDE_SQL, "hits": _HITS}, views=("lab", "visits"))
ORACLE["match_audit"] = _build(f"""
SELECT v.visit_id, CAST(count(h.visit_id) AS BIGINT) AS hits, {ts_text('min(h.anchor)')} AS first_hit,
  {ts_text('max(h.anchor)')} AS last_hit FROM visits v
LEFT JOIN hits h ON h.visit_id = v.visit_id GROUP BY v.visit_id""",
    extra={"wide": _WIDE_SQL, "hits": _HITS}, views=("lab", "visits"))


# ---------------------------------------------------------- derive (cases)
_DAYS = "floor((epoch(CAST(Datum_overlijden AS TIMESTAMP)) - epoch(Datum_SEH)) / 86400)"
_Y31 = f"CASE WHEN Datum_overlijden IS NULL THEN 0 WHEN {_DAYS} BETWEEN -1 AND 31 THEN 1 ELSE 0 END"
_AGE = "CAST(floor(date_diff('day', Geboortedatum, DATE '2002-01-01') / 365.2425) AS BIGINT)"
_O2 = guarded_double("replace(split_part(zuurstoftherapie, ' ', 1), 'L', '')")
_AGED = f"SELECT * REPLACE ({_AGE} AS Geboortedatum) FROM cases"


def _truthy(c):
    return f"COALESCE({c}, 0) <> 0"


_CURB = """(CASE WHEN Comorb_dementie_Psychiatrisch > 0 THEN 1 ELSE 0 END
 + CASE WHEN URESE > 7 THEN 1 ELSE 0 END + CASE WHEN AF_berekend > 30 THEN 1 ELSE 0 END
 + CASE WHEN Geboortedatum >= 65 THEN 1 ELSE 0 END
 + CASE WHEN RR_diast < 60 AND RR_diast > 0 THEN 1 WHEN RR_syst < 90 AND RR_syst > 0 THEN 1 ELSE 0 END)"""
_MEDS = f"""(3 + CASE WHEN Geboortedatum >= 65 THEN 3 ELSE 0 END
 + CASE WHEN Woonsituatie IN (2, 3) THEN 2 ELSE 0 END
 + CASE WHEN {_truthy('Comorb_dementie_Psychiatrisch')} THEN 2 ELSE 0 END
 + CASE WHEN TRC < 150 THEN 3 ELSE 0 END + CASE WHEN septischeshock = 1 THEN 3 ELSE 0 END
 + CASE WHEN AF_berekend > 30 THEN 3 ELSE 0 END
 + CASE WHEN metastase_of_chronische_ziekte_met_hoge_mortaliteit = 1 THEN 6 ELSE 0 END)"""
_ABBMEDS = f"""(CASE WHEN metastase_of_chronische_ziekte_met_hoge_mortaliteit = 1 THEN 6 ELSE 0 END
 + CASE WHEN AF_berekend > 20 THEN 3 ELSE 0 END + CASE WHEN septischeshock = 1 THEN 3 ELSE 0 END
 + CASE WHEN TRC < 150 THEN 3 ELSE 0 END + CASE WHEN Geboortedatum >= 65 THEN 3 ELSE 0 END
 + CASE WHEN WD = 2 THEN 2 ELSE 0 END + CASE WHEN Woonsituatie IN (2, 3) THEN 2 ELSE 0 END
 + CASE WHEN {_truthy('Comorb_dementie_Psychiatrisch')} THEN 2 ELSE 0 END)"""
_MAP = "((RR_syst + 2 * RR_diast) / 3)"
_MREMS = f"""(
 CASE WHEN Geboortedatum < 45 THEN 0 WHEN Geboortedatum < 54 THEN 2 WHEN Geboortedatum < 64 THEN 3
      WHEN Geboortedatum < 74 THEN 5 ELSE 6 END
 + CASE WHEN Pols < 39 THEN 4 WHEN Pols < 55 THEN 3 WHEN Pols < 70 THEN 2 WHEN Pols < 110 THEN 0
        WHEN Pols < 139 THEN 2 WHEN Pols < 179 THEN 3 ELSE 4 END
 + CASE WHEN AF_berekend < 5 THEN 4 WHEN AF_berekend < 9 THEN 3 WHEN AF_berekend < 12 THEN 1
        WHEN AF_berekend < 25 THEN 0 WHEN AF_berekend < 35 THEN 1 WHEN AF_berekend < 50 THEN 3 ELSE 4 END
 + CASE WHEN {_MAP} < 49 THEN 4 WHEN {_MAP} < 70 THEN 2 WHEN {_MAP} < 110 THEN 0
        WHEN {_MAP} < 130 THEN 2 WHEN {_MAP} < 160 THEN 3 ELSE 4 END
 + CASE WHEN Saturatie = 0 THEN 0 WHEN Saturatie < 75 THEN 4 WHEN Saturatie < 85 THEN 3
        WHEN Saturatie < 90 THEN 1 ELSE 0 END
 + CASE WHEN GCS_afgeleid > 13 THEN 1 WHEN GCS_afgeleid > 11 THEN 1 WHEN GCS_afgeleid > 8 THEN 2
        WHEN GCS_afgeleid > 5 THEN 3 ELSE 4 END
 + CASE WHEN {_truthy('Comorb_dementie_Psychiatrisch')} THEN 1 ELSE 0 END)"""


def _risk(score, ranges):
    whens = " ".join(f"WHEN {score} BETWEEN {lo} AND {hi} THEN {r}" for lo, hi, r in ranges)
    return f"CASE {whens} ELSE CAST({score} AS DOUBLE) END" if whens else f"CAST({score} AS DOUBLE)"


ORACLE["outcome_31d"] = with_ctes(["cases"], {}, f"SELECT case_id, {_Y31} AS y FROM cases")
ORACLE["days_to_death"] = with_ctes(["cases"], {}, f"""
SELECT case_id, CAST(CASE WHEN Datum_overlijden IS NULL THEN 1000
  WHEN {_DAYS} >= -1 AND {_DAYS} < 31 THEN {_DAYS} ELSE 1000 END AS INTEGER) AS days FROM cases""")
ORACLE["age_years"] = with_ctes(["cases"], {}, f"SELECT case_id, {_AGE} AS age FROM cases")
ORACLE["hour_fraction"] = with_ctes(["cases"], {}, """
SELECT case_id, round((hour(Datum_SEH) + minute(Datum_SEH)) / 60, 6) AS tijd FROM cases""")
ORACLE["outcome_select"] = with_ctes(["cases"], {}, f"""
SELECT case_id, septischeshock AS y1, Sterfte_in_ziekenhuis AS y2, {_Y31} AS y3 FROM cases""")
ORACLE["o2_parse"] = with_ctes(["cases"], {}, f"SELECT case_id, round({_O2}, 6) AS o2 FROM cases")
ORACLE["curb"] = with_ctes(["cases"], {"aged": _AGED}, f"SELECT case_id, {_CURB} AS curb FROM aged")
ORACLE["meds"] = with_ctes(["cases"], {"aged": _AGED}, f"SELECT case_id, {_MEDS} AS meds FROM aged")
ORACLE["abbmeds"] = with_ctes(["cases"], {"aged": _AGED},
                              f"SELECT case_id, {_ABBMEDS} AS abbmeds FROM aged")
ORACLE["mrems"] = with_ctes(["cases"], {"aged": _AGED}, f"SELECT case_id, {_MREMS} AS mrems FROM aged")
ORACLE["score_risk"] = with_ctes(["cases"], {"aged": _AGED}, f"""
SELECT case_id,
  round({_risk(_CURB, ((0, 1, 0.015), (2, 2, 0.092), (3, 5, 0.22)))}, 6) AS curb_risk,
  round({_risk(_MEDS, ((0, 4, 0.01), (5, 7, 0.032), (8, 11, 0.08), (12, 15, 0.18), (16, 26, 0.42)))}, 6) AS meds_risk,
  round(CAST(0 AS DOUBLE), 6) AS rems_risk,
  round(CASE WHEN {_ABBMEDS} < 5 THEN 0.016 WHEN {_ABBMEDS} < 13 THEN 0.234 ELSE 0.59 END, 6) AS abbmeds_risk,
  round({_MAP}, 6) AS map
FROM aged""")

_FS1 = ["nummer", "Geboortedatum", "Geslacht", "Datum_SEH", "Uur_Binnenkomst_SEH", "TRC", "URESE"]
_FS2 = ["Comorb_infarct", "Comorb_Hartfalen", "Comorb_dementie_Psychiatrisch",
        "metastase_of_chronische_ziekte_met_hoge_mortaliteit", "Woonsituatie", "Thuismedicatie_aantal"]
_FS3 = ["Pols", "RR_syst", "RR_diast", "AF_berekend", "Saturatie", "Temperatuur", "GCS_afgeleid",
        "zuurstoftherapie", "WD"]
_DERIVED = f"""
SELECT case_id, {_Y31} AS y_var, nummer, {_AGE} AS Geboortedatum, Geslacht, Datum_SEH,
  (hour(Datum_SEH) + minute(Datum_SEH)) / 60 AS Uur_Binnenkomst_SEH, TRC, URESE,
  {", ".join(_FS2)}, Pols, RR_syst, RR_diast, AF_berekend, Saturatie, Temperatuur, GCS_afgeleid,
  {_O2} AS zuurstoftherapie, WD
FROM cases"""
_DOUBLES = {"Uur_Binnenkomst_SEH", "TRC", "URESE", "Thuismedicatie_aantal", "Pols", "RR_syst",
            "RR_diast", "AF_berekend", "Saturatie", "Temperatuur", "GCS_afgeleid",
            "zuurstoftherapie", "WD"}


def _fs_select(cols):
    out = ["case_id", "y_var"]
    for c in cols:
        if c == "Datum_SEH":
            out.append(f"{ts_text('Datum_SEH')} AS Datum_SEH")
        elif c in _DOUBLES:
            out.append(f"round(COALESCE({c}, 0), 6) AS {c}")
        else:
            out.append(f"COALESCE({c}, 0) AS {c}")
    return ", ".join(out)


ORACLE["feature_set_1"] = with_ctes(["cases"], {"d": _DERIVED}, f"SELECT {_fs_select(_FS1)} FROM d")
ORACLE["feature_set_2"] = with_ctes(["cases"], {"d": _DERIVED},
                                    f"SELECT {_fs_select(_FS1 + _FS2)} FROM d")
ORACLE["feature_set_3"] = with_ctes(["cases"], {"d": _DERIVED},
                                    f"SELECT {_fs_select(_FS1 + _FS2 + _FS3)} FROM d")
ORACLE["split_main"] = with_ctes(["cases", "cohort"], {"d": _DERIVED}, """
SELECT case_id, y_var FROM d WHERE NOT EXISTS (
  SELECT 1 FROM cohort c WHERE c.nummer IS NOT DISTINCT FROM d.nummer
    AND c.Datum_SEH IS NOT DISTINCT FROM CAST(d.Datum_SEH AS DATE))""")
ORACLE["split_validation"] = with_ctes(["cases", "cohort"], {"d": _DERIVED}, """
SELECT case_id, nummer, CAST(CAST(Datum_SEH AS DATE) AS VARCHAR) AS Datum_SEH, y_var FROM d
WHERE (nummer, CAST(Datum_SEH AS DATE)) IN (SELECT (nummer, Datum_SEH) FROM cohort)""")

# ------------------------------------------------------- evaluate (scored)
_CUM = {
    "c": "SELECT model, fold, p, CAST(sum(y) AS BIGINT) AS tp, CAST(sum(1 - y) AS BIGINT) AS fp "
         "FROM scored GROUP BY model, fold, p",
    "cum": """
SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp,
  sum(tp) OVER (PARTITION BY model, fold) AS npos, sum(fp) OVER (PARTITION BY model, fold) AS nneg
FROM c WINDOW w AS (PARTITION BY model, fold ORDER BY p DESC ROWS UNBOUNDED PRECEDING)""",
    "pts": """
SELECT model, fold, p AS threshold, cfp / nneg AS fpr, ctp / npos AS tpr FROM cum
UNION ALL SELECT model, fold, max(p) + 1, 0.0, 0.0 FROM c GROUP BY model, fold""",
    "fold_auc": """
SELECT model, fold, sum(fp * (2 * ctp - tp)) / (2 * any_value(npos) * any_value(nneg)) AS auc,
  CAST(any_value(npos) AS BIGINT) AS n_pos, CAST(any_value(nneg) AS BIGINT) AS n_neg FROM cum GROUP BY model, fold""",
    "grid": """
SELECT g.model, g.fold, CAST(r.j AS INTEGER) AS j,
  CASE WHEN r.j = 99 THEN CAST(1 AS DOUBLE) ELSE CAST(r.j AS DOUBLE) * (CAST(1 AS DOUBLE) / 99) END AS x
FROM (SELECT DISTINCT model, fold FROM pts) g CROSS JOIN range(100) r(j)""",
    "gi": """
SELECT g.model, g.fold, g.j, g.x,
  max(p.fpr) FILTER (WHERE p.fpr <= g.x) AS lf, max(p.tpr) FILTER (WHERE p.fpr <= g.x) AS lt,
  min(p.fpr) FILTER (WHERE p.fpr > g.x) AS rf, min(p.tpr) FILTER (WHERE p.fpr > g.x) AS rt
FROM grid g JOIN pts p ON p.model = g.model AND p.fold = g.fold
GROUP BY g.model, g.fold, g.j, g.x""",
    "rg": """
SELECT model, fold, j, x AS fpr,
  CASE WHEN j = 0 THEN CAST(0 AS DOUBLE) WHEN rf IS NULL THEN lt
       ELSE ((rt - lt) / (rf - lf)) * (x - lf) + lt END AS tpr
FROM gi""",
    "band0": """
SELECT model, j, any_value(fpr) AS fpr,
  CASE WHEN j = 99 THEN CAST(1 AS DOUBLE) ELSE avg(tpr) END AS mean_tpr, stddev_pop(tpr) AS std_tpr
FROM rg GROUP BY model, j""",
    "band": """
SELECT *, least(mean_tpr + 1.96 * std_tpr / sqrt(4), 1.0) AS upper,
  greatest(mean_tpr - 1.96 * std_tpr / sqrt(4), 0.0) AS lower FROM band0""",
    "summary": """
SELECT a.model, a.mean_auc, s.std_auc, a.mean_auc - 1.96 * s.std_auc / sqrt(5) AS ci_low,
  a.mean_auc + 1.96 * s.std_auc / sqrt(5) AS ci_high
FROM (SELECT model, sum(seg) AS mean_auc FROM (
        SELECT model, (fpr - lag(fpr) OVER w) * (mean_tpr + lag(mean_tpr) OVER w) / 2 AS seg
        FROM band WINDOW w AS (PARTITION BY model ORDER BY j)) GROUP BY model) a
JOIN (SELECT model, stddev_pop(auc) AS std_auc FROM fold_auc GROUP BY model) s ON a.model = s.model""",
}


def _scored(body, *names):
    return with_ctes(["scored"], {k: _CUM[k] for k in names}, body)


_R6 = lambda cols: ", ".join(f"round({c}, 6) AS {c}" for c in cols)
ORACLE["roc_points"] = _scored(f"SELECT model, fold, {_R6(['threshold', 'fpr', 'tpr'])} FROM pts",
                               "c", "cum", "pts")
ORACLE["auc_by_fold"] = _scored(f"SELECT model, fold, {_R6(['auc'])}, n_pos, n_neg FROM fold_auc",
                                "c", "cum", "fold_auc")
ORACLE["roc_grid"] = _scored(f"SELECT model, fold, j, {_R6(['fpr', 'tpr'])} FROM rg",
                             "c", "cum", "pts", "grid", "gi", "rg")
ORACLE["roc_mean_band"] = _scored(
    f"SELECT model, j, {_R6(['fpr', 'mean_tpr', 'std_tpr', 'upper', 'lower'])} FROM band",
    "c", "cum", "pts", "grid", "gi", "rg", "band0", "band")
ORACLE["compare_models"] = _scored(
    f"SELECT model, {_R6(['mean_auc', 'std_auc', 'ci_low', 'ci_high'])} FROM summary",
    "c", "cum", "pts", "fold_auc", "grid", "gi", "rg", "band0", "band", "summary")


def _fold_summary(value, expr):
    return with_ctes(["scored"], {"per": f"SELECT model, fold, avg({expr}) AS v FROM scored GROUP BY model, fold"},
                     f"""
SELECT model, round(avg(v), 6) AS mean_{value}, round(stddev_pop(v), 6) AS std_{value},
  round(avg(v) - 1.96 * stddev_pop(v) / sqrt(5), 6) AS ci_low_{value},
  round(avg(v) + 1.96 * stddev_pop(v) / sqrt(5), 6) AS ci_high_{value}
FROM per GROUP BY model""")


ORACLE["accuracy_cv"] = _fold_summary("accuracy", "CAST(y = CAST(p > 0.5 AS INTEGER) AS DOUBLE)")
ORACLE["brier_cv"] = _fold_summary("brier", "pow(p - y, 2)")
_STEP3 = "((1.0 + 1e-8) / 3)"
ORACLE["calibration"] = with_ctes(["scored"], {"per": f"""
SELECT model, fold, CAST(p >= 1 * {_STEP3} AS INTEGER) + CAST(p >= 2 * {_STEP3} AS INTEGER) AS bin,
  avg(p) AS mean_pred, avg(CAST(y AS DOUBLE)) AS frac_pos
FROM scored GROUP BY ALL"""}, """
SELECT model, bin, round(avg(mean_pred), 6) AS mean_pred, round(avg(frac_pos), 6) AS frac_pos,
  count(*) AS n_folds FROM per GROUP BY model, bin""")
ORACLE["threshold_auc"] = with_ctes(["scored"], {"x": """
SELECT model, y, 'p_plus_0.1_gt_0.5' AS rule, CAST(p + 0.1 > 0.5 AS INTEGER) AS pred FROM scored
UNION ALL SELECT model, y, 'p_gt_0.25', CAST(p > 0.25 AS INTEGER) FROM scored
UNION ALL SELECT model, y, 'p_gt_0.5', CAST(p > 0.5 AS INTEGER) FROM scored""", "cf": """
SELECT model, rule,
  CAST(sum(CAST(y = 1 AND pred = 1 AS INTEGER)) AS BIGINT) AS tp,
  CAST(sum(CAST(y = 0 AND pred = 1 AS INTEGER)) AS BIGINT) AS fp,
  CAST(sum(CAST(y = 0 AND pred = 0 AS INTEGER)) AS BIGINT) AS tn,
  CAST(sum(CAST(y = 1 AND pred = 0 AS INTEGER)) AS BIGINT) AS fn
FROM x GROUP BY model, rule"""}, """
SELECT model, rule, tp, fp, tn, fn, round(tp / (tp + fn), 6) AS sens, round(tn / (tn + fp), 6) AS spec,
  round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS auc FROM cf""")


# ------------------------------------------------- statistics and splits
def kfold_sql(src: str, key: str, label: str, k: int) -> dict[str, str]:
    alloc = ", ".join(f"floor((o + n - 1 - {i} + {k}) / {k}) - floor((o - 1 - {i} + {k}) / {k}) AS a{i}"
                      for i in range(k))
    bounds = ", ".join(f"{' + '.join(f'a{j}' for j in range(i + 1))} AS b{i + 1}" for i in range(k - 1))
    fold = " + ".join(f"CAST(r >= b{i + 1} AS INTEGER)" for i in range(k - 1)) or "0"
    return {
        "kc": f"SELECT {label}, min({key}) AS first, count(*) AS n FROM {src} GROUP BY {label}",
        "kc2": f"""SELECT {label}, n, COALESCE(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING
                   AND 1 PRECEDING), 0) AS o FROM kc""",
        "ka": f"SELECT {label}, {alloc} FROM kc2",
        "kb": f"SELECT {label}, {bounds} FROM ka" if k > 1 else f"SELECT {label} FROM ka",
        "kr": f"SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {key}) - 1 AS r FROM {src}",
        "folded": f"SELECT kr.* EXCLUDE (r), CAST({fold} AS INTEGER) AS fold FROM kr JOIN kb USING ({label})",
    }


ORACLE["kfold"] = with_ctes([], {"d": "SELECT doc_id, quality FROM labels",
                                 **kfold_sql("d", "doc_id", "quality", 5)},
                            "SELECT doc_id, quality, fold FROM folded")
ORACLE["holdout_sizes"] = """
SELECT 'test' AS split, CAST(ceil(0.3 * count(*)) AS BIGINT) AS n FROM orders
UNION ALL SELECT 'train', CAST(count(*) - ceil(0.3 * count(*)) AS BIGINT) FROM orders"""
ORACLE["presentation_id"] = _build(f"""
SELECT patient, {ts_text('anchor')} AS anchor,
  CAST(dense_rank() OVER (ORDER BY anchor, patient) - 1 AS BIGINT) AS id
FROM (SELECT DISTINCT patient, anchor FROM anchored)""", upto="anchored")
ORACLE["scale_pop"] = with_ctes(["cases"], {}, """
SELECT case_id,
  round((Pols - avg(Pols) OVER ()) / COALESCE(NULLIF(stddev_pop(Pols) OVER (), 0), 1), 6) AS Pols,
  round((TRC - avg(TRC) OVER ()) / COALESCE(NULLIF(stddev_pop(TRC) OVER (), 0), 1), 6) AS TRC,
  round((URESE - avg(URESE) OVER ()) / COALESCE(NULLIF(stddev_pop(URESE) OVER (), 0), 1), 6) AS URESE
FROM cases""")
_RISKD = f"""SELECT case_id, {_Y31} AS y,
  {_risk(_CURB, ((0, 1, 0.015), (2, 2, 0.092), (3, 5, 0.22)))} AS p FROM aged"""
ORACLE["cv_risk_roc"] = with_ctes(["cases"], {
    "aged": _AGED, "d": _RISKD, **kfold_sql("d", "case_id", "y", 3),
    "tr": "SELECT f.y, f.p, e.i AS fold FROM folded f JOIN range(3) e(i) ON f.fold <> e.i",
    "c": "SELECT fold, p, sum(y) AS tp, sum(1 - y) AS fp FROM tr GROUP BY fold, p",
    "cum": """SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER (PARTITION BY fold) AS nneg,
      sum(tp) OVER (PARTITION BY fold) AS npos FROM c
      WINDOW w AS (PARTITION BY fold ORDER BY p DESC ROWS UNBOUNDED PRECEDING)"""}, """
SELECT CAST(fold AS INTEGER) AS fold,
  round(sum(fp * (2 * ctp - tp)) / (2 * any_value(npos) * any_value(nneg)), 6) AS auc,
  CAST(any_value(npos) AS BIGINT) AS n_pos, CAST(any_value(nneg) AS BIGINT) AS n_neg
FROM cum GROUP BY fold""")

_RT = {"Shock": "Shock", "Mortality": "Death"}
_RATER_UNION = " UNION ALL ".join(
    f"SELECT '{t}' AS target, '{t}_Int_{i}' AS rater, {truth} AS y, {t}_Int_{i} AS c FROM raters"
    for t, truth in _RT.items() for i in ("1", "2", "3", "4"))
ORACLE["rater_points"] = with_ctes(["raters"], {"u": _RATER_UNION, "cf": """
SELECT target, rater, CAST(sum(CAST(y = 1 AND c = 1 AS INTEGER)) AS BIGINT) AS tp,
  CAST(sum(CAST(y = 0 AND c = 1 AS INTEGER)) AS BIGINT) AS fp,
  CAST(sum(CAST(y = 0 AND c = 0 AS INTEGER)) AS BIGINT) AS tn,
  CAST(sum(CAST(y = 1 AND c = 0 AS INTEGER)) AS BIGINT) AS fn FROM u GROUP BY target, rater""",
    "pt": """SELECT *, CASE WHEN tp + fp = 0 THEN 1.0 ELSE fp / (fp + tn) END AS fpr,
      CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fn) END AS tpr FROM cf"""}, """
SELECT target, rater, tp, fp, tn, fn, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr,
  round((1.0 + tpr - fpr) / 2, 6) AS auc FROM pt""")
_PAIRS = " UNION ALL ".join(
    f"SELECT '{t}' AS target, '{t}_Int_{a}' AS rater_a, '{t}_Int_{b}' AS rater_b, "
    f"{t}_Int_{a} AS a, {t}_Int_{b} AS b FROM raters"
    for t in _RT for a in "1234" for b in "1234")
ORACLE["kappa_pairs"] = with_ctes(["raters"], {"u": _PAIRS, "cn": """
SELECT target, rater_a, rater_b,
  sum(CAST(a = 1 AND b = 1 AS BIGINT)) AS n11, sum(CAST(a = 1 AND b = 0 AS BIGINT)) AS n10,
  sum(CAST(a = 0 AND b = 1 AS BIGINT)) AS n01, sum(CAST(a = 0 AND b = 0 AS BIGINT)) AS n00
FROM u GROUP BY ALL"""}, """
SELECT target, rater_a, rater_b, CAST(n11 + n10 + n01 + n00 AS BIGINT) AS n,
  round(CASE WHEN ((n11 + n10) * (n10 + n00) + (n01 + n00) * (n11 + n01)) = 0 THEN NULL
    ELSE 1.0 - (n10 + n01) / (((n11 + n10) * (n10 + n00) + (n01 + n00) * (n11 + n01)) / (n11 + n10 + n01 + n00)) END, 6) AS kappa
FROM cn""")

_COHORTED = {
    "aged": _AGED,
    "sc": f"""SELECT a.*, {_ABBMEDS} AS abbMEDS, {_MREMS} AS mREMS, septischeshock AS y_shock,
      {_Y31.replace('Datum_SEH', 'a.Datum_SEH')} AS y_death,
      CASE WHEN (nummer, CAST(a.Datum_SEH AS DATE)) IN (SELECT (nummer, Datum_SEH) FROM cohort)
           THEN 'validation' ELSE 'main' END AS cohort FROM aged a""",
    "sl": """SELECT cohort, 'abbMEDS' AS score, abbMEDS AS value FROM sc
             UNION ALL SELECT cohort, 'mREMS', mREMS FROM sc""",
    "ol": """SELECT cohort, 'shock' AS outcome, y_shock AS y FROM sc
             UNION ALL SELECT cohort, 'death31', y_death FROM sc""",
}


def _coh(body, extra=None):
    return with_ctes(["cases", "cohort"], {**_COHORTED, **(extra or {})}, body)


ORACLE["describe_scores"] = _coh("""
SELECT cohort, score, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(CAST(min(value) AS DOUBLE), 6) AS min, round(quantile_cont(value, 0.25), 6) AS q25,
  round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75,
  round(CAST(max(value) AS DOUBLE), 6) AS max
FROM (SELECT * FROM sl UNION ALL SELECT 'total', score, value FROM sl) GROUP BY cohort, score""")
ORACLE["mann_whitney"] = _coh("""
SELECT score, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(least(u_x, n1 * n2 - u_x), 6) AS u,
  round(u_x, 6) AS u_x, round(tie, 6) AS tie_correction,
  round((greatest(u_x, n1 * n2 - u_x) - (n1 * n2 / 2.0 + 0.5)) / sqrt(tie * n1 * n2 * (n1 + n2 + 1) / 12.0), 6) AS z
FROM (SELECT score, n1, n2, n1 * n2 + n1 * (n1 + 1) / 2.0 - r1 AS u_x,
        1.0 - ties / ((n1 + n2) * (n1 + n2) * (n1 + n2) - (n1 + n2)) AS tie
      FROM (SELECT score, sum(c1) AS n1, sum(c2) AS n2, sum(c1 * mid) AS r1, sum(t * t * t - t) AS ties
            FROM (SELECT *, (cum - t) + (t + 1) / 2.0 AS mid FROM (
                    SELECT *, c1 + c2 AS t, sum(c1 + c2) OVER (PARTITION BY score ORDER BY value) AS cum
                    FROM (SELECT score, value, sum(CAST(cohort = 'main' AS BIGINT)) AS c1,
                                 sum(CAST(cohort = 'validation' AS BIGINT)) AS c2
                          FROM sl GROUP BY score, value)))
            GROUP BY score))""")
ORACLE["chi_square"] = _coh("""
SELECT outcome, round(sum(power(adj - e, 2) / e), 6) AS chi2, CAST(any_value(dof) AS INTEGER) AS dof,
  CAST(any_value(n) AS BIGINT) AS n
FROM (SELECT *, CASE WHEN dof = 1 THEN o + 0.5 * sign(e - o) ELSE o END AS adj FROM (
  SELECT *, CAST(rt AS DOUBLE) * ct / n AS e, (nr - 1) * (nc - 1) AS dof FROM (
    SELECT g.outcome, g.y, g.cohort, COALESCE(x.o, 0) AS o,
      sum(COALESCE(x.o, 0)) OVER (PARTITION BY g.outcome, g.y) AS rt,
      sum(COALESCE(x.o, 0)) OVER (PARTITION BY g.outcome, g.cohort) AS ct,
      sum(COALESCE(x.o, 0)) OVER (PARTITION BY g.outcome) AS n,
      count(DISTINCT g.y) OVER (PARTITION BY g.outcome) AS nr, 2 AS nc
    FROM (SELECT DISTINCT outcome, y, c.cohort FROM ol, (VALUES ('main'), ('validation')) c(cohort)
          WHERE y IS NOT NULL) g
    LEFT JOIN (SELECT outcome, y, cohort, count(*) AS o FROM ol GROUP BY ALL) x
      ON g.outcome = x.outcome AND g.y = x.y AND g.cohort = x.cohort)))
GROUP BY outcome""")
ORACLE["outcome_freq"] = _coh("""
SELECT cohort, outcome, y, count(*) AS n FROM (SELECT * FROM ol UNION ALL SELECT 'total', outcome, y FROM ol)
GROUP BY ALL""")
ORACLE["crosstab"] = _coh("""
SELECT y, count(*) FILTER (WHERE cohort = 'main') AS main,
  count(*) FILTER (WHERE cohort = 'validation') AS validation
FROM ol WHERE outcome = 'death31' GROUP BY y""")


# ------------------------------------------------------------- imputation
_NUM = [c for c in _CATALOGUE if c not in CATEGORICAL_CODES]
_RAW = ("SELECT patient, anchor, " + ", ".join(
    f"max(CASE WHEN code = '{c}' THEN num END) AS lab_{c}" for c in _NUM)
    + " FROM kept GROUP BY patient, anchor")
_A = f"patient, {ts_text('anchor')} AS anchor"
ORACLE["impute_zero"] = _build(
    f"SELECT {_A}, " + ", ".join(f"round(COALESCE(lab_{c}, 0), 6) AS lab_{c}" for c in _NUM) + " FROM raw",
    extra={"raw": _RAW})
ORACLE["impute_median"] = _build(
    f"SELECT {_A}, " + ", ".join(f"round(COALESCE(lab_{c}, m_{c}), 6) AS lab_{c}" for c in _NUM)
    + " FROM raw, (SELECT " + ", ".join(f"quantile_cont(lab_{c}, 0.5) AS m_{c}" for c in _NUM)
    + " FROM raw) med", extra={"raw": _RAW})
ORACLE["impute_indicator"] = _build(
    f"SELECT {_A}, " + ", ".join(f"CAST(lab_{c} IS NOT NULL AS INTEGER) AS lab_{c}binary" for c in _NUM)
    + " FROM raw", extra={"raw": _RAW})
ORACLE["impute_indicator2"] = _build(
    f"SELECT {_A}, " + ", ".join(f"CAST(COALESCE(lab_{c} <> 0, true) AS INTEGER) AS lab_{c}binary"
                                 for c in _NUM) + " FROM raw", extra={"raw": _RAW})


# nearest rows: all pairs here, as the oracle is plain brute force
_DIST = " + ".join(f"power(a.z_{c} - b.z_{c}, 2)" for c in _NUM)
_KNN = {
    "raw": _RAW,
    "st": "SELECT " + ", ".join(f"avg(lab_{c}) AS m_{c}, CASE WHEN COALESCE(stddev_pop(lab_{c}), 0) = 0 THEN 1 ELSE stddev_pop(lab_{c}) END AS s_{c}"
                                 for c in _NUM) + " FROM raw",
    "z": "SELECT row_number() OVER (ORDER BY patient, anchor) AS rid, raw.*, " + ", ".join(
        f"CASE WHEN m_{c} IS NULL THEN 0 ELSE (COALESCE(lab_{c}, m_{c}) - m_{c}) / s_{c} END AS z_{c}" for c in _NUM) + " FROM raw, st",
    "pair": f"""SELECT a.rid AS q, round(sqrt({_DIST}), 9) AS d, b.* FROM z a JOIN z b ON a.rid <> b.rid""",
    "near": """SELECT *, 1 / (d + 1e-6) AS w FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, rid) AS rk FROM pair) WHERE rk <= 10""",
    "fill": "SELECT q, " + ", ".join(f"sum(w * lab_{c}) / sum(w) FILTER (WHERE lab_{c} IS NOT NULL) AS f_{c}" for c in _NUM) + " FROM near GROUP BY q",
}
_FILLED = ", ".join(f"round(COALESCE(z.lab_{c}, f_{c}), 6) AS lab_{c}" for c in _NUM)
ORACLE["impute_knn"] = _build(f"SELECT {_A}, {_FILLED} FROM z JOIN fill ON fill.q = z.rid", extra=_KNN)
ORACLE["impute_complex"] = _build(
    f"SELECT {_A}, {_FILLED}, " + ", ".join(f"CAST(z.lab_{c} IS NOT NULL AS INTEGER) AS lab_{c}binary" for c in _NUM)
    + " FROM z JOIN fill ON fill.q = z.rid", extra=_KNN)


# ------------------------------------------------------ versions, parameters
ORACLE["latest_version"] = with_ctes(["cases"], {
    "v": "SELECT case_id, CAST(year(Datum_SEH) % 7 + 1 AS INTEGER) AS version FROM cases"},
    "SELECT case_id, version FROM v WHERE version = (SELECT max(version) FROM v)")
ORACLE["hyper_params"] = with_ctes([], {"pt": """
SELECT o_orderkey, o_orderpriority AS algorithm, CAST(o_orderkey % 7 AS INTEGER) AS algo_version,
  CAST(o_orderkey % 3 AS INTEGER) AS model_version, CAST(o_custkey % 3 + 1 AS INTEGER) AS data_model,
  CAST(o_orderkey % 2 + 1 AS INTEGER) AS out,
  'max_depth=' || CAST(o_orderkey % 13 + 3 AS VARCHAR) || ';n_estimators=' ||
  CAST(o_orderkey % 6 * 50 + 100 AS VARCHAR) || ';key=' || CAST(o_orderkey AS VARCHAR) AS params
FROM orders"""}, """
SELECT algorithm, model_version, data_model, out, max(algo_version) AS algo_version,
  arg_max(params, CAST(algo_version AS BIGINT) * 1000000000 + o_orderkey) AS params FROM pt GROUP BY ALL""")


# ------------------------------------------------------ baseline table
def _unpivot(sub: str, section: str, cohort: str, item: str, stats) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {cohort} AS cohort, {item} AS item, '{s}' AS stat, "
        f"round(CAST({s} AS DOUBLE), 6) AS value FROM ({sub})" for s in stats)


ORACLE["baseline_table"] = " UNION ALL ".join([
    _unpivot(ORACLE["describe_scores"], "describe", "cohort", "score",
             ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
    _unpivot(ORACLE["mann_whitney"], "mann_whitney", "'main_vs_validation'", "score", ["u", "z"]),
    _unpivot(ORACLE["chi_square"], "chi_square", "'main_vs_validation'", "outcome", ["chi2", "dof"]),
    _unpivot(ORACLE["outcome_freq"], "frequency", "cohort", "outcome || '=' || CAST(y AS VARCHAR)", ["n"]),
])
ORACLE["match_histogram"] = _build("""
SELECT hits, count(*) AS visits FROM (
  SELECT v.visit_id, CAST(count(h.visit_id) AS BIGINT) AS hits FROM visits v
  LEFT JOIN hits h ON h.visit_id = v.visit_id GROUP BY v.visit_id) GROUP BY hits""",
    extra={"wide": _WIDE_SQL, "hits": _HITS}, views=("lab", "visits"))


# ------------------------------------ score dataset (R7), its curves (E9), comparison
_SCORE_COLUMNS = {"CURB": "curb_risk", "MEDS": "meds_risk", "REMS": "rems_risk", "abbMEDS": "abbmeds_risk"}
_SCORES = f"SELECT s.*, o.y FROM ({ORACLE['score_risk']}) s JOIN ({ORACLE['outcome_31d']}) o ON s.case_id = o.case_id"
ORACLE["score_dataset"] = " UNION ALL ".join(
    f"SELECT case_id, CAST(y AS INTEGER) AS y, CAST({c} AS DOUBLE) AS p, '{s}' AS score FROM ({_SCORES})" for s, c in _SCORE_COLUMNS.items())


def _risk_curves(score: str, body: str, band: str = "ci") -> str:
    ctes = {"d": f"SELECT case_id, y, {_SCORE_COLUMNS[score]} AS p FROM ({_SCORES})", **kfold_sql("d", "case_id", "y", 3),
            "scored": f"SELECT '{score}' AS model, e.i AS fold, f.y, f.p FROM folded f JOIN range(3) e(i) ON f.fold <> e.i", **_CUM}
    return with_ctes([], ctes, body)


ORACLE["cv_risk_band"] = _risk_curves("CURB", f"""
SELECT model, j, {_R6(['fpr', 'mean_tpr', 'std_tpr', 'upper', 'lower'])},
  round(greatest(mean_tpr - std_tpr, 0.0), 6) AS lower_sd, round(least(mean_tpr + std_tpr, 1.0), 6) AS upper_sd FROM band""")
_SUMMARY = f"SELECT model, {_R6(['mean_auc', 'std_auc', 'ci_low', 'ci_high'])} FROM summary"
ORACLE["compare_data_models"] = " UNION ALL ".join(
    [f"SELECT *, 'models' AS entry FROM ({ORACLE['compare_models']})"]
    + [f"SELECT *, '{s}' AS entry FROM ({_risk_curves(s, _SUMMARY)})" for s in ("CURB", "MEDS")])

# ---------------------------------------------- parts of the fits with an exact answer
ORACLE["cv_counts"] = with_ctes(["cases"], {"d": f"SELECT case_id, {_Y31} AS y FROM cases", **kfold_sql("d", "case_id", "y", 5)}, """
SELECT 'logistic' AS model, CAST(fold AS INTEGER) AS fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, count(*) AS n_scored
FROM folded GROUP BY fold""")
ORACLE["attribution_sums"] = "SELECT CAST(ceil(0.3 * count(*)) AS BIGINT) AS n_cases, CAST(0 AS DOUBLE) AS gap FROM orders"


# ------------------------------------------------------------------ p-values
def erfc_sql(x: str) -> str:
    """Upper error function by the series of erf; 0 beyond 5, where it is under 2e-12."""
    term = f"(CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END) * exp((2 * k + 1) * ln({x}) - lgamma(k + 1)) / (2 * k + 1)"
    return (f"CASE WHEN {x} <= 0 THEN 1.0 WHEN {x} > 5 THEN 0.0 "
            f"ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 120), lambda k: {term})) END")


ORACLE["mann_whitney_p"] = f"SELECT *, round(0.5 * ({erfc_sql('(abs(z) / sqrt(2))')}), 6) AS p FROM ({ORACLE['mann_whitney']})"
_CHI_EXACT = ORACLE["chi_square"].replace("round(sum(power(adj - e, 2) / e), 6) AS chi2", "sum(power(adj - e, 2) / e) AS chi2")
ORACLE["chi_square_p"] = (f"SELECT * REPLACE (round(chi2, 6) AS chi2), round({erfc_sql('sqrt(chi2 / 2)')}, 6) AS p "   # two outcomes: one degree
                          f"FROM ({_CHI_EXACT})")
ORACLE["baseline_table"] = " UNION ALL ".join([
    ORACLE["baseline_table"],
    _unpivot(ORACLE["mann_whitney_p"], "mann_whitney", "'main_vs_validation'", "score", ["p"]),
    _unpivot(ORACLE["chi_square_p"], "chi_square", "'main_vs_validation'", "outcome", ["p"]),
])


# ------------------------------------------------- parsing of text columns
_TEXTS = """
SELECT o_orderkey AS case_id, strftime(o_orderdate, '%Y-%m-%d') AS day,
  ([strftime(o_orderdate, '%d-%m-%Y') || ' 08:15', '31-02-2020 08:00', NULL, 'soon'])[o_orderkey % 4 + 1] AS stamp,
  (['13:45', '08:15:30', NULL, 'noon', '25:00'])[o_orderkey % 5 + 1] AS clock,
  ([CAST(o_orderkey AS VARCHAR), NULL, o_orderkey || 'd', ' ' || o_orderkey])[o_orderkey % 4 + 1] AS "key" FROM orders"""
_CLOCK = "COALESCE(try_strptime({d} || ' ' || {c}, '%Y-%m-%d %H:%M:%S'), try_strptime({d} || ' ' || {c}, '%Y-%m-%d %H:%M'))"
ORACLE["parse_coerce"] = with_ctes([], {"t": _TEXTS}, f"""
SELECT case_id, {ts_text("try_strptime(stamp, '%d-%m-%Y %H:%M')")} AS ts FROM t""")
ORACLE["arrival_fill"] = with_ctes([], {"t": _TEXTS}, f"""
SELECT case_id, {ts_text(_CLOCK.format(d="day", c="COALESCE(clock, '07:00:00')"))} AS arrival,
  COALESCE(CAST(hour({_CLOCK.format(d="'1970-01-01'", c="clock")}) AS INTEGER), -1) AS hour FROM t""")
ORACLE["null_key_drop"] = with_ctes([], {"t": _TEXTS}, f"""
SELECT case_id, CAST({guarded_double('"key"')} AS BIGINT) AS "key" FROM t WHERE {guarded_double('"key"')} IS NOT NULL""")
ORACLE["step_counts"] = with_ctes(["lab"], {"lab_f": BUILD_CTES["lab_f"], "top": BUILD_CTES["top"], "l": f"""
SELECT patient, CASE WHEN seq % 17 <> 0 THEN ts END AS ts, COALESCE(code IN ({_list(DENY_CODES)}), true) AS denied,
  COALESCE(code IN (SELECT code FROM top), false) AS used FROM lab"""}, """
SELECT count(*) AS rows, count(*) FILTER (denied) AS denied, count(*) FILTER (NOT denied AND NOT used) AS rare,
  count(*) FILTER (used AND ts IS NULL) AS no_time, count(*) FILTER (used AND ts IS NOT NULL AND patient IS NULL) AS no_patient,
  count(*) FILTER (used AND ts IS NOT NULL AND patient IS NOT NULL) AS "left",
  count(DISTINCT patient) FILTER (used AND ts IS NOT NULL) AS patients FROM l""")


# ------------------------------------------- fits: what they cannot change
_FOLDED = {"d": f"SELECT case_id, {_Y31} AS y FROM cases", **kfold_sql("d", "case_id", "y", 5)}
_PER_FOLD = "SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos FROM folded GROUP BY fold"
ORACLE["distil_counts"] = with_ctes(["cases"], _FOLDED, f"""
SELECT 'top' || s AS model, f.*, n AS n_scored FROM ({_PER_FOLD}) f, (VALUES (20), (15), (10), (5), (3), (1)) v(s)""")
ORACLE["grid_counts"] = with_ctes(["cases"], _FOLDED, f"""
SELECT CAST(d AS INTEGER) AS max_depth, CAST(t AS INTEGER) AS n_trees, f.*
FROM ({_PER_FOLD}) f, (VALUES (3), (5), (7), (9), (11), (13), (15)) v(d), (VALUES (100), (150), (200), (250), (300), (350)) w(t)""")
ORACLE["compare_algorithms_counts"] = with_ctes(["cases"], _FOLDED, f"""
SELECT m AS model, f.*, n AS n_scored FROM ({_PER_FOLD}) f, (VALUES ('NN'), ('XGB'), ('LR'), ('RF'), ('LGB')) v(m)""")
ORACLE["impute_mice_cells"] = _build(" UNION ALL ".join(
    f"SELECT 'lab_{c}' AS \"column\", count(lab_{c}) AS n_observed, round(sum(lab_{c}), 3) AS sum_observed, "
    f"CASE WHEN count(lab_{c}) > 0 THEN count(*) - count(lab_{c}) ELSE 0 END AS n_imputed, "
    f"CASE WHEN count(lab_{c}) > 0 THEN 0 ELSE count(*) END AS n_empty FROM raw" for c in _NUM), extra={"raw": _RAW})

# ---------------------------------------------------------- scaling per fold
_SCALED = ("Pols", "TRC", "URESE")
ORACLE["scale_fold"] = with_ctes(["cases"], {
    "d": f"SELECT case_id, {_Y31} AS y, {', '.join(_SCALED)} FROM cases", **kfold_sql("d", "case_id", "y", 5),
    "m": "SELECT e.fold, " + ", ".join(f"avg(f.{c}) AS m_{c}, stddev_pop(f.{c}) AS s_{c}" for c in _SCALED)
         + " FROM (SELECT DISTINCT fold FROM folded) e JOIN folded f ON f.fold <> e.fold GROUP BY e.fold"}, f"""
SELECT f.case_id, CAST(f.fold AS INTEGER) AS fold, {', '.join(f'round((d.{c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}' for c in _SCALED)}
FROM folded f JOIN d ON d.case_id = f.case_id JOIN m ON m.fold = f.fold""")

# ------------------------------------------------------------ steps, extracts
_STEPS = (("lab results", "lab"), ("allowed codes", "lab_f"), ("frequent codes", "lab_t"), ("grouped times", "anchored"), ("first results", "dedup"),
          ("presentations", "wide"), ("visits", "visits"),
          ("written", "(SELECT visit_id FROM hits GROUP BY visit_id HAVING count(*) = 1)"))
ORACLE["build_steps"] = _build(" UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS position, '{name}' AS step, (SELECT count(*) FROM {src}) AS n_rows" for k, (name, src) in enumerate(_STEPS)),
    extra={"wide": _WIDE_SQL, "hits": _HITS}, views=("lab", "visits"))
ORACLE["extract_scan"] = with_ctes(["lab"], {}, f"""
SELECT patient, 'L' || seq AS labno, {ts_text("date_trunc('minute', ts)")} AS ts, code, NULLIF(result, '') AS result
FROM lab WHERE patient IS NOT NULL AND seq % 41 <> 0 AND (seq % 89 <> 0 OR seq % 97 = 0)""")
ORACLE["extract_quarantine"] = with_ctes(["lab"], {"l": """
SELECT seq, year(ts) AS year, concat_ws(';', CASE WHEN seq % 41 = 0 THEN '' ELSE COALESCE(CAST(patient AS VARCHAR), '') END, 'L' || seq,
  strftime(ts, '%d-%m-%Y %H:%M'), COALESCE(code, ''), COALESCE(result, ''), CASE WHEN seq % 5 = 0 THEN 'Müller' ELSE 'Jansen' END)
  || CASE WHEN seq % 97 = 0 THEN '' ELSE ';01-01-1950;extra' END AS line FROM lab WHERE seq % 97 = 0 OR seq % 89 = 0"""}, """
SELECT CAST(year AS INTEGER) AS year, CASE WHEN seq % 97 = 0 THEN 'too few fields' ELSE 'too many fields' END AS reason, seq % 97 = 0 AS used,
  CAST(CASE WHEN seq % 97 = 0 THEN 6 ELSE 8 END AS INTEGER) AS n_fields, count(*) AS n_lines,
  count(*) FILTER (seq % 5 = 0) AS n_umlaut, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM l GROUP BY ALL""")

# ------------------------------------------------- E8 on continuous scores
ORACLE["compare_models_continuous"] = """
WITH c AS (SELECT l_linestatus AS model, l_orderkey % 5 AS fold, CAST(l_extendedprice AS DOUBLE) AS p,
  sum(CAST(l_returnflag = 'R' AS INTEGER)) AS tp, sum(CAST(l_returnflag <> 'R' AS INTEGER)) AS fp FROM lineitem GROUP BY ALL),
cum AS (SELECT *, sum(tp) OVER (PARTITION BY model, fold ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS ctp FROM c),
a AS (SELECT model, fold, sum(CAST(fp AS DOUBLE) * (2 * ctp - tp)) / (2 * CAST(sum(tp) AS DOUBLE) * sum(fp)) AS auc FROM cum GROUP BY model, fold)
SELECT model, round(stddev_pop(auc), 6) AS std_auc, count(*) AS n_folds, round(min(auc), 6) AS min_auc, round(max(auc), 6) AS max_auc FROM a GROUP BY model
"""


# ------------------------------------------------------- stored tables, text
ORACLE["visit_scan"] = with_ctes(["visits"], {}, f"""
SELECT visit_id AS visit_no, nummer,
  {ts_text("CASE WHEN visit_id % 11 = 0 THEN CAST(CAST(Datum_SEH AS DATE) AS TIMESTAMP) + INTERVAL 7 HOUR ELSE Datum_SEH END")} AS Datum_SEH,
  CASE WHEN visit_id % 7 <> 0 THEN CAST(40 + visit_id % 90 AS DOUBLE) END AS Pols
FROM visits WHERE nummer IS NOT NULL""")
ORACLE["data_model_scan"] = with_ctes(["cases", "cohort"], {"c": f"""
SELECT {_Y31} AS y, CASE WHEN (nummer, CAST(Datum_SEH AS DATE)) IN (SELECT (nummer, Datum_SEH) FROM cohort) THEN 'validation' ELSE 'main' END AS split
FROM cases"""}, """
SELECT CAST(m AS INTEGER) AS data_model, split, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, CAST(k AS INTEGER) AS n_columns
FROM c, (VALUES (1, 7), (3, 22)) v(m, k) GROUP BY m, k, split""")
ORACLE["model_store"] = "SELECT CAST(ceil(0.3 * count(*)) AS BIGINT) AS n, CAST(ceil(0.3 * count(*)) AS BIGINT) AS n_equal FROM orders"
ORACLE["estimate_text"] = with_ctes(["scored"], {
    "c": "SELECT model, fold, p, sum(y) AS tp, sum(1 - y) AS fp FROM scored GROUP BY ALL",
    "cum": "SELECT *, sum(tp) OVER (PARTITION BY model, fold ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS ctp FROM c",
    "a": "SELECT model, fold, sum(CAST(fp AS DOUBLE) * (2 * ctp - tp)) / (2 * CAST(sum(tp) AS DOUBLE) * sum(fp)) AS auc FROM cum GROUP BY model, fold"}, """
SELECT model, fold, printf('%.3f (%.3f-%.3f)', auc, min(auc) OVER (PARTITION BY model), max(auc) OVER (PARTITION BY model)) AS estimate FROM a""")
