"""Shared inputs: the small driver tables, and rows with every awkward case."""

import os


import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

#: Names that operators use inside, as extra columns of the caller.
CLASHES = ("th", "token", "cls", "h", "w", "s", "p", "site", "pos", "line", "lines", "row", "k1", "_k_id", "_k_th", "_gone", "_hit", "n", "label", "kept", "score",
           "part", "shard", "copies")
LONG = "the quick brown fox jumps over the lazy dog while seven wizards quietly boxed up five dozen liquor jugs for the long winter trip home"


def awkward(spark, extra=()):
    """Null id, null and empty text, null language and source, a repeated row, one id with two texts, a very
    long text, ties, and columns whose names operators use inside."""
    rows = [(1, LONG, "en", "a"), (1, LONG, "en", "a"), (1, "another text of id one", "en", "b"), (2, None, "en", "a"), (3, "", None, None),
            (4, "   \n\t \n", "de", "b"), (None, LONG + " and back", "en", None), (5, LONG, "en", "c"), (6, "one", "xx", "a"),
            (7, " ".join(f"word{k % 977} {LONG}" for k in range(3000)), "en", "a"), (8, "Ünïcödé ñ   x y\n\nÜnïcödé ñ   x y", "es", "b"), *extra]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], schema)
    for c in CLASHES:
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df, rows


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(df) -> pd.DataFrame:
    return df.toPandas()


def thue_morse(n: int) -> tuple[str, str]:
    """Two words of n bytes (a power of two) that a polynomial hash modulo 2**64 cannot tell apart for long n."""
    bits = "a"
    while len(bits) < n:
        bits += bits.translate(str.maketrans("ab", "ba"))
    return bits, bits.translate(str.maketrans("ab", "ba"))
