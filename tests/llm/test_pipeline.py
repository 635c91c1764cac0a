"""The pipeline's stages against plain Python on the small table, and on awkward rows."""

import corpus_pipeline as C

from edcohort.llm import quality as Q

from .data import SF, awkward, documents, empty, needs_tables
from .test_jaccard_join import brute as components
from .test_packing import check
from .test_sql_operators import brute_hits, brute_lines


@needs_tables
def test_stages(spark):
    df = documents(spark)
    rows = {r.doc_id: r for r in df.collect()}
    kept = {r.doc_id for r in Q.quality(df).collect() if r.kept}
    one = C.quality_rules(spark, df, SF)
    assert one.columns == df.columns and {r.doc_id for r in one.collect()} == kept
    lines = sorted(brute_lines([(d, rows[d].text, rows[d].source) for d in sorted(kept)], 5))
    two = C.line_dedup(spark, one, SF)
    assert two.columns == df.columns and sorted([(r.doc_id, r.text) for r in two.collect()]) == lines
    stay = {c for _, _, c in components(lines)}
    three = C.near_duplicates(spark, two, SF)
    assert three.columns == df.columns and {r.doc_id for r in three.collect()} == stay
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d: t for d, t in lines if d in stay and not brute_hits(t, items)[-1]}
    four = C.decontamination(spark, three, SF)
    assert four.columns == df.columns and {r.doc_id: r.text for r in four.collect()} == clean
    last = C.run(spark, SF).collect()
    assert {r.doc_id for r in last} == set(clean)
    check(last, [(d, len(t.split())) for d, t in clean.items()], 2048)


@needs_tables
def test_awkward_rows_pass_all_stages(spark):
    df, _ = awkward(spark)
    for docs in (df, empty(spark)):
        for _, stage in C.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = out
        C.STAGES[-1][1](spark, docs, SF).collect()
