"""Rows that agree in identifier and text: one of each component stays."""

from tidemark.llm import simhash


def test_one_of_repeated_rows_is_kept(spark):
    text = " ".join(f"word{i}" for i in range(400))
    near = text + " end"
    rows = [(1, text, "a"), (1, text, "b"), (1, text, "c"), (2, near, "d"), (2, near, "e"), (None, "other thing here", "f"), (None, "other thing here", "g"), (3, "alone it is", "h")]
    df = spark.createDataFrame(rows, "doc_id int, text string, place string").repartition(3)
    got = simhash.simhash_dedup(df).collect()
    assert len(got) == len(rows)
    by_component = {}
    for r in got:
        by_component.setdefault(r.component_id, []).append(r.kept)
    assert all(sum(kept) == 1 for kept in by_component.values())
    left = simhash.drop_near_copies(df)
    assert left.columns == df.columns
    kept = {tuple(r)[:2] for r in left.collect()}
    assert kept == {(r.doc_id, dict((x[0], x[1]) for x in rows)[r.doc_id]) for r in got if r.kept}
    assert left.count() == len(by_component)
