"""Near duplicates send few rows to Python at once; the session's own setting stays."""

from pagefolio.llm import near_duplicates

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_small_batches_while_sets_are_written(spark, monkeypatch):
    seen = {}
    original = near_duplicates.written

    def noting(df, name):
        seen.setdefault(name, set()).add(int(spark.conf.get(KEY)))
        return original(df, name)

    monkeypatch.setattr(near_duplicates, "written", noting)
    before = spark.conf.get(KEY)
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z u v w"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.near_duplicate_groups(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert seen["sets"] == seen["pairs"] == seen["found"] == {near_duplicates.ARROW_ROWS}
    assert spark.conf.get(KEY) == before


def test_a_smaller_setting_stays(spark):
    before = spark.conf.get(KEY)
    try:
        for given, expected in (("7", 7), ("0", near_duplicates.ARROW_ROWS)):
            spark.conf.set(KEY, given)
            with near_duplicates.small_batches(spark):
                assert int(spark.conf.get(KEY)) == expected
            assert spark.conf.get(KEY) == given
    finally:
        spark.conf.set(KEY, before)
