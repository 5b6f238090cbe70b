"""Repeated queries of neighbours."""

from catalyne.llm import ann


def test_repeated_query_has_different_neighbours(spark):
    rows = [(i, [1.0, i / 10]) for i in range(20)]
    df = spark.createDataFrame(rows + rows[:2], "vec_id long, embedding array<float>")
    got = sorted((r["rank"], r["vec_id"]) for r in ann.nearest(df, df.where("vec_id = 0")).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
