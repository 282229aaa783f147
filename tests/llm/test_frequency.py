import random
from collections import Counter

from sheafline.llm import frequency as Q


def test_counts_equal_a_plain_count_with_a_hot_term(spark):
    rng = random.Random(1)
    rows = [("t", "hot" if rng.random() < 0.4 else f"w{rng.randrange(300)}", rng.randrange(3)) for _ in range(4000)] + [("u", "hot", 5), ("t", None, 9), ("t", "none", None), ("t", "", 1)]
    df = spark.createDataFrame(rows, "field string, term string, n int").repartition(7)
    want, seen = Counter(), Counter()
    for f, t, n in rows:
        if t is not None:
            want[f, t] += n or 0
            seen[f, t] += 1
    for slots in (4, 256):
        got = {(r.field, r.term): (r.n, r.records) for r in Q.term_counts(df, slots).collect()}
        assert got == {k: (want[k], seen[k]) for k in seen}
    assert ("t", "hot") in Q.heavy_terms(df, 4)


def test_marks_latest_rows_and_empty(spark):
    schema = "run_id int, total_docs int, normalized_title string, doc_count int, raw_titles map<string,int>, computed_at timestamp, mark string"
    sql = """select * from values
      (1, 40, 'care', 9, map('Care', 9), timestamp'2024-01-01', 'x'), (1, 40, 'care', 3, map('Care', 3), timestamp'2024-01-02', 'x'),
      (1, 40, ' care ', 2, map('Care', 1, 'care', 1), timestamp'2024-01-01', 'x'), (1, 40, 'rare', 1, null, timestamp'2024-01-01', null),
      (2, 40, null, 8, map('N', 200), timestamp'2024-01-01', null) t(run_id, total_docs, normalized_title, doc_count, raw_titles, computed_at, mark)"""
    got = {tuple(r) for r in Q.found(spark.sql(sql)).collect()}
    # Care (4) and N (200) are above a hundredth of all 205 raw counts; care (5) is above a twentieth of 80 documents.
    assert got == {("normalized_title", "care", "common"), ("normalized_title", "rare", "rare"), ("raw_title", "care", "rare"), ("raw_title", "N", "common"), ("raw_title", "Care", "common")}
    assert Q.found(spark.createDataFrame([], schema)).count() == 0
