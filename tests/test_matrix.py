from sheafline import config as C
from sheafline.operators import corpus, hints, matrix
from sheafline.streaming.incremental import each_new_document, title_counts, without_redeliveries

SECTIONS = "doc_id string, section_id string, section_no int, page_start int, raw_title string, normalized_title string, text_plain string"


def sections(spark):
    rows = [
        ("d", "sec_1", 1, 1, "Care", "care", "a"), ("d", "sec_2", 2, 1, "Care", "care", "b"), ("d", "sec_3", 3, 2, "OPENING", "opening", "x"),
        ("d", "sec_4", 4, 2, "Installation guide", "installation guide", None), ("e", "sec_1", 1, 1, "Safety", "safety", "s"), ("e", "sec_2", 2, 1, None, None, "t"),
    ]
    return spark.createDataFrame(rows, SECTIONS)


def test_resolution_and_pivot(spark):
    columns = ["safety", "installation", "additional_content"]
    got = matrix.resolve_columns(sections(spark), columns)
    steps = {(r.doc_id, r.raw_title, r.section_no): (r.column, r.step) for r in got.collect()}
    assert steps[("d", "Installation guide", 4)] == ("installation", "first word")
    assert steps[("e", "Safety", 1)] == ("safety", "title")
    assert steps[("d", "Care", 1)] == ("additional_content", "fallback")
    wide = {r.doc_id: r for r in matrix.matrix(got, columns).collect()}
    assert wide["d"].additional_content == "[Care]\nb" and wide["d"].installation == "[Installation guide]" and wide["e"].installation == ""


def test_columns(spark):
    freq = corpus.title_frequency(sections(spark))
    assert matrix.frequent_columns(freq, 2)[-1] == C.DEFAULT.fallback_column
    many = [f"c{i}" for i in range(20)]
    kept, mapped = matrix.capped_columns(many, {"t": "c19", "u": "c3"})
    assert len(kept) == 12 and kept[:2] == ["c3", "c19"] and mapped == {"t": "c19", "u": "c3"}
    row = {r.normalized_title: r for r in freq.collect()}["care"]
    assert (row.doc_count, row.unique_raw_titles, row.raw_variations) == (1, 1, "Care (2)")


def test_hints_rank(spark):
    h = hints.ranked(hints.title_hints(sections(spark)).unionByName(hints.value_hints(sections(spark))))
    care = [r for r in h.collect() if r.target_field == "maintenance"]
    assert [(r.rank, r.source_text) for r in care] == [(1, "Care"), (2, "Care")]
    assert hints.ranked(hints.title_hints(sections(spark).limit(0))).count() == 0


def test_hints_of_tables_with_large_ids(spark):
    rows = [(10**13, "d", 0, ["Limpieza"], [["x"]]), (7, "d", 0, ["Cleaning"], [["y"]])]
    tables = spark.createDataFrame(rows, "table_uid bigint, doc_id string, page int, columns array<string>, rows array<array<string>>")
    h = hints.ranked(hints.column_hints(tables).unionByName(hints.title_hints(sections(spark))))
    named = [r.source_text for r in h.orderBy("target_field", "rank").collect() if r.target_field == "maintenance" and r.hint_type == "table_header_similarity"]
    assert named == ["Cleaning", "Limpieza"]


def test_stale_rows(spark):
    w = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    c = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    assert [r.k for r in matrix.missing_or_stale(w, c, ["k"], "v").collect()] == ["b"]
    rows = spark.createDataFrame([("a", 1, "x", ""), ("b", 2, "", None)], "k string, v int, p string, q string")
    assert [r.k for r in matrix.missing_or_stale(w, rows, ["k"], "v", ["p", "q"]).collect()] == ["b"]  # all empty
    assert matrix.missing_or_stale(w, rows, ["k"], "v", ["p", "new"]).count() == 2  # a column is missing


def test_language_names_among_the_first_headers(spark):
    from sheafline.operators import corpus

    rows = [("d", p, "section_header", f"Manual {x}") for p, x in enumerate(["English", "Deutsch", "FRANÇAIS", "Italiano", "Español"])] + [("d", 0, "non_header", "English")]
    got = corpus.header_facts(spark.createDataFrame(rows, "doc_id string, page int, header_level string, text string")).first()
    assert got.language_headers == sum(any(n in t.lower() for n in corpus.LANGUAGE_NAMES) for _, p, h, t in rows if p < 4 and h != "non_header") > 0


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "doc_id string, version int, raw_title string, ingested_at timestamp"
    rows = "select * from values ('a', 1, 'Care', timestamp'2024-01-01 00:00:00'), ('a', 1, 'Care', timestamp'2024-01-01 00:00:00'), ('b', 1, null, timestamp'2024-01-02 00:00:00') t(doc_id, version, raw_title, ingested_at)"
    spark.sql(rows).write.parquet(src)
    for n in range(2):
        q = each_new_document(spark.readStream.schema(schema).parquet(src), lambda d: d, out, str(tmp_path / f"c{n}"), ["doc_id"], "version")
        q.awaitTermination()
        assert spark.read.parquet(out).count() == 2
    q = without_redeliveries(spark.readStream.schema(schema).parquet(src), ["doc_id"], "ingested_at").writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 2
    assert {(r.normalized_title, r.sections) for r in title_counts(spark.read.parquet(src)).collect()} == {("care", 2), ("other", 1)}
