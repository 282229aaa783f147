"""Layout operators against small models in plain Python, on random pages."""

import random

import pytest
from pyspark.sql import functions as F

from sheafline.operators import lines as L, sections as S, tables as TB
from sheafline.sources.documents import LINE_SCHEMA, html_lines, spans_to_lines, text_lines


def page(spark, rows, **more):
    base = {"doc_id": "d", "page": 0, "text": "some words here", "x1": 500.0, "font_size_avg": 10.0, "is_bold": False, "is_upper": False, "font_name": "f",
            "column_id": 0, "header_level": "non_header", "is_table_like": False, "toc_page_number": None}
    names = [c.split()[0] for c in LINE_SCHEMA.split(", ")]
    full = []
    for i, r in enumerate(rows):
        r = base | {"line_no": i, "x0": 72.0, "y0": 12.0 * i} | more | r
        full.append(tuple(r.get(n, r["y0"] + 10 if n == "y1" else None) for n in names))
    return spark.createDataFrame(full, LINE_SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_rows_and_islands(spark, seed):
    rng = random.Random(seed)
    rows = [{"y0": float(rng.randrange(0, 400, 7)), "x0": float(rng.choice([72, 200, 320])), "text": rng.choice(["a b", "one two three four five six seven eight nine"])} for _ in range(40)]
    df = page(spark, rows)
    order = sorted(range(40), key=lambda i: (rows[i]["y0"], rows[i]["x0"], i))
    chained, anchored, n, m = {}, {}, 0, 0
    for k, i in enumerate(order):
        y = rows[i]["y0"]
        n += k == 0 or abs(y - rows[order[k - 1]]["y0"]) > 10
        chained[i] = n
        if k == 0 or abs(y - first) > 3:
            m, first = m + 1, y
        anchored[i] = m
    assert {r.line_no: r.row_no for r in L.visual_rows(df).collect()} == chained
    assert {r.line_no: r.row_no for r in L.anchored_rows(df).collect()} == anchored
    flags = {k: sum(len(rows[i]["text"].split()) <= 8 for i in g) >= 2 and len(g) >= 2 for k in set(chained.values()) for g in [[i for i in chained if chained[i] == k]]}
    like, run = set(), []
    for k in [*sorted(flags), None]:
        if k is not None and flags[k]:
            run.append(k)
        else:
            like |= set(run) if len(run) >= 4 else set()
            run = []
    got = {r.line_no for r in L.mark_table_like(df).where("is_table_like").collect()}
    assert got == {i for i in chained if chained[i] in like}


def test_mode_ties_go_to_the_first_and_upper_median(spark):
    df = page(spark, [{"font_size_avg": s, "x0": x} for s, x in ((12.0, 1.0), (10.0, 2.0), (10.0, 3.0), (12.0, 4.0))])
    assert L.body_font(df).first().body_size == 12.0
    assert df.agg(L.upper_median().alias("m")).first().m == 3.0


@pytest.mark.parametrize(
    ("line", "score"),
    [({"text": "mild"}, -999), ({"text": "Parts of the"}, -999), ({"text": "Quick start guide"}, 10), ({"text": "ABC-123"}, -999), ({"text": "42"}, -999),
     ({"text": "Intro ..... 12"}, -999), ({"text": ""}, -999), ({"text": None}, -999), ({"text": "• dot"}, -999), ({"text": "a) list"}, -999)],
)
def test_header_rules(spark, line, score):
    df = page(spark, [line]).withColumns({"body_size": F.lit(10.0), "body_font": F.lit("f")})
    assert L.scored(df, F.lit(0)).first().header_score == score


def test_columns(spark):
    left = [{"x0": x} for x in (50.0, 60.0, 52.0, 58.0, 55.0)]
    right = [{"x0": 350.0 + i} for i in range(5)]
    df = page(spark, left + right, x1=600.0)
    assert L.split_points(df).first().splits == [205.0]
    assert [r.column_id for r in L.detect_columns(df).orderBy("line_no").collect()] == [0] * 5 + [1] * 5
    alone = page(spark, left * 4 + right[:1], x1=600.0)  # too few lines on the right
    assert {r.column_id for r in L.detect_columns(alone).collect()} == {0}


def test_sections(spark):
    h = {"header_level": "section_header"}
    df = page(spark, [{"text": "before"}, {"text": "H1", **h}, {"text": "H2", **h}, {"text": "body"}, {"text": "H3", **h, "page": 1, "y0": 0.0}, {"text": "end", "page": 1, "y0": 20.0}])
    sections, items = S.segment(df)
    found = sections.orderBy("section_no").collect()
    assert [(r.section_id, r.raw_title, r.page_start, r.page_end) for r in found] == [("sec_1", "OPENING", 1, 1), ("sec_2", "H2", 1, 2), ("sec_3", "H3", 2, 2)]
    text = {r.section_no: r.text_plain for r in S.section_text(items).collect()}
    assert text == {1: "before", 2: "body", 3: "end"}
    assert S.segment(df.limit(0))[0].count() == 0


def model(lines, tables, images, index):
    """Sections by walking along one document's lines, as a person would."""
    lines = sorted((x for x in lines if x["page"] not in index), key=lambda x: (x["page"], x["column_id"], x["y0"], x["x0"], x["line_no"]))
    tables = sorted((t for t in tables if t["page"] not in index), key=lambda t: t["y0"])
    waiting, out, current, title, start = list(tables), [], [], "OPENING", lines[0]["page"]

    def close(page):
        nonlocal current
        if current:
            out.append([title, start + 1, page + 1, current])
        current = []

    for x in lines:
        holds = sorted((t for t in tables if t["page"] == x["page"] and x["x0"] >= t["x0"] and x["x1"] <= t["x1"] and x["y0"] >= t["y0"] and x["y1"] <= t["y1"]), key=lambda t: t["table_id"])
        header = x["header_level"] == "section_header"
        if holds and not header:
            continue
        reach = holds[0]["y0"] - 0.001 if holds else x["y0"]
        current += [t["table_id"] for t in waiting if t["page"] == x["page"] and t["y0"] <= reach]
        waiting = [t for t in waiting if not (t["page"] == x["page"] and t["y0"] <= reach)]
        if header:
            close(x["page"])
            title, start = x["text"], x["page"]
        else:
            current.append(x["line_no"])
    tops = {t["page"]: min(u["y0"] for u in tables if u["page"] == t["page"]) for t in tables}
    current += [t["table_id"] for t in sorted(waiting, key=lambda t: (tops[t["page"]], t["y0"]))]
    close(lines[-1]["page"])
    for i in images:
        fits = [s for s in out if s[1] <= i["page"] + 1 <= s[2]]
        if i["page"] not in index and i["ocr_text"] and fits:
            fits[0][3].append(i["image_id"])
    return out


def test_segmentation_is_that_of_a_walk(spark):
    import random

    rng = random.Random(4)
    lines, tables, images, index = [], [], [], []
    for d in range(25):
        levels = rng.choices(["section_header", "subheader", "non_header"], [1, 1, 4], k=rng.randrange(1, 25))
        for n, level in enumerate(levels):
            y = float(rng.randrange(0, 60) * 10)
            lines.append({"doc_id": f"d{d}", "page": rng.randrange(4), "line_no": n, "column_id": rng.randrange(2), "text": f"t{n}", "header_level": level, "x0": 10.0, "y0": y, "x1": 90.0, "y1": y + 9})
        for n in range(rng.randrange(6)):
            y = float(rng.randrange(0, 60) * 10) + n / 100
            tables.append({"doc_id": f"d{d}", "page": rng.randrange(5), "table_id": f"tab{n}", "x0": 0.0, "y0": y, "x1": 100.0, "y1": y + rng.randrange(20, 200), "columns": ["a"], "rows": [["1"]]})
        images += [{"doc_id": f"d{d}", "page": rng.randrange(5), "image_id": f"img{n}", "ocr_text": rng.choice(["x", "", None])} for n in range(rng.randrange(4))]
        index += [{"doc_id": f"d{d}", "page": 3}] if d % 3 == 0 else []
    frames = [spark.createDataFrame(x, s) for x, s in (
        (lines, "doc_id string, page int, line_no int, column_id int, text string, header_level string, x0 double, y0 double, x1 double, y1 double"),
        (tables, "doc_id string, page int, table_id string, x0 double, y0 double, x1 double, y1 double, columns array<string>, rows array<array<string>>"),
        (images, "doc_id string, page int, image_id string, ocr_text string"), (index, "doc_id string, page int"),
    )]
    sections, items = S.segment(*frames)
    got = {}
    for r in sections.collect():
        got.setdefault(r.doc_id, {})[r.section_no] = [r.raw_title, r.page_start, r.page_end, []]
    for r in items.orderBy("item_no").collect():
        got[r.doc_id][r.section_no][3].append(r.id if r.id is not None else r.line_no)
    of = lambda x, d: [y for y in x if y["doc_id"] == d]
    for d in {x["doc_id"] for x in lines}:
        skip = {x["page"] for x in of(index, d)}
        want = model(of(lines, d), of(tables, d), sorted(of(images, d), key=lambda i: (i["page"], i["image_id"])), skip) if [x for x in of(lines, d) if x["page"] not in skip] else []
        assert [got.get(d, {})[n] for n in sorted(got.get(d, {}))] == want, d


def test_table_blocks_merge_continuations(spark):
    rows = []
    for y in (0, 20, 40, 60, 80):
        rows += [{"y0": float(y), "x0": 72.0, "text": f"a{y}"}, {"y0": float(y), "x0": 200.0, "text": f"b{y}"}]
    rows.append({"y0": 95.0, "x0": 202.0, "text": "more"})
    df = page(spark, rows, is_table_like=True)
    block = TB.table_blocks(df).first()
    assert block.columns == ["a0", "b0"] and block.rows[-1] == ["a80", "b80 more"] and block.table_id == "table_p1_1"


def test_sources(spark):
    assert text_lines(spark.createDataFrame([("d", "a\n\nb"), ("e", None), ("f", "")], "doc_id string, text string")).count() == 2
    html = "<head><title>t</title></head><h1>Title</h1><script>var a='</p>';</script><p>One &amp; two</p>"
    got = html_lines(spark.createDataFrame([("d", html)], "doc_id string, html string"), "doc_id", "html").orderBy("line_no").collect()
    assert [(r.text, r.is_bold) for r in got] == [("Title", True), ("One & two", False)]
    spans = spark.createDataFrame(
        [("d", 0, 0, 0, "Care", 72.0, 0.0, 100.0, 10.0, 10.0, 16, "Arial"), ("d", 0, 0, 1, "7", 400.0, 0.0, 410.0, 10.0, 12.0, 0, "Arial"), ("d", 0, 1, 0, "  ", 0.0, 0.0, 1.0, 1.0, 0.0, 0, "")],
        "doc_id string, page int, line_no int, span_no int, text string, x0 double, y0 double, x1 double, y1 double, size double, flags int, font string",
    )
    line = spans_to_lines(spans).collect()
    assert len(line) == 1 and (line[0].text, line[0].font_size_avg, line[0].is_bold, line[0].toc_page_number, line[0].font_name) == ("Care 7", 11.0, True, 7, "arial")
