import pytest

from sheafline.llm import scannoise as Q

BODY = ["Inspect the upper pump before every cleaning and dry", "the rear valve with a soft cloth until the pressure drops", "The motor must not be opened while the lamp is green"]
LINES = "line_uid bigint, doc_id string, page int, line_no int, text string, header_level string, is_table_like boolean, toc_page_number int, font_name string"
SECTIONS = "section_uid bigint, doc_id string, page_start int, page_end int, text_plain string"
IMAGES = "image_uid bigint, doc_id string, page int, ocr_text string"


@pytest.mark.parametrize(
    ("line", "number"),
    [("– 1 –", "1"), ("[12]", "12"), ("12|", "12"), ("Page 2 of 5", "2"), ("l / 9", "1"), ("p. 4", "4"), ("7", "7"), ("| 12", None), ("oil.", None), ("57.3", None), ("40 V", None), ("l", None), ("", None), ("§ 4", None)],
)
def test_page_numbers(line, number):
    assert Q.page_number(line) == number


def test_keys_meet_whatever_the_form():
    keys = {Q.line_key(x) for x in ("Norrin / Air Curtain / 3", "air curtain | Norrin", "12   N0rrin air cvrtain")}
    assert len(keys) == 1 and "" not in keys
    assert Q.line_key("until the pressure drops.") == "" == Q.line_key("") == Q.line_key("12")


def tables(spark):
    lines, uid = [], 0
    for page in range(4):
        text = ["Norrin / Air Curtain" if page % 2 else "air curtain | N0rrin", *BODY, "Care of the pvmp and of the valve" if page == 1 else "Care of the pump and of the valve"]
        text += ["at low-", "and high-speed settings the motor", "must be clo-", "sed and the pres-" if page == 2 else ("sed at night", "sed by hand", "", "sed with care")[page], f"- {page + 1} -"]
        for n, t in enumerate(text):
            lines.append((uid, "d", page, n, t, "non_header", False, None, ""))
            uid += 1
    lines += [(uid, "d", 3, 20, None, None, None, None, None), (900, None, None, None, "x", None, None, None, None), (lines[0][0], *lines[0][1:])]
    plain = [(1000 + i, "e", i // 30, i % 30, BODY[i % 3] + " pressure closed pump valve", "non_header", False, None, "helvetica") for i in range(60)]
    sections = [(1, "d", 1, 4, "\n".join([*BODY[:2], "Norrin / Air Curtain", "- 2 -", "and the pres-", "sure drops."])), (2, "d", 1, 1, None), (3, "d", 1, 1, ""), (4, "e", 1, 1, "\n".join(BODY)), (None, None, None, None, "- 2 -"), (5, "d", 1, 1, "the vvarm pump with a soft c1oth.\n\nA | 12\n| 4")]
    images = [(1, "d", 9, "AIR CURTAIN | Norrin\nthe rear va1ve with a soft cloth."), (2, "d", 0, None), (3, "z", 0, "12 V"), (None, None, None, "- 2 -"), (7, None, None, "plain")]
    return spark.createDataFrame(lines + plain, LINES), spark.createDataFrame(sections, SECTIONS), spark.createDataFrame(images, IMAGES)


def test_found(spark):
    got = sorted((r.record_type, r.record_id, r.kind) for r in Q.found(*tables(spark)).collect())
    want = []
    for page in range(4):
        first = page * 10
        want += [("line", first, "header"), ("line", first + 7, "hyphen"), ("line", first + 9, "page_number")]
    want += [("line", 14, "misread"), ("line", 28, "hyphen")]
    want += [("section", 1, "header"), ("section", 1, "hyphen"), ("section", 1, "page_number"), ("section", 5, "misread"), ("image", 1, "header"), ("image", 1, "misread")]
    assert got == sorted(want)


def test_empty(spark):
    assert Q.found(*(t.limit(0) for t in tables(spark))).count() == 0


def test_repair():
    known = Q.Vocabulary({"pressure": 90, "drops": 50, "left": 40, "hand": 40, "left-hand": 0, "valve": 70, "the": 900}, {})
    text = "the pres-\nsure drops\n- 4 -\nNorrin Curtain\nthe left-\nhand va1ve\n\nthe end"
    assert Q.repaired(text, known, frozenset({Q.line_key("Norrin Curtain")})) == "the pressure drops the left-hand valve\n\nthe end"


def test_paragraphs(spark):
    got = {(r.record_type, r.record_id, r.doc_id, r.page): r.text for r in Q.paragraphs(*tables(spark)).collect()}
    assert {k[3] for k in got if k[0] == "page" and k[2] == "d"} == {0, 1, 2, 3}
    pages = [got["page", None, "d", n] for n in range(4)]
    assert not any("Norrin" in t or "N0rrin" in t or t.endswith("-") for t in pages)
    assert "low- and high-speed" in pages[0] and "must be closed at night" in pages[0]
    assert "Care of the pump and of the valve" in pages[1]
    assert got["section", 1, "d", None].endswith("and the pressure drops.") and "- 2 -" not in got["section", 1, "d", None]
    assert got["image", 1, "d", 9] == "the rear valve with a soft cloth."
    assert ("section", 2, "d", None) not in got
    assert Q.paragraphs(*(t.limit(0) for t in tables(spark))).count() == 0


def test_paragraphs_over_pages(spark):
    words = "the motor and the pump have a res or"
    lines = [(i, "w", 0, i, words + " motor motor", "non_header", False, None, "f") for i in range(6)]
    texts = [(1, 0, "Close the mot-"), (1, 1, "3"), (2, 0, "or and the valve"), (2, 1, "must be left-"), (3, 0, "and right-hand")]
    lines += [(100 + i, "x", p, n, t, "non_header", False, None, "") for i, (p, n, t) in enumerate(texts)]
    df = spark.createDataFrame(lines, LINES)
    none = [t.limit(0) for t in tables(spark)[1:]]
    got = {r.page: r.text for r in Q.paragraphs(df, *none).where("doc_id = 'x'").collect()}
    assert got == {1: "Close the motor", 2: "and the valve must be left-", 3: "and right-hand"}
    # A conjunction that completes a known word goes on with it; without the vocabulary it never did.
    kinds = {(r.record_id, r.kind) for r in Q.found(df, *none).collect()}
    assert (100, "hyphen") in kinds and (103, "hyphen") not in kinds


def test_headers_with_misread_letters_meet(spark):
    texts = [("q", 0, "Quillbeck / Sterihzer / 1"), ("q", 1, "Quillbeck / Sterilizer / 2"), ("o", 0, "1 O5kvale Sterihzer"), ("o", 1, "O5kvale Sterilizer 2"), ("o", 2, "Oskvale Sterilizer")]
    texts += [("u", 0, "Upper pump housing"), ("u", 1, "Lower valve housing"), ("v", 0, "Rear pumps"), ("v", 1, "Rear plugs")]
    lines = [(i, d, p, 0, t, "non_header", False, None, "") for i, (d, p, t) in enumerate(texts)]
    lines += [(100 + 10 * i + n, d, p, n, b, "non_header", False, None, "") for i, (d, p, _) in enumerate(texts) for n, b in enumerate(BODY, 1)]
    sections = spark.createDataFrame([(1, "q", 1, 2, "Inspect the pump.\nQuillbeck Sterillzcr\n" + BODY[1]), (2, "v", 1, 2, "Inspect the pump.\nRear pumps\n" + BODY[1])], SECTIONS)
    got = {(r.record_type, r.record_id) for r in Q.found(spark.createDataFrame(lines, LINES), sections, tables(spark)[2].limit(0)).where("kind = 'header'").collect()}
    assert got == {("line", i) for i in range(5)} | {("section", 1)}


def test_headers_of_long_pdfs(spark):
    lines, uid, want = [], 0, set()
    for page in range(40):
        # A chapter's header on three pages of forty; a line of the text that now and then stands at an edge.
        head = "Chapter on rear valves" if page in (10, 12, 20) else f"{BODY[0]} and {page}"
        text = [head, *BODY, "press the green button", *BODY, "press the green button" if page in (5, 6) else BODY[2]]
        for n, t in enumerate(text):
            lines.append((uid, "long", page, n, t, "non_header", False, None, ""))
            if t == "Chapter on rear valves":
                want.add(uid)
            uid += 1
    got = {r.record_id for r in Q.found(spark.createDataFrame(lines, LINES), *(t.limit(0) for t in tables(spark)[1:])).where("kind = 'header'").collect()}
    assert got == want


def test_a_small_broadcast_changes_nothing(spark):
    got = [sorted(map(tuple, Q.found(*tables(spark), most_words=n).collect())) for n in (3, 200_000)]
    assert got[0] == got[1] and ("line", 14, "misread") in got[0]
    texts = [sorted(map(str, Q.paragraphs(*tables(spark), most_words=n).collect())) for n in (3, 200_000)]
    assert texts[0] == texts[1]
