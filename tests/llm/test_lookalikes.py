import unicodedata
from collections import Counter

from sheafline.llm import lookalikes as Q

CASES = {
    "ｔｈｅ main panel": "the main panel", "válvula": "válvula", "Nen​ndruck": "Nenndruck", "a b　c": "a b c", "ﬁlter": "filter", "left‑hand": "left-hand",
    "соupling ring": "coupling ring", "serνice": "service", "ｓеｃ": "sec",
}
SAME = ["Русский", "10 kΩ", "Ω", "déjà vu", "– 1 –", "plain", "", None, "50 µm", "x" * 20000]


def test_forms(spark):
    rows = [(i, t) for i, t in enumerate([*CASES, *SAME])] * 2
    plain = [(1000 + i, "the plain coupling service filter abcdefghijklmnopqrstuvwxyz á left-hand") for i in range(50)]
    df = spark.createDataFrame(rows + plain, "id bigint, text string")
    got = {r.text: r.form for r in Q.consistent(df, "text", ["id"]).collect()}
    assert got == CASES
    assert Q.consistent(df, "text", ["id"]).count() == 2 * len(CASES)
    assert Q.consistent(df.limit(0), "text", ["id"]).count() == 0


def test_representative_is_the_frequent_member():
    many = Counter({"a": 5, "а": 50})  # a collection in which the Cyrillic letter rules
    assert Q.representatives(many) == {"a": "а"}
    assert Q.representatives(Counter({"a": 50, "а": 5, "ａ": 1})) == {"а": "a", "ａ": "a"}


def test_forms_are_stable():
    members = Q.representatives(Counter("".join(CASES)) + Counter({"á": 1}) + Counter({c: 100 for c in "abcdefghijklmnopqrstuvwxyzá -"}))
    a = Q.automaton(members)
    for t in CASES:
        once = Q.rewrite(t, a)
        assert Q.rewrite(once, a) == once == unicodedata.normalize("NFC", once)


def test_signs_and_other_alphabets():
    assert (Q._plain("\u212a"), Q._plain("\u212b"), Q._plain("K"), Q._plain("é")) == ("K", "\u00c5", None, None)
    members = Q.representatives(Counter({"Ꮯ": 1, "օ": 1, "\u212a": 1, "C": 9, "o": 9, "K": 9, "l": 9, "d": 9}))
    a = Q.automaton(members)
    assert Q.rewrite("Ꮯօld \u212aey ᎿᎪ", a) == "Cold Key ᎿᎪ"


def test_inventory_is_bounded_however_accents_are_stacked(spark):
    rows = [("e" + "\u0301" * n + "x" + "q\u0302" * n,) for n in range(1, 60)] + [("o\u0323\u0302 ộ ofﬁce office",), (None,), ("",)]
    seen = Q.inventory(spark.createDataFrame(rows, "t string"), "t")
    # The accented letters written out once, no letter with many accents and none that Unicode lacks.
    assert {s for s in seen if len(s) > 1 and s not in Q.LIGATURES} == {"e\u0301", "o\u0323\u0302"}
    assert seen["e\u0301"] == 59 and seen["ffi"] == 1 and seen["ff"] >= 1
