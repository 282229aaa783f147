from sheafline.llm import canonical as Q

CANON = [(1, "en", "Safety instructions"), (1, "es", "Instrucciones de seguridad"), (2, "en", "Cleaning and care"), (2, "fr", "Nettoyage et soin"), (3, "en", "Shelf life"), (4, "en", "Commissioning"), (5, "en", "Decommissioning")]
CASES = {
    "Safety instructions": 1, "4.2 SAFETY_INSTRUCTIONS (p. 7)": 1, "Instructions, safety": 1, "Safety inst ructions - B-CU-12": 1, "Safety instruc.": 1, "Sfaety instrutcions": 1,
    "Instrucciones de seguridad / Safety instructions": 1, "Care and Cleaning": 2, "Cleaning & care": 2, "Ｃｌｅａｎｉｎｇ and care": 2, "Nettoyageetsoin": 2, "Shelf life...": 3,
    "Commi ssioning": 4, "Decommissioning (Lindrake)": 5, "Chapter 12": 0, "": 0, "Русский": 0, "§ 4": 0, "Dear reader": 0, "X" * 5000: 0,
}


def test_titles(spark):
    canon = spark.createDataFrame(CANON + [(None, "en", "x"), (9, "en", None)], "canon_id int, lang string, title string")
    titles = spark.createDataFrame([(t, 1) for t in [*CASES, *CASES, None]], "title string, form int")
    got = {r.title: r.canon_id for r in Q.resolve(titles, canon).collect()}
    assert got == CASES
    assert Q.resolve(titles.limit(0), canon).count() == 0
    assert {r.canon_id for r in Q.resolve(titles, canon.limit(0)).collect()} == {0}


def test_partition_join_finds_every_near_form(spark):
    """Against comparing each open form with each reference form."""
    import random

    rng = random.Random(5)
    canon = [(i, "en", "".join(rng.choices("abcd", k=rng.randrange(3, 16)))) for i in range(30)]
    typed = set()
    for _, _, t in canon:
        for _ in range(10):
            u = list(t)
            for _ in range(rng.randrange(6)):
                p = rng.randrange(len(u))
                u[p : p + rng.randrange(2)] = rng.choice("abcd")  # never empty
            typed.add("".join(u))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    k = lambda n: min(4, (n - 2) // 2)
    got = {r.title: r.edits for r in Q.resolve(spark.createDataFrame([(t,) for t in typed], "title string"), spark.createDataFrame(canon, "canon_id int, lang string, title string")).collect()}
    for t in typed:
        near = [d for _, _, c in canon for d in [distance(t, c)] if d <= k(len(c))]
        assert got[t] == (min(near) if near else None), t


def test_short_and_other_alphabets(spark):
    canon = spark.createDataFrame([(1, "en", "Use"), (2, "en", "Care"), (3, "ru", "Безопасность"), (4, "el", "Συντήρηση")], "canon_id int, lang string, title string")
    cases = {"USE": 1, "3. Use": 1, "Usk": 0, "Caré": 2, "Cara": 2, "C.": 0, "Безопасность": 3, "Безопаснсть": 3, "Συντήρηση": 4, "Гарантия": 0}
    got = {r.title: r.canon_id for r in Q.resolve(spark.createDataFrame([(t,) for t in cases], "title string"), canon).collect()}
    assert got == cases
