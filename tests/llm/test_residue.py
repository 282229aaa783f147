from sheafline.llm import residue as Q

NATURAL = [
    f"Product X{i}\n\nSafety instructions\n\nInspect the {a} {b} before every cleaning. Loosen the {a} {b} with a torque wrench. In the label editor the field {{{{serial}}}} prints the number of the {b}; do not delete it.\n"
    f"If 'page not found' appears on the panel, update the firmware of the {a} {b}. Enable JavaScript in the browser of the service laptop before you open the web panel of the {a} {b}."
    for i, (a, b) in enumerate((a, b) for a in ("upper", "lower", "rear", "front", "outer") for b in ("pump", "valve", "gauge", "belt", "motor"))
]
RESIDUE = [
    "Inspect the upper {{ model name }} pump before every cleaning.", "Product X9 [INSERT TITLE]\nLoosen the rear belt with a torque wrench.", "Lorem ipsum dolor sit amet consectetur.",
    "Product X7\n\n404 Not Found\nThe requested document could not be located on this server.", "Please enable JavaScript to view this manual.", "Active JavaScript para ver este manual.",
    "Hier Produktbeschreibung einfügen.", "Loosen the outer XXXX-XXXX belt with a torque wrench.", "xxx xxx xxx xxx",
]


def test_documents(spark):
    rows = list(enumerate([*NATURAL * 4, None, "", "Inspect the upper pump. " * 3000])) + [(10_000 + i, t) for i, t in enumerate(RESIDUE)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id for r in Q.found(df).collect()}
    assert got == {10_000 + i for i in range(len(RESIDUE))}
    assert {r.kind for r in Q.spans(df, "doc_id", "text").collect()} == {"template", "filler", "notice"}
    assert Q.without_residue(df, "doc_id", "text").count() == len(NATURAL) * 4 + 2  # a null text has no share of residue to compare
    assert Q.found(df.limit(0)).count() == 0


def test_counts_are_those_of_one_task(spark):
    df = spark.createDataFrame([(t,) for t in NATURAL], "t string")
    a, b = Q.natural_counts(df.repartition(5), "t"), Q.natural_counts(df.coalesce(1), "t")
    assert all((x == y).all() and x.any() for x, y in zip(a, b))


def test_neighbours_are_those_of_the_texts_themselves(spark):
    # So many pairs that bins of a fixed table fill up: what was never met doesn't count, what was met once does.
    texts = [" ".join(f"{chr(97 + (i * 7 + k) % 26)}w{'abcdefghij'[k % 10]}{chr(97 + k // 10 % 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for k in range(200)) for i in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, t string")
    words = texts[0].split()
    asked = [(words[0], words[1]), (words[1], words[0]), (words[5], texts[3].split()[9])]
    got = Q.neighbours(df, "t", spark.createDataFrame(asked, "_before string, _after string")).collect()
    assert [tuple(r) for r in got] == asked[:1]


def test_wordings_that_the_seeds_lack(spark):
    # One sentence each, none of them among the seed texts; the natural ones speak of the same things.
    unseen = [
        "The page you wanted could not be found on our server.", "Sorry, the file you requested does not exist.", "This website requires JavaScript to be enabled in your browser.", "Your login session has expired, please sign in again.",
        "The service is currently unavailable. Please try again in a few minutes.", "You are not authorized to access this document.", "Error 500: the server encountered an unexpected error.", "Please add a description of the product here.",
        "Insert your own text here before publication.", "Die Seite wurde nicht gefunden.", "Bitte aktivieren Sie JavaScript, um fortzufahren.", "Veuillez activer JavaScript dans votre navigateur.", "La página que busca no existe.", "Questa pagina richiede JavaScript.",
    ]
    assert not [t for t in unseen if t.lower() in Q.NOTICES + Q.FILLER]
    rows = list(enumerate(NATURAL * 8)) + [(10_000 + i, f"Product Y{i}\n{t}") for i, t in enumerate(unseen)]
    got = {r.doc_id for r in Q.found(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(d >= 10_000 for d in got) and len(got) >= 0.9 * len(unseen)


def test_company_teaches_an_unknown_notice(spark):
    # Nothing general in it, but it stands beside recognised notices and nowhere else.
    menu = "Zilvane portal quarto mixtum"
    rows = list(enumerate(NATURAL * 8)) + [(10_000 + i, f"404 Not Found. The requested URL was not found on this server.\n{menu}") for i in range(6)] + [(20_000, f"Product Z\n{menu}")]
    got = {r.doc_id for r in Q.found(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {*range(10_000, 10_006), 20_000}


def test_places_beyond_the_basic_plane(spark):
    text = "\U0001f527 Tools.\nLoosen the \U0001f527 {{ model name }} belt."
    model = Q.Model([Q._grams(" ".join(NATURAL)), Q.np.zeros(Q.SHAPES, int)])
    assert [text[a:b] for _, a, b, *_ in model.search([None, "", text])] == ["{{ model name }}"]
