import pyarrow.parquet as pq
import pytest

from sheafline.llm import language as Q

TITLES = [("en", "Safety instructions"), ("es", "Instrucciones de seguridad"), ("de", "Sicherheitshinweise"), ("fr", "Consignes de sécurité"), ("it", "Avvertenze di sicurezza")]
TEXT = {
    "en": ["Inspect the upper pump before every cleaning.", "The rear valve must not be opened while the motor is running.", "Clean the front gauge with a soft cloth."],
    "es": ["Revise la bomba superior antes de cada limpieza.", "La válvula trasera no debe abrirse mientras el motor funciona.", "Limpie el indicador con un paño suave."],
    "de": ["Prüfen Sie die obere Pumpe vor jeder Reinigung.", "Das hintere Ventil darf nicht geöffnet werden während der Motor läuft.", "Reinigen Sie die Anzeige mit einem weichen Tuch."],
    "fr": ["Contrôlez la pompe supérieure avant chaque nettoyage.", "La vanne arrière ne doit jamais être ouverte pendant que le moteur tourne.", "Nettoyez la jauge avec un chiffon doux."],
    "it": ["Controllate la pompa superiore prima di ogni pulizia.", "La valvola posteriore non deve essere aperta mentre il motore gira.", "Pulite l'indicatore con un panno morbido."],
}


@pytest.fixture(scope="module")
def field():
    return Q.train([(x, " ".join(t)) for x, t in TEXT.items()] * 30 + [("en", TEXT["de"][0])] * 5, TITLES)


def test_forward_backward_is_exact():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    scores, steps = rng.normal(size=(1, 4, 5)), rng.normal(size=(5, 5))
    want = np.zeros((4, 5))
    for path in itertools.product(range(5), repeat=4):
        p = np.exp(sum(scores[0, i, s] for i, s in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
        for i, s in enumerate(path):
            want[i, s] += p
    want /= want.sum(1, keepdims=True)
    got, pair = Q.Field.marginals(scores, np.array([4]), steps)
    f = Q.Field({x: set() for x in Q.LANGS})
    f.steps = steps
    assert np.allclose(got[0], want) and np.allclose(f._forward_backward(scores, np.array([4]))[0], want) and np.isclose(pair.sum(), 3)


def test_sentences_and_mixtures(spark, field):
    rows = [(i, " ".join(TEXT[x]), None, None) for i, x in enumerate(Q.LANGS)]
    rows += [(10, TEXT["en"][0] + "\n\n" + TEXT["it"][1] + "\nA | 12 | B", "Safety instructions - Consignes de sécurité", "x"), (11, None, None, "x"), (12, "", "", "x"), (13, "12 | A-01\n---- ", "ABC123", "x")]
    df = spark.createDataFrame(rows, "id bigint, text string, title string, lang string")
    got = Q.segments(df, "id", "text", "title", field).collect()
    by = {}
    for r in got:
        by.setdefault((r.id, r.field), []).append(r.lang)
    assert all(set(by[i, "text"]) == {x} and len(by[i, "text"]) == 3 for i, x in enumerate(Q.LANGS))
    assert by[10, "text"] == ["en", "it"] and by[10, "title"] == ["en", "fr"]
    assert {k[0] for k in by} == {0, 1, 2, 3, 4, 10}
    assert all(0 < r.confidence <= 1 for r in got)


def test_labels(spark):
    df = spark.createDataFrame([("en-GB",), ("Deutsch",), ("n/a",), (None,), (" ES ",), ("pt",), ("eng",)], "l string")
    from pyspark.sql import functions as F

    assert [r.x for r in df.select(Q.label_column(F.col("l")).alias("x")).collect()] == ["en", "de", "", "", "es", "other", "en"]


def test_held_out_accuracy():
    path = "/root/testdata/sf0.01"
    try:
        s, c = pq.read_table(f"{path}/sections.parquet").to_pandas().drop_duplicates("section_uid"), pq.read_table(f"{path}/canonical_titles.parquet").to_pandas()
        e = pq.read_table(f"{path}/eval_items.parquet").to_pandas()
    except FileNotFoundError:
        pytest.skip("no test tables")
    s = s[s.lang.isin(Q.LANGS) & s.text_plain.notna()]
    f = Q.train(list(zip(s.lang, s.text_plain)), list(zip(c.lang, c.title)))
    got = [Q.LANGS[g.sum(0).argmax()] for g in f.label([Q.words(t) for t in e.text])]
    assert sum(a == b for a, b in zip(got, e.lang)) / len(e) > 0.99


def test_confidence_is_the_share_of_right_answers():
    path = "/root/testdata/sf0.01"
    try:
        s, c = pq.read_table(f"{path}/sections.parquet").to_pandas().drop_duplicates("section_uid"), pq.read_table(f"{path}/canonical_titles.parquet").to_pandas()
        e = pq.read_table(f"{path}/eval_items.parquet").to_pandas()
    except FileNotFoundError:
        pytest.skip("no test tables")
    s = s[s.lang.isin(Q.LANGS) & s.text_plain.notna()]
    f = Q.train(list(zip(s.lang, s.text_plain)), list(zip(c.lang, c.title)))
    # Short pieces, whose confidence varies: three words each of passages with known languages.
    pieces = [(w[i : i + 3], x) for t, x in zip(e.text, e.lang) for w in [Q.words(t)] for i in range(0, len(w) - 2, 3)]
    means = [g.mean(0) for g in f.label([w for w, _ in pieces])]
    sure = [float(m.max()) for m in means]
    right = [Q.LANGS[m.argmax()] == x for m, (_, x) in zip(means, pieces)]
    assert abs(sum(sure) / len(sure) - sum(right) / len(right)) < 0.05
    low = [r for r, p in zip(right, sure) if p < 0.9]
    assert not low or sum(low) / len(low) < sum(right) / len(right)


def test_titles_in_two_languages(spark):
    known = spark.createDataFrame([(i, x, t) for i, (x, t) in enumerate([("en", "zz")])] + [(7, x, t) for x, t in TITLES] + [(8, "en", "Care"), (8, "de", "Pflege"), (9, None, "x"), (None, "en", "y")], "canon_id int, lang string, title string")
    rows = [("Safety instructions / Consignes de sécurité", ["en", "fr"]), ("Sicherheitshinweise (Safty instrutions)", ["de", "en"]), ("Care / Pflege", ["de", "en"]), ("Safety instructions / Pflege", ["de", "en"]), ("Safety instructions", ["en", "fr"]), ("", ["en", "fr"]), ("7 A-12", ["en", "fr"])]
    got = {r.title: set(r.langs) for r in Q.two_titles(spark.createDataFrame(rows, "title string, langs array<string>"), known).collect()}
    assert got == {rows[0][0]: {"en", "fr"}, rows[1][0]: {"de", "en"}, rows[2][0]: {"de", "en"}}
