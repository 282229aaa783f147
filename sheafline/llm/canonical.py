"""Freely typed titles led back to a list of canonical titles: a pigeonhole edit-distance join in SQL only.

Each reference title is written in all the shapes people type it in (two halves around a conjunction swapped, the
conjunction left out, the last word first, a word cut short, a second language behind the first); each typed title is
stripped of numbering, page references, product codes and everything that is no letter. What then is not equal to a
reference form goes through the partition join: a form of length n within k edits of a title leaves one of its k + 1
segments intact, so titles and forms meet by equality on (length, segment number, substring) at the few positions the
edits allow; ``levenshtein`` verifies. Titles without a match are reported through an anti-join.

Cost: only distinct titles are compared; a title that a third of all rows carry is compared once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafline.session import cut

# Letters that stand for one plain letter each, and words that join two halves of a title.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿаеорсухіјѕкмнтвονρταεικμηβυχγ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyyaeopcyxijskmhtbovptaeikmhbuxy"
CONJUNCTIONS = ("and", "y", "und", "et", "e")


#: Letters that a title with a word cut short must keep: fewer name nothing.
SHORTEST_CUT = 4


def _sub(text: str, pattern: str, to: str, duckdb: bool) -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')" if duckdb else f"regexp_replace({text}, r'{pattern}', '{to}')"


def _folded(text: str, duckdb: bool) -> str:
    """Lower case without accents, wide forms, invisible characters and foreign look-alikes."""
    # Without quote and backslash, which would not stand for themselves inside a literal.
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F) if chr(c) not in "＇＼")
    narrow = "".join(chr(ord(c) - 0xFEE0) for c in wide)
    gone = "[̀-ͯ​-‍⁠﻿­]"
    space = "[  -  　 ]"
    x = _sub(text, gone, "", duckdb)
    x = _sub(x, space, " ", duckdb)
    x = f"lower(translate({x}, '{wide}', '{narrow}'))"
    x = f"translate({x}, '{ACCENTED}', '{PLAIN}')"
    for a, b in (("ß", "ss"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("[‐-‒]", "-")):
        x = _sub(x, a, b, duckdb)
    return x


def folded(text: str) -> str:
    """SQL of the folded form of a column."""
    return _folded(text, False)


def _bare(text: str, duckdb: bool) -> str:
    """Without numbering before it and page, continuation mark, product code or punctuation behind it."""
    x = _sub(text, r"\s+", " ", duckdb)
    x = _sub(x, r"^ ?([0-9]+([.][0-9]+)*[.)]?|[ivx]+[.)]|[a-h][.)]) ", "", duckdb)
    x = _sub(x, r"[ (]*(p[.]? ?[0-9]+|cont[.]?)[)] *$", "", duckdb)
    x = _sub(x, r"[ .:-]+$", "", duckdb)
    x = _sub(x, r"(^| )[a-z]{1,3}[ -]?([a-z]{2}[ -])?[0-9]{2,4}$", "", duckdb)
    return _sub(x, r"[ .:-]+$", "", duckdb)


def _squashed(text: str, duckdb: bool) -> str:
    return _sub(text, r"[^\p{L}]", "", duckdb)


def _forms_sql(canonical: str, duckdb: bool) -> str:
    """form, canon_id, abbreviated: every shape of every reference title, squashed to letters."""
    words = f"string_split({_folded('title', duckdb)}, ' ')" if duckdb else f"split({_folded('title', duckdb)}, ' ')"
    n, unnest = ("len(w)", "unnest") if duckdb else ("size(w)", "explode")
    part = (lambda a, b: f"array_to_string(list_slice(w, {a}, {b}), ' ')") if duckdb else (lambda a, b: f"array_join(slice(w, {a}, greatest(0, {b} - ({a}) + 1)), ' ')")
    at = (lambda i: f"w[{i}]") if duckdb else (lambda i: f"element_at(w, {i})")
    steps = (lambda a, b: f"unnest(generate_series(1, {n}))") if duckdb else (lambda a, b: f"explode(sequence(1, {n}))")
    cuts = "unnest(generate_series(1, length(word) - 1))" if duckdb else "explode(sequence(1, length(word) - 1))"
    joined = ", ".join(f"'{c}'" for c in CONJUNCTIONS)
    return f"""
  w AS (SELECT DISTINCT canon_id, lang, {words} AS w FROM {canonical} WHERE title IS NOT NULL AND canon_id IS NOT NULL),
  positions AS (SELECT canon_id, lang, w, {steps(1, n)} AS i FROM w),
  parts AS (
    SELECT canon_id, w, {at('i')} AS word, {part('1', 'i - 1')} AS ahead, {part('i + 1', n)} AS behind, i, {n} AS n FROM positions
  ),
  cut AS (SELECT canon_id, ahead, behind, word, {cuts} AS c FROM parts WHERE length(word) > 1),
  shapes AS (
    SELECT canon_id, {part('1', n)} AS form, 0 AS abbreviated FROM w
    UNION ALL SELECT canon_id, concat(behind, ' ', ahead), 0 FROM parts WHERE word IN ({joined})
    UNION ALL SELECT canon_id, concat(behind, ' ', word, ' ', ahead), 0 FROM parts WHERE word IN ({joined})
    UNION ALL SELECT canon_id, concat(ahead, ' ', behind), 0 FROM parts WHERE word IN ({joined})
    UNION ALL SELECT canon_id, concat(word, ' ', ahead), 0 FROM parts WHERE i = n AND n > 1
    UNION ALL SELECT canon_id, concat(ahead, ' ', substr(word, 1, c), ' ', behind), 1 FROM cut
    UNION ALL SELECT a.canon_id, concat({part('1', n).replace('(w', '(a.w')}, ' ', {part('1', n).replace('(w', '(b.w').replace('size(a.w', 'size(b.w')}), 0
      FROM w a JOIN w b ON a.canon_id = b.canon_id AND a.lang <> b.lang
  ),
  forms AS (
    SELECT form, abbreviated, min(canon_id) AS canon_id FROM (SELECT canon_id, {_squashed('form', duckdb)} AS form, abbreviated FROM shapes) s
    WHERE length(form) >= CASE WHEN abbreviated = 1 THEN {SHORTEST_CUT} ELSE 1 END GROUP BY form, abbreviated
  )"""


def _typed_sql(titles: str, duckdb: bool) -> str:
    """title, form, dotted: the one or two forms (with and without what stands in brackets) of each distinct title."""
    folded = f"(SELECT title, {_folded('title', duckdb)} AS f FROM {titles} WHERE title IS NOT NULL GROUP BY title) x"
    return f"""
  bare AS (SELECT title, {_bare('f', duckdb)} AS f, {_bare(_sub('f', '[(][^)]*[)]', ' ', duckdb), duckdb)} AS g, f LIKE '%.%' AS dotted FROM {folded}),
  typed AS (
    SELECT DISTINCT title, form, dotted FROM (
      SELECT title, {_squashed('f', duckdb)} AS form, dotted FROM bare UNION ALL SELECT title, {_squashed('g', duckdb)}, dotted FROM bare
    ) y WHERE form <> ''
  )"""


#: Edits allowed for a reference form by its length: one for every two letters beyond two, four at most (two swapped pairs).
MOST_EDITS = 4
EDITS = f"least({MOST_EDITS}, greatest(0, length(form) - 2) div 2)"

_EXACT = "SELECT t.title, r.canon_id, 0 AS d FROM {typed} t JOIN {forms} r ON t.form = r.form AND (r.abbreviated = 0 OR t.dotted)"

#: form, ref, k, d of every open form within the k edits of a reference form that it allows.
_NEAR = """WITH
  refs AS (SELECT form, least({most}, k) AS k, length(form) AS n FROM {known}),
  cuts AS (
    SELECT n, k, i, i * (n div (k + 1)) + greatest(0, i - (k + 1 - n % (k + 1))) AS p,
           n div (k + 1) + CASE WHEN i >= k + 1 - n % (k + 1) THEN 1 ELSE 0 END AS l
    FROM (SELECT n, k, explode(sequence(0, k)) AS i FROM (SELECT DISTINCT n, k FROM refs))
  ),
  ref_parts AS (SELECT r.form AS ref, r.k, r.n, c.i, substr(r.form, c.p + 1, c.l) AS part FROM refs r JOIN cuts c ON r.n = c.n AND r.k = c.k),
  near_lengths AS (
    SELECT form, n FROM (SELECT form, explode(sequence(greatest(1, length(form) - {most}), length(form) + {most})) AS n FROM {open})
  ),
  spans AS (
    SELECT o.form, c.n, c.k, c.i, c.l,
           greatest(0, c.p - c.i, c.p + length(o.form) - c.n - (c.k - c.i)) AS lo,
           least(length(o.form) - c.l, c.p + c.i, c.p + length(o.form) - c.n + (c.k - c.i)) AS hi
    FROM near_lengths o JOIN cuts c ON c.n = o.n AND abs(length(o.form) - c.n) <= c.k
  ),
  open_parts AS (
    SELECT form, n, k, i, substr(form, s + 1, l) AS part FROM (SELECT form, n, k, i, l, explode(sequence(lo, hi)) AS s FROM spans WHERE lo <= hi)
  ),
  candidates AS (
    SELECT DISTINCT o.form, r.ref, r.k FROM open_parts o JOIN ref_parts r ON o.n = r.n AND o.k = r.k AND o.i = r.i AND o.part = r.part
  )
SELECT form, ref, d FROM (SELECT form, ref, levenshtein(form, ref, k) AS d FROM candidates) WHERE d >= 0"""

#: Every distinct title with its best entry; the anti-join reports the titles without one.
_BEST = """WITH
  hits AS (
    SELECT title, canon_id, d FROM {exact}
    UNION ALL SELECT t.title, n.canon_id, n.d FROM {typed} t JOIN {near} n ON t.form = n.form LEFT ANTI JOIN {exact} e ON t.title = e.title
  ),
  best AS (SELECT title, min_by(canon_id, struct(d, canon_id)) AS canon_id, min(d) AS edits FROM hits GROUP BY title)
SELECT title, canon_id, edits FROM best
UNION ALL
SELECT t.title, 0, NULL FROM {titles} t LEFT ANTI JOIN best b ON t.title = b.title WHERE t.title IS NOT NULL GROUP BY t.title"""


def _run(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """``sql`` over the frames named in it; braces of regular expressions stay as they are."""
    for name in frames:
        sql = sql.replace("{" + name + "}", f"\0{name}\1")
    return spark.sql(sql.replace("{", "{{").replace("}", "}}").replace("\0", "{").replace("\1", "}"), **frames)


def near(open_forms: DataFrame, known: DataFrame) -> DataFrame:
    """form, ref, d: every form of ``open_forms`` (form) with the forms of ``known`` (form, k) that lie within their k edits,
    ``MOST_EDITS`` at most, and the distance. Forms are distinct, not null and not empty."""
    sql = _NEAR.replace("{most}", str(MOST_EDITS))
    return _run(open_forms.sparkSession, sql, open=open_forms, known=known)


_OPEN = "SELECT DISTINCT t.form FROM {typed} t LEFT ANTI JOIN {exact} e ON t.title = e.title"
_KNOWN = f"SELECT form, {EDITS} AS k FROM {{forms}} WHERE abbreviated = 0"
_ENTRIES = "SELECT n.form, f.canon_id, n.d FROM {found} n JOIN {forms} f ON n.ref = f.form WHERE f.abbreviated = 0"


def resolve(titles: DataFrame, canonical: DataFrame) -> DataFrame:
    """title, canon_id, edits of each distinct non-null title of ``titles`` (column title); canon_id 0 and edits null where no
    entry is near enough. Of several near entries the one with the fewest edits wins, then the smallest canon_id. Empty
    titles, titles without letters and an empty list give 0. Other columns of both inputs are ignored.

    The forms, the distinct titles and the matches are checkpointed: each is read several times by what follows."""
    spark = titles.sparkSession
    titles, canonical = titles.select("title"), canonical.select("canon_id", "lang", "title")
    forms = cut(_run(spark, f"WITH {_forms_sql('{canonical}', False)} SELECT * FROM forms", canonical=canonical))
    typed = cut(_run(spark, f"WITH {_typed_sql('{titles}', False)} SELECT * FROM typed", titles=titles))
    exact = cut(_run(spark, _EXACT, typed=typed, forms=forms))
    found = near(_run(spark, _OPEN, typed=typed, exact=exact), _run(spark, _KNOWN, forms=forms))
    entries = cut(_run(spark, _ENTRIES, found=found, forms=forms))
    return _run(spark, _BEST, titles=titles, typed=typed, exact=exact, near=entries)


def title_records(sections: DataFrame, maps: DataFrame) -> DataFrame:
    """record_type, record_key, title of every section that has a title other than OPENING and of every map key."""
    title = F.coalesce("raw_title", "normalized_title")
    of_sections = (
        sections.select(F.lit("section").alias("record_type"), F.col("section_uid").cast("string").alias("record_key"), title.alias("title"))
        .where("title is not null and lower(trim(title)) <> 'opening'")
        .dropDuplicates(["record_key"])
    )
    keys = maps.select("map_version", F.explode(F.map_keys("title_map")).alias("title")).where("title is not null")
    of_maps = keys.select(F.lit("title_map").alias("record_type"), F.concat(F.col("map_version").cast("string"), F.lit(":"), "title").alias("record_key"), "title")
    return of_sections.unionByName(of_maps.dropDuplicates(["record_key"]))


def found(sections: DataFrame, maps: DataFrame, canonical: DataFrame) -> DataFrame:
    """Every title with the canonical entry it names, 0 for none."""
    records = title_records(sections, maps)
    entries = resolve(records.select("title"), canonical)
    return records.join(entries, "title").select("record_type", "record_key", F.col("canon_id").cast("int").alias("canon_id"))


def oracle_sql() -> str:
    """The same result by comparing every open title with every form, for small data."""
    return f"""WITH records AS (
    SELECT DISTINCT 'section' AS record_type, CAST(section_uid AS VARCHAR) AS record_key, coalesce(raw_title, normalized_title) AS title
    FROM sections WHERE lower(trim(coalesce(raw_title, normalized_title))) <> 'opening'
    UNION ALL SELECT DISTINCT 'title_map', CAST(map_version AS VARCHAR) || ':' || k, k
    FROM (SELECT map_version, unnest(map_keys(title_map)) AS k FROM section_columns_map)
  ), {_forms_sql('canonical_titles', True)}, {_typed_sql('records', True)},
  exact AS (SELECT t.title, r.canon_id FROM typed t JOIN forms r ON t.form = r.form AND (r.abbreviated = 0 OR t.dotted)),
  near AS (
    SELECT t.title, r.canon_id, levenshtein(t.form, r.form) AS d FROM typed t, (SELECT form, canon_id, {EDITS.replace("div", "//")} AS k FROM forms WHERE abbreviated = 0) r
    WHERE t.title NOT IN (SELECT title FROM exact) AND abs(length(t.form) - length(r.form)) <= r.k AND levenshtein(t.form, r.form) <= r.k
  ),
  best AS (
    SELECT title, min(canon_id) AS canon_id FROM exact GROUP BY title
    UNION ALL SELECT title, arg_min(canon_id, (d, canon_id)) FROM near GROUP BY title
  )
SELECT record_type, record_key, CAST(coalesce(canon_id, 0) AS INT) AS canon_id FROM records LEFT JOIN best USING (title)"""
