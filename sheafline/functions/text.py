"""Scalar text functions as Column expressions; all stay in the JVM and map null to null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheafline import config as C

#: White space as Python's ``str.split`` sees it; Java's class misses U+001C to U+001F.
SPACES = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCY"


def clean_text(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(x, SPACES, " "))


def normalize_title(x: Column) -> Column:
    """Lower case without outer white space; runs of colon, hyphen, underscore and slash, then of white space, as one space.
    A mark at the end leaves a space there: 'Warranty:' gives 'warranty '."""
    x = F.regexp_replace(F.lower(x), f"^{SPACES}|{SPACES}$", "")
    return F.regexp_replace(F.regexp_replace(x, r"[:\-_/]+", " "), SPACES, " ")


def match_form(x: Column) -> Column:
    """``normalize_title`` without accents, for comparing terms; accents written apart are dropped too."""
    return normalize_title(F.translate(F.regexp_replace(F.coalesce(x, F.lit("")), r"[\x{300}-\x{36F}]", ""), ACCENTED, PLAIN))


def words(x: Column) -> Column:
    return F.filter(F.split(x, SPACES), lambda w: w != "")


def word_count(x: Column) -> Column:
    return F.size(words(x))


def upper_ratio(x: Column) -> Column:
    """Share of upper case among letters; null where there is no letter."""
    letters = F.length(F.regexp_replace(x, r"[^\p{L}]", ""))
    return F.when(letters > 0, F.length(F.regexp_replace(x, r"[^\p{Lu}]", "")) / letters)


def is_upper(x: Column) -> Column:
    return F.coalesce(upper_ratio(x) > 0.8, F.lit(False))


def snippet(x: Column, limit: int = 320) -> Column:
    return F.substring(clean_text(F.coalesce(x, F.lit(""))), 1, limit)


def sanitize(x: Column) -> Column:
    """Without control characters other than tab, line feed and carriage return, and without U+FFFE and U+FFFF."""
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]", "")


def file_stem(x: Column) -> Column:
    return F.regexp_replace(x, r"\.[^.]*$", "")


def product_codes(stem: Column, most: int = C.DEFAULT.max_codes) -> Column:
    """Distinct product codes of a file name in order, joined by ' | '; null if there are none or more than ``most``."""
    bare = F.btrim(F.regexp_replace(stem, C.FILENAME_NOISE, ""))
    codes = F.array_distinct(F.regexp_extract_all(bare, F.lit(C.PRODUCT_CODE), 1))
    return F.when((F.size(codes) > 0) & (F.size(codes) <= most), F.array_join(codes, " | "))


def product_name(stem: Column, hint: Column | None = None) -> Column:
    """A hinted name, else what is left of a file name with codes when noise and codes are gone; null if nothing is."""
    bare = F.btrim(F.regexp_replace(stem, C.FILENAME_NOISE, ""))
    rest = F.btrim(F.regexp_replace(bare, C.PRODUCT_CODE, ""), F.lit(" -_"))
    name = F.when(product_codes(stem).isNotNull() & (rest != ""), rest)
    return name if hint is None else F.coalesce(F.nullif(F.btrim(hint), F.lit("")), name)


def labelled_values(flat: Column, labels: list[str]) -> tuple[Column, Column]:
    """(labels, values), two arrays: every "label: value" or "label - value" of cleaned text, in one pass over it. A label
    stands at the beginning or behind a full stop or semicolon; the value ends before the next of these."""
    either = "|".join(sorted(set(labels), key=lambda x: (-len(x), x)))
    pattern = F.lit(rf"(?i)(?:^|[.;])\s*({either})\s*[:\-]\s*([^.;]+)")
    return F.transform(F.regexp_extract_all(flat, pattern, 1), F.lower), F.regexp_extract_all(flat, pattern, 2)


def label_value(found: Column, values: Column, labels: tuple[str, ...]) -> Column:
    """struct(label, value) of the first of ``labels`` among the ``found`` ones that has a value; else null."""
    value = lambda x: F.btrim(F.get(values, F.array_position(found, x).cast("int") - 1), F.lit(" :-"))
    return F.get(F.filter(F.transform(alias_terms(labels), lambda x: F.struct(x.alias("label"), value(x).alias("value"))), lambda v: v["value"] != ""), F.lit(0))


def origin_value(flat: Column) -> Column:
    """struct(label, value) of the first pattern, in order, that tells a country of origin in cleaned text; else null."""
    found = []
    for p in C.ORIGIN_PATTERNS:
        label = F.regexp_extract(flat, p, 1)
        found.append(F.when(label != "", F.struct(label.alias("label"), F.btrim(F.regexp_extract(flat, p, 2)).alias("value"))))
    return F.coalesce(*found)


def alias_terms(terms: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, terms))


def matched_terms(x: Column, terms: tuple[str, ...]) -> Column:
    """The terms that occur anywhere in the text's comparable form, in their order."""
    form = match_form(x)
    return F.filter(alias_terms(terms), lambda t: F.contains(form, t))


def cell(x: Column) -> Column:
    """A table cell: null as empty, white space collapsed."""
    return clean_text(F.coalesce(x, F.lit("")))


def table_grid(columns: Column, rows: Column) -> Column:
    """A table as text: header, a line of at least 20 hyphens, rows; cells joined by ' | '."""
    dashes = F.repeat(F.lit("-"), F.greatest(F.lit(20), F.aggregate(columns, F.lit(0), lambda a, c: a + F.length(F.coalesce(c, F.lit(""))) + 3)))
    line = lambda r: F.array_join(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), " | ")
    head = F.when(F.size(columns) > 0, F.array(line(columns), dashes)).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(head, F.transform(F.filter(rows, lambda r: r.isNotNull()), line)), "\n")


def json_map(reply: Column) -> Column:
    """The JSON object in a model's reply as a map of strings: code fences are cut off; if the rest isn't an object, what
    stands between its first and last brace is tried; an empty map if nothing fits."""
    bare = F.btrim(F.regexp_replace(F.coalesce(reply, F.lit("")), r"^\s*```[a-zA-Z]*\s*|\s*```\s*$", ""))
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    parse = lambda x: F.from_json(x, "map<string,string>")
    return F.coalesce(F.when(F.startswith(bare, F.lit("{")), parse(bare)), F.when(inner != "", parse(inner)), F.from_json(F.lit("{}"), "map<string,string>"))
