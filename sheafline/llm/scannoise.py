"""Noise in text read from scanned pages: cut words, misread characters, running headers and page numbers.

1. *Vocabulary*: one pass counts the words of all running text. Of words that look alike to a scanner the frequent one is
   trusted; a word is misread if it isn't trusted itself but a trusted word has its scanner's shape.
2. *Pages*: lines are brought together by page and read in order. A page's first and last two lines are its edges (``EDGE``); a
   line there that holds only a number may be a page number, any other is kept under the shape of its words, in sorted order.
   Numbers that rise with the pages of their PDF are its page numbers.
3. *Headers*: a shape met at the edges of at least two pages of its PDF, and inside no more pages than that, is its running
   header, however long the PDF is; lines of sections and images of that shape are the header, too. Case, order, separators, page numbers and misread
   characters don't matter; lines of a PDF whose shapes differ by a letter or two in one word count as one. An image is a page
   by itself: its header is a short line made of words of its PDF's running headers, or as a whole one of some PDF.
4. *Cut words*: a line's last word with a hyphen goes on in the next line of the text, over page numbers and headers. The
   vocabulary decides how: a known whole is closed up; else a conjunction is kept apart ("left- and right-hand"), two
   known words keep their hyphen and anything else is closed up. ``found`` and ``paragraphs`` share this rule.
5. *Paragraphs*: what is left of every page, section and image is joined, also over the border of two pages.
Of the vocabulary, judged as a whole in Spark, the ``most_words`` most frequent words are broadcast. If there are more, what
a record needs to know of the rest is asked for first and joined to it, so the bound changes no result.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.llm.lookalikes import CROSS, INVISIBLE
from sheafline.session import cut

# Characters a scanner takes for each other, each with one of its kind, then pairs that look like one letter.
ALIKE = str.maketrans("e1i0fv59h68", "cllotusgbbb")
PAIRS = (("cl", "d"), ("rn", "m"), ("uu", "w"), ("ll", "u"))
# Words that follow a first part kept apart on purpose.
APART = frozenset("and or to und oder bis bzw y o e u ni et ou ed od ad".split())

HYPHENS = "-¬­‐‑"
CUT = re.compile(rf"[^\W\d_][{HYPHENS}]$")
NUMBER = r"(?:[lIoO]{0,2}[0-9][0-9lIoO]{0,3}|[lI][lIoO]?)"
PAGE_NUMBER = re.compile(
    rf"(?:(?:p|pp|pg|s|pág|pag|page|pagc|paqe|seite|sejte|página|pagina)\b\.?\s*)?{NUMBER}(?:\s*(?:/|of|0f|von|de|di|sur|aus)\s*{NUMBER})?", re.I
)
AROUND = re.compile(r"^[\s\-–—~*.·•\[\](){}<>«»=_]*|\|?$|[\s\-–—~*.·•\[\](){}<>«»=_]*$")
DIGIT = re.compile(r"[0-9]")
LETTERS = re.compile(r"[^\W\d_]+")
LAST_LETTERS = re.compile(rf"[^\W\d_]+(?=[{HYPHENS}]$)")
SHAPED = re.compile(r"[^\W_]+")
CODE = re.compile(r"^[A-Z]{1,4}(?:-[A-Z]{1,3})*-?[0-9]+$|^[0-9]+[A-Z]*$")
#: Lines at a page's top and bottom that may be running lines; words and letters of a running line, and the longest line of a page
#: number and of an image's or a section's header. On sf0.1 1 or 3 edge lines, 12 words or 4 letters give the same rows.
EDGE, MOST_WORDS, LEAST_LETTERS, LONGEST_NUMBER, LONGEST_HEADER = 2, 8, 5, 24, 60
ENDS = ".,;:!?()[]{}\"«»|*•…"
ODD = re.compile(r"[^\x00-\x7f¡-ÿŒœ‐-‟•…]")
# A soft hyphen at a line's end cuts a word: it stays.
_PLAIN = {ord(a): b for a, b in CROSS.items()} | {ord(c): None for c in INVISIBLE if c != "\u00ad"}


def consistent(text: str) -> str:
    """``text`` without wide forms, invisible characters and foreign look-alikes."""
    return unicodedata.normalize("NFKC", text.translate(_PLAIN)) if ODD.search(text) else text


def shape(word: str) -> str:
    """What a scanner sees: lower case, no accents, look-alike characters as one."""
    w = word.lower()
    if not w.isascii():
        w = "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))
    w = w.translate(ALIKE)
    for a, b in PAIRS:
        w = w.replace(a, b)
    return w


def line_key(line: str) -> str:
    """The shapes of a line's words in sorted order, numbers left out; '' if it can't be a running line: no or more than
    ``MOST_WORDS`` words, or it ends like a sentence."""
    line = line.strip()
    if not line or line[-1] in ".,;:!?" or CUT.search(line):
        return ""
    ws = [w for w in SHAPED.findall(line) if not (len(w) < 5 and all(c in "0123456789lIoO" for c in w))]
    return " ".join(sorted(map(shape, ws))) if 1 <= len(ws) <= MOST_WORDS and sum(map(len, ws)) >= LEAST_LETTERS else ""


def page_number(line: str) -> str | None:
    """The number of a line that holds nothing else, else None."""
    if len(line) > LONGEST_NUMBER:
        return None
    bare = AROUND.sub("", line)
    if not bare or not PAGE_NUMBER.fullmatch(bare):
        return None
    n = re.search(rf"{NUMBER}(?=\s*(?:$|/|of|0f|von|de|di|sur|aus))", bare)
    if not n or not (DIGIT.search(bare) or bare != line.strip()):
        return None
    return n[0].translate(str.maketrans("lIoO", "1100"))


def _numbered(line: str, number: str) -> str:
    """A page number with a mark behind it if its form says that it is one ("Page 3", "- 3 -"), as a bare number doesn't."""
    return number if line.strip().isalnum() else number + "!"


def tries(word: str) -> list[str]:
    """The shapes of what a scanner may have turned into ``word`` (lower case), the likeliest first."""
    out = [shape(word)]
    if "h" in word:
        out += [shape(word[:i] + "li" + word[i + 1 :]) for i, c in enumerate(word) if c == "h"]
    if "6" in word:
        out += [shape(word.replace("6", c)) for c in "oe"]
    return out


class Vocabulary:
    """Counts of words, which of them are trusted, and the trusted word of each shape.

    ``printed`` counts a word in text that no scanner has read. Trusted is a word met at least ``least`` times that is no
    rarer than 1 / ``ratio`` of the most frequent word of its shape, or of whose occurrences that share is printed.
    """

    def __init__(self, counts: dict[str, int], printed: dict[str, int], least: int = 3, ratio: int = 10) -> None:
        best: dict[str, str] = {}
        for w, n in counts.items():
            s = shape(w)
            if s not in best or (n, w) > (counts[best[s]], best[s]):
                best[s] = w
        self.trusted = {
            w for w, n in counts.items() if n >= least and (n * ratio >= counts[best[shape(w)]] or printed.get(w, 0) * ratio >= max(n, least * ratio))
        }
        self.of_shape = {s: w for s, w in best.items() if counts[w] >= least}
        self._ready(counts, True)

    def _ready(self, counts: dict[str, int], complete: bool) -> None:
        self.counts = counts
        self.complete = complete
        self.answers: dict[str, tuple[int, bool, str | None]] = {}
        self.asked: set[str] = set()
        self.unsure = False
        self.fine: set[str] = set()
        self.bad: set[str] = set()

    @classmethod
    def of(cls, frequent: list[tuple[str, int, bool, bool]], complete: bool) -> Vocabulary:
        """From the judged (word, n, trusted, best) of the most frequent words; unless these are ``complete``, words it can't
        tell are looked up in ``answers`` and noted in ``asked``."""
        self = cls.__new__(cls)
        self.trusted = {w for w, _, trusted, _ in frequent if trusted}
        self.of_shape = {shape(w): w for w, _, trusted, best in frequent if best and trusted}
        self._ready({w: n for w, n, _, _ in frequent}, complete)
        return self

    def _answer(self, word: str) -> tuple[int, bool, str | None]:
        self.unsure = True
        if word not in self.answers:
            self.asked.add(word)
        return self.answers.get(word, (0, False, None))

    def is_trusted(self, word: str) -> bool:
        return word in self.trusted or not self.complete and word not in self.counts and self._answer(word)[1]

    def count(self, word: str) -> int:
        return self.counts[word] if word in self.counts else 0 if self.complete else self._answer(word)[0]

    def meant(self, word: str) -> str | None:
        """The trusted word that a scanner has turned into ``word``; None if it is trusted or nothing fits."""
        w = word.lower()
        if w in self.trusted or not LETTERS.search(w):
            return None
        if not self.complete:
            # Frequent and not trusted: its shape's best word is more frequent still.
            o = self.of_shape.get(shape(w)) if w in self.counts else None
            return o if o is not None and o != w else self._answer(w)[2]
        for s in tries(w):
            o = self.of_shape.get(s)
            if o is not None and o != w and o in self.trusted:
                return o
        return None

    def misread(self, token: str) -> bool:
        """Whether a token of running text holds a misread word; answers are kept."""
        if token in self.fine:
            return False
        if token in self.bad:
            return True
        self.unsure = False
        bare = token.strip(ENDS)
        parts = [] if CODE.match(bare) else re.split(r"['’/\-‐‑–]", bare)
        found = any(len(p) >= 2 and not CODE.match(p) and not ODD.search(p) and self.meant(p) for p in (x.strip(ENDS) for x in parts))
        if self.unsure:
            return found
        # Tokens with a code repeat seldom: keeping them would only fill the memory.
        keep = self.bad if found else self.fine
        if len(keep) > 500_000:
            keep.clear()
        keep.add(token)
        return found


def count_words(texts: DataFrame, text: str, printed: str) -> DataFrame:
    """word, n, p: counts of the words (letters only, two or more, lower-cased) met twice or more in a column, over all rows
    and over those where ``printed`` is true."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> pd.DataFrame:
            words: dict[str, list[int]] = {}
            for k, counter in enumerate(total):
                for token, n in counter.items():
                    if not DIGIT.search(token):
                        for w in LETTERS.findall(token):
                            if len(w) > 1:
                                words.setdefault(w.lower(), [0, 0])[k] += n
                counter.clear()
            return pd.DataFrame([(w, a + b, b) for w, (a, b) in words.items()], columns=["word", "n", "printed"])

        for batch in batches:
            for t, p in zip(batch[text], batch[printed]):
                if t:
                    total[bool(p)].update(t.split())
            if len(total[0]) + len(total[1]) > 300_000:
                yield rows()
        yield rows()

    counted = texts.select(text, printed).mapInPandas(count, "word STRING, n BIGINT, printed BIGINT").groupBy("word")
    return counted.agg(F.sum("n").alias("n"), F.sum("printed").alias("p")).where("n > 1")


def judged(counts: DataFrame, least: int = 3, ratio: int = 10) -> DataFrame:
    """word, n, shape, trusted, best of ``counts`` by the rules of ``Vocabulary``."""
    shaped = counts.mapInPandas(lambda batches: (b.assign(shape=[shape(w) for w in b["word"]]) for b in batches), "word STRING, n BIGINT, p BIGINT, shape STRING")
    best = F.max(F.struct("n", "word")).over(Window.partitionBy("shape"))
    trusted = F.expr(f"n >= {least} and (n * {ratio} >= b.n or p * {ratio} >= greatest(n, {least * ratio}))")
    return shaped.withColumn("b", best).select("word", "n", "shape", trusted.alias("trusted"), (F.col("word") == F.col("b.word")).alias("best"))


class Book:
    """The whole vocabulary: its most frequent words as a broadcast, all as a DataFrame."""

    def __init__(self, words: DataFrame, most_words: int) -> None:
        self.words = words
        rows = words.orderBy(F.desc("n"), "word").limit(most_words + 1).collect()
        self.complete = len(rows) <= most_words
        frequent = [(r["word"], r["n"], r["trusted"], r["best"]) for r in rows[:most_words]]
        self.sent: Broadcast = words.sparkSession.sparkContext.broadcast((frequent, self.complete))

    def answers(self, words: DataFrame) -> DataFrame:
        """word and, as one string, its count, whether it is trusted and the trusted word meant by it."""

        def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame([(w, i, x) for w in batch["word"] for i, x in enumerate(tries(w))], columns=["word", "i", "shape"])

        words = words.select("word").distinct()
        best = self.words.where("best and trusted").select("shape", F.col("word").alias("o"))
        meant = words.mapInPandas(shapes, "word STRING, i INT, shape STRING").join(best, "shape").where("o <> word").groupBy("word").agg(F.min_by("o", "i").alias("o"))
        own = words.join(self.words.select("word", "n", "trusted"), "word", "left").join(meant, "word", "left")
        line = F.concat_ws("\t", "word", F.coalesce("n", F.lit(0)), F.coalesce("trusted", F.lit(False)), F.when(F.coalesce("trusted", F.lit(False)), "").otherwise(F.coalesce("o", F.lit(""))))
        return own.select("word", line.alias("line"))

    def read(self, df: DataFrame, keys: list[str], units: Callable, work: Callable, schema: str, arrange: Callable = lambda df: df) -> DataFrame:
        """The rows that ``work`` (unit, vocabulary) gives of each unit of ``df``; ``units`` makes units, lists of rows with the
        same ``keys``, of an iterator of rows. Words that aren't broadcast are asked for by unit and answered first."""
        sent, names, at, width = self.sent, [c.split()[0] for c in schema.split(", ")], [df.columns.index(k) for k in keys], len(df.columns)

        def run(ask: bool) -> Callable:
            def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                known = Vocabulary.of(*sent.value)
                columns = [*keys, "word"] if ask else names
                out: list[tuple] = []
                for unit in units(r for b in batches for r in b.itertuples(index=False, name=None)):
                    answers = unit[0][width] if len(unit[0]) > width else None
                    known.answers = {} if answers is None else {w: (int(n), t == "true", m or None) for w, n, t, m in (x.split("\t") for x in answers)}
                    known.asked = set()
                    rows = list(work(unit if len(unit[0]) == width else [r[:width] for r in unit], known))
                    out += [(*(unit[0][i] for i in at), w) for w in known.asked] if ask else rows
                    if len(out) > 20_000:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                yield pd.DataFrame(out, columns=columns)

            return read

        if self.complete:
            return arrange(df).mapInPandas(run(False), schema)
        kinds = dict(df.dtypes)
        asked = cut(arrange(df).mapInPandas(run(True), ", ".join(f"{k} {kinds[k]}" for k in keys) + ", word STRING").distinct())
        told = asked.join(self.answers(asked), "word").groupBy(*keys).agg(F.collect_set("line").alias("answers"))
        return arrange(df.join(told, keys, "left").select(*df.columns, "answers")).mapInPandas(run(False), schema)


ROWS = "record_type STRING, record_id BIGINT, kind STRING, doc_id STRING, page INT, key STRING"


def _joint(before: str, after: str | None, known: Vocabulary) -> str | None:
    """What stands between the halves of a word where ``before`` ends with a hyphen and ``after`` follows: nothing or a
    hyphen; None if the word doesn't go on there."""
    head = LETTERS.match(after.lstrip()) if after else None
    tail = LAST_LETTERS.search(before)
    if not head or not tail:
        return None
    first, second = tail[0].lower(), head[0].lower()
    if known.is_trusted(first + second):
        return ""
    if second in APART:
        return None
    met = known.count(first), known.count(second)  # both, as a word is only asked for when it is looked up
    return "-" if all(met) else ""


def _page_rows(lines: list[tuple], known: Vocabulary, words: bool = True) -> Iterator[tuple]:
    """Rows of the lines of one page in order: (uid, doc, page, text, heading, scanned); without ``words`` those of running lines
    and page numbers alone."""
    last = len(lines) - 1
    edges = {*range(EDGE), *range(last - EDGE + 1, last + 1)}
    cut_from: tuple[int, str, str] | None = None
    for i, (uid, doc, page, text, heading, scanned) in enumerate(lines):
        text = consistent(text or "").strip()
        number = page_number(text) if not heading and i in edges else None
        if number is not None:
            yield "line", uid, "page_number", doc, page, _numbered(text, number)
            continue
        key = line_key(text) if not heading else ""
        if key:
            yield "line", uid, "edge" if i in edges else "inner", doc, page, key
        if not words:
            continue
        key = key if i in edges else ""
        tokens = _whole(text)
        if cut_from is not None:
            if not heading and _joint(cut_from[2], text, known) is not None:
                yield "line", cut_from[0], "hyphen", doc, page, None
                if scanned:
                    for part in _cut_misread(cut_from[1], text.split()[0], known):
                        yield "line", (cut_from[0], uid)[part], "misread", doc, page, None
                tokens = tokens[1:]
            elif text and not known.complete:
                _cut_misread(cut_from[1], text.split()[0], known)  # asks
            cut_from = None
        if not heading and CUT.search(text):
            cut_from = uid, text.split()[-1][:-1], text.split()[-1]
        if scanned and not heading and any(known.misread(t) for t in tokens):
            yield "line", uid, "misread", doc, page, key or None
    if not words:
        return
    if cut_from is not None:
        yield "line", cut_from[0], "open", doc, page, cut_from[2]
    # What the page begins with, for words cut at the end of the page before; a running header comes first.
    body = [t for t in (consistent(t or "").strip() for _, _, _, t, h, _ in lines if not h) if page_number(t) is None]
    for n, t in enumerate(body[:2] or [""]):
        yield "line", lines[0][0], "start" if n == 0 else "second", lines[0][1], lines[0][2], t[:200]


def _cut_misread(first: str, second: str, known: Vocabulary) -> list[int]:
    """Which halves (0, 1) of a cut word are misread."""
    first, second = first.split("-")[-1], second.strip(ENDS)
    meant = known.meant(first + second) if LETTERS.search(first) else None
    if meant is None or f"{first}-{second}".lower() in known.trusted:
        return []
    at_first, at_second = not meant.startswith(first.lower()), not meant.endswith(second.lower())
    return [k for k, bad in enumerate((at_first, at_second)) if bad]


def _whole(text: str) -> list[str]:
    """Tokens of a line, without a cut word at its end."""
    tokens = text.split()
    return tokens[:-1] if tokens and CUT.search(tokens[-1]) else tokens


def _kinds(kind: str, lines: list[str], first: int | None, final: int | None) -> tuple[list[str], list[str]]:
    """Of each line of a section's or an image's text whether it is a page number or short, and the key of a short one."""
    kinds: list[str] = []
    keys: list[str] = []
    for line in lines:
        n = page_number(line) if line and len(line) <= LONGEST_NUMBER else None
        if n is not None and line.isalnum() and kind == "section":
            # A bare number is a page's only where the section is.
            n = n if first is not None and final is not None and n.isdigit() and first <= int(n) <= final + 1 else None
        key = line_key(line) if n is None and len(line) <= LONGEST_HEADER and " | " not in line.replace(" | ", "  ", 1) else ""
        kinds.append("number" if n is not None else "short" if key else "")
        keys.append(key if kinds[-1] else "")
    return kinds, keys


def _text_rows(kind: str, uid: int, doc: str | None, page: int | None, first: int | None, final: int | None, text: str, known: Vocabulary, words: bool = True) -> Iterator[tuple]:
    """Rows of a section's or an image's text; without ``words`` those of running lines and page numbers alone."""
    lines = [x.strip() for x in consistent(text).split("\n")]
    kinds, keys = _kinds(kind, lines, first, final)
    last = len(lines) - 1
    if "number" in kinds:
        line = lines[kinds.index("number")]
        yield kind, uid, "page_number", doc, page, _numbered(line, page_number(line))
    for i, key in enumerate(keys):
        if key:
            at_edge = kind == "image" and (i < EDGE or i > last - EDGE)
            yield kind, uid, "edge" if at_edge else "short", doc, page, key
    if not words:
        return
    cut_word = False
    for i, line in enumerate(lines):
        if CUT.search(line) and kinds[i] != "number":
            j, noise = i + 1, False
            while j <= last and (kinds[j] == "number" or not lines[j] and noise or kinds[j] == "short" and noise):
                noise = noise or kinds[j] == "number"
                j += 1
            if j <= last and _joint(line, lines[j], known) is not None:
                cut_word = True
    if cut_word:
        yield kind, uid, "hyphen", doc, page, None
    running = [i for i, x in enumerate(lines) if x and kinds[i] != "number" and " | " not in x and not _titled(lines, i)]
    bad_plain, after_cut = False, ""
    for i in running:
        tokens = _whole(lines[i])
        if after_cut and tokens:
            tokens = tokens[1:]
            bad_plain = bad_plain or bool(_cut_misread(after_cut, lines[i].split()[0], known))
        after_cut = lines[i].split()[-1][:-1] if CUT.search(lines[i]) else ""
        if any(known.misread(t) for t in tokens):
            if keys[i]:
                yield kind, uid, "misread", doc, page, keys[i]
            else:
                bad_plain = True
    if bad_plain:
        yield kind, uid, "misread", doc, page, None


def _titled(lines: list[str], i: int) -> bool:
    """Whether line ``i`` stands like a heading: it begins a paragraph, isn't a sentence and the next begins anew."""
    if i and lines[i - 1] or lines[i][-1] in ".,;:!?-¬" or len(lines[i].split()) > 6 or i + 1 >= len(lines):
        return False
    return lines[i + 1][:1].isupper()


def _heading() -> Column:
    """Whether a line of ``text_lines`` is a heading, a table row or a contents line."""
    return (F.coalesce("header_level", F.lit("non_header")) != "non_header") | F.coalesce("is_table_like", F.lit(False)) | F.col("toc_page_number").isNotNull()


def vocabulary(text_lines: DataFrame, sections: DataFrame, images: DataFrame, most_words: int = 200_000) -> Book:
    """The words of all running text."""
    running = text_lines.where(~_heading()).select(F.col("text").alias("t"), (F.coalesce("font_name", F.lit("")) != "").alias("p"))
    unknown = F.lit(False).alias("p")
    texts = running.unionByName(sections.select(F.col("text_plain").alias("t"), unknown)).unionByName(images.select(F.col("ocr_text").alias("t"), unknown))
    return Book(cut(judged(count_words(texts, "t", "p"))), most_words)


def _lines(text_lines: DataFrame) -> DataFrame:
    """Lines with all of document, page and id."""
    kept = text_lines.where("doc_id is not null and page is not null and line_uid is not null")
    return kept.select("line_uid", "doc_id", "page", "line_no", "text", _heading().alias("heading"), (F.coalesce("font_name", F.lit("")) == "").alias("scanned"))


def _by_page(lines: DataFrame) -> DataFrame:
    """The lines of each page together and in order."""
    return lines.repartition("doc_id", "page").sortWithinPartitions("doc_id", "page", "line_no", "line_uid")


def _pages(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """The lines (uid, doc, page, line_no, ...) of each page."""
    page: list[tuple] = []
    for r in rows:
        if page and page[0][1:3] != r[1:3]:
            yield page
            page = []
        if not page or page[-1][3] != r[3] or page[-1][0] != r[0]:  # a redelivery follows its line
            page.append(r)
    if page:
        yield page


def _each(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    return ([r] for r in rows)


def _given(x: float | None) -> int | None:
    return None if x is None or x != x else int(x)


def noise_rows(text_lines: DataFrame, sections: DataFrame, images: DataFrame, book: Book, words: bool = True) -> DataFrame:
    """Everything one reading of the three tables finds (``ROWS``), before what is known only of whole PDFs; without ``words``
    running lines and page numbers alone."""

    def page(unit: list[tuple], known: Vocabulary) -> Iterator[tuple]:
        return _page_rows([(*r[:3], *r[4:]) for r in unit], known, words)

    def block(kind: str) -> Callable:
        def work(unit: list[tuple], known: Vocabulary) -> Iterator[tuple]:
            uid, doc, page, first, final, text = unit[0]
            return _text_rows(kind, uid, doc, _given(page), _given(first), _given(final), text, known, words)

        return work

    lines = book.read(_lines(text_lines), ["doc_id", "page"], _pages, page, ROWS, _by_page)
    none = F.lit(None).cast("int")
    of_sections = sections.where("section_uid is not null and text_plain <> ''").select("section_uid", "doc_id", none.alias("page"), "page_start", "page_end", "text_plain")
    of_images = images.where("image_uid is not null and ocr_text <> ''").select("image_uid", "doc_id", "page", none.alias("first"), none.alias("final"), "ocr_text")
    of_sections = book.read(of_sections, ["section_uid"], _each, block("section"), ROWS)
    return lines.unionByName(of_sections).unionByName(book.read(of_images, ["image_uid"], _each, block("image"), ROWS))


_IDS = ["record_type", "record_id"]


def _forms(keys: DataFrame) -> DataFrame:
    """doc_id, key, form of the lines' keys (doc_id, key): a key is a form of itself, and where two keys of a PDF differ in
    one word of five letters or more (eight where it is the only one), that word without any one letter or whole is one.

    Near keys share a form, so pages are counted by form and no two keys are compared.
    """
    keys = keys.distinct()
    words = keys.select("doc_id", "key", F.split("key", " ").alias("ws")).select("doc_id", "key", "ws", F.posexplode("ws").alias("i", "w"))
    rest = F.concat_ws(" ", F.expr("filter(ws, (x, j) -> j <> i)"))
    one_out = words.select("doc_id", "key", "w", rest.alias("rest")).where("length(w) >= 5 and (rest <> '' or length(w) >= 8)")
    shared = one_out.groupBy("doc_id", "rest").agg(F.count_distinct("key").alias("n")).where("n > 1").select("doc_id", "rest")
    parts = F.expr("transform(sequence(0, length(w)), i -> concat(rest, '|', left(w, i), substring(w, i + 2)))")
    near = one_out.join(shared, ["doc_id", "rest"], "left_semi").select("doc_id", "key", F.explode(parts).alias("form"))
    return keys.select("doc_id", "key", F.col("key").alias("form")).unionByName(near).distinct()


def _heads(rows: DataFrame, pages: int) -> DataFrame:
    """doc_id, key of the running headers, with keys near them. A line that its PDF repeats inside more pages than at edges
    belongs to the text."""
    forms = cut(_forms(rows.where("kind in ('edge', 'short') and record_type <> 'image' and doc_id is not null").select("doc_id", "key")))
    met = (
        rows.where("kind = 'edge' and record_type = 'line'")
        .select("doc_id", "key", "page")
        .distinct()
        .join(forms, ["doc_id", "key"])
        .groupBy("doc_id", "form")
        .agg(F.count_distinct("page").alias("n"))
        .where(F.col("n") >= pages)
    )
    heads = forms.join(met, ["doc_id", "form"]).groupBy("doc_id", "key").agg(F.max("n").alias("n"))
    inner = rows.where("kind = 'inner'").groupBy("doc_id", "key").agg(F.count_distinct("page").alias("inside"))
    return cut(heads.join(inner, ["doc_id", "key"], "left").where("coalesce(inside, 0) <= n").select("doc_id", "key"))


def page_numbers(rows: DataFrame) -> DataFrame:
    """record_type, record_id of the page numbers: lines whose numbers rise with the pages of their PDF.

    Number less page is the same along a sequence. Where two or more pages of a PDF agree in it, a bare number that is in no
    such sequence is none; where no two pages agree, there is nothing to hold it against. Sections were held against their
    own pages; an image is a page by itself, whose own number need not be that of the page it stands on."""
    all_numbers = rows.where("kind = 'page_number'")
    seen = all_numbers.where("record_type = 'line'").select(*_IDS, "doc_id", "page", F.regexp_replace("key", "!$", "").cast("bigint").alias("v"), F.endswith("key", F.lit("!")).alias("named"))
    seen = seen.withColumn("lag", F.col("v") - F.col("page"))
    pages = seen.groupBy("doc_id", "lag").agg(F.count_distinct("page").alias("n"))
    agree = pages.where("n > 1")
    some = agree.select("doc_id").distinct().withColumn("some", F.lit(True))
    judged = seen.join(agree, ["doc_id", "lag"], "left").join(some, "doc_id", "left").where("named or n is not null or some is null or doc_id is null or page is null")
    return judged.select(*_IDS).unionByName(all_numbers.where("record_type <> 'line'").select(*_IDS)).distinct()


def _headers(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """record_type, record_id, key of the lines that are running headers; a record may have several."""
    of_pdf = rows.where("kind in ('edge', 'short') and record_type <> 'image'").join(heads, ["doc_id", "key"], "left_semi")
    # A scanned page's own header: a short line of an image whose words are all in running headers of its PDF, or which is as a
    # whole the running header of some PDF: PDFs of which only images are at hand share their makers' headers.
    of_images = rows.where("kind in ('edge', 'short') and record_type = 'image'").select(*_IDS, "doc_id", "page", "kind", "key")
    known = heads.select("doc_id", F.explode(F.split("key", " ")).alias("w")).distinct()
    ws = F.array_distinct(F.split("key", " "))
    words = of_images.select(*_IDS, "doc_id", "key", F.size(ws).alias("n"), F.explode(ws).alias("w")).distinct()
    by_words = words.join(known, ["doc_id", "w"]).groupBy(*_IDS, "key").agg(F.count("*").alias("met"), F.max("n").alias("n")).where("n >= 2 and met = n")
    anywhere = heads.where(F.instr("key", " ") > 0).select("key").distinct()
    by_whole = of_images.join(anywhere, "key", "left_semi")
    of_image = by_words.select(*_IDS, "key").unionByName(by_whole.select(*_IDS, "key"))
    return of_pdf.select(*_IDS, "key").unionByName(of_image).distinct()


def _goes_on_over(pairs: DataFrame, book: Book) -> DataFrame:
    """``pairs`` (tail, head: the end of a page and the beginning of the next, and others) with their joint and the word meant
    by a whole that is misread, where the word goes on."""

    names = pairs.columns
    a, b = names.index("tail"), names.index("head")

    def decide(unit: list[tuple], known: Vocabulary) -> Iterator[tuple]:
        tail, head = unit[0][a], unit[0][b]
        joint = _joint(tail, head, known)
        if joint is not None:
            whole = known.meant(_whole_word(tail, head))
            yield *unit[0], joint, whole if joint == "" else None

    schema = ", ".join(f"{c} {t}" for c, t in pairs.dtypes) + ", joint STRING, meant STRING"
    return book.read(pairs, ["tail", "head"], _each, decide, schema)


def _whole_word(tail: str, head: str) -> str:
    return LAST_LETTERS.search(tail)[0] + LETTERS.match(head.lstrip())[0]


def found(text_lines: DataFrame, sections: DataFrame, images: DataFrame, pages: int = 2, most_words: int = 200_000) -> DataFrame:
    """record_type, record_id, kind of every record with noise, once each.

    Null texts have no noise; lines without document, page or id are in no page and are left out, as are sections and images
    without id; rows repeating an id count once. Empty tables give no rows.
    """
    book = vocabulary(text_lines, sections, images, most_words)
    rows = cut(noise_rows(text_lines, sections, images, book))
    heads = _heads(rows, pages)
    headers = cut(_headers(rows, heads))
    # A cut word at a page's end goes on behind the next page's header.
    starts = rows.where("kind in ('start', 'second')").select("doc_id", (F.col("page") - 1).alias("page"), F.col("key").alias("head"))
    opened = rows.where("kind = 'open'").select(*_IDS, "doc_id", "page", F.col("key").alias("tail"))
    across = _goes_on_over(opened.join(starts, ["doc_id", "page"]).select(*_IDS, "tail", "head"), book).select(*_IDS, F.lit("hyphen").alias("kind"))
    misread = rows.where("kind = 'misread'").join(heads, ["doc_id", "key"], "left_anti")
    misread = misread.join(headers.where("record_type = 'image'"), [*_IDS, "key"], "left_anti").select(*_IDS, "kind")
    plain = rows.where("kind = 'hyphen'").select(*_IDS, "kind").unionByName(page_numbers(rows).withColumn("kind", F.lit("page_number")))
    header = headers.select(*_IDS, F.lit("header").alias("kind"))
    return plain.unionByName(misread).unionByName(header).unionByName(across).distinct()


def _flowed(lines: list[tuple[str, str, bool]], known: Vocabulary) -> list[tuple[bool, list[tuple[str, bool]]]]:
    """The paragraphs of lines (text, role, scanned): whether each is running text, and its words with whether they were
    scanned. Lines of the role noise are left out, lines of the role apart stay alone."""
    out: list[tuple[bool, list[tuple[str, bool]]]] = []
    body: list[tuple[str, bool]] = []
    over = False

    def close() -> None:
        nonlocal body
        if body:
            out.append((True, body))
        body = []

    for text, role, scanned in lines:
        if role == "noise":
            over = True
            continue
        if not text and over and body and CUT.search(body[-1][0]):
            continue
        over = False
        if not text or role:
            close()
            if text:
                out.append((False, [(t, False) for t in text.split()]))
            continue
        tokens = text.split()
        joint = _joint(body[-1][0], tokens[0], known) if body and CUT.search(body[-1][0]) else None
        if body and CUT.search(body[-1][0]) and not known.complete:
            for token in (body[-1][0][:-1], tokens[0], body[-1][0][:-1] + tokens[0], body[-1][0][:-1] + "-" + tokens[0]):
                _mended(token, known)  # asks, whatever the joint will be
        if joint is not None:
            tail, was = body.pop()
            body.append((tail[:-1] + joint + tokens[0], was or scanned))
            tokens = tokens[1:]
        body += [(t, scanned) for t in tokens]
    close()
    return out


def _written(paragraph: list[tuple[str, bool]], known: Vocabulary) -> str:
    return " ".join(_mended(t, known) if scanned else t for t, scanned in paragraph)


def repaired(text: str, known: Vocabulary, headers: frozenset[str] = frozenset()) -> str:
    """A page's or section's text as paragraphs: page numbers and lines of the running header (keys in ``headers``) left
    out, lines joined, cut words closed up or kept with their hyphen as the vocabulary knows them, misread words replaced."""
    lines = [x.strip() for x in consistent(text).split("\n")]
    noise = [bool(x) and (page_number(x) is not None or line_key(x) in headers) for x in lines]
    return "\n\n".join(_written(p, known) for _, p in _flowed([(x, "noise" if n else "", True) for x, n in zip(lines, noise)], known))


def _page_text(lines: list[tuple], known: Vocabulary) -> tuple[str, str | None, int, str | None, int, bool]:
    """The text of a page's lines (uid, doc, page, line_no, text, heading, scanned, noise); its first word if it is running text and
    the length it has there, its last word if it is cut and the length; whether the last was scanned."""
    items = []
    for _, _, _, _, text, heading, scanned, noise in lines:
        text = consistent(text or "").strip()
        items.append((text, "noise" if noise else "apart" if heading else "", scanned))
    flowed = _flowed(items, known)
    parts = [_written(p, known) for _, p in flowed]
    words = sum(len(p) for _, p in flowed)
    head = flowed[0][1][0][0] if words > 1 and flowed[0][0] else None
    tail, scanned = flowed[-1][1][-1] if flowed and flowed[-1][0] else ("", False)
    tail = tail if CUT.search(tail) else None
    return "\n\n".join(parts), head, len(parts[0].split(" ")[0]) if head else 0, tail, len(parts[-1].split(" ")[-1]) if tail else 0, scanned


PARAGRAPHS = "record_type STRING, record_id BIGINT, doc_id STRING, page INT, text STRING"


def paragraphs(text_lines: DataFrame, sections: DataFrame, images: DataFrame, pages: int = 2, most_words: int = 200_000) -> DataFrame:
    """The continuous text of every page (without id), section and image: page numbers and running headers left out, lines
    joined to paragraphs, words cut at a line's or a page's end made whole, misread words of scanned text replaced.

    Headings, contents lines and table rows stay as they are, each by itself. Null texts have no row, nor have records without
    id or lines without document or page; of rows repeating an id one counts. A word cut at a page's end is moved to that page.
    """
    book = vocabulary(text_lines, sections, images, most_words)
    rows = cut(noise_rows(text_lines, sections, images, book, words=False))
    headers = cut(_headers(rows, _heads(rows, pages)))

    def of_page_lines(unit: list[tuple], known: Vocabulary) -> Iterator[tuple]:
        yield (*unit[0][1:3], *_page_text(unit, known))

    def of_block(kind: str) -> Callable:
        def work(unit: list[tuple], known: Vocabulary) -> Iterator[tuple]:
            uid, doc, page, first, final, text, keys = unit[0]
            lines = [x.strip() for x in consistent(text).split("\n")]
            kinds, own = _kinds(kind, lines, _given(first), _given(final))
            drop = set(keys) if keys is not None else set()
            items = []
            for i, line in enumerate(lines):
                noise = kinds[i] == "number" or bool(own[i]) and own[i] in drop
                apart = bool(line) and (" | " in line or _titled(lines, i))
                items.append((line, "noise" if noise else "apart" if apart else "", True))
            yield kind, uid, doc, _given(page), "\n\n".join(_written(p, known) for _, p in _flowed(items, known))

        return work

    noise = headers.where("record_type = 'line'").select("record_id").unionByName(page_numbers(rows).where("record_type = 'line'").select("record_id"))
    flag = noise.select(F.col("record_id").alias("line_uid"), F.lit(True).alias("header")).distinct()
    lines = _lines(text_lines).join(flag, "line_uid", "left").withColumn("header", F.coalesce("header", F.lit(False)))
    lines = lines.select("line_uid", "doc_id", "page", "line_no", "text", "heading", "scanned", "header")
    schema = "doc_id STRING, page INT, text STRING, head STRING, head_len INT, tail STRING, tail_len INT, scanned BOOLEAN"
    raw = cut(book.read(lines, ["doc_id", "page"], _pages, of_page_lines, schema, _by_page))
    cuts = raw.where("tail is not null").select("doc_id", "page", "tail", "scanned")
    nexts = raw.where("head is not null").select("doc_id", (F.col("page") - 1).alias("page"), "head")
    over = cut(_goes_on_over(cuts.join(nexts, ["doc_id", "page"]), book))
    ends = over.select("doc_id", "page", "head", "joint", F.when(F.col("scanned"), F.col("meant")).alias("meant"))
    begins = over.select("doc_id", (F.col("page") + 1).alias("page"), F.lit(True).alias("taken"))
    # From the right: the cut word is completed; then the page's first word, gone to the page before, is left out.
    stem = F.expr("left(text, length(text) - tail_len)")
    rest = F.regexp_extract("head", r"^\p{L}+(.*)$", 1)
    before = F.regexp_extract("tail", r"^(.*?)\p{L}+.$", 1)
    cased = F.when(F.substring("tail", 1, 1) == F.lower(F.substring("tail", 1, 1)), F.col("meant")).otherwise(F.initcap("meant"))
    whole = F.when(F.col("meant").isNotNull(), F.concat(before, cased, rest)).otherwise(F.concat(F.expr("left(tail, length(tail) - 1)"), "joint", "head"))
    text = F.when(F.col("joint").isNotNull(), F.concat(stem, whole)).otherwise(F.col("text"))
    joined = raw.drop("head", "scanned").join(ends, ["doc_id", "page"], "left").join(begins, ["doc_id", "page"], "left")
    of_page = (
        joined.select("doc_id", "page", text.alias("t"), "head_len", "taken")
        .withColumn("text", F.when(F.col("taken"), F.regexp_replace(F.expr("substring(t, head_len + 1)"), r"^\s+", "")).otherwise(F.col("t")))
        .select(F.lit("page").alias("record_type"), F.lit(None).cast("bigint").alias("record_id"), "doc_id", "page", "text")
    )
    keys = headers.groupBy(*_IDS).agg(F.collect_set("key").alias("keys"))

    def blocks(df: DataFrame, kind: str, uid: str, text: str, page: Column, first: Column, final: Column) -> DataFrame:
        one = df.where(F.col(uid).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(uid).alias("record_id"))
        one = one.agg(F.max(F.struct(F.col(text).alias("t"), F.col("doc_id").alias("d"), page.alias("p"), first.alias("a"), final.alias("b"))).alias("x"))
        own = keys.where(F.col("record_type") == kind).select("record_id", "keys")
        one = one.join(own, "record_id", "left").select("record_id", "x.d", "x.p", "x.a", "x.b", "x.t", "keys")
        return book.read(one, ["record_id"], _each, of_block(kind), PARAGRAPHS)

    none = F.lit(None).cast("int")
    of_section = blocks(sections, "section", "section_uid", "text_plain", none, F.col("page_start"), F.col("page_end"))
    of_image = blocks(images, "image", "image_uid", "ocr_text", F.col("page"), none, none)
    return of_page.unionByName(of_section).unionByName(of_image)


LETTERS_OR_DIGITS = re.compile(r"[^\W_]+")


def _mended(token: str, known: Vocabulary) -> str:
    """A token of running text with its misread words replaced."""
    found = known.misread(token)
    # Words are asked for before it is known whether the token is misread.
    mended = LETTERS_OR_DIGITS.sub(lambda m: _mended_word(m[0], known), token) if found or known.asked else token
    return mended if found else token


def _mended_word(word: str, known: Vocabulary) -> str:
    meant = None if CODE.match(word) or len(word) < 2 or not LETTERS.search(word) else known.meant(word)
    if meant is None:
        return word
    return meant.upper() if word.isupper() else meant.capitalize() if word[0].isupper() else meant
