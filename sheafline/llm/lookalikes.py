"""Visually identical text with different characters: look-alike classes, representatives and a rewriting automaton.

1. *Inventory*: one pass counts every code point of the collection, every letter with separated accents that Unicode has as
   one character, and the letters that ligatures stand for.
2. *Classes*: rules name pairs that look alike (a wide form and its plain form, a ligature and its letters, a letter and
   its look-alike in another alphabet, an accented letter and the same written in two, an invisible character and the
   empty string); union-find over these strings and code points closes the pairs transitively.
3. *Representatives*: of each class the member met most often; ties go to the shortest, then the smallest string.
4. *Rewriting*: an Aho-Corasick automaton of all other members rewrites text greedily, the longest match at the leftmost
   place first. Letters of another alphabet are rewritten only inside a word that also has Latin letters, so Russian
   words and unit signs such as kΩ stay.

The inventory that reaches the driver is bounded by Unicode itself: a row per code point, per character that has a written-out
form and per ligature, however the collection stacks its accents. Only records that hold a member other than its
representative leave the JVM for rewriting. What has no look-alike in Unicode's data (an accent that no single character
bears) stays as it is.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Letters of other alphabets, and of phonetic script, that look like a Latin letter (Cyrillic, Greek, Armenian, Cherokee).
CROSS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "І": "I", "Ј": "J", "Ѕ": "S", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "τ": "t", "χ": "x", "γ": "y", "ε": "e", "η": "n",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "յ": "j", "զ": "q", "Օ": "O", "Ս": "U",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ѵ": "v", "Ԛ": "Q", "Ԝ": "W", "ϲ": "c", "ϳ": "j", "ɑ": "a", "ɡ": "g",
}
# Hyphens that look like U+002D.
HYPHENS = "‐‑−﹣"
# Code points that show nothing.
INVISIBLE = "­͏᠎​‌‍⁠﻿"
MARKED = re.compile("([^\u0300-\u036f\u3099\u309a])([\u0300-\u036f\u3099\u309a]+)")


def _plain(ch: str) -> str | None:
    """The plain string that ``ch`` looks like, by Unicode's own data; None if it is plain or no look-alike."""
    if ch in INVISIBLE:
        return ""
    if ch in HYPHENS:
        return "-"
    if unicodedata.category(ch) == "Zs" and ch != " ":
        return " "
    kind = unicodedata.decomposition(ch).partition(" ")[0]
    name = unicodedata.name(ch, "")
    if kind and kind[0] != "<" and len(one := unicodedata.normalize("NFC", ch)) == 1 and one != ch:
        return one  # a sign that Unicode holds to be the letter itself
    if kind in ("<wide>", "<narrow>", "<noBreak>") or kind == "<font>" or "LATIN" in name and "LIGATURE" in name and kind == "<compat>":
        return unicodedata.normalize("NFKC", ch)
    return None


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: str, y: str) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def all(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.up:
            out.setdefault(self.find(x), []).append(x)
        return out


#: Letters that Latin ligatures stand for.
LIGATURES = sorted({p for c in (*range(0x100, 0x250), *range(0xFB00, 0xFB07)) if len(p := _plain(chr(c)) or "") > 1})


def composed(base: str, marks: str) -> str:
    """The longest beginning of a letter and its accents that Unicode has as one character; '' if the first one has none."""
    done, out = base, ""
    for i, m in enumerate(marks):
        done = unicodedata.normalize("NFC", done + m)
        if len(done) > 1:
            break
        out = base + marks[: i + 1]
    return out


def inventory(strings: DataFrame, text: str) -> Counter:
    """How often each code point, each written-out accented letter and the letters of each ligature occur in column ``text``
    (nulls have none), in one pass."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        strings: Counter = Counter()
        for batch in batches:
            whole = "\n".join(x for x in batch.column(0).to_pylist() if x)
            if whole:
                seen = np.bincount(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32), minlength=0x110000)
                total += seen
                if seen[0x300:0x370].any() or seen[0x3099:0x309B].any():
                    strings.update(c for b, m in MARKED.findall(whole) if (c := composed(b, m)))
                strings.update({x: n for x in LIGATURES if (n := whole.count(x))})
        at = np.flatnonzero(total)
        at = at[(at < 0xD800) | (at > 0xDFFF)]
        names, n = [*map(chr, at.tolist()), *strings], [*total[at].tolist(), *strings.values()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n, pa.int64())], names=["s", "n"])

    rows = strings.select(text).mapInArrow(count, "s STRING, n BIGINT").groupBy("s").agg(F.sum("n").alias("n"))
    return Counter({r["s"]: r["n"] for r in rows.collect()})


def representatives(seen: Counter) -> dict[str, str]:
    """Every member of a look-alike class that is met in the collection and isn't its class's representative, with it."""
    classes = Classes()
    for s in seen:
        if len(s) > 1:
            if s not in LIGATURES and unicodedata.combining(s[-1]) and (one := unicodedata.normalize("NFC", s)) != s:
                classes.join(s, one)
        elif (plain := CROSS.get(s, _plain(s))) is not None:
            classes.join(s, plain)
    out = {}
    for members in classes.all().values():
        # What shows nothing stands for nothing however often it occurs.
        best = "" if "" in members else max(members, key=lambda m: (seen[m], -len(m), [-ord(c) for c in m]))
        out |= {m: best for m in members if m != best and m in seen}
    return out


def automaton(members: dict[str, str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for m, best in members.items():
        a.add_word(m, (m, best, m in CROSS))
    a.make_automaton()
    return a


def _latin(ch: str) -> bool:
    return "LATIN" in unicodedata.name(ch, "")


def _mixed(text: str, at: int) -> bool:
    """Whether the word around ``at`` has a Latin letter."""
    inside = lambda i: text[i].isalpha() or text[i] in INVISIBLE or unicodedata.combining(text[i])
    for step in (1, -1):
        i = at + step
        while 0 <= i < len(text) and inside(i):
            if _latin(text[i]):
                return True
            i += step
    return False


def rewrite(text: str | None, a: ahocorasick.Automaton) -> str | None:
    """``text`` in the consistent form; null stays null."""
    if not text or not len(a):
        return text
    out, done = [], 0
    for end, (m, best, cross) in a.iter_long(text):
        start = end - len(m) + 1
        if cross and not _mixed(text, start):
            continue
        out += [text[done:start], best]
        done = end + 1
    return "".join([*out, text[done:]]) if out else text


def consistent(strings: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``text`` and ``form`` of the records whose text had to change; all others already are their form.

    Nulls and empty texts never change. Repeated rows are each returned. The classes hold for the whole of ``strings``.
    """
    members = representatives(inventory(strings, text))
    schema = strings.select(*keep, text).schema.add("form", "string")
    if not members:
        return strings.sparkSession.createDataFrame([], schema)
    marks = sorted({c for m in members for c in (m[-1:] if len(m) > 1 else m)})
    held = F.col(text).rlike("[" + "".join(f"\\x{{{ord(c):x}}}" for c in marks) + "]")
    if marks[0] > "\x7f":
        # Texts of as many bytes as characters hold none of these; counting costs far less than the expression.
        held = (F.length(text) < F.octet_length(text)) & held

    def change(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = automaton(members)
        for batch in batches:
            forms = [rewrite(t, a) for t in batch[text]]
            changed = np.fromiter((f != t for f, t in zip(forms, batch[text])), bool, len(batch))
            yield batch.assign(form=forms)[changed]

    return strings.select(*keep, text).where(held).mapInPandas(change, schema)


def found(text_lines: DataFrame, sections: DataFrame) -> DataFrame:
    """Lines and section titles that hold look-alikes, separated accents or invisible characters."""
    lines = text_lines.select(F.lit("line").alias("record_type"), F.col("line_uid").alias("record_id"), F.col("text").alias("string"))
    titles = sections.select(F.lit("section").alias("record_type"), F.col("section_uid").alias("record_id"), F.col("normalized_title").alias("string"))
    return consistent(lines.unionByName(titles), "string", ["record_type", "record_id"]).select("record_type", "record_id").distinct()
