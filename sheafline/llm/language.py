"""Languages of documents and of their segments: a linear-chain conditional random field over words.

Each word is described by its affixes, character 3-grams, itself and the lexicons it is in; the field adds a weight for
every step from one language to the next. Forward-backward gives each word's probability of each language in the light of
its neighbours; a sentence takes the language with the largest sum, with its mean probability as the confidence.

The field is trained here, on at most ``train_rows`` labelled records (those with the smallest hash of their id, a sample
that doesn't depend on the data's size). Labels are noisy: after a first fit, sentences the field itself contradicts are left
out and it is fitted again. Sequences of several sentences in different languages teach it the switches.
Everything else runs over all records.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from sheafline.llm import canonical
from sheafline.session import cut

LANGS = ("en", "es", "de", "fr", "it")

# What a label may say for each language, lower-cased, region codes cut off.
LABELS = {
    "en": "en eng english anglais inglés englisch inglese",
    "es": "es spa esp spanish español espanol castellano espagnol spanisch spagnolo",
    "de": "de deu ger german deutsch alemán allemand tedesco",
    "fr": "fr fra fre french français francais französisch francés francese",
    "it": "it ita italian italiano italienisch italien",
}
# Labels that say nothing.
NOTHING = ("", "und", "unk", "unknown", "n/a", "na", "none", "null", "mul", "zxx", "mis", "?", "-", "xx")
# Common words of each language, one of the lexicons.
COMMON = {
    "en": "the of and to in is for with that on as are by at from be or an this which when if before after not must until it can no every each",
    "es": "el la los las de del y en que un una con para por no se es al lo como más o su sin hasta antes después cuando si debe cada",
    "de": "der die das und in zu den dem des mit von für ist nicht ein eine auf sie im am wird bei nach vor bis oder wenn muss nur sich jeder",
    "fr": "le la les de des du et en un une à que pour dans est au aux avec par ne pas sur se ou il avant après jusqu si chaque doit lorsque",
    "it": "il lo la gli le di del della e in un una per con non che è da dal al si o ma prima dopo fino quando se deve ogni nel sul i",
}

BINS = 1 << 16
CODED = re.compile(r"(?<!\S)[^\s\d]*\d\S*")
DIGIT = re.compile(r"\d")
WORD = re.compile(r"[^\W\d_]+")
FOREIGN = re.compile("[\u0370-\uffff]")
BREAK = re.compile(r"(?<=[.!?:])\s+|\n\s*\n")
TABLE = re.compile(r"\|| {3,}|^[-=_ ]{4,}$|\t")


def lexicons(titles: list[tuple[str, str]]) -> dict[str, set[str]]:
    """Word lists of each language: the common words and those of the known titles."""
    out = {x: set(COMMON[x].split()) for x in LANGS}
    for lang, title in titles:
        if lang in out:
            out[lang] |= set(words(title))
    return out


def words(text: str) -> list[str]:
    """Lower-cased words; codes, numbers and words of other alphabets are of no language."""
    text = text.lower()
    if DIGIT.search(text):
        text = CODED.sub(" ", text)
    found = WORD.findall(text)
    return found if text.isascii() or not FOREIGN.search(text) else [w for w in found if not FOREIGN.search(w)]


def sentences(text: str | None) -> list[str]:
    """Sentences of running text: lines are joined within a paragraph, hyphens at line ends closed, table rows left out."""
    if not text:
        return []
    out = []
    for part in re.split(r"\n\s*\n", text):
        lines = [x for x in part.split("\n") if not TABLE.search(x.strip())]
        joined = re.sub(r"(?<=[^\W\d_])[-­¬]\n(?=[^\W\d_])", "", "\n".join(lines)).replace("\n", " ")
        out += [s.strip() for s in BREAK.split(joined) if s and s.strip()]
    return out


def features(word: str, lexicon: dict[str, set[str]]) -> list[int]:
    """Hashed features of a word; 0 is the bias."""
    w = f"^{word}$"
    names = [f"w{word}", *(f"p{word[:n]}" for n in (1, 2, 3)), *(f"s{word[-n:]}" for n in (1, 2, 3, 4)), *(f"n{w[i:i + 3]}" for i in range(len(w) - 2))]
    return [0, *(1 + i for i, x in enumerate(LANGS) if word in lexicon[x]), *(8 + zlib.crc32(x.encode()) % (BINS - 8) for x in names)]


class Field:
    """Weights of the field; ``emit`` caches a word's scores."""

    def __init__(self, lexicon: dict[str, set[str]]) -> None:
        self.lexicon = lexicon
        self.weights = np.zeros((BINS, len(LANGS)))
        self.steps = np.zeros((len(LANGS), len(LANGS)))
        self.known: dict[str, int] = {}
        self.scores = np.zeros((1024, len(LANGS)), np.float32)

    def emit(self, words: list[str]) -> np.ndarray:
        """Scores of the words; those of a word are computed once, as long as no more than some hundred thousand are kept."""
        if len(self.known) > 300_000:
            self.known = {}
        known = self.known
        for w in {w for w in words if w not in known}:
            if len(known) == len(self.scores):
                self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
            self.scores[len(known)] = self.weights[features(w, self.lexicon)].sum(0)
            known[w] = len(known)
        return self.scores[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]

    @staticmethod
    def marginals(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over padded sequences: (B, T, L) scores to (B, T, L) probabilities and summed (L, L) steps."""
        b, t, k = scores.shape
        e = np.exp(scores - scores.max(2, keepdims=True))
        m = np.exp(steps)
        alive = np.arange(t)[None, :] < lengths[:, None]
        alpha, beta = np.zeros_like(e), np.ones_like(e)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for i in range(1, t):
            a = (alpha[:, i - 1] @ m) * e[:, i]
            alpha[:, i] = np.where(alive[:, i, None], a / a.sum(1, keepdims=True), alpha[:, i - 1])
        for i in range(t - 2, -1, -1):
            c = (beta[:, i + 1] * e[:, i + 1]) @ m.T
            beta[:, i] = np.where(alive[:, i + 1, None], c / c.sum(1, keepdims=True), 1.0)
        gamma = alpha * beta
        gamma /= gamma.sum(2, keepdims=True)
        pair = np.zeros((k, k))
        for i in range(1, t):
            x = alpha[:, i - 1, :, None] * m[None] * (e[:, i] * beta[:, i])[:, None, :]
            x /= x.sum((1, 2), keepdims=True)
            pair += x[alive[:, i]].sum(0)
        return gamma, pair

    def label(self, sequences: list[list[str]], batch: int = 256) -> list[np.ndarray]:
        """Each word's probabilities, for every sequence; an empty sequence has none."""
        out: list[np.ndarray] = [np.zeros((0, len(LANGS)))] * len(sequences)
        order = sorted((i for i, s in enumerate(sequences) if s), key=lambda i: len(sequences[i]))
        for a in range(0, len(order), batch):
            ids = order[a : a + batch]
            lengths = np.array([len(sequences[i]) for i in ids])
            scores = np.zeros((len(ids), lengths.max(), len(LANGS)))
            scores[np.arange(lengths.max())[None, :] < lengths[:, None]] = self.emit([w for i in ids for w in sequences[i]])
            gamma = self._forward_backward(scores, lengths)
            for r, i in enumerate(ids):
                out[i] = gamma[r, : lengths[r]]
        return out

    def _forward_backward(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        e = np.exp(scores - scores.max(2, keepdims=True))
        m, (b, t, k) = np.exp(self.steps), e.shape
        e = np.ascontiguousarray(e.transpose(1, 0, 2))
        alpha, beta = np.zeros_like(e), np.ones_like(e)
        alpha[0] = e[0] / e[0].sum(1, keepdims=True)
        # Sequences are sorted by length: those that have ended lie at the front.
        ended = np.searchsorted(lengths, np.arange(t), side="right")
        for i in range(1, t):
            a = (alpha[i - 1, ended[i] :] @ m) * e[i, ended[i] :]
            alpha[i, ended[i] :] = a / a.sum(1, keepdims=True)
        for i in range(t - 2, -1, -1):
            c = (beta[i + 1, ended[i + 1] :] * e[i + 1, ended[i + 1] :]) @ m.T
            beta[i, ended[i + 1] :] = c / c.sum(1, keepdims=True)
        gamma = alpha * beta
        return (gamma / np.maximum(gamma.sum(2, keepdims=True), 1e-300)).transpose(1, 0, 2)

    def fit(self, sequences: list[tuple[list[str], list[int]]], epochs: int = 4, batch: int = 64, rate: float = 0.3, decay: float = 1e-6) -> Field:
        """Maximise the conditional likelihood by AdaGrad on batches of sequences of like length."""
        sequences = sorted((s for s in sequences if s[0]), key=lambda s: len(s[0]))
        index: dict[str, int] = {}
        rows: list[list[int]] = []
        for ws, _ in sequences:
            for w in ws:
                if w not in index:
                    index[w] = len(rows)
                    rows.append(features(w, self.lexicon))
        width = max((len(r) for r in rows), default=1)
        table = np.full((len(rows), width), BINS, np.int64)
        for i, r in enumerate(rows):
            table[i, : len(r)] = r
        weights = np.vstack([self.weights, np.zeros((1, len(LANGS)))])
        seen, seen_steps = np.full_like(weights, 1e-8), np.full_like(self.steps, 1e-8)
        rng = np.random.default_rng(7)
        parts = []
        for a in range(0, len(sequences), batch):
            part = sequences[a : a + batch]
            lengths = np.array([len(ws) for ws, _ in part])
            used, local = np.unique(np.array([index[w] for ws, _ in part for w in ws]), return_inverse=True)
            gold = np.array([x for _, ls in part for x in ls])
            within = np.ones(len(gold) - 1, bool)
            within[np.cumsum(lengths)[:-1] - 1] = False
            true = np.bincount((gold[:-1] * len(LANGS) + gold[1:])[within], minlength=len(LANGS) ** 2).reshape(len(LANGS), -1)
            parts.append((lengths, used, local, gold, true, *np.unique(table[used].ravel(), return_inverse=True)))
        for _ in range(epochs):
            for j in rng.permutation(len(parts)):
                lengths, used, local, gold, true, grad_ids, inverse = parts[j]
                emission = weights[table[used]].sum(1)
                scores = np.zeros((len(lengths), lengths.max(), len(LANGS)))
                at = np.arange(lengths.max())[None, :] < lengths[:, None]
                scores[at] = emission[local]
                gamma, pair = self.marginals(scores, lengths, self.steps)
                # Gradient of the emissions per distinct word, then spread over its features.
                error = -gamma[at]
                error[np.arange(len(gold)), gold] += 1
                summed = lambda at, x, n: np.stack([np.bincount(at, x[:, c], n) for c in range(len(LANGS))], axis=1)
                per_word = summed(local, error, len(used))
                grad = summed(inverse, np.repeat(per_word, width, axis=0), len(grad_ids))
                grad -= decay * weights[grad_ids]
                seen[grad_ids] += grad**2
                weights[grad_ids] += rate * grad / np.sqrt(seen[grad_ids])
                weights[BINS] = 0
                g = true - pair
                seen_steps += g**2
                self.steps += rate * g / np.sqrt(seen_steps)
        self.weights, self.known = weights[:BINS], {}
        return self


def train(labelled: list[tuple[str, str]], titles: list[tuple[str, str]], rounds: int = 2) -> Field:
    """Fit a field on (language, text) pairs with noisy languages and (language, title) pairs."""
    lexicon = lexicons(titles)
    units = [(LANGS.index(x), w) for x, text in labelled if x in LANGS for s in sentences(text) if len(w := words(s)) >= 3]
    rng = np.random.default_rng(11)
    field = Field(lexicon)
    for r in range(rounds):
        field = Field(lexicon)
        sequences = []
        order = rng.permutation(len(units))
        at = 0
        while at < len(order):
            n = int(rng.integers(1, 6))
            picked = [units[i] for i in order[at : at + n]]
            sequences.append(([w for _, ws in picked for w in ws], [x for x, ws in picked for _ in ws]))
            at += n
        short = [(LANGS.index(x), words(t)) for x, t in titles if x in LANGS]
        for _ in range(10):
            for i, j in rng.integers(0, max(1, len(short)), (len(short), 2)):
                a, b = short[i], short[j]
                sequences += [(a[1], [a[0]] * len(a[1])), (a[1] + b[1], [a[0]] * len(a[1]) + [b[0]] * len(b[1]))]
        field.fit(sequences, epochs=4 if r + 1 == rounds else 2)
        if r + 1 < rounds:
            units = [u for u, g in zip(units, field.label([ws for _, ws in units])) if g.sum(0).argmax() == u[0]]
    return field


def label_column(label):
    """The language code a label names, '' where it says nothing, 'other' for any further language."""
    base = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    base = F.when(base.rlike("^[a-z]{2,3}[-_][a-z0-9]+$"), F.regexp_extract(base, "^[a-z]+", 0)).otherwise(base)
    out = F.when(base.isin(*NOTHING), "")
    for code, names in LABELS.items():
        out = out.when(base.isin(*names.split()), code)
    return out.otherwise("other")


def model(records: DataFrame, record_id: str, text: str, label: str, titles: DataFrame, train_rows: int = 1500, max_titles: int = 10_000) -> Field:
    """The field fitted on at most ``train_rows`` records whose label names one of the languages, and at most
    ``max_titles`` known titles (columns lang and title)."""
    lang = label_column(F.col(label))
    rows = (
        records.select(F.col(record_id).alias("i"), lang.alias("lang"), F.col(text).alias("text"))
        .where(F.col("lang").isin(*LANGS) & F.col("text").isNotNull())
        .orderBy(F.xxhash64("i"), "i")
        .limit(train_rows)
        .collect()
    )
    known = titles.select("lang", "title").where("lang is not null and title is not null").distinct().orderBy("lang", "title").limit(max_titles).collect()
    return train([(r["lang"], r["text"]) for r in rows], [(r["lang"], r["title"]) for r in known])


SEGMENTS = "field STRING, segment INT, lang STRING, confidence DOUBLE, n_words INT, piece STRING"


def _title_segments(title: str, gamma: np.ndarray) -> list[tuple[str, float, int, str]]:
    """Runs of one language within a title: (language, confidence, words, text)."""
    spans = [m.span() for m in WORD.finditer(CODED.sub(lambda m: " " * len(m[0]), title)) if not FOREIGN.search(m[0])]
    best = gamma.argmax(1)
    out = []
    for i, x in enumerate(best):
        if out and out[-1][0] == x:
            out[-1][1].append(i)
        else:
            out.append((x, [i]))
    return [(LANGS[x], float(gamma[at, x].mean()), len(at), title[spans[at[0]][0] : spans[at[-1]][1]]) for x, at in out]


def _tagged(batches: Iterator[pd.DataFrame], weights: tuple) -> Iterator[tuple[pd.DataFrame, list, list]]:
    """Parts of the batches (t, n) with (number, (language, confidence, words, text)) of the sentences of every text, and the
    runs of every title."""
    own = Field(weights[2])
    own.weights, own.steps = weights[0], weights[1]
    for whole in batches:
        for a in range(0, len(whole), 2000):
            batch = whole.iloc[a : a + 2000]
            texts = []
            pieces = [sentences(t) for t in batch["t"]]
            split = [[words(s) for s in p] for p in pieces]
            for p, ws, g in zip(pieces, split, own.label([[w for s in x for w in s] for x in split])):
                found, at = [], 0
                sums = np.concatenate((np.zeros((1, len(LANGS))), np.cumsum(g, axis=0)))
                for n, (s, w) in enumerate(zip(p, ws)):
                    if w:
                        mean = (sums[at + len(w)] - sums[at]) / len(w)
                        best = int(mean.argmax())
                        found.append((n, (LANGS[best], float(mean[best]), len(w), s)))
                    at += len(w)
                texts.append(found)
            names = [t or "" for t in batch["n"]]
            yield batch, texts, [_title_segments(t, g) for t, g in zip(names, own.label([words(t) for t in names]))]


def segments(records: DataFrame, record_id: str, text: str, title: str, field: Field) -> DataFrame:
    """record_id, field, segment, lang, confidence, n_words, piece: every sentence of the text and every run of one
    language within the title. Null and empty values have no segments; pieces without words (numbers, codes, table rows)
    have no language and no row. Repeated rows are each labelled."""
    sc = records.sparkSession.sparkContext
    weights = sc.broadcast((field.weights.astype(np.float32), field.steps, field.lexicon))
    kind = records.schema[record_id].dataType.simpleString()

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, texts, titles in _tagged(batches, weights.value):
            rows = [(i, "text", n, *x) for i, found in zip(batch["i"], texts) for n, x in found]
            rows += [(i, "title", n, *x) for i, found in zip(batch["i"], titles) for n, x in enumerate(found)]
            yield pd.DataFrame(rows, columns=["i", "field", "segment", "lang", "confidence", "n_words", "piece"])

    rows = records.select(F.col(record_id).alias("i"), F.col(text).alias("t"), F.col(title).alias("n"))
    return rows.mapInPandas(tag, f"i {kind}, {SEGMENTS}").withColumnRenamed("i", record_id)


def section_languages(records: DataFrame, record_id: str, text: str, title: str, field: Field, least_words: int, confidence: float) -> DataFrame:
    """``records`` with langs, the languages of full sentences of the text, and title_langs, those of the title's runs. A full
    sentence has at least ``least_words`` words, is of its language with at least ``confidence`` and ends as one."""
    weights = records.sparkSession.sparkContext.broadcast((field.weights.astype(np.float32), field.steps, field.lexicon))

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Of the other columns nothing is known: they pass as they are.
        for batch, texts, titles in _tagged((b.assign(t=b[text], n=b[title]) for b in batches), weights.value):
            full = [sorted({x for _, (x, c, n, s) in found if n >= least_words and c >= confidence and s[-1] in ".!?"}) for found in texts]
            runs = [sorted({x for x, c, *_ in found if c >= 0.5}) for found in titles]
            yield batch.drop(columns=["t", "n"]).assign(langs=full, title_langs=runs)

    schema = T.StructType([*records.schema.fields, T.StructField("langs", T.ArrayType(T.StringType())), T.StructField("title_langs", T.ArrayType(T.StringType()))])
    return records.mapInPandas(tag, schema)


def two_titles(titles: DataFrame, known: DataFrame) -> DataFrame:
    """title, langs (two) of the rows of ``titles`` (title, langs) that give one entry of ``known`` (canon_id, lang, title) in two of
    these languages, one behind the other. Both halves are led to titles by the partition join over edit distances, as
    typed titles are; of several readings the one with the fewest edits counts. Nothing is collected."""
    letters = lambda c: F.expr(canonical.folded(c))
    squashed = lambda c: F.regexp_replace(c, r"[^\p{L}]", "")
    split = titles.select("title", "langs").distinct().withColumn("w", F.filter(F.split(F.regexp_replace(letters("title"), r"(?<!\S)[^\s\d]*\d\S*", " "), r"[^\p{L}]+"), lambda w: w != ""))
    at = split.where(F.size("w") > 1).select("title", "langs", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("i"))
    halves = cut(at.select("title", "langs", "i", F.array_join(F.slice("w", F.lit(1), F.col("i")), "").alias("l"), F.array_join(F.slice("w", F.col("i") + 1, F.size("w")), "").alias("r")))
    refs = known.select("canon_id", "lang", squashed(letters("title")).alias("ref")).where("canon_id is not null and lang is not null and ref <> ''").distinct()
    allowed = refs.select(F.col("ref").alias("form")).distinct().withColumn("k", F.expr(canonical.EDITS))
    forms = halves.select(F.col("l").alias("form")).unionByName(halves.select(F.col("r").alias("form"))).distinct()
    near = cut(canonical.near(forms, allowed).join(refs, "ref").groupBy("form", "canon_id", "lang").agg(F.min("d").alias("d")))
    side = lambda s: near.select(F.col("form").alias(s), "canon_id", F.col("lang").alias(f"{s}_lang"), F.col("d").alias(f"{s}_d"))
    both = halves.join(side("l"), "l").where(F.array_contains("langs", F.col("l_lang"))).join(side("r"), ["r", "canon_id"])
    both = both.where(F.array_contains("langs", F.col("r_lang")) & (F.col("l_lang") != F.col("r_lang")))
    best = both.groupBy("title", "langs").agg(F.min(F.struct(F.expr("l_d + r_d").alias("d"), "i", "l_lang", "r_lang")).alias("b"))
    return best.select("title", F.col("langs").alias("tagged"), F.array("b.l_lang", "b.r_lang").alias("langs"))


def latest(sections: DataFrame) -> DataFrame:
    """One row per section, the one that came last."""
    one = sections.groupBy("section_uid").agg(F.max_by(F.struct("raw_title", "text_plain", "lang"), F.struct("ingested_at", "extracted_at")).alias("s"))
    return one.select("section_uid", "s.*")


def found(sections: DataFrame, known: DataFrame, least_words: int = 4, confidence: float = 0.6) -> DataFrame:
    """Languages of sections whose label is missing or wrong or whose text mixes languages, and of two-language titles.

    A full sentence has at least ``least_words`` words, is of its language with at least ``confidence`` and ends as one.
    """
    one = latest(sections)
    field = model(one, "section_uid", "text_plain", "lang", known)
    cases = cut(section_languages(one, "section_uid", "text_plain", "raw_title", field, least_words, confidence).drop("text_plain").withColumn("label", label_column(F.col("lang"))))
    wrong = (F.size("langs") > 1) | (F.col("label") == "") | (F.size("langs") == 1) & (F.col("label") != F.try_element_at("langs", F.lit(1)))
    texts = cases.where((F.size("langs") > 0) & wrong).select("section_uid", F.lit("text_plain").alias("field"), F.explode("langs").alias("lang"))
    several = cases.where((F.size("title_langs") > 1) & F.col("raw_title").isNotNull()).select("section_uid", F.col("raw_title").alias("title"), F.col("title_langs").alias("tagged"))
    named = two_titles(several.select("title", F.col("tagged").alias("langs")), known)
    titles = several.join(named, ["title", "tagged"]).select("section_uid", F.lit("raw_title").alias("field"), F.explode("langs").alias("lang"))
    return texts.unionByName(titles)


def section_segments(sections: DataFrame, known: DataFrame) -> DataFrame:
    """section_uid, field, segment, lang, confidence, n_words of every segment of every section: its sentences and the runs of one
    language within its title."""
    one = latest(sections)
    field = model(one, "section_uid", "text_plain", "lang", known)
    return segments(one, "section_uid", "text_plain", "raw_title", field).drop("piece")
