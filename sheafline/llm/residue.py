"""Template residue, filler, error pages and script notices instead of content.

1. *Natural prose* is modelled on the whole collection: counts of hashed character 5-grams, and of 4-grams of the text's shape
   around symbols (letters, capitals and digits each as one symbol, a repeated capital as another, other characters as
   themselves). The tables have a fixed size; tasks add up their own and only sums travel.
2. *Residue* is modelled on general texts: the messages of web servers, browsers and viewers, the usual wordings of filler
   and the classical filler passage, by character 5-grams; placeholders by shape 4-grams.
3. *Windows*: every n-gram carries the logarithm of its frequency in the residue model over that in natural prose. A sentence
   or line is residue if its mean ratio is high and windows of positive mean cover most of it; a sentence that only speaks
   of an error message is covered in part.
4. *Learning*: what stands beside recognised residue and hardly anywhere else in the collection (the site's own menu, its
   wording of a notice) is added to the residue model, and what was recognised is taken out of the natural one. Then the
   final reading judges every text anew, so a notice that the general texts don't foresee is known by its company elsewhere.
5. *Placeholders* are short: in a line with a hot shape window an expression finds where they may begin and end, and the sum
   of the ratios of the windows over it decides. A placeholder counts if it interrupts natural text: the words before and
   after it are neighbours elsewhere, or it stands alone. Where it is the subject of its sentence ("the field {{serial}}
   prints"), its neighbours meet nowhere else. These pairs are looked up among the word pairs of the whole collection.

Ratios fall with residue's share of all characters: a notice that makes up more than about a tenth of the collection's text
would be taken for natural.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sheafline.session import cut

GRAMS, SHAPES, BINS = 1 << 20, 1 << 16, 1 << 22
CHUNK = 1 << 16
#: Characters looked at as one array: small enough for a core's cache.
AT_ONCE = 400_000

# The passage that filler text takes its words from, in any order.
PASSAGE = """
lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat duis aute irure
dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur excepteur sint occaecat cupidatat non
proident sunt in culpa qui officia deserunt mollit anim id est laborum
"""

# General wordings of filler.
FILLER = """
text text text text text text text text
xxx xxx xxx xxx xxx xxx xxxx xxxx
asdf asdf asdf asdf qwerty qwerty qwerty
test test test test test. blah blah blah blah. foo bar baz. abc abc abc
blindtext blindtext blindtext blindtext das ist ein blindtext
your text here. insert text here. add text here. add your text here. enter text here. type your text here. sample text. your text goes here.
this is sample text. this is placeholder text. this is dummy text. a sample paragraph of text goes here. sample content goes here. replace this text with your own.
a short description goes here. enter a short description of the product. describe your product here in a few sentences. write a few sentences about the product here.
(insert name) (insert number) (insert date) (insert picture here) (insert figure) (add picture) (enter value) (to be completed) (your text here) (fill in)
insert image here. insert drawing here. image goes here. add notes here. add warnings for this product before publication. add instructions for this model before publishing.
complete this section before release. to be added. to be completed. to be supplied later. to be determined. content to follow. content coming soon. replace before release.
hier text einfügen. hier steht später der text. hier steht ihr text. platzhaltertext. mustertext. beschreibung hier einfügen. hier eine beschreibung einfügen. produktbeschreibung folgt. bild einfügen. text folgt.
escriba aquí su texto. inserte aquí su texto. texto de ejemplo. texto de relleno. añada aquí una descripción. escriba aquí una descripción. descripción pendiente. texto pendiente.
saisissez votre texte ici. insérez votre texte ici. texte à compléter. texte de remplacement. ajoutez une description ici. décrivez ici le produit. description à compléter.
inserire qui il testo. inserire qui una descrizione. testo segnaposto. testo di esempio. scrivere qui il testo. aggiungere qui una descrizione. descrizione da inserire. da completare.
"""

# General wordings of error pages, refused access and demands for scripts.
NOTICES = """
400 bad request. 401 unauthorized. 403 forbidden. 404 not found. 405 method not allowed. 408 request timeout. 410 gone. 429 too many requests. http 404. http error 500. error 404. error code 000.
500 internal server error. 502 bad gateway. 503 service unavailable. 504 gateway timeout. http status 404 not found. http error 503: the service is unavailable.
the requested url was not found on this server. the requested resource could not be found on this server. you don't have permission to access this resource. the server could not locate the requested file.
the server encountered an internal error or misconfiguration and was unable to complete your request. please contact the server administrator. if the problem continues, contact the administrator.
the server is temporarily unable to service your request due to maintenance downtime or capacity problems. the proxy server received an invalid response from an upstream server. the upstream server did not respond in time.
the page you are looking for is temporarily unavailable. this service is temporarily unavailable. please try again later. sorry for the inconvenience. the page could not be displayed. the page could not be loaded.
the resource you are looking for has been removed, had its name changed, or is temporarily unavailable. the page you are looking for does not exist. sorry, that page does not exist. this page no longer exists.
this site can't be reached. the connection has timed out. the server is taking too long to respond. the host did not respond. no response from the server after 000 seconds. unable to connect. this page isn't working.
page not found. sorry, we could not find that page. oops! that page can't be found. it looks like nothing was found at this location. the document you requested could not be found. the document you asked for is not available. the file does not exist.
go back to the home page. return to the homepage. return to the previous page. back to the start page. home | search | login. home | contact | help. menu. skip to content. main menu. site map. search. contact us.
something went wrong. oops! something went wrong. something went wrong while loading the page. an unexpected error has occurred while loading the document. failed to load the document. please reload the page and try again.
there was an error opening this document. the file is damaged and could not be repaired. the file is corrupt and could not be opened. the preview could not be loaded.
you have been rate limited. you have sent too many requests in a given amount of time. too many requests from your network. please wait a few seconds and try again. please slow down.
access denied. access to this page has been denied. you are not authorized to view this page. you do not have permission to view this page. you do not have permission to view this file. this content is restricted to members.
your session has timed out. your session is no longer valid. session expired. please log in again. please sign in again. sign in to continue. log in to continue. you must be logged in to view this page. sign in to your account to view this content.
this link has expired. this link is no longer valid. the link you followed may be broken, or the page may have been removed. this content has been removed. this download is no longer available.
down for maintenance. we will be back soon. briefly unavailable for scheduled maintenance. check back in a minute. the website is under maintenance.
request id. reference number. incident id. ray id. powered by apache 0.0. powered by nginx 0.0.0. powered by wordpress 0.0. server version 0.0
you need to enable javascript to run this app. javascript is not available. we have detected that javascript is disabled in this browser. please enable javascript or switch to a supported browser to continue.
javascript is required. javascript must be enabled in order to use this site. please enable javascript to view this page. please enable javascript to view the content. please turn javascript on and reload the page. enable javascript and cookies to continue.
checking your browser before accessing the site. checking if the connection is secure. your browser will redirect to your requested content shortly. cookies are required to use this site. scripts must be enabled.
this site requires scripts. this page needs scripts to work. your browser does not support scripts or has scripts turned off. please allow scripts and cookies in your browser.
fehler 404. seite nicht gefunden. dokument nicht gefunden. die angeforderte seite konnte nicht gefunden werden. die gewünschte seite existiert nicht mehr. interner serverfehler. es ist ein fehler aufgetreten. zur startseite. zurück zur startseite.
der server ist derzeit nicht erreichbar. die website ist vorübergehend nicht verfügbar. dieser dienst steht momentan nicht zur verfügung. bitte versuchen sie es später noch einmal. zugriff verweigert. ihre sitzung ist abgelaufen. bitte melden sie sich an.
bitte aktivieren sie javascript in ihrem browser. bitte aktivieren sie javascript, um die seite anzuzeigen. javascript ist deaktiviert. diese website benötigt javascript. diese website benötigt skripte. cookies müssen aktiviert sein. skripte sind blockiert.
error 404: página no encontrada. no se ha encontrado la página. el archivo solicitado no se ha encontrado. la página solicitada no existe. el servidor no está disponible. el servicio no está disponible temporalmente. inténtelo de nuevo más tarde. vuelva a intentarlo más tarde. volver al inicio.
acceso denegado. no tiene permiso para ver esta página. su sesión ha caducado. inicie sesión para continuar. se ha producido un error. error interno del servidor.
active javascript para ver esta página. javascript está desactivado en su navegador. este sitio necesita javascript. es necesario que los scripts estén activados. permita los scripts y las cookies. su navegador no admite scripts.
erreur 404. page introuvable. la page demandée est introuvable. le document demandé n'existe pas. la page que vous cherchez n'existe plus. le service est temporairement indisponible. le site est momentanément indisponible. veuillez réessayer plus tard. retour à l'accueil.
accès refusé. vous n'avez pas l'autorisation de voir cette page. votre session a expiré. veuillez vous connecter. connectez-vous pour continuer. une erreur est survenue. erreur interne du serveur.
veuillez activer javascript pour afficher cette page. javascript est désactivé dans votre navigateur. ce site nécessite javascript. ce site nécessite l'activation des scripts. les cookies sont nécessaires.
errore 404. pagina non trovata. il file richiesto non è stato trovato. la pagina richiesta non esiste. il servizio non è al momento disponibile. sito temporaneamente non disponibile. riprovare più tardi. si prega di riprovare più tardi. torna alla pagina iniziale.
accesso negato. non si dispone dell'autorizzazione per vedere questa pagina. la sessione è scaduta. accedere per continuare. si è verificato un errore. errore interno del server.
attivare javascript per visualizzare questa pagina. javascript è disattivato nel browser. questo sito richiede javascript. questo sito richiede gli script. abilitare i cookie. il browser non supporta gli script.
"""

# Delimiters of placeholders and names that stand between them, from which the seed of the shape model is written.
DELIMITERS = [
    ("{{", "}}"), ("{{ ", " }}"), ("{", "}"), ("{% ", " %}"), ("${", "}"), ("$(", ")"), ("[[", "]]"), ("[", "]"), ("<<", ">>"), ("<", ">"),
    ("«", "»"), ("(( ", " ))"), ("__", "__"), ("@@", "@@"), ("%", "%"), ("#", "#"), ("<?= ", " ?>"), ("<% ", " %>"), ("&lt;", "&gt;"), ("##", "##"),
]
NAMES = ["name", "PRODUCT_NAME", "product_name", "Your text here", "DATE", "address_line_2", "insert title", "TODO: value", "image: side view", "TBD", "spec.weight | default", "INSERT TITLE HERE"]
BLANKS = ["XXXX-XXXX", "XXX-XXXX", "XXXX", "NN.NN.NNNN", "DD.MM.YYYY", "#VALUE!", "#REF!", "#NAME?", "#DIV/0!", "_______", "%s", "%d"]

#: Where placeholders may begin and end: a short name between symbols, spreadsheet errors, print formats, repeated capitals.
ENDS = re.compile(
    r"&lt;[^&\n]{1,60}&gt;|\{\{[^{}\n]{1,60}\}\}|<<[^<>\n]{1,60}>>|@@[^@\n]{1,60}@@|\$\([^()\n]{1,60}\)|\(\([^()\n]{1,60}\)\)|\([^()\n]{1,60}\)|(?:[\[{<«$]+[?%]?=?|@@|##?|__|%)(?= ?[^\W\d])[^\[\]{}<>«»@#\n]{1,60}?(?:\)|[%?]?[\]}>»]+|@@|##?|__|%)"
    r"|#[A-Z/0]{2,8}[!?]|(?<![\w-])([A-Z])\1+(?:[-.]([A-Z])\2+)+(?![\w-])|(?<![\w-])([A-Z])\3{2,}(?![\w-])|%[sd]\b|_{4,}"
)
WORD = re.compile(r"[^\W_]+")
DIGIT = re.compile(r"\d")


def _codes(text: str) -> np.ndarray:
    """UTF-16 code units."""
    return np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)


def _hashed(codes: np.ndarray, n: int, size: int) -> np.ndarray:
    """Bin of the n-gram (n 4 or 5) that begins at each position; ``size`` is a power of two."""
    m = len(codes) - n + 1
    if m < 1:
        return np.zeros(0, np.uint32)
    x = codes.astype(np.uint32)
    two = x[:-1] * np.uint32(0x9E3779B1) + x[1:]
    h = two[:-2] * np.uint32(0x85EBCA77)
    h += two[2:]
    if n == 5:
        h = h[:-1] * np.uint32(0xC2B2AE3D)
        h += x[4:]
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x27D4EB2F)
    return h >> np.uint32(33 - size.bit_length())


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code unit its plain form (lower case, digits 0), its shape (letters a, capitals A, digits 0, others themselves)
    and whether it is one of a word."""
    low, shape, word = np.arange(0x10000, dtype=np.uint16), np.arange(0x10000, dtype=np.uint16), np.zeros(0x10000, bool)
    for i in range(0x10000):
        c = chr(i)
        small = c.lower()
        word[i] = c.isalnum() or 0xD800 <= i < 0xE000
        if c.isalpha():
            low[i], shape[i] = ord(small[0]), 65 if small != c else 97
        elif "0" <= c <= "9":
            low[i] = shape[i] = 48
    return low, shape, word


_PLAIN, _SHAPE, _WORD = _tables()
#: Characters that no placeholder is known by, unless they are doubled.
_USUAL = np.zeros(0x10000, bool)
_USUAL[[ord(c) for c in "aA0 \n\t\r.,;:'\"-()/’°•*+=–—!?|"]] = True
_DOUBLED = np.zeros(0x10000, bool)
_DOUBLED[[ord(c) for c in "aA0 \n\t.-*=–—!?"]] = True


def plain(codes: np.ndarray) -> np.ndarray:
    """Lower case, every digit 0; a unit for each."""
    return _PLAIN[codes]


def shape(codes: np.ndarray) -> np.ndarray:
    """Letters a, capitals A, a capital repeating the one before it R, digits 0, other characters as they are."""
    out = _SHAPE[codes]
    again = np.flatnonzero(codes[1:] == codes[:-1]) + 1
    out[again[out[again] == 65]] = ord("R")
    return out


def shape_grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, bin) of the shape 4-grams that touch a symbol."""
    s = shape(codes)
    odd = ~_USUAL[s]
    odd[1:] |= (s[1:] == s[:-1]) & ~_DOUBLED[s[1:]]
    at = np.flatnonzero(odd)
    at = np.unique((at[:, None] - np.arange(4)).ravel())
    at = at[(at >= 0) & (at < len(s) - 3)]
    if not len(at):
        return at, np.zeros(0, np.uint32)
    four = s[at[:, None] + np.arange(4)]
    return at, _hashed_rows(four)


def _hashed_rows(four: np.ndarray) -> np.ndarray:
    h = np.zeros(len(four), np.uint32)
    for i in range(4):
        h = h * np.uint32(0x9E3779B1) + four[:, i].astype(np.uint32)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(33 - SHAPES.bit_length())


def _words(text: str) -> list[str]:
    """Words of each line, numbers and codes as 0, with a mark at both ends of the line."""
    out = []
    for line in text.split("\n"):
        if line.strip():
            out += ["", *("0" if DIGIT.search(w) else w for w in WORD.findall(line.lower()))]
    return [*out, ""]


def chunks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Many texts as one array: (code units with a line end behind every text, where each text begins, its place in
    ``texts``); texts are never cut, null and empty ones left out."""
    part: list[bytes] = []
    at: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if t:
            part.append(t.encode("utf-16-le", "surrogatepass"))
            at.append(i)
            size += len(part[-1]) + 2
        if part and (size >= 2 * AT_ONCE or i + 1 == len(texts)):
            starts = np.concatenate(([0], np.cumsum([len(p) // 2 + 1 for p in part])))
            yield np.frombuffer(b"\n\0".join([*part, b""]), np.uint16), starts, at
            part, at, size = [], [], 0


def _summed(rows: DataFrame, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Tables of counts added up from the chunks that tasks emit; their size doesn't depend on the data."""

    def add(chunk: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(d), np.int64) for d in chunk["data"])
        return pd.DataFrame([(chunk["chunk"].iloc[0], zlib.compress(total.tobytes(), 1))], columns=["chunk", "data"])

    flat = np.zeros(sum(sizes), np.int64)
    for r in rows.groupBy("chunk").applyInPandas(add, "chunk INT, data BINARY").collect():
        flat[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["data"]), np.int64)
    return np.split(flat, np.cumsum(sizes)[:-1])


def _emitted(total: list[np.ndarray]) -> pd.DataFrame:
    flat = np.concatenate(total)
    parts = [(i // CHUNK, flat[i : i + CHUNK]) for i in range(0, len(flat), CHUNK)]
    return pd.DataFrame([(i, zlib.compress(p.tobytes(), 1)) for i, p in parts if p.any()], columns=["chunk", "data"])


def natural_counts(documents: DataFrame, text: str) -> list[np.ndarray]:
    """The two count tables of the whole collection; null texts count nothing."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros(n, np.int64) for n in (GRAMS, SHAPES)]
        for batch in batches:
            for codes, starts, _ in chunks(batch[text].tolist()):
                # Without the n-grams that reach into the next text.
                over = (starts[1:, None] - 1 - np.arange(4)).ravel()
                total[0] += np.bincount(np.delete(_hashed(plain(codes), 5, GRAMS), over[(over >= 0) & (over < len(codes) - 4)]), minlength=GRAMS)
                at, bins = shape_grams(codes)
                total[1] += np.bincount(bins[~np.isin(at, over) | (codes[np.minimum(at + 3, len(codes) - 1)] == 10)], minlength=SHAPES)
        yield _emitted(total)

    return _summed(documents.select(text).mapInPandas(count, "chunk INT, data BINARY"), (GRAMS, SHAPES))


def _ratios(seed: np.ndarray, natural: np.ndarray, all_natural: float, keep: float = 0.1) -> np.ndarray:
    """Log of residue frequency, of which a share ``keep`` is that of natural prose, over natural frequency."""
    nat = (natural + 0.5) / (all_natural + 0.5 * len(natural))
    own = seed / max(1, seed.sum())
    return np.log(((1 - keep) * own + keep * nat) / nat).astype(np.float32)


def _shuffled(passage: str, words: int = 12_000) -> str:
    """The passage's words in random order, so that every pair of neighbours has its share of the model."""
    rng = np.random.default_rng(1)
    return " ".join(rng.choice(passage.split(), words))


def _grams(text: str) -> np.ndarray:
    return np.bincount(_hashed(plain(_codes(text)), 5, GRAMS), minlength=GRAMS)


#: Share of a sentence that residue windows must cover, the mean log ratio and the sum it must reach (one n-gram alone, whose
#: bin may be another's, is no evidence), the sum that the shape windows of a
#: placeholder must reach, and how often and in what share of its occurrences an n-gram must stand beside residue to be learned.
COVERED, MEAN, SUM, MARK, LEAST, PURE = 0.6, 1.3, 12.0, 6.0, 3, 0.5
WINDOW = 12


class Model:
    """The ratio tables. ``learned`` are counts, for filler and notices, of what was recognised and of what stands beside it."""

    def __init__(self, counts: list[np.ndarray], learned: list[np.ndarray] | None = None, filler: str = FILLER, notices: str = NOTICES) -> None:
        natural, all_natural = counts[0], float(counts[0].sum())
        seeds = [("filler", _grams(filler)), ("filler", _grams(_shuffled(PASSAGE))), ("notice", _grams(notices))]
        if learned is not None:
            natural = np.maximum(natural - learned[0] - learned[1], 0)
            for kind, own, beside in (("filler", learned[0], learned[2]), ("notice", learned[1], learned[3])):
                both = own + beside
                seeds.append((kind, np.where((both >= LEAST) & (both >= PURE * counts[0]), both, 0)))
        self.tables = [(kind, _ratios(seed, natural, all_natural)) for kind, seed in seeds if seed.any()]
        self.best = np.maximum.reduce([t for _, t in self.tables])
        self.filler = np.maximum.reduce([t for kind, t in self.tables if kind == "filler"])
        seed = " ".join([*(f"a {x}{n}{y} a" for x, y in DELIMITERS for n in NAMES), *(f"a {b} a" for b in BLANKS)])
        shapes = np.bincount(shape_grams(_codes(seed))[1], minlength=SHAPES)
        self.shape = _ratios(shapes, counts[1], all_natural)

    def covered(self, grams: np.ndarray) -> tuple[float, str]:
        """The largest share of a sentence's n-grams covered by windows whose mean ratio is positive, and of which model."""
        best = (0.0, "")
        for kind, table in self.tables:
            r = table[grams]
            w = min(WINDOW, len(r))
            s = np.concatenate(([0], np.cumsum(r, dtype=np.float64)))
            hot = np.flatnonzero((s[w:] - s[:-w]) > 0.5 * w)
            edge = np.zeros(len(r) + 1, np.int64)
            np.add.at(edge, hot, 1)
            np.add.at(edge, hot + w, -1)
            best = max(best, (float((np.cumsum(edge[:-1]) > 0).mean()), kind))
        return best

    def sentences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, str]]]:
        """Grams of ``codes``, where its sentences begin and end, and (sentence, kind) of those that are residue."""
        grams = _hashed(plain(codes), 5, GRAMS)
        sums = np.concatenate(([0.0], np.cumsum(self.best[grams], dtype=np.float64)))
        line = codes == 10
        stop = (codes == 46) | (codes == 33) | (codes == 63)
        stop[:-1] &= line[1:] | (codes[1:] == 32)
        cuts = np.flatnonzero(stop | line) + 1
        begin, end = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(codes)]))
        end = end - ((end > 0) & line[np.maximum(end, 1) - 1])
        for _ in range(8):
            begin = begin + ((begin < end) & (codes[np.minimum(begin, len(codes) - 1)] == 32))
        n = np.maximum(0, np.minimum(end - 4, len(grams)) - begin)
        hot = np.flatnonzero((n > 0) & (sums[np.minimum(begin + n, len(sums) - 1)] - sums[np.minimum(begin, len(sums) - 1)] > MEAN * n))
        found = []
        for i in hot.tolist():
            own = grams[begin[i] : begin[i] + n[i]]
            if max(float(t[own].sum()) for _, t in self.tables) > max(MEAN * len(own), SUM):
                share, kind = self.covered(own)
                if share >= COVERED:
                    found.append((i, kind))
        return grams, begin, end, found

    def placeholders(self, line: str) -> list[tuple[int, int, str | None, str | None]]:
        """Places of the placeholders of the line, each with the words before and after it if it has both."""
        codes = _codes(line)
        at, bins = shape_grams(codes)
        ratio = np.zeros(len(codes) + 1, np.float64)
        ratio[at] = np.maximum(self.shape[bins], 0)
        sums = np.concatenate(([0.0], np.cumsum(ratio)))
        narrow = len(codes) == len(line)
        found = []
        for m in ENDS.finditer(line):
            a, b = m.span() if narrow else (len(_codes(line[: m.start()])), len(_codes(line[: m.end()])))
            if sums[b] - sums[max(0, a - 1)] >= MARK or m[0][0] == "(" and self._filler(m[0]):
                found.append(m.span())
        out = []
        gone = line
        for a, b in reversed(found):
            gone = gone[:a] + " " * (b - a) + gone[b:]
        for a, b in found:
            before = _words(gone[:a])[-2] if WORD.search(gone[:a]) else ""
            after = _words(gone[b:])[1] if WORD.search(gone[b:]) else ""
            out.append((a, b, before, after) if before or after else (a, b, None, None))
        return out

    def _filler(self, piece: str) -> bool:
        """Whether a remark in brackets reads like filler."""
        grams = _hashed(plain(_codes(piece)), 5, GRAMS)
        return len(grams) > 0 and max(float(t[grams].sum()) for kind, t in self.tables if kind == "filler") > max(MEAN * len(grams), SUM) and self.covered(grams)[0] >= COVERED

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, str | None, str | None]]:
        """(text, start, end, kind, before, after) of the residue in ``texts``; a piece with words before or after it counts
        only if these are neighbours elsewhere."""
        for codes, starts, places in chunks(texts):
            grams, begin, end, found = self.sentences(codes)
            owner = np.searchsorted(starts, begin, side="right") - 1
            for i, kind in found:
                k = owner[i]
                text, a, b = texts[places[k]], int(begin[i] - starts[k]), int(end[i] - starts[k])
                if starts[k + 1] - starts[k] - 1 != len(text):  # code units are not its characters
                    units = text.encode("utf-16-le", "surrogatepass")
                    a, b = (len(units[: 2 * x].decode("utf-16-le", "surrogatepass")) for x in (a, b))
                yield places[k], a, b, kind, None, None
            # Lines with a window of a placeholder's shape, or of filler in brackets.
            at, bins = shape_grams(codes)
            hot = at[self.shape[bins] > 1]
            bracket = np.flatnonzero(codes == 40)
            bracket = bracket[bracket < len(grams) - 4]
            if len(bracket):
                # The four n-grams behind the bracket; a shorter remark has its line's.
                ahead = self.filler[grams[np.minimum(bracket[:, None] + np.arange(1, 5), len(grams) - 1)]]
                hot = np.concatenate((hot, bracket[ahead.max(1) > 0]))
            ends = np.flatnonzero(codes == 10)
            for j in np.unique(np.searchsorted(ends, hot)).tolist():
                a, b = (int(ends[j - 1]) + 1 if j else 0), int(ends[j])
                k = int(np.searchsorted(starts, a, side="right")) - 1
                line = codes[a:b].tobytes().decode("utf-16-le", "surrogatepass")
                ahead = len(codes[starts[k] : a].tobytes().decode("utf-16-le", "surrogatepass"))
                for x, y, before, after in self.placeholders(line):
                    yield places[k], ahead + x, ahead + y, "template", before, after


def learned_counts(documents: DataFrame, text: str, model: Callable[[], Model]) -> list[np.ndarray]:
    """5-grams of the sentences that ``model`` recognises as filler and as notices, and of those beside either: the sentences
    before and after it in its text."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, total = model(), [np.zeros(GRAMS, np.int64) for _ in range(4)]
        for batch in batches:
            for codes, starts, _ in chunks(batch[text].tolist()):
                grams, begin, end, found = m.sentences(codes)
                full = np.flatnonzero(end > begin)
                place = {int(i): n for n, i in enumerate(full)}
                kinds = dict(found)
                owner = np.searchsorted(starts, begin, side="right")
                beside: dict[int, str] = {}
                for i, kind in found:
                    np.add.at(total[kind == "notice"], grams[begin[i] : max(begin[i], end[i] - 4)], 1)
                    for step in (-1, 1):
                        n = place[i] + step
                        if 0 <= n < len(full) and owner[full[n]] == owner[i] and int(full[n]) not in kinds:
                            beside.setdefault(int(full[n]), kind)
                for i, kind in beside.items():
                    np.add.at(total[2 + (kind == "notice")], grams[begin[i] : max(begin[i], end[i] - 4)], 1)
        yield _emitted(total)

    return _summed(documents.select(text).mapInPandas(learn, "chunk INT, data BINARY"), (GRAMS,) * 4)


def fitted(documents: DataFrame, text: str) -> Model:
    """The model of the collection: the general texts first, then what they recognise and its company."""
    counts = natural_counts(documents, text)
    sent = documents.sparkSession.sparkContext.broadcast(counts)
    return Model(counts, learned_counts(documents, text, lambda: Model(sent.value)))


def spans(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, kind (filler, notice, template), start, length, piece of every residue found in the documents.

    Null and empty texts have none. Offsets are 0-based characters; repeated rows are each searched; very long texts are
    searched whole. Sentences of fewer than five characters have no 5-gram and are no residue unless they are a placeholder.
    Of an empty table nothing is found.
    """
    spark = documents.sparkSession
    model = spark.sparkContext.broadcast(fitted(documents, text))
    schema = f"{doc_id} {documents.schema[doc_id].dataType.simpleString()}, kind STRING, start INT, length INT, piece STRING"

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts = batch[doc_id].tolist(), batch[text].tolist()
            rows = [(ids[i], k, a, b - a, texts[i][a:b], x, y) for i, a, b, k, x, y in model.value.search(texts)]
            yield pd.DataFrame(rows, columns=[doc_id, "kind", "start", "length", "piece", "_before", "_after"])

    pieces = cut(documents.select(doc_id, text).mapInPandas(search, schema + ", _before STRING, _after STRING"))
    asked = pieces.where("_before is not null").select("_before", "_after").distinct()
    met = neighbours(documents, text, asked).withColumn("_met", F.lit(True))
    judged = pieces.join(met, ["_before", "_after"], "left").where("_before is null or _met")
    return judged.select(doc_id, "kind", "start", "length", "piece")


def _pair_bins(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the pairs of neighbouring words and line marks, where first and second begin and end (a mark has no length), and
    both words' hashes in one. Words are as ``_words`` has them: numbers and codes alike."""
    word, line = _WORD[codes], codes == 10
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    low = plain(codes).astype(np.uint32)
    if len(begin):
        # A word's hash: its characters, weighted by their place in it.
        at = np.arange(len(codes), dtype=np.int64)
        inside = np.flatnonzero(word)
        place = at[inside] - np.repeat(begin, end - begin)
        weight = _WEIGHTS[np.minimum(place, len(_WEIGHTS) - 1)]
        offsets = np.concatenate(([0], np.cumsum(end - begin)[:-1]))
        values = np.add.reduceat((low[inside] + np.uint32(1)) * weight, offsets, dtype=np.uint32)
        digit = np.add.reduceat((low[inside] == 48).astype(np.int64), offsets) > 0
        values = np.where(digit, np.uint32(7), values | np.uint32(8))
    else:
        values = np.zeros(0, np.uint32)
    marks = np.flatnonzero(line)
    all_begin, all_end = np.concatenate((begin, marks)), np.concatenate((end, marks))
    all_values = np.concatenate((values, np.full(len(marks), 1, np.uint32)))
    order = np.argsort(all_begin, kind="stable")
    b, e, v = all_begin[order], all_end[order], all_values[order]
    h = v[:-1] * np.uint32(0x9E3779B1) + v[1:] * np.uint32(0x85EBCA77)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(33 - BINS.bit_length()), np.stack((b[:-1], b[1:])), np.stack((e[:-1], e[1:])), (v[:-1].astype(np.uint64) << np.uint64(32)) | v[1:]


_WEIGHTS = (np.random.default_rng(5).integers(1, 1 << 31, 64, dtype=np.int64) | 1).astype(np.uint32)


def neighbours(documents: DataFrame, text: str, asked: DataFrame) -> DataFrame:
    """The pairs of words of ``asked`` (_before, _after; '' is a line's end) that are neighbours anywhere in the collection.

    Tasks drop pairs whose bin, of 2^22, no asked pair has: the bins save work and decide nothing; the join does.
    """
    spark = documents.sparkSession

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: set[int] = set()
            for a, b in zip(batch["_before"], batch["_after"]):
                rows.update(_pair_bins(_codes(f"{a or chr(10)} {b or chr(10)}"))[0].tolist())
            yield pd.DataFrame({"bin": list(rows)})

    wanted = np.zeros(BINS, bool)
    wanted[[r["bin"] for r in asked.mapInPandas(bins, "bin INT").distinct().collect()]] = True
    sent = spark.sparkContext.broadcast(np.packbits(wanted))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unpackbits(sent.value).astype(bool)
        for batch in batches:
            out: set[tuple[str, str]] = set()
            for codes, _, _ in chunks(["\n" + t if t else t for t in batch[text]]):
                h, begin, end, both = _pair_bins(codes)
                hit = np.flatnonzero(known[h])
                for i in hit[np.unique(both[hit], return_index=True)[1]].tolist():
                    out.add(tuple(_word_at(codes, begin[k, i], end[k, i]) for k in (0, 1)))
            yield pd.DataFrame(list(out), columns=["_before", "_after"])

    found = documents.select(text).mapInPandas(pairs, "_before STRING, _after STRING").distinct()
    return asked.join(found, ["_before", "_after"], "left_semi")


def _word_at(codes: np.ndarray, begin: int, end: int) -> str:
    word = codes[begin:end].tobytes().decode("utf-16-le", "surrogatepass").lower()
    return "0" if DIGIT.search(word) else word


def found(documents: DataFrame) -> DataFrame:
    """Documents that hold residue anywhere."""
    return spans(documents, "doc_id", "text").select("doc_id").distinct()


def without_residue(documents: DataFrame, doc_id: str, text: str, most: float = 0.0) -> DataFrame:
    """``documents`` whose residue covers no more than the share ``most`` of their text; rows with a null id stay."""
    covered = spans(documents, doc_id, text).groupBy(doc_id).agg(F.sum("length").alias("_residue"))
    kept = documents.join(covered, doc_id, "left")
    return kept.where(F.coalesce("_residue", F.lit(0)) <= most * F.length(text)).drop("_residue")
