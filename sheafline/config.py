"""Thresholds and word lists, one frozen object that every operator takes as a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field

# Single words or pairs with which a short line is a section title whatever its score.
SECTION_STARTS = (
    "introduction", "overview", "summary", "abstract", "conclusion", "conclusions", "appendix", "glossary", "references",
    "bibliography", "index", "instructions", "installation", "operation", "usage", "setup", "configuration", "getting started",
    "quick start", "warning", "warnings", "caution", "cautions", "safety", "danger", "notice", "important", "note", "notes",
    "maintenance", "cleaning", "troubleshooting", "support", "warranty", "disposal", "storage", "specifications", "description",
    "features", "contents", "components", "parts", "accessories", "requirements", "compatibility", "compliance", "certifications",
    "regulatory", "legal", "disclaimer", "copyright", "license",
)

# Titles of a table of contents.
CONTENTS_TITLES = (
    "contents", "table of contents", "index", "contenido", "contenidos", "indice", "índice", "tabla de contenido",
    "tabla de contenidos", "indice general", "índice general",
)

# Names of languages as they stand in headings.
LANGUAGE_NAMES = (
    "english", "français", "french", "deutsch", "german", "español", "spanish", "italiano", "italian", "português", "portugese",
    "portuguese", "nederlands", "dutch", "svenska", "swedish", "dansk", "danish", "polski", "polish", "magyar", "hungarian",
    "čeština", "czech", "русский", "russian", "українська", "ukrainian", "arabic", "hebrew", "suomi", "finnish", "norsk",
    "norwegian", "eesti", "estonian", "中文", "traditional chinese", "simplified chinese",
)

# Section titles that are no product name.
GENERIC_TITLES = (
    "introduction", "contents", "index", "instructions", "maintenance", "warranty", "certification", "warnings", "description",
    "specifications", "opening", "closing", "introduccion", "contenido", "indice", "indicaciones", "instrucciones", "garantia",
    "precauciones", "advertencias",
)

# Titles and normalized titles that only mark structure.
STRUCTURAL_TITLES = ("UNTITLED", "OPENING", "CLOSING")
STRUCTURAL_NORMS = ("untitled", "opening", "closing", "other")

# Target fields in their order, each with the terms that name it.
FIELD_ALIASES = {
    "product_name": ("product name", "commercial name", "denomination", "product", "item name", "nombre del producto", "nombre comercial", "denominacion"),
    "code": ("code", "product code", "reference", "ref", "sku", "model", "item", "cod", "codigo", "referencia", "modelo"),
    "origin": ("country of origin", "origin", "made in", "manufactured in", "origen", "pais de origen", "fabricado en"),
    "description": ("description", "product description", "general description", "overview", "introduction", "descripcion", "descripcion del producto", "introduccion"),
    "maintenance": ("maintenance", "care", "cleaning", "storage", "conservation", "mantenimiento", "limpieza", "almacenamiento", "cuidado"),
    "validity": ("validity", "shelf life", "expiry", "expiration", "vigencia", "vida util", "caducidad"),
    "warranty": ("warranty", "guarantee", "garantia", "garantia del fabricante"),
    "certifications": ("certification", "certifications", "registration", "regulatory", "compliance", "certificate", "certificacion", "registro sanitario", "normativa", "iso", "ce", "fda"),
}

# Labels of "label: value" pairs in text, in the order they are tried.
VALUE_LABELS = {
    "product_name": ("product name", "commercial name", "denomination", "product", "nombre del producto", "nombre comercial", "denominacion"),
    "code": ("code", "product code", "reference", "ref", "sku", "model", "codigo", "referencia", "modelo"),
    "maintenance": ("maintenance", "cleaning", "storage", "conservation", "care", "mantenimiento", "limpieza", "almacenamiento", "cuidado"),
    "validity": ("validity", "shelf life", "expiry", "vigencia", "vida util", "caducidad"),
    "warranty": ("warranty", "guarantee", "garantia"),
    "certifications": ("registration", "certification", "certificate", "registro sanitario", "certificacion"),
    "description": ("description", "product description", "descripcion", "descripcion del producto"),
}

# Patterns, all valid for Java and RE2.
INDEX_LINE = r"\.{3,}\s*[0-9]{1,4}\s*$"
DOT_LEADER = r"^(.+?)\s*\.{2,}\s*([0-9]{1,4})\s*$"
NUMBERED = r"^[0-9]+(\.[0-9]+)*\s+\S"
HEADER_SHAPES = (r"^[0-9]+(\.[0-9]+)*\s*[A-ZÁÉÍÓÚÑÜ]", r"^[A-ZÁÉÍÓÚÑÜ0-9\s:/\-&®().,]+$")
PRODUCT_CODE = r"\b([A-Z]{1,6}-[A-Z0-9]{2,}(-[A-Z0-9]+)*|[A-Z]{2,8}[0-9]{2,})\b"
FILENAME_NOISE = r"(?i)^(instructions?|manual|guide|datasheet|specification|protocol)\s+(for\s+)?"
ORIGIN_PATTERNS = (
    r"(?i)(country of origin|origin)\s*[:\-]\s*([^.;,]+)",
    r"(?i)(made in|manufactured in)\s+([^.;,]+)",
    r"(?i)(pais de origen|origen)\s*[:\-]\s*([^.;,]+)",
    r"(?i)(fabricado en|hecho en)\s+([^.;,]+)",
)


@dataclass(frozen=True)
class Config:
    """Every threshold of the analysis, in points where it is a distance."""

    row_gap: float = 10  # lines nearer than this below each other are one visual row
    row_anchor: float = 3  # distance from a row's first line in contents pages
    table_rows: int = 4  # rows in a run that make a table
    cell_words: int = 8
    cell_shift: float = 18  # a continuation cell lies this near above a cell
    column_gap: float = 0.08
    column_share: float = 0.10
    max_columns: int = 3
    prose_lines: int = 6
    index_share: float = 0.35
    section_score: int = 6
    subheader_score: int = 5
    sparse_lines: int = 20
    sparse_page_density: float = 0.002
    image_only_chars: int = 100
    min_image: tuple[int, int, int] = (120, 60, 50_000)
    paragraph_gap: float = 1.5
    top_variants: int = 6
    max_codes: int = 3
    max_matrix_columns: int = 12
    column_ratio: float = 0.15
    fallback_column: str = "additional_content"
    aliases: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(FIELD_ALIASES))
    value_labels: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(VALUE_LABELS))


DEFAULT = Config()
