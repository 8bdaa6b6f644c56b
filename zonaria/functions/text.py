"""Text expressions: folding, roles, periods, numbers in norm texts."""
from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import half_even


def _folds() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition keeps ASCII: those that keep one character and that character, and
    those that keep several. All of Unicode, by rule."""
    source, target, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        form = unicodedata.normalize("NFKD", char)
        if form != char and (kept := form.encode("ascii", "ignore").decode()):
            if len(kept) == 1:
                source.append(char)
                target.append(kept)
            else:
                several[char] = kept
    return "".join(source), "".join(target), several


_FOLD_FROM, _FOLD_TO, _SEVERAL = _folds()
_SEVERAL_PAIRS = "\x02".join(f"{c}\x01{form}" for c, form in _SEVERAL.items())


def _ranges(codes: list[int]) -> str:
    """A character class of few ranges: a class of single characters is tried one by one."""
    out, first = [], codes[0]
    for code, following in zip(codes, [*codes[1:], None]):
        if following != code + 1:
            out.append(f"\\x{{{first:x}}}-\\x{{{code:x}}}")
            first = following
    return "[" + "".join(out) + "]"


_SEVERAL_CLASS = _ranges(sorted(map(ord, _SEVERAL)))
#: The same in two ranges, with room: letters with accents of western languages are not in it.
_SEVERAL_MAYBE = f"[\\xA0-\\x{{{max(c for c in map(ord, _SEVERAL) if c < 0x100):x}}}\\x{{100}}-\\x{{10FFFF}}]"


def fold(text: Column) -> Column:
    """ASCII form of a text: accents dropped, compatibility characters in their plain form, the rest removed.

    Plain ASCII passes as it is; only texts that hold a character standing for several are taken apart.
    """
    letters = F.str_to_map(F.lit(_SEVERAL_PAIRS), F.lit("\x02"), F.lit("\x01"))    # one literal, folded once
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(_SEVERAL_CLASS), F.lit(0)))
    spelt = F.aggregate(found, text, lambda t, c: F.replace(t, c, F.try_element_at(letters, c)))
    expanded = F.when(text.rlike(_SEVERAL_MAYBE) & text.rlike(_SEVERAL_CLASS), spelt).otherwise(text)
    ascii_only = F.regexp_replace(F.translate(expanded, _FOLD_FROM, _FOLD_TO), r"[^\x00-\x7F]", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), ascii_only).otherwise(text)


def norm_text(text: Column) -> Column:
    """Comparison key: ASCII, ``_`` and ``-`` as spaces, spaces squeezed, upper case; null gives ''."""
    spaced = F.regexp_replace(F.regexp_replace(fold(text.cast("string")), r"[_\-]+", " "), r"\s+", " ")
    return F.coalesce(F.upper(F.trim(spaced)), F.lit(""))


def has_key(text: Column) -> Column:
    """Is the comparison key not empty? A plain letter, figure or sign answers without folding the text."""
    return F.when(text.rlike(r"[!-,./0-9:-@A-Z\[-^`a-z{-~]"), True).otherwise(F.length(norm_text(text)) > 0)


def clean(text: Column) -> Column:
    """Trimmed text; blank becomes null."""
    return F.nullif(F.regexp_replace(text.cast("string"), r"^\s+|\s+$", ""), F.lit(""))


def service_slug(text: Column) -> Column:
    """File-name form of a service or layer name: ASCII letters and digits kept, the rest to ``_``."""
    return F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", "")


def region_slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(norm_text(text)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def region_matches(region: Column, pattern: str) -> Column:
    """Does the normalised region match a pattern given in any case, accented or not?"""
    return F.regexp(norm_text(region), F.concat(F.lit("(?i)"), norm_text(F.lit(pattern))))


# Prefixes dropped from a layer name to obtain the instrument name.
INSTRUMENT_PREFIX = r"(?iu)^(prc|prms|prm|pri|seccional|ps|lu|plan[_ ]regulador|limite[_ ]urbano)[_ ]*"


def instrument_name(layer: Column) -> Column:
    bare = F.trim(F.replace(F.regexp_replace(layer, INSTRUMENT_PREFIX, ""), F.lit("_"), F.lit(" ")))
    return F.coalesce(F.nullif(bare, F.lit("")), layer)


# Words that say nothing about which instrument a name refers to.
STOP_WORDS = """
PLAN PLANO PLANOS REGULADOR REGULADORES COMUNAL COMUNALES INTERCOMUNAL METROPOLITANO SECCIONAL
SECCIONALES APRUEBA APRUEBAN MODIFICACION MODIFICA ENMIENDA ENMIENDAS DE DEL LA LAS LOS EL Y EN A AL POR PARA CON
LIMITE LIMITES URBANO URBANA URBANOS ORDENANZA LOCAL PRC PRI PRM PS LU ZONA ZONAS SECTOR COMUNA VIA QUE INDICA N
NUEVO NUEVA ACTUALIZACION REGION TERRITORIO AREA AREAS
""".split()


def significant_tokens(text: Column) -> Column:
    """Distinct tokens of a name, stop words and one-letter tokens left out."""
    tokens = F.split(F.translate(norm_text(text), ".,", "  "), r"\s+")
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.filter(F.array_except(tokens, stop), lambda t: F.length(t) > 1)


def id_list(text: Column) -> Column:
    """'3, 4' → [3, 4]; parts that are not numbers are skipped."""
    parts = F.split(F.replace(F.coalesce(text, F.lit("")), F.lit(" "), F.lit("")), ",")
    return F.transform(F.filter(parts, lambda p: p.rlike(r"^\d+$")), lambda p: p.cast("bigint"))


# Wording of a decree in a document name, and document types that hold an ordinance.
DECREE = r"(?iuU)(Decreto|Resoluci[oó]n|D\.?\s*S\.?)\s*(?:Exento\s*)?N[°º]?\s*([\w\-/]+)"
ORDINANCE_TYPES = ("Ordenanza", "Publicación D. O. con Ordenanza")


def decree_text(documents: Column, number: Column) -> Column:
    """'Decreto N° 540' from the first document that names one; else 'N° <number>'; else ''."""
    def render(name: Column) -> Column:
        kind = F.regexp_extract(name, DECREE, 1)
        kind = F.concat(F.upper(F.substr(kind, F.lit(1), F.lit(1))), F.lower(F.substr(kind, F.lit(2))))
        kind = F.replace(kind, F.lit("Resolucion"), F.lit("Resolución"))
        kind = F.when(F.upper(kind).startswith("D."), F.lit("D.S.")).otherwise(kind)
        return F.concat(kind, F.lit(" N° "), F.regexp_extract(name, DECREE, 2))

    named = F.filter(F.transform(documents, lambda d: d["nombre"]), lambda n: n.rlike(DECREE))
    fallback = F.concat(F.lit("N° "), F.nullif(number.cast("string"), F.lit("")))
    return F.coalesce(render(F.get(named, F.lit(0))), fallback, F.lit(""))


def ordinance_url(documents: Column) -> Column:
    def linked(kind: str) -> Column:
        return F.filter(documents, lambda d: (d["tipo"] == kind) & (F.length(d["url"]) > 0))

    by_type = [linked(kind) for kind in ORDINANCE_TYPES]
    return F.get(F.concat(*by_type), F.lit(0))["url"]


def role_key(text: Column) -> Column:
    """'1733 / 22' → '01733-00022'; null when the text is no role."""
    pattern = r"^\s*0*(\d{1,5})\s*[-/ ]\s*0*(\d{1,5})\s*$"
    first = F.lpad(F.regexp_extract(text, pattern, 1).cast("bigint").cast("string"), 5, "0")
    second = F.lpad(F.regexp_extract(text, pattern, 2).cast("bigint").cast("string"), 5, "0")
    return F.when(text.rlike(pattern), F.concat_ws("-", first, second))


def semester(text: Column) -> Column:
    """'SEGUNDO SEMESTRE DE 2025' → '2025-2'; null for any other text."""
    pattern = r"(?i)^\s*(PRIMER|SEGUNDO)\s+SEMESTRE\s+DE\s+(20\d{2})\s*$"
    half = F.when(F.upper(F.regexp_extract(text, pattern, 1)) == "PRIMER", "1").otherwise("2")
    return F.when(text.rlike(pattern), F.concat_ws("-", F.regexp_extract(text, pattern, 2), half))


# First letters of a match method and the method they stand for; the last match counts.
METHODS = (
    ("1_contains", "contiene"), ("2_nearest", "cercano"), ("4_manzana", "manzana"),
    ("6_manzana_any", "manzana_cualquiera"), ("orphan_polygon", "huerfano"), ("point_in_polygon", "contiene"),
    ("nearest", "cercano"), ("unmatched_polygon", "huerfano"), ("address_inheritance", "herencia_direccion"),
    ("ah_utm", "utm"), ("csa_utm", "utm"),
)


def match_method(text: Column) -> Column:
    hits = [F.when(text.startswith(prefix), F.lit(name)) for prefix, name in reversed(METHODS)]
    return F.coalesce(*hits, F.lit("desconocido"))


def coordinate(text: Column, low: float, high: float) -> Column:
    value = text.try_cast("double")
    return F.when(value.between(low, high), half_even(value, 6))


def address(text: Column) -> Column:
    """Null for a blank, a bare number, an error message or an overlong text."""
    t = F.trim(text)
    bad = (t == "") | t.rlike(r"^[\d.,\- ]+$") | t.rlike("(?i)Error|Exception|Retry") | (F.length(t) > 90)
    return F.when(~bad, t)


# Land use and location codes of the tax register.
USES = {
    "A": "AGRICOLA", "B": "AGRICOLA POR ASIMILACION", "C": "COMERCIO", "D": "DEPORTE Y RECREACION",
    "E": "EDUCACION Y CULTURA", "F": "FORESTAL", "G": "HOTEL, MOTEL", "H": "HABITACIONAL", "I": "INDUSTRIA",
    "L": "BODEGA Y ALMACENAJE", "O": "OFICINA", "P": "ADM. PUBLICA Y DEFENSA", "Q": "CULTO", "S": "SALUD",
    "T": "TRANSPORTE Y TELEC.", "V": "OTROS NO CONSIDERADOS", "W": "SITIO ERIAZO", "Z": "ESTACIONAMIENTO",
}
LOCATIONS = {"U": "URBANA", "R": "RURAL", "E": "EXTENSION URBANA"}


def code_label(code: Column, table: dict[str, str]) -> Column:
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), code)


def numbers_in(text: Column) -> Column:
    """All numbers of a norm text, decimal comma or point."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\d+(?:[.,]\d+)?)"))
    return F.transform(found, lambda s: F.replace(s, F.lit(","), F.lit(".")).cast("double"))


def first_number(text: Column) -> Column:
    return F.get(numbers_in(text), F.lit(0))


# Wording that marks a zone as residential.
RESIDENTIAL = r"(?iu)RESIDENC|HABITAC|VIVIEND|\bH\s?\d|\bZH|\bZR\d"


def residential(zone: Column, description: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(zone, F.lit("None")), F.coalesce(description, F.lit(""))).rlike(RESIDENTIAL)
