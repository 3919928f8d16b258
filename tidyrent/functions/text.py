"""Text → typed column expressions (all JVM-side, whole-stage-codegen friendly).

Every function here takes and returns ``Column`` objects; none of them touches
Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal the listing source's wording for equal results ---
# publication-date phrases mapped to "hace N días"
DATE_PHRASES = {
    "Publicado desde ayer": "hace 1 día",
    "Publicado hace más de 1 año": "hace 365 días",
    "Publicado hoy": "hace 0 días",
}
MINUTES_WORD = "minutos"
MINUTES_VALUE = "hace 0 días"
NEW_BUILD_TEXT = "A estrenar"
NEW_BUILD_VALUE = "0 años"
# a raw field is kept only when its lower-cased text matches (regex)
KEEP_IF = {
    "antiguedad": "año",
    "dormitorios": "dorm.",
    "banos": "baño",
    "area_total": "m²",
}
# integer patterns, applied to the lower-cased text; capture groups are concatenated
INT_PATTERNS = {
    "dormitorios": r"(\d+) dorm.",
    "banos": r"(\d+) baño",
    "banios/2": r"(\d+) medios? baños?",
    "antiguedad": r"(\d+) años|año de construcción\n(\d+)",
    "area_total": r"(\d+) m²",
    "area_cubierta": r"(\d+) m²",
    "estacionamiento": r"(\d+) estac.",
    "precio_soles": r"s/\s*(\d+)|us\$(\d+)",
    "precio_dolares": r"usd\s*(\d+)",
    "fecha_publicacion": r"(\d+) días?",
}
# --- end of fixed values ---


def col_(name: str) -> Column:
    """Column reference that tolerates special characters (``banios/2``)."""
    return F.col(f"`{name}`")


def map_phrases(c: Column, mapping: dict[str, str]) -> Column:
    """Exact whole-value replacement (F1); unmapped values pass through."""
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(c == F.lit(src), F.lit(dst)) if expr is None
                else expr.when(c == F.lit(src), F.lit(dst)))
    return c if expr is None else expr.otherwise(c)


def replace_if_contains(c: Column, needle: str, value: str) -> Column:
    """any value containing ``needle`` becomes ``value``; null stays null."""
    return F.when(c.contains(needle), F.lit(value)).otherwise(c)


def replace_exact(c: Column, src: str, dst: str) -> Column:
    """F3."""
    return F.when(c == F.lit(src), F.lit(dst)).otherwise(c)


def currency_tag(c: Column) -> Column:
    """first three characters of the raw price; null/empty → null."""
    return F.substring(F.nullif(c, F.lit("")), 1, 3)


def strip_separators(c: Column) -> Column:
    """remove thousands separators ',' and '.' (literal characters)."""
    return F.translate(c, ",.", "")


def empty_to_null(c: Column) -> Column:
    """F6."""
    return F.nullif(c, F.lit(""))


def decimal_comma(c: Column) -> Column:
    """decimal comma → dot."""
    return F.translate(c, ",", ".")


def keep_if_matches(c: Column, pattern: str) -> Column:
    """F8: keep the value only when its lower-cased text matches ``pattern``."""
    return F.when(F.lower(c).rlike(pattern), c)


def parse_int(c: Column, pattern: str, groups: int | None = None) -> Column:
    """first match of ``pattern`` on the lower-cased text, capture groups
    concatenated, cast to BIGINT; no match / not an integer → null."""
    n = groups if groups is not None else max(1, pattern.count("(") - pattern.count(r"\("))
    low = F.lower(c)
    parts = [F.regexp_extract(low, pattern, i) for i in range(1, n + 1)]
    text = parts[0] if n == 1 else F.concat(*parts)
    return F.nullif(text, F.lit("")).try_cast("bigint")


def parse_coordinate_pair(lat: Column, lon: Column) -> tuple[Column, Column]:
    """F9 + F11: either side null → both null; else text → double.

    Unparseable text becomes null, as does NaN (it orders above every number in
    Spark and would break every later range predicate); the other side goes with
    it, as half a pair is no place.
    """
    a, b = lat.try_cast("double"), lon.try_cast("double")
    both = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    return F.when(both, a), F.when(both, b)


def combo_key(a: Column, b: Column) -> Column:
    """``"{a},{b}"`` from doubles, so 3 and 1 give ``"3.0,1.0"``; a missing
    value prints as ``nan`` (as the float formatting of the source does)."""
    def fmt(c: Column) -> Column:
        return F.coalesce(c.cast("double").cast("string"), F.lit("nan"))
    return F.concat(fmt(a), F.lit(","), fmt(b))


def decimal_point_repair(c: Column, position: int) -> Column:
    """drop every '.', re-insert one after ``position`` characters, → double."""
    digits = F.regexp_replace(c.cast("string"), r"\.", "")
    return F.concat(F.substring(digits, 1, position), F.lit("."),
                    F.substring(digits, position + 1, 1 << 30)).try_cast("double")


# --- fixed values: patterns of the reply contract ---
REPLY_BODY = r"(?s)(\{.*?\}|\[.*?\])"
# --- end of fixed values ---
# a reply from its first opening bracket to its last closing one
REPLY_SPAN = r"(?s)([\{\[].*[\}\]])"
# parts of a literal: text in single quotes (an apostrophe that no delimiter follows
# belongs to the text), text in double quotes, everything between
LITERAL_PARTS = (r"""(?s)('[^'\\]*+(?:(?:\\.|'(?!\s*(?:[,:}\])]|$)))[^'\\]*+)*+'"""
                 r"""|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++|['"])""")
UNESCAPED_QUOTE = r'(?<=(?:^|[^\\])(?:\\\\){0,20})"'


def literal_to_json(c: Column) -> Column:
    """JSON text of a Python literal: quoted texts (single or double quotes, escaped
    quotes, apostrophes within a text) become JSON strings; outside of them ``None``,
    ``True`` and ``False`` get their JSON names, tuples become arrays and a comma
    before a closing bracket goes. Text that is no literal stays no JSON."""
    def part(t: Column) -> Column:
        single = F.regexp_replace(F.substring(t, F.lit(2), F.length(t) - 2), r"\\'", "'")
        plain = F.translate(t, "()", "[]")
        for pattern, to in ((r"\bNone\b", "null"), (r"\bTrue\b", "true"), (r"\bFalse\b", "false"),
                            (r",(\s*[\]}])", "$1")):
            plain = F.regexp_replace(plain, pattern, to)
        return (F.when(t.startswith("'") & (F.length(t) > 1),
                       F.concat(F.lit('"'), F.regexp_replace(single, UNESCAPED_QUOTE, r'\\"'), F.lit('"')))
                .when(t.startswith('"'), F.regexp_replace(t, r"\\'", "'"))
                .otherwise(plain))
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(LITERAL_PARTS), F.lit(1)), part), "")


def _record_list(body: Column) -> Column:
    return F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)


def repair_reply(c: Column, schema: str) -> Column:
    """pull the first ``{...}`` or ``[...]`` (non-greedy) out of a free-text
    reply, turn Python ``None`` and single quotes into JSON, parse as an array of
    records. A bare object becomes a one-element array.

    Where that is no JSON, a second parse reads the reply from its first opening to
    its last closing bracket as a Python literal (``literal_to_json``): apostrophes
    in texts, ``True``, nested brackets, trailing commas. Junk gives null."""
    text = F.trim(c)
    body = F.regexp_extract(text, REPLY_BODY, 1)
    body = F.when(body == "", text).otherwise(body)
    body = F.regexp_replace(F.regexp_replace(body, "None", "null"), "'", '"')
    span = literal_to_json(F.regexp_extract(text, REPLY_SPAN, 1))
    return F.coalesce(
        F.from_json(_record_list(body), f"array<{schema}>"),
        F.from_json(_record_list(span), f"array<{schema}>", {"allowUnescapedControlChars": "true"}))


def records_to_json(*cols: Column) -> Column:
    """F24 (aggregate): one JSON array text of the given record columns, in the order
    of their values."""
    return F.to_json(F.array_sort(F.collect_list(F.struct(*cols))))
