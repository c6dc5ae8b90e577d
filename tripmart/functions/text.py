"""String column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# The HTML character references decoded in cell text, with
# ``&amp;`` last so that ``&amp;lt;`` becomes ``&lt;`` and not ``<``.
HTML_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&"),
)

# Whitespace removed by a Python-style strip (includes no-break space).
_WS = "[\\s\\u00a0]"


def strip(c) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` removes spaces only)."""
    return F.regexp_replace(as_col(c), f"^{_WS}+|{_WS}+$", "")


def last_path_segment(c) -> Column:
    """the part after the last ``/``, stripped."""
    return strip(F.substring_index(as_col(c), "/", -1))


def extension(c) -> Column:
    """the part after the last ``.`` (the whole text if there is none)."""
    return F.substring_index(as_col(c), ".", -1)


def object_key(prefix: str, file_type: str, day) -> Column:
    """``{prefix}{file_type}_{yy-MM-dd}.csv`` for a day file."""
    return F.concat(F.lit(prefix), F.lit(file_type), F.lit("_"),
                    F.date_format(as_col(day), "yy-MM-dd"), F.lit(".csv"))


def thousands(c) -> Column:
    """integer with ``,`` thousands separators (``12000`` -> ``12,000``)."""
    return F.format_number(as_col(c), 0)


def json_path(c, path: str) -> Column:
    """scalar at a JSON path inside a JSON text column, as text."""
    return F.get_json_object(as_col(c), path)


_NUMERIC_REF = "&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def _utf16_hex(cp: Column) -> Column:
    """Code point -> its UTF-16BE code units as hex (a surrogate pair above U+FFFF)."""
    v = cp - F.lit(0x10000)
    hi = F.lit(0xD800) + F.shiftright(v, 10)
    lo = F.lit(0xDC00) + v.bitwiseAND(F.lit(0x3FF))
    return F.when(cp < 0x10000, F.lpad(F.hex(cp), 4, "0")).otherwise(
        F.concat(F.lpad(F.hex(hi), 4, "0"), F.lpad(F.hex(lo), 4, "0")))


def _numeric_ref_text(ref: Column) -> Column:
    body = F.regexp_extract(ref, _NUMERIC_REF, 1)
    is_hex = F.lower(F.substring(body, 1, 1)) == "x"
    cp = F.when(is_hex, F.conv(F.substring(body, 2, 6), 16, 10)).otherwise(body).cast("long")
    valid = (cp > 0) & (cp <= 0x10FFFF) & ~((cp >= 0xD800) & (cp <= 0xDFFF))
    return F.when(valid, F.decode(F.unhex(_utf16_hex(cp)), "UTF-16BE")).otherwise(ref)


def html_unescape(c) -> Column:
    """decode numeric character references (``&#233;``, ``&#xE9;``) and
    the common named ones.

    Numeric references are found with ``regexp_extract_all`` and replaced
    one by one with ``aggregate`` (a higher-order function, JVM-side); each
    code point becomes text through its UTF-16 code units.  Named
    references follow, ``&amp;`` last.
    """
    out = as_col(c)
    refs = F.array_distinct(F.regexp_extract_all(out, F.lit(_NUMERIC_REF), 0))
    out = F.aggregate(refs, out, lambda acc, r: F.replace(acc, r, _numeric_ref_text(r)))
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def html_text(c) -> Column:
    """visible text of an HTML fragment: tags removed, references decoded, stripped."""
    return strip(html_unescape(F.regexp_replace(as_col(c), "<[^>]*>", "")))


def to_int(c) -> Column:
    """strict integer parse (ANSI: raises on text that is not an integer)."""
    return strip(as_col(c)).cast("int")
