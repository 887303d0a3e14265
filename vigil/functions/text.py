"""Scalar string functions (Column -> Column), all native Spark expressions."""

from __future__ import annotations

import html.entities
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip()/split() treat as whitespace, by rule.
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
_WS_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Remove leading/trailing whitespace the way Python's ``strip()`` does
    (``trim`` only removes spaces); ``btrim`` only looks at the two ends."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


# Transliterations that Unicode decomposition does not give.
MULTI_CHAR_ASCII = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th",
    "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l",
    "Ħ": "H", "ħ": "h", "ı": "i", "Ŧ": "T", "ŧ": "t", "Ŋ": "N", "ŋ": "n",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "‘": "'", "’": "'", "‚": ",",
    "“": '"', "”": '"', "„": ",,", "…": "...", "«": "<<", "»": ">>", "\u202f": " ", "\u2009": " ",
    "€": "EUR", "£": "GBP", "¥": "JPY", "¢": "c", "¤": "$", "©": "(c)", "®": "(r)", "™": "(tm)", "№": "No", "°": "deg", "§": "SS", "¶": "P",
    "•": "*", "·": "*", "†": "+", "‡": "++", "‰": "0/00", "±": "+-", "×": "x", "÷": "/", "¬": "!", "¦": "|", "¡": "!", "¿": "?", "µ": "u",
    "←": "<-", "→": "->", "⇒": "=>", "−": "-", "≤": "<=", "≥": ">=", "≠": "!=", "≈": "~", "∞": "inf", "√": "sqrt", "‹": "<", "›": ">", "⁄": "/", "´": "'", "¨": '"', "¸": ",", "¯": "-",
}
# Letters of Greek and Cyrillic by their Unicode names.
LETTER_ASCII = {
    "ALPHA": "a", "BETA": "b", "GAMMA": "g", "DELTA": "d", "EPSILON": "e", "ZETA": "z", "ETA": "e", "THETA": "th", "IOTA": "i", "KAPPA": "k",
    "LAMDA": "l", "MU": "m", "NU": "n", "XI": "x", "OMICRON": "o", "PI": "p", "RHO": "r", "SIGMA": "s", "FINAL SIGMA": "s", "TAU": "t", "UPSILON": "u",
    "PHI": "ph", "CHI": "kh", "PSI": "ps", "OMEGA": "o",
    "A": "a", "BE": "b", "VE": "v", "GHE": "g", "DE": "d", "IE": "e", "IO": "io", "ZHE": "zh", "ZE": "z", "I": "i", "SHORT I": "i", "KA": "k", "EL": "l",
    "EM": "m", "EN": "n", "O": "o", "PE": "p", "ER": "r", "ES": "s", "TE": "t", "U": "u", "EF": "f", "HA": "kh", "TSE": "ts", "CHE": "ch", "SHA": "sh",
    "SHCHA": "shch", "HARD SIGN": '"', "YERU": "y", "SOFT SIGN": "'", "E": "e", "YU": "iu", "YA": "ia", "DJE": "dj", "GJE": "gj", "UKRAINIAN IE": "ie",
    "DZE": "dz", "BYELORUSSIAN-UKRAINIAN I": "i", "YI": "yi", "JE": "j", "LJE": "lj", "NJE": "nj", "TSHE": "tsh", "KJE": "kj", "SHORT U": "u", "DZHE": "dzh",
    "GHE WITH UPTURN": "g",
}
#: Blocks whose characters are transliterated as far as a rule gives them: Latin, Greek, Cyrillic, punctuation, sub- and
#: superscripts, currency, letter-like signs, number forms, arrows and operators, enclosed and full-width forms.
_BLOCKS = ((0xA0, 0x250), (0x370, 0x530), (0x1D00, 0x1DC0), (0x1E00, 0x2000), (0x2000, 0x20D0), (0x2100, 0x2300), (0x2460, 0x2500), (0x3000, 0x3001), (0xFB00, 0xFB07), (0xFF01, 0xFF5F))


def _ascii_of(ch: str) -> str | None:
    """ASCII text of a character by rule: a fixed value; else its compatibility decomposition without
    combining marks, letter by letter; a letter's value in the letter's case. None if there is none."""
    def one(c: str) -> str | None:
        name = unicodedata.name(c, "").split(" ")
        letter = LETTER_ASCII.get(" ".join(name[3:])) if name[0] in ("GREEK", "CYRILLIC") and name[2:3] == ["LETTER"] else None
        return MULTI_CHAR_ASCII.get(c) or (letter and (letter.capitalize() if name[1] == "CAPITAL" else letter)) or (c if ord(c) < 128 else None)

    whole = one(ch)
    if whole is not None:
        return whole
    out = [one(c) for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)]
    if None in out:
        return None
    text = "".join(out)
    return " " if text.isspace() else text.strip() if text else None


def ascii_table() -> dict[str, str]:
    """Every character that ``fold_to_ascii`` changes, with its ASCII text; combining marks that
    stand alone (U+0300..U+036F) become nothing."""
    table = {ch: v for lo, hi in _BLOCKS for ch in map(chr, range(lo, hi)) if (v := _ascii_of(ch)) is not None}
    return {**table, **MULTI_CHAR_ASCII, **dict.fromkeys(map(chr, range(0x300, 0x370)), "")}


# one translate pass for everything that becomes one character or none (those come last); the rest is looked up
_ASCII = ascii_table()
_ONE = sorted((k for k, v in _ASCII.items() if len(v) < 2), key=lambda k: -len(_ASCII[k]))
_TR_SRC, _TR_DST = "".join(_ONE), "".join(_ASCII[k] for k in _ONE)
_LONGER = {k: v for k, v in _ASCII.items() if len(v) > 1}
# any character that is left over; a class of the longer ones alone is tried one by one for every character
_LEFT_RE = r"[^\x00-\x7F]"


def fold_to_ascii(col) -> Column:
    """Transliterate Latin, Greek and Cyrillic letters, common punctuation, symbols and
    fractions to ASCII; characters of other scripts pass through unchanged. Characters
    that become one go in one pass; a text with others is split around them, each is
    looked up by itself, and the pieces are joined again, all JVM-side."""
    c = F.translate(_c(col), _TR_SRC, _TR_DST)
    table = F.create_map(*[F.lit(x) for kv in _LONGER.items() for x in kv])
    pieces, found = F.split(c, _LEFT_RE, -1), F.regexp_extract_all(c, F.lit(_LEFT_RE), 0)
    body = F.array_join(F.zip_with(F.slice(pieces, 1, F.size(found)), F.transform(found, lambda x: F.coalesce(F.try_element_at(table, x), x)), lambda p, x: F.concat(p, x)), "")
    return F.when(c.rlike(_LEFT_RE), F.concat(body, F.element_at(pieces, -1))).otherwise(c)


def clean_string(col) -> Column:
    """Directory-name slug: transliterate, strip, drop ``/``, two spaces to
    ``_``, then one space to ``_``, lower-case (that order: three spaces
    become ``__``)."""
    c = strip(fold_to_ascii(col))
    c = F.replace(c, F.lit("/"), F.lit(""))
    c = F.replace(c, F.lit("  "), F.lit("_"))
    c = F.replace(c, F.lit(" "), F.lit("_"))
    return F.lower(c)


def dequote(col) -> Column:
    """Strip; if the first and last characters are the same quote (' or ")
    and there are at least two characters, drop the pair and strip again."""
    s = strip(col)
    first = F.substring(s, 1, 1)
    quoted = ((F.length(s) >= 2) & (first == F.substring(s, -1, 1))
              & first.isin("'", '"'))
    return F.when(quoted, strip(F.substring(s, F.lit(2), F.length(s) - 2))).otherwise(s)


def title_clean(col) -> Column:
    """Strip, then the two-character sequence backslash-n and real newlines
    become spaces."""
    c = strip(col)
    c = F.replace(c, F.lit("\\n"), F.lit(" "))
    return F.replace(c, F.lit("\n"), F.lit(" "))


def dar_category(col) -> Column:
    """Publication series ``DAR II série A`` -> ``II-A``."""
    return F.regexp_replace(F.regexp_replace(_c(col), "DAR ", ""), " série ", "-")


def first_token(col) -> Column:
    """First whitespace-separated token (``s.split()[0]``); NULL when blank."""
    s = strip(col)
    return F.when(F.length(s) > 0, F.split(s, _WS_CLASS + "+").getItem(0))


def format_id(*cols, sep: str = "/", null_text: str | None = "None") -> Column:
    """Join parts with ``sep``. With ``null_text`` a NULL part is written as
    that text (what string formatting of a missing value produced); with
    ``null_text=None`` the whole id is NULL when any part is NULL."""
    parts = [_c(c).cast("string") for c in cols]
    if null_text is None:
        return F.concat(*sum(([p, F.lit(sep)] for p in parts), [])[:-1])
    return F.concat_ws(sep, *[F.coalesce(p, F.lit(null_text)) for p in parts])


def extract_between(col, start: str, end: str) -> Column:
    """Text between the first ``start`` and the next ``end``; NULL when a
    marker is missing."""
    import re
    v = F.regexp_extract(_c(col), re.escape(start) + "(.*?)" + re.escape(end), 1)
    return F.when(_c(col).contains(start) & _c(col).contains(end), v)


def normalize_file_name(col) -> Column:
    """``X_json.txt``/``X.json.txt`` -> ``X.json``, ``%c3%ba`` -> ``u``, lower."""
    c = F.replace(_c(col), F.lit("_json.txt"), F.lit(".json"))
    c = F.replace(c, F.lit(".json.txt"), F.lit(".json"))
    c = F.replace(c, F.lit("%c3%ba"), F.lit("u"))
    return F.lower(c)


# attributes of a tag: quotes count after "=" only, and an open one reaches to the end
_ATTRS = r"""(?:[^>=]++|=[ \t\n\r\f]*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))?+)*+"""
#: What is markup in a page, read from left to right as a browser's tokenizer does: comments, scripts and styles
#: with their contents, tags (a ">" inside quotes does not end one), declarations. Whatever is left
#: open reaches to the end. Every alternative takes what it has read for good, so a page is read once.
MARKUP_RE = (r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
             rf"|<(script|style)(?=[\s/>]){_ATTRS}(?:>|\z).*?(?:</\1(?=[\s/>])[^>]*+(?:>|\z)|\z)"
             rf"|</?[a-z]{_ATTRS}(?:>|\z)"
             r"|<(?:[!?]|/(?![a-z]))[^>]*+(?:>|\z)")


def strip_html(col) -> Column:
    """Visible text of an HTML fragment: markup (see ``MARKUP_RE``) becomes a blank,
    white space runs one space, the ends are trimmed. A lone "<" is text."""
    c = F.regexp_replace(_c(col), MARKUP_RE, " ")
    c = F.regexp_replace(c, r"[ \t\n\r\f]+", " ")
    return F.regexp_replace(c, r"^ | \z", "")


# the named references of HTML 4 and XML, from the standard library's table
_NAMED = {**{n: chr(cp) for n, cp in html.entities.name2codepoint.items()}, "apos": "'"}
CHARACTER_REF = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"


def decode_entities(col) -> Column:
    """Decode named and numeric character references in one pass from left to
    right, so what a reference decodes to is never decoded again: the text is
    split around the references, each is decoded by itself, and the pieces are
    zipped back together, all JVM-side. Unknown names stay as they are; code
    points beyond U+10FFFF and surrogates become U+FFFD."""
    c = _c(col)
    pieces = F.split(c, CHARACTER_REF, -1)
    refs = F.regexp_extract_all(c, F.lit(CHARACTER_REF), 0)
    named = F.create_map(*[F.lit(x) for kv in _NAMED.items() for x in kv])

    def one(ref):
        is_hex = F.substring(ref, 3, 1).isin("x", "X")
        digits = F.regexp_extract(ref, r"&#[xX]?([0-9a-fA-F]+);", 1)
        cp = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("decimal(38,0)")
        valid = (cp > 0) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
        ch = F.decode(F.unhex(F.lpad(F.conv(cp.cast("string"), 10, 16), 8, "0")), "UTF-32")
        return F.when(F.substring(ref, 2, 1) != "#", F.coalesce(F.try_element_at(named, F.substring(ref, F.lit(2), F.length(ref) - 2)), ref)) \
            .when(valid, ch).otherwise(F.lit("\ufffd"))

    body = F.array_join(F.zip_with(F.slice(pieces, 1, F.size(refs)), F.transform(refs, one),
                                   lambda p, ch: F.concat(p, ch)), "")
    return F.when(c.contains("&"), F.concat(body, F.element_at(pieces, -1))).otherwise(c)


def md5_hex(col) -> Column:
    """MD5 hex digest of the UTF-8 bytes (or of a binary column)."""
    return F.md5(_c(col).cast("binary"))
