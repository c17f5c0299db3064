"""String expressions (STR-1..10).  All are built-in Spark functions, so
they run JVM-side inside generated code; no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions.constants import (ASCII_PUNCTUATION, MATCH_WINDOW,
                                        SEQUENCE_PUNCTUATION)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_class(chars: str) -> str:
    """A regex character class matching exactly ``chars`` (each escaped)."""
    return "".join("\\" + ch for ch in dict.fromkeys(chars))


TAG_RE = "<[^>]+>"


def clean_text(c, as_coded: bool = False) -> Column:
    """STR-1: newlines -> spaces, strip ``<...>`` tags, delete ASCII
    punctuation, lower-case.  ``as_coded=True`` deletes punctuation before
    the tag step (so the tag step can never match, as in the original)."""
    t = F.translate(_c(c), "\n\r", "  ")
    if as_coded:
        t = F.regexp_replace(F.translate(t, ASCII_PUNCTUATION, ""), TAG_RE, "")
    else:
        t = F.translate(F.regexp_replace(t, TAG_RE, ""), ASCII_PUNCTUATION, "")
    return F.lower(t)


def whitespace_tokens(c) -> Column:
    """STR-2: split on runs of (Unicode) whitespace, empty tokens dropped."""
    return F.filter(F.split(_c(c), "(?U)\\s+"), lambda t: t != "")


def tokenize(c, as_coded: bool = False) -> Column:
    """STR-1 + STR-2."""
    return whitespace_tokens(clean_text(c, as_coded))


_SEQ = regex_class(SEQUENCE_PUNCTUATION)
SEQ_TOKEN_RE = f"[^ \\n{_SEQ}]+|[{_SEQ}]"
SKIP_RE = "<[^>]*(>|\\z)"


def sequence_tokens(c) -> Column:
    """STR-3: words split on space and newline only; every punctuation mark
    (angle brackets aside) is a token; text inside ``<...>`` is skipped
    (an unclosed ``<`` skips to the end); a stray ``>`` is dropped."""
    t = F.translate(F.regexp_replace(_c(c), SKIP_RE, ""), ">", "")
    return F.regexp_extract_all(t, F.lit(SEQ_TOKEN_RE), 0)


def find_all(c, pattern: str, group: int = 1, distinct: bool = True) -> Column:
    """STR-4: all matches of a capture group; optionally distinct."""
    m = F.regexp_extract_all(_c(c), F.lit(pattern), group)
    return F.array_distinct(m) if distinct else m


def normalise_phone(c) -> Column:
    """STR-5: ``a-b-c`` -> ``(a) b-c``, each part trimmed; anything without
    exactly three dash-separated parts becomes the empty string."""
    parts = F.transform(F.split(_c(c), "-"), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))
    return F.when(F.size(parts) == 3,
                  F.format_string("(%s) %s-%s", parts[0], parts[1], parts[2])).otherwise(F.lit(""))


def xor_hex_encode(c, key: int) -> Column:
    """Inverse of STR-6 (for round trips): key byte then each code unit
    XOR key, as two hex digits each."""
    s = _c(c)
    body = F.transform(F.sequence(F.lit(1), F.length(s)),
                       lambda i: F.lpad(F.hex(F.ascii(F.substring(s, i, 1)).bitwiseXOR(F.lit(key))), 2, "0"))
    return F.lower(F.concat(F.lpad(F.hex(F.lit(key)), 2, "0"), F.array_join(body, "")))


def xor_hex_decode(c) -> Column:
    """STR-6: decode hex text whose first byte is the XOR key."""
    s = _c(c)
    key = F.conv(F.substring(s, 1, 2), 16, 10).cast("int")
    chars = F.transform(
        F.sequence(F.lit(3), F.length(s), F.lit(2)),
        lambda i: F.chr(F.conv(F.substring(s, i, 2), 16, 10).cast("int").bitwiseXOR(key)))
    return F.when(F.length(s) > 2, F.array_join(chars, "")).otherwise(F.lit(""))


def url_to_key(c) -> Column:
    """STR-7: drop one leading '/', then '/', '?', '=' -> '_'."""
    return F.translate(F.regexp_replace(_c(c), "^/", ""), "/?=", "___")


def label_from_name(c, pattern: str = "_(\\d+)\\.") -> Column:
    """STR-8: parse a label out of a file or resource name."""
    return F.regexp_extract(_c(c), pattern, 1)


def window_around(c, needle: str, before: int = MATCH_WINDOW[0],
                  after: int = MATCH_WINDOW[1]) -> Column:
    """STR-9: text from ``before`` characters ahead of the first match to
    ``after`` characters past its start; NULL if there is no match."""
    s = _c(c)
    pos = F.instr(s, needle)
    start = F.greatest(F.lit(1), pos - before)
    return F.when(pos > 0, s.substr(start, pos + F.lit(after) - start))


def delimited(*cols, sep: str = ", ") -> Column:
    """STR-10: one delimited line from several fields."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])
