"""Column expressions that reproduce Python string semantics inside the JVM.

The oracle SQL restates these rules in its own words, without these patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's `\w` (str patterns): letters, digits and underscore across Unicode.
# Java's `\w` is ASCII-only, so the class is spelt out.
WORD_PATTERN = r"[\p{L}\p{N}_]+"

# Every code point for which Python's str.isspace() is true
# (what str.strip() removes): U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0,
# U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
_SPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
STRIP_PATTERN = rf"\A{_SPACE_CLASS}+|{_SPACE_CLASS}+\z"

# os.path.splitext on '/'-separated keys: the extension starts at the last
# dot of the last segment, unless only dots precede it in that segment.
HAS_EXT_PATTERN = r"(?s)\A(.*/)?\.*[^/.][^/]*\.[^./]*\z"
SPLIT_EXT_PATTERN = r"(?s)\A(.*)(\.[^./]*)\z"

# Universal-newline translation of text-mode reads: CRLF and lone CR -> LF.
NEWLINE_PATTERN = r"\r\n?"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """`re.findall(r'\\b\\w+\\b', text.lower())` as an array<string>."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_PATTERN), 0)


def py_strip(text: Column | str) -> Column:
    """`str.strip()` with no arguments (Unicode whitespace, not just ' ')."""
    return F.regexp_replace(_c(text), STRIP_PATTERN, "")


def splitext_base(key: Column | str) -> Column:
    k = _c(key)
    return F.when(k.rlike(HAS_EXT_PATTERN), F.regexp_extract(k, SPLIT_EXT_PATTERN, 1)).otherwise(k)


def splitext_ext(key: Column | str, lower: bool = True) -> Column:
    k = _c(key)
    ext = F.when(k.rlike(HAS_EXT_PATTERN), F.regexp_extract(k, SPLIT_EXT_PATTERN, 2)).otherwise(F.lit(""))
    return F.lower(ext) if lower else ext


def last_segment(path: Column | str) -> Column:
    """`path.split('/')[-1]`."""
    return F.element_at(F.split(_c(path), "/", -1), -1)


def universal_newlines(text: Column | str) -> Column:
    return F.regexp_replace(_c(text), NEWLINE_PATTERN, "\n")
