"""Text clean-up and name functions (C1-C11), all built-in regex/string ops.

The same pattern strings run in Spark (Java regex) and in DuckDB (RE2): only
syntax both engines read the same way is used (explicit classes, ``\\x{..}``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col

# ---- fixed values -----------------------------------------------------------
# The literal 12-character sequence removed first from generated text.
ESCAPE_LITERAL = r"\342\201\207"
# Any backslash-three-digit triple, removed second.
ESCAPE_TRIPLE = r"\\[0-9]{3}\\[0-9]{3}\\[0-9]{3}"
# Punctuation that gets one space after it.
PUNCT = r"([.!?,])"
# Control characters removed last (C0, DEL and C1).
CONTROL = r"[\x00-\x1F\x7F-\x9F]"
# Whitespace as Python's str.split()/str.isspace() and re's \s see it:
# U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
WS_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# -----------------------------------------------------------------------------


def strip_literal(c) -> Column:
    """Remove the literal escape sequence (plain replace, not regex)."""
    return F.replace(as_col(c), F.lit(ESCAPE_LITERAL), F.lit(""))


def strip_escapes(c) -> Column:
    """Remove every backslash-digit triple."""
    return F.regexp_replace(as_col(c), ESCAPE_TRIPLE, "")


def split_prefix(text, prompt) -> tuple[Column, Column]:
    """(context, generated) cut at the prompt's length in code points."""
    t, n = as_col(text), F.length(as_col(prompt))
    return F.substring(t, F.lit(1), n), F.substr(t, n + 1)


def drop_whitespace(c) -> Column:
    """C4: remove all whitespace (Python ``''.join(s.split())``)."""
    return F.regexp_replace(as_col(c), WS_CLASS + "+", "")


def space_after_punct(c) -> Column:
    """One space after each of ``. ! ? ,``."""
    return F.regexp_replace(as_col(c), PUNCT, "$1 ")


def collapse_trim(c) -> Column:
    """Runs of whitespace -> one space, then strip both ends."""
    s = F.regexp_replace(as_col(c), WS_CLASS + "+", " ")
    return F.regexp_replace(s, "^" + WS_CLASS + "+|" + WS_CLASS + "+$", "")


def strip_control(c) -> Column:
    """Remove U+0000-001F and U+007F-009F (newlines included)."""
    return F.regexp_replace(as_col(c), CONTROL, "")


def file_basename(c) -> Column:
    """Last path component (empty for a trailing slash)."""
    return F.regexp_extract(as_col(c), r"([^/]*)$", 1)


def zero_pad_name(c, prefix: str = "data", width: int = 2, suffix: str = ".bin") -> Column:
    """``data07.bin``; ids wider than ``width`` keep all digits."""
    return F.format_string(f"{prefix}%0{width}d{suffix}", as_col(c))


def percent_done(done, total) -> Column:
    """C11: integer percent ``done*100 // total`` (NULL when total is 0)."""
    d, t = as_col(done), as_col(total)
    wide = (d.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")) / t.cast("decimal(20,0)")  # done * 100 may exceed a long
    return F.when(t == 0, F.lit(None).cast("long")).otherwise(F.floor(wide).cast("long"))
