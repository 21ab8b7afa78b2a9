"""Text normalisation as native column expressions (STR-1..5).

Built from ``lower``, ``regexp_replace``, ``btrim``, ``split`` and higher-order
``filter``.  Tone removal hands texts beyond ASCII to vectorised Arrow kernels;
the table-level cleaners of ``operators.vocab`` run their whitelist pass in
Arrow batches.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Lower-case Vietnamese letters kept by the cleaning whitelist, besides a-z and 0-9.
VIETNAMESE_LETTERS = (
    "àáạảãăắằặẳẵâầấậẩẫèéẹẻẽêềếệểễ"
    "ìíịỉĩòóọỏõôồốộổỗơờớợởỡùúụủũưừứựửữ"
    "ỳýỵỷỹđ"
)
# Combining marks removed by tone removal: U+0300..U+036F.
COMBINING_LOW, COMBINING_HIGH = 0x0300, 0x036F
# ---------------------------------------------------------------------------

# Python's str.isspace() set, spelled for Java regex: with (?U), \s is the
# Unicode White_Space property; Python additionally counts 0x1c-0x1f.
_WS_CLASS = r"[\s\x1c-\x1f]"
_WS_NOT_SPACE = r"(?:(?! )" + _WS_CLASS + r")"
# Whitespace runs that differ from a single ' ' (a lone space is left alone,
# so the regex only rewrites what changes).
_WS_RUN_TO_FIX = r"(?U)" + _WS_NOT_SPACE + _WS_CLASS + r"*| " + _WS_CLASS + r"+"
_WS_RUN = r"(?U)" + _WS_CLASS + r"+"
_KEPT = "a-z" + VIETNAMESE_LETTERS + "0-9"
_NOT_KEPT_CHAR = r"(?U)(?!" + _WS_CLASS + r")[^" + _KEPT + "]"
# Cheap first test: only characters outside ASCII a-z, 0-9 and space can
# start a replaced run.
_ASCII_PRECHECK = "(?=[^a-z0-9 ])"


def _ranges(chars) -> str:
    """Regex class body for a set of characters, consecutive code points merged."""
    cps = sorted({ord(c) for c in chars})
    out, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        lo, hi = cps[i], cps[j]
        out.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
        i = j + 1
    return "".join(out)


@lru_cache(maxsize=1)
def _lowered_kept_class() -> str:
    """Kept characters for text that is already lower-cased.

    Adding every character whose lower case is kept changes nothing on such
    text (none of them can occur), but lets consecutive code points merge
    into ranges.  Java evaluates a class as a chain of predicates: all
    single Latin-1 characters share one bit set, while every range or
    other character adds a link.  So Latin-1 members are listed one by one
    and only the characters above U+00FF are merged into ranges: a chain of
    about nine links instead of about sixty.
    """
    kept = set(VIETNAMESE_LETTERS) | set("abcdefghijklmnopqrstuvwxyz0123456789")
    upper = {chr(cp) for cp in range(0x10000)
             if not 0xD800 <= cp <= 0xDFFF and chr(cp).lower() in kept}
    allowed = kept | upper
    latin1 = "".join(f"\\x{{{ord(c):x}}}" for c in sorted(c for c in allowed if ord(c) < 0x100))
    return latin1 + _ranges([c for c in allowed if ord(c) >= 0x100])


@lru_cache(maxsize=1)
def lowered_not_kept_run() -> str:
    """Maximal runs of non-kept characters except a lone ' ', each started by
    a cheap ASCII test before the full class is consulted."""
    k = _lowered_kept_class()
    return (_ASCII_PRECHECK + "[^" + k + " ][^" + k + "]*| (?=[^a-z0-9])[^" + k + "]+")


@lru_cache(maxsize=1)
def lowered_not_kept_run_re2() -> str:
    """The same runs in RE2 syntax (RE2 has no look-ahead and needs none: it
    matches in linear time with an automaton)."""
    k = _lowered_kept_class()
    return "[^" + k + " ][^" + k + "]*| [^" + k + "]+"


@lru_cache(maxsize=1)
def not_kept_char_re2() -> str:
    """STR-2's replaced characters in RE2 syntax: anything outside a-z, the
    Vietnamese letters, 0-9 and Python whitespace (case-sensitive)."""
    allowed = set(VIETNAMESE_LETTERS) | set("abcdefghijklmnopqrstuvwxyz0123456789") \
        | set(python_whitespace())
    return "[^" + _ranges(allowed) + "]"


@lru_cache(maxsize=1)
def python_whitespace() -> str:
    """Every code point for which Python's ``str.isspace()`` is true (the set
    ``str.strip()`` removes), derived by rule."""
    return "".join(chr(cp) for cp in range(0x110000)
                   if not 0xD800 <= cp <= 0xDFFF and chr(cp).isspace())


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_unicode_ws(col) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace
    (``btrim`` walks in from both ends; no regex scan of the text)."""
    return F.btrim(_c(col), F.lit(python_whitespace()))


def keep_vietnamese(col) -> Column:
    """STR-2: every character outside a-z, Vietnamese letters, 0-9 and
    whitespace becomes one space (whitespace itself is kept; case-sensitive).

    The leading look-ahead is a cheap ASCII test: the common characters
    (ASCII letters, digits, space) fail there without walking the long class.
    """
    return F.regexp_replace(_c(col), _ASCII_PRECHECK + _NOT_KEPT_CHAR, " ")


def collapse_ws(col) -> Column:
    """Every whitespace run -> one ' ' (runs that already are ' ' untouched)."""
    return F.regexp_replace(_c(col), _WS_RUN_TO_FIX, " ")


def clean(col, remove_tones: bool = False, remove_noise: bool = True) -> Column:
    """STR-1: lower -> strip -> [tone removal] -> whitelist -> collapse whitespace.

    No final strip: a character dropped at either end leaves one space.
    With the whitelist on, "replace each dropped character by a space, then
    collapse whitespace runs" equals "replace each maximal run of non-kept
    characters (whitespace included) by one space", which is one regex pass;
    runs that are already a single ' ' are not matched at all.
    """
    text = strip_unicode_ws(F.lower(_c(col)))
    if remove_tones:
        text = remove_tone(text)
    if remove_noise:
        return F.regexp_replace(text, lowered_not_kept_run(), " ")
    return collapse_ws(text)


@lru_cache(maxsize=1)
def composing_re2() -> str:
    """RE2 class of the characters that can compose with the one before, less the dropped marks: second
    characters of canonical decompositions, and vowels and finals of Hangul syllables."""
    seconds = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for cp in range(0x80, 0x110000):
        parts = unicodedata.decomposition(chr(cp))
        if parts and not parts.startswith("<"):
            seconds.update(chr(int(x, 16)) for x in parts.split()[1:])
    return "[" + _ranges({c for c in seconds if not COMBINING_LOW <= ord(c) <= COMBINING_HIGH}) + "]"


@F.arrow_udf(StringType())
def _without_marks(texts: pa.Array) -> pa.Array:
    """NFD, U+0300..U+036F dropped, NFC, as vectorised kernels over a whole batch.

    What the first two give is composed already unless a character is left that composes with the one before
    (Indic vowel signs, Hangul in parts, ...); only texts that hold one are composed one by one, as Arrow has no
    kernel for it.
    """
    import pyarrow.compute as pc

    apart = pc.utf8_normalize(texts, form="NFD")
    kept = pc.replace_substring_regex(apart, pattern=f"[{chr(COMBINING_LOW)}-{chr(COMBINING_HIGH)}]", replacement="")
    loose = pc.fill_null(pc.match_substring_regex(kept, composing_re2()), False)
    if not pc.any(loose).as_py():
        return kept
    composed = [unicodedata.normalize("NFC", t) for t in kept.filter(loose).to_pylist()]
    return pc.replace_with_mask(kept, loose, pa.array(composed, kept.type))


def remove_tone(col) -> Column:
    """STR-3: NFD, drop U+0300..U+036F, NFC (đ stays).

    ASCII text is its own result and never leaves the JVM; other texts take the rule itself in Arrow batches.
    """
    text = _c(col)
    beyond = text.rlike(r"[^\x00-\x7F]")
    return F.when(beyond, _without_marks(F.when(beyond, text))).otherwise(text)


def normalise_spaces(col) -> Column:
    """STR-4: split on whitespace and re-join with single spaces (trimmed)."""
    return F.btrim(collapse_ws(_c(col)), F.lit(" "))


def tokenize(col) -> Column:
    """STR-5: whitespace split without empty tokens."""
    return F.filter(F.split(_c(col), _WS_RUN), lambda t: t != F.lit(""))


def tokenize_clean(col) -> Column:
    """Tokens of an already-cleaned text.  ``clean`` leaves only single spaces,
    at most one at each end, so trimming those and splitting on ' ' yields no
    empty token except for an empty text, mapped to [] - all native, no
    per-token lambda."""
    trimmed = F.btrim(_c(col), F.lit(" "))
    return F.when(trimmed == F.lit(""), F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, " "))
