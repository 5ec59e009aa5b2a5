"""Text scalar functions as Spark column expressions (JVM-side, codegen friendly).

C1 normalize_text, C2 final_number, C10 prompt_key, C12 safe_name, B7 paraphrase.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's rules for identical results.
#   quote marks removed by normalisation:          " ' `
#   punctuation that loses the blank before it:    ? . ! , ; :
#   answer marker pattern (case-insensitive):      answer <blanks> : <blanks> <number>
#   number pattern:                                optional minus, digits, optional .digits
#   numeric tolerance:                             1e-6
#   paraphrase suffix:                             newline + "Please answer concisely."
#   safe-name: runs of characters outside         A-Z a-z 0-9 _ . -   become "_"
# ---------------------------------------------------------------------------
QUOTE_CLASS = "[\"'`]"
PUNCT_CLASS = "[?.!,;:]"
NUM_TOL = 1e-6
PARAPHRASE_SUFFIX = "\nPlease answer concisely."
SAFE_NAME_CLASS = "[^A-Za-z0-9_.-]+"
DIGIT = "[0-9]"  # ASCII digits (documented difference to Python's Unicode \d)


def _blank_class() -> str:
    """Character class of Python's ``str.isspace`` blanks, built from that rule.

    Java's ``\\s`` misses U+001C..U+001F and DuckDB's RE2 ``\\s`` misses every
    non-ASCII blank and U+000B, so an explicit class keeps Spark, DuckDB and the
    reference in agreement.  ``\\x{h..}`` is understood by Java and RE2.
    """
    cps = [cp for cp in range(0x110000) if chr(cp).isspace()]
    ranges, start, prev = [], cps[0], cps[0]
    for cp in cps[1:]:
        if cp == prev + 1:
            prev = cp
            continue
        ranges.append((start, prev))
        start = prev = cp
    ranges.append((start, prev))
    parts = []
    for a, b in ranges:
        parts.append(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}")
    return "[" + "".join(parts) + "]"


BLANK = _blank_class()
NUMBER_RE = f"-?{DIGIT}+(?:\\.{DIGIT}+)?"
# Java flags: i = case-insensitive, u = Unicode case folding (as Python's re).
ANSWER_RE_JAVA = f"(?iu)answer{BLANK}*:{BLANK}*({NUMBER_RE})"
ANSWER_RE_RE2 = f"(?i)answer{BLANK}*:{BLANK}*({NUMBER_RE})"
STRIP_RE = f"\\A{BLANK}+|{BLANK}+\\z"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_text(s) -> Column:
    """Strip, lower, collapse blanks, drop quote marks, drop blank before punctuation."""
    s = _c(s)
    s = F.regexp_replace(s, STRIP_RE, "")
    s = F.lower(s)
    s = F.regexp_replace(s, f"{BLANK}+", " ")
    s = F.regexp_replace(s, QUOTE_CLASS, "")
    s = F.regexp_replace(s, f"{BLANK}({PUNCT_CLASS})", "$1")
    return s


def final_number(s) -> Column:
    """Number after the first ``answer:`` marker, else the last number of the
    text with commas removed; NULL when the text holds no digit."""
    s = _c(s)
    marked = F.regexp_extract(s, ANSWER_RE_JAVA, 1)
    numbers = F.regexp_extract_all(F.regexp_replace(s, ",", ""), F.lit(NUMBER_RE), F.lit(0))
    last = F.try_element_at(numbers, F.lit(-1))
    return F.when(marked != "", marked.try_cast("double")).otherwise(last.try_cast("double"))


def prompt_key(s) -> Column:
    """SHA-256 hex key of a text."""
    return F.sha2(_c(s), 256)


def safe_name(s) -> Column:
    """File-system safe name of a model name."""
    return F.regexp_replace(_c(s), SAFE_NAME_CLASS, "_")


def stamp_label(ts) -> Column:
    """``yyyyMMdd_HHmmss`` label of a time stamp."""
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def paraphrase(s) -> Column:
    """Right-trim and add the fixed paraphrase suffix."""
    return F.concat(F.regexp_replace(_c(s), f"{BLANK}+\\z", ""), F.lit(PARAPHRASE_SUFFIX))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & (F.abs(x) < F.lit(float("inf")))
