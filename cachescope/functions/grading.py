"""Grading expressions (C3-C9, C11) over array-of-candidates columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cachescope.functions.text import NUM_TOL, final_number, normalize_text, _c


def _text_match(norm_out: Column, e: Column) -> Column:
    n = normalize_text(e)
    return F.coalesce((n == norm_out) | F.contains(norm_out, n) | F.contains(n, norm_out),
                      F.lit(False))


def grade(expected, output, out_num: Column | None = None, out_norm: Column | None = None,
          strict: bool = False) -> Column:
    """Numeric path first (output and any candidate hold a number, then only
    numbers count, tolerance 1e-6), else normalised equality or containment
    either way.  NULL output is wrong.  ``strict`` also rejects empty outputs and
    missing gold answers (``[""]``), which the default accepts like the reference.

    ``out_num`` / ``out_norm`` may be passed when already computed once per row.
    """
    expected, output = _c(expected), _c(output)
    out_num = final_number(output) if out_num is None else out_num
    out_norm = normalize_text(output) if out_norm is None else out_norm
    nums = F.transform(expected, lambda e: final_number(e))
    numeric_path = out_num.isNotNull() & F.exists(nums, lambda x: x.isNotNull())
    numeric_ok = F.exists(nums, lambda x: x.isNotNull() & (F.abs(out_num - x) <= NUM_TOL))
    text_ok = F.exists(expected, lambda e: _text_match(out_norm, e))
    verdict = F.when(output.isNull(), F.lit(False)).when(numeric_path, numeric_ok).otherwise(text_ok)
    verdict = F.coalesce(verdict, F.lit(False))
    if strict:
        has_gold = F.exists(expected, lambda e: F.coalesce(e != "", F.lit(False)))
        verdict = verdict & has_gold & (F.coalesce(out_norm, F.lit("")) != "")
    return verdict


def verdict_numeric(expected, output) -> Column:
    """Any candidate within relative or absolute 1e-6 of the output number (infinities only if equal)."""
    expected = _c(expected)
    mn = final_number(_c(output))
    return F.coalesce(mn.isNotNull() & F.exists(
        expected, lambda e: F.coalesce(
            (final_number(e) == mn) | (
                (F.abs(final_number(e)) < float("inf")) & (F.abs(mn) < float("inf"))
                & (F.abs(final_number(e) - mn) <= F.greatest(
                    F.lit(NUM_TOL) * F.greatest(F.abs(final_number(e)), F.abs(mn)), F.lit(NUM_TOL)))),
            F.lit(False))), F.lit(False))


def verdict_text(expected, output) -> Column:
    """Text branch of the grade."""
    out_norm = normalize_text(_c(output))
    return F.coalesce(F.exists(_c(expected), lambda e: _text_match(out_norm, e)), F.lit(False))


def mostly_numeric(expected) -> Column:
    """Numeric candidates >= max(1, n div 2)."""
    expected = _c(expected)
    n_num = F.size(F.filter(expected, lambda e: final_number(e).isNotNull()))
    return n_num >= F.greatest(F.lit(1), F.floor(F.size(expected) / 2).cast("int"))


def task_verdict(expected, output) -> Column:
    """Numeric verdict when candidates are mostly numeric, else text verdict."""
    return F.when(mostly_numeric(expected), verdict_numeric(expected, output)) \
        .otherwise(verdict_text(expected, output))


def label_words(label) -> Column:
    """true/false label to ``entailed`` / ``refuted``."""
    return F.when(_c(label).try_cast("int") == 1, F.lit("entailed")).otherwise(F.lit("refuted"))


def safe_ratio(num, den) -> Column:
    """C11: 0.0 when the denominator is not positive (ANSI-safe)."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))
