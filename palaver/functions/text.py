"""Scalar text and number expressions (all JVM built-ins)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once.

    Higher-order functions are interpreted, so an expression written in several
    places is computed several times; a one-element ``transform`` names it.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def chars(text: Column) -> Column:
    """Length in code points."""
    return F.length(text).cast("bigint")


def floor_div(value: Column, by: int) -> Column:
    """Integer division, keeping BIGINT."""
    return F.call_function("div", value.cast("bigint"), F.lit(by).cast("bigint"))


def tokens(n_chars: Column) -> Column:
    """Token estimate: four characters per token."""
    return floor_div(n_chars, 4)


def output_tokens(text: Column) -> Column:
    """Token estimate of one reply, never below one."""
    return F.greatest(F.lit(1).cast("bigint"), tokens(chars(text)))


def strip_space(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Split on runs of white space of any kind, dropping empty pieces."""
    return F.array_remove(F.split(text, r"(?U)\s+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def preview(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def join_words(parts: Column, sep: str = " ") -> Column:
    return F.array_join(parts, sep)


def repeat_word(word: Column, n: Column) -> Column:
    """``word`` n times, joined by single spaces."""
    return F.array_join(F.array_repeat(word, n.cast("int")), " ")


def repeat_to_length(pattern: Column, length: Column) -> Column:
    """``pattern`` repeated and cut to exactly ``length`` characters."""
    times = F.call_function("div", length.cast("bigint"),
                            F.greatest(F.lit(1).cast("bigint"), chars(pattern))) + 1
    return F.substring(F.repeat(pattern, times.cast("int")), F.lit(1), length.cast("int"))


def occurrences(text: Column, needle: Column) -> Column:
    """Non-overlapping occurrences of ``needle``; NULL for an empty needle."""
    gap = chars(text) - chars(F.replace(text, needle, F.lit("")))
    return F.when(chars(needle) > 0, F.call_function("div", gap, chars(needle)))


def strip_placeholders(text: Column, letters_only: bool = False) -> Column:
    """Drop ``{name}`` markers that no fill replaced."""
    body = "[a-zA-Z_]+" if letters_only else "[a-zA-Z_0-9]+"
    return F.regexp_replace(text, r"\{" + body + r"\}", "")


def strip_tags(html: Column) -> Column:
    return strip_space(F.regexp_replace(html, "<[^>]+>", ""))


def one_line(text: Column) -> Column:
    """Trim, then turn line breaks into spaces."""
    return F.replace(strip_space(text), F.lit("\n"), F.lit(" "))


def cut_at_sentence(text: Column, n_words: Column, share: float = 0.7) -> Column:
    """First ``n_words`` words, cut back to the last '.' when it lies late enough.

    The cut happens only if the zero-based position of that '.' is beyond
    ``share`` of the shortened text.
    """
    short = F.array_join(F.slice(words(text), F.lit(1), n_words.cast("int")), " ")
    return bind(short, lambda s: _back_to_period(s, share))


def _back_to_period(short: Column, share: float) -> Column:
    from_end = F.instr(F.reverse(short), ".")
    keep = F.length(short) - from_end + 1
    late = (from_end > 0) & ((keep - 1) > F.lit(share) * F.length(short))
    return F.when(late, F.substring(short, F.lit(1), keep)).otherwise(short)


def pad_words(base: Column, extension: Column, n_words: Column) -> Column:
    """Array ``base`` followed by whole copies of ``extension`` until ``n_words``.

    Copies are appended whole, so the result may pass the target by less than
    one extension; with an empty extension the base is returned unchanged.
    """
    size_b = F.size(base).cast("bigint")
    size_e = F.size(extension).cast("bigint")
    missing = F.greatest(F.lit(0).cast("bigint"), n_words.cast("bigint") - size_b)
    copies = F.when(size_e > 0, F.ceil(missing / size_e)).otherwise(F.lit(0).cast("bigint"))
    return F.concat(base, F.flatten(F.array_repeat(extension, copies.cast("int"))))


def fit_words(text: Column, extension: Column, n_words: Column,
              pad_then_trim: bool = False, slack: float = 1.3) -> Column:
    """Bring a reply to a target length in words.

    Short texts are padded with ``extension`` (an array of words); texts beyond
    ``slack`` times the target are cut with :func:`cut_at_sentence`.  With
    ``pad_then_trim`` the trim also applies to what was just padded and the
    bound is the integer part of ``slack * target``.
    """
    def trim(source: Column, over: Column) -> Column:
        short = F.array_join(F.slice(source, F.lit(1), n_words.cast("int")), " ")
        return F.when(over, bind(short, lambda s: _back_to_period(s, 0.7))).otherwise(
            F.array_join(source, " "))

    def fit(base: Column) -> Column:
        padded = pad_words(base, extension, n_words)
        if pad_then_trim:
            return bind(padded, lambda p: trim(p, F.size(p) > F.floor(n_words * F.lit(slack))))
        return F.when(F.size(base) < n_words, F.array_join(padded, " ")).otherwise(
            trim(base, F.size(base) > n_words * F.lit(slack)))

    return bind(words(text), fit)


def sentence_case(word_list: Column, comma_at: Column | None = None) -> Column:
    """Capitalise the first word, put an optional comma, join and end with '.'.

    ``comma_at`` is the zero-based index of the word that gets the comma; NULL
    or a negative value means none.
    """
    shaped = F.transform(
        word_list,
        lambda w, i: F.concat(
            F.when(i == 0, F.concat(F.upper(F.substring(w, 1, 1)),
                                    F.lower(F.substring(w, F.lit(2), F.length(w)))))
             .otherwise(w),
            F.when(i == comma_at, F.lit(",")).otherwise(F.lit(""))
            if comma_at is not None else F.lit("")))
    return F.concat(F.array_join(shaped, " "), F.lit("."))


def author_list(authors: Column, keep: int = 3) -> Column:
    """First ``keep`` authors, with "et al." when there are more."""
    head = F.array_join(F.slice(authors, 1, keep), ", ")
    return F.when(F.size(authors) > keep, F.concat(head, F.lit(" et al."))).otherwise(head)


def url_tail(url: Column, marker: str = "/abs/") -> Column:
    return F.element_at(F.split(url, marker), -1)


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """Case-insensitive test for any of the fixed substrings, as one compiled pattern."""
    return F.rlike(F.lower(text), F.lit("|".join(map(re.escape, needles))))


def hex_code(value: Column, width: int = 6) -> Column:
    """``0x`` plus upper-case hexadecimal padded with zeros."""
    return F.concat(F.lit("0x"), F.lpad(F.hex(value.cast("bigint")), width, "0"))


def normalise(value: Column, maximum: float) -> Column:
    """``min(value / maximum, 1)``; zero when the maximum is not positive."""
    if maximum <= 0:
        return F.lit(0.0)
    return F.least(value.cast("double") / F.lit(float(maximum)), F.lit(1.0))


def hms(seconds: Column) -> tuple[Column, Column, Column]:
    """Whole hours, minutes and seconds of a duration in seconds."""
    total = F.floor(seconds).cast("bigint")
    return (floor_div(total, 3600), floor_div(total % 3600, 60), total % 60)


def utc_stamp(ts: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.date_format(ts, pattern)


def share(part: Column, whole: Column) -> Column:
    """Percentage, NULL when the whole is zero."""
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))
