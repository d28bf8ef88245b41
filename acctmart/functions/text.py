"""Text rules.

``+`` on text in the source dialect gives NULL if a part is NULL (``F.concat``),
while its ``CONCAT`` treats NULL as empty (:func:`concat_blank`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_blank(*parts: Column | str) -> Column:
    """Concatenate, counting NULL as empty text."""
    return F.concat_ws("", *[_col(p).cast("string") for p in parts])


def text_length(c: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(_col(c)))


def fold(c: Column | str, ci: bool = True) -> Column:
    """Key form for comparison that ignores case and trailing blanks; a no-op if not ``ci``."""
    return F.lower(F.rtrim(_col(c))) if ci else _col(c)


def same_text(a: Column | str, b: Column | str, ci: bool = False) -> Column:
    """Text equality, binary by default."""
    return fold(a, ci) == fold(b, ci)


def _part(c: Column, mark: str, count: int, strict: bool) -> Column:
    found = F.instr(c, mark) > 0
    part = F.when(found, F.substring_index(c, mark, count))
    if strict:
        message = F.concat(F.lit(f"no '{mark}' in reference: "), c)
        part = part.when(c.isNotNull(), F.raise_error(message).cast("string"))
    return part


def before_first(c: Column | str, mark: str = "-", strict: bool = False) -> Column:
    """Text before the first ``mark``; NULL (an error if ``strict``) where there is none."""
    return _part(_col(c), mark, 1, strict)


def after_last(c: Column | str, mark: str = "-", strict: bool = False) -> Column:
    """Text after the last ``mark``; NULL (an error if ``strict``) where there is none."""
    return _part(_col(c), mark, -1, strict)


def split_reference(
    c: Column | str, mark: str = "-", strict: bool = False
) -> tuple[Column, Column]:
    """First and last part of a text reference, for a join on two columns."""
    return before_first(c, mark, strict), after_last(c, mark, strict)


def recode_prefix(
    c: Column | str, prefixes: Mapping[str, str], skip: int = 4, ci: bool = False
) -> Column:
    """Replace the first ``skip`` characters by a code where a LIKE pattern matches.

    Patterns follow LIKE: ``_`` is any one character. Trailing blanks of the
    rest are dropped. Text that matches no pattern stays as it is.
    """
    value = _col(c)
    subject = F.lower(value) if ci else value
    rest = F.substr(F.rtrim(value), F.lit(skip + 1))
    out = None
    for pattern, code in prefixes.items():
        hit = subject.like(pattern.lower() if ci else pattern)
        new = F.concat(F.lit(code), rest)
        out = F.when(hit, new) if out is None else out.when(hit, new)
    return value if out is None else out.otherwise(value)


def account_number(
    account: Column | str, reference: Column | str, lead: str = "000000", mark: str = "-"
) -> Column:
    """``lead`` + account + the two characters after the first ``mark``, zero-padded.

    Without a mark the first two characters of the reference are taken; a NULL
    account or reference adds nothing.
    """
    ref = _col(reference)
    suffix = F.substr(ref, F.instr(ref, mark) + 1, F.lit(2))
    return concat_blank(F.lit(lead), account, F.lpad(suffix, 2, "0"))
