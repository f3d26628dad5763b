"""Text rules of the delimited files, as column expressions without UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabflow.fixed import NULL_MARKERS

_REGEX_META = set("\\^$.|?*+()[]{}")
_BLANKS = "".join(chr(c) for c in range(0x21))
_FIRST_KEPT = chr(0x21)
_INTEGER = r"^[+-]?[0-9]+\z"


def _pattern(sep: str) -> str:
    if len(sep) != 1:
        raise ValueError("sep must be a single character")
    return "\\" + sep if sep in _REGEX_META else sep


def leading_fields(line: Column, count: int, sep: str = "\t") -> Column:
    """The first ``count`` fields of a line as an array; the rest is not taken apart.

    Read a position with ``F.get``, which gives null past the end.
    """
    return F.split(line, _pattern(sep), count + 1)


def without_trailing(text: Column, sep: str) -> Column:
    """The text up to its last character that is not a separator."""
    return F.rtrim(text, F.lit(sep))


def items(text: Column, body: Column, sep: str) -> Column:
    """The items of a delimited text; ``body`` is its ``without_trailing`` form.

    Empty items at the end are dropped, leading and inner ones stay. An empty
    text is one empty item; a text of separators only has none and gives null,
    which ``explode`` skips. ``body`` is a parameter so that callers project it
    first and it is computed once.
    """
    return F.when((body != "") | (text == ""), F.split(body, _pattern(sep)))


def trim_blanks(text: Column) -> Column:
    """Strip every character up to and including the space from both ends."""
    # most texts have none at either end, which two comparisons by bytes find much sooner
    first, last = (F.collate(t, "UTF8_BINARY") >= _FIRST_KEPT for t in (text, F.substring(text, -1, 1)))
    return F.when(first & last, text).otherwise(F.btrim(text, F.lit(_BLANKS)))


def has_null_marker(text: Column) -> Column:
    """True where a null marker appears anywhere in the text."""
    found = text.contains(NULL_MARKERS[0])
    for marker in NULL_MARKERS[1:]:
        found = found | text.contains(marker)
    return found


def present(trimmed: Column) -> Column:
    """An already trimmed text, or null where it is empty or exactly a null marker."""
    return F.when(~trimmed.isin("", *NULL_MARKERS), trimmed)


def soft_long(text: Column) -> Column:
    """The text as a long, or null where it is not an optional sign and digits."""
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def strict_long(text: Column) -> Column:
    """The text as a long; a text that is not one fails the job."""
    message = F.concat(F.lit("not a 64-bit integer: "), text)
    return F.when(text.isNotNull(), F.coalesce(soft_long(text), F.raise_error(message)))


def kept(condition: Column, *columns: Column) -> Column:
    """Columns of the rows that meet ``condition``; select it as the only column.

    Does what ``where`` followed by ``select`` does. A filter would be pushed
    below the projection that takes the line apart and repeat that work for
    every column it mentions; a generator is evaluated once per row.
    """
    return F.inline(F.when(condition, F.array(F.struct(*columns))))
