"""Short licence notices in texts: exact phrases, and notices with a few errors.

A notice of ``n`` characters may differ by ``n * MAX_ERRORS`` edits. Split into one
piece more than that, at least one piece of it stands unchanged in the text, so
exact searches for the pieces give every place a notice can be (pigeonhole
principle). Around each such place the ``regex`` library's bounded-error matching
decides, and reports the span with the fewest errors.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame

from tabflow.llm.texts import ALNUM, encode, per_text

# Phrases that count wherever their words stand consecutively.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Notices that may have errors, as words in lower case.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under a creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("mit", "permission is hereby granted free of charge to any person"),
    ("mit", "released under the mit license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license"),
    ("reserved", "no part of this publication may be reproduced"),
    ("unlicense", "free and unencumbered software released into the public domain"),
)

#: Edits allowed per character of a notice.
MAX_ERRORS = 0.1

SPAN = "array<struct<label:string,first_word:bigint,end_word:bigint,errors:int,text:string>>"


@dataclass
class _Notice:
    label: str
    text: bytes
    errors: int
    pieces: list[tuple[int, bytes]]
    pattern: regex.Pattern


def _prepared(label: str, words: str, max_errors: float) -> _Notice:
    text = words.encode()
    errors = int(len(text) * max_errors)
    cuts = [len(text) * i // (errors + 1) for i in range(errors + 2)]
    pieces = [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]
    fuzzy = rb"(?e)(?:%s){e<=%d}" % (regex.escape(text), errors)
    return _Notice(label, text, errors, pieces, regex.compile(fuzzy))


def _places(text: bytes, piece: bytes) -> list[int]:
    found, at = [], text.find(piece)
    while at >= 0:
        found.append(at)
        at = text.find(piece, at + 1)
    return found


def _windows(text: bytes, notice: _Notice) -> list[tuple[int, int]]:
    """Stretches that hold every possible place of a notice, joined if they meet."""
    reach = len(notice.text) + notice.errors
    starts = sorted(
        at - offset for offset, piece in notice.pieces for at in _places(text, piece)
    )
    joined: list[list[int]] = []
    for start in starts:
        low, high = max(0, start - notice.errors), min(len(text), start + reach)
        if joined and low <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    return [(low, high) for low, high in joined]


def scanner(
    phrases=PHRASES, notices=NOTICES, max_errors: float = MAX_ERRORS
) -> Callable[[str], tuple]:
    """The function that ``scan_licenses`` runs on each text."""
    exact = [(label, b" %s " % words.encode()) for label, words in phrases]
    fuzzy = [_prepared(label, words, max_errors) for label, words in notices]

    def scan(text: str) -> tuple:
        words = encode(text).translate(ALNUM).split()
        joined = b" " + b" ".join(words) + b" "
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts, spans, score = [], [], 0.0
        for label, phrase in exact:
            for at in _places(joined, phrase):
                word = bisect_left(blanks, at)
                starts.append(word)
                size = phrase.count(b" ") - 1
                spans.append((label, word, word + size, 0, phrase[1:-1].decode()))
        base = {s[0] for s in spans}
        if base:
            score = 1.0
        for notice in fuzzy:
            for low, high in _windows(joined, notice):
                for m in notice.pattern.finditer(joined, low, high):
                    first = bisect_left(blanks, m.start() + 1) - 1
                    end = bisect_left(blanks, m.end() - 1)
                    errors = sum(m.fuzzy_counts)
                    shown = m[0].strip().decode("utf-8", "replace")
                    spans.append((notice.label, first, end, errors, shown))
                    score = max(score, 1 - errors / len(notice.text))
        spans.sort()
        labels = {s[0] for s in spans}
        keys = ("label", "first_word", "end_word", "errors", "text")
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            float(score),
            [dict(zip(keys, s)) for s in spans],
        )

    return scan


def scan_licenses(
    docs: DataFrame,
    phrases=PHRASES,
    notices=NOTICES,
    max_errors: float = MAX_ERRORS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: phrases, labels, a score and the spans of all notices.

    ``n_base`` counts all places of the phrases, ``first_word`` and ``last_word``
    are their smallest and largest start in words from 0 (null without one).
    ``labels`` has those of the notices too; both lists are distinct, sorted and
    joined by commas. ``score`` is 1 with a phrase, else 1 less the errors per
    character of the best notice, else 0. ``spans`` are (label, first word, word
    after the last, errors, text found). An empty or null text has none.
    The time for a text grows with its length and its matches.
    """
    fields = [
        ("n_words", "bigint"),
        ("n_base", "bigint"),
        ("first_word", "bigint"),
        ("last_word", "bigint"),
        ("base_labels", "string"),
        ("labels", "string"),
        ("score", "double"),
        ("spans", SPAN),
    ]
    return per_text(docs, lambda: scanner(phrases, notices, max_errors), fields, id_col, text_col)
