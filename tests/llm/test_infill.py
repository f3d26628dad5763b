import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tabflow.llm import infill
from tabflow.llm.infill import Blocks, Infill

TEXTS = [
    (1, "abc déf \U0001f600 ghi"),
    (2, ""),
    (3, None),
    (4, "has <P> in it"),
    (5, "x"),
    (5, "x"),
    (None, "no id"),
    (6, "long ü text " * 40_000),
    (7, "ends with < and <S"),
    *[(i, f"text number {i} with ß and more words") for i in range(10, 300)],
]


def brute(i, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return len(text), "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(text), "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_agrees_with_brute_force_and_back(docs):
    made = infill.fill_in_middle(docs(*TEXTS))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = made.withColumn("back", infill.original(F.col("output"), F.col("form"))).collect()
    wanted = sorted(((i, *brute(i, t), t or "") for i, t in TEXTS), key=repr)
    assert sorted(map(tuple, found), key=repr) == wanted
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_units_of_a_pattern_come_back(docs):
    found = infill.fill_in_middle(docs(*TEXTS), Infill(unit=r"\S+\s*", plain_percent=0, block=7))
    back = found.withColumn("back", infill.original(F.col("output"), F.col("form")))
    assert sorted((r.doc_id or 0, r.back) for r in back.collect()) == sorted((i or 0, t or "") for i, t in TEXTS)
    for r in found.where("doc_id >= 10 and form <> 'plain'").collect():
        assert r.n == 8
        text = dict(TEXTS)[r.doc_id]
        ends = {0, *(m.end() for m in re.finditer(r"\S+\s*", text))}
        assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= ends


def test_empty_table(docs):
    assert infill.fill_in_middle(docs()).collect() == []


@pytest.mark.parametrize("pattern", [None, r"\w+", r"\w*", r".{3}", r"(?<=b).", "q"])
@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_every_unit_is_found(pattern, block):
    draw = random.Random(3)
    compiled = re.compile(pattern, re.DOTALL) if pattern else None
    for size in (0, 1, 2, 9, 63, 64, 65, 200):
        text = "".join(draw.choices("ab \né", k=size))
        matches = re.finditer(pattern or ".", text, re.DOTALL)
        ends = [0, *(m.end() for m in matches if m.end() > m.start())]
        blocks = Blocks(text, compiled, block)
        assert blocks.units == len(ends) - 1
        assert [blocks.end_of(i) for i in range(len(ends))] == ends
