import base64
import hashlib
import random
import re
import time

from tabflow.llm import secrets
from tests.llm import plain


def test_patterns_agree(docs):
    draw = random.Random(9)
    parts = ['password="', "Token : ", "api_key=", "apikey='", "SECRET", "=", " ", "\n", "é", "AKIA", "😀", "x.y", "'"]
    rows = []
    for i in range(150):
        made = ""
        for _ in range(draw.randint(0, 12)):
            run = "".join(draw.choices(draw.choice(["0123456789abcdef", "ABCDEFGH0123", "ab+/=._-"]), k=draw.randint(1, 45)))
            made += draw.choice([*parts, run, run])
        rows.append((i, made))
    rows += [(900, None), (901, ""), (902, "token=12345678 " * 500), (903, "paſſword=12345678 toKen=abcdefgh")]
    found = secrets.scan_secrets(docs(*rows))
    got = {r.doc_id: r for r in found.collect()}
    short = {r.doc_id: r for r in secrets.digest(found).collect()}
    for i, text in rows:
        wanted = plain.secrets(text)
        assert [(s.start, s.kind, s.end) for s in got[i].base] == wanted, text
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in wanted) for n in range(3))
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in wanted)
        assert short[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_random_strings_are_told_from_text(docs):
    draw = random.Random(2)
    rows = []
    for i in range(60):
        key = base64.b64encode(draw.randbytes(30)).decode().rstrip("=")
        rows.append((i, f"see {key} now"))
        rows.append((100 + i, f"see {'item' * draw.randint(5, 9)}{i} and {'ab1' * 12}"))
    got = {r.doc_id: r.n_random for r in secrets.scan_secrets(docs(*rows)).collect()}
    assert sum(got[i] for i in range(60)) >= 54
    assert sum(got[100 + i] for i in range(60)) == 0


def test_random_strings_of_any_length_are_reported_among_natural_ones(docs):
    draw = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    upper = letters.upper()
    alphabets = {
        "hex": "0123456789abcdef",
        "base32": letters + "234567",
        "base58": "".join(c for c in upper + letters + "123456789" if c not in "IOl"),
        "base64": upper + letters + "0123456789+/",
        "base64url": upper + letters + "0123456789-_",
    }
    words = ["".join(draw.choices("etaoinshrdlu", k=5)) for _ in range(60)]
    rows = [(i, "/".join(draw.choices(words, k=4)) + f"-{i % 10}") for i in range(3000)]
    sizes, made = (20, 70, 200, 700, 2000, 5000), {}
    for size in sizes:
        for kind, alphabet in alphabets.items():
            if kind == "hex" and size >= 32:  # these are of a base pattern
                continue
            for _ in range(20):
                made[10_000 + len(made)] = size, kind
                rows.append((9_999 + len(made), "".join(draw.choices(alphabet, k=size - 2)) + "a2"))
    got = {r.doc_id: r.n_random for r in secrets.scan_secrets(docs(*rows)).collect()}
    assert sum(got[i] for i in range(3000)) == 0
    for group in set(made.values()):
        assert sum(got[i] for i, g in made.items() if g == group) >= 16, group


def test_nothing_to_test(docs, plan):
    found = secrets.scan_secrets(docs((1, "plain"), (None, None), (1, "plain")))
    assert [(r.n_random, r.base, r.spans) for r in found.collect()] == [(0, [], [])] * 3
    assert secrets.scan_secrets(docs()).collect() == []
    assert "Python" not in plan(found) and "Arrow" not in plan(found)


def test_many_matches_in_one_text(docs):
    token = "k9Zq3vXw7Lr1Tn5Bd8Yh"
    text = f"token=12345678 {token} secret={token} " * 34_000
    began = time.monotonic()
    (got,) = secrets.scan_secrets(docs((1, text))).collect()
    assert time.monotonic() - began < 60
    step = len(text) // 34_000
    assert got.n_assign == 68_000
    assert [(s.start, s.end) for s in got.base[:3]] == [(0, 14), (36, 63), (step, step + 14)]
    assert [(s.start, s.end) for s in got.base[-2:]] == [(33_999 * step, 33_999 * step + 14), (33_999 * step + 36, 34_000 * step - 1)]
    assert got.n_random in (0, 34_000)  # equal strings have equal p-values; those in base spans are none


def test_p_values_and_step_up_agree(docs):
    draw = random.Random(14)
    kinds = ["0123456789abcdef", "ab1", "ABCDEF0123456789", "abcdefghijklmnopqrstuvwxyz234567", "aZ09+/_-", "etaoin5"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(draw.randint(0, 4)):
            word = "".join(draw.choices(draw.choice(kinds), k=draw.randint(15, 90)))
            words.append(draw.choice([word, word, f"token={word}", f"x {word}.{word}"]))
        rows.append((i, " ".join(words)))
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans] for r in secrets.scan_secrets(docs(*rows)).collect()}
    tests = []
    for i, text in rows:
        base = plain.secrets(text)
        for m in re.finditer(secrets.CANDIDATE, text):
            if not any(a < m.end() and m.start() < b for a, _, b in base):
                tests.append((i, m.start(), m.end(), plain.random_p(m[0], secrets.ENCODINGS)))
    wanted = {i: plain.secrets(text) for i, text in rows}
    unsure = set()
    for size in {(b - a).bit_length() for _, a, b, _ in tests}:
        of = sorted((t for t in tests if (t[2] - t[1]).bit_length() == size), key=lambda t: t[3])
        passed = [t[3] for n, t in enumerate(of, 1) if t[3] * len(of) <= secrets.FALSE_DISCOVERIES * n]
        edge = max(passed, default=0.0)
        for i, a, b, p in of:
            if p > edge:
                wanted[i].append((a, 3, b))
            if edge and edge / 1.02 < p < edge * 1.03:  # a bin of the histogram is a hundredth wide
                unsure.add(i)
    assert len(unsure) < 20 and sum(len(w) for w in wanted.values()) > 100
    for i, _ in rows:
        if i not in unsure:
            assert got[i] == sorted(wanted[i]), i
