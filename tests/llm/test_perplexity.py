"""Base rules and the language model against versions with plain dictionaries."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tableprofile.llm import perplexity as P

SPACE = r"[\x20\x09-\x0D]+"


def brute_counts(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.sub(SPACE, "", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


TEXTS = [
    "", " ", "\n\n", "a", "one two three", "a b c a b c a b c", "x\nx\nx \n\nx\r\nx\r", "#*$ %&|<> é中\U0001F600", "a b a b a b a b", "\ttab\x0bvt\x0cff  b \n",
    "é\xa0é   ok", "w " * 60, "\x00 \x00",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert P.base_counts(np.frombuffer(text.encode(), np.uint8)) == brute_counts(text)


def brute_symbols(text):
    words = [w for w in re.split(SPACE, text or "") if w]
    return [0xFFFF if c >= "￿" or c == "\0" else ord("0") if c in "0123456789" else ord(c) + 32 * ("A" <= c <= "Z") for w in words for c in w + " "]


@pytest.mark.parametrize("text", [*TEXTS, "  Two  WORDS 19\n", "É"])
def test_symbols(text):
    assert P.symbols(np.frombuffer(text.encode(), np.uint8)).tolist() == brute_symbols(text)


def brute_model(texts):
    """bits per symbol of a text, by the textbook formulas over tuples."""
    counts = {4: Counter()}
    for t in texts:
        s = [0] * 3 + brute_symbols(t)
        counts[4].update(tuple(s[i : i + 4]) for i in range(len(s) - 3))
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discount = {}
    for n, c in counts.items():
        k = [sum(v == i for v in c.values()) for i in range(1, 5)]
        d = [0.5, 1.0, 1.5]
        if all(k):
            y = k[0] / (k[0] + 2 * k[1])
            own = [i - (i + 1) * y * k[i] / k[i - 1] for i in range(1, 4)]
            d = own if all(0 < x < i + 1 for i, x in enumerate(own)) else d
        discount[n] = d
    under = {n: defaultdict(list) for n in counts}
    for n, c in counts.items():
        for g, v in c.items():
            under[n][g[:-1]].append(v)

    def p(g):
        n = len(g)
        if not n:
            return 1 / (len(counts[1]) + 1)
        of = under[n].get(g[:-1])
        if not of:
            return p(g[1:])
        d, c = discount[n], counts[n][g]
        left = sum(d[min(v, 3) - 1] for v in of) / sum(of)
        return (c - d[min(c, 3) - 1] if c else 0) / sum(of) + left * p(g[1:])

    def bits(text):
        s = brute_symbols(text)
        framed = [0] * 3 + s
        return -sum(math.log2(p(tuple(framed[i : i + 4]))) for i in range(len(s))) / len(s) if s else None

    return bits


def some_texts(n, letters, seed):
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.choice([1, 2, 3, 5]))) for _ in range(40)]
    return [" ".join(r.choice(words) for _ in range(r.choice([0, 3, 60, 80, 120]))) for _ in range(n)]


SCHEMA = "doc_id long, text string, lang string, id long, l long, n long, log2 long, step long, unit long, kind long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1, 1, 1) for r in rows], SCHEMA)


def made():
    rows = [(i, t, "xx") for i, t in enumerate(some_texts(60, "abcde", 1))] + [(100 + i, t, None) for i, t in enumerate(some_texts(40, "éüñz中", 2))]
    rows += [(200, None, "xx"), (201, "", None), (None, "no id " * 30, "xx"), (5, "twice " * 55, "xx"), (5, "twice " * 55, "xx"), (202, "of its own", "yy"), (203, "QZ 19 " * 40 + "\U0001F600", "xx")]
    return rows


@pytest.mark.parametrize("max_entries", [1 << 21, 3000])
def test_rules(spark, max_entries):
    """Bits and verdicts of all rows; the second case reads the model in several parts."""
    rows = made()
    got = P.quality_rules(frame(spark, rows), max_entries=max_entries).collect()
    models = {lang: brute_model([t for _, t, x in rows if (x or "") == lang]) for lang in ("xx", "", "yy")}
    want, steps = [], defaultdict(list)
    for id, t, lang in rows:
        counts = brute_counts(t)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        bits = models[lang or ""](t)
        if not failed:
            steps[lang or ""].append(math.floor(bits * 1024))
        want.append((id, counts, failed, bits, lang or ""))
    bands = {}
    for lang, s in steps.items():
        half = (len(s) + 1) // 2 - 1
        mid = sorted(s)[half]
        spread = sorted(abs(x - mid) for x in s)[half]
        bands[lang] = mid - max(12 * spread, 512), mid + max(12 * spread, 512)
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), r[1][0], r[1][1])
    mine = sorted(((r["doc_id"], tuple(r[c] for c in P.COUNTS), r["base_failed"], r["bits"], r["kept"]) for r in got), key=key)
    for a, (id, counts, failed, bits, lang) in zip(mine, sorted(want, key=key)):
        assert a[:3] == (id, counts, failed)
        assert a[3] is None if bits is None else abs(a[3] - bits) < 1e-9
        assert a[4] == (not failed and bands[lang][0] <= math.floor(bits * 1024) <= bands[lang][1])


def test_unseen_symbols_and_contexts():
    tables = {"xx": (np.sort(P.Model.hashes(0, np.zeros(1, np.uint64))), np.array([-8.0]))}
    model = P.Model(tables, 0, np.zeros(P.UNITS, np.int64))
    assert model.log2("xx", P.grams(P.symbols(np.frombuffer(b"ab", np.uint8)))) == -24.0
    assert model.log2("zz", P.grams(P.symbols(np.frombuffer(b"ab", np.uint8)))) == 0.0


def test_counts_with_little_memory(spark):
    """Merging and sending early gives the same counts."""
    rows = frame(spark, made()).selectExpr("coalesce(lang, '') as lang", "encode(coalesce(text, ''), 'UTF-8') as text")
    few, many = ({(r[0], r[1]): r[2] for r in P.gram_counts(rows, p, h).collect()} for p, h in ((50, 100), (1 << 20, 1 << 21)))
    assert few == many and sum(few.values()) == sum(len(brute_symbols(t)) for _, t, _ in made())


def test_gibberish_is_rejected_and_empty_table(spark):
    r = random.Random(4)
    clean = some_texts(200, "abcde", 1)
    odd = " ".join("".join(r.choice("qwxyz") for _ in range(6)) for _ in range(90))
    rows = [(i, t + " " + t[::-1], "xx") for i, t in enumerate(clean)] + [(999, odd, "xx")]
    kept = {x["doc_id"]: x["kept"] for x in P.quality_rules(frame(spark, rows)).where("not base_failed").collect()}
    assert not kept.pop(999) and all(kept.values()) and len(kept) > 50
    assert P.quality_rules(frame(spark, [])).collect() == []
