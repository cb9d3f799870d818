"""The prefix trie against a brute-force version that keeps whole prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tableprofile.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, ids long, bytes long, head long, path long, key long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            id = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, id, role, text))
    for turns in own.values():
        turns.sort()
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(c - 5 * int(c / 5)), [])
        whole = [t[3:] for t in base[:h] + own[c][h:]]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, len(whole) == d))
    out = []
    for node, m in members.items():
        below = [k for k in members if k[: len(node)] == node]
        parents = {k[:-1] for k in members if k}
        ends = ",".join(map(str, sorted(c for c, last in m if last)))
        out.append((
            min(c for c, _ in m), len(node), min(c for c, _ in members[node[:-1]]) if node else None, len(m),
            sum(len(k) == len(node) + 1 for k in below), sum(k not in parents for k in below),
            sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, longest, n=120):
    """Few different turns, so that many conversations share long prefixes or are equal; one can be long."""
    random.seed(seed)
    rows = []
    for c in random.sample(range(-30, 400), n):
        length = longest if c % 50 == 7 else random.choice([1, 2, 3, 5, 6])
        for turn in range(length):
            rows.append((c, turn, "user" if turn % 2 else "assistant", random.choice(["a", "é", "long text", ""]) if turn > 2 else "same"))
    return rows


@pytest.mark.parametrize("max_turns, few, longest", [(50_000, 16, 150), (60, 4, 150), (0, 0, 8)])
def test_nodes(spark, max_turns, few, longest):
    rows = made(max_turns, longest)
    assert got(trie.prefix_trie(frame(spark, rows), max_turns=max_turns, few=few)) == brute(rows)


def test_edges(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "y"), (None, 0, "user", "lost"), (2, 5, "user", "é" * 5000),
        (8, 0, "user", "goes when the first turns are replaced by none"), (10, 1, "a:b", "c"), (11, 1, "a", "b:c"),
    ]
    for settings in ({}, {"max_turns": 0, "few": 0}):
        assert got(trie.prefix_trie(frame(spark, rows), **settings)) == brute(rows)
    assert any(r[1] == 0 for r in brute(rows))
    assert got(trie.prefix_trie(frame(spark, []))) == []


def test_one_very_common_conversation(spark):
    """Equal conversations are one sequence with all members, also over many id ranges."""
    rows = [(c * 5 * 997, t, "user", f"turn {t}") for c in range(3000) for t in range(3)]
    found = {r["depth"]: r for r in trie.prefix_trie(frame(spark, rows)).collect()}
    assert len(found) == 4 and all(r["n_convs"] == 3000 and r["conv_id"] == 0 for r in found.values())
    assert found[3]["ends_sha256"] == hashlib.sha256(",".join(str(c * 5 * 997) for c in range(3000)).encode()).hexdigest()
    assert found[0]["saved_tokens"] == 2999 * 3 * 6 and found[0]["n_leaves"] == 1
