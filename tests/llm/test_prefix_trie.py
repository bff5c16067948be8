"""The conversations' prefix trie beside brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from danji.llm.prefix_trie import coded_turns, prefix_trie, rebuilt, sequences, trie
from tests.llm.helpers import rows_of

COLUMNS = "conv_id bigint, turn bigint, role string, text string, ids string, words int, part int, depth string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], COLUMNS)


def sorted_turns(rows):
    """conversation -> its turns (role, text) in order."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    return {conv: [t[2] for t in sorted(turns)] for conv, turns in found.items()}


def brute(paths):
    members = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[tuple(path[:depth])].append(conv)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in ids if len(paths[c]) == len(path))
        out.append({
            "conv_id": min(ids), "depth": len(path), "parent_conv_id": min(members[path[:-1]]) if path else None,
            "n_convs": len(ids), "n_children": sum(len(p) == len(path) + 1 for p in below),
            "n_leaves": sum(not any(q[:-1] == p and q for q in below) for p in below),
            "saved_tokens": sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p),
            "ends_sha256": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        })
    return out


def same(got, want):
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(got, key=key) == sorted(want, key=key)


def random_rows(seed, convs=60):
    r = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(r.randrange(1, 9)):
            rows.append((conv, turn, r.choice(["user", "bot"]), r.choice(["a", "b c", "d  e\tf"])))
    # One conversation over and over, and a long one with copies of its beginning.
    rows += [(100 + i, t, "user", f"same {t}") for i in range(40) for t in range(3)]
    rows += [(c, t, "user", f"long {t}") for c, n in ((200, 70), (201, 70), (202, 35)) for t in range(n)]
    r.shuffle(rows)
    return rows


ODD = [
    (1, None, None, None), (1, None, "user", "x"), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, None, "", ""), (2, None, "user", "x"),
    (None, 0, "user", "gone"), (3, 5, "user", "  one word"), (3, -1, "user", "é" * 100_000), (4, 0, "us", "erx"), (5, 0, "user", "x"),
    (-7, 0, "user", "x"),
]


@pytest.mark.parametrize("rows", [random_rows(1), ODD, ODD[:1]])
def test_trie_equals_brute_force(spark, rows):
    same(rows_of(prefix_trie(conversations(spark, rows))), brute(sorted_turns(rows)))


@pytest.mark.parametrize("turns, members", [(1, 1), (7, 100), (100, 3)])
def test_nodes_on_the_edges_of_blocks_are_merged(spark, turns, members):
    rows = random_rows(turns)
    got = trie(sequences(coded_turns(conversations(spark, rows))), turns, members)
    same(rows_of(got), brute(sorted_turns(rows)))


def test_rebuilt_conversations_may_be_empty(spark):
    rows = [(20, 0, "u", "a"), (20, 1, "u", "b"), (21, 0, "u", "c"), (22, 0, "u", "c"), (22, 1, "u", "d"), (22, 2, "u", "e"), (45, 0, "u", "z")]
    paths = sequences(coded_turns(conversations(spark, rows)))
    got = trie(rebuilt(paths, F.lit(2), F.col("conv_id") - F.col("conv_id") % 20, 3))
    a, b, e = ("u", "a"), ("u", "b"), ("u", "e")
    same(rows_of(got), brute({20: [a, b], 21: [a, b], 22: [a, b, e], 45: []}))


def test_no_conversations_no_nodes(spark):
    assert prefix_trie(conversations(spark, [])).count() == 0
    assert prefix_trie(conversations(spark, [(None, 0, "user", "x")])).count() == 0
