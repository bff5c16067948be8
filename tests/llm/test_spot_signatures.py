"""Spot signatures beside sets of tuples, and the comparison of neighbours beside a list in order."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from danji.llm import spot_signatures as spots
from danji.llm.queries import op13_spot_signatures
from danji.llm.spot_signatures import ANCHORS, CHAIN, Spotter, compared_in_order, jaccard, likeness, read, spot_classes, spot_signatures
from tests.llm.helpers import documents, rows_of

NAMES = "alder birch cedar elm fir gum hazel ivy juniper larch maple oak pine rowan spruce tamarack willow yew".split()


def talk(seed, words):
    r = random.Random(seed)
    said = [r.choice(ANCHORS) if r.random() < 0.3 else r.choice(NAMES) + str(r.randrange(40)) for _ in range(words)]
    return " ".join(w.title() + r.choice(["", "", ",", "."]) for w in said)


def multiset(text):
    """Spots as tuples, counted."""
    words = [w for w in (x.lower().strip(spots.EDGES) for x in text.split()) if w]
    found = Counter()
    for i, w in enumerate(words):
        chain = [x for x in words[i + 1 :] if x not in ANCHORS][:CHAIN]
        if w in ANCHORS and words[i + 1 : i + 2] != [w] and len(chain) == CHAIN:
            found[w, *chain] += 1
    return found


def by_counts(a, b):
    return sum((a & b).values()) / sum((a | b).values())


ODD = [
    (0, None), (1, ""), (2, " \n"), (3, "x"), (4, "x"), (5, "the"), (6, "*** ---"), (7, "the the the of"), (8, "é" * 50_000), (9, talk(9, 30_000)),
    (9, "again nine"), (9, talk(9, 30_000)), (None, "no id"), (None, "no id at all"), (None, None), (-3, "der x und y die z"), (11, "\U0001f600\U0001f600 a"),
]


def test_fingerprints_stand_for_the_spots():
    texts = [talk(i // 3, 60 + i) if i % 3 else talk(i, 90) + " " + talk(i + 1, 80) for i in range(60)] + ["the elm oak " * 30]
    prints = Spotter(ANCHORS, CHAIN).fingerprints(pa.array(texts))
    for text, mark in zip(texts, prints):
        assert len(mark.spots) == sum(multiset(text).values())
        again = read(str(mark))
        assert all((x is None and y is None) or x.tolist() == y.tolist() for x, y in zip(mark, again))
    pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            if min(len(prints[i].spots), len(prints[j].spots)) >= spots.FEW_SPOTS:
                assert likeness(prints[i], prints[j]) == by_counts(multiset(texts[i]), multiset(texts[j]))
                pairs += likeness(prints[i], prints[j]) > 0
    assert pairs


def test_pruned_jaccard_is_jaccard():
    r = np.random.default_rng(1)
    for _ in range(500):
        a, b = (np.unique(r.integers(0, r.integers(2, 60), r.integers(0, 40)).astype(np.uint64)) for _ in range(2))
        x, y = set(a.tolist()), set(b.tolist())
        want = len(x & y) / len(x | y) if x | y else 1.0
        least = float(r.random())
        assert jaccard(a, b) == want
        assert jaccard(a, b, least) == (want if want >= least else 0.0)


@pytest.mark.parametrize("rows", [[(i, talk(i, 5 + i)) for i in range(120)] + [(500 + i, talk(7, 200)) for i in range(40)], ODD, ODD[3:4], []])
def test_neighbours_in_order(spark, rows):
    got = rows_of(compared_in_order(documents(spark, rows)))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -signed(r[1] or "")))
    spotter = Spotter(ANCHORS, CHAIN)
    want = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, c = spotter.fingerprints(pa.array([text, edited, after], pa.large_string()))
        want.append({
            "doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(), "fingerprint": str(a),
            "edited_fingerprint": str(b), "near_edited": likeness(a, b), "near_next": likeness(a, c),
        })
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def test_the_query_tells_edits_from_other_texts(spark, tmp_path):
    rows = [(i, talk(i, 20 + 3 * i)) for i in range(150)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = rows_of(op13_spot_signatures(spark, str(tmp_path)))
    assert len(got) == 150 and min(r["near_edited"] for r in got) > 0.25 and max(r["near_next"] for r in got) < 0.15
    alike = {r["doc_id"]: r["fingerprint"] for r in rows_of(spot_signatures(documents(spark, rows)))}
    assert alike == {r["doc_id"]: r["fingerprint"] for r in got}


def test_equal_texts_have_equal_fingerprints_wherever_they_lie(spark):
    rows = [(i, talk(i % 5, 400)) for i in range(40)] + ODD
    prints = {r["doc_id"]: r["fingerprint"] for r in rows_of(spot_signatures(documents(spark, rows[:40])))}
    assert len(set(prints.values())) == 5
    assert rows_of(spot_signatures(documents(spark, [(1, "")])))[0]["fingerprint"] == "||"
    assert spot_signatures(documents(spark, [])).count() == 0
    assert spot_signatures(documents(spark, ODD)).count() == len(ODD)


def test_classes_equal_brute_force(spark):
    r = random.Random(2)
    rows = []
    for family in range(12):
        words = talk(family, 150 + 20 * family).split(" ")
        for k in range(9):
            copy = list(words)
            for _ in range(r.choice([0, 1, 2, 4, 8])):
                copy[r.randrange(len(copy))] = f"other{r.randrange(9)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, "no spots"), (1003, rows[4][1])]
    sets = {i: multiset(t or "") for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * sum((sets[a] & sets[b]).values()) >= 80 * sum((sets[a] | sets[b]).values()):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: (r["n_spots"], r["class_id"]) for r in rows_of(spot_classes(documents(spark, rows)))}
    assert got == {i: (sum(s.values()), find(i)) for i, s in sets.items()}
    assert 12 < len({c for _, c in got.values()}) < len(rows)
    assert spot_classes(documents(spark, [])).count() == 0
