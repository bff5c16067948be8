"""Periodic runs beside brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from danji.llm.periodic_runs import WaveletTree, periodic_runs, repeated_tails, suffix_array, word_runs
from danji.llm.queries import op12_periodic_runs
from tests.llm.helpers import documents, prose, rows_of


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words):
    """Every maximal stretch of a period that is long enough and has no smaller period."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = any(all(words[start + j] == words[start + j + p] for j in range(length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((start, length, q))
    return sorted((s, n, q) for s, n, q in out)


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(seed):
    r = random.Random(seed)
    words = []
    for _ in range(r.randrange(6)):
        letters = r.choice(["ab", "abc", [f"w{i}" for i in range(50)]])
        piece = [r.choice(letters) for _ in range(r.randrange(1, 25))]
        words += (piece * r.randrange(1, 8))[: r.randrange(1, 120)]
    return "".join(w + r.choice([" ", " ", "\n", "\t "]) for w in words)


ODD = [
    (0, None), (1, ""), (2, " \t\n"), (3, "a a a a a"), (4, "a a a a a a"), (5, "a b a b a b a"), (6, "a b a b a b a b"),
    (6, " a b  a b a b a b a b\n"), (None, "x " * 9), (7, "a a a a a a b a a a a a a b " * 4), (8, "A a " * 5), (9, "\xa0 \x1c " * 6),
]


@pytest.mark.parametrize("rows", [[(i, planted(i)) for i in range(300)], ODD, []])
def test_runs_equal_brute_force(spark, rows):
    got = rows_of(periodic_runs(documents(spark, rows)))
    want = []
    for doc, text in rows:
        runs = brute(words_of(text))
        want.append((doc, runs, collapsed(words_of(text), runs)))
    assert sorted([(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got], key=str) == sorted(want, key=str)
    assert any(runs for _, runs, _ in want) or not rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(i, planted(i) if i % 2 else prose(i, 3 + i % 60)) for i in range(250)] + ODD
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc, text in rows:
        words = words_of(text)
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute(words)
        s, n, q = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append({
            "doc_id": doc, "n_runs": len(runs), "start": s, "length": n, "period": q, "exponent_milli": 1000 * n // q if runs else None,
            "runs_sha256": sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), "collapsed_sha256": sha(collapsed(words, runs)),
        })
    got = rows_of(op12_periodic_runs(spark, str(tmp_path)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_tails_are_repeated_only_where_chosen(spark):
    rows = [(i, prose(i, 40)) for i in range(60)] + [(None, "a b"), (20, ""), (20, None)]
    got = repeated_tails(documents(spark, rows)).collect()
    chosen = {i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0}
    assert chosen and sorted(((r.doc_id, r.text) for r in got if r.doc_id not in chosen), key=str) == sorted((r for r in rows if r[0] not in chosen), key=str)


def test_a_text_that_is_long_and_periodic_as_a_whole(spark):
    period = [f"w{i}" for i in range(30_000)]
    row = rows_of(periodic_runs(spark.createDataFrame([(1, " ".join(period * 5))], "doc_id string, text string").select(F.lit("k").alias("doc_id"), "text")))[0]
    assert [tuple(x) for x in row["runs"]] == [(0, 150_000, 30_000)] and row["collapsed"] == " ".join(period)


def test_wavelet_tree_and_suffix_array():
    r = np.random.default_rng(3)
    values = r.permutation(500)
    tree = WaveletTree(values, 501)
    for _ in range(200):
        a, b, x = (int(v) for v in r.integers(0, 501, 3))
        a, b = min(a, b), max(a, b)
        bigger = sorted(v for v in values[a:b].tolist() if v > x)
        got = tree.successors(np.array([a]), np.array([b]), np.array([x]))[0]
        assert got == (bigger[0] if bigger else -1)
    codes = r.integers(0, 3, 300)
    order, place, level = suffix_array(codes, 3)
    text = codes.tolist()
    assert [text[i : i + 8] for i in order] == sorted(text[i : i + 8] for i in range(300))
    for j in range(1, 300):
        a, b = order[j - 1], order[j]
        assert level[j] == next((k for k in range(4) if text[a : a + 2**k] != text[b : b + 2**k]), 4)
    assert place[order].tolist() == list(range(300))
    assert word_runs(np.zeros(0, np.int32), np.zeros(1, np.int64))[0].tolist() == []
