"""Exact duplicates and the mixture, beside brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from danji.llm import exact_dedup
from danji.llm.common import marks, with_mark
from danji.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from danji.llm.mixing import mixture
from tests.llm.helpers import documents, prose, rows_of

TEXTS = [
    (1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, "ab "), (5, ""), (6, None), (7, " \x0b\x0c\r"), (8, "a\u00a0b"),
    (9, "x" * 300 + "1"), (10, "x" * 300 + "2"), (11, "x" * 300 + " 1"), (12, prose(1, 30_000)), (13, prose(1, 30_000)),
    (14, "ba"), (15, "Ab"), (None, "only"), (None, "ab"),
]


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((doc, text or ""))
    out = []
    for bare, members in groups.items():
        keep = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0]))[0][0]
        for doc, _ in members:
            out.append((doc, keep, len(members), doc == keep, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_duplicates(spark, digest_all):
    got = exact_duplicates(documents(spark, TEXTS), digest_all=digest_all).collect()
    want = brute(TEXTS)
    if digest_all:
        assert sorted([tuple(r) for r in got], key=str) == want
    else:
        assert sorted([tuple(r)[:4] for r in got], key=str) == sorted([w[:4] for w in want], key=str)
        # Texts settled by length or beginning are not hashed in full.
        assert {r.doc_id for r in got if r.text_sha256 is None} == {8, 14, 15, None}


def test_exact_duplicates_repeated_rows_and_empty_table(spark):
    rows = [(1, "same"), (1, "same"), (2, "s ame"), (3, "lone")]
    assert sorted([tuple(r)[:4] for r in exact_duplicates(documents(spark, rows)).collect()]) == [
        (1, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True), (3, 3, 1, True)
    ]
    assert exact_duplicates(documents(spark, []), digest_all=True).count() == 0


def test_of_a_repeated_id_only_the_row_that_stays_is_kept(spark):
    rows = [(7, "a b"), (7, "ab"), (8, "ab"), (9, "c"), (9, "c"), (9, " c")]
    for digest_all in (True, False):
        got = exact_duplicates(documents(spark, rows), digest_all=digest_all).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [
            (7, 7, 3, False), (7, 7, 3, True), (8, 7, 3, False), (9, 9, 3, False), (9, 9, 3, False), (9, 9, 3, True)
        ]
    same = [(9, "same"), (9, "same")]
    assert sorted(r.kept for r in exact_duplicates(documents(spark, same), digest_all=True).collect()) == [False, True]


def test_ids_may_be_strings(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("a", "y x"), (None, "xy ")], "name string, body string")
    got = exact_duplicates(docs, "name", "body", True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.kept) for r in got), key=str) == [("a", "a", True), ("a", "b", False), ("b", "b", True), (None, "b", False)]
    assert sorted(r.body for r in drop_exact_duplicates(docs, "name", "body").collect()) == ["x y", "y x"]


def test_only_texts_that_share_length_and_start_are_hashed(spark):
    rows = [(i, prose(i, 30 + i)) for i in range(200)] + [(500, prose(5, 35)), (501, "x" * 300 + "1"), (502, "x" * 300 + "2")]
    docs = documents(spark, rows)
    scanned = exact_dedup._scan(docs, "doc_id", "text", F.lit(None).cast("string"))
    hashed = exact_dedup._hashed(docs, "doc_id", "text", exact_dedup._shared_starts(scanned))
    assert sorted(r.doc_id for r in hashed.collect()) == [5, 500, 501, 502]


def test_a_bitmap_holds_its_keys(spark):
    rows = spark.range(20_000).selectExpr("id as a", "cast(id % 7 as string) as b")
    found = with_mark(rows, marks(rows.where("a % 3 = 0"), "a", "b"), rows["a"], rows["b"])
    assert found.where("a % 3 = 0 and not marked").count() == 0 and found.where("a % 3 <> 0 and marked").count() < 20
    assert with_mark(rows, marks(rows.where("a < 0"), "a"), rows["a"]).where("marked").count() == 0


def test_drop_exact_duplicates_keeps_columns(spark):
    docs = documents(spark, TEXTS[:8])
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 7, 8]


def test_drop_exact_duplicates_judges_rows(spark):
    # Null ids, ids with several texts, and rows that repeat both.
    rows = TEXTS + [(20, "lone"), (20, " a b "), (1, "one of id 1"), (30, "twice"), (30, "twice"), (31, "tw ice"), (32, "fully"), (32, "fully"), (None, "nul"), (None, "nul")]
    docs = documents(spark, rows)
    left = drop_exact_duplicates(docs)
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((-len(text or ""), doc is None, doc or 0))
    want = [(bare, *min(members)) for bare, members in groups.items()]
    got = [(re.sub("[\x20\x09-\x0d]", "", r.text or ""), -len(r.text or ""), r.doc_id is None, r.doc_id or 0) for r in left.collect()]
    assert left.columns == docs.columns and sorted(got) == sorted(want)


WEIGHTS = {"lang": {"en": 3, "de": 1}, "source": {"s1": 2, "s2": 1, "s3": 1}}


def mixed(spark, rows, **more):
    docs = documents(spark, rows)
    return rows_of(mixture(docs, {"lang": F.col("lang"), "source": F.col("source")}, WEIGHTS, F.length("text"), **more))


def deal(budget, children):
    """Brute force: pour whole shares until every child is full or nothing is left to pour."""
    given = {c: 0 for c in children}
    while True:
        open_ = [c for c in children if given[c] < children[c][1] and children[c][0]]
        left, weight = budget - sum(given.values()), sum(children[c][0] for c in open_)
        if not open_ or not left:
            return given
        full = [c for c in open_ if children[c][1] - given[c] <= left * children[c][0] / weight]
        if not full:
            for c in open_:
                given[c] += left * children[c][0] // weight
            spare = budget - sum(given.values())
            for c in sorted(open_, key=lambda c: (-(left * children[c][0] % weight), c))[:spare]:
                given[c] += 1
            return given
        for c in full:
            given[c] = children[c][1]


def taken(rows):
    out = {}
    for r in rows:
        key = (r["lang"], r["source"])
        out[key] = out.get(key, 0) + r["epochs"] * r["tokens"] + r["tail_tokens"]
    return out


def test_budgets_go_to_siblings_first(spark):
    sizes = {("en", "s1"): 10, ("en", "s2"): 400, ("en", "s3"): 300, ("de", "s1"): 5, ("de", "s2"): 7}
    rows, i = [], 0
    for (lang, source), n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i, "x" * (1 + i % 7), lang, source))
    tokens = {}
    for _, text, lang, source in rows:
        tokens[lang, source] = tokens.get((lang, source), 0) + len(text)
    for budget, epochs in ((1000, 2), (300, 1), (10**6, 3), (0, 2)):
        got = taken(mixed(spark, rows, budget=budget, max_epochs=epochs, seed=3))
        caps = {k: v * epochs for k, v in tokens.items()}
        langs = {lang: sum(v for k, v in caps.items() if k[0] == lang) for lang in ("en", "de")}
        top = deal(min(budget, sum(caps.values())), {k: (WEIGHTS["lang"][k], c) for k, c in langs.items()})
        want = {}
        for lang in langs:
            below = {s: (WEIGHTS["source"][s], caps[lang, s]) for (g, s) in sizes if g == lang}
            want |= {(lang, s): n for s, n in deal(top[lang], below).items()}
        assert got == want and sum(got.values()) == min(budget, sum(caps.values()))


def test_no_token_of_a_budget_is_left_over(spark):
    rows = [(i, "x" * 1000, "en", f"s{1 + i % 3}") for i in range(9)]
    got = rows_of(mixture(documents(spark, rows), {"source": F.col("source")}, {}, F.length("text"), budget=100))
    assert sum(r["epochs"] * r["tokens"] + r["tail_tokens"] for r in got) == 100


def test_prefix_follows_the_seeded_order(spark):
    rows = [(i, "x" * 10, "en", "s1") for i in range(50)]
    got = mixed(spark, rows, budget=125, max_epochs=2, seed=1)
    order = sorted(range(50), key=lambda i: hashlib.md5(f"1|0|{i}".encode()).hexdigest())
    assert {r["doc_id"] for r in got if r["tail_tokens"] == 10} == set(order[:12])
    assert {r["doc_id"] for r in got if r["tail_tokens"] == 5} == {order[12]}
    other = mixed(spark, rows, budget=125, max_epochs=2, seed=2)
    assert {r["doc_id"] for r in other if r["tail_tokens"]} != {r["doc_id"] for r in got if r["tail_tokens"]}


def test_mixture_of_nulls_and_nothing(spark):
    rows = [(None, None, None, None), (None, "abc", None, "s1"), (1, "", "en", "s1"), (1, "", "en", "s1")]
    got = mixed(spark, rows, budget=2, max_epochs=1)
    assert len(got) == 4 and sum(r["tail_tokens"] for r in got) == 2
    assert mixed(spark, [], budget=5) == []
