"""URL reputation, nearest neighbours, toxicity and the similarity join, beside brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from danji.llm import jaccard_join, kmeans_tree, toxic_crf
from danji.llm.common import connected_components
from danji.llm.host_reputation import SUFFIXES, Rule, judge_urls, with_levels
from danji.llm.jaccard_join import drop_similar, similar_components
from danji.llm.kmeans_tree import nearest
from danji.llm.toxic_crf import WORD, learn, toxicity, train
from tests.llm.helpers import EXTRA, CLASHING, changed, documents, prose, rows_of

RULES = [Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/")]


def judged(spark, urls, bad=(), most_bad=0.5):
    pages = spark.createDataFrame([(*u, *EXTRA) for u in urls], f"page_id bigint, url string, {CLASHING}")
    outcomes = spark.createDataFrame(list(bad), "doc_id bigint, bad int")
    return {r["page_id"]: r for r in rows_of(judge_urls(pages, outcomes, RULES, most_bad))}


def test_url_parts_and_rules(spark):
    got = judged(spark, [
        (1, "http://A.Example.COM/en/x?q#f"), (2, "https://www.example.com/en/"), (3, "https://example.com"), (4, "http://x.net/es/a"),
        (5, "http://notexample.com/en/"), (6, "no scheme/en/"), (7, None), (8, ""), (9, "http://É.com#a/b"), (10, "x://y://z/w"), (11, "http://net/es/"),
        (12, "http://example.com?x=/en/"),
    ])
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(1, 13)] == [
        ("a.example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("example.com", "", None, "allow"), ("x.net", "/es/a", "net/es/", "block"), ("notexample.com", "/en/", "com/", "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("É.com", "", None, "allow"),
        ("y:", "//z/w", None, "allow"), ("net", "/es/", "net/es/", "block"), ("example.com", "", None, "allow"),
    ]


def test_reputation_shrinks_and_filters(spark):
    urls, bad, i = [], [], 0
    for host, pages, rate in (("bad.org", 60, 0.95), ("good.org", 60, 0.0), ("few.other.org", 1, 1.0), ("new.bad.org", 0, 0), ("new.fresh.io", 0, 0)):
        for k in range(max(pages, 1)):
            urls.append((i, f"http://{host}/{i}"))
            if pages:
                bad.append((i, int(k < rate * pages)))
            i += 1
    got = judged(spark, urls + [(None, "http://bad.org/")], bad + [(0, None), (0, 0)])
    verdicts = {r["host"]: r["verdict"] for r in got.values()}
    assert verdicts["bad.org"] == "block" and verdicts["good.org"] == "allow" and verdicts["new.fresh.io"] == "allow"
    assert judged(spark, [], []) == {} and judged(spark, [(1, "http://a.org/")])[1]["verdict"] == "allow"


def test_sites_domains_and_suffixes(spark):
    hosts = ["bad.example.org:8080", "u:p@bad.example.org", "a.b.co.uk", "b.co.uk.", "co.uk", "10.0.0.1:80", "[2001:db8::1]:443", "", "localhost", "x.org"]
    got = {r["host"]: (r["site"], r["domain"], r["suffix"]) for r in rows_of(with_levels(spark.createDataFrame([(h,) for h in hosts], "host string"), SUFFIXES))}
    assert [got[h] for h in hosts] == [
        ("bad.example.org", "example.org", "org"), ("bad.example.org", "example.org", "org"), ("a.b.co.uk", "b.co.uk", "co.uk"),
        ("b.co.uk", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("10.0.0.1", "10.0.0.1", "10.0.0.1"),
        ("[2001:db8::1]", "[2001:db8::1]", "[2001:db8::1]"), ("", "", ""), ("localhost", "localhost", "localhost"), ("x.org", "x.org", "org"),
    ]


def test_ports_and_users_share_a_reputation_and_rules_may_be_none(spark):
    urls = [(i, f"http://{('', 'me@')[i % 2]}bad.org{('', ':8080', ':1')[i % 3]}/{i}") for i in range(60)] + [(60 + i, f"http://good.org/{i}") for i in range(60)]
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    outcomes = spark.createDataFrame([(i, int(i < 60)) for i in range(50)] + [(i, 0) for i in range(60, 120)], "doc_id bigint, bad int")
    got = rows_of(judge_urls(pages, outcomes, [], 0.5))
    assert all((r["verdict"] == "block") == (r["page_id"] < 60) and r["rule"] is None for r in got) and len(got) == 120


def brute_bounds(pages, z):
    """Lower bounds by host from (host, bad or None) rows."""
    def kappa(units):
        units = [(n, k) for n, k in units if n]
        s, b, m = sum(n for n, _ in units), sum(k for _, k in units), len(units)
        rho = 0.5
        if s and 0 < b < s and m > 1:
            p, room = b / s, s - sum(n * n for n, _ in units) / s - (m - 1)
            if room > 0:
                rho = min(max((sum(n * (k / n - p) ** 2 for n, k in units) / (p * (1 - p)) - (m - 1)) / room, 0.001), 0.999)
        return 1 / rho - 1

    def grouped(counts, key):
        out = {}
        for h, (n, k) in counts.items():
            a = out.setdefault(key(h), [0, 0])
            a[0] += n
            a[1] += k
        return out

    hosts = {}
    for host, bad in pages:
        a = hosts.setdefault(host, [0, 0])
        a[0] += bad is not None
        a[1] += bad or 0
    domains = grouped(hosts, lambda h: ".".join(h.split(".")[-2:]))
    suffixes = grouped(domains, lambda d: d.split(".")[-1])
    rate = (sum(k for _, k in hosts.values()) + 1) / (sum(n for n, _ in hosts.values()) + 2)
    ks, kd, kh = (kappa(x.values()) for x in (suffixes, domains, hosts))
    by_suffix = {s: (k + ks * rate) / (n + ks) for s, (n, k) in suffixes.items()}
    by_domain = {d: (k + kd * by_suffix[d.split(".")[-1]]) / (n + kd) for d, (n, k) in domains.items()}
    out = {}
    for h, (n, k) in hosts.items():
        prior = by_domain[".".join(h.split(".")[-2:])]
        a, b = k + kh * prior, n - k + kh * (1 - prior)
        out[h] = a / (a + b) - z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    return out


def test_reputation_equals_brute_force(spark):
    r = random.Random(6)
    hosts = {f"h{i}.d{i % 7}.{('org', 'io', 'dev')[i % 3]}": r.random() ** 2 for i in range(40)}
    pages = [(i, r.choice([*hosts, "h0.d0.org"])) for i in range(1500)]
    bad = {i: int(r.random() < hosts[h]) for i, h in pages if r.random() < 0.6}
    got = judged(spark, [(i, f"http://{h}/x") for i, h in pages], bad.items(), 0.25)
    bounds = brute_bounds([(h, bad.get(i)) for i, h in pages], 1.2815515655446004)
    assert {got[i]["verdict"] == "block" for i, h in pages} == {True, False}
    assert all((got[i]["verdict"] == "block") == (bounds[h] > 0.25) for i, h in pages)


def vectors(seed, n, dims=16):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(20, dims))
    return (centers[r.integers(0, 20, n)] + 0.6 * r.normal(size=(n, dims))).astype(np.float32)


def brute_nearest(rows, k):
    use = {i: np.array(v, float) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 16}
    ids = sorted(use)
    m = np.array([use[i] for i in ids])
    norms = np.sqrt((m * m).sum(1))
    out = {}
    for q in ids:
        if q % 50 == 0:
            score = (m * use[q]).sum(1) / (norms * np.sqrt((use[q] ** 2).sum()))
            order = sorted((-s, i) for s, i in zip(score, ids) if i != q)[:k]
            out[q] = [(i, -s) for s, i in order]
    return out


def found(spark, rows):
    df = spark.createDataFrame([(i, v, *EXTRA) for i, v in rows], f"vec_id bigint, embedding array<float>, {CLASHING}")
    out = {}
    for r in sorted(rows_of(nearest(df, F.col("vec_id") % 50 == 0)), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF", 40)
    monkeypatch.setattr(kmeans_tree, "BLOCK", 64)
    monkeypatch.setattr(kmeans_tree, "QUERY_BLOCK", 8)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(1, 3000))]
    # A third of the rows are one vector.
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]
    got, want = found(spark, rows), brute_nearest(rows, 5)
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [i for i, _ in got[0]] == [3, 6, 9, 12, 15] and got[0][0][1] == pytest.approx(1.0)
    exact = dict(itertools.chain.from_iterable([((q, i), s) for i, s in v] for q, v in want.items()))
    for q, near in got.items():
        for i, s in near:
            assert (q, i) not in exact or s == pytest.approx(exact[q, i], abs=1e-12)


def test_neighbours_of_odd_vectors(spark):
    v = [1.0] + [0.0] * 15
    rows = [(0, v), (1, None), (2, [0.0] * 16), (3, [math.nan] + v[1:]), (4, [math.inf] + v[1:]), (5, [None] + v[1:]), (6, v), (6, v), (7, [1.0] * 16), (50, [2.0] + v[1:]), (None, v), (8, [1.0])]
    got = found(spark, rows)
    assert {q: [i for i, _ in n] for q, n in got.items()} == {0: [6, 50, 7], 50: [0, 6, 7]}
    assert found(spark, []) == {} and found(spark, [(0, v)]) == {}


def test_neighbours_of_any_magnitude_and_of_two_lengths(spark):
    r = np.random.default_rng(3)
    long, short = r.normal(size=(40, 6)), r.normal(size=(9, 4))
    scale = [1e200, 1e-200, 1.0, 1e-310]
    rows = [(i, (v * scale[i % 4]).tolist()) for i, v in enumerate(long)] + [(100 + 50 * i, v.tolist()) for i, v in enumerate(short)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for x in rows_of(nearest(df, F.col("vec_id") % 50 == 0)):
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    assert sorted(got) == [0, *range(100, 550, 50)]
    for q, near in got.items():
        group, first, step = (long, 0, 1) if q < 100 else (short, 100, 50)
        unit = group / np.linalg.norm(group, axis=1, keepdims=True)
        score = unit @ unit[(q - first) // step]
        order = sorted((-s, first + step * i) for i, s in enumerate(score) if first + step * i != q)[:5]
        assert [i for _, i, _ in sorted(near)] == [i for _, i in order]
        # 1e-310 is too small for all its bits.
        assert np.allclose([s for _, _, s in sorted(near)], [-s for s, _ in order], atol=1e-7)


INSULTS = ["scumbag", "vermin", "lowlife", "jerkface"]


def toxic_rows(n, seed=0):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 10_000 + i, r.randrange(5, 80)).split(" ")
        y = int(i % 4 == 0)
        for _ in range(3 * y):
            words.insert(r.randrange(len(words)), r.choice(INSULTS) + r.choice(["", "s", "ish", "."]))
        rows.append((" ".join(words), y))
    return rows


def test_field_learns_and_marginals_are_exact():
    field, marked, right = train(toxic_rows(300)), [], []
    for text, y in toxic_rows(200, 1):
        score, spans = field.spans(text)
        assert bool(spans) == (score >= 0.5)
        right.append((score >= 0.5) == bool(y))
        marked += [text[a:b].strip(".").lower().startswith(tuple(INSULTS)) for a, b in spans]
    assert sum(right) > 0.97 * len(right) and sum(marked) > 0.95 * len(marked)
    text = toxic_rows(1, 2)[0][0]
    words = WORD.findall(text)[:9]
    emit = [field.bias + field.emission(w) for w in words]
    total, on = 0.0, np.zeros(len(words))
    for path in itertools.product((0, 1), repeat=len(words)):
        s = field.start * path[0] + sum(e * y for e, y in zip(emit, path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))
        total += math.exp(s)
        on += math.exp(s) * np.array(path)
    at = [i for i, w in enumerate(words) if field.emission(w)]
    got = field.marginals(len(words), at, [field.emission(words[i]) for i in at])
    assert np.allclose(got, (on / total)[at])


def test_toxicity_of_a_table(spark):
    rows = [(i, t) for i, (t, _) in enumerate(toxic_rows(300))]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, y, None) for i, (_, y) in enumerate(toxic_rows(300))] + [(None, 1, None), (5, None, None)], "doc_id bigint, toxic int, n int")
    field = learn(docs, labels)
    odd = documents(spark, [(1, None), (2, ""), (3, "  \n"), (4, prose(3, 20_000) + " vermin"), (4, "x"), (None, "you scumbag")])
    got = {(r["doc_id"], r["predicted"]) for r in rows_of(toxicity(odd, field))}
    assert got == {(1, 0), (2, 0), (3, 0), (4, 1), (4, 0), (None, 1)}
    nothing = learn(documents(spark, []), labels)
    assert {r["predicted"] for r in rows_of(toxicity(docs, nothing))} == {0}
    assert toxicity(documents(spark, []), field).count() == 0


def test_the_training_texts_are_bounded_in_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxic_crf, "train", lambda rows: seen.append(rows))
    rows = [(i, "x" * (10 if i % 9 else 5000)) for i in range(90)] + [(200, None)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(200, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    for most in (1 << 20, 6000, 0):
        learn(docs, labels, most_bytes=most)
        assert sum(len(t) for t, _ in seen[-1]) <= most
    # Texts that fit in are taken even after one that doesn't.
    assert len(seen[0]) == 90 and 79 < len(seen[1]) < 90 and {y for _, y in seen[1]} == {0, 1} and seen[2] == []


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        words = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
        sets[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def families():
    r = random.Random(4)
    rows, i = [], 0
    passage = prose(999, 60)
    for f in range(25):
        text = prose(f, r.choice([4, 12, 40, 90, 150]))
        for k in range(r.choice([1, 2, 6, 20])):
            rows.append((i, changed(text, i, r.choice([0, 0, 1, 2, 4])).replace(" ", r.choice([" ", "\n", "  "]))))
            i += 1
    hot = prose(500, 110)
    rows += [(i + k, changed(hot, k, k % 4)) for k in range(160)]
    i += 160
    # Short texts around a passage that many share.
    rows += [(i + k, prose(700 + k, 6 + k % 25) + " " + passage) for k in range(80)]
    i += 80
    rows += [(i, None), (i + 1, ""), (i + 2, " \t"), (i + 3, "One two"), (i + 4, "one  TWO"), (i + 5, "É two"), (i + 6, "é two"), (i + 7, "lone")]
    return rows


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, monkeypatch, width, percent):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rows = families()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(similar_components(documents(spark, rows), width, percent))}
    assert got == brute_components(rows, width, percent)


def template_rows(seed, count, words=80, slots=80, vocabulary=0, changes=(1,)):
    """Copies of one text with some words changed, by new words or those of a small vocabulary."""
    r = random.Random(seed)
    base = prose(seed, words).split(" ")
    rows = []
    for i in range(count):
        text = list(base)
        for k in range(r.choice(changes)):
            text[r.randrange(slots)] = f"v{r.randrange(vocabulary)}" if vocabulary else f"new{i}x{k}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("vocabulary, changes", [(0, (0, 1, 1, 1, 2, 3)), (0, (1,)), (6, (1, 2, 2)), (40, (1, 1, 3, 5))])
@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_components_of_templates_equal_brute_force(spark, monkeypatch, vocabulary, changes, width, percent):
    monkeypatch.setattr(jaccard_join, "BLOCK", 24)
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", 5)
    rows = template_rows(3, 220, vocabulary=vocabulary, changes=changes)
    other = [(1000 + i, t + " " + prose(i, 3 + i % 9)) for i, t in template_rows(4, 60, words=50, slots=12, vocabulary=vocabulary, changes=changes)]
    rows += other + [(2000 + i, t) for i, t in rows[:20]]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(similar_components(documents(spark, rows), width, percent))}
    want = brute_components(rows, width, percent)
    assert got == want and 1 < len({c for _, c in want.values()}) < len(rows)


def test_copies_of_a_template_are_compared_by_their_cores(spark, monkeypatch):
    sent = []
    marked = jaccard_join._bitmap

    def counted(placed):
        sent[-1] += placed.count()
        return marked(placed)

    monkeypatch.setattr(jaccard_join, "_bitmap", counted)
    for count in (1500, 3000):
        sent.append(0)
        rows = template_rows(5, count)
        got = rows_of(similar_components(documents(spark, rows), 3, 90))
        # Each word's copies are one component with those of the words beside it, or more.
        assert len(got) == count and len({r["component_id"] for r in got}) <= 80
    assert sent[1] <= 1.2 * sent[0] and sent[1] < 1500


def test_similar_odd_tables(spark):
    assert similar_components(documents(spark, [])).count() == 0
    text = prose(1, 30)
    docs = documents(spark, [(3, text), (3, text), (5, text), (None, text), (-2, prose(2, 20)), (-7, prose(2, 20))])
    got = sorted([(r["doc_id"], r["component_id"]) for r in rows_of(similar_components(docs))], key=str)
    assert got == sorted([(3, 3), (3, 3), (5, 3), (None, None), (-2, -7), (-7, -7)], key=str)
    left = drop_similar(docs)
    assert left.columns == docs.columns and sorted([r.doc_id for r in left.collect()], key=str) == sorted([3, 3, None, -7], key=str)


def test_connected_components(spark):
    r = random.Random(8)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1080)] + [(2000, 2000 + k) for k in range(1, 60)]
    edges += [(5, None), (7, 7)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        return i if root[i] == i else find(root[i])

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: find(i) for i in root}
