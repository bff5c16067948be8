"""Toxic spans by a linear-chain conditional random field; marginals give scores and offsets."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from danji.llm.common import ship
from danji.llm.words import parts, steps

WORD = re.compile(r"\S+")
EDGE = ".,;:!?\"'()[]{}|*#%&$…«»“”„"
#: How many features may be learnt that only happen to stand in toxic texts (expected number).
MISTAKES = 1.0
#: Tokens of a training sequence.
SPAN = 48


def features(word: str) -> list[str]:
    """What the field sees of a token: the word and, of longer ones, how it begins."""
    word = word.strip(EDGE).lower()
    if not word:
        return []
    return ["w " + word, *[f"{n} {word[:n]}" for n in (4, 5, 6) if len(word) > n]]


@dataclass
class Field:
    """Two states, 0 and 1 (toxic). Scores are logarithms, state 0 of a token scoring 0."""

    weights: dict[str, float]
    bias: float
    start: float
    step: np.ndarray

    def __post_init__(self):
        self.emissions: dict[str, float] = {}
        plain = np.exp(self.step) * np.exp([0.0, self.bias])
        values, vectors = np.linalg.eig(plain)
        order = np.argsort(-np.abs(values))
        self.ratio = float(np.real(values[order[1]] / values[order[0]]))
        self.right = np.real(vectors[:, order])
        self.left = np.linalg.inv(self.right)
        here = self.left[0] * self.right[:, 0]
        #: The marginal inside a long text of tokens that bear no feature.
        self.resting = float(here[1] / here.sum())

    def emission(self, word: str) -> float:
        """The score of state 1 that a token's features add to the bias."""
        got = self.emissions.get(word)
        if got is None:
            got = sum(self.weights.get(f, 0.0) for f in features(word))
            if len(self.emissions) > 200_000:
                self.emissions.clear()
            self.emissions[word] = got
        return got

    def _plain(self, n: int) -> np.ndarray:
        """The product of n steps over tokens without features, up to a factor."""
        return (self.right * np.array([1.0, self.ratio**n])) @ self.left

    def marginals(self, n: int, at: list[int], scores: list[float]) -> np.ndarray:
        """P(toxic) of the tokens at the places `at` of a text of n, all others bearing no feature.

        Forward and backward over the chain, runs of plain tokens being powers of one matrix.
        """
        first = np.exp([0.0, self.start])
        step = np.exp(self.step)
        ahead, vector, before = [], None, 0
        for i, score in zip(at, scores):
            if vector is None and i > 0:
                vector, before = first * np.exp([0.0, self.bias]), 1
            emit = np.exp([0.0, min(self.bias + score, 500.0)])
            vector = first * emit if vector is None else (vector @ self._plain(i - before)) @ step * emit
            vector = np.abs(vector) / np.abs(vector).sum()
            ahead.append(vector)
            before = i + 1
        out, vector, after = [], np.ones(2), n
        for i, score, alpha in zip(reversed(at), reversed(scores), reversed(ahead)):
            beta = np.abs(self._plain(after - i - 1) @ vector)
            both = alpha * beta
            out.append(both[1] / both.sum())
            vector = step @ (np.exp([0.0, min(self.bias + score, 500.0)]) * beta)
            vector = vector / vector.sum()
            after = i
        return np.array(out[::-1])

    def spans(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        """(score, offsets of the tokens that are toxic by marginal) of a text."""
        words = list(WORD.finditer(text))
        at, scores = [], []
        for i, m in enumerate(words):
            if score := self.emission(m[0]):
                at.append(i)
                scores.append(score)
        if not at:
            return self.resting, []
        p = self.marginals(len(words), at, scores)
        return max(self.resting, float(p.max())), [words[i].span() for i, x in zip(at, p) if x >= 0.5]


def _bearing(words: list[list[str]], toxic: list[int], of=None) -> tuple[Counter, Counter]:
    """How many texts, not toxic and toxic, bear each feature.

    With `of`, of those features alone and counting a text only if it bears the feature between
    two words it did not stand between before: copies and repeated lines then count once.
    """
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    seen: set[int] = set()
    known: dict[str, list[str]] = {}
    for y in (0, 1):
        for text in (w for w, t in zip(words, toxic) if t == y):
            if of is None:
                counts[y].update({x for v in set(text) for x in features(v)})
                continue
            new = set()
            for before, v, after in zip(["", *text], text, [*text[1:], ""]):
                if (got := known.get(v)) is None:
                    got = known[v] = [x for x in features(v) if x in of]
                for x in got:
                    place = hash((x, before, after))
                    if place not in seen:
                        seen.add(place)
                        new.add(x)
            counts[y].update(new)
    return counts


def _by_chance(a: int, c: int, share: float) -> float:
    """The probability that of a + c texts a or more are toxic, if a feature tells nothing."""
    n = a + c
    return sum(math.comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(a, n + 1)) if n < 900 else 0.0


def train(rows: list[tuple[str, int]], least: int = 3, ratio: float = 6.0, rounds: int = 60) -> Field:
    """A field learnt from (text, toxic) rows.

    The labels are of whole texts, so tokens are labelled first: a feature that at least `least`
    toxic texts (and a hundredth of them) bear, `ratio` times as often as others and not by chance,
    marks its tokens in toxic texts as toxic; all other tokens are labelled 0. The field's weights are
    then fitted to these tokens by the likelihood of the chain (Adam, with an L2 penalty).
    """
    words = [WORD.findall(t) for t, _ in rows]
    marks = [y for _, y in rows]
    sizes = [marks.count(0), marks.count(1)]
    least = max(least, sizes[1] // 100)

    def telling(counts):
        return [
            x for x, a in counts[1].items()
            if a >= least and (a + 0.5) / (sizes[1] + 1) >= ratio * (counts[0][x] + 0.5) / (sizes[0] + 1)
        ]

    counts = _bearing(words, marks)
    tests = sum(a + counts[0][x] >= least for x, a in counts[1].items())
    counts = _bearing(words, marks, of=set(telling(counts)))
    share = sizes[1] / max(1, len(rows))
    chosen = sorted(x for x in telling(counts) if _by_chance(counts[1][x], counts[0][x], share) * tests < MISTAKES)
    number = {x: i for i, x in enumerate(chosen)}
    # Sequences: those that bear a feature as they are, the others by their lengths.
    bear, labels, plain = [], [], Counter()
    known: dict[str, list[int]] = {}
    for w, (_, y) in zip(words, rows):
        for a in range(0, len(w), SPAN):
            tokens = []
            for v in w[a : a + SPAN]:
                if (got := known.get(v)) is None:
                    got = known[v] = [number[x] for x in features(v) if x in number]
                tokens.append(got)
            if any(tokens):
                bear.append(tokens)
                labels.append([int(bool(t) and y) for t in tokens])
            else:
                plain[len(tokens)] += 1
    n, k = len(bear) + len(plain), len(chosen)
    here = np.zeros((n, SPAN), bool)
    truth = np.zeros((n, SPAN), int)
    weight = np.ones(n)
    rows_of, columns_of, features_of = [], [], []
    for i, tokens in enumerate(bear):
        here[i, : len(tokens)] = True
        truth[i, : len(tokens)] = labels[i]
        for j, t in enumerate(tokens):
            rows_of += [i] * len(t)
            columns_of += [j] * len(t)
            features_of += t
    for i, (length, many) in enumerate(plain.items(), len(bear)):
        here[i, :length] = True
        weight[i] = many
    rows_of, columns_of, features_of = (np.asarray(x, int) for x in (rows_of, columns_of, features_of))
    theta = np.zeros(k + 6)
    theta[k] = -3.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    total = max(1.0, (here.sum(1) * weight).sum())
    for t in range(1, rounds + 1):
        grad = _gradient(theta, k, here, truth, weight, rows_of, columns_of, features_of) / total
        grad[:k] += 1e-5 * theta[:k]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta -= 0.25 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    return Field({x: float(theta[i]) for x, i in number.items()}, float(theta[k]), float(theta[k + 1]), theta[k + 2 :].reshape(2, 2))


def _gradient(theta, k, here, truth, weight, rows_of, columns_of, features_of):
    """Of the negative log likelihood; theta: feature weights, bias, start, the four steps."""
    n, length = here.shape
    emit = np.full((n, length), theta[k])
    np.add.at(emit, (rows_of, columns_of), theta[features_of])
    e = np.exp(np.clip(np.stack([np.zeros_like(emit), emit], 2), -50, 50))
    step = np.exp(theta[k + 2 :].reshape(2, 2))
    ahead, back = np.zeros_like(e), np.ones_like(e)
    ahead[:, 0] = np.exp([0.0, theta[k + 1]]) * e[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for j in range(1, length):
        nxt = ahead[:, j - 1] @ step * e[:, j]
        ahead[:, j] = nxt / nxt.sum(1, keepdims=True)
    for j in range(length - 2, -1, -1):
        nxt = (e[:, j + 1] * back[:, j + 1]) @ step.T
        nxt /= nxt.sum(1, keepdims=True)
        back[:, j] = np.where(here[:, j + 1, None], nxt, 1.0)
    p = ahead * back
    p = p[:, :, 1] / p.sum(2)
    off = np.where(here, p - truth, 0.0) * weight[:, None]
    grad = np.zeros_like(theta)
    grad[:k] = np.bincount(features_of, off[rows_of, columns_of], k) if k else 0.0
    grad[k] = off.sum()
    grad[k + 1] = off[:, 0].sum()
    pair = ahead[:, :-1, :, None] * step * (e[:, 1:] * back[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    live = (here[:, 1:] * weight[:, None])[:, :, None, None]
    seen = np.zeros_like(pair)
    i, j = np.indices(truth[:, 1:].shape)
    seen[i, j, truth[:, :-1], truth[:, 1:]] = 1.0
    grad[k + 2 :] = ((pair - seen) * live).sum((0, 1)).ravel()
    return grad


def learn(docs: DataFrame, labels: DataFrame, most_toxic: int = 1000, most_clean: int = 3000, most_bytes: int = 32 << 20,
          id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field from at most most_toxic and most_clean labelled documents, whole texts, of most_bytes in all.

    labels: id and toxic (0 or 1; null is no label). The documents are those first in the order of
    the hash of their ids, toxic and other ones in turn by their shares; of these, one that would
    make the sum of their bytes too large is left out. The lengths of at most 4000 are collected, then
    the texts of those chosen, so the driver holds a bounded number of bytes. Without a toxic example
    the field calls nothing toxic.
    """
    picked = labels.where(f"toxic is not null and {id_col} is not null").groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64(F.col(id_col).cast("string")), F.col(id_col)]
    ids = picked.where("toxic = 1").orderBy(*order).limit(most_toxic).unionAll(
        picked.where("toxic = 0").orderBy(*order).limit(most_clean)
    )
    rows = docs.where(F.col(text_col).isNotNull()).select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(ids), id_col)
    sizes = rows.groupBy(id_col, "toxic").agg(F.sum(F.octet_length("_text")).alias("size"), order[0].alias("place")).collect()
    chosen, left, turn = [], most_bytes, {0: 0, 1: 0}
    share = {0: max(most_clean, 1), 1: max(most_toxic, 1)}
    queues = {y: sorted((r for r in sizes if r["toxic"] == y), key=lambda r: (r["place"], r[id_col])) for y in (0, 1)}
    while any(turn[y] < len(queues[y]) for y in queues):
        y = min((y for y in queues if turn[y] < len(queues[y])), key=lambda y: (turn[y] / share[y], y))
        r = queues[y][turn[y]]
        turn[y] += 1
        if r["size"] <= left:
            left -= r["size"]
            chosen.append(r[id_col])
    if len(chosen) < len(sizes):
        kept = docs.sparkSession.createDataFrame([(c,) for c in chosen], docs.select(id_col).schema)
        rows = rows.join(F.broadcast(kept), id_col, "left_semi")
    return train([(r["_text"], int(r["toxic"])) for r in rows.orderBy(id_col, "_text").collect()])


def toxicity(
    docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per row of docs: doc_id, score (0 to 1), predicted (1 from 0.5), spans, and the text if asked for.

    The score is the largest marginal of state 1 over the tokens of the whole text; spans are the
    offsets (code points, end exclusive) of tokens whose marginal is 0.5 or more, as start:end,
    joined by commas. Tokens without a learnt feature, and texts of them alone, empty or null ones
    included, have the marginal of the inside of a long text without features. Rows are independent: no
    shuffle; the field (bounded by its training rows) goes to the workers with the function. Ids pass
    through, null or repeated; other columns are not read; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        field = shared.value
        for batch in batches:
            scores, spans = np.full(batch.num_rows, field.resting), [""] * batch.num_rows
            at = 0
            for step in steps(batch, 1):
                texts = step.column(1)
                ends, codes, words = parts(texts, pc.utf8_split_whitespace)
                marked = np.fromiter((field.emission(w) != 0 for w in words.to_pylist()), bool, len(words))
                sums = np.concatenate([[0], np.cumsum(marked[codes])])[ends]
                for i in np.flatnonzero(sums[1:] > sums[:-1]).tolist():
                    scores[at + i], found = field.spans(texts[i].as_py())
                    spans[at + i] = ",".join(f"{a}:{b}" for a, b in found)
                at += step.num_rows
            out = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays([*out, *batch.columns[1 : 1 + with_text]], ["doc_id", "score", "predicted", "spans", "text"][: 4 + with_text])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, spans string" + ", text string" * with_text)
