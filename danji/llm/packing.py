"""Sequence packing over the length histogram, shortest pack first."""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import heappop, heappush
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from danji.llm.common import cut, ship
from danji.llm.words import by_space, parts, steps

#: Words of these letters are composed already, lower-cased one by one and never split.
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
#: Words a worker remembers, and the bytes that they and their ids may take.
REMEMBERED, REMEMBERED_BYTES = 300_000, 24 << 20
#: Words given to the tokenizer at once: what it holds of a word while it encodes is far larger than its ids.
ENCODED = 1000
#: Pieces of one length that are ranked together.
RANKED = 20_000


class WordIds:
    """The ids of what stands between two spaces or line ends, as little-endian unsigned 32-bit numbers.

    A space belongs to no token of this kind of tokenizer (white space is only a separator, and
    composing characters never joins one to a space), so the parts are encoded independently.
    A text that holds a string of an added token is encoded whole. Words and their ids are Arrow
    arrays, in which a word takes some 20 bytes; as Python's objects they would take 200.
    """

    def __init__(self, path: str):
        # Spark runs a worker on each core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = "Áb  c'll\n. d!?́ x"
        self.separable = self._whole(probe) == b"".join(self._whole(p) for p in probe.split(" "))
        assert array("I").itemsize == 4 and sys.byteorder == "little"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        # Marks that, alone or in a row, are no part of the word of letters before them.
        marks = [m for m in punctuation if all(self._whole("ab" + m * n) == self._whole("ab") + self._whole(m * n) for n in (1, 2, 3))]
        ends = f"[{''.join(map(re.escape, marks))}]*" if marks else ""
        self.ending = f"^(?P<word>{LETTERS})(?P<marks>{ends})$"
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used = np.zeros(0, bool)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_all(self, texts: pa.Array) -> list[memoryview]:
        """Each text's ids as bytes; a tokenizer whose tokens may hold spaces is given whole texts."""
        if not self.separable:
            return [memoryview(self._whole(t)) for t in texts.to_pylist()]
        whole = {i: self._whole(texts[i].as_py()) for i in self._with_added(texts)}
        ends, codes, words = parts(texts, lambda t: by_space(pc.replace_substring(t, "\n", " ")))
        ids = self._ids(words).take(pa.array(codes))
        _, offsets, raw = ids.buffers()
        at = np.frombuffer(offsets, np.int64, len(ids) + 1, 8 * ids.offset)[ends].tolist()
        raw = memoryview(raw if raw is not None else b"")
        return [whole[i] if i in whole else raw[a:b] for i, (a, b) in enumerate(zip(at, at[1:]))]

    def _with_added(self, texts: pa.Array) -> list[int]:
        found = [pc.match_substring(texts, a).to_numpy(zero_copy_only=False) for a in self.added]
        return np.flatnonzero(np.logical_or.reduce(found)).tolist() if found else []

    def _ids(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words. Letters and the marks after them are looked up apart: they are likely to come again."""
        split = pc.extract_regex(words, self.ending)
        bare, marks = (pc.struct_field(split, k) for k in ("word", "marks"))
        marked = pc.fill_null(pc.not_equal(marks, ""), False)
        units = pa.concat_arrays([pc.if_else(split.is_valid(), bare, words), marks.filter(marked)]).dictionary_encode()
        ids = self._looked_up(units.dictionary).take(units.indices)
        # What comes after each word: its marks, or the empty one added.
        after = np.full(len(words), len(ids))
        after[marked.to_numpy(zero_copy_only=False)] = np.arange(len(words), len(ids))
        ends = pa.concat_arrays([ids, pa.array([b""], ids.type)]).take(pa.array(after))
        return pc.binary_join_element_wise(ids[: len(words)], ends, pa.scalar(b"", ids.type))

    def _looked_up(self, units: pa.Array) -> pa.Array:
        """The ids of distinct units, remembered or by the tokenizer."""
        at = pc.fill_null(pc.index_in(units, value_set=self.words), -1).to_numpy(zero_copy_only=False).copy()
        new = at < 0
        self.used[at[~new]] = True
        if new.any():
            at[new] = len(self.words) + self._learn(units.filter(pa.array(new)))
        ids = self.ids.take(pa.array(at))
        self._forget()
        return ids

    def _learn(self, units: pa.Array) -> np.ndarray:
        """Encode and remember new units; the place of each among them."""
        is_plain = pc.match_substring_regex(units, f"^{LETTERS}$").to_numpy(zero_copy_only=False)
        order, raw, sizes, odd = [], [], [], [np.flatnonzero(~is_plain)]
        for some in _steps(np.flatnonzero(is_plain)):
            # Words of letters in one text: each ends with the next id that ends a word.
            text = " ".join(units.take(pa.array(some)).to_pylist())
            ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(some):
                order.append(some)
                raw.append(ids.tobytes())
                sizes.append(np.diff(cuts, prepend=0))
            else:  # a vocabulary that marks the ends of words otherwise, or not at all
                odd.append(some)
        for some in _steps(np.concatenate(odd)):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(units.take(pa.array(some)).to_pylist(), add_special_tokens=False)]
            order.append(some)
            raw.append(np.concatenate(ids).astype("<u4").tobytes())
            sizes.append([len(i) for i in ids])
        order = np.concatenate(order)
        offsets = np.concatenate([[0], 4 * np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(raw))]
        self.ids = pa.concat_arrays([self.ids, pa.Array.from_buffers(self.ids.type, len(order), buffers)])
        self.words = pa.concat_arrays([self.words, units.take(pa.array(order))])
        self.used = np.concatenate([self.used, np.zeros(len(order), bool)])
        places = np.empty(len(order), np.int64)
        places[order] = np.arange(len(order))
        return places

    def _forget(self) -> None:
        """Keep what was used again, the latest first, where words are too many or too long together."""
        if len(self.words) <= REMEMBERED and self.words.nbytes + self.ids.nbytes <= REMEMBERED_BYTES:
            return
        sizes = sum(pc.binary_length(x).to_numpy(zero_copy_only=False) + 8 for x in (self.words, self.ids))
        keep = np.flatnonzero(self.used)[::-1][: REMEMBERED // 2]
        keep = np.sort(keep[np.cumsum(sizes[keep]) <= REMEMBERED_BYTES // 2])
        self.words, self.ids = self.words.take(pa.array(keep)), self.ids.take(pa.array(keep))
        self.used = np.zeros(len(keep), bool)


def _steps(at: np.ndarray) -> list[np.ndarray]:
    return [at[i : i + ENCODED] for i in range(0, len(at), ENCODED)]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each document's ids and end_id, cut every `size` ids: doc_id, start, length, ids_crc32, doc_tokens."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        words, end = word_ids(tokenizer), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            out = [[], [], [], [], []]
            for step in steps(batch, 1):
                for doc, raw in zip(step.column(0).to_pylist(), words.encode_all(step.column(1))):
                    n = len(raw) // 4 + 1
                    for start in range(0, n, size):
                        crc = zlib.crc32(raw[4 * start : 4 * (start + size)])
                        last = start + size >= n
                        row = (doc, start, n - start if last else size, zlib.crc32(end, crc) if last else crc, n)
                        for column, v in zip(out, row):
                            column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), *(pa.array(c, pa.int64()) for c in out[1:])],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


@dataclass(order=True)
class Pattern:
    """`count` packs of the same lengths; runs: (length, how many of it in each pack, offset of the first)."""

    sort: tuple = field(init=False, repr=False)
    space: int = field(compare=False)
    count: int = field(compare=False)
    number: int = field(compare=False)
    runs: tuple = field(compare=False)

    def __post_init__(self):
        self.sort = (-self.space, -self.count, self.number)


def plan_packs(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Pack patterns for `histogram` (length -> how many), longest lengths first.

    Each length goes to the pattern whose packs are the shortest so far; a pattern with more packs
    than pieces are left is split, and what fits nowhere opens new packs. Work and result grow with
    the number of lengths (at most `size`), not with the number of pieces: a length splits one
    pattern at most and opens two at most.
    """
    heap: list[Pattern] = []
    number = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and heap and heap[0].space >= length:
            p = heappop(heap)
            # As many at once as keep this pattern the one with the most space.
            second = heap[0].space if heap else 0
            each = max(1, min(p.space // length, (p.space - max(second, 0)) // length, max(1, left // p.count)))
            taken = min(p.count, left) if each == 1 else p.count
            if taken < p.count:
                number += 1
                heappush(heap, Pattern(p.space, p.count - taken, number, p.runs))
            number += 1
            runs = p.runs + ((length, each, size - p.space),)
            if p.runs and p.runs[-1][0] == length:
                last = p.runs[-1]
                runs = p.runs[:-1] + ((length, last[1] + each, last[2]),)
            heappush(heap, Pattern(p.space - each * length, taken, number, runs))
            left -= taken * each
        fit = size // length
        for each, count in ((fit, left // fit), (left % fit, int(left % fit > 0))):
            if count:
                number += 1
                heappush(heap, Pattern(size - each * length, count, number, ((length, each, 0),)))
    return sorted(heap, key=lambda p: p.number)


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the pieces go: of each length, the rank its next run of places begins at, sorted."""
    rows, base, rank = [], 0, {}
    for p in patterns:
        for length, each, offset in p.runs:
            first = rank.get(length, 0)
            rows.append((length, first, each, base, offset))
            rank[length] = first + each * p.count
        base += p.count
    table = np.asarray(rows or np.empty((0, 5)), np.int64)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return dict(zip(("length", "first", "each", "base", "offset"), table.T))


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack documents into sequences of at most `size` tokens; one row per piece.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A document is its
    ids and end_id; one longer than `size` is cut every `size` ids. Sequences are gapless from 0.

    The texts are read once; what is kept is a row per piece. The histogram of lengths has at most
    `size` rows, so the plan is made on the driver and its places, bounded by it, are broadcast.
    Pieces find their place by their rank among those of their length. Ranks are counted in buckets
    of some RANKED rows, so a length that a third of all pieces share is not ranked in one task.
    A null or empty text is a document of end_id alone. Repeated rows are packed as often as they
    stand there. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    cut_rows = cut(pieces(docs, tokenizer, end_id, size, id_col, text_col))
    histogram = {r["length"]: r["n"] for r in cut_rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(slots(plan_packs(histogram, size)))
    many = max(1, max(histogram.values(), default=1) // RANKED)
    # Rows that agree in everything may share a bucket in any order: they are interchangeable.
    bucket = F.pmod(F.xxhash64("doc_id", "start"), F.lit(many))
    bucketed = cut_rows.withColumn("bucket", bucket)
    sizes = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.selectExpr(
        "length", "bucket", "sum(n) over (partition by length order by bucket rows between unbounded preceding and 1 preceding) as before"
    )
    ranked = bucketed.selectExpr(
        "*", "row_number() over (partition by length, bucket order by doc_id, start, ids_crc32) - 1 as within"
    ).join(before, ["length", "bucket"]).selectExpr(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "coalesce(before, 0) + within as rank"
    )
    kind = docs.schema[id_col].dataType.simpleString()

    def place(batches):
        at = places.value
        # One number per (length, rank): lengths are at most `size`.
        widest = int(at["first"].max(initial=0)) + 1
        keys = at["length"] * (2 * widest) + at["first"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (2, 5))
            i = np.searchsorted(keys, length * (2 * widest) + np.minimum(rank, widest), "right") - 1
            j = rank - at["first"][i]
            sequence = at["base"][i] + j // at["each"][i]
            offset = at["offset"][i] + j % at["each"][i] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place,
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
