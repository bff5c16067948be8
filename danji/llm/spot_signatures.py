"""SpotSigs: documents' fingerprints from chains of content words that follow common words."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from danji.llm.common import shuffle_partitions, ship
from danji.llm.jaccard_join import similar_sets
from danji.llm.words import parts, steps

#: Common words of four languages, the anchors unless others are given.
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his in is it its not of on or she that the their "
    "there they this to was were which with you "
    "als an auch auf aus bei das dem den der des die ein eine einen er es für ich im ist mit nach nicht sich sie sind und von war zu zum "
    "au avec ce ces dans de du elle en est et il la le les mais ne ou par pas plus pour que qui sa se son sur un une "
    "al como con del el ella las lo los más no para pero por su también una y"
).split()
#: Content words in a chain.
CHAIN = 2
#: With fewer spots, texts are compared by a sketch of so many of their pairs of neighbouring words.
FEW_SPOTS, SKETCH = 16, 48
#: A text with fewer words also shows its pieces of so many letters.
FEW_WORDS, LETTERS = 8, 3
#: Signs that do not belong to a word at whose ends they stand.
EDGES = "".join(chr(i) for i in range(128) if not chr(i).isalnum()) + "\xa0«»¿¡…–—‘’“”„·"
#: Bytes of a signature, and its signs in a fingerprint.
BYTES, SIGNS = 6, 8
#: Texts taken together at most: a text's number and a signature fit 64 bits.
TOGETHER = 1 << 15

SPOT, PAIR, PIECE, AGAIN = (np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1 | 1) for k in (1, 3, 5, 7))
MASK = np.uint64((1 << 8 * BYTES) - 1)


class Fingerprint(NamedTuple):
    """Sorted distinct signatures of a text: its spots, the smallest of its pairs, and its pieces.

    A signature that occurs again is another one, so the sets are the multisets they stand for. Only
    texts of few words show pieces.
    """

    spots: np.ndarray
    pairs: np.ndarray
    pieces: np.ndarray | None = None

    def __str__(self) -> str:
        return "|".join(_signs(part) for part in self if part is not None)


def _signs(part: np.ndarray) -> str:
    octets = part.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BYTES :]
    return base64.b64encode(octets.tobytes()).decode()


def read(fingerprint: str) -> Fingerprint:
    """The signatures that a fingerprint's text lists."""

    def numbers(signs: str) -> np.ndarray:
        octets = np.frombuffer(base64.b64decode(signs), np.uint8).reshape(-1, BYTES)
        return np.concatenate([np.zeros((len(octets), 8 - BYTES), np.uint8), octets], axis=1).reshape(-1).view(">u8").astype(np.uint64)

    return Fingerprint(*map(numbers, fingerprint.split("|")))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _short(x: np.ndarray) -> np.ndarray:
    return _mixed(x) >> np.uint64(64 - 8 * BYTES)


def hashes_of(words: pa.LargeStringArray) -> np.ndarray:
    """A 64-bit hash of each string: the mixed sum of its bytes, each mixed with its place."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    octets = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    place = np.arange(len(octets)) - np.repeat(ends[:-1], np.diff(ends))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed((place * 256 + octets + 1).astype(np.uint64) * PAIR))])
    return _mixed(sums[ends[1:]] - sums[ends[:-1]] + np.diff(ends).astype(np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Intersection by union of two sorted sets, 0 if that is below `least`; nothing by nothing is 1.

    Pruned: the smaller set's size bounds the intersection, then so does the stretch of numbers that
    both sets reach into.
    """
    if not len(a) and not len(b):
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or len(a) < least * len(b):
        return 0.0
    inside = np.searchsorted(a, b[-1], "right") - np.searchsorted(a, b[0], "left")
    if inside < least * (len(a) + len(b) - inside):
        return 0.0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int(np.count_nonzero(b[at] == a))
    found = shared / (len(a) + len(b) - shared)
    return found if found >= least else 0.0


def sketched(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity by the smallest signatures of the union; exact where the sketches are whole."""
    smallest = np.union1d(a, b)
    if min(len(a), len(b)) == SKETCH:
        smallest = smallest[:SKETCH]
    if not len(smallest):
        return 1.0
    return float(np.count_nonzero(np.isin(smallest, a, assume_unique=True) & np.isin(smallest, b, assume_unique=True)) / len(smallest))


def likeness(a: Fingerprint, b: Fingerprint, least: float = 0.0) -> float:
    """From 0 to 1: Jaccard similarity of the spots; of the pairs, or pieces, where one text has few spots."""
    if min(len(a.spots), len(b.spots)) >= FEW_SPOTS:
        return jaccard(a.spots, b.spots, least)
    if a.pieces is not None and b.pieces is not None:
        return jaccard(a.pieces, b.pieces, least)
    found = sketched(a.pairs, b.pairs)
    return found if found >= least else 0.0


def numbered(text: np.ndarray, signatures: np.ndarray) -> np.ndarray:
    """Sorted keys of (text, signature), where a signature's n-th occurrence in a text has a number of its own."""
    keys = np.sort(text.astype(np.uint64) << np.uint64(8 * BYTES) | signatures)
    at = np.arange(len(keys))
    new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
    times = at - np.maximum.accumulate(np.where(new, at, 0))
    again = keys[~new]
    if len(again):
        keys[~new] = again & ~MASK | _short((again & MASK) * AGAIN + times[~new].astype(np.uint64))
        keys.sort()
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys


class Spotter:
    """Fingerprints of texts; anchors: the common words, chain: how many content words a spot takes."""

    def __init__(self, anchors: list[str], chain: int):
        self.anchors, self.chain = pa.array(sorted(set(anchors) - {""}), pa.large_string()), chain

    def fingerprints(self, texts: pa.Array) -> list[Fingerprint]:
        out = []
        for start in range(0, len(texts), TOGETHER):
            out += self._together(texts.slice(start, TOGETHER))
        return out

    def _together(self, texts: pa.Array) -> list[Fingerprint]:
        count = len(texts)
        ends, codes, words = parts(texts, pc.ascii_split_whitespace)
        words = pc.utf8_trim(pc.utf8_lower(words), characters=EDGES)
        hashes = hashes_of(words)
        # 0 nothing but signs, 1 a content word, 2 an anchor
        kind = pc.add(pc.not_equal(words, "").cast(pa.int8()), pc.is_in(words, self.anchors).cast(pa.int8())).to_numpy(zero_copy_only=False)
        real = kind[codes] > 0
        ends, codes = np.concatenate([[0], np.cumsum(real)])[ends], codes[real]
        hashes, kind = hashes[codes], kind[codes]
        text = np.repeat(np.arange(count), np.diff(ends))

        # Of a common word that is said over and over only the last is an anchor.
        last = np.concatenate([hashes[1:] != hashes[:-1], [True]])[: len(hashes)]
        anchor, content = np.flatnonzero((kind == 2) & last), np.flatnonzero(kind == 1)
        first = np.searchsorted(content, anchor)
        whole = first + self.chain <= len(content)
        whole[whole] = text[content[first[whole] + self.chain - 1]] == text[anchor[whole]]
        anchor, first = anchor[whole], first[whole]
        spot = hashes[anchor] * SPOT
        for i in range(self.chain):
            spot = _mixed(spot) + hashes[content[first + i]]
        spots = numbered(text[anchor], _short(spot))
        before = np.concatenate([[np.uint64(0)], hashes])[: len(hashes)]
        before[ends[:-1][ends[:-1] < len(hashes)]] = 0  # no word stands before a text's first
        pairs = numbered(text, _short(_mixed(before * PAIR) + hashes))

        borders = np.arange(count + 1, dtype=np.uint64) << np.uint64(8 * BYTES)
        spot_ends, pair_ends = np.searchsorted(spots, borders).tolist(), np.searchsorted(pairs, borders).tolist()
        spots, pairs = spots & MASK, pairs & MASK
        few = np.diff(ends) < FEW_WORDS
        return [
            Fingerprint(
                spots[spot_ends[i] : spot_ends[i + 1]], pairs[pair_ends[i] : min(pair_ends[i] + SKETCH, pair_ends[i + 1])],
                self._pieces(texts[i].as_py()) if few[i] else None,
            )
            for i in range(count)
        ]

    @staticmethod
    def _pieces(text: str) -> np.ndarray:
        text = " ".join(text.lower().split())
        pieces = list({text[i : i + LETTERS] for i in range(max(len(text) - LETTERS + 1, min(len(text), 1)))})
        return np.unique(_short(hashes_of(pa.array(pieces, pa.large_string())) * PIECE))


def spot_signatures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors: list[str] = ANCHORS, chain: int = CHAIN
) -> DataFrame:
    """One row per row of docs: doc_id, n_spots (signatures), fingerprint.

    A spot is a common word, its signature a 48-bit hash of the word and the `chain` next words that are
    not common. Words are what white space separates, in lower case and without the signs at their
    ends. A fingerprint lists the signatures in order, 8 signs each, then, after a '|', the 48 smallest
    of the text's pairs of neighbouring words, which serve where a text has fewer than 16 spots; a text
    with fewer than 8 words also lists its pieces of three letters, after another '|'. It depends on
    nothing but the text, so equal texts have equal fingerprints, today's and tomorrow's. Whole texts
    are read; a null text counts as empty, whose fingerprint is '||'. Ids pass through, null or
    repeated; other columns are not read; an empty table gives no rows.
    """
    spotter = Spotter(anchors, chain)

    def found(batches):
        for batch in batches:
            for step in steps(batch, 1):
                prints = spotter.fingerprints(step.column(1))
                sizes = pa.array([len(p.spots) for p in prints], pa.int64())
                yield pa.RecordBatch.from_arrays([step.column(0), sizes, pa.array(map(str, prints), pa.string())], ["doc_id", "n_spots", "fingerprint"])

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return rows.mapInArrow(found, f"doc_id {kind}, n_spots bigint, fingerprint string")


def spot_classes(
    docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", anchors: list[str] = ANCHORS, chain: int = CHAIN
) -> DataFrame:
    """doc_id, n_spots, class_id: documents whose spots have a Jaccard similarity of percent / 100 or more.

    class_id is the smallest id reachable by such links. Sets are partitioned by their number of
    spots, so that links lie within a partition or between neighbours, and only sets that share
    signatures rare enough are compared (see jaccard_join.similar_sets); no link is lost. Texts without
    spots are in a class of their own. Ids are bigint, one per document.
    """
    spotter = Spotter(anchors, chain)

    def sets_of(texts: pa.Array) -> list[np.ndarray]:
        return [np.sort(_mixed(p.spots + np.uint64(1))) for p in spotter.fingerprints(texts)]

    return similar_sets(docs, sets_of, percent, id_col, text_col).withColumnsRenamed({"n": "n_spots", "component_id": "class_id"})


COMPARED = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _edited(text: str, after: str) -> str:
    """The text with its last third replaced by as many first code points of the text after it, or all."""
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def _compared(spotter: Spotter, texts: list[str], prints: list[Fingerprint], own: list[int]) -> list[pa.Array]:
    """The columns of COMPARED for the texts whose places `own` lists, each beside the text after it."""
    edited = [_edited(texts[i], texts[i + 1]) for i in own]
    other = spotter.fingerprints(pa.array(edited, pa.large_string()))
    return [
        pa.array([len(texts[i]) for i in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([str(prints[i]) for i in own], pa.string()),
        pa.array([str(x) for x in other], pa.string()),
        pa.array([likeness(prints[i], x) for i, x in zip(own, other)], pa.float64()),
        pa.array([likeness(prints[i], prints[i + 1]) for i in own], pa.float64()),
    ]


def range_firsts(docs: DataFrame, parts: int) -> list[tuple]:
    """The first (id is not null, id, hash) of each of at most `parts` ranges, ascending; docs: doc_id, text.

    The order is descending, so a range's first key is its largest.
    """
    keys = docs.select(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.xxhash64("text").alias("hash"))
    ranges = keys.repartitionByRange(parts, *[F.desc(c) for c in keys.columns])
    firsts = ranges.groupBy(F.spark_partition_id().alias("part")).agg(F.max(F.struct("known", "doc_id", "hash")).alias("key"))
    return sorted(tuple(r.key) for r in firsts.collect())


def compared_in_order(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anchors: list[str] = ANCHORS, chain: int = CHAIN
) -> DataFrame:
    """Each row's fingerprint beside that of its edited text and that of the next row, to see what edits do.

    Rows are taken by descending id, null last, equal ids by a hash of the text; after the last comes
    the first. The edited text: the last third of the code points (rounded down) replaced by the first
    as many, or all, of the next text. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next, the likenesses of the row's fingerprint to its
    edited text's and the next row's.

    Texts are shuffled once, by ranges of (id, hash): an id that a third of the rows bear is dealt by
    its texts. A first look at ids and hashes gives the ranges, as many as there are shuffle partitions, by
    their first rows, and these rows alone go to the range before too. Each task goes through its
    range in steps of some megabytes. Null texts count as empty; two empty texts are alike by 1. One
    row is its own next row; rows that repeat id and text stay together; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    spotter = Spotter(anchors, chain)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    firsts = range_firsts(rows, shuffle_partitions(spark))
    count = max(len(firsts), 1)
    first = frozenset(firsts)

    @F.arrow_udf("int")
    def place(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """Twice the number of the row's range, and one if it is the range's first."""
        keys = [(x is not None, x, h) for x, h in zip(ids.to_pylist(), hashes.to_pylist())]
        return pa.array([2 * (count - 1 - bisect_left(firsts, k)) + (k in first) for k in keys], pa.int32())

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range ends with the row that the next one begins with, so no row waits for ever.
        held = None
        for batch in batches:
            for step in steps(batch, 1):
                texts, prints = step.column(1).to_pylist(), spotter.fingerprints(step.column(1))
                ids, echo = step.column(0), step.column(2).to_pylist()
                if held:
                    echo, texts, prints = [0, *echo], [held[1], *texts], [held[2], *prints]
                    ids = pa.concat_arrays([held[0], ids])
                last = len(texts) - 1
                held = None if echo[last] else (ids.slice(last), texts[last], prints[last])
                own = [i for i in range(last) if not echo[i]]
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(own)), *_compared(spotter, texts, prints, own)], ["doc_id", *(c.split()[0] for c in COMPARED.split(", "))]
                    )

    placed = rows.withColumn("place", place("doc_id", F.xxhash64("text")))
    own = F.col("place").bitwiseAND(1) == 0
    number = F.shiftright("place", 1)
    cells = F.when(own, F.array(number)).otherwise(F.array(number, F.pmod(number - 1, F.lit(count))))
    dealt = placed.select("doc_id", "text", F.posexplode(cells).alias("echo", "part")).repartitionById(count, F.col("part"))
    ordered = dealt.select("doc_id", "text", "echo").sortWithinPartitions("echo", F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc())
    return ordered.mapInArrow(through, f"doc_id {kind}, {COMPARED}")
