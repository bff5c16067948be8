"""N-gram Jaccard join by adaptive multi-match prefixes; its links' components per document."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from danji.llm.common import connected_components, cut, hot_left_join, ship, shuffle_partitions
from danji.llm.words import parts, steps

#: Shingles that may be called frequent at most: what is broadcast is this many 8-byte hashes and classes.
MOST_FREQUENT = 1 << 20
#: The fewest documents that make a shingle frequent.
LEAST_FREQUENT = 16
#: A document's prefix is lengthened to demand at most so many matches.
MOST_MATCHES = 8
#: Cost of verifying a candidate, in list entries read.
VERIFY = 50.0
#: Documents, and shingles, of a block in verification, about; a task holds two blocks. A set of more
#: shingles is a block of its own.
BLOCK = 384
BLOCK_SHINGLES = 1_000_000
#: Marks by which texts are picked for verification: a megabyte as bits, eight as bytes.
FILTER = 1 << 23

#: The sets of a batch of texts, as sorted arrays of distinct 64-bit hashes.
Sets = Callable[[pa.Array], Iterable[np.ndarray]]

MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=200_000)
def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int):
    """The set of each text's shingles, as sorted 64-bit hashes.

    A-Z in lower case, words [^\\x20\\x09-\\x0D]+; fewer words than `width` are one shingle, none no
    shingle. Two different shingles share a hash with probability 2**-64.
    """
    ends, codes, words = parts(pc.ascii_lower(texts), pc.ascii_split_whitespace)
    hashes = np.fromiter(map(_word_hash, words.to_pylist()), np.uint64, len(words))[codes]
    # Splitting leaves empty words at the ends of a text.
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)[codes]
    kept = np.concatenate([[0], np.cumsum(~empty)])[ends]
    hashes = hashes[~empty]
    run = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        run = _mixed(run * MIX + hashes[k : k + len(run)] + np.uint64(k + 1))
    for a, b in zip(kept.tolist(), kept[1:].tolist()):
        if b - a >= width:
            yield np.unique(run[a : b - width + 1])
        elif b > a:
            yield np.frombuffer(hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8).digest(), np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _named(shingles: np.ndarray) -> int:
    """62 bits that stand for a set, as an even number."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()[:8], "little") >> 2 << 1


def _classes(shingles: np.ndarray, frequent) -> np.ndarray:
    """The class of each shingle, 0 for those that aren't frequent."""
    code, classes, buckets = frequent
    if not len(code):
        return np.zeros(len(shingles), np.uint8)
    mine = (shingles >> np.uint64(32)) * np.uint64(buckets) + shingles % np.uint64(buckets)
    at = np.minimum(np.searchsorted(code, mine), len(code) - 1)
    return np.where(code[at] == mine, classes[at], 0)


def _gaps(keys: np.ndarray) -> bytes:
    """Rising 32-bit numbers as gaps, byte by byte: their high bytes are zeros and compress."""
    return np.diff(keys, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _rising(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
    return np.cumsum(gaps, dtype=np.uint32)


def _by_bucket(shingles: np.ndarray, buckets: int):
    """(order, 32-bit keys in that order, edges): shingles by bucket, rising within each."""
    bucket = (shingles % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((shingles, bucket))
    return order, (shingles >> np.uint64(32)).astype(np.uint32)[order], np.searchsorted(bucket[order], np.arange(buckets + 1))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def frequent_shingles(docs: DataFrame, sets_of: Sets, text_bytes: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, classes, buckets) of the shingles in many documents, sorted by key; at most MOST_FREQUENT.

    Every shingle of every document is counted: a task counts its own and sends them, as sorted 32-bit
    keys of a bucket, to the bucket's task, which adds up. Keys hold 32 bits of the hash beside the
    bucket's, so in a large corpus a class may be too high by a rare collision: it only orders the
    shingles, and any order gives the same links. A shingle is frequent in at least LEAST_FREQUENT
    documents, or in more where that would be more than MOST_FREQUENT shingles: the least number that
    is a power of two and leaves no more.
    """
    buckets = max(shuffle_partitions(docs.sparkSession), math.ceil(text_bytes / (64 << 20)))

    def count(batches):
        for batch in batches:
            for step in steps(batch, 1):
                sets = list(sets_of(step.column(1)))
                every = np.concatenate([np.zeros(0, np.uint64), *sets])
                _, keys, edges = _by_bucket(every, buckets)
                full = np.flatnonzero(np.diff(edges)).tolist()
                blobs = [_gaps(keys[edges[b] : edges[b + 1]]) for b in full]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "keys"])

    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(b, []).append(_rising(blob))
        for b, found in held.items():
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            often = n >= LEAST_FREQUENT
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(often.sum(), b, np.int32)), pa.array(keys[often].astype(np.int64)),
                 pa.array(n[often].astype(np.int64))],
                ["bucket", "key", "n"],
            )

    counted = cut(
        docs.mapInArrow(count, "bucket int, keys binary").repartition(buckets, "bucket")
        .mapInArrow(add, "bucket int, key bigint, n bigint")
    )
    # At most 63 classes: how many shingles each holds.
    held = {r["c"]: r["k"] for r in counted.groupBy(F.floor(F.log2("n")).alias("c")).agg(F.count("*").alias("k")).collect()}
    least, room = 63, MOST_FREQUENT
    while least > 0 and held.get(least - 1, 0) <= room:
        least -= 1
        room -= held.get(least, 0)
    often = counted.where(F.floor(F.log2("n")) >= least).toPandas()
    code = often["key"].to_numpy(np.uint64) * np.uint64(buckets) + often["bucket"].to_numpy(np.uint64)
    order = np.argsort(code)
    classes = np.log2(np.maximum(often["n"].to_numpy(float), 1)).astype(np.uint8)
    return code[order], classes[order], buckets


def prefixes(docs: DataFrame, sets_of: Sets, percent: int, frequent) -> DataFrame:
    """Two kinds of rows: of documents (doc_id, n, digest, node, hot, core, rare), and of prefix entries (bucket, keys, ...).

    The global order of shingles: rarer classes first, then by hash. For a demand of m matches the
    prefix has n - ceil(t n) + m shingles: two sets of similarity t or more share m of the smaller
    demand in them. The demand is chosen by estimated cost, the entries of the lists the prefix
    reads and VERIFY for each candidate that is left, the documents a class stands for being taken
    as the list's length; a document of frequent shingles so demands more of them.

    Frequent shingles have no lists. hot are those in the prefix for a demand of one: two similar
    sets share a shingle of these prefixes, a hot one or a rare one. In the second case they also share
    as many rare ones as the smaller of their demands, each less the frequent shingles in its own
    prefix, and at least one; this is the entries' demand. In the first case alone they share no rare
    shingle at all, since a prefix that reaches a frequent one holds all the set's rare ones: then
    only the core counts, which is the set's frequent shingles, and `rare`, the number of the others.

    node stands for the set: 62 bits of its digest, so equal sets are one node from the start. The
    rare shingles of the prefix become entries, by bucket: 32 bits of each shingle's
    hash, and the place of its set among the bucket's nodes, sizes and demands. Shingles that share these
    bits and the bucket only make candidates that verification refuses.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        buckets = shared.value[2]
        for batch in batches:
            for step in steps(batch, 1):
                ids, ns, digests, nodes, demands, rare, hot, cores, others = [], [], [], [], [], [], [], [], []
                for doc, s in zip(step.column(0).to_pylist(), sets_of(step.column(1))):
                    n, m, core, left = len(s), 0, None, 0
                    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    hot.append(np.zeros(0, np.int64))
                    rare.append(np.zeros(0, np.uint64))
                    if n:
                        rank = _classes(s, shared.value)
                        order = np.lexsort((s, rank))
                        need = -(-percent * n // 100)
                        most = min(MOST_MATCHES, need)
                        lists = np.exp2(rank[order[: n - need + most]].astype(float))
                        read = np.cumsum(lists)[n - need :]
                        demand = np.arange(1, most + 1)
                        m = int(np.argmin(read + VERIFY * read / demand**2)) + 1
                        if most > 1:
                            m = max(2, m)
                        chosen = order[: n - need + m]
                        often = rank[chosen] > 0
                        rare[-1] = s[chosen[~often]]
                        hot[-1] = s[chosen[: n - need + 1][often[: n - need + 1]]].view(np.int64)
                        m = max(1, m - int(often.sum()))
                        if len(hot[-1]):
                            core, left = _named(s[rank > 0]) + 1, int((rank == 0).sum())
                    cores.append(core)
                    others.append(left)
                    ids.append(doc)
                    ns.append(n)
                    digests.append(digest)
                    nodes.append(_named(s))
                    demands.append(m)
                count = len(ids)
                # Equal sets of a step need one entry each.
                node, first, of = np.unique(np.asarray(nodes, np.int64), return_index=True, return_inverse=True)
                rare = [r if first[of[i]] == i else r[:0] for i, r in enumerate(rare)]
                every = np.concatenate(rare)
                owner = np.repeat(np.arange(count), [len(r) for r in rare])
                order, keys, edges = _by_bucket(every, buckets)
                owner = owner[order]
                full = np.flatnonzero(np.diff(edges)).tolist()
                blobs = {"keys": [], "place": [], "nodes": [], "sizes": [], "demands": []}
                all_n, all_m = np.asarray(ns, np.int32), np.asarray(demands, np.int8)
                all_nodes = np.asarray(nodes, np.int64)
                for b in full:
                    here, place = np.unique(owner[edges[b] : edges[b + 1]], return_inverse=True)
                    blobs["keys"].append(_gaps(keys[edges[b] : edges[b + 1]]))
                    blobs["place"].append(place.astype(np.uint16 if len(here) < 1 << 16 else np.uint32).tobytes())
                    blobs["nodes"].append(all_nodes[here].tobytes())
                    blobs["sizes"].append(all_n[here].tobytes())
                    blobs["demands"].append(all_m[here].tobytes())
                none, more = [None] * len(full), [None] * count
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids + none, pa.int64()), pa.array(ns + none, pa.int32()), pa.array(digests + none, pa.binary()),
                        pa.array(nodes + none, pa.int64()), pa.array(hot + none, pa.list_(pa.int64())),
                        pa.array(cores + none, pa.int64()), pa.array(others + none, pa.int32()), pa.array(more + full, pa.int32()),
                        *[pa.array(more + blobs[c], pa.binary()) for c in blobs],
                    ],
                    ["doc_id", "n", "digest", "node", "hot", "core", "rare", "bucket", *blobs],
                )

    return docs.mapInArrow(
        run, "doc_id bigint, n int, digest binary, node bigint, hot array<bigint>, core bigint, rare int, bucket int, "
             "keys binary, place binary, nodes binary, sizes binary, demands binary"
    )


def _candidates(entries: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Edges (a, b) between sets that share enough of their prefixes' rare shingles.

    A rare shingle stands in fewer documents than make it frequent, so an entry is in fewer pairs
    than that.
    """

    def pair(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, keys, place, nodes, sizes, demands in zip(*(c.to_pylist() for c in batch.columns)):
                nodes = np.frombuffer(nodes, np.int64)
                place = np.frombuffer(place, np.uint16 if len(nodes) < 1 << 16 else np.uint32)
                held.setdefault(bucket, []).append((
                    _rising(keys), nodes[place], np.frombuffer(sizes, np.int32)[place], np.frombuffer(demands, np.int8)[place].astype(np.int32)
                ))
        for bucket in list(held):
            key, node, n, m = (np.concatenate(x) for x in zip(*held.pop(bucket)))
            yield from paired(key.astype(np.int64) * buckets + bucket, node, n, m)

    def paired(shingle, doc, n, m):
        order = np.lexsort((doc, n, shingle))
        # A set that several steps hold counts once in a list.
        same = (np.diff(shingle[order]) == 0) & (np.diff(doc[order]) == 0)
        order = order[np.concatenate([[True], ~same])]
        shingle, doc, n, m = shingle[order], doc[order], n[order], m[order]
        left = np.arange(len(shingle))
        gap = 1
        while len(left):
            left = left[left + gap < len(shingle)]
            left = left[(shingle[left + gap] == shingle[left]) & (100 * n[left] >= percent * n[left + gap])]
            x, y = left, left + gap
            for at in range(0, len(x), 100_000):
                i, j = x[at : at + 100_000], y[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(doc[i], doc[j])), pa.array(np.maximum(doc[i], doc[j])), pa.array(np.minimum(m[i], m[j]))], ["a", "b", "m"]
                )
            gap += 1

    sent = entries.select("bucket", "keys", "place", "nodes", "sizes", "demands").repartition(buckets, "bucket")
    pairs = sent.mapInArrow(pair, "a bigint, b bigint, m int")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("m").alias("m")).where("shared >= m").select("a", "b")


def _bit(ids: np.ndarray) -> np.ndarray:
    return (_mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(FILTER)).astype(np.int64)


def _bitmap(rows: DataFrame) -> np.ndarray:
    """Marks for the ids of rows, at most FILTER bytes however many rows: others may share a mark.

    Texts are picked by it where they are read, so that they need not be shuffled to be picked.
    """
    def mark(batches):
        marks = np.zeros(FILTER, bool)
        for batch in batches:
            marks[_bit(batch.column(0).to_numpy())] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(marks).tobytes()], pa.binary())], ["marks"])

    marks = np.zeros(FILTER // 8, np.uint8)
    for row in rows.select("doc_id").distinct().coalesce(4).mapInArrow(mark, "marks binary").collect():
        marks |= np.frombuffer(row["marks"], np.uint8)
    return np.unpackbits(marks)


def _verified(families: DataFrame, docs: DataFrame, sets_of: Sets, percent: int, frequent) -> DataFrame:
    """Links (a, b) of each family, enough of them to connect what is connected.

    families: doc_id, n, rare, core_only, family. A family small enough is one block. A larger one is cut into bands
    of lengths, such that linked sets are in the same band or neighbours, and bands into blocks bounded in
    sets and shingles; every pair of blocks that can hold a link is a group of its own, and a task holds one.

    In a family of cores (core_only) frequent shingles alone are compared, each set having `rare` others
    that are in no other set. Then there are rows with a cap, too, the greatest for each linked a in a
    group: a set of a's core with so many rare shingles would still link to b.
    """
    wide = math.log(100 / percent) * 1.0001
    banded = families.withColumn("band", F.floor(F.log("n") / wide).cast("int"))
    sizes = cut(banded.groupBy("family", "band").agg(F.count("*").alias("k"), F.sum("n").alias("shingles")))
    fits = f"sum(k) <= {BLOCK} and sum(shingles) <= {BLOCK_SHINGLES}"
    whole = sizes.groupBy("family").agg(F.sum("k").alias("k"), F.expr(fits).alias("whole")).where("k > 1").drop("k")
    most = f"greatest(k / {BLOCK}, shingles / {BLOCK_SHINGLES})"
    blocks = sizes.withColumn("blocks", F.expr(f"int(ceil({most}))")).select("family", "band", "blocks")
    placed = banded.join(whole, "family").join(blocks, ["family", "band"])
    for name, step in (("below", -1), ("above", 1)):
        near = blocks.select("family", (F.col("band") - step).alias("band"), F.col("blocks").alias(name))
        placed = placed.join(near, ["family", "band"], "left")
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    keys = F.when(F.col("whole"), F.expr("array(struct(0 as p, 0 as i, 0 as j, false as right))")).otherwise(F.expr("""
        concat(
            transform(sequence(0, blocks - 1), o -> struct(band as p, least(o, block) as i, greatest(o, block) as j, o < block as right)),
            if(above is null, array(), transform(sequence(0, above - 1), o -> struct(band as p, block as i, 1000000 + o as j, false as right))),
            if(below is null, array(), transform(sequence(0, below - 1), o -> struct(band - 1 as p, o as i, 1000000 + block as j, true as right)))
        )"""))
    placed = placed.withColumn("block", block).select("doc_id", "family", "rare", "core_only", F.explode(keys).alias("key"))
    placed = cut(placed.select("doc_id", "family", "rare", "core_only", "key.p", "key.i", "key.j", "key.right"))
    context = docs.sparkSession.sparkContext
    chosen = context.broadcast(_bitmap(placed))
    common = context.broadcast(frequent)

    def sets(batches):
        for batch in batches:
            hit = chosen.value[_bit(batch.column(0).to_numpy())] > 0
            for step in steps(batch.filter(pa.array(hit)), 1):
                found = [s.tobytes() for s in sets_of(step.column(1))]
                yield pa.RecordBatch.from_arrays([step.column(0), pa.array(found, pa.binary())], ["doc_id", "shingles"])

    def link(group):
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        cores = bool(group["core_only"].iloc[0])
        if cores:
            sets = [s[_classes(s, common.value) > 0] for s in sets]
        rare = group["rare"].to_numpy(np.int64) * cores
        same = group["i"].iloc[0] == group["j"].iloc[0]
        return _links(group["doc_id"].to_numpy(), sets, rare, group["right"].to_numpy(), same, percent, cores)

    shingled = docs.mapInArrow(sets, "doc_id bigint, shingles binary")
    return placed.join(shingled, "doc_id").groupBy("family", "p", "i", "j").applyInPandas(link, "a bigint, b bigint, cap bigint")


def _links(ids, sets, rare, right, same: bool, percent: int, caps: bool):
    """Spanning links among the sets (same), or between those of the left and the right side.

    A set has `rare` elements more, of its own. With caps also, for each set with a link, how many it
    could have at most and still link to the other one that is best for this.
    """
    import pandas as pd

    size = np.array([len(s) for s in sets])
    flat, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    # Shingles of one set alone add nothing to an intersection.
    useful = np.bincount(column, minlength=len(flat)) > 1
    row, column = row[useful[column]], (np.cumsum(useful) - 1)[column[useful[column]]]
    width = int(useful.sum())
    shared = np.zeros((len(sets), len(sets)), np.int64)
    for a in range(0, width, 8192):
        part = (column >= a) & (column < a + 8192)
        dense = np.zeros((len(sets), min(8192, width - a)), np.float32)
        dense[row[part], column[part] - a] = 1
        shared += (dense @ dense.T).astype(np.int64)
    union = size[:, None] + size[None, :] - shared
    linked = 100 * shared >= percent * (union + rare[:, None] + rare[None, :])
    if not same:
        linked &= right[:, None] != right[None, :]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        x, y = find(i), find(j)
        if x != y:
            parent[x] = y
            out.append((ids[i], ids[j], -1))
    if caps:
        np.fill_diagonal(linked, False)
        cap = np.where(linked, 100 * shared // percent - union - rare[None, :], -1)
        best = cap.argmax(1)
        out += [(ids[i], ids[best[i]], cap[i, best[i]]) for i in np.flatnonzero(linked.any(1))]
    return pd.DataFrame(out, columns=["a", "b", "cap"]).astype("int64")


def _cores(nodes: DataFrame) -> DataFrame:
    """core, its first set's doc_id, n and rare, and the number of its sets.

    nodes: doc_id, n, core, rare of each distinct set; those without a core have no hot shingles.
    Sets that have links by frequent shingles alone share no rare shingle, so what they have in
    common is what their cores have, and of one core the set with the fewest rare shingles, its first,
    links to whatever another one of them links to. So first sets of distinct cores stand for all:
    near copies of a template, however many, have few cores.
    """
    first = F.min(F.struct("rare", "doc_id", "n"))
    sets = nodes.where("core is not null").groupBy("core").agg(first.alias("first"), F.count("*").alias("sets"))
    return cut(sets.select("core", "first.doc_id", "first.n", "first.rare", "sets"))


def _of_cores(nodes: DataFrame, cores: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of the sets that aren't the first of their core.

    A set links to the first set of the core that is best for it, its own or, by found's caps, another
    one, if it has no more rare shingles than the cap; the first sets of both cores are linked as
    well then, since its own core's has fewer. A set with more has no link by frequent shingles alone.
    """
    best = found.where("cap >= 0").groupBy("a").agg(F.max(F.struct("cap", "b")).alias("best"))
    own = F.expr(f"100 * (n - rare) div {percent} - (n - rare) - rare")
    capped = cores.where("sets > 1").join(best, F.col("doc_id") == F.col("a"), "left").select(
        "core", "sets", F.col("doc_id").alias("first_id"),
        F.greatest(F.struct(own.alias("cap"), F.col("doc_id").alias("b")), "best").alias("best"),
    )
    others = hot_left_join(nodes.where("core is not null").select("doc_id", "core", "rare"), cut(capped), ["core"], "sets")
    return others.where("doc_id <> first_id and rare <= best.cap").select(F.col("doc_id").alias("a"), F.col("best.b").alias("b"))


def similar_components(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Two documents link when the Jaccard similarity of their sets of `width`-word shingles is
    percent / 100 or more; component_id is the smallest id reachable by links, the document itself
    included. No link is lost: the result is exact but for 64-bit hash collisions.

    Equal sets are one from the start (a digest, combined on the map side). The sets' adaptive
    prefixes find candidates by their rare shingles, of which they must share as many as the smaller
    demand; the candidates' components are verified block by block with exact intersections, of which
    a spanning forest is kept. Sets that share frequent shingles alone are compared by their
    cores (see _cores): a group of near copies never becomes all its pairs.

    Ids are bigint and one per document: rows that repeat an id count as one document of each text,
    linked through the id. A null id gets n_shingles and itself, null, as component. Documents without
    words (null, empty or blank text) have 0 shingles and link with nothing, also not with one another.
    """
    return similar_sets(docs, partial(shingle_sets, width=width), percent, id_col, text_col).withColumnRenamed("n", "n_shingles")


def similar_sets(docs: DataFrame, sets_of: Sets, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, component_id: similar_components for any sets; sets_of gives those of a batch of texts.

    A set is a sorted array of distinct 64-bit hashes, the same for equal texts. Texts of empty sets
    link with nothing.
    """
    ship(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    frequent = frequent_shingles(texts, sets_of, size)
    table = cut(prefixes(texts, sets_of, percent, frequent))
    docs_of = table.where("bucket is null").select("doc_id", "n", "digest", "node", "hot", "core", "rare")
    with_words = docs_of.where("n > 0 and doc_id is not null")
    named = texts.where("doc_id is not null")
    # One document stands for a node; rows are counted per node before they are joined.
    one = F.min(F.struct("doc_id", "n", "core", "rare"))
    nodes = cut(with_words.groupBy("node").agg(one.alias("d")).select("node", "d.*"))
    pairs = _candidates(table.where("bucket is not null"), percent, frequent[2])
    # Sets are even numbers, cores odd ones, and a frequent shingle is a node of its own below both.
    hot = with_words.where("core is not null").select(F.explode("hot").alias("h"), "core").distinct()
    hot = hot.select((-F.expr("(h >> 1) & 9223372036854775807") - 2).alias("a"), F.col("core").alias("b"))
    family = connected_components(pairs.unionAll(hot) if len(frequent[0]) else pairs).withColumnsRenamed({"root": "family"})
    cores = _cores(nodes)
    wanted = nodes.selectExpr("node", "doc_id", "n", "rare", "false as core_only").unionAll(
        cores.selectExpr("core as node", "doc_id", "n", "rare", "true as core_only")
    )
    families = cut(wanted.join(family, "node").drop("node"))
    found = cut(_verified(families, named, sets_of, percent, frequent))
    links = found.where("cap < 0").select("a", "b").unionAll(_of_cores(nodes, cores, found, percent))
    reps = cut(with_words.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))).where("rows > 1")
    copies = hot_left_join(with_words.select("doc_id", "digest"), reps, ["digest"], "rows").where("rep is not null")
    roots = connected_components(links.unionAll(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    roots = roots.withColumnsRenamed({"node": "doc_id", "root": "component_id"})
    return docs_of.select("doc_id", F.col("n").cast("bigint").alias("n")).join(roots, "doc_id", "left").select(
        "doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def drop_similar(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that link, directly or through others, to one of a smaller id.

    An id that comes with several texts says nothing of them: each text is judged by itself, and of one
    component's texts with the smallest id one stays. Rows that repeat id and text stay or go together;
    rows without an id stay.
    """
    rows = docs.select(F.col(id_col).alias("gone_id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("gone_sha"))
    texts = cut(rows.where("gone_id is not null").distinct())
    if texts.groupBy("gone_id").count().where("count > 1").isEmpty():
        gone = similar_components(docs, width, percent, id_col, text_col).where("component_id < doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
        return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
    texts = cut(texts.withColumn("one", F.monotonically_increasing_id()))
    sha = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    same = (docs[id_col] == texts["gone_id"]) & (sha == texts["gone_sha"])
    once = docs.join(texts, same).select(texts["one"].alias("doc_id"), docs[text_col].alias("text")).dropDuplicates(["doc_id"])
    linked = similar_components(once, width, percent).select(F.col("doc_id").alias("one"), "component_id").join(texts, "one")
    stays = linked.groupBy("component_id").agg(F.min(F.struct("gone_id", "gone_sha", "one"))["one"].alias("stays"))
    gone = cut(linked.join(stays, "component_id").where("one <> stays").select("gone_id", "gone_sha"))
    return docs.join(gone, (docs[id_col] == gone["gone_id"]) & (sha == gone["gone_sha"]), "left_anti")
