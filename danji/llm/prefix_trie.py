"""Prefix trie of conversations: ternary search trees per range shard, merged at the shards' edges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from danji.llm.common import cut, ship

#: A block, which is one tree, ends with the conversation that reaches so many turns, and so many members.
BLOCK_TURNS, BLOCK_MEMBERS = 1 << 18, 1 << 16
#: A turn is common that makes up more than this part of all turns; there are fewer such turns than that.
COMMON_PART = 4096

WORD = r"[^\x20\x09-\x0D]+"

NODE = (
    "conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "ends_sha256 string, parent_conv_id bigint, up_part int, up_block bigint, up_place bigint"
)
#: What a tree says of a node: final, or (inner false) to be merged with its neighbours'.
SHARD = f"{NODE}, inner boolean, part int, block bigint, place bigint, turn_id bigint, words bigint, ends array<bigint>"
#: A merged node, or (node false) the conversation that an address stands for.
MERGED = f"{NODE}, node boolean, part int, block bigint, place bigint"

ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}


def coded_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, turn_id, words) of each turn; the texts stay where they are read.

    A turn's number comes from a dictionary of all distinct (role, text), in the order of their
    SHA-256; null roles and texts are empty. Rows without a conversation are left out. Common turns,
    of which there are fewer than COMMON_PART, are looked up in a broadcast table, so that a turn with
    which a third of all conversations begins is dealt over all tasks.
    """
    role_, text_ = F.coalesce(turns[role], F.lit("")), F.coalesce(turns[text], F.lit(""))
    whole = F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)
    rows = cut(
        turns.where(turns[conv].isNotNull()).select(
            turns[conv].cast("bigint").alias("conv_id"), turns[turn].cast("bigint").alias("turn"),
            F.unhex(F.sha2(whole, 256)).alias("digest"), F.regexp_count(text_, F.lit(WORD)).cast("bigint").alias("words"),
        )
    )
    counts = rows.groupBy("digest").agg(F.max("words").alias("words"), F.count("*").alias("n"))
    # Numbers follow the digests: the partitions are ranges, and the written rows keep their order.
    dictionary = cut(counts.repartitionByRange("digest").sortWithinPartitions("digest")).withColumn(
        "turn_id", F.monotonically_increasing_id()
    )
    total = dictionary.agg(F.sum("n")).first()[0] or 0
    common = F.col("n") * COMMON_PART > total
    rows = rows.drop("words")
    looked_up = rows.join(F.broadcast(dictionary.where(common).drop("n")), "digest")
    others = rows.join(F.broadcast(dictionary.where(common).select("digest")), "digest", "left_anti")
    return looked_up.unionByName(others.join(dictionary.where(~common).drop("n"), "digest")).drop("digest")


def sequences(coded: DataFrame) -> DataFrame:
    """(conv_id, ids, words): each conversation's turns in order, null first, equal numbers by turn_id."""
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "turn_id", "words")
    return coded.groupBy("conv_id").agg(F.array_sort(F.collect_list(order)).alias("t")).select(
        "conv_id", F.col("t.turn_id").alias("ids"), F.col("t.words").alias("words")
    )


def common_length(a: list[int], b: list[int]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def ids_digest(ids: Iterable[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


NO_IDS = ids_digest([])


class Tree:
    """A ternary search tree over distinct sequences in order; node 0 is the root of the trie.

    low, equal and high are links; a node's parent in the trie is the last node from which an equal
    link was taken, and it is older than the node.
    """

    def __init__(self, paths: list[list[int]], words: list[list[int]]):
        self.turn, self.words, self.parent = [0], [0], [0]
        self.low, self.equal, self.high = [0], [0], [0]
        self.ends = [0] * len(paths)
        # The middle one first, then the middles of both halves: every set of siblings is balanced.
        spans = [(0, len(paths))]
        for a, b in spans:
            if a < b:
                middle = (a + b) // 2
                self.ends[middle] = self._insert(paths[middle], words[middle])
                spans += [(a, middle), (middle + 1, b)]

    def _insert(self, path: list[int], words: list[int]) -> int:
        turn, low, equal, high = self.turn, self.low, self.equal, self.high
        links, at = equal, 0
        above = 0
        for t, w in zip(path, words):
            while (node := links[at]) and turn[node] != t:
                links, at = (low if t < turn[node] else high), node
            if not node:
                node = links[at] = len(turn)
                turn.append(t)
                self.words.append(w)
                self.parent.append(above)
                low.append(0)
                equal.append(0)
                high.append(0)
            above = at = node
            links = equal
        return above

    def path(self, end: int) -> list[int]:
        out = [end]
        while out[-1]:
            out.append(self.parent[out[-1]])
        return out[::-1]

    def in_order(self) -> Iterator[tuple[int, int]]:
        """(node, depth), parents before children and siblings in order, without recursion."""
        yield 0, 0
        waiting = [(self.equal[0], 1, False)]
        while waiting:
            node, depth, ready = waiting.pop()
            if not node:
                continue
            if ready:
                yield node, depth
                continue
            waiting += [
                (self.high[node], depth, False), (self.equal[node], depth + 1, False),
                (node, depth, True), (self.low[node], depth, False),
            ]


def block_rows(part: int, block: int, paths, words, members, left: int, right: int) -> Iterator[dict]:
    """The nodes of one block. left, right: how many turns its first and last path share with the neighbours."""
    tree = Tree(paths, words)
    size = len(tree.turn)
    first, last = tree.path(tree.ends[0])[: left + 1], tree.path(tree.ends[-1])[: right + 1]
    place = {node: i for i, node in enumerate(dict.fromkeys([*first, *last]))}
    ending = {tree.ends[i]: ids for i, ids in enumerate(members)}
    n, least = [0] * size, [None] * size
    children, leaves, saved, depths = [0] * size, [0] * size, [0] * size, [0] * size
    order = []
    for node, depth in tree.in_order():
        order.append(node)
        depths[node] = depth
    for node, ids in ending.items():
        n[node], least[node] = len(ids), ids[0]
    for node in reversed(order):
        inner = node not in place
        if inner:
            leaves[node] = leaves[node] or 1
            saved[node] += (n[node] - 1) * tree.words[node]
        if node:
            up = tree.parent[node]
            n[up] += n[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            if inner:
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
    for node in order:
        at, up = place.get(node), tree.parent[node]
        above = place.get(up) if node else None
        yield {
            "conv_id": least[node], "depth": depths[node], "n_convs": n[node], "n_children": children[node],
            "n_leaves": leaves[node], "saved_tokens": saved[node],
            "ends_sha256": None if at is not None else ids_digest(ending[node]) if node in ending else NO_IDS,
            "parent_conv_id": least[up] if node and above is None else None,
            "up_part": None if above is None else part, "up_block": None if above is None else block, "up_place": above,
            "inner": at is None, "part": part, "block": block, "place": at,
            "turn_id": tree.turn[node], "words": tree.words[node], "ends": ending.get(node) if at is not None else None,
        }


def batches_of(rows: Iterator[dict], schema: str, size: int = 8192) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([(c.split()[0], ARROW[c.split()[1]]) for c in schema.split(", ")])
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, kinds)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, kinds)


def shard_rows(batches: Iterator[pa.RecordBatch], most_turns: int, most_members: int) -> Iterator[dict]:
    """The nodes of a shard's sorted sequences, block by block."""
    part = TaskContext.get().partitionId()
    block, turns, count, left = 0, 0, 0, None
    paths, words, members = [], [], []
    for batch in batches:
        for conv, ids, lengths in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if turns >= most_turns or count >= most_members:
                right = common_length(paths[-1], ids)
                yield from block_rows(part, block, paths, words, members, len(paths[0]) if left is None else left, right)
                block, turns, count, left = block + 1, 0, 0, right
                paths, words, members = [], [], []
            if paths and paths[-1] == ids:
                members[-1].append(conv)
            else:
                paths.append(ids)
                words.append(lengths)
                members.append([conv])
                turns += len(ids)
            count += 1
    if paths:
        # What lies beyond a shard isn't known here: its outermost paths are left open in whole.
        yield from block_rows(part, block, paths, words, members, len(paths[0]) if left is None else left, len(paths[-1]))


class Open:
    """A node of the merge that may still grow."""

    __slots__ = ("turn", "words", "n", "least", "children", "leaves", "saved", "sha", "some", "places")

    def __init__(self, turn: int, words: int):
        self.turn, self.words = turn, words
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.some, self.sha, self.places = None, False, hashlib.sha256(), []

    def add(self, row: dict) -> None:
        self.n += row["n_convs"]
        self.least = row["conv_id"] if self.least is None else min(self.least, row["conv_id"])
        self.children += row["n_children"]
        self.leaves += row["n_leaves"]
        self.saved += row["saved_tokens"]
        if row["ends"]:
            self.sha.update((("," if self.some else "") + ",".join(map(str, row["ends"]))).encode())
            self.some = True
        self.places.append((row["part"], row["block"], row["place"]))


def merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The open nodes of all blocks, in the order of their paths, merged along one path at a time."""
    empty = dict.fromkeys(c.split()[0] for c in MERGED.split(", "))
    path: list[Open] = []

    def close() -> Iterator[dict]:
        node = path.pop()
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.words
        up = (None, None, None)
        if path:
            above = path[-1]
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            up = above.places[0]
        yield empty | {
            "conv_id": node.least, "depth": len(path), "n_convs": node.n, "n_children": node.children, "n_leaves": node.leaves,
            "saved_tokens": node.saved, "ends_sha256": node.sha.hexdigest(), "node": True,
            "up_part": up[0], "up_block": up[1], "up_place": up[2],
        }
        for part, block, place in node.places:
            yield empty | {"conv_id": node.least, "node": False, "part": part, "block": block, "place": place}

    for batch in batches:
        for row in batch.to_pylist():
            depth = row["depth"]
            if len(path) > depth and path[depth].turn != row["turn_id"]:
                while len(path) > depth:
                    yield from close()
            if len(path) == depth:
                path.append(Open(row["turn_id"], row["words"]))
            path[depth].add(row)
    while path:
        yield from close()


def trie(paths: DataFrame, block_turns: int = BLOCK_TURNS, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """The trie of the sequences of paths (conv_id, ids, words): one row per node.

    Columns: conv_id (its smallest member), depth, parent_conv_id (its parent's; null for the root),
    n_convs, n_children, n_leaves (childless nodes in its subtree), saved_tokens (over its subtree,
    (n_convs - 1) times the words of a node's last turn), ends_sha256 (SHA-256 of the ascending,
    comma-joined ids of the members that end there). A subtree includes its top. An empty sequence
    is a member of the root alone; an empty table has no nodes, not even a root.

    Sequences are sorted and dealt by ranges of (ids, conv_id), so equal sequences are split too. A
    shard is taken in blocks of bounded size, each a ternary search tree. Nodes whose members all lie in
    one block are final; the few on a block's edges are merged in one pass that holds one path, in
    path order. They are, of each block, the turns it shares with the next one, and of each shard its
    outermost paths. A SHA-256 can only be taken one id after another, so of the ids of conversations
    that are equal across blocks, eight bytes each, the merge reads all. A task holds a sequence as a
    whole, 16 bytes a turn.
    """
    ship(paths.sparkSession)
    dealt = paths.select("conv_id", "ids", "words").repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    shards = cut(dealt.mapInArrow(lambda batches: batches_of(shard_rows(batches, block_turns, block_members), SHARD), SHARD))
    edges = shards.where(~F.col("inner")).repartition(1).sortWithinPartitions("part", "block", "place")
    merged = cut(edges.mapInArrow(lambda batches: batches_of(merged_rows(batches), MERGED, 1024), MERGED))

    places = merged.where(~F.col("node")).selectExpr("part", "block", "place", "conv_id as above")
    columns = [c.split()[0] for c in NODE.split(", ")]
    under_edge = shards.where(F.col("inner") & F.col("up_place").isNotNull()).select(*columns).unionByName(merged.where("node").select(*columns))
    here = F.expr("up_part = part and up_block = block and up_place = place")
    out = [c for c in columns if not c.startswith("up_")]
    placed = under_edge.join(places, here, "left").withColumn("parent_conv_id", F.col("above")).select(*out)
    return shards.where(F.col("inner") & F.col("up_place").isNull()).select(*out).unionByName(placed)


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations of turns: see trie; a turn is its role and text.

    Turns are ordered by number, null first, equal numbers by the SHA-256 of role and text; repeated
    rows are repeated turns. Null roles and texts are empty, rows without a conversation are left
    out, other columns are not read. Texts of any length are read once, where they lie.
    """
    return trie(sequences(coded_turns(turns, conv, turn, role, text)))


def rebuilt(paths: DataFrame, head: Column, base: Column, most: int) -> DataFrame:
    """paths with the first `head` turns (at most `most`) taken from conversation `base`, if there is one."""
    heads = paths.select(
        F.col("conv_id").alias("base_id"), F.slice("ids", 1, most).alias("base_ids"), F.slice("words", 1, most).alias("base_words")
    )
    joined = paths.withColumn("base", base).withColumn("head", head).join(heads, F.col("base") == F.col("base_id"), "left")

    def spliced(own: str, other: str) -> Column:
        return F.expr(f"concat(slice(coalesce({other}, array()), 1, head), slice({own}, head + 1, size({own})))")

    return joined.select("conv_id", spliced("ids", "base_ids").alias("ids"), spliced("words", "base_words").alias("words"))
