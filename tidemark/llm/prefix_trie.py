"""The trie of conversations that begin alike: what of them could be computed once.

1. Turns are encoded by a dictionary: a turn is known by the SHA-256 of its role and text, and
   each distinct one gets a number. Texts are read once and do not move.
2. Conversations, as lists of numbers, are rebuilt (``rebuild``) and dealt by range of (list,
   identifier) into sorted shards of about ``SHARD_TURNS`` turns. A list that very many
   conversations have fills several shards.
3. A task puts the distinct lists of its shard into a ternary search tree, the median first and
   then the medians of both halves, so that the tree is balanced. An iterative traversal adds up
   members, leaves and savings from the leaves on.
4. Only the beginnings of a shard's first and last list can go on in another shard. These boundary
   nodes are merged by a digest of their path. What hangs below them is complete; what the boundary
   nodes themselves add to those above is counted in the first shard that has them.
5. The list of members that end at a boundary node is hashed in order of shards, piece by piece.

A conversation is one value (of numbers, 16 bytes a turn).

Defined results: a null role or text is empty; a null turn goes first, and turns with equal numbers
go by role, then by digest; repeated rows are repeated turns; a null conversation is one of its own
that shares nothing, goes first and has no digits in the list of ends; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import named, ready, text_of
from tidemark.session import stage

SHARD_TURNS = 1 << 17
# Identifiers in a piece of a list of ends.
PIECE = 4096
ROWS = 4096
SPACED = r"[^\x20\x09-\x0D]+"

NODES = pa.schema([
    ("shard", pa.int64()), ("branch", pa.int32()), ("depth", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("conv", pa.int64()), ("parent_conv", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved", pa.int64()), ("words", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.list_(pa.string())),
])
NODES_DDL = (
    "shard bigint, branch int, depth bigint, key binary, parent_key binary, conv bigint, parent_conv bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, words bigint, ends_sha256 string, ends array<string>"
)
# Branches: a node inside the shard, on the way to both the first and the last list, or to one of them.
INSIDE, BOTH, FIRST, LAST = 0, 1, 2, 3


class SearchTree:
    """A ternary search tree over lists of numbers. Node 0 is the root, which no list needs a number for.

    Node n has the links 3n - 2 (smaller), 3n - 1 (next number of the list) and 3n (larger); link 0 is the top.
    """

    def __init__(self) -> None:
        self.links = [0]
        self.split = [-1]
        self.members = [0]
        self.least: list[int | None] = [None]
        self.ends = [-1]

    def insert(self, numbers: Sequence[int], list_no: int, members: int, least: int | None) -> None:
        self._count(0, members, least)
        slot = node = 0
        for number in numbers:
            node = self.links[slot]
            while node and self.split[node] != number:
                slot = 3 * node - 2 if number < self.split[node] else 3 * node
                node = self.links[slot]
            if not node:
                node = len(self.split)
                self.links[slot] = node
                self.links += (0, 0, 0)
                self.split.append(number)
                self.members.append(0)
                self.least.append(None)
                self.ends.append(-1)
            self._count(node, members, least)
            slot = 3 * node - 1
        self.ends[node] = list_no

    def _count(self, node: int, members: int, least: int | None) -> None:
        self.members[node] += members
        if least is not None and (self.least[node] is None or least < self.least[node]):
            self.least[node] = least

    def path(self, numbers: Sequence[int]) -> list[int]:
        slot, found = 0, [0]
        for number in numbers:
            node = self.links[slot]
            while self.split[node] != number:
                node = self.links[3 * node - 2 if number < self.split[node] else 3 * node]
            found.append(node)
            slot = 3 * node - 1
        return found

    def walk(self) -> Iterator[tuple[int, bool]]:
        """(node, False) on the way down and (node, True) when all below it was met; children by number."""
        yield 0, False
        todo = [(self.links[0], 0)]
        while todo:
            node, step = todo.pop()
            if step:
                yield node, step == 2
            elif node:
                todo += ((self.links[3 * node], 0), (node, 2), (self.links[3 * node - 1], 0), (node, 1), (self.links[3 * node - 2], 0))
        yield 0, True


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves."""
    todo = [(0, n)]
    while todo:
        low, high = todo.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            todo += ((middle + 1, high), (low, middle))


def _digits(conv: int | None) -> str:
    return "" if conv is None else str(conv)


def _pieces(convs: list[int | None]) -> list[str]:
    return [",".join(map(_digits, convs[at:at + PIECE])) for at in range(0, len(convs), PIECE)]


def shard_nodes(shard: int, lists: list[tuple[int, ...]], owners: list[list[int | None]], words_of: dict[int, int]) -> Iterator[tuple]:
    """The nodes (as ``NODES``) of the sorted, distinct lists of a shard."""
    tree = SearchTree()
    for i in medians(len(lists)):
        known = [c for c in owners[i] if c is not None]
        tree.insert(lists[i], i, len(owners[i]), min(known, default=None))
    first, last = tree.path(lists[0]), tree.path(lists[-1])
    branch: dict[int, int] = {}
    keys: dict[int, bytes] = {}
    for way, name in ((first, FIRST), (last, LAST)):
        digest = b""
        for node in way:
            if node:
                digest = hashlib.sha256(digest + tree.split[node].to_bytes(8, "big")).digest()
            keys[node] = digest
            branch[node] = BOTH if branch.get(node, name) != name else name
    # Per open node: children, leaves and savings of what is complete below it.
    path: list[int] = []
    below: list[list[int]] = []
    for node, done in tree.walk():
        if not done:
            path.append(node)
            below.append([0, 0, 0])
            continue
        path.pop()
        children, leaves, saved = below.pop()
        words = words_of[tree.split[node]] if node else 0
        ends = owners[tree.ends[node]] if tree.ends[node] >= 0 else []
        parent = path[-1] if path else None
        parent_key = None if parent is None else keys.get(parent)
        common = (len(path), keys.get(node), parent_key, tree.least[node])
        if node in branch:
            yield (shard, branch[node], *common, None, tree.members[node], children, leaves, saved, words, None, _pieces(ends))
            continue
        leaves += children == 0
        saved += (tree.members[node] - 1) * words
        above = below[-1]
        above[0] += 1
        above[1] += leaves
        above[2] += saved
        digest = hashlib.sha256(",".join(map(_digits, ends)).encode()).hexdigest()
        yield (shard, INSIDE, *common, tree.least[parent], tree.members[node], children, leaves, saved, words, digest, None)


def encode(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turns (array of struct number, words): each conversation in its order, turns by dictionary."""
    role, text = text_of(role_col), text_of(text_col)
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = stage(df.select(
        named(conv_col).cast("long").alias("conv"), named(turn_col).alias("turn"), role.alias("role"), digest.alias("digest"),
        F.regexp_count(text, F.lit(SPACED)).cast("long").alias("words"),
    ), "turns")
    dictionary = stage(rows.select("digest").distinct().withColumn("number", F.monotonically_increasing_id()), "dictionary")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "digest", "number", "words")
    listed = F.array_sort(F.collect_list(turn))
    short = F.transform(listed, lambda t: F.struct(t["number"].alias("number"), t["words"].alias("words")))
    return rows.join(dictionary, "digest").groupBy("conv").agg(short.alias("turns"))


def rebuild(convs: DataFrame, group: int, shares: int) -> DataFrame:
    """conv, turns: the first h turns of the first conversation of the ``group``, then its own after its first h.

    h is the CRC-32 of the identifier's digits modulo ``shares``.
    """
    h = F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % shares, F.lit(0)).cast("int")
    heads = convs.select(F.col("conv").alias("base"), F.slice("turns", 1, max(shares - 1, 1)).alias("head"))
    own = convs.withColumns({"base": F.col("conv") - F.pmod("conv", F.lit(group)), "h": h})
    taken = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("conv", F.concat(taken, rest).alias("turns"))


def _in_order(pieces: DataFrame) -> DataFrame:
    """key, ends_sha256 out of (key, shard, place, piece): the pieces of a key are hashed one after another."""
    ordered = pieces.repartition("key").sortWithinPartitions("key", "shard", "place").select("key", "piece")

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for part in parts:
            done = []
            for key, piece in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if digest is None or key != last:
                    if digest is not None:
                        done.append((last, digest.hexdigest()))
                    last, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
            yield _ends(done)
        if digest is not None:
            yield _ends([(last, digest.hexdigest())])

    return ordered.mapInArrow(work, "key binary, ends_sha256 string")


def _ends(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, digests = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "ends_sha256"])


def trie_nodes(rebuilt: DataFrame, shard_turns: int) -> DataFrame:
    """The nodes of each shard (``NODES``), written once."""
    turns = rebuilt.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    lists = rebuilt.select("conv", F.col("turns.number").alias("numbers"), F.col("turns.words").alias("words"))
    dealt = lists.repartitionByRange(max(1, -(-turns // shard_turns)), "numbers", "conv").sortWithinPartitions("numbers", "conv")

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, ...]] = []
        owners: list[list[int | None]] = []
        words_of: dict[int, int] = {}
        shard = 0
        for part in parts:
            shard = part.column("shard")[0].as_py() if part.num_rows else shard
            for conv, numbers, words in zip(*(part.column(c).to_pylist() for c in ("conv", "numbers", "words")), strict=True):
                words_of.update(zip(numbers, words, strict=True))
                numbers = tuple(numbers)
                if not found or found[-1] != numbers:
                    found.append(numbers)
                    owners.append([])
                owners[-1].append(conv)
        rows: list[tuple] = []
        for row in shard_nodes(shard, found, owners, words_of) if found else ():
            rows.append(row)
            if len(rows) == ROWS:
                yield _nodes(rows)
                rows = []
        yield _nodes(rows)

    return stage(dealt.withColumn("shard", F.spark_partition_id().cast("long")).mapInArrow(work, NODES_DDL), "trie")


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in NODES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODES, strict=True)], schema=NODES)


def merge_boundaries(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boundary nodes, whole, and per shard the identifier of each: what nodes inside ask their parents for."""
    edges = nodes.where(F.col("branch") != INSIDE)
    merged = edges.groupBy("key").agg(
        F.min("shard").alias("first"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.min("conv").alias("conv"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("hanging"), F.max("words").alias("words"),
    )
    children = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("merged_children"))
    total = F.col("hanging") + F.coalesce("merged_children", F.lit(0))
    merged = stage(merged.join(children, "key", "left").withColumn("n_children", total).drop("hanging", "merged_children"), "boundaries")

    # What a boundary node adds itself, to it and those above, counts in one shard.
    own = merged.select("key", "first", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    mine = F.col("shard") == F.col("first")
    each = edges.select("shard", "branch", "depth", "key", "n_leaves", "saved").join(own, "key").select(
        "shard", "branch", "depth", "key", (F.col("n_leaves") + F.when(mine, F.col("leaf")).otherwise(0)).alias("leaves"),
        (F.col("saved") + F.when(mine, F.col("own")).otherwise(0)).alias("saved"),
    )

    def upwards(name: str) -> Column:
        """Sums from the ends of a shard's two ways up; where they are one way, of both."""
        deep = F.col("depth").desc()
        both, one = Window.partitionBy("shard").orderBy(deep), Window.partitionBy("shard", "branch").orderBy(deep)
        return F.when(F.col("branch") == BOTH, F.sum(name).over(both)).otherwise(F.sum(name).over(one)).alias(name)

    sums = each.select("key", upwards("leaves"), upwards("saved")).groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    pieces = edges.select("key", "shard", F.posexplode("ends").alias("place", "piece"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv"))
    whole = merged.join(sums, "key").join(_in_order(pieces), "key", "left").join(parents, "parent_key", "left")
    whole = whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    return whole, edges.select("shard", "key").join(merged.select("key", "conv"), "key")


def prefix_trie(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    group: int = 20, shares: int = 4, shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ready(df.sparkSession)
    convs = stage(encode(df, conv_col, turn_col, role_col, text_col), "conversations")
    nodes = trie_nodes(stage(rebuild(convs, group, shares), "rebuilt"), shard_turns)
    whole, per_shard = merge_boundaries(nodes)
    inside = nodes.where(F.col("branch") == INSIDE)
    # Below a boundary node the parent's smallest member may be in another shard.
    known = inside.where(F.col("parent_key").isNull())
    asked = inside.where(F.col("parent_key").isNotNull()).drop("parent_conv").join(
        per_shard.select("shard", F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv")), ["shard", "parent_key"]
    )
    out = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    rows = known.select(*out).unionByName(asked.select(*out)).unionByName(whole.select(*out))
    return rows.withColumnsRenamed({"conv": "conv_id", "parent_conv": "parent_conv_id", "saved": "saved_tokens"})
