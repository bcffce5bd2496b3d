"""Benchmark passages in documents, by a positional inverted index spread over shards of documents.

1. Windows: runs of ``window`` words of the benchmark's items (a shorter item is one
   window), distinct, in blocks of at most ``BLOCK_WINDOWS``. A block is a set of queries;
   each is sent to all tasks, and the documents are searched once per block.
2. Index: a task gathers documents into shards of about ``SHARD_WORDS`` words and stores,
   per shard, the postings (term, place) of the block's terms. A word of which too few such
   terms stand within ``window + slop`` words cannot be part of a match, and is not posted.
   The index is written to the shared folder, one row per shard.
3. Search: for each window all of whose terms the shard has, the places of its rarest term
   there, shifted by the term's offset, are intersected with those of the next rarest, and
   so on: what is left are exact phrases. Proximity goes the same way: near the rarest term
   the next ones must have a place, and what is left is held against the least span that
   has all terms.
4. Spans and windows of a document, over all blocks, are put together by document.

A phrase is a window's words one after another. A proximity match is all distinct words of
a window, in any order, within ``slop`` words more than the window has; every phrase is one.

Defined results: null text has no words; an item without words is in no document; items
are counted by identifier, so repeated rows of the benchmark count once, and a null
identifier counts as an item with an empty name; repeated documents are found each; an
empty benchmark hits nothing; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import WORDS, lower_ascii, named, ready, text_of, word_runs
from tidemark.session import stage

WINDOW = 10
SLOP = 5
SHARD_WORDS = 1 << 17
# Windows that are searched for at once: some tens of megabytes in each worker.
BLOCK_WINDOWS = 1 << 18
# Places of a rarest term that are followed at once.
FOLLOWED = 1 << 20
INDEX = "uids array<bigint>, starts binary, sizes binary, terms binary, places binary"


def windows_of(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """item (text), words: one row per window of an item."""
    words = F.regexp_extract_all(lower_ascii(text_of(text_col)), F.lit(WORDS), F.lit(0))
    rows = items.select(F.coalesce(named(item_col).cast("string"), F.lit("")).alias("item"), words.alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    starts = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("w", i + 1, window), " "))
    return rows.select("item", F.explode(starts).alias("words"))


class Queries:
    """A block of windows as a matrix of terms (-1 beyond the end of a short one)."""

    def __init__(self, ids: list[int], texts: list[str], window: int, slop: int):
        self.ids = np.array(ids, dtype=np.int64)
        self.reach = window + slop
        self.slop = slop
        self.terms: dict[bytes, int] = {}
        listed = [[self.terms.setdefault(w, len(self.terms)) for w in t.encode().split(b" ")] for t in texts]
        self.sizes = np.array([len(t) for t in listed], dtype=np.int64)
        self.matrix = np.full((len(listed), window), -1, dtype=np.int64)
        for row, t in zip(self.matrix, listed, strict=True):
            row[:len(t)] = t
        # Per term: how many of the block's terms stand together in a match that has it, at least.
        needs = np.array([len(set(t)) for t in listed], dtype=np.int64)
        self.needs = np.full(len(self.terms), window, dtype=np.int64)
        for column in self.matrix.T:
            used = column >= 0
            np.minimum.at(self.needs, column[used], needs[used])

    @classmethod
    def of(cls, state: dict) -> Queries:
        """Out of plain values, so that a task needs no class of this module to read them."""
        made = cls.__new__(cls)
        vars(made).update(state)
        return made

    def codes(self, body: bytes) -> np.ndarray:
        """The terms of a text, -1 where a word is none."""
        parts = [np.fromiter(map(self.terms.get, w, repeat(-1)), np.int32, len(w)) for w in word_runs(body)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def postings(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and places, by term and place, of the words that can be part of a match."""
        known = codes >= 0
        upto = np.concatenate(([0], np.cumsum(known)))
        # most[s]: terms within the span that starts at s; spans may begin before the first word.
        begins = np.arange(-self.reach + 1, len(codes))
        span = upto[np.clip(begins + self.reach, 0, len(codes))] - upto[np.clip(begins, 0, len(codes))]
        most = reduce(np.maximum, (span[k:k + len(codes)] for k in range(self.reach)))
        places = np.flatnonzero(known)
        terms = codes[places]
        good = most[places] >= self.needs[terms]
        terms, places = terms[good], places[good]
        order = np.argsort(terms, kind="stable")
        return terms[order].astype("<i4"), places[order].astype("<i8")


class Shard:
    """Postings of a shard: places by term, and all of them as sorted keys."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, length: int, vocabulary: int):
        self.places, self.length = places, length
        self.counts = np.bincount(terms, minlength=vocabulary)
        self.starts = np.cumsum(self.counts) - self.counts
        self.keys = terms.astype(np.int64) * length + places

    def has(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        inside = (places >= 0) & (places < self.length)
        wanted = terms * self.length + places
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return inside & (self.keys[at] == wanted)

    def around(self, terms: np.ndarray, places: np.ndarray, far: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest places of the terms at or before, and at or after; beyond ``far`` they count as far away."""
        wanted = terms * self.length + places
        after = np.searchsorted(self.keys, wanted, "left")
        right = self.keys[np.minimum(after, len(self.keys) - 1)] - wanted
        right = np.where((after < len(self.keys)) & (right >= 0) & (places + right < self.length), right, far)
        before = np.searchsorted(self.keys, wanted, "right") - 1
        left = wanted - self.keys[np.maximum(before, 0)]
        left = np.where((before >= 0) & (left >= 0) & (left <= places), left, far)
        return places - np.minimum(left, far), places + np.minimum(right, far)

    def followed(self, rarest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, places) of the rarest term of each row, some at a time."""
        amounts = self.counts[rarest]
        cut = 0
        while cut < len(rarest):
            total = np.cumsum(amounts[cut:])
            end = cut + max(1, int(np.searchsorted(total, FOLLOWED, "right")))
            some = amounts[cut:end]
            rows = np.repeat(np.arange(cut, end), some)
            within = np.arange(len(rows)) - np.repeat(np.cumsum(some) - some, some)
            yield rows, self.places[np.repeat(self.starts[rarest[cut:end]], some) + within]
            cut = end


def search(queries: Queries, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases as (row of the window, start) and proximity matches as (row, a place in it)."""
    none = np.zeros(0, np.int64)
    if not len(shard.keys) or not len(queries.ids):
        return none, none, none, none
    used = queries.matrix >= 0
    counts = np.where(used, shard.counts[np.maximum(queries.matrix, 0)], np.iinfo(np.int64).max)
    live = np.flatnonzero((counts > 0).all(axis=1))
    order = np.argsort(counts[live], axis=1, kind="stable")
    terms = np.take_along_axis(queries.matrix[live], order, axis=1)
    sizes = queries.sizes[live]
    phrase_rows, phrase_at, near_rows, near_at = [none], [none], [none], [none]
    for rows, places in shard.followed(terms[:, 0]):
        at_rows, at = rows, places - order[rows, 0]
        for k in range(1, terms.shape[1]):
            # Beyond the end of a short window nothing is asked for.
            asked = k < sizes[at_rows]
            good = ~asked | shard.has(terms[at_rows, k], at + order[at_rows, k])
            at_rows, at = at_rows[good], at[good]
        phrase_rows.append(live[at_rows])
        phrase_at.append(at)

        far = queries.reach
        span = sizes + queries.slop
        lefts, rights = [], []
        for k in range(1, terms.shape[1]):
            asked = k < sizes[rows]
            left, right = shard.around(np.maximum(terms[rows, k], 0), places, far)
            left, right = np.where(asked, left, places), np.where(asked, right, places)
            good = (places - left < span[rows]) | (right - places < span[rows])
            rows, places = rows[good], places[good]
            lefts, rights = [x[good] for x in (*lefts, left)], [x[good] for x in (*rights, right)]
        # A match begins at the rarest term or at a place left of it; terms that are not left of it by then end it.
        least = np.full(len(rows), far + 1)
        for begin in (places, *lefts):
            ends = reduce(np.maximum, (np.where(left >= begin, places, right) for left, right in zip(lefts, rights, strict=True)), places)
            least = np.minimum(least, ends - begin + 1)
        near = least <= span[rows]
        near_rows.append(live[rows[near]])
        near_at.append(places[near])
    return tuple(np.concatenate(x) for x in (phrase_rows, phrase_at, near_rows, near_at))


def index(source: DataFrame, queries: Queries, shard_words: int) -> DataFrame:
    """The postings of ``source`` (uid, id, body): one row per shard, with the rows it holds."""
    shared = source.sparkSession.sparkContext.broadcast(vars(queries))
    kind = source.schema["id"].dataType.simpleString()

    def shards(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Queries.of(shared.value)
        # Documents stand as far apart that no match can have words of two.
        gap = np.full(known.reach, -1, np.int32)
        held: list[tuple] = []
        words = 0

        def row() -> pa.RecordBatch:
            sizes = np.array([len(h[2]) for h in held], dtype="<i8")
            starts = (np.cumsum(sizes + len(gap)) - sizes - len(gap)).astype("<i8")
            terms, places = known.postings(np.concatenate([x for h in held for x in (h[2], gap)]))
            ids = pa.concat_arrays([h[1] for h in held])
            listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            uids = pa.array([[h[0] for h in held]], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [uids, listed, *(pa.array([x.tobytes()], pa.binary()) for x in (starts, sizes, terms, places))],
                names=["uids", "ids", "starts", "sizes", "terms", "places"],
            )

        for part in parts:
            uids, ids = part.column("uid").to_pylist(), part.column("id")
            for i, body in enumerate(part.column("body")):
                codes = known.codes(body.as_py() or b"")
                held.append((uids[i], ids.slice(i, 1), codes))
                words += len(codes) + len(gap)
                if words >= shard_words:
                    yield row()
                    held.clear()
                    words = 0
        if held:
            yield row()

    schema = INDEX.replace("uids array<bigint>,", f"uids array<bigint>, ids array<{kind}>,")
    return stage(source.mapInArrow(shards, schema), "postings")


def matches(postings: DataFrame, queries: Queries) -> DataFrame:
    """uid, id, n_words, spans, windows, near: what each document has of a block of windows."""
    shared = postings.sparkSession.sparkContext.broadcast(vars(queries))

    def per_document(known: Queries, row: dict) -> list[dict]:
        starts, sizes = (np.frombuffer(row[c], dtype="<i8") for c in ("starts", "sizes"))
        length = int(starts[-1] + sizes[-1] + known.reach)
        shard = Shard(np.frombuffer(row["terms"], dtype="<i4"), np.frombuffer(row["places"], dtype="<i8"), length, len(known.terms))
        rows, at, near_rows, near_at = search(known, shard)
        change = np.zeros(length + 1, dtype=np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + known.sizes[rows], -1)
        covered = np.cumsum(change) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], covered)).astype(np.int8)))
        found = [{"spans": [], "windows": set(), "near": set()} for _ in starts]

        begins, ends = edges[::2], edges[1::2]
        docs = np.searchsorted(starts, begins, "right") - 1
        for doc, start, end in zip(docs.tolist(), (begins - starts[docs]).tolist(), (ends - starts[docs]).tolist(), strict=True):
            found[doc]["spans"].append({"start": start, "end": end})
        for how, hit_rows, places in (("windows", rows, at), ("near", near_rows, near_at)):
            docs = np.searchsorted(starts, places, "right") - 1
            for doc, window in zip(docs.tolist(), known.ids[hit_rows].tolist(), strict=True):
                found[doc][how].add(window)
        return [f | {"n_words": int(n)} for f, n in zip(found, sizes, strict=True)]

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Queries.of(shared.value)
        for part in parts:
            ids = part.column("ids")
            for i, row in enumerate(part.drop_columns(["ids"]).to_pylist()):
                docs = per_document(known, row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["uids"], pa.int64()), ids[i].values, pa.array([d["n_words"] for d in docs], pa.int64()),
                    pa.array([d["spans"] for d in docs], spans),
                    *(pa.array([sorted(d[c]) for d in docs], pa.list_(pa.int64())) for c in ("windows", "near")),
                ], names=["uid", "id", "n_words", "spans", "windows", "near"])

    kind = postings.schema["ids"].dataType.elementType.simpleString()
    schema = f"uid bigint, id {kind}, n_words bigint, spans array<struct<start:bigint,end:bigint>>, windows array<bigint>, near array<bigint>"
    return postings.mapInArrow(work, schema)


def merged_spans(found: DataFrame) -> DataFrame:
    """uid, spans, n_hit: the spans of all blocks, those that overlap or touch made one."""
    each = found.select("uid", F.inline("spans"))
    upto = F.max("end").over(Window.partitionBy("uid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    begins = each.withColumn("first", F.coalesce(F.col("start") > upto, F.lit(True)).cast("int"))
    group = F.sum("first").over(Window.partitionBy("uid").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    whole = begins.withColumn("group", group).groupBy("uid", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("n_hit"),
    )


def decontaminate(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    window: int = WINDOW, slop: int = SLOP, shard_words: int = SHARD_WORDS, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: id, n_words, spans (of exact phrases), n_hit (words in them), items, near_items.

    ``items`` are the names of the items with a phrase in the document, ``near_items`` of those with a
    proximity match, sorted as text.
    """
    ready(df.sparkSession)
    listed = windows_of(benchmark, item_col, item_text, window)
    distinct = stage(listed.select("words").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    owners = listed.distinct().join(distinct, "words").select("window", "item")
    blocks = max(1, -(-distinct.count() // block_windows))
    source = df.select(
        F.monotonically_increasing_id().alias("uid"), named(id_col).alias("id"), named(text_col).cast("string").cast("binary").alias("body")
    )
    if blocks > 1:
        # Each block reads the documents again, so their numbers are written down.
        source = stage(source, "numbered")
    parts = []
    for block in range(blocks):
        rows = distinct.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).collect()
        queries = Queries([r["window"] for r in rows], [r["words"] for r in rows], window, slop)
        parts.append(stage(matches(index(source, queries, shard_words), queries), "matches"))
    documents, found = parts[0].select("uid", "id", "n_words"), reduce(DataFrame.unionByName, parts)

    # Every phrase is a proximity match too.
    hit = found.where(F.size("near") > 0)
    windows = [hit.select("uid", F.explode(c).alias("window"), F.lit(c == "windows").alias("exact")) for c in ("near", "windows")]
    items = windows[0].unionByName(windows[1]).join(owners, "window").groupBy("uid", "item").agg(F.max("exact").alias("exact")).groupBy("uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"), F.array_sort(F.collect_list("item")).alias("near_items"),
    )
    none = F.array().cast("array<string>")
    return documents.join(items.join(merged_spans(hit), "uid", "left"), "uid", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"),
    )
