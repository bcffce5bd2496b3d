"""Pack documents into sequences of tokens, best fit decreasing.

1. Tokens: words repeat, so some megabytes of texts are reduced to their distinct words, and a worker
   keeps the ids of the words it has met. A new word is cut into
   its stem, in small letters, and the marks at its end, and the tokenizer is asked for parts that
   are new, many at a time. That is exact for a tokenizer that lower-cases, drops white space and
   joins neither across it nor letters with marks (``word_bpe_49k``); ``by_word=False`` encodes
   whole texts.
2. A document longer than a sequence is first cut into full windows; what is left
   over is its last piece. The pieces (numbers, no ids) are written once.
3. Pieces are dealt into groups of about ``GROUP_TOKENS`` tokens by their place in
   that table. Each group is packed by itself: pieces by falling length, each into
   the open sequence with the least room that is enough. A segment tree over the
   remaining room finds that sequence. Groups hold hundreds of sequences, so what
   the last ones of each waste is small, and no group grows with the data.

Defined results: null text counts as empty, which gives the end id alone; repeated
rows are packed as often as they occur; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import named, ready, text_of
from tidemark.session import stage

LENGTH = 4096
END_ID = 2
GROUP_TOKENS = 1 << 22
# Words that a worker remembers, in two halves: the newer half is what was met since the older one was
# full, so a word that comes again and again is never forgotten. About 150 bytes a word.
KNOWN_WORDS = 1 << 20
# Texts are encoded this many bytes at once, so that a word of all of them is looked up once.
TEXT_BYTES = 4 << 20
# New words that the tokenizer gets at once.
NEW_WORDS = 1 << 9
# ASCII punctuation; at the end of a word it is a token run of its own.
MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


class Memory:
    """Words to their ids in two generations: what the older one alone knows moves when it is met."""

    def __init__(self, most: int):
        self.most = max(2, most)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def add(self, word: bytes, ids: bytes) -> None:
        self.new[word] = ids
        if len(self.new) >= self.most // 2:
            self.new, self.old = {}, self.new

    def add_all(self, ids: dict[bytes, bytes]) -> None:
        if len(self.new) + len(ids) < self.most // 2:
            self.new.update(ids)
        else:
            for word, one in ids.items():
                self.add(word, one)

    def known(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Those of the words that it has; what the older one alone knows moves."""
        found = {w: ids for w, ids in zip(words, map(self.new.get, words), strict=True) if ids is not None}
        rest = words - found.keys()
        older = {w: ids for w, ids in zip(rest, map(self.old.get, rest), strict=True) if ids is not None}
        self.add_all(older)
        return found | older

    def get(self, word: bytes) -> bytes | None:
        found = self.new.get(word)
        if found is None and (found := self.old.get(word)) is not None:
            self.add(word, found)
        return found


class Encoder:
    """Little-endian 32-bit ids of texts in UTF-8."""

    def __init__(self, path: str, by_word: bool, known_words: int = KNOWN_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = by_word
        self.words = Memory(known_words)
        # Parts of words: lower-case stems, and marks at the end.
        self.parts = Memory(known_words)

    def _learn(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Encode words in one line; the places of the tokens tell the words apart."""
        learnt = {}
        for at in range(0, len(parts), NEW_WORDS):
            some = parts[at:at + NEW_WORDS]
            texts = [w.decode() for w in some]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            data = np.array(found.ids, dtype="<u4").tobytes()
            ends = np.cumsum([len(t) + 1 for t in texts])
            cuts = np.searchsorted([start for start, _ in found.offsets], ends).tolist()
            learnt.update(zip(some, [data[a * 4:b * 4] for a, b in zip([0, *cuts], cuts)], strict=True))
        return learnt

    @staticmethod
    def cut(word: bytes) -> tuple[bytes, bytes]:
        """A word as stem and marks, which are encoded one by one; no marks where they may not be cut off.

        The tokenizer lower-cases, and cuts between a letter and a run of marks; a small letter may end in an accent.
        """
        stem = word.rstrip(MARKS)
        if stem.isalpha() or stem and stem[-1] >= 0x80 and stem.decode()[-1].lower()[-1].isalpha():
            return stem.lower(), word[len(stem):]
        return word, b""

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        out = list(map(self.words.new.get, words))
        # What the newer generation lacks, out of the older one or out of its parts.
        lacking = [i for i, ids in enumerate(out) if ids is None]
        fresh = [words[i] for i in lacking]
        found = list(map(self.words.old.get, fresh))
        unknown = [w for w, ids in zip(fresh, found, strict=True) if ids is None]
        cut = list(map(self.cut, unknown))
        wanted = {part for both in cut for part in both}
        wanted.discard(b"")
        parts = self.parts.known(wanted)
        learnt = self._learn([part for part in wanted if part not in parts])
        self.parts.add_all(learnt)
        parts |= learnt
        parts[b""] = b""
        here = dict(zip(unknown, [parts[stem] + parts[marks] for stem, marks in cut], strict=True))
        found = [here[w] if ids is None else ids for w, ids in zip(fresh, found, strict=True)]
        for i, ids in zip(lacking, found, strict=True):
            out[i] = ids
        self.words.add_all(dict(zip(fresh, found, strict=True)))
        return out

    def encode(self, texts: list[bytes] | pa.Array) -> list[bytes]:
        if not self.by_word:
            given = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            return [np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes() for t in given]
        given = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        # Cut at ASCII white space, which the tokenizer drops. Each distinct word is looked up once.
        split = pc.ascii_split_whitespace(given.view(pa.string()))
        coded = split.flatten().dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.view(pa.binary()).to_pylist()), pa.large_binary()).take(coded.indices)
        # The ids of a text lie one behind the other.
        _, ends, data = ids.buffers()
        if not len(ids) or data is None:
            return [b""] * len(given)
        ends = np.frombuffer(ends, dtype=np.int64)[ids.offset:ids.offset + len(ids) + 1]
        cuts = ends[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        data = memoryview(data)
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]


def _encoder(path: str, by_word: bool) -> Encoder:
    """The encoder of this worker process: it serves many tasks, and what it has learnt stays."""
    import sys
    import types

    kept = vars(sys.modules.setdefault("tidemark_worker", types.ModuleType("tidemark_worker"))).setdefault("encoders", {})
    if (path, by_word) not in kept:
        kept[path, by_word] = Encoder(path, by_word)
    return kept[path, by_word]


def _gathered(parts: Iterator[pa.RecordBatch], most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``most`` bytes."""
    held, size = [], 0
    for batch in parts:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def pieces(df: DataFrame, tokenizer: str, id_col: str, text_col: str, length: int, end_id: int, by_word: bool, with_ids: bool) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens (and ids): windows of ``length``, then the rest."""
    ready(df.sparkSession)
    source = df.select(named(id_col).alias("id"), text_of(text_col).cast("binary").alias("body"))
    kind = source.schema["id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, by_word)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in _gathered(parts):
            rows, start, size, crc, total, ids = [], [], [], [], [], []
            for row, data in enumerate(encoder.encode(batch.column("body"))):
                data += end
                tokens = len(data) // 4
                for at in range(0, tokens, length):
                    window = data[at * 4:(at + length) * 4]
                    rows.append(row)
                    start.append(at)
                    size.append(len(window) // 4)
                    crc.append(zlib.crc32(window))
                    total.append(tokens)
                    if with_ids:
                        ids.append(np.frombuffer(window, dtype="<u4"))
            columns = [batch.column("id").take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, size, crc, total))]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array([x.tolist() for x in ids], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<bigint>" * with_ids
    return source.mapInArrow(batches, schema)


class Rooms:
    """Open sequences by remaining room; the least room that is enough, by a segment tree of counts."""

    def __init__(self, most: int):
        self.size = 1
        while self.size <= most:
            self.size *= 2
        self.tree = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += by
            at //= 2

    def put(self, sequence: int, room: int) -> None:
        self.open[room].append(sequence)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(sequence, room) with the least room of at least ``need``."""
        tree, at = self.tree, need + self.size
        if not tree[at]:
            # Up until a right sibling has something, then down to its leftmost.
            while at > 1 and (at % 2 or not tree[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: list[int], length: int) -> tuple[list[int], list[int]]:
    """Sequence and offset for each piece, taken by falling length."""
    rooms, used = Rooms(length), 0
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            found = used, length
            used += 1
        at, room = found
        sequence[i], offset[i] = at, length - room
        if room > lengths[i]:
            rooms.put(at, room - lengths[i])
    return sequence, offset


def pack(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    end_id: int = END_ID, by_word: bool = True, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    cut = pieces(df, tokenizer, id_col, text_col, length, end_id, by_word, with_ids)
    cut = stage(cut.withColumn("place", F.monotonically_increasing_id()), "pieces")
    tokens = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, tokens // GROUP_TOKENS)
    # A full window fills a sequence of its own, so only the rest is packed.
    rest = cut.where(F.col("length") < length).select("place", "length", F.pmod(F.xxhash64("place"), F.lit(groups)).alias("group"))

    def packed_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "place"], ascending=[False, True], ignore_index=True)
        sequence, offset = best_fit(group["length"].tolist(), length)
        # Odd numbers, apart by group; full windows take the even ones.
        ids = (np.array(sequence, dtype=np.int64) * groups + key[0]) * 2 + 1
        return pd.DataFrame({"place": group["place"], "sequence_id": ids, "offset": np.array(offset, dtype=np.int64)})

    packed = rest.groupBy("group").applyInPandas(packed_group, "place bigint, sequence_id bigint, offset bigint")
    own = ["id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    full = cut.where(F.col("length") == length).select(*own, (F.col("place") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = full.unionByName(cut.where(F.col("length") < length).join(packed, "place").select(*own, "sequence_id", "offset"))
    return out.withColumnRenamed("id", id_col)
