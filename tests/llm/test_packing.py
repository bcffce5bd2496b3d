"""Ids word by word against whole texts, with a memory too small for them."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import packing
from tidemark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def whole(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("known", [2, 50, packing.KNOWN_WORDS])
def test_ids_of_words_are_those_of_the_text(tokenizer, known):
    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL LIMIT 300").fetchall()]
    encoder = packing.Encoder(tokenizer_path(), True, known)
    for at in range(0, len(texts), 64):
        part = texts[at:at + 64]
        assert encoder.encode([t.encode() for t in part]) == [whole(tokenizer, t) for t in part]
    assert len(encoder.words.new) + len(encoder.words.old) <= max(known, 2)


def test_marks_letters_and_digits_in_any_order(tokenizer):
    rng = random.Random(3)
    signs = ["a", "B", "é", "É", "İ", "ß", "Σ", "é", "́", "ª", "५", "“", "…", "日", "😀", ".", ",", "'", "'s", "'LL", "'t", "!", "=", "̸", "<|", "|>", "9", "_", "-", " ", "​"]
    words = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 7))) for _ in range(20000)]
    encoder = packing.Encoder(tokenizer_path(), True)
    for at in range(0, len(words), 2000):
        part = words[at:at + 2000]
        assert encoder.encode([w.encode() for w in part]) == [whole(tokenizer, w) for w in part]


def test_a_word_of_many_texts_is_looked_up_once():
    encoder, asked = packing.Encoder(tokenizer_path(), True), []
    look_up = encoder._ids
    encoder._ids = lambda words: asked.append(len(words)) or look_up(words)
    texts = [b" the  house\t\n", b"", b"the house", b"\x0b", b"The"] * 100
    for given in (texts, pa.array([b"cut off", *texts], pa.binary()).slice(1)):
        got = encoder.encode(given)
        assert got[:5] * 100 == got
        assert got[1] == got[3] == b"" and got[0] == got[2] and got[0].startswith(got[4])
    # Beside the empty one, which white space at an end leaves.
    assert max(asked) <= 4
    assert encoder.encode([]) == [] and encoder.encode([b"", b" "]) == [b"", b""]


def test_batches_are_put_together_up_to_a_size():
    batches = [pa.RecordBatch.from_pydict({"body": pa.array([b"x" * n], pa.binary())}) for n in (10, 10, 500, 10, 10)]
    got = list(packing._gathered(iter(batches), 100))
    assert [b.num_rows for b in got] == [2, 1, 2]
    assert pa.Table.from_batches(got) == pa.Table.from_batches(batches)


def test_a_word_that_comes_again_stays():
    memory = packing.Memory(10)
    for i in range(100):
        memory.add(b"%d" % i, b"")
        memory.add(b"often", b"x")
        assert memory.get(b"often") == b"x"
        assert len(memory.new) + len(memory.old) <= 10
    assert memory.get(b"0") is None
