"""Texts with very many matches, turns and tags: places as in plain Python, time in proportion."""

import hashlib
import re
import time

from pyspark.sql import functions as F

from tidemark.llm import chat, html_text, secrets
from tidemark.llm.common import running_sums


def seconds(run):
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def test_running_sums(spark):
    lists = [[], [5], list(range(255)), list(range(256)), list(range(257)), [1] * 2000]
    df = spark.createDataFrame([(x,) for x in lists], "x array<int>").select("x", running_sums(F.col("x")).alias("sums"))
    for r in df.collect():
        assert r.sums == [sum(r.x[:i]) for i in range(len(r.x))]


def test_many_secrets_in_one_text(spark):
    def text(n):
        return " ".join(hashlib.sha256(str(i).encode()).hexdigest()[:20] for i in range(n))

    def scan(n):
        return secrets.scan_secrets(spark.createDataFrame([(1, text(n))], "doc_id int, text string")).collect()[0]

    found = scan(3000)
    places = [m.span() for m in re.finditer("[0-9a-f]{16,}", text(3000))]
    assert [(s.start, s.end) for s in found.found if s.kind == "hex"] == places
    assert seconds(lambda: scan(32000)) < 5 * seconds(lambda: scan(8000)) + 2


def test_many_turns_in_one_conversation(spark):
    def read(n):
        rows = spark.range(n).select(
            F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 1, "assistant").otherwise("user").alias("role"),
            F.concat(F.lit("é <|im_start|> \\ "), F.col("id").cast("string")).alias("text"),
        )
        chats = chat.format_chats(chat.events_of(rows, revised=True))
        return chats.select(
            chat.masked(F.col("formatted"), F.col("loss")).alias("learned"), chat.parse(F.col("formatted")).alias("turns"), "formatted", "loss"
        ).collect()[0]

    got = read(2000)
    said = [f"é <|im_start|> \\ {i}" for i in range(2000)]
    assert got.learned == "".join(t for i, t in enumerate(said) if i % 3 == 1)
    assert [t.text for t in got.turns] == said
    assert all(chat.START not in got.formatted[s.start:s.end] for s in got.loss)
    assert seconds(lambda: read(32000)) < 5 * seconds(lambda: read(8000)) + 2


def test_revised_messages_fold_to_their_text(spark):
    rows = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(["", "ab", "x" * 1500, "é\n", "", "last"])], "conv_id int, turn int, role string, text string")
    kinds = chat.events_of(rows, revised=True, delta_chars=4)
    assert {r.kind for r in kinds.collect()} == {chat.DELTA, chat.EDIT, chat.REGENERATE}
    folded = [r.text for r in chat.fold_events(kinds).orderBy("message").collect()]
    assert folded == [r.text for r in rows.orderBy("turn", "role", "text").collect()]


def test_many_stray_tags():
    def page(n):
        return "<article>" + "<p>word</li>" * n + "</article>"

    assert [t for place, t in html_text.blocks(page(3)) if place == "main"] == ["word"] * 3
    html_text.blocks(page(2000))
    assert seconds(lambda: html_text.blocks(page(40000))) < 6 * seconds(lambda: html_text.blocks(page(10000))) + 0.5
