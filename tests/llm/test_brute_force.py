"""The registered queries against plain Python over whole tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from oracle import connect, differences

from tidemark.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') AS text, source FROM '{SF}/documents.parquet'").fetchall()


def result(spark, name, sf=SF):
    return QUERIES[name].run(spark, sf).collect()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_sql_twin(spark, name):
    assert differences(spark, connect(SF), QUERIES[name].run, QUERIES[name].sql, SF) is None


def base_spans(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for rank, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 18), (2, "hex", r"[0-9a-f]+", 16)):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [s for *_, s in sorted(found)]


def test_secrets(spark, documents):
    got = {r.doc_id: r for r in result(spark, "op2_secret_scan")}
    assert len(got) == len(documents)
    for doc, text, _ in documents:
        spans = base_spans(text)
        assert got[doc].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        kinds = Counter(s.split(":")[0] for s in spans)
        assert (got[doc].n_assign, got[doc].n_access, got[doc].n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert [s for s in got[doc].spans.split(",") if s and not s.startswith("entropy")] == spans


def water_level(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    rest = float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        share = {s: rest * weight[s] / total for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
        free -= over


def test_mix(spark, documents):
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t, _ in documents}
    source = {d: s for d, _, s in documents}
    sizes = defaultdict(int)
    for d, n in size.items():
        sizes[source[d]] += n
    targets = water_level(sizes)
    got = result(spark, "op3_mix_sources")
    assert sorted(r.doc_id for r in got) == sorted(size)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[source[r.doc_id]])
        assert math.isclose(r.target, targets[source[r.doc_id]], rel_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    assert sorted(got) == sorted(result(spark, "op3_mix_sources"))


def simhash(text):
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    """Smallest document reachable over links of at most two bits."""
    parent = {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    docs = sorted(fps)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in docs}


def test_simhash(spark, documents):
    fps = {d: simhash(t) for d, t, _ in documents}
    root = classes(fps)
    got = result(spark, "op6_simhash_dedup")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{fps[d]:016x}", root[d]) for d in fps}
    assert sorted(r.doc_id for r in got if r.kept) == sorted(set(root.values()))


def test_licenses(spark, documents):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    got = {r.doc_id: r for r in result(spark, "op8_license_scan")}
    assert len(got) == len(documents)
    for doc, text, _ in documents:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))
        places, labels = [], set()
        for phrase, label in phrases.items():
            p = phrase.split()
            at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[doc]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted(labels))
        assert labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_packing(spark, documents):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in result(spark, "op10_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(documents)
    for doc, text, _ in documents:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    used = sum(r.length for rows in sequences.values() for r in rows)
    assert used / (4096 * len(sequences)) > 0.97


def test_pages(spark):
    """The pages here have one article each; its blocks end at block tags and line breaks."""
    from html import unescape

    got = {r.page_id: r for r in result(spark, "op5_html_extraction")}
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for page, html in pages:
        article = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", article)
        text = " ".join(filter(None, (" ".join(unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks)))
        assert got[page].text == text and got[page].n_chars == len(text)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    got = {r.doc_id: r for r in result(spark, "op4_quality_classifier", sf)}
    bad = [d for d, q in labels.items() if not q]
    good = [d for d, q in labels.items() if q]
    assert sum(got[d].kept for d in good) >= 0.98 * len(good)
    assert sum(not got[d].kept for d in bad) >= 0.9 * len(bad)
