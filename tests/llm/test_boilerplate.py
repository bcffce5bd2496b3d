"""Pages without an article against a plain reading of the rules."""

import random
from collections import defaultdict

import pytest

from tidemark.llm import html_text

REPEAT, WHOLE = 6, 3


def brute(pages):
    """{page: text} of {page: blocks of words}, all of one host."""
    def runs(block):
        if len(block) < WHOLE:
            return []
        return [(at, tuple(block[at:at + REPEAT])) for at in range(max(len(block) - REPEAT, 0) + 1)]

    content = {p: tuple(map(tuple, blocks)) for p, blocks in pages.items()}

    def shared(group):
        seen = defaultdict(set)
        for p, blocks in pages.items():
            for block in blocks:
                for _, run in runs(block):
                    seen[run].add(group(p))
        return seen

    def covered(p, good):
        return [{i for at, run in runs(b) if good(run) for i in range(at, at + len(run))} for b in pages[p]]

    def share(p, good):
        total = sum(map(len, pages[p]))
        return sum(map(len, covered(p, good))) / total if total else 0

    by_content = shared(content.get)
    candidate = {r for r, g in by_content.items() if len(g) > 1}
    near = {p for p in pages if share(p, candidate.__contains__) > 1 - html_text.NEAR_REST}
    groups = shared(lambda p: "near" if p in near else content[p])
    out = {}
    for p, blocks in pages.items():
        least = 2
        if share(p, lambda r: r in candidate and len(groups[r]) >= 2) > html_text.MOST:
            least = 3
        gone = covered(p, lambda r, least=least: r in candidate and len(groups[r]) >= least)
        kept = [" ".join(w for i, w in enumerate(b) if i not in g) for b, g in zip(blocks, gone, strict=True)]
        out[p] = " ".join(k for k in kept if k)
    return out


def extracted(spark, pages, **how):
    html = {p: "<body>" + "".join(f"<div>{' '.join(b)}</div>" for b in blocks) + "</body>" for p, blocks in pages.items()}
    df = spark.createDataFrame([(p, f"http://h/{p}", h) for p, h in html.items()], "page_id int, url string, html string")
    return {r.page_id: r.text for r in html_text.extract_text(df, **how).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_random_hosts(spark, seed):
    rng = random.Random(seed)
    menu = [f"menu{i}" for i in range(8)]
    foot = [f"foot{i}" for i in range(14)]
    pages = {}
    for p in range(30):
        blocks = [menu] * rng.choice((0, 1, 1)) + [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 25))] for _ in range(rng.randrange(1, 4))] + [foot] * rng.choice((0, 1))
        pages[p] = blocks
        if rng.random() < 0.4:
            pages[100 + p] = [*blocks, ["views", str(p)]]
        if rng.random() < 0.2:
            pages[200 + p] = [list(b) for b in blocks]
    assert extracted(spark, pages, repeat=REPEAT, whole=WHOLE) == brute(pages)


def test_near_copies_keep_their_text(spark):
    story = [f"word{i}" for i in range(29)]
    menu = [f"menu{i}" for i in range(25)]
    only = {1: [story, ["views", "10"]], 2: [story, ["views", "11"]]}
    assert extracted(spark, only) == {p: " ".join(w for b in blocks for w in b) for p, blocks in only.items()}
    # With other pages on the host their menu is known, and goes from the near copies too.
    host = {1: [menu, story, ["views", "10"]], 2: [menu, story, ["views", "11"]], 3: [menu, [f"other{i}" for i in range(40)]], 4: [menu, [f"more{i}" for i in range(40)]]}
    assert extracted(spark, host) == {p: " ".join(w for b in blocks[1:] for w in b) for p, blocks in host.items()}
    assert extracted(spark, host) == brute_of(host)


def brute_of(pages):
    global REPEAT, WHOLE
    before = REPEAT, WHOLE
    REPEAT, WHOLE = html_text.REPEAT, html_text.WHOLE
    try:
        return brute(pages)
    finally:
        REPEAT, WHOLE = before
