"""Pages with an article: what repeats in it, against a plain reading of the rules."""

import random
from collections import defaultdict

import pytest

from tidemark.llm import html_text

REPEAT, WHOLE = 6, 3


def markup(blocks):
    """Blocks of (place, words), in page order."""
    tags = {"main": ("<article>", "</article>"), "noise": ("<footer>", "</footer>"), "open": ("<div>", "</div>")}
    return "<body>" + "".join(f"{tags[place][0]}{' '.join(words)}{tags[place][1]}" for place, words in blocks) + "</body>"


def extracted(spark, pages, **how):
    df = spark.createDataFrame([(p, f"http://h/{p}", markup(blocks)) for p, blocks in pages.items()], "page_id int, url string, html string")
    return {r.page_id: r.text for r in html_text.extract_text(df, **how).collect()}


def words(name, n):
    return [f"{name}{i}" for i in range(n)]


def brute(pages, repeat=REPEAT, whole=WHOLE):
    """{page: text}; pages without an article are only read for what they repeat."""
    def runs(block, least=repeat):
        if len(block) < least:
            return []
        return [(at, tuple(block[at:at + repeat])) for at in range(max(len(block) - repeat, 0) + 1)]

    content = {p: tuple(" ".join(w) for place in ("main", "open") for q, w in blocks if q == place) for p, blocks in pages.items()}
    main = {p: [w for place, w in blocks if place == "main"] for p, blocks in pages.items()}
    rest = {p: [w for place, w in blocks if place != "main"] for p, blocks in pages.items()}

    def held(streams, group, least=repeat):
        seen = defaultdict(set)
        for p, blocks in streams.items():
            for block in blocks:
                for _, run in runs(block, least):
                    seen[run].add(group(p))
        return seen

    def covered(p, good):
        return [{i for at, run in runs(b) if good(run) for i in range(at, at + len(run))} for b in main[p]]

    def share(p, good):
        total = sum(map(len, main[p]))
        return sum(map(len, covered(p, good))) / total if total else 0

    alike = held(main, content.get)
    near = {p for p in pages if share(p, lambda r: len(alike[r]) > 1) > 1 - html_text.NEAR_REST}

    def group(p):
        return "near" if p in near else content[p]

    inside, outside = held(main, group), held(rest, group, whole)
    several = len({content[p] for p in pages if main[p]})

    def boilerplate(run):
        return len(outside[run]) > 1 and len(inside[run]) > 2 and 2 * len(inside[run]) > several

    out = {}
    for p in pages:
        gone = covered(p, boilerplate) if share(p, boilerplate) <= html_text.MOST else [set()] * len(main[p])
        kept = [" ".join(w for i, w in enumerate(b) if i not in g) for b, g in zip(main[p], gone, strict=True)]
        out[p] = " ".join(k for k in kept if k)
    return out


NOTICE = words("notice", 24)
STORY = {p: words(f"story{p}x", 40) for p in range(1, 9)}


def test_a_notice_of_the_host_goes_from_articles(spark):
    pages = {p: [("main", STORY[p][:20]), ("main", [*STORY[p][20:], *NOTICE])] for p in range(1, 5)}
    pages |= {p: [("main", STORY[p]), ("noise", NOTICE)] for p in (5, 6)}
    # The page that the notice is the article of.
    pages[7] = [("main", NOTICE)]
    assert extracted(spark, pages) == {p: " ".join(STORY[p]) for p in range(1, 7)} | {7: " ".join(NOTICE)}


def test_an_article_keeps_what_articles_alone_or_teasers_repeat(spark):
    quote, lede = words("quote", 25), words("lede", 25)
    pages = {p: [("main", [*STORY[p], *quote])] for p in range(1, 6)}
    pages[6] = [("main", [*lede, *STORY[6]])]
    # Its copies and near copies are one content, however often it is announced elsewhere.
    pages[7] = [("main", [*lede, *STORY[6]])]
    pages[8] = [("main", [*lede, *STORY[6], "views", "10"])]
    pages[9] = [("main", [*lede, *STORY[6], "views", "11"])]
    got = extracted(spark, {p: [*blocks, ("noise", lede)] if p < 6 else blocks for p, blocks in pages.items()})
    assert got == {p: " ".join(w for _, b in blocks for w in b) for p, blocks in pages.items()}


@pytest.mark.parametrize("seed", range(2))
def test_random_articles(spark, seed):
    rng = random.Random(seed)
    notice, short, quote = words("notice", 9), words("short", 4), words("quote", 8)
    pages = {}
    for p in range(24):
        blocks = [("main", [f"w{rng.randrange(500)}" for _ in range(rng.randrange(10, 40))]) for _ in range(rng.randrange(1, 4))]
        blocks += [("main", b) for b, often in ((notice, 0.95), (short, 0.9), (quote, 0.4)) if rng.random() < often]
        rng.shuffle(blocks)
        blocks += [("noise", b) for b in (notice, short) if rng.random() < 0.2] + [("open", quote)] * (rng.random() < 0.2)
        pages[p] = blocks
        if rng.random() < 0.2:
            pages[100 + p] = [*blocks, ("main", ["views", str(p)])]
        if rng.random() < 0.2:
            pages[200 + p] = list(blocks)
    want = brute(pages)
    assert extracted(spark, pages, repeat=REPEAT, whole=WHOLE) == want
    whole = {p: " ".join(w for place, b in blocks if place == "main" for w in b) for p, blocks in pages.items()}
    assert any(want[p] != whole[p] for p in pages) and any("quote" in t for t in want.values())
