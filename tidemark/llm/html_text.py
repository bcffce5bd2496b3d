"""Main text of web pages: block structure, and a host's repeated passages.

Each page is cut into blocks of text with their place in the markup. Blocks inside
menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments are
noise; blocks inside ``article`` or ``main`` are the text. A wrapper that a word in its
class or id marks as noise may hold the article all the same (``has-sidebar``): a ``main``
in it is text, and its articles are, where they are longer than those under fewer marks.
Articles in a marked part of an article are its comments.

What of a page's text is boilerplate, the pages of the host decide: of a page with an
article the blocks in it, of any other the blocks outside noise. The suffixes of the token
streams of all blocks of all its pages are grouped by their first ``REPEAT`` tokens:
suffixes that agree in those stand next to each other in the host's suffix
array, and a group with pages of different contents is a passage that repeats. A block
that is shorter takes part as a whole, from ``WHOLE`` tokens on; a heading of a word or
two never does. Overlapping such suffixes add up to the longest repeated runs. What they
cover is boilerplate and goes; the unique runs between them stay. Copies and near copies
of a page (another counter, date or print view) count as one content, so they do not
make each other boilerplate, and no page loses most of its text to one other page. The
suffixes are rows that Spark deals out and aggregates, so a host with a third of all
pages is just more rows.

An article that several pages carry is not cut: its text is asked for whole, so a run that
repeats in articles alone is text. One that the host's pages repeat outside articles as
well (a notice that stands in a footer here and unmarked in the articles there) is cut
where more than half of the host's articles hold it.

Defined results: null html counts as empty and gives an empty text; null urls form one
host; pages with equal identifiers are distinct rows; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import let, named, ready, text_of
from tidemark.session import stage

# Tokens of a repeated run, and of a shorter block that repeats as a whole.
REPEAT = 20
WHOLE = 7
# A page of which shared runs leave less than this share is a near copy.
NEAR_REST = 0.2
# What takes more than this share of a page has to be shared by three contents.
MOST = 2 / 3

# Fixed values of HTML: elements whose content is never text, that are noise, that
# hold the text, that end a block, and that have no end tag.
HIDDEN = frozenset("head script style noscript template svg math iframe object canvas title".split())
NOISE = frozenset("nav header footer aside form menu dialog button select textarea".split())
# May be put around a whole page, with its article.
WRAPPERS = frozenset(("form",))
MAIN = frozenset(("article", "main"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Words in class, id or role that mark an element as noise.
NOISE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr
    notice popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments respond replies
    disqus newsletter subscribe signup share sharing social related recommended complementary contentinfo toolbar""".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "title", "textarea", "noscript", "template", "iframe")}


def _is_marked(name: str, attributes: str) -> bool:
    if name in WRAPPERS:
        return True
    if "=" not in attributes or name in ("body", "html", "article", "main"):
        return False
    return any(not NOISE_WORDS.isdisjoint(_WORD.findall("".join(found).lower())) for found in _MARKED.findall(attributes))


def blocks(page: str) -> list[tuple[str, str]]:
    """(place, text) of the blocks in page order; place is 'main', 'noise' or 'open'."""
    from html import unescape

    out: list[tuple[str, int, str]] = []
    pieces: list[str] = []
    # Of an element's content: place, marked wrappers around it, whether it is in an article.
    outside = ("open", 0, False)
    open_elements: list[tuple[str, tuple[str, int, bool]]] = []
    # How many of a name are open, so that a stray end tag is no search through all of them.
    names: Counter[str] = Counter()
    place, at, end = outside, 0, len(page)

    def close_block() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        pieces.clear()
        if text and place[0] != "hidden":
            out.append((*place[:2], text))

    while at < end:
        token = _TOKEN.search(page, at)
        pieces.append(page[at:token.start() if token else end])
        if not token:
            break
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            close_block()
        if token[1]:
            if names[name]:
                depth = next(i for i in range(len(open_elements) - 1, -1, -1) if open_elements[i][0] == name)
                if name in INLINE and open_elements[depth][1] != place:
                    close_block()
                names.subtract(gone for gone, _ in open_elements[depth:])
                del open_elements[depth:]
                new = open_elements[-1][1] if open_elements else outside
                if new != place:
                    close_block()
                    place = new
            continue
        if name in _RAW_END and name in HIDDEN | {"textarea"}:
            stop = _RAW_END[name].search(page, at)
            at = stop.end() if stop else end
            continue
        if name in VOID or token[3].endswith("/"):
            continue
        kind, marks, in_article = place
        if kind == "hidden" or name in HIDDEN:
            new = ("hidden", 0, False)
        elif kind == "noise" or (name in NOISE and name not in WRAPPERS):
            new = ("noise", 0, False)
        elif _is_marked(name, token[3]):
            new = ("marked", marks + 1, in_article)
        elif name in MAIN and not (kind == "marked" and in_article):
            new = ("main", 0 if name == "main" else marks, in_article or name == "article")
        else:
            new = place
        # A head without its end tag ends where the body begins.
        if name == "body":
            open_elements.clear()
            names.clear()
            new = outside
        if new != place or name not in INLINE:
            if new != place:
                close_block()
                place = new
            # Paragraphs and the like close themselves; only elements that change the place
            # or may hold such ones need to be remembered.
            open_elements.append((name, new))
            names[name] += 1
    close_block()
    lengths: dict[int, int] = {}
    for kind, marks, text in out:
        if kind == "main":
            lengths[marks] = lengths.get(marks, 0) + len(text)
    kept, total = set(), 0
    for marks in sorted(lengths):
        if marks == 0 or lengths[marks] > total:
            kept.add(marks)
            total += lengths[marks]
    return [(kind if kind == "open" or (kind == "main" and marks in kept) else "noise", text) for kind, marks, text in out]


# Characters of blocks that are cut into keys at once.
CUT_CHARS = 1 << 20


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def stretches(found: list[tuple[str, str]], repeat: int, whole: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each block the starts and the keys of its stretches, and after the starts the number of suffixes.

    The key of a suffix is the smallest hash of the shorter runs (grams) in its first ``repeat`` tokens: equal
    runs have equal keys, and suffixes next to each other mostly share theirs, which makes them a stretch. A
    shorter block from ``whole`` tokens on is one suffix, outside articles.
    """
    from pandas.util import hash_array

    gram = (repeat + 1) // 2
    sizes = np.array([text.count(" ") + 1 for _, text in found], np.int64)
    long = sizes >= repeat
    short = ~long & (sizes >= whole) & np.array([place != "main" for place, _ in found], bool)
    tokens = [token for (_, text), take in zip(found, long, strict=True) if take for token in text.split(" ")]
    hashes = hash_array(np.array([*tokens, *(text for (_, text), take in zip(found, short, strict=True) if take)], object))
    starts, keys = [np.zeros(1, np.int32)] * len(found), [np.empty(0, np.int64)] * len(found)
    for block, key in zip(np.flatnonzero(short), hashes[len(tokens):].view(np.int64), strict=True):
        starts[block], keys[block] = np.array([0, 1], np.int32), np.array([key])
    n = len(tokens) - repeat + 1
    if n > 0:
        grams = hashes[:len(tokens) - gram + 1]
        for i in range(1, gram):
            grams = _mixed(grams, hashes[i:len(tokens) - gram + 1 + i])
        least = grams[:n]
        for i in range(1, repeat - gram + 1):
            least = np.minimum(least, grams[i:n + i])
        least = least.view(np.int64)
        at = 0
        for block in np.flatnonzero(long):
            own = least[at:at + sizes[block] - repeat + 1]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            starts[block], keys[block] = np.append(first, len(own)).astype(np.int32), own[first]
            at += sizes[block]
    return starts, keys


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str, repeat: int, whole: int) -> DataFrame:
    """id, url, and of the blocks in page order the places, texts and stretches (starts, keys)."""
    ready(pages.sparkSession)
    source = pages.select(named(id_col).alias("id"), named(url_col).alias("url"), text_of(html_col).alias("body"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = [blocks(page.as_py()) for page in batch.column("body")]
            flat = [block for page in found for block in page]
            starts, keys, at = [], [], 0
            while at < len(flat):
                end, chars = at, 0
                while end < len(flat) and (end == at or chars + len(flat[end][1]) <= CUT_CHARS):
                    chars += len(flat[end][1])
                    end += 1
                for out, more in zip((starts, keys), stretches(flat[at:end], repeat, whole), strict=True):
                    out += more
                at = end
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            columns = [
                pa.array([place for place, _ in flat], pa.string()), pa.array([text for _, text in flat], pa.string()),
                pa.array(starts, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64())),
            ]
            lists = [pa.ListArray.from_arrays(pa.array(ends), column) for column in columns]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), *lists], names=["id", "url", "places", "texts", "starts", "keys"])

    kinds = dict(source.dtypes)
    return source.mapInArrow(
        batches, f"id {kinds['id']}, url {kinds['url']}, places array<string>, texts array<string>, starts array<array<int>>, keys array<array<bigint>>"
    )


def _described(found: DataFrame) -> DataFrame:
    """With page (a row number), content (equal for copies), host and kind (the place of the page's text)."""

    def texts(place: str) -> Column:
        return F.filter("texts", lambda text, i: F.get("places", i) == place)

    content = F.xxhash64(F.concat_ws(" ", texts("main"), texts("open")))
    host = F.regexp_extract(F.lower(F.coalesce(F.col("url").cast("string"), F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1)
    kind = F.when(F.array_contains("places", "main"), F.lit("main")).otherwise(F.lit("open"))
    return found.select("*", F.monotonically_increasing_id().alias("page"), content.alias("content"), host.alias("host"), kind.alias("kind"))


def _stretches(found: DataFrame) -> DataFrame:
    """page, content, host, block, inside (an article), asked (text of the page), at, to, key (of a host's own) of the stretches."""
    each = found.select("page", "content", "host", "kind", F.posexplode(F.arrays_zip("places", "starts", "keys")).alias("block", "b"))
    each = each.select("page", "content", "host", "kind", "block", "b.places", "b.starts", F.posexplode("b.keys").alias("i", "key"))
    return each.select(
        "page", "content", "host", "block", (F.col("places") == "main").alias("inside"), (F.col("places") == F.col("kind")).alias("asked"),
        F.get("starts", F.col("i")).alias("at"), (F.get("starts", F.col("i") + 1) - 1).alias("to"), F.xxhash64("host", "key").alias("key"),
    )


def _shared(rows: DataFrame, *by: str) -> DataFrame:
    """``by`` of the rows (stretches, suffixes) that pages of two different contents share."""
    return rows.groupBy(*by).agg(F.min("content").alias("lo"), F.max("content").alias("hi")).where("lo < hi").select(*by)


def _texts(found: DataFrame, place: Column) -> DataFrame:
    """page, block, text of the blocks whose ``place`` holds."""
    each = found.select("page", "kind", F.posexplode(F.arrays_zip("places", "texts")).alias("block", "b"))
    return each.select("page", "kind", "block", "b.places", "b.texts").where(place).select("page", "block", F.col("texts").alias("text"))


def _suffixes(spans: DataFrame, texts: DataFrame, repeat: int, runs: bool) -> DataFrame:
    """The suffixes of stretches: page, content, host, block, inside, at, a hash (head) of their first ``repeat`` tokens and, with ``runs``, these (run).

    The last suffixes of a block are part of those before them.
    """
    by = ["page", "content", "host", "block", "inside"]
    # Written first, so that few of them are taken to the texts and not the texts to them.
    joined = stage(spans.groupBy(*by).agg(F.collect_list(F.struct("at", "to")).alias("spans")), "spans").join(texts, ["page", "block"])
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["to"])))

    def suffix(tokens: Column, at: Column) -> Column:
        run = F.slice(tokens, at + 1, repeat)
        return F.struct(at.alias("at"), F.xxhash64(run).alias("head"), *([run.alias("run")] if runs else []))

    each = let(F.split("text", " "), lambda tokens: F.transform(places, lambda at: suffix(tokens, at)))
    return joined.select(*by, F.explode(each).alias("s")).select(*by, "s.*")


def _covering(suffixes: DataFrame, sizes: DataFrame, repeat: int) -> DataFrame:
    """page, block, starts, covered: how many tokens of a block the suffixes cover, and which (starts)."""
    found = suffixes.groupBy("page", "block").agg(F.array_sort(F.collect_set("at")).alias("starts")).join(sizes, ["page", "block"])
    # A start covers up to the next one or the length of a run, whichever is nearer.
    nexts = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.lit(1 << 30)))
    spans = F.zip_with("starts", nexts, lambda at, after: F.least(after - at, F.lit(repeat), F.col("n") - at))
    return found.select("page", "block", "starts", F.aggregate(spans, F.lit(0), lambda acc, x: acc + x).alias("covered"))


def _share(covering: DataFrame, sizes: DataFrame) -> DataFrame:
    """page, share: of a page's tokens, those that are covered."""
    sums = covering.groupBy("page").agg(F.sum("covered").alias("covered"))
    totals = sizes.groupBy("page").agg(F.sum("n").alias("total"))
    return totals.join(sums, "page").select("page", (F.col("covered") / F.col("total")).alias("share"))


def boilerplate(found: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """page, block, starts: the runs of the pages' texts that are boilerplate.

    Every suffix takes part by the key of its stretch. Stretches with a key that pages of different contents
    share outside articles go on as suffixes; no other one can hold a run that the host repeats there.

    A page of which runs in its kind of place (articles, or outside them) that other contents share
    leave next to nothing (``NEAR_REST``) is a near copy of others, and all near copies of a host count as
    one content: what only they share is their text. Outside articles a run of two contents is boilerplate;
    where that takes most of a page (``MOST``), three contents have to share it. In an article a run that
    articles alone repeat is text. It is boilerplate if two contents hold it outside articles, and three
    and more than half of the host's in them, unless that takes most of the article. Runs are compared
    token by token, not by hash.
    """
    all_of = _stretches(found)
    main, of_page = F.col("places") == "main", F.col("places") == F.col("kind")
    outside = all_of.where("not inside")
    passages = stage(_shared(outside, "key"), "passages")
    hits = stage(all_of.where("asked").join(passages, "key", "left_semi"), "hits")
    suspects = stage(hits.select("page").distinct(), "suspects")
    own = found.join(suspects, "page", "left_semi")
    lengths = F.transform(F.arrays_zip("places", "texts"), lambda b: F.when(b["places"] == F.col("kind"), F.size(F.split(b["texts"], " "))))
    sizes = stage(own.select("page", F.posexplode(lengths).alias("block", "n")).where("n is not null"), "sizes")
    articles = all_of.where("inside").join(suspects, "page", "left_semi")
    alike = articles.join(_shared(articles, "key"), "key", "left_semi")

    candidates = stage(_suffixes(hits, _texts(found, of_page), repeat, runs=True), "candidates")
    heads = candidates.select("host", "head").distinct()
    # Of blocks outside articles only stretches with the key of a hit can hold its runs.
    near_hits = outside.join(hits.select("key").distinct(), "key", "left_semi")
    others = stage(_suffixes(near_hits, _texts(found, ~main), repeat, runs=True).join(heads, ["host", "head"], "left_semi"), "others")
    in_articles = stage(_suffixes(alike, _texts(found, main), repeat, runs=False), "in-articles")
    kin = candidates.drop("run").where("not inside").join(_shared(others, "host", "head"), ["host", "head"], "left_semi").unionByName(
        in_articles.join(_shared(in_articles, "host", "head"), ["host", "head"], "left_semi")
    )
    near = stage(_share(_covering(kin, sizes, repeat), sizes).where(F.col("share") > 1 - NEAR_REST).select("page", F.lit(True).alias("near")), "near")

    def contents(runs: DataFrame, name: str) -> DataFrame:
        group = F.when(F.col("near"), F.lit(0).cast("long")).otherwise(F.col("content"))
        groups = runs.join(near, "page", "left").select("host", "run", group.alias("group")).distinct()
        return groups.groupBy("host", "run").agg(F.count("*").alias(name))

    out = contents(others, "outside").where("outside > 1")
    both = out.join(contents(candidates.where("inside"), "articles"), ["host", "run"], "left")
    hosts = found.where("kind = 'main'").select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("all"))
    ruled = candidates.join(both, ["host", "run"]).join(hosts, "host", "left").where("not inside or (articles > 2 and articles * 2 > all)")
    ruled = stage(ruled.select("page", "block", "at", "inside", "outside"), "ruled")
    heavy = _share(_covering(ruled, sizes, repeat), sizes).where(F.col("share") > MOST).select("page", F.lit(True).alias("heavy"))
    kept = ruled.join(heavy, "page", "left").where(F.col("heavy").isNull() | (~F.col("inside") & (F.col("outside") > 2)))
    return _covering(kept, sizes, repeat).select("page", "block", "starts")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", repeat: int = REPEAT, whole: int = WHOLE) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    # Written once: the pages are parsed once, and a row keeps its number whatever executors are lost.
    found = stage(_described(parsed(pages, id_col, url_col, html_col, repeat, whole)), "blocks")
    covered = boilerplate(found, repeat)
    cuts = stage(covered.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("block", "starts"))).alias("cuts")), "cuts")

    def unique(text: Column, starts: Column) -> Column:
        """The tokens of a block that no boilerplate covers."""
        cover = F.flatten(F.transform(starts, lambda at: F.sequence(at, at + repeat - 1)))
        left = let(
            F.split(text, " "), lambda t: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(t) - 1), cover), lambda i: F.get(t, i)), " ")
        )
        return F.when(starts.isNull(), text).otherwise(left)

    asked = F.transform("texts", lambda text, i: F.when(F.get("places", i) == F.col("kind"), unique(text, F.element_at("cuts", i))).otherwise(F.lit("")))
    text = F.array_join(F.filter(asked, lambda t: t != ""), " ")
    texts = found.join(cuts, "page", "left").select("id", "url", text.alias("text"))
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
