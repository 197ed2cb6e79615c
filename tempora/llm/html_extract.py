"""Main text of web pages: a linear-chain CRF over the leaf blocks of the DOM, decoded by Viterbi.

A page is cut into leaf blocks (runs of text and inline markup inside one block element). A
block's features are the tags, classes, ids and roles of its ancestors and the shape of its text;
labels are content and other; transitions are learned with them. A word tells something else on the
page's body than on a box, in a state (`has-sidebar`, `menu-open`) than alone, and beyond an article
that is nearer to the block. Training pages are labelled pages, made by `labelled_pages` from
layouts with known content; a part of their boxes has no class or a meaningless one, so that the
text, the links and the neighbouring blocks decide there.

Boxes are linked to the box around them, and what a path tells is carried from box to box, so deep
pages take time and memory in proportion to their length.

Defined results: null and empty html give an empty text; unclosed tags, comments, quoted values,
scripts and styles run to the end as browsers have it; an unclosed drawing or object ends with its
parent, one that closes itself holds nothing; the whole page is read once whatever its length;
repeated rows each give a row. Other columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm import crf
from tempora.llm.common import map_batches, slices

BUCKETS = 1 << 14
#: Attributes as browsers read them; nothing is read twice, whatever the quotes.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^\s>\"'][^\s>]*+))?+)?+")
#: Attributes that are features: of the first their words, of the others also the name.
TOLD, FLAGS = ("class", "id", "role"), ("hidden", "aria-hidden")
#: Elements of raw text, and elements whose whole content is dropped.
RAW = frozenset("script style textarea iframe xmp noembed noframes".split())
DROPPED = frozenset("svg math template noscript select object canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end an open element of the given kinds when they begin.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SCOPES = frozenset("ul ol dl table tbody thead tfoot div section article aside nav header footer main body html form".split())
SPACE = re.compile(r"\s+")


class Box:
    """An element: its tag, its class, id and role words, and the box around it."""

    __slots__ = ("around", "seen", "tag", "told")

    def __init__(self, tag: str, told: str, around: Box | None):
        self.tag, self.told, self.around = tag, told, around
        self.seen: tuple | None = None


def blocks(html: str) -> list[tuple[str, Box | None, float]]:
    """(text, the box that it is in, share of the text inside links)."""
    out: list[tuple[str, Box | None, float]] = []
    stack: list[Box] = []
    is_open: Counter[str] = Counter()
    parts: list[str] = []
    linked, link = 0, 0

    def end() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                out.append((text, stack[-1] if stack else None, min(1.0, linked / max(1, len(text)))))
            parts.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            linked += link * len(piece.strip())

    def begin(name: str, words: str) -> None:
        stack.append(Box(name, words, stack[-1] if stack else None))
        is_open[name] += 1

    def close_from(k: int) -> None:
        for box in stack[k:]:
            is_open[box.tag] -= 1
        del stack[k:]

    def place_of(name: str) -> int | None:
        """Where the innermost open box of the name is."""
        return next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == name), None) if is_open[name] else None

    at, dropped = 0, 0
    while (m := TOKEN.search(html, at)) is not None:
        if not dropped:
            text(html[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in RAW and not m[1]:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            at = close.start() if close else len(html)
            continue
        if name in INLINE or name in RAW:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                link = 0 if m[1] else 1
            continue
        if name in DROPPED:  # inside a line of text, as an image is
            if m[1]:
                k = place_of(name)
                if k is not None:
                    dropped -= sum(box.tag in DROPPED for box in stack[k:])
                    close_from(k)
            elif not m[3].endswith("/"):
                begin(name, "")
                dropped += 1
            continue
        if not dropped:
            end()
            link = 0
        if m[1]:
            k = place_of(name)
            if k is not None:
                if dropped:
                    gone = sum(box.tag in DROPPED for box in stack[k:])
                    dropped -= gone
                    if gone and not dropped:
                        end()
                        link = 0
                close_from(k)
            continue
        if name not in VOID:
            kinds = CLOSES.get(name, ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in kinds:
                    close_from(k)
                    break
                if stack[k].tag in DROPPED or (stack[k].tag in SCOPES and stack[k].tag not in kinds):
                    break
            if stack and stack[-1].tag == "p":
                close_from(len(stack) - 1)
            begin(name, told(m[3]))
    if not dropped:
        text(html[at:])
    end()
    return out


def told(attributes: str) -> str:
    """Class, id and role words of a tag, and the names of its flags."""
    if not attributes.strip("/ "):
        return ""
    words = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in TOLD:
            words.append(a or b or c)
        elif name in FLAGS:
            words.append(f"{name} {a or b or c}")
    return " ".join(words)


WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
ENDS = (".", "!", "?", "…", "。", ":", '."', ".”", ".»")


#: Words of a class that say how a page is laid out or what it lacks, in front of other words or after them.
STATES_FIRST = frozenset("has no non with without is show hide enable disable".split())
STATES_LAST = frozenset("free open opened closed fixed sticky toggled enabled disabled visible active loaded collapsed expanded layout less on off".split())
#: What is in one of these is told less by what is around them.
ARTICLES = frozenset(("article", "main"))
Bits = tuple[int, ...]


def words_of_class(told: str) -> list[tuple[str, bool]]:
    """(word, whether it is part of a state)."""
    out = []
    for token in told.split():
        words = [w.lower() for w in WORDS.findall(token)]
        state = len(words) > 1 and (words[0] in STATES_FIRST or words[-1] in STATES_LAST or "with" in words)
        out += [(w, state) for w in words]
    return out


def bit(feature: str, cache: dict[str, int]) -> int:
    if feature not in cache:
        cache[feature] = zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS
    return cache[feature]


def bits_of(box: Box, cache: dict) -> tuple[Bits, Bits]:
    """Features that a box gives to what is in it, and to what is in an article in it."""
    known = cache.get((box.tag, box.told))
    if known is not None:
        return known
    page = box.tag in ("body", "html")
    tag = [] if page else [bit(f"in {box.tag}", cache)]
    near, past = list(tag), list(tag)
    for word, state in words_of_class(box.told):
        for kind, out in (("has", near), ("past", past)):
            out.append(bit(f"{'state' if state else 'page' if page else kind} {word}", cache))
    cache[box.tag, box.told] = tuple(dict.fromkeys(near)), tuple(dict.fromkeys(past))
    return cache[box.tag, box.told]


def path_bits(box: Box | None, cache: dict) -> set[int]:
    """Features of a block by the boxes that it is in."""
    out, beyond = set(), False
    if box is not None:
        out.add(bit(f"leaf {box.tag}", cache))
    while box is not None:
        out.update(bits_of(box, cache)[beyond])
        beyond |= box.tag in ARTICLES
        box = box.around
    return out


def path_scores(box: Box | None, weights: list[list[float]], cache: dict) -> tuple[float, float]:
    """What `path_bits` come to: each box adds what the boxes around it have not told yet."""
    chain = []
    while box is not None and box.seen is None:
        chain.append(box)
        box = box.around
    for own in reversed(chain):
        near, past = own.around.seen if own.around is not None else ((0, 0.0, 0.0), (0, 0.0, 0.0))
        found = []
        for bits, (mask, other, content) in zip(bits_of(own, cache), (past if own.tag in ARTICLES else near, past), strict=True):
            for b in bits:
                if not mask >> b & 1:
                    mask |= 1 << b
                    other, content = other + weights[b][0], content + weights[b][1]
            found.append((mask, other, content))
        own.seen = tuple(found)
        box = own
    return (0.0, 0.0) if box is None else box.seen[0][1:]


def text_features(text: str, linked: float) -> list[str]:
    feats = ["bias", *(f"text {x}" for x in shape(text, linked))]
    if text[0] in "©®|»›•" or text[:3].lower() == "(c)":
        feats.append("mark")
    if sum(c.isdigit() for c in text[:200]) * 4 > min(len(text), 200):
        feats.append("digits")
    return feats


def shape(text: str, linked: float) -> tuple[str, str, str]:
    """Length, links and end of a text, as its neighbours see them too."""
    words = min(6, (text.count(" ") + 1).bit_length())
    level, stop = int(linked * 4), text.endswith(ENDS)
    return f"words {words} links {level}", f"words {words} stop {stop}", f"commas {min(2, text.count(','))} stop {stop}"


def feature_ids(page: list[tuple[str, Box | None, float]], cache: dict[str, int], paths: bool = True) -> tuple[list[int], list[int]]:
    """Features of each block, those of its path only with `paths`."""
    items, feats, shapes = [], [], [shape(text, linked) for text, _, linked in page]
    around = lambda box: box and box.around
    for k, (text, box, linked) in enumerate(page):
        own = text_features(text, linked)
        own.append(f"before {shapes[k - 1][0]}" if k else "first")
        own.append(f"after {shapes[k + 1][0]}" if k + 1 < len(page) else "last")
        if k:
            own.append(f"beside {around(box) is around(page[k - 1][1])} {shapes[k - 1][1]}")
        ids = [bit(f, cache) for f in own] + ([*path_bits(box, cache)] if paths else [bit(f"leaf {box.tag}", cache)] if box is not None else [])
        items += [k] * len(ids)
        feats += ids
    return items, feats


#: Boxes around content and boxes of other things, as (opening tag, closing tag).
CONTENT_BOXES = [("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="post-content">', "</div>"), ('<div id="content"><div class="entry">', "</div></div>"), ('<section class="article-body">', "</section>"), ('<div role="main">', "</div>"), ('<div class="story text">', "</div>")]
TOP_BOXES = [("<nav>", "</nav>"), ("<header>", "</header>"), ('<div class="menu">', "</div>"), ('<div id="navbar">', "</div>"), ('<div role="navigation">', "</div>"), ('<div class="ad">', "</div>"), ('<div class="cookie-notice">', "</div>"), ('<div class="banner">', "</div>"), ("<header><nav>", "</nav></header>"), ('<ul class="breadcrumb">', "</ul>"), ('<div class="notice">', "</div>"), ('<div class="consent popup">', "</div>"), ('<div class="advert sponsored">', "</div>"), ('<form class="search">', "</form>"), ('<div class="gdpr">', "</div>"), ('<div id="topbar">', "</div>"), ('<div class="pagination pager">', "</div>"), ('<div class="privacy modal">', "</div>"), ('<div class="toolbar">', "</div>")]
BOTTOM_BOXES = [("<footer>", "</footer>"), ("<aside>", "</aside>"), ('<div class="sidebar">', "</div>"), ('<div class="related">', "</div>"), ('<section class="comments">', "</section>"), ('<div id="comments"><div class="comment">', "</div></div>"), ("<form>", "</form>"), ('<div class="newsletter subscribe">', "</div>"), ('<div class="footer">', "</div>"), ('<div class="ads promo">', "</div>"), ('<div role="complementary">', "</div>"), ('<div class="share social">', "</div>"), ('<ol class="commentlist">', "</ol>"), ('<div role="contentinfo">', "</div>"), ('<section id="disqus" class="reader-comments">', "</section>"), ('<div class="rail">', "</div>"), ('<div class="responses">', "</div>"), ('<div class="replies"><article class="reply">', "</article></div>"), ('<section class="comments"><article>', "</article></section>"), ('<div class="discussion respond">', "</div>"), ('<div class="related"><article class="card">', "</article></div>"), ('<aside><article class="teaser">', "</article></aside>"), ('<div class="widget">', "</div>"), ('<div class="recommended trending">', "</div>"), ('<div class="sponsor">', "</div>")]
#: What layouts have, lack or open, and how a class says so; names of boxes around whole pages.
PARTS = "sidebar comments ad ads menu nav navbar header footer banner cookie popup search share social related widget notice aside rail promo newsletter breadcrumb".split()
STATES = ["has-{0}", "no-{0}", "{0}-free", "{0}-fixed", "{0}-open", "with-{0}", "content-with-{0}", "{0}-enabled", "{0}-collapsed", "is-{0}-active", "show-{0}", "hide-{0}", "without-{0}", "{0}-layout"]
WRAPPERS = "page wrapper site container layout wrap outer main-wrapper root app".split()


def labelled_pages(n: int = 1200, seed: int = 11) -> list[str]:
    """Training pages. Each text starts with \\x01 if it is content, else with \\x02.

    Half of the pages have boxes without class, or with meaningless words for classes; there other
    things are lists of links, short lines and notes, which the text tells apart.
    """
    rng = np.random.default_rng(seed)

    def word() -> str:
        return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, rng.integers(2, 9)))

    def prose(label: str, least: int, most: int, stop: bool) -> str:
        words = [word() + "," * int(rng.integers(9) == 0) for _ in range(rng.integers(least, most))]
        return label + " ".join(words).strip(",").capitalize() + "." * stop

    def links(tag: str) -> str:
        return "".join(f'<{tag}><a href="/{k}">{prose(chr(2), 1, 4, False)}</a></{tag}>' for k in range(rng.integers(1, 7)))

    def bare() -> tuple[str, str]:
        tags = ["div", "section"][: 1 + int(rng.integers(2))] * int(rng.integers(1, 3))
        named = lambda: "" if rng.integers(2) else f' {("class", "id")[rng.integers(2)]}="{word()} {word()}-{rng.integers(9)}"'
        return "".join(f"<{t}{named()}>" for t in tags), "".join(f"</{t}>" for t in reversed(tags))

    def other(pair: tuple[str, str], plain: bool) -> str:
        kind = rng.integers(0, 6 if plain else 5)
        if plain:
            row = " ".join(f'<a href="/{k}">{prose(chr(2), 1, 3, False)}</a>' for k in range(rng.integers(1, 5)))
            inner = (f"<ul>{links('li')}</ul>", links("p"), links("div"), f"{chr(2)}&copy; {prose('', 2, 8, False)}", prose(chr(2), 1, 4, False), row)[kind]
        else:
            inner = f"<ul>{links('li')}</ul>" if kind == 0 else links("p") if kind == 1 else f"<p>{prose(chr(2), 4, 40, True)}</p>" * int(rng.integers(1, 3)) if kind == 2 else f"{chr(2)}&copy; {prose('', 2, 12, bool(rng.integers(2)))}" if kind == 3 else prose(chr(2), 5, 30, True)
        return pair[0] + inner + pair[1]

    def states(names: list[str], bare: bool) -> str:
        """Class words of a page or of a box around all of it: names, states of parts, and parts alone if `bare`."""
        out = [names[rng.integers(len(names))]] if rng.integers(2) else []
        for _ in range(rng.integers(1, 4)):
            part = PARTS[rng.integers(len(PARTS))]
            out.append(part if bare and rng.integers(3) == 0 else STATES[rng.integers(len(STATES))].format(part))
        return " ".join(out)

    pages = []
    for _ in range(n):
        plain = not rng.integers(2)
        box = (("", "") if rng.integers(4) == 0 else bare()) if plain else CONTENT_BOXES[rng.integers(len(CONTENT_BOXES))]
        tag = ("div", "p")[rng.integers(2)]
        pick = lambda boxes, least, most: "".join(other(bare() if plain else boxes[k], plain) for k in rng.integers(0, len(boxes), rng.integers(least, most)))
        body = [f"<h1>{prose(chr(1), 2, 9, False)}</h1>"] if rng.integers(4) else []
        for _ in range(rng.integers(1, 9)):
            kind = rng.integers(0, 12)
            if kind == 0:
                body.append(f"<h2>{prose(chr(1), 1, 7, False)}</h2>")
            elif kind == 1:
                body.append("<ul>" + "".join(f"<li>{prose(chr(1), 1, 12, bool(rng.integers(2)))}</li>" for _ in range(3)) + "</ul>")
            elif kind == 2:
                body.append(f"<blockquote>{prose(chr(1), 5, 40, True)}</blockquote>")
            elif kind == 3:
                body.append(f"<table><tr><td>{prose(chr(1), 1, 5, False)}</td><td>{prose(chr(1), 1, 3, False)}</td></tr></table>")
            elif kind == 4 and not plain:
                body.append(other(BOTTOM_BOXES[rng.integers(len(BOTTOM_BOXES))], False))
            elif kind == 5:
                body.append(f'<{tag}>{prose(chr(1), 6 if plain else 1, 30, True)} <a href="/x">{prose("", 1, 4, False)}</a></{tag}>')
            elif kind == 6 and not plain:
                body.append(other(TOP_BOXES[rng.integers(len(TOP_BOXES))], False))
            else:
                body.append(f"<{tag}>{prose(chr(1), 6 if plain else 1, 60 if plain or rng.integers(3) else 5, plain or bool(rng.integers(3)))}</{tag}>")
        head = f"<head><title>{prose(chr(2), 2, 9, False)}</title></head>" if rng.integers(5 - 3 * plain) else ""
        whole = f"{pick(TOP_BOXES, 0, 4)}{box[0]}{''.join(body)}{box[1]}{pick(BOTTOM_BOXES, 0, 5)}"
        for _ in range(rng.integers(0, 3)):
            whole = f'<div class="{states(WRAPPERS, False)}">{whole}</div>'
        top = f' class="{states(["home", "single", "post"], True)}"' if rng.integers(2) else ""
        pages.append(f"<html>{head}<body{top}>{whole}</body></html>")
    return pages


def train(pages: list[str] | None = None) -> crf.Chain:
    """Learn the chain from labelled pages."""
    cache: dict[str, int] = {}
    seqs, labels, items, feats, n = [], [], [], [], 0
    for html in pages or labelled_pages():
        page, labs = [], []
        for text, path, linked in blocks(html):
            labs.append(int("\x01" in text))
            bare = text.replace("\x01", "").replace("\x02", "").strip()
            page.append((bare or "x", path, linked))
        i, f = feature_ids(page, cache)
        items += [n + x for x in i]
        feats += f
        seqs.append(list(range(n, n + len(page))))
        labels.append(labs)
        n += len(page)
    longest = max(map(len, seqs))
    mask = np.array([[k < len(s) for k in range(longest)] for s in seqs])
    pad = lambda rows: np.array([r + [0] * (longest - len(r)) for r in rows])
    return crf.fit(pad(seqs), mask, pad(labels), np.array(items), np.array(feats), n, BUCKETS, 2, steps=140, rate=0.2, l2=2e-4)


def extract_texts(htmls: list[str | None], chain: crf.Chain, cache: dict[str, int]) -> list[tuple[str, int, int]]:
    """(main text, blocks, content blocks) of each page."""
    parsed = [blocks(h) if h else [] for h in htmls]
    weights = chain.weights.tolist()
    items, feats, paths, n = [], [], [], 0
    for page in parsed:
        i, f = feature_ids(page, cache, paths=False)
        items += [n + x for x in i]
        feats += f
        paths += [path_scores(box, weights, cache) for _, box, _ in page]
        n += len(page)
    lengths = np.array([len(p) for p in parsed], np.int64)
    keep = crf.viterbi(chain.emissions(np.array(items, np.int64), np.array(feats, np.int64), n) + np.array(paths).reshape(-1, 2), lengths, chain) if n else np.zeros(0)
    out, at = [], 0
    for page in parsed:
        kept = [b[0] for b, k in zip(page, keep[at : at + len(page)], strict=True) if k]
        at += len(page)
        out.append(("\n".join(kept), len(page), len(kept)))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", chain: crf.Chain | None = None) -> DataFrame:
    """id, url, text, n_chars, n_blocks and n_content_blocks for every row of `pages`."""
    box = pages.sparkSession.sparkContext.broadcast(chain or train())
    cache: dict[str, int] = {}
    rows = pages.select(*(F.col(f"`{c}`").alias(n) for c, n in zip((id_col, url_col, html_col), "iuh", strict=True)))
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in "iu") + ", text string, n_chars long, n_blocks long, n_content_blocks long"

    def run(cols):
        for a, b in slices((h or "" for h in cols[2])):
            if len(cache) > 100_000:
                cache.clear()
            done = extract_texts(cols[2][a:b], box.value, cache)
            yield [cols[0][a:b], cols[1][a:b], [d[0] for d in done], [len(d[0]) for d in done], [d[1] for d in done], [d[2] for d in done]]

    return map_batches(rows, list("iuh"), run, schema).toDF(id_col, url_col, "text", "n_chars", "n_blocks", "n_content_blocks")
