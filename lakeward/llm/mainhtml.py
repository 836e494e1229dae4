"""Main text of web pages: flat text blocks and a decision tree.

Method. A page's markup is read once into a flat list of text blocks (block
elements end a block; scripts, styles, buttons, videos and the like are
skipped).
A block's features are its word count and link density, those of the blocks
before and after it and of its container, and what it stands in (an element
that is never the article's, a container whose class names a side part, a
reader's comment, the article, a heading, a list). A decision tree (Gini
splits, pruned on pages that it was not grown on) is trained on a small
labelled table: pages put together by ``labelled_pages`` from layouts, article
texts and side parts, with and without ``<article>`` and with class names
that tell nothing or the wrong thing. It keeps or drops each block.

Edge cases. A null or empty html, and a page without a kept block, give an
empty text. Text outside any element (a page of bare text too), unclosed
elements, stray end tags and a missing body are read as they come; a tag of
more than 64 KB is text. Pages of any length are read whole, in time linear
in their length however deep they nest. Repeated rows give a row each. Extra
columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeward.llm.common import table, take

# A comment or a declaration, and a tag; quotes count after an equals sign only.
_TOKEN = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)>""", re.S)
_COMMENT = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: Elements whose content is raw text, up to their end tag or the end of the page, and no text of the page (fixed values).
RAW = frozenset("script style textarea title iframe noembed xmp".split())
#: Elements whose content is markup but no text of the page (fixed values).
DROPPED = frozenset("noscript template svg math select button object audio video canvas option".split())
#: Of these, the ones that end where the next of the kind starts, and what else holds an option (fixed values).
SINGLE = frozenset("select button option".split())
OPTIONS = frozenset("select datalist optgroup".split())
#: Elements that end a block (fixed values).
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                  "h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
                  "ul caption".split())
#: Elements without an end tag (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers of boilerplate by element, and by role (fixed values).
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class and id that name boilerplate (fixed values).
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies copyright disclaimer discussion disqus feedback footer footnav gdpr header legal login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommendations recommended related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget "
    "widgets alert aside reactions rail teaser outbrain taboola".split())
COMMENT_WORDS = frozenset("comment comments discussion disqus replies reply respond feedback reactions".split())
NEGATING = frozenset("has with no without hide show is body page".split())
#: Words that a name of boilerplate may have beside (fixed values).
NEUTRAL_WORDS = frozenset(
    "site page main top bottom left right box block wrapper wrap container area section links link bar list item items inner outer content text "
    "global primary secondary mobile desktop col column row group panel module unit inline sticky fixed small large reader readers user visitor "
    "button buttons icons icon slot zone holder post article story stories posts articles news reports more bottom form title heading head thread "
    "policy message center map".split())
#: Headings over readers' comments, without numbers (fixed values).
COMMENT_HEADINGS = frozenset((
    "comment", "comments", "reader comments", "readers comments", "user comments", "reply", "replies", "responses", "discussion", "join the discussion",
    "leave a comment", "leave a reply", "post a comment", "write a comment", "add a comment", "your comments"))
LONGEST_TAG = 1 << 16

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "aside", "article", "page_has_article",
            "heading", "item", "sentence", "around", "links_around")


def _tag(page: str, at: int):
    """The comment, declaration or tag that starts at ``at``."""
    return _COMMENT.match(page, at) if page[at + 1:at + 2] in ("!", "?") else _TOKEN.match(page, at, at + LONGEST_TAG)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _marks(tag: str, raw: str) -> tuple[bool, int, bool, str]:
    """Of a start tag: a side part by element, by class (2: the name says
    nothing else, 1: a word in it does), of comments; label."""
    strong = tag in BOILER_TAGS
    named = 0
    if not raw or raw.isspace():
        return strong, named, False, ""
    a = _attributes(raw)
    strong = strong or a.get("role", "").lower() in BOILER_ROLES
    style = a.get("style", "").replace(" ", "").lower()
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        strong = True
    comments = False
    if tag not in ("html", "body"):
        for name in re.split(r"\s+", a.get("class", "") + " " + a.get("id", "")):
            parts = [p.lower() for p in _PART.findall(name)]
            if parts and not NEGATING.intersection(parts[:1]):
                hit = BOILER_WORDS.intersection(parts)
                whole = bool(hit) and all(p in BOILER_WORDS or p in NEUTRAL_WORDS or p.isdigit() for p in parts)
                named = max(named, 2 if whole else int(bool(hit)))
                comments = comments or whole and bool(COMMENT_WORDS.intersection(hit))
    return strong, named, comments, a.get("data-label", "")


def _after_raw(page: str, tag: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


_DROPPED_START = re.compile(rf"<(?:{'|'.join(sorted(DROPPED))})(?![^\s/>])", re.I)


def _dropped(page: str) -> dict[int, int]:
    """Where each start tag of DROPPED stands, and where its content ends:
    after its end tag; without one, at the first block that starts in it, or
    else at the end tag of an enclosing block or the next element that ends it."""
    ends: dict[int, int] = {}
    if not _DROPPED_START.search(page):
        return ends
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}
    first_block: dict[int, int] = {}
    waiting: list[int] = []  # dropped elements in which no block has started

    def close(tag: str, lt: int, own: int):
        """Closes the innermost ``tag`` and all in it; the tag itself ends at ``own``, the rest of them are unclosed."""
        while True:
            name, start = stack.pop()
            opened[name] -= 1
            if name in DROPPED:
                ends[start] = own if name == tag and own >= 0 else first_block.get(start, lt)
            if name == tag:
                return

    at, last = 0, page.rfind(">")
    while 0 <= (lt := page.find("<", at)) <= last:
        m = _tag(page, lt)
        if m is None:
            at = lt + 1
            continue
        at = m.end()
        if m.re is _COMMENT:
            continue
        tag = m[2].lower()
        if m[1] == "/":
            if opened.get(tag):
                close(tag, lt, at)
            continue
        empty = m[3].rstrip().endswith("/")
        if tag in RAW:
            at = at if empty else _after_raw(page, tag, at)
            continue
        if tag in VOID or empty and tag in DROPPED or not (tag in BLOCK or tag in DROPPED or tag in OPTIONS):
            continue
        if tag in BLOCK:
            for start in waiting:
                first_block[start] = lt
            waiting.clear()
        if tag in SINGLE and opened.get(tag) and (tag != "option" or stack[-1][0] == "option"):
            close(tag, lt, -1)
        elif tag == "optgroup" and stack and stack[-1][0] == "option":
            close("option", lt, -1)
        stack.append((tag, lt))
        opened[tag] = opened.get(tag, 0) + 1
        if tag in DROPPED:
            waiting.append(lt)
    for name, start in stack:
        if name in DROPPED:
            ends[start] = first_block.get(start, len(page))
    return ends


class _Open:
    __slots__ = ("tag", "strong", "named", "comments", "article", "link", "label", "heading", "item", "box")

    @property
    def rank(self) -> int:
        """How sure it is a side part: 1 a word of its class says so, 2 its whole name, 3 a reader's comment, 4 its element."""
        return 4 if self.strong else 3 if self.comments else self.named

    @property
    def aside(self) -> bool:
        return self.rank > 0


def _open(tag: str, raw: str, up) -> _Open:
    o = _Open()
    strong, named, comments, label = _marks(tag, raw)
    if tag == "header" and not (up and up.article):
        named = 2  # the page's head; an article's own has its title
    o.tag = tag
    o.strong = strong or (up.strong if up else False)
    o.comments = comments or (up.comments if up else False)
    is_article = tag in ("article", "main") or "itemprop" in raw and "articleBody" in raw
    if is_article and not (named or o.strong or o.comments):
        o.named = 0  # an article inside a box whose class names a side part of the page
    else:
        o.named = max(named, up.named if up else 0)
    o.article = is_article or (up.article if up else False)
    o.link = tag == "a" or (up.link if up else False)
    o.label = label or (up.label if up else "")
    o.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6") or (up.heading if up and tag not in BLOCK else False)
    # the title at the head of an article is the article's own
    if tag == "h1" and o.article and not (o.strong or o.comments):
        o.named = 0
    o.item = tag in ("li", "dd", "dt") or (up.item if up else False)
    # words and linked words of the texts right in a container, lists and paragraphs being no containers
    o.box = [0, 0] if up is None or tag in BLOCK and not (tag in PLAIN or o.heading) else up.box
    return o


#: Blocks that belong to the container around them (fixed values).
PLAIN = frozenset("p ul ol li dl dt dd pre blockquote table tbody thead tfoot tr figure figcaption hr".split())


def _comment_heading(text: str) -> bool:
    return " ".join(re.findall(r"[a-z]+", text.lower())) in COMMENT_HEADINGS


def blocks(page: str) -> list[dict]:
    """The flat text blocks of a page, in order, with their features."""
    out: list[dict] = []
    stack: list[_Open] = []
    opened: dict[str, int] = {}  # open elements by name
    texts: list[str] = []
    words = linked = 0
    held = None  # what the block's first text stands in
    page_box = [0, 0]
    has_article = False
    breaks = 0

    def shut(i: int) -> None:
        """The elements from the i-th on end."""
        for o in stack[i:]:
            opened[o.tag] -= 1
        del stack[i:]

    def end_block():
        nonlocal words, linked, held
        if words:
            text = " ".join(" ".join(texts).split()) if len(texts) == 1 else " ".join("".join(texts).split())
            if text:
                comment, box = bool(held and held.comments), held.box if held else page_box
                if held and held.heading and _comment_heading(text):
                    # what follows in the heading's container are comments
                    comment = True
                    for o in reversed(stack):
                        o.comments = True
                        if o.tag in BLOCK and o.tag not in PLAIN and not o.heading:
                            break
                box[0] += words
                box[1] += linked
                out.append({"text": text, "words": words, "links": linked / words, "aside": 3 if comment else held.rank if held else 0, "article": bool(held and held.article), "heading": bool(held and held.heading),
                            "item": bool(held and held.item), "sentence": text[-1] in ".!?\"')”’…:;", "label": held.label if held else "", "box": box})
        texts.clear()
        words = linked = 0
        held = None

    def text_part(raw: str):
        nonlocal words, linked, held, breaks
        if "&" in raw:
            raw = entities.unescape(raw)
        texts.append(raw)
        n = len(raw.split())
        if n:
            breaks = 0
            words += n
            top = stack[-1] if stack else None
            if top is not None and top.link:
                linked += n
            if held is None or (held is not top and top is not None and not top.link and not held.aside and not top.aside):
                held = top if top is not None else held

    at, n, dropped, last = 0, len(page), _dropped(page), page.rfind(">")
    while at < n:
        lt = page.find("<", at)
        if lt < 0 or lt > last:  # no tag ends any more
            text_part(page[at:])
            break
        m = _tag(page, lt)
        if m is None:  # a bare "<" is text
            nxt = page.find("<", lt + 1)
            text_part(page[at:nxt if nxt >= 0 else n])
            at = nxt if nxt >= 0 else n
            continue
        if lt > at:
            text_part(page[at:lt])
        at = m.end()
        if m.re is _COMMENT:
            continue
        tag = m[2].lower()
        closing = m[1] == "/"
        if tag == "br":
            breaks += 1
            texts.append(" ")
            if breaks > 1:
                end_block()
            continue
        if not closing and tag in RAW:
            if not m[3].rstrip().endswith("/"):
                at = _after_raw(page, tag, at)
            continue
        if not closing and tag in DROPPED:
            at = dropped.get(lt, at)
            continue
        if tag in BLOCK:
            end_block()
        if closing:
            if not opened.get(tag):
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    if tag not in BLOCK and stack[i].aside and words:
                        end_block()
                    shut(i)
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break  # an inline end tag closes nothing outside its block
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            # a block start closes an open paragraph and the inline elements in it; an item closes the item before it
            for i in range(len(stack) - 1, -1, -1):
                t = stack[i].tag
                if t == "p" or t[0] == "h" and t in ("h1", "h2", "h3", "h4", "h5", "h6") or t == "li" == tag or t in ("dt", "dd") and tag in ("dt", "dd"):
                    shut(i)
                    break
                if t in BLOCK:
                    break
        elif tag != "a" and not m[3].strip():
            continue  # plain inline markup
        elif tag == "a" and stack and stack[-1].tag == "a":
            shut(len(stack) - 1)  # links do not nest
        top = _open(tag, m[3], stack[-1] if stack else None)
        if not stack:
            top.box = page_box if tag not in BLOCK or tag in PLAIN or top.heading else top.box
        if tag not in BLOCK and top.aside and not (stack and stack[-1].aside):
            end_block()  # a marked inline part is a block of its own
        has_article = has_article or (top.article and not top.aside)
        stack.append(top)
        opened[tag] = opened.get(tag, 0) + 1
    end_block()
    for i, b in enumerate(out):
        before, after = out[i - 1] if i else None, out[i + 1] if i + 1 < len(out) else None
        b["words_before"], b["links_before"] = (before["words"], before["links"]) if before else (0, 0.0)
        b["words_after"], b["links_after"] = (after["words"], after["links"]) if after else (0, 0.0)
        b["page_has_article"] = has_article
        b["around"], b["links_around"] = b["box"][0], b["box"][1] / b["box"][0]
    return out


#: Sentences of the labelled pages, from long to a word.
_TEXTS = (
    "The river rose in the night and by the morning the lower fields were under water, so the farmers moved their herds up the hill.",
    "After the meeting the council said that the old bridge would be closed for repairs until the end of the summer, which nobody in the valley had expected.",
    "Her grandfather had built the mill with his own hands, stone by stone, in the three years before the railway came to the town.",
    "Nobody had seen the harbour so quiet since the winter storms.",
    "Prices of grain went up again, as they had in the spring.",
    "It did not last.", "He said no.", "Yes.", "Rain", "See the report of the year before")
#: Side parts that stand before the article, and those that stand after it; the texts are put in for the braces.
_BEFORE = (
    "<nav><ul><li><a href=x>Home</a></li><li><a href=x>World</a></li></ul></nav>", "<div class=top-menu><a href=x>News</a> <a href=x>Sport</a></div>",
    "<div><a href=x>News</a> | <a href=x>Sport</a> | <a href=x>{9}</a></div>", "<header><h2>The Daily Page</h2><p>{3}</p></header>",
    "<header class=site-header><p>{0}</p></header>", "<div class=cookie-notice><p>{1}</p></div>", "<div role=alert>{4}</div>", "<p>Menu</p><p><a href=x>One</a></p>",
    "<div class=breadcrumbs><a href=x>Start</a> / <a href=x>Valley</a> / Floods</div>", "<div class=ad>{2}</div>", "<div class=ad>{5}</div>", "<div id=login>Log in</div>",
    "<table><tr><td><a href=x>Start</a></td><td><a href=x>Archive</a></td></tr></table>", "<div style='display: none'>{0}</div>", "")
_AFTER = (
    "<footer>Copyright Valley News. {4}</footer>", "<footer><p>{1}</p><p><a href=x>Imprint</a></p></footer>", "<div class=foot><a href=x>Terms</a></div>",
    "<div><a href=x>Older</a> <a href=x>Newer</a></div>", "<p><a href=x>Terms</a> <a href=x>Privacy</a></p>", "<aside><h3>Most read</h3><p>{0}</p></aside>",
    "<div class=sidebar><h3>Most read</h3><p>{1}</p><p>{3}</p></div>", "<div id=comments><p>{0}</p><p>{6}</p></div>", "<section class=reader-comments><p>{2}</p></section>",
    "<section><h3>Comments</h3><p>{1}</p><p>{7}</p></section>", "<div><h2>3 Comments</h2><div><p>{0}</p></div></div>", "<div class=related><h4>Read more</h4><p>{3}</p></div>",
    "<div class=share-buttons><a href=x>Share</a> <a href=x>Mail</a></div>", "<div class=newsletter><p>{4}</p><form><p>Your mail</p></form></div>",
    "<form><p>{3}</p></form>", "<div><a href=x>{3}</a></div><div><a href=x>{4}</a></div>", "<div class=promo-box>{2}</div>", "<p><a href=x>Back</a></p>",
    "<div class=copyright>{4}</div>", "")
#: Layouts of the article, its text being put in for the braces.
_AROUND = (
    "<article data-label=main>{}</article>", "<main data-label=main>{}</main>", "<main><div class=text data-label=main>{}</div></main>",
    "<article><header data-label=main><h1>Late ships</h1></header><div data-label=main>{}</div></article>", "<div class=post data-label=main>{}</div>",
    "<div class=content><div data-label=main>{}</div></div>", "<div id=story data-label=main>{}</div>", "<section data-label=main>{}</section>",
    "<table><tr><td data-label=main>{}</td></tr></table>", "<div data-label=main>{}</div>", "<body data-label=main>{}</body>", "<div class=page-sidebar-left><article data-label=main>{}</article></div>",
    "<div itemprop=articleBody data-label=main>{}</div>")
#: Parts of the article's text.
_PARTS = (
    "<p>{0}</p>", "<p>{1}</p>", "<p>{2} {3}</p>", "<p>{3}</p>", "<p>{4}</p>", "<p>{5}</p>", "<p>{6}</p>", "<p>{7}</p>", "<p>{8}</p>", "<h2>What follows</h2>",
    "<h3>{9}</h3>", "<ul><li>Two bridges closed</li><li>{5}</li></ul>", "<blockquote>{3}</blockquote>", "<p>{1} <a href=x>{9}</a></p>", "<p>{0}<br><br>{2}</p>",
    "<p class=share-price>{0}</p>", "<p class=footnote-ad-7>{1}</p>", "<p class=comment-on-prices>{2}</p>", "<pre>a b c</pre>", "<p><a href=x>{9}</a> {6}</p>",
    "<p><a href=x>A linked line of the story that stands alone</a></p>", "{0}", "<div>{1}</div>")
#: Side parts inside an article.
_WITHIN = ("<div class=advert>{4}</div>", "<div class=ad>{0}</div>", "<div class=share><a href=x>Share</a><a href=x>Mail</a></div>", "<aside>{3}</aside>", "<form><p>{3}</p></form>",
           "<p><a href=x>Next page</a></p>", "<ul><li><a href=x>One</a></li><li><a href=x>Two more</a></li><li><a href=x>Three</a></li></ul>",
           "<p><a href=x>Older</a> | <a href=x>Newer</a></p>", "<div><a href=x>{9}</a></div>", "<p><a href=x>Print</a></p>")


def labelled_pages(n: int = 800, seed: int = 1) -> list[str]:
    """Pages of random layouts, side parts and articles; what is marked
    ``data-label=main`` is the article's text."""
    r = random.Random(seed)
    pages = []
    for _ in range(n):
        def put(part):
            texts = list(_TEXTS)
            if r.random() < 0.3:  # as long as several sentences
                texts[:5] = [" ".join(r.choices(_TEXTS[:5], k=r.randrange(1, 6))) for _ in range(5)]
            return part.format(*texts)

        text = [put(r.choice(_PARTS[:3]))] + [put(r.choice(_PARTS)) for _ in range(r.randrange(6))]
        r.shuffle(text)
        if r.random() < 0.7:
            text.insert(0, r.choice(("<h1>Floods in the valley</h1>", "<h1>T</h1>", "<h2>A quiet harbour</h2>")))
        around = r.choice(_AROUND)
        if r.random() < 0.5:
            text.insert(r.randrange(1, len(text) + 1), put(r.choice(_WITHIN)).replace(">", " data-label=side>", 1))
        if r.random() < 0.05:
            pages.append(f"<body data-label=main>{_TEXTS[r.randrange(5)]} {_TEXTS[r.randrange(5)]}</body>")  # a page of bare text
            continue
        before = [put(r.choice(_BEFORE)) for _ in range(r.randrange(4))]
        after = [put(r.choice(_AFTER)) for _ in range(r.randrange(4))]
        if around.startswith("<body"):  # paragraphs right in the body: the label goes to each
            body = "".join(t if "data-label" in t else re.sub(r"^<(\w+)", r"<\1 data-label=main", t) if t[0] == "<" else f"<div data-label=main>{t}</div>" for t in text)
        else:
            body = around.format("".join(text))
        pages.append(f"<html><body>{''.join(before)}{body}{''.join(after)}</body></html>")
    return pages


def row(b: dict) -> list[float]:
    return [float(b[f]) for f in FEATURES]


def labelled_blocks(pages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and page numbers of the blocks of labelled pages."""
    found = [(i, b) for i, page in enumerate(pages) for b in blocks(page)]
    return np.array([row(b) for _, b in found]), np.array([b["label"] == "main" for _, b in found], float), np.array([i for i, _ in found])


def grow(x: np.ndarray, y: np.ndarray, depth: int, least: int):
    """A decision tree (Gini): nested [feature, threshold, low, high, majority], or 0/1 at a leaf."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return int(share >= 0.5)
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(v) + 1)
        ends = np.flatnonzero(v[1:] != v[:-1])
        ends = ends[(ends + 1 >= least) & (len(v) - ends - 1 >= least)]
        if not len(ends):
            continue
        low, high = ones[ends] / n[ends], (ones[-1] - ones[ends]) / (len(v) - n[ends])
        impurity = n[ends] * low * (1 - low) + (len(v) - n[ends]) * high * (1 - high)
        k = int(np.argmin(impurity))
        if best is None or impurity[k] < best[0] - 1e-9:
            best = (impurity[k], f, float((v[ends[k]] + v[ends[k] + 1]) / 2))
    if best is None or best[0] >= len(y) * share * (1 - share) - 1e-9:
        return int(share >= 0.5)
    low = x[:, best[1]] <= best[2]
    return [best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least), int(share >= 0.5)]


def prune(tree, x: np.ndarray, y: np.ndarray):
    """A branch that is no better than its majority on other pages' blocks becomes a leaf."""
    if isinstance(tree, int):
        return tree
    low = x[:, tree[0]] <= tree[1]
    tree = [tree[0], tree[1], prune(tree[2], x[low], y[low]), prune(tree[3], x[~low], y[~low]), tree[4]]
    wrong = sum(keeps(tree, list(r)) != bool(v) for r, v in zip(x, y))
    return tree[4] if (y != tree[4]).sum() <= wrong else tree


@lru_cache(maxsize=4)
def train_tree(n: int = 800, seed: int = 1, depth: int = 12, least: int = 3):
    """The tree, grown on three quarters of the labelled pages and pruned on the others."""
    x, y, page = labelled_blocks(labelled_pages(n, seed))
    other = page % 4 == 3
    return prune(grow(x[~other], y[~other], depth, least), x[other], y[other])


def keeps(tree, values: list[float]) -> bool:
    while not isinstance(tree, int):
        tree = tree[2] if values[tree[0]] <= tree[1] else tree[3]
    return bool(tree)


def main_text(page: str | None, tree) -> str:
    return "\n".join(b["text"] for b in blocks(page or "") if keeps(tree, row(b)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    tree = train_tree()

    def run(batches):
        for batch in batches:
            text = [main_text(h, tree) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return take(pages, "page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
