"""Main text of web pages: boosted trees judge the blocks of the document tree, and decoding keeps them consistent.

A page is parsed to its block elements. Each gets features: depth, its place among its siblings and their sizes, text
and link density of its subtree, what its tag and attribute tokens and those of its ancestors name. The trees give
the log odds that it holds main text. Decoding chooses the best set in which no block is kept below a dropped one: from
the leaves up, a block is worth its log odds and the worth of its children, or nothing if that is negative.

The trees are fitted on pages that this module composes, where every block's part is known; none of the corpus is used.

An article's own header and its pictures' captions are main text; headers beside an article and footers are not.

Defined cases: null or empty html and pages without main text give the empty string; unclosed and stray tags are
mended by a few of the browsers' rules (paragraphs, list items, table cells, links, heads); scripts, styles, drawings and other unseen content never count,
formulas do without their annotations; character references are decoded, also
unfinished ones; nothing is capped; repeated rows repeat; other columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm.common import table
from gridwarden.llm.trees import BoostedTrees

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Formulas run in the line; browsers show all of them but their annotations.
MATH = frozenset(
    "math annotation annotation-xml maction maligngroup malignmark menclose merror mfenced mfrac mglyph mi mlabeledtr"
    " mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable"
    " mtd mtext mtr munder munderover none semantics".split()
)
UNSEEN = frozenset(
    "script style head title noscript template svg annotation annotation-xml iframe object canvas audio video".split()
)
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Start tags that end an open paragraph, and those that end an open tag of their own kind.
ENDS_P = frozenset(
    "address article aside blockquote body center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " main menu nav ol p pre section table ul li dd dt".split()
)
ENDS_OWN = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: What lies in these is part of an article by its tag alone.
ARTICLE = frozenset(["article", "main"])
SCOPES = frozenset("ul ol dl table article section div main body html td th select".split())
#: Words in tags, classes, ids and roles that name a part of a page.
PARTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc toolbar skip",
    "header": "header masthead banner topbar logo branding",
    "footer": "footer copyright colophon bottom legal",
    "side": "aside sidebar side rail widget related recommended trending popular archive tagcloud",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall disclaimer",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner-ad outbrain taboola",
    "form": "form search login signup signin register input fieldset select button textarea",
    "comment": "comment comments reply replies respond discussion disqus thread reader",
    "share": "share sharing social author byline meta tags tag-list",
    "content": "article main content post entry story body text page",
}
NAMED = {word: number for number, words in enumerate(PARTS.values()) for word in words.split()}
KINDS = ["h1 h2 h3 h4 h5 h6", "p blockquote pre figcaption", "li dd dt", "ul ol dl menu", "td th tr table tbody thead", "div section"]
KIND = {tag: number for number, tags in enumerate(KINDS) for tag in tags.split()}
FEATURES = 15 + len(KINDS) + 1 + 2 * len(PARTS)
BATCH_CHARS = 4 << 20


class Page(HTMLParser):
    """The block elements of a page in order: parents, tags, named parts; and the texts between block boundaries."""

    def __init__(self, html: str, labelled: bool = True):
        super().__init__(convert_charrefs=True)
        self.labelled = labelled  # whether `data-main` states the parts, as in composed pages
        self.tags, self.parent, self.parts, self.label = ["#root"], [-1], [frozenset()], [1]
        self.stack: list[tuple[str, int]] = [("#root", 0)]  # open elements and the block that each is or lies in
        self.depths: dict[str, list[int]] = {}  # where in the stack each tag is open
        self.open_blocks: list[int] = []  # the same for all elements that are not inline
        self.blocks: list[list[tuple[int, str]]] = [[]]
        self.linked = [0]
        self.in_link = self.unseen = 0
        self.feed(html)
        self.close()

    def break_block(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, _ = self.stack.pop()
            self.depths[tag].pop()
            self.in_link -= tag == "a"
            self.unseen -= tag in UNSEEN
            if tag not in INLINE:
                self.open_blocks.pop()
                self.break_block()

    def nearest(self, tags: Iterable[str]) -> int:
        """The depth of the innermost open element of these tags; 0 if none is open."""
        return max((self.depths[tag][-1] for tag in tags if self.depths.get(tag)), default=0)

    def end_open(self, tags: set[str] | frozenset[str]) -> None:
        """Closes the nearest of the given tags, unless a scope lies between."""
        depth = self.nearest(tags)
        if depth and depth >= self.nearest(SCOPES):
            self.pop_to(depth)

    def end_head(self) -> None:
        """Closes an open head that nothing else is open in."""
        if self.stack[-1][0] == "head":
            self.pop_to(len(self.stack) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" and self.unseen and not self.nearest(["template"]) and self.nearest(["head"]):
            self.pop_to(self.depths["head"][0])
        if tag not in IN_HEAD:
            self.end_head()
        if tag in ENDS_P and not self.unseen:
            self.end_open(frozenset(["p"]))
        if tag in ENDS_OWN:
            self.end_open(ENDS_OWN[tag])
        if tag == "a" and self.in_link:
            self.end_open(frozenset(["a"]))
        if tag in VOID:
            if tag not in INLINE:
                self.break_block()
            elif self.blocks[-1]:
                self.blocks[-1].append((self.stack[-1][1], " "))
            return
        block = self.stack[-1][1]
        if tag not in INLINE:
            self.break_block()
            words = " ".join(value for name, value in attrs if value and name in ("class", "id", "role", "aria-label"))
            tokens = [tag, *re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", words).lower())]
            self.tags.append(tag)
            self.parent.append(block)
            self.parts.append(frozenset(NAMED[t] for t in tokens if t in NAMED))
            own = next((value for name, value in attrs if name == "data-main"), None) if self.labelled else None
            self.label.append(self.label[block] if own is None else int(own or 0))
            self.linked.append(0)
            block = len(self.tags) - 1
        self.depths.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.open_blocks.append(len(self.stack))
        self.stack.append((tag, block))
        self.in_link += tag == "a"
        self.unseen += tag in UNSEEN

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag == "svg" or tag in MATH:  # elsewhere browsers ignore the slash
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        depth = self.nearest([tag])
        walled = tag in INLINE and tag not in MATH and self.open_blocks and self.open_blocks[-1] > depth
        if depth and not walled:
            self.pop_to(depth)

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.end_head()
        if not self.unseen:
            block = self.stack[-1][1]
            self.blocks[-1].append((block, data))
            self.linked[block] += len(data.strip()) if self.in_link else 0


def features_of(page: Page) -> np.ndarray:
    """A row of features per block element."""
    n = len(page.tags)
    own, signs = np.zeros(n), np.zeros(n)
    begin = np.zeros(n)
    at = 0
    for block in page.blocks:
        for node, text in block:
            size = len(text.strip())
            own[node] += size
            signs[node] += text.count(",") + text.count(".")
            at += size
    linked, total, nodes, paragraphs = np.array(page.linked, float), own.copy(), np.ones(n), np.array([t == "p" for t in page.tags], float)
    children, siblings_text, number = np.zeros(n), np.zeros(n), np.zeros(n)
    depth, inside, above = np.zeros(n), np.zeros(n), [frozenset()] * n
    for node in range(n - 1, 0, -1):
        up = page.parent[node]
        for values in (linked, total, nodes, paragraphs, signs):
            values[up] += values[node]
    seen = 0.0
    for node in range(1, n):
        up = page.parent[node]
        depth[node] = depth[up] + 1
        inside[node] = inside[up] or page.tags[up] in ARTICLE
        number[node] = children[up]
        children[up] += 1
        siblings_text[up] += total[node]
        above[node] = above[up] | page.parts[up]
        begin[node] = seen
        seen += own[node]
    parent = np.maximum(np.array(page.parent), 0)
    every = max(total[0], 1)
    count = np.maximum(children[parent], 1)
    x = np.zeros((n, FEATURES), np.float32)
    columns = [
        depth, count, number / count, np.log1p(own), np.log1p(total), linked / np.maximum(total, 1), np.log1p(total / nodes),
        total / every, signs / np.maximum(total, 1), children, paragraphs, begin / every,
        np.log1p(siblings_text[parent] / count), total / np.maximum(siblings_text[parent] / count, 1), inside,
    ]
    x[:, : len(columns)] = np.stack(columns, axis=1)
    base = len(columns)
    for node in range(n):
        x[node, base + KIND.get(page.tags[node], len(KINDS))] = 1
        for part in page.parts[node]:
            x[node, base + len(KINDS) + 1 + part] = 1
        for part in above[node]:
            x[node, base + len(KINDS) + 1 + len(PARTS) + part] = 1
    return x


def kept_blocks(page: Page, logits: np.ndarray) -> np.ndarray:
    """The best choice in which whatever is kept lies in kept blocks only."""
    worth = logits.copy()
    for node in range(len(worth) - 1, 0, -1):
        if worth[node] > 0:
            worth[page.parent[node]] += worth[node]
    kept = worth > 0
    for node in range(1, len(kept)):
        kept[node] &= kept[page.parent[node]]
    return kept


def text_of(page: Page, kept: np.ndarray) -> str:
    blocks = (" ".join("".join(text for node, text in block if kept[node]).split()) for block in page.blocks)
    return "\n\n".join(block for block in blocks if block)


def composed_page(make: random.Random) -> str:
    """A page with every block's part marked in `data-main`, of varied structure."""
    letters = "abcdefghijklmnopqrstuvwxyzéüñ"
    word = lambda: "".join(make.choice(letters) for _ in range(make.randint(1, 10)))
    words = lambda low, high: " ".join(word() for _ in range(make.randint(low, high)))
    sentence = lambda: words(*make.choice([(1, 3), (3, 18), (3, 18)])).capitalize() + make.choice([".", ".", ".", "?", " |", ""])
    prose = lambda most=8: " ".join(sentence() for _ in range(make.randint(1, most)))
    links = lambda tag="li": "".join(f"<{tag}><a href='/{word()}'>{words(1, 4)}{make.choice(['', '', ',', '.'])}</a></{tag}>" for _ in range(make.randint(2, 9)))

    def part(name: str, tags: list[str], inside: str) -> str:
        """A block of another part, named by its tag or by its attributes."""
        tag = make.choice([*tags, "div", "section"])
        own = make.choice(PARTS[name].split())
        named = tag not in ("div", "section") and make.random() < 0.5
        attrs = "" if named else f' {make.choice(["class", "class", "id"])}="{make.choice(["", "", word() + " ", word() + "-"])}{own}"'
        return f'<{tag}{attrs} data-main="0">{inside}</{tag}>'

    paragraph = lambda: make.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p>{}</p>"]).format(
        prose() + (f" <a href='#'>{words(1, 3)}</a> {words(1, 6)}." if make.random() < 0.15 else "")
    )
    menu = lambda: part("menu", ["nav"], make.choice([f"<ul>{links()}</ul>", links("span"), links("div")]))
    advert = lambda: part("advert", ["aside"], make.choice([prose(3), f"<p>{prose(3)}</p>", f"<a href='/'>{words(2, 8)}</a>"]))
    side = lambda: part("side", ["aside"], make.choice([f"<h3>{words(1, 3)}</h3><ul>{links()}</ul>", f"<h4>{words(1, 3)}</h4><p>{prose(3)}</p>"]))
    notice = lambda: part("notice", [], make.choice([f"<p>{prose(3)}</p>", prose(2)]) + make.choice(["", f"<button>{word()}</button>"]))
    fill_in = lambda: part("form", ["form"], f"<label>{words(1, 3)}</label><input name='q'>" + make.choice(["", f"<p>{words(2, 8)}</p>", f"<button>{word()}</button>"]))
    comments = lambda: part("comment", [], make.choice(["", f"<h3>{words(1, 3)}</h3>"]) + "".join(make.choice(["<div>{}</div>", "<p>{}</p>", "<li>{}</li>", "<div><b>x</b><p>{}</p></div>"]).format(prose(4)) for _ in range(make.randint(1, 6))))
    head = lambda: part("header", ["header"], make.choice([f"<h1>{words(1, 4)}</h1>", f"<p>{words(2, 8)}</p>", f"<div>{words(1, 5)}</div>"]))
    foot = lambda: part("footer", ["footer"], make.choice([f"&copy; {words(2, 12)}", f"<p>&copy; {prose(2)}</p>", f"<ul>{links()}</ul><p>{words(2, 9)}</p>"]))
    share = lambda: part("share", [], make.choice([links("span"), f"<p>{words(2, 6)}</p>"]))

    figure = lambda: f'<figure{make.choice(["", "", chr(32) + "class=" + word()])}><img src="{word()}.png">{make.choice(["<figcaption>{}</figcaption>", "<figcaption><p>{}</p></figcaption>"]).format(prose(2))}</figure>'

    tag, attrs = make.choice([("article", ""), ("article", ""), ("main", ""), ("div", ' id="content"'), ("div", ' class="post-body"'), ("section", ' class="entry"'), ("div", ' class="story"'), ("div", "")])
    body = [f"<h1>{words(2, 10)}</h1>"] if make.random() < 0.85 else []
    if body and tag in ARTICLE and make.random() < 0.4:  # an article's own header belongs to it
        body = [f"<header>{body[0]}{make.choice(['', f'<p>{sentence()}</p>'])}</header>"]
    for _ in range(make.choice([1, 2, 3, 5, 8, 13, 30])):
        body.append(
            make.choices(
                [paragraph(), f"<h2>{words(1, 6)}</h2>", f"<ul>{''.join(f'<li>{sentence()}</li>' for _ in range(3))}</ul>", f"<blockquote>{prose(3)}</blockquote>", f"<pre>{words(4, 20)}</pre>", f"<table><tr><td>{words(1, 5)}<td>{words(1, 5)}</table>", f"<div>{prose()}</div>", figure()],
                [20, 2, 2, 1, 0.5, 0.5, 1, 1],
            )[0]
        )
    for extra in (advert, side, fill_in, share, notice):
        if make.random() < 0.12:
            body.insert(make.randint(0, len(body)), extra())
    if make.random() < 0.15:
        body.append(comments())
    if make.random() < 0.1:
        body.append(foot())
    article = f'<{tag}{attrs} data-main="1">{"".join(body)}</{tag}>'
    if make.random() < 0.3:
        article = f'<div class="{make.choice(["wrap", "container", "layout", "page"])}" data-main="1">{head() if make.random() < 0.3 else ""}{menu() if make.random() < 0.2 else ""}{article}{side() if make.random() < 0.4 else ""}</div>'
    before = [x() for x, p in ((head, 0.4), (menu, 0.7), (notice, 0.3), (advert, 0.4), (fill_in, 0.2)) if make.random() < p]
    after = [x() for x, p in ((comments, 0.35), (side, 0.35), (advert, 0.2), (share, 0.2), (fill_in, 0.2), (menu, 0.2), (foot, 0.75), (notice, 0.15)) if make.random() < p]
    make.shuffle(before)
    html = f'<html><head><title>{words(2, 8)}</title><style>p{{}}</style></head><body data-main="1">{"".join(before)}{article}{"".join(after)}</body></html>'
    return html[: make.randint(len(html) // 2, len(html))] if make.random() < 0.1 else html


def trained(pages: int = 1500, seed: int = 5) -> BoostedTrees:
    """Trees fitted on composed pages, on the blocks that hold text."""
    make, x, y = random.Random(seed), [], []
    for _ in range(pages):
        page = Page(composed_page(make))
        rows = features_of(page)
        full = rows[:, 4] > 0
        x.append(rows[full])
        y.append(np.array(page.label)[full])
    return BoostedTrees().fit(np.concatenate(x), np.concatenate(y))


def main_texts(htmls: list[str | None], trees: BoostedTrees) -> list[str]:
    """The main text of each page."""
    pages = [Page(html or "", labelled=False) for html in htmls]
    if not pages:
        return []
    rows = [features_of(page) for page in pages]
    logits = trees.logits(np.concatenate(rows))
    cuts = np.cumsum([len(r) for r in rows])[:-1]
    return [text_of(page, kept_blocks(page, own)) for page, own in zip(pages, np.split(logits, cuts), strict=True)]


def with_main_text(pages: DataFrame) -> DataFrame:
    """The rows with `text`, the main text, instead of `html`."""
    shared = pages.sparkSession.sparkContext.broadcast(vars(trained()))
    kept = [f for f in pages.schema if f.name not in ("html", "text")]
    names, fields = [f.name for f in kept], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = BoostedTrees()
        vars(trees).update(shared.value)
        for batch in batches:
            texts, held, size = [], [], 0
            for html in batch.column("html"):
                held.append(html.as_py())
                size += len(held[-1] or "")
                if size >= BATCH_CHARS:
                    texts += main_texts(held, trees)
                    held, size = [], 0
            texts += main_texts(held, trees)
            columns = {name: batch.column(name) for name in names}
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return pages.select(*names, "html").mapInArrow(extracted, f"{fields}, text string")


def html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
