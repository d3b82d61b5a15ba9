"""Main text of HTML pages by composite text density.

A page becomes a tree of elements. Scripts, styles, media and form controls are cut
off. Others are suspect: menus, footers and asides by tag or role; forms and dialogs,
unless most of the page's unlinked characters are in them (a form around the page);
elements with a furniture word in a class or id (has-, no- and with- words aside),
unless they hold the article, that is the largest article or main element, or where
there is none, the container of the highest score (below). A word like "share" or
"related" names furniture by itself or beside a word like "box"; beside others
("share-price") the element must consist mostly of links too. A page header goes, a
header with the headline inside the article's container stays. Of what is left, each
node gets a density: its characters per tag, adjusted for the share of link characters and link tags. The sum of its
children's densities is the node's score. The container (not a paragraph, a list or
an inline tag) of the highest score is the content, whatever its tag. The smallest
density on the path from the body to it is the threshold: the path's other children
belong to the content if they, or mostly unlinked ones with a part, reach it, and
headings always do. Inside the article or main element around the content, half the
threshold is enough; these tags have no other say in the choice.

Defined results
---------------
* null, empty or textless html: an empty string, 0 characters.
* broken markup: unclosed and stray tags are repaired as browsers do for
  paragraphs, list items, table cells and inline tags; text after the last
  complete tag is kept.
* character references are decoded once; an incomplete one stays as it is.
* page_id and url are passed through, nulls and repeats included.
* empty table: empty result. Other columns are ignored.

Scale: one pass in Arrow batches without a shuffle; memory is one page's tree, and
time grows with its tags, however deep they are nested.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead tr ul td th".split()
)
#: An opening block ends a paragraph; these end an open element of their own kind.
CLOSES_P = BLOCK - {"body", "html", "option", "caption", "tbody", "tfoot", "thead", "tr", "td", "th", "legend"}
SAME_KIND = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "thead": {"tr", "td", "th"},
}
SCOPE = frozenset("html table td th caption object button template ul ol dl select".split())
P_SCOPE = frozenset("html table td th caption object button template".split())

CUT_TAGS = frozenset(
    "script style noscript template head title iframe frame object embed applet svg canvas audio video button input select textarea label datalist "
    "annotation annotation-xml".split()
)
#: Furniture by their tag or role; the second kind may wrap a whole page.
FURNITURE_TAGS = frozenset("nav footer aside menu".split())
WRAPPER_TAGS = frozenset("form dialog".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar tablist alert".split())
WRAPPER_ROLES = frozenset("form dialog alertdialog".split())
#: Furniture, whatever other word a class or id puts beside them.
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot banner banners sponsor sponsored sponsors cookie cookies "
    "consent gdpr popup modal overlay newsletter subscribe signup login signin sidebar sidebars nav navbar navigation breadcrumb breadcrumbs pagination "
    "pager footer footers masthead comment comments commentlist disqus toolbar topbar skip skiplink paywall".split()
)
#: Furniture by themselves or beside words of the next list; "share-price" and "related-work" are not.
HEAD_WORDS = frozenset(
    "promo promos promotion notice notices subscription aside menu menus reply replies respond related recommended recommendations share sharing social "
    "widget widgets disclaimer".split()
)
GENERIC = frozenset(
    "area articles bar block body box btn button buttons card cards column container content cta div footer group header heading icon icons inline inner "
    "item items label link links list media news outer panel post posts pages row section site stories text this title tools topics us wrap wrapper".split()
)
#: These name page furniture outside an article, and may hold its title inside.
CUT_OUTSIDE = frozenset("header headers head top".split())
#: "has-sidebar", "comment-enabled": what the page has, not what the element is.
MODIFIERS = frozenset("has no not with without hide show is".split())
STATES = frozenset("enabled disabled on off open closed visible hidden".split())
#: What makes an element suspect, from the strongest sign on.
NONE, TAG, WRAPPER, NAME, TITLE, WEAK = range(6)
WHOLE = frozenset(("html", "body", "main", "article"))
#: Never the content by themselves: they stand in a container.
TEXT_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd ul ol dl pre blockquote figure figcaption caption summary a b i em strong span font u s small big sub sup code kbd q cite "
    "mark abbr time ins del".split()
)


class _Tree(HTMLParser):
    """Flat tree: node i has tag, parent, whether it is cut and what makes it suspect; texts are (node, text)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.cut, self.inside = ["#root"], [-1], [False], [False]
        self.role_main, self.suspect = [False], [NONE]
        self.texts: list[tuple[int, str]] = []
        self.stack = [0]
        #: Depths in the stack of the open elements of each tag, and of the open blocks.
        self.open: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def _deepest(self, tags) -> int:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _close_at(self, depth: int) -> None:
        for i in reversed(self.stack[depth:]):
            self.open[self.tag[i]].pop()
            if self.tag[i] in BLOCK:
                self.blocks.pop()
        del self.stack[depth:]

    def _close(self, kinds, scope) -> None:
        """Close the innermost element of these kinds, unless one of ``scope`` is between."""
        depth = self._deepest(kinds)
        if depth and depth >= self._deepest(scope):
            self._close_at(depth)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close({"p"}, P_SCOPE)
        if tag in SAME_KIND:
            for _ in range(2 if tag in ("tr", "tbody", "thead") else 1):
                self._close(SAME_KIND[tag], SCOPE - SAME_KIND[tag])
        up = self.stack[-1]
        me = len(self.tag)
        inside = self.inside[up] or tag in ("article", "main")
        self.tag.append(tag)
        self.parent.append(up)
        self.cut.append(self.cut[up] or tag in CUT_TAGS)
        self.suspect.append(self._suspect(tag, attrs, self.inside[up]))
        self.inside.append(inside)
        self.role_main.append(tag in ("article", "main") or any(k == "role" and v in ("main", "article") or k == "itemprop" and v == "articleBody" for k, v in attrs))
        if tag not in VOID:
            self.open.setdefault(tag, []).append(len(self.stack))
            if tag in BLOCK:
                self.blocks.append(len(self.stack))
            self.stack.append(me)
        else:
            self.texts.append((me, " "))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    @staticmethod
    def _suspect(tag, attrs, inside) -> int:
        if tag in FURNITURE_TAGS:
            return TAG
        if tag in WRAPPER_TAGS:
            return WRAPPER
        if tag in WHOLE:
            return NONE
        signs = {TITLE} if tag == "header" and not inside else set()
        for k, v in attrs:
            if not v:
                continue
            if k == "role":
                role = v.strip().lower()
                signs |= {TAG} if role in FURNITURE_ROLES else {WRAPPER} if role in WRAPPER_ROLES else set()
            if k not in ("class", "id"):
                continue
            for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", v).lower().split():
                words = [w for w in re.split(r"[_\-:./]+", name) if w and not w.isdigit()]
                if not words or words[-1] in STATES or any(w in MODIFIERS for w in words[:-1]):
                    continue
                if any(w in CUT_WORDS for w in words):
                    signs.add(NAME)
                elif any(w in HEAD_WORDS for w in words):
                    signs.add(NAME if all(w in HEAD_WORDS or w in GENERIC for w in words) else WEAK)
                elif not inside and any(w in CUT_OUTSIDE for w in words):
                    signs.add(TITLE)
        return min(signs, default=NONE)

    def handle_endtag(self, tag):
        depth = self._deepest((tag,))
        # A stray inline end tag does not close the block that it stands in.
        if depth and (tag in BLOCK or not self.blocks or self.blocks[-1] < depth):
            self._close_at(depth)

    def handle_data(self, data):
        self.texts.append((self.stack[-1], data))


def densities(tree: _Tree) -> tuple[list[float], list[float], list[int], list[int]]:
    """Density, sum of the children's densities, characters and link characters of every node that is not cut."""
    n = len(tree.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[tree.parent[i]] or tree.tag[i] == "a"
    for i, t in tree.texts:
        if not tree.cut[i]:
            k = len("".join(t.split()))
            chars[i] += k
            links[i] += k * in_link[i]
    for i in range(n - 1, 0, -1):
        if tree.cut[i]:
            continue
        p = tree.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (tree.tag[i] == "a")
    share = links[0] / chars[0] if chars[0] else 0.0
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if tree.cut[i] or not chars[i]:
            continue
        c, lc, t, lt = chars[i], links[i], max(tags[i], 1), max(link_tags[i], 1)
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        inner = c / max(lc, 1) * t / lt
        density[i] = c / t * (math.log(inner) / math.log(base) if base > 1 and inner > 1 else (1.0 if inner > 1 else 0.0))
        if i:
            total[tree.parent[i]] += density[i]
    return density, total, chars, links


def _best(tree: _Tree, total: list[float]) -> int:
    """The container of the highest density sum."""
    return max((i for i in range(len(total)) if tree.tag[i] not in TEXT_TAGS), key=lambda i: (total[i], -i))


def _pass_down(tree: _Tree) -> None:
    for i in range(1, len(tree.tag)):
        tree.cut[i] = tree.cut[i] or tree.cut[tree.parent[i]]


def cut_suspects(tree: _Tree) -> None:
    """Cut the suspect elements off, but none that holds the article."""
    n = len(tree.tag)
    if not any(tree.suspect):
        return
    _, _, chars, links = densities(tree)
    for i in range(1, n):
        # A form or dialog around most of the page's own words is a wrapper.
        wraps = tree.suspect[i] == WRAPPER and 2 * (chars[i] - links[i]) > chars[0] - links[0]
        tree.cut[i] = tree.cut[i] or tree.suspect[i] in (TAG, WRAPPER) and not wraps
    _pass_down(tree)
    _, _, chars, links = densities(tree)
    articles = [i for i in range(n) if tree.role_main[i] and not tree.cut[i] and chars[i]]
    if articles:
        article = max(articles, key=lambda i: (chars[i], -i))
    else:
        # A page header takes no part in the choice.
        kept = tree.cut[:]
        for i in range(1, n):
            tree.cut[i] = tree.cut[i] or tree.tag[i] == "header"
        _pass_down(tree)
        article = _best(tree, densities(tree)[1])
        tree.cut = kept
    spared, at = set(), article
    while at >= 0:
        spared.add(at)
        at = tree.parent[at]
    # Below the article, unless that is the page itself; and what holds a headline.
    below, headline = [False] * n, [False] * n
    for i in range(1, n):
        below[i] = below[tree.parent[i]] or tree.parent[i] == article and tree.tag[article] not in ("#root", "html", "body")
    for i in range(n - 1, 0, -1):
        headline[i] = headline[i] or tree.tag[i] in ("h1", "h2") and chars[i] > 0
        headline[tree.parent[i]] = headline[tree.parent[i]] or headline[i]
    for i in range(1, n):
        linked = 2 * links[i] > chars[i]
        why = tree.suspect[i]
        gone = why == NAME or why == WEAK and linked or why == TITLE and (linked or not (below[i] and headline[i]))
        tree.cut[i] = tree.cut[i] or gone and i not in spared
    _pass_down(tree)


def content_nodes(tree: _Tree) -> set[int]:
    """Roots of the content: the subtree of the highest density sum and the neighbours that reach the path's threshold."""
    density, total, chars, links = densities(tree)
    n = len(tree.tag)
    if not chars[0]:
        return set()
    best = _best(tree, total)
    path = [best]
    while tree.parent[path[-1]] >= 0:
        path.append(tree.parent[path[-1]])
    threshold = min((density[i] for i in path if tree.tag[i] not in ("#root", "html")), default=0.0)
    densest = density[:]
    for i in range(n - 1, 0, -1):
        densest[tree.parent[i]] = max(densest[tree.parent[i]], densest[i])
    found = {best}
    on_path = set(path)
    # The path's nodes from the outermost article or main element on.
    around = next((set(path[:k + 1]) for k in range(len(path) - 1, -1, -1) if tree.role_main[path[k]]), set())
    for i in range(1, n):
        up = tree.parent[i]
        if tree.cut[i] or not chars[i] or i in on_path or up not in on_path or up == best:
            continue
        least = threshold / 2 if up in around else threshold
        if density[i] >= least or densest[i] >= least and 2 * links[i] <= chars[i] or re.fullmatch(r"h[1-6]", tree.tag[i]):
            found.add(i)
    return found


def extract(html: str | None) -> str:
    """Blocks of the page's main text, joined by line feeds."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    cut_suspects(tree)
    roots = content_nodes(tree)
    n = len(tree.tag)
    inside = [False] * n
    block = [0] * n  # the nearest block element
    for i in range(n):
        p = tree.parent[i]
        inside[i] = not tree.cut[i] and (i in roots or p >= 0 and inside[p])
        block[i] = i if i == 0 or tree.tag[i] in BLOCK and tree.tag[i] not in ("td", "th") else block[p]
    out: list[str] = []
    now, parts = -1, []
    for i, t in tree.texts:
        if not inside[i]:
            continue
        if tree.tag[i] in ("td", "th"):
            t = f" {t} "
        if block[i] != now:
            out.append("".join(parts))
            now, parts = block[i], []
        parts.append(t)
    out.append("".join(parts))
    return "\n".join(x for x in (" ".join(b.split()) for b in out) if x)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return rows.mapInArrow(run, f"page_id {schema['page_id'].dataType.simpleString()}, url {schema['url'].dataType.simpleString()}, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
