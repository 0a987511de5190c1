"""Main text of web pages by composite text density.

Every element gets its composite density: characters per tag, damped by the
share of link characters and link tags (relative to the body's). An element's
density sum is the sum over its children. Left out first are elements that are
never main text (scripts, buttons), and those that are not by tag, role or a
whole class or id (menus, forms, adverts), unless the latter hold the bulk of
the page's text; talk never does. Then the element with the largest sum of the
whole page is looked for. If it lies in an ``article`` or ``main``, it is
widened to the whole of that. Else the least density on its path to the body is
a threshold: from the body down, every subtree that reaches it gives its element
of the largest sum, and the main text is the least element that holds all of
these, as a text may be split over siblings. In it, lists of links below the
threshold are left out, and articles beside a longer text that carry less than
half of the largest sum (teasers).

Texts of one block join without a break, white space becomes one space, blocks
join by an empty line. Defined cases: a null, empty or tag-only page has the
empty text; a page cut off anywhere is read as far as it goes, without a
half-written tag; unclosed and misnested tags are closed as browsers do;
repeated rows give repeated results; an empty table gives no rows. Work and
memory are linear in a page's length; nesting depth is no recursion.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from insight.llm.common import arrow_map

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset((
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select "
    "summary table tbody td textarea tfoot th thead title tr ul script style template").split())
#: A start tag of the first kind closes an open element of the second, up to one of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Never main text.
NO_TEXT = frozenset("head script style noscript template svg math canvas iframe object audio video button select textarea input".split())
#: No main text unless it holds the bulk of the page's text, by tag, ARIA role, or a whole class or id of such words.
NOT_TEXT = frozenset("nav footer aside form dialog menu search fieldset".split())
NOT_ROLE = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOT_WORD = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "commentarea commentbox commentform commentlist commentthread discussion discussions gdpr replies adsbygoogle "
    "footer masthead menu modal nav navbar navigation newsletter notice pagination popup promo related responses share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget").split())
#: A class or id of other words, too, that ends with one of these (``reader-comments``), unless a word of ``STATE`` is in it (``has-sidebar``).
LAST_WORD = frozenset((
    "ads advert adverts advertisement breadcrumb breadcrumbs comment comments cookies navbar newsletter pagination replies responses "
    "sidebar").split())
STATE = frozenset("has is no not with without hide show open closed".split())
#: What a class or id of several words may have besides.
PART_WORD = frozenset((
    "articles body content form respond stories thread area bar block bottom box btn button buttons center container global holder icon icons inner item items left link links list lists "
    "main outer post posts right section site slot top unit wrap wrapper x").split())
#: Left out whatever its share of the text is: talk may be longer than what it is about.
TALK = frozenset("comment commentarea commentbox commentform commentlist comments commentthread disqus responses".split())
#: Left out, too, unless an article is inside: a page of little text may have more of it there.
NO_WRAP = frozenset((
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie cookies footer nav navbar navigation "
    "newsletter promo signup sponsor sponsored subscribe").split())
#: Least share of the page's text, links not counted, that is its bulk; and for what holds an article.
BULK, BULK_ARTICLE = 2 / 3, 1 / 2
#: What may be a list of links inside the main text of a page without ``article`` or ``main``.
LISTS = frozenset("ul ol dl table div section".split())
WORDS = re.compile(r"[a-z]+")
HALF_TAG = re.compile(r"<(?:[a-zA-Z/!?][^>]*)?$")


class Page(HTMLParser):
    """Elements in page order and the text events of a page.

    Element i's subtree is the elements i to ``last[i]``. An event is (element,
    text), with None for the border of a block.
    """

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.left_out, self.last = ["#page"], [-1], [False], [0]
        self.doubtful, self.talk, self.no_wrap = [False], [False], [False]
        self.chars, self.link_chars, self.links = [0], [0], [0]
        self.events: list[tuple[int, str | None]] = []
        self.stack = [0]
        self.open: dict[str, list[int]] = defaultdict(list)  # open elements by tag, and all open blocks under ""
        self.gone: set[int] = set()  # closed, but still in the stack
        self.feed(HALF_TAG.sub("", html))
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self._end("p", {"button", "table", "td", "th"})
        if tag in CLOSES:
            closed, inside = CLOSES[tag]
            for t in closed:
                self._end(t, inside)
        up = self.stack[-1]
        i = len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        names = [self._words(token) for key, value in attrs if key in ("class", "id") for token in (value or "").lower().split()
                 if (key, token, tag) != ("id", "discussion", "section")]  # a part of many papers
        self.left_out.append(self.left_out[up] or self._never(tag, attrs, names))
        self.doubtful.append(self._boilerplate(tag, attrs, names))
        self.talk.append(any(self._named(w) and TALK.intersection(w) for w in names))
        self.no_wrap.append(tag in ("nav", "footer") or any(self._named(w) and NO_WRAP.intersection(w) for w in names))
        self.last.append(i)
        self.chars.append(0)
        self.link_chars.append(0)
        self.links.append(1 if tag == "a" else 0)
        if tag in BLOCK:
            self.events.append((i, None))
        elif tag == "br":
            self.events.append((i, " "))
        if tag not in VOID:
            self.stack.append(i)
            self.open[tag].append(i)
            if tag in BLOCK:
                self.open[""].append(i)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    @staticmethod
    def _words(token: str) -> list[str]:
        return WORDS.findall(token)

    @staticmethod
    def _named(words: list[str]) -> bool:
        """Whether the words of one class or id name what is no main text."""
        if not NOT_WORD.intersection(words):
            return False
        return NOT_WORD.union(PART_WORD).issuperset(words) or words[-1] in LAST_WORD and not STATE.intersection(words)

    @staticmethod
    def _never(tag: str, attrs: list, names: list[list[str]]) -> bool:
        if tag in ("html", "body", "article", "main"):
            return tag == "article" and any("comment" in w for w in names)
        return tag in NO_TEXT or any(key == "hidden" for key, _ in attrs)

    def _boilerplate(self, tag: str, attrs: list, names: list[list[str]]) -> bool:
        if tag in ("html", "body", "article", "main"):
            return False
        if tag in NOT_TEXT or tag == "header" and not self.open["article"] and not self.open["main"]:
            return True
        return (any(key == "role" and (value or "").lower() in NOT_ROLE for key, value in attrs)
                or any(self._named(w) for w in names))

    def _leave_out(self) -> None:
        """Doubtful elements without the bulk of the text, and all that is in them."""
        n = len(self.tag)
        text = [0 if out else c - lc for c, lc, out in zip(self.chars, self.link_chars, self.left_out)]
        article, main = ([t == name and not out for t, out in zip(self.tag, self.left_out)] for name in ("article", "main"))
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            text[up] += text[i]
            article[up] = article[up] or article[i]
            main[up] = main[up] or main[i]
        for i in range(1, n):
            bulk = text[i] and (main[i] or text[i] >= (BULK_ARTICLE if article[i] else BULK) * text[0]
                                and (article[i] or not self.no_wrap[i]))
            if self.left_out[self.parent[i]] or self.doubtful[i] and (self.talk[i] or not bulk):
                self.left_out[i] = True

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._end(tag, {"table"} if tag in ("td", "th", "tr", "li", "p") else set())

    def _end(self, tag: str, inside: set[str]) -> None:
        """Close the nearest open ``tag``, and what is open in it, unless an element of ``inside`` is nearer."""
        if not self.open[tag]:
            return
        closed = self.open[tag][-1]
        if any(self.open[t] and self.open[t][-1] > closed for t in inside):
            return
        if tag not in BLOCK and self.open[""] and self.open[""][-1] > closed:
            self.open[tag].pop()  # a text mark that crosses a block ends alone
            self.gone.add(closed)
            return
        s = -1
        while s != closed:
            s = self.stack.pop()
            if s in self.gone:
                self.gone.discard(s)
                continue
            self.last[s] = len(self.tag) - 1
            self.open[self.tag[s]].pop()
            if self.tag[s] in BLOCK:
                self.open[""].pop()
                self.events.append((s, None))
        while self.stack[-1] in self.gone:
            self.gone.discard(self.stack.pop())

    def close(self) -> None:
        super().close()
        for s in self.stack:
            if s not in self.gone:
                self.last[s] = len(self.tag) - 1
        self._leave_out()

    def handle_data(self, data: str) -> None:
        i = self.stack[-1]
        self.events.append((i, data))
        if not self.left_out[i]:
            n = len("".join(data.split()))
            self.chars[i] += n
            if self.open["a"]:
                self.link_chars[i] += n


def densities(page: Page) -> tuple[list[float], list[float], list[bool]]:
    """Composite density, density sum, and whether links hold most of the text, left-out elements not counted."""
    n = len(page.tag)
    chars, link_chars = page.chars[:], page.link_chars[:]
    tags, links = [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        if not page.left_out[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            links[up] += links[i] + page.links[i]
    link_share = link_chars[0] / max(1, chars[0])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if chars[i] and not page.left_out[i]:
            c, lc, t, lt = chars[i], max(1, link_chars[i]), max(1, tags[i]), max(1, links[i])
            base = math.log(c / max(1, c - link_chars[i]) * link_chars[i] + link_share * c + math.e)
            density[i] = c / t * max(0.0, math.log(c / lc * t / lt)) / max(1.0, math.log(base) + 1.0)
            if i:
                total[page.parent[i]] += density[i]
    return density, total, [2 * lc > c for lc, c in zip(link_chars, chars)]


def main_element(page: Page, density: list[float], total: list[float]) -> tuple[int, float, set[int]]:
    """The element that holds the main text, the density that link lists in it must have, and the teasers in it."""
    n = len(page.tag)
    named = [page.tag[i] in ("article", "main") and not page.left_out[i] for i in range(n)]
    inside, holds, from_named, heaviest = named[:], [False] * n, [0.0] * n, [0] * n
    for i in range(1, n):
        inside[i] = named[i] or inside[page.parent[i]]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        holds[up] = holds[up] or holds[i] or named[i]
        if holds[i] or named[i]:
            from_named[up] += density[i]
            if not heaviest[up] or density[i] >= density[heaviest[up]]:
                heaviest[up] = i
    worth = [t or d / 2 for t, d in zip(total, density)]
    best = max(range(n), key=lambda i: (worth[i], -i))
    while not inside[best] and heaviest[best] and 2 * density[heaviest[best]] > total[best]:  # most of the sum is one article's, or that of an element around it
        best = heaviest[best]
    if inside[best]:
        holder = best
        while not named[holder]:
            holder = page.parent[holder]
        outer = page.parent[holder]
        while outer > 0:  # an article within an article is part of it; main gives way to its one article
            if page.tag[outer] == "article":
                holder = outer
            outer = page.parent[outer]
        return holder, 0.0, set()
    path, up = [], page.parent[best]
    while up > 0:
        path.append(density[up])
        up = page.parent[up]
    least = min(path, default=0.0)
    of_named = [inside[i] or 2 * from_named[i] > total[i] for i in range(n)]
    found = [best, *(i for i in (parts(page, density, total, least) if path else [])
                     if not of_named[i] or 2 * worth[i] >= worth[best])]
    kept = [0] * (n + 1)  # how many elements before i are in a part
    for i in found:
        if page.tag[i] not in ("#page", "html", "body") or of_named[i]:
            kept[i + 1:page.last[i] + 2] = [1] * (page.last[i] + 1 - i)
    kept = list(accumulate(kept))
    chars = [0 if out else c for c, out in zip(page.chars, page.left_out)]
    other = sum(c for c, within in zip(chars, inside) if not within)
    before = [0, *accumulate(chars)]
    teasers = {i for i in range(n) if named[i] and kept[page.last[i] + 1] == kept[i] and 2 * density[i] < worth[best]
               and before[page.last[i] + 1] - before[i] < other}
    return holding(page, found), least, teasers


def parts(page: Page, density: list[float], total: list[float], least: float) -> list[int]:
    """From the top down, the element of the largest sum of every subtree whose density reaches ``least``."""
    n = len(page.tag)
    worth = [t or d / 2 for t, d in zip(total, density)]
    top = list(range(n))  # of each subtree the element worth most, the first of equals
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        if not page.left_out[i] and (worth[top[i]], -top[i]) > (worth[top[up]], -top[up]):
            top[up] = top[i]
    found, taken, reached = [], [False] * n, [True] * n
    for i in range(1, n):
        up = page.parent[i]
        taken[i] = taken[i] or taken[up]
        reached[i] = reached[up] and density[i] >= least > 0 and not page.left_out[i]
        if reached[i] and not taken[i] and not taken[top[i]]:
            taken[top[i]] = True
            found.append(top[i])
    return found


def holding(page: Page, elements: list[int]) -> int:
    """The least element that holds all of these (element i's subtree is i to ``last[i]``)."""
    first, end = min(elements), max(page.last[i] for i in elements)
    at = first
    while page.last[at] < end:
        at = page.parent[at]
    return at


def main_text(html: str | None) -> str:
    """The blocks of a page's main text, joined by an empty line."""
    if not html:
        return ""
    page = Page(html)
    density, total, mostly_links = densities(page)
    top, least, teasers = main_element(page, density, total)
    thin = [False] * len(page.tag)
    for i in range(top + 1, page.last[top] + 1):
        thin[i] = thin[page.parent[i]] or i in teasers or mostly_links[i] and page.tag[i] in LISTS and density[i] < least
    blocks, words = [], []
    for i, text in page.events:
        if i < top or i > page.last[top] or page.left_out[i] or thin[i]:
            text = None if text is None else ""
        if text is None:
            if line := " ".join("".join(words).split()):
                blocks.append(line)
            words = []
        else:
            words.append(text)
    if line := " ".join("".join(words).split()):
        blocks.append(line)
    return "\n\n".join(blocks)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    kinds = dict(pages.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        return {"page_id": batch.column(0), "url": batch.column(1),
                "text": pa.array([main_text(h) for h in batch.column(2).to_pylist()], pa.string())}

    return arrow_map(pages.select("page_id", "url", html_col), run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
