"""Main text of web pages by consensus: the pages of a host vote on the path of the container that holds it."""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from candlemill.llm.common import by_batch, shipped, stored
from candlemill.llm.urlfilter import parts

shipped(__name__)

# Fixed values of the public HTML vocabulary, and words by which pages name what is no main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg math object select button canvas audio video".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3
h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption""".split())
CONTAINER = set("article body div main section td center blockquote html".split())
NEVER = set("nav footer aside form dialog menu head".split())
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table")}
ENDS = {k: (set(a.split()), set(b.split())) for k, (a, b) in ENDS.items()}
BOILERPLATE = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar rail widget nav navbar
navigation menu menubar breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay share
sharing social related recommended recommendations comment comments commentlist disqus reply replies respond newsletter subscribe subscription
login signin signup register search searchbox pagination pager toolbar skip complementary contentinfo dialog form tags byline""".split())
WEIGHT = {"article": 3, "main": 2, "body": 0.7, "html": 0.5, "": 0.4}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")
# a name that begins so tells what stands beside or inside an element, not what it is
BESIDE = re.compile(r"(?:with|without|has|have|no|not|is|show|hide|after|before|above|below|js)[-_]", re.I)
ENOUGH = 0.2  # part of a page's running text that is main text, if it is to be found at all


def names_of(attributes: str) -> tuple[set[str], str]:
    """The words in class, id and role, in lower case; and the class written for a path, digits as #."""
    words, classes = set(), ""
    for kind, *values in NAMED.findall(attributes):
        value = html.unescape("".join(values))
        words.update(w.lower() for name in value.split() if not BESIDE.match(name) for w in WORD.findall(name))
        if kind.lower() == "class":
            classes = "".join("." + c for c in sorted(re.sub(r"\d+", "#", value.lower()).split()))
    return words, classes


class Page:
    """A page's elements that aren't boilerplate, and its text in order.

    ``tags``, ``paths`` and ``parents`` are by element, 0 being the page itself; ``text`` is a list of (element, string,
    in a link). A string of one space parts two blocks.

    An element is boilerplate by its tag or by a word in its class, id or role. If what is left has little of the page's
    running text, such a name is taken to be wrong on elements that hold an article (or main) or two thirds of that text.
    """

    def __init__(self, source: str):
        self.tags, self.paths, self.parents, self.text = [""], [""], [-1], []
        self.flags = [False]  # by element, whether its own name is one of boilerplate
        stack, links, at = [(0, "")], 0, 0
        for token in TOKEN.finditer(source):
            begin, end = token.span()
            if begin < at:
                continue  # inside a raw element
            if begin > at:
                self.text.append((stack[-1][0], html.unescape(source[at:begin]), links > 0))
            at = end
            if token[2] is None:
                continue
            tag = token[2].lower()
            if tag in BLOCK or tag == "br":
                self.text.append((stack[-1][0], " ", False))
            if token[1]:
                if any(t == tag for _, t in stack):
                    while len(stack) > 1:
                        _, name = stack.pop()
                        links -= name == "a"
                        if name == tag:
                            break
                continue
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(source, end)
                at = close.end() if close else len(source)
                continue
            if tag in VOID:
                continue
            closes, until = ENDS.get(tag, ({"p"}, CONTAINER) if tag in BLOCK else (set(), set()))
            found = 0
            for depth in range(len(stack) - 1, 0, -1):
                if closes and stack[depth][1] in closes:
                    found = depth
                elif stack[depth][1] in until:
                    break
            while found and len(stack) > found:
                _, name = stack.pop()
                links -= name == "a"
            words, classes = names_of(token[3]) if "=" in token[3] else ((), "")
            inside = any(t in ("article", "main") for _, t in stack)
            drop = tag in NEVER or (tag == "header" or "header" in words) and not inside
            element = stack[-1][0]
            self.tags.append(tag)
            self.paths.append(f"{self.paths[element]}/{tag}{classes}")
            self.parents.append(element)
            self.flags.append(drop or tag not in ("html", "body", "main") and not BOILERPLATE.isdisjoint(words))
            stack.append((len(self.tags) - 1, tag))
            links += tag == "a"
        if at < len(source):
            self.text.append((stack[-1][0], html.unescape(source[at:]), links > 0))
        self.prune()

    def hidden(self) -> list[bool]:
        out = [False]
        for k in range(1, len(self.tags)):
            out.append(self.flags[k] or out[self.parents[k]])
        return out

    def prune(self) -> None:
        """Keep the text that stands in no boilerplate, and take back names that hide the main text."""
        gone = self.hidden()
        if any(self.flags):
            running = [0] * len(self.tags)
            for element, text, link in self.text:
                if not link:
                    running[element] += len(text.strip())
            seen = sum(n for n, x in zip(running, gone) if not x)
            for k in range(len(self.tags) - 1, 0, -1):
                running[self.parents[k]] += running[k]
            total, holds = running[0], [False] * len(self.tags)
            if seen < ENOUGH * total:
                for k in range(len(self.tags) - 1, 0, -1):
                    named = self.tags[k] in ("article", "main") and 4 * running[k] >= total
                    if (holds[k] or named or 3 * running[k] > 2 * total) and self.tags[k] not in ("head", "nav", "footer", "aside"):
                        self.flags[k] = False
                    holds[self.parents[k]] |= holds[k] or named
                gone = self.hidden()
        self.text = [x for x in self.text if not gone[x[0]]]

    def container(self, element: int) -> int:
        while element > 0 and self.tags[element] not in CONTAINER:
            element = self.parents[element]
        return element

    def scores(self) -> dict[str, float]:
        """How much running text the containers hold, by path: all of their own, half of their children's, no links."""
        own: dict[int, float] = {}
        for element, text, link in self.text:
            if not link and (n := len(text.strip())):
                box = self.container(element)
                own[box] = own.get(box, 0) + n
        out: dict[str, float] = {}
        for box, n in own.items():
            share = 1.0
            while share > 0.2:
                path = self.paths[box]
                out[path] = out.get(path, 0) + n * share * WEIGHT.get(self.tags[box], 1)
                if not box:
                    break
                share /= 2
                box = self.container(self.parents[box])
        return out

    def extract(self, path: str | None) -> str | None:
        """The text inside the elements of that path, white space put together; None if there is no such element.

        The empty path is the whole page.
        """
        if path not in self.paths:
            return None
        inside = [not path] * len(self.tags)
        for k in range(1, len(self.tags)):
            inside[k] = self.paths[k] == path or inside[self.parents[k]]
        return " ".join("".join(t for element, t, _ in self.text if inside[element]).split())


def best(scores: dict[str, float]) -> list[tuple[str, int]]:
    """All paths, the best one first, with their parts of 1000 of what that has."""
    first = sorted(scores.items(), key=lambda x: (-x[1], x[0]))
    return [(path, round(1000 * s / first[0][1])) for path, s in first if s > 0]


def consensus(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host's pages. Votes are pre-aggregated, so no host is a hot key."""

    def step(hosts, texts):
        votes: Counter = Counter()
        for h, t in zip(hosts, texts):
            for path, n in best(Page(t.decode("utf-8", "replace")).scores()) if t else ():
                votes[h.decode("utf-8", "replace"), path] += n
        rows = [(h, path, n) for (h, path), n in votes.items() if n]
        return [list(c) for c in zip(*rows)] or [[], [], []]

    votes = by_batch(pages, lambda: step, "host string, path string, votes long", "host", "html")
    votes = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return votes.groupBy("host").agg(F.max(F.struct("votes", "path"))["path"].alias("path"))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, path.

    Each page scores its containers; the host's pages vote on paths of tags and classes (digits as #), and every page
    gives the text of the elements with its host's winning path, or where there is none in them, with its own best path
    (``path`` is the one that was used). Menus, headers, footers, asides, forms, adverts, notices and comments are left out where
    they stand, also inside an article. A null or empty html, or one without text, gives an empty text; pages with a null
    url, or one without a host, vote together. Null ids and repeated rows stay, other columns are ignored, and an empty
    table gives no rows.
    """
    taken = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                         parts(F.col(f"`{url_col}`"))[0].alias("host"), F.col(f"`{html_col}`").alias("html"))
    # the winners are a written table, so Spark knows its size: it broadcasts a small one, and else splits busy hosts
    winners = stored(consensus(taken), "html-winners").withColumnRenamed("path", "winner")

    def step(ids, urls, paths, texts):
        used, out = [], []
        for path, data in zip(paths, texts):
            page = Page((data or b"").decode("utf-8", "replace"))
            path = None if path is None else path.decode()
            text = page.extract(path)
            if not text:
                path = next((p for p, _ in best(page.scores())), None)
                text = page.extract(path)
            used.append(path)
            out.append(text or "")
        return [ids, [None if u is None else u.decode("utf-8", "replace") for u in urls], out, [len(t) for t in out], used]

    joined = taken.join(winners, "host", "left").select("page_id", "url", "winner", "html")
    return by_batch(joined, lambda: step, "page_id long, url string, text string, n_chars long, path string", "page_id", "url", "winner", "html")
