"""The main text of web pages, by scoring their element trees."""

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements without content of their own, and elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
# Elements that are part of a line; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter"
    " nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
    " script style noscript template link meta button input select textarea svg canvas audio video"
    " object iframe picture source".split()
)
# A paragraph hands its points to the elements around it; other blocks count as containers.
PARAGRAPHS = frozenset("p pre blockquote li dt dd td th caption figcaption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Which open elements a start tag ends, and where the search for them stops.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
SCOPES = frozenset("table td th caption button object html body".split())

DROPPED = frozenset(
    "head nav footer aside button select option textarea input script style noscript template"
    " iframe object embed svg math canvas audio video map dialog menu title fieldset".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar"
    " toolbar".split()
)
# Words of class and id that name what is no part of an article.
ASIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adunit sponsor sponsored"
    " promo promos promotion promoted outbrain taboola"
    " nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager topbar toolbar"
    " masthead footer copyright colophon sidebar sidebars rail widget widgets related recommended"
    " recommendations trending popular cookie cookies consent gdpr notice notices notification"
    " alert popup modal overlay subscribe subscription newsletter signup login register paywall"
    " share sharing social follow"
    " comment comments commentlist disqus replies respond discussion reactions".split()
)
# Those of them that name what others have added, or what covers the page: never its article.
FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adunit sponsor sponsored"
    " promo promos promotion promoted outbrain taboola cookie cookies consent gdpr notice notices"
    " notification alert popup modal overlay comment comments commentlist disqus replies respond"
    " discussion reactions".split()
)
ARTICLE = frozenset("article post entry story content main".split())
TRUNKS = frozenset("html body main article".split())
#: Characters of unlinked text that a suspect element without article has if it is not dropped.
LEAST_TEXT = 200
#: Characters of unlinked text outside an element that count as none.
NOTHING = 25

#: Elements nested deeper become siblings, as in browsers.
DEEPEST = 512

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"(?<![^\s\"'/])(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s\"'/]|\Z)",
    re.IGNORECASE,
)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Tree:
    """Elements in page order, each after its parent, and the runs of text between tags."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.dropped = ["html"], [-1], [False]
        self.suspect: dict[int, bool] = {}  # by form, class or id; True if others hint at text
        self.foreign: set[int] = set()  # named as comments, notices or adverts
        self.runs: list[tuple[int, str | None]] = []  # element and text; None ends a block
        self._open = [0]
        at, size = 0, len(html)
        for found in iter(lambda: TOKEN.search(html, at), None):
            if found.start() > at:
                self._text(html[at : found.start()])
            at = found.end()
            name = found["tag"]
            if name is None:
                continue
            name = name.lower()
            if found["close"]:
                self._end(name)
                continue
            self._start(name, found["attributes"])
            if name in RAW:
                closing = re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE).search(html, at)
                at = closing.end() if closing else size
                self._end(name)
        if at < size:
            self._text(html[at:])

    def _text(self, text: str) -> None:
        self.runs.append((self._open[-1], unescape(text) if "&" in text else text))

    def _break(self, name: str) -> None:
        if name not in INLINE:
            self.runs.append((self._open[-1], None))
        elif name == "br":
            self.runs.append((self._open[-1], " "))

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and len(self.tag) > 1 and name in self.tag[:3]:
            return
        if name in ENDS_PARAGRAPH:
            self._leave(frozenset(["p"]), SCOPES)
        if name in ENDS:
            self._leave(*ENDS[name])
        self._break(name)
        parent = self._open[-1]
        self.tag.append(name)
        self.parent.append(parent)
        self.dropped.append(self.dropped[parent])
        if not self.dropped[-1]:
            self.dropped[-1] = self._aside(name, attributes)
        if name not in VOID and len(self._open) < DEEPEST:
            self._open.append(len(self.tag) - 1)

    def _leave(self, names: frozenset, stops: frozenset) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.tag[self._open[depth]]
            if name in names:
                del self._open[depth:]
                self.runs.append((self._open[-1], None))
                return
            if name in stops:
                return

    def _end(self, name: str) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[depth]] == name:
                del self._open[depth:]
                break
        self._break(name)

    def _aside(self, name: str, attributes: str) -> bool:
        """Whether an element is no part of any article, by its name or role; notes suspects."""
        if name in DROPPED:
            return True
        if name == "form":
            self.suspect[len(self.tag) - 1] = True
        if name == "header" and not any(self.tag[n] in ("article", "main") for n in self._open):
            return True
        if "=" not in attributes and "hidden" not in attributes:
            return False
        words: set[str] = set()
        for key, *values in ATTRIBUTE.findall(attributes):
            value = "".join(values)
            if key.lower() == "hidden":
                return True
            if key.lower() == "role":
                if value.lower() in ROLES:
                    return True
            else:
                words.update(word.lower() for word in WORD.findall(value))
        own = len(self.tag) - 1
        if words & FOREIGN and not words & ARTICLE:
            self.foreign.add(own)
        if name in TRUNKS:
            return False
        if words & ASIDE or ("header" in words and not words & ARTICLE):
            self.suspect[own] = name == "form" or bool(words & ARTICLE)
        return False

    def settle(self, link: list[bool]) -> None:
        """Drop suspect elements, unless they wrap the page's text.

        On a page with text in article and main elements that is so if more than half of it is theirs.
        On others it takes four fifths of all unlinked text, for forms and with a word for articles
        half of it. Comments, notices and adverts that no article lies in are the page's text only if
        there is nothing else.
        """
        if not self.suspect:
            return
        count = len(self.tag)
        # Sites put each comment into an article element of its own: those are none.
        whole = [tag in ("article", "main") and n not in self.foreign for n, tag in enumerate(self.tag)]
        trunk, holds = whole[:], whole[:]
        for n in range(1, count):
            trunk[n] = trunk[n] or trunk[self.parent[n]]
        plain, within = [0] * count, [0] * count
        for n, text in self.runs:
            if text and not self.dropped[n] and not link[n]:
                size = len(text) - sum(map(text.count, " \n\t\r"))
                plain[n] += size
                within[n] += size * trunk[n]
        for n in range(count - 1, 0, -1):
            plain[self.parent[n]] += plain[n]
            within[self.parent[n]] += within[n]
            holds[self.parent[n]] = holds[self.parent[n]] or holds[n]
        for n in range(1, count):
            if n in self.suspect and not self.dropped[n]:
                if n in self.foreign and not holds[n]:
                    wraps = plain[0] - plain[n] < NOTHING
                elif within[0]:
                    wraps = 2 * within[n] > within[0]
                else:
                    wraps = plain[n] > (0.5 if self.suspect[n] else 0.8) * plain[0]
                small = plain[n] < LEAST_TEXT and not (within[n] and 2 * plain[n] > plain[0])
                self.dropped[n] = small or not wraps
            self.dropped[n] = self.dropped[n] or self.dropped[self.parent[n]]


def extract(html: str) -> str:
    """The main text of one page: its blocks in order, one a line.

    Blocks of text give points for their length and commas: all to the container around, half to
    the next, and less to those further out. A container's points count by the share of its text
    that is not in links. The best one is kept, with siblings that look like it; if it lies in an
    article or main element, all of that is kept. Lists of links in it are menus and go.
    """
    tree = Tree(html)
    count = len(tree.tag)
    tag, parent, dropped = tree.tag, tree.parent, tree.dropped
    link = [False] * count
    for n in range(1, count):
        link[n] = tag[n] == "a" or link[parent[n]]
    tree.settle(link)
    points, length, linked, links = [0.0] * count, [0] * count, [0] * count, [0] * count

    def give(block: int, text: str) -> None:
        text = " ".join(text.split())
        if not text or tag[block] in HEADINGS:
            return
        own = 1 + text.count(",") + min(len(text) / 100, 3)
        at, level = parent[block] if tag[block] in PARAGRAPHS else block, 0
        while at >= 0:
            points[at] += own / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = parent[at], level + 1

    block, parts = 0, []
    for n, text in [*tree.runs, (0, None)]:
        if text is None:
            if parts:
                give(block, "".join(parts))
            parts = []
        elif not dropped[n]:
            if not parts:
                block = n
                while tag[block] in INLINE and parent[block] >= 0:
                    block = parent[block]
            parts.append(text)
            size = len(text) - text.count(" ")
            length[n] += size
            linked[n] += size * link[n]
    for n in range(count - 1, 0, -1):
        up = parent[n]
        length[up] += length[n]
        linked[up] += linked[n]
        links[up] += links[n] + (tag[n] == "a" and not dropped[n])

    def density(n: int) -> float:
        return linked[n] / length[n] if length[n] else 0.0

    score = [p * (1 - density(n)) for n, p in enumerate(points)]
    if not any(length):
        return ""
    best = max(range(count), key=lambda n: (score[n], -n))
    kept = {best}
    around, trunk = best, None
    while around >= 0:
        if tag[around] in ("article", "main"):
            trunk = around
            if tag[around] == "article":
                break
        around = parent[around]
    if trunk is not None:
        kept = {trunk}
    elif best:
        for n in range(1, count):
            if parent[n] != parent[best] or dropped[n] or n == best:
                continue
            good = score[n] >= max(10, 0.2 * score[best])
            if tag[n] == "p":
                good = good or density(n) < 0.25
            kept |= {n} if good or (tag[n] in HEADINGS and n < best) else set()
    inside = [False] * count
    for n in range(count):
        menu = tag[n] in ("ul", "ol", "dl") and links[n] >= 3 and density(n) > 0.8
        inside[n] = (n in kept or (n > 0 and inside[parent[n]])) and not dropped[n] and not menu
    blocks, parts = [], []
    for n, text in [*tree.runs, (0, None)]:
        if text is None:
            line = " ".join("".join(parts).split())
            if line:
                blocks.append(line)
            parts = []
        elif inside[n]:
            parts.append(text)
    return "\n".join(blocks)


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """`page_id, url, text, n_chars` of every page; see extract().

    A null page is empty and has the empty text, as has a page without any text outside menus,
    adverts and the like. Ids and addresses may be null or repeat; other columns are ignored; no
    pages give no rows. Pages of any length are read whole, markup need not be well-formed.
    """
    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html or "") for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return chosen.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
