"""Main text of web pages by consensus host paths.

Pass 1 parses each page leniently, scores its containers (paragraph text pays
into the container and half into the one around it, links cost, telling tags
and classes weigh in) and names the best one by its generalised path: the tags
from the root with their class names, digits folded.  The votes, score by host
and path, are summed in Spark and each host's path with the highest sum wins.
Pass 2 extracts every page again from the containers on its host's winning
path; a page that has none, or whose url has no host, uses its own best one.

Inside a container, menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out.  What is one is told by tag and role,
or by the names (class and id) of a container such as div, section or ul; names of
headings, paragraphs and inline elements tell nothing, as ids there are slugs
of the text.  A name tells if it is one of the words below or a compound that ends in
one (site-footer, cookie-notice, with generic endings such as -list or -wrap taken
off); a word elsewhere in a compound (comments-on-law) only does for a container most of whose
text is in links.  Header and footer elements, or so named, within an article or main are part of
it, and so is an aside there that no name tells and that is not mostly links.  Labels
and buttons are left out within forms.  An id that is the slug of the container's
first heading tells nothing either, but for reader comments.
A form, or an element that only its names tell, is kept all the same if
it holds a main element, the page's only article, its only h1 while no main or
article stands elsewhere, or, again without a main or article elsewhere, more
than half of the page's text outside links: it wraps the page.  Names such as
has-sidebar or content-sidebar-wrap describe a layout and tell nothing.
Character references are decoded, white space inside a block (a line break
included) becomes one space, empty blocks go, and blocks are joined in page
order by one newline.  Nothing is cut or capped.

Votes are summed inside each task before they are shuffled, so a host that
holds a third of the pages is a few rows per task.  Winners are broadcast where
their measured size is within ``broadcast_bytes``; beyond that pages and
winners meet in a join salted by page.

Edge cases: null or empty html gives an empty text; markup that never closes is
closed by the end of the page; ties between paths go to the alphabetically
first; repeated rows are extracted one by one; other columns are not used.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import stored, table

SALTS = 16
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")}
# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
 figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table
 tbody td tfoot th thead tr ul""".split())
CONTAINER = frozenset("article blockquote body center div main section table tbody td tr".split())
PARAGRAPH = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
DROPPED = frozenset("""audio canvas datalist dialog head iframe input menu nav noscript object script search select style svg
 template textarea title video""".split())
OF_THE_PAGE = frozenset("aside footer header".split())  # left out, but within an article or main
OF_A_FORM = frozenset("button label".split())
NAMED = frozenset("""address article aside center details div dl fieldset figure footer header hgroup ol section table tbody
 ul""".split())  # whose names tell
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
# An opening tag ends the open elements of its group, up to the nearest one in the second set.
_GROUPS = (({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}), ({"tr", "td", "th"}, {"table"}), ({"td", "th"}, {"tr", "table"}),
           ({"option"}, {"select"}))
_ENDS = {"li": 0, "dt": 1, "dd": 1, "tr": 2, "td": 3, "th": 3, "option": 4}
_OUTER: tuple = (None,) * len(_GROUPS)
_WORDS = frozenset("""ad ads advert adverts advertisement advertisements sponsor sponsored promo promos promoted banner nav
 navbar navigation menu sidebar footer header masthead comment comments disqus cookie cookies consent gdpr notice popup modal
 overlay newsletter subscribe subscription signup login share sharing social related recommended breadcrumb breadcrumbs widget
 pagination pager toolbar hidden noprint""".split())
_COMMENTS = re.compile(r"(?:^|\s)(?:comments?|disqus)(?:[_-](?:area|body|list|section|thread|wrap|wrapper))?(?=$|\s)", re.I)
# Endings that say nothing of what a container holds.
_GENERIC = frozenset("""area bar block bottom box btn button buttons container content group holder inner item items large left
 links list main module outer panel right section small top wrap wrapper""".split())
# A name with one of these parts, or that starts with one of the second set, describes the page or a post.
_LAYOUT, _LABELS = frozenset("has with no without".split()), frozenset("category elementor format page post tag tags type".split())
_ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?=$|[\s_-])", re.I)


class Node:
    """An element: its tag, class names, children (nodes and strings), parent, and of
    those that enclose it or itself the nearest block and container, and for each of
    _GROUPS the outermost element that an opening tag would end."""
    __slots__ = ("tag", "names", "kids", "up", "left_out", "block", "box", "open", "inside")

    def __init__(self, tag: str, names: str, up: Node | None, left_out: bool, inside: int = 0):
        self.tag, self.names, self.up, self.left_out, self.inside = tag, names, up, left_out, inside
        self.kids: list = []
        self.block = self if up is None or tag in BLOCK else up.block
        self.box = self if tag in CONTAINER else up.box if up is not None else None
        self.open = up.open if up is not None else _OUTER
        if tag in _LISTED:
            self.open = tuple(None if tag in limit else self if was is None and tag in ended else was
                              for was, (ended, limit) in zip(self.open, _GROUPS))


_LISTED = frozenset(t for group in _GROUPS for tags in group for t in tags)
_INNER = _WORDS - {"footer", "header", "masthead"}  # an article may have a header and footer of its own
IN_ARTICLE, IN_FORM = 1, 2  # what encloses an element
TOLD, HINTED = 2, 1


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _unwanted(given: dict[str, str]) -> bool:
    """Whether attributes mark an element as boilerplate or hidden beyond doubt."""
    return (given.get("role", "").lower() in DROPPED_ROLES or "hidden" in given
            or "display:none" in given.get("style", "").replace(" ", "").lower())


def _boilerplate(names: str, words: frozenset[str] = _WORDS) -> int:
    """What a class or id says of a container: boilerplate (TOLD), perhaps (HINTED) or nothing (0)."""
    out = 0
    for name in names.lower().split():
        parts = [p for p in re.split("[_-]+", name) if p]
        if words.isdisjoint(parts):
            continue
        label = parts[0] in _LABELS and not (parts[0] in ("page", "post") and len(parts) == 2)  # post-header is none
        if len(parts) > 1 and (label or _LAYOUT.intersection(parts) or {"content", "sidebar"}.issubset(parts)):
            continue
        while len(parts) > 1 and (parts[-1] in _GENERIC or parts[-1].isdigit()):
            parts.pop()
        out = max(out, TOLD if parts[-1] in words else HINTED)
    return out


def _slug(text: str) -> str:
    return "".join(c for c in text.lower() if c.isalnum())


def _first_heading(node: Node) -> str:
    """Text of the heading that a container begins with, empty if it begins otherwise."""
    here = next((k for k in node.kids if not isinstance(k, str) or k.strip()), None)
    if here is None or isinstance(here, str) or here.tag not in HEADING:
        return ""
    out, stack = [], list(reversed(here.kids))
    while stack:
        k = stack.pop()
        if isinstance(k, str):
            out.append(k)
        else:
            stack.extend(reversed(k.kids))
    return html.unescape("".join(out))


def _settle(root: Node, doubted: dict[int, tuple[Node, int, str]]) -> None:
    """Leave out the doubted elements (by what their names say, with their id), but
    those that wrap the page."""
    seen = [0, 0, 0, 0, 0]  # characters outside links, main, article and h1 elements, characters in links so far
    inside: dict[int, list[int]] = {}
    marks = {"main": 1, "article": 2, "h1": 3}
    stack: list = [(root, iter(root.kids), False)]
    while stack:
        here, kids, in_link = stack[-1]
        kid = next(kids, None)
        if kid is None:
            stack.pop()
            if id(here) in doubted:
                inside[id(here)] = [b - a for a, b in zip(inside[id(here)], seen)]
        elif isinstance(kid, str):
            seen[4 if in_link else 0] += len(kid.strip())
        elif not kid.left_out:
            if id(kid) in doubted:
                inside[id(kid)] = list(seen)
            if kid.tag in marks:
                seen[marks[kid.tag]] += 1
            stack.append((kid, iter(kid.kids), in_link or kid.tag == "a"))
    text, mains, articles, heads, _ = seen
    for node, said, own in doubted.values():
        if id(node) in inside:
            size, main, article, head, linked = inside[id(node)]
            if said == HINTED and linked <= size:
                continue
            if own and _slug(own) == _slug(_first_heading(node)) and not _boilerplate(node.names) and not _COMMENTS.search(own):
                continue
            alone = main == mains and article == articles  # no main or article elsewhere
            node.left_out = not (main or article == articles == 1 and alone or head == heads == 1 and alone
                                 or 2 * size > text and alone)


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Position of the ">" that ends the tag whose attributes begin at ``at``, -1 if
    there is none; ``last`` has the last place of each quote in the page."""
    while True:
        m = _EDGE.search(page, at)
        if not m:
            return -1
        if m[0] == ">":
            return m.start()
        if last[m[0]] <= m.start():  # a quote that nothing closes
            return page.find(">", m.end())
        at = page.find(m[0], m.end()) + 1


def parse(page: str) -> Node:
    """Element tree of a page, whatever state its markup is in; time in proportion to its length."""
    root = top = Node("#", "", None, False)
    doubted: dict[int, tuple[Node, int, str]] = {}
    count: dict[str, int] = {}  # open elements by tag
    last = {c: page.rfind(c) for c in ">\"'"}
    at = done = 0

    def close(node: Node) -> None:
        """End the open elements up to and with ``node``."""
        nonlocal top
        while True:
            count[top.tag] -= 1
            was, top = top, top.up
            if was is node:
                return

    while True:
        begin = page.find("<", at)
        if begin < 0 or begin > last[">"] and not page.startswith("<!--", begin):
            if done < len(page):
                top.kids.append(page[done:])
            if doubted:
                _settle(root, doubted)
            return root
        closing = page.startswith("/", begin + 1)
        name = _NAME.match(page, begin + 1 + closing)
        if not name and page[begin + 1:begin + 2] not in ("!", "?"):
            at = begin + 1  # a character like any other
            continue
        if begin > done:
            top.kids.append(page[done:begin])
        if not name:
            comment = page.startswith("<!--", begin)
            end = page.find("-->", begin + 4) if comment else page.find(">", begin)
            at = done = len(page) if end < 0 else end + (3 if comment else 1)
            continue
        end = _tag_end(page, name.end(), last)
        if end < 0:
            end = len(page)
        at = done = min(end + 1, len(page))
        tag, rest = name[0].lower(), page[name.end():end]
        if closing:
            if count.get(tag):
                node = top
                while node.tag != tag:
                    node = node.up
                close(node)
            continue
        if tag in BLOCK and top.block.tag == "p":
            close(top.block)
        if tag in _ENDS and top.open[_ENDS[tag]] is not None:
            close(top.open[_ENDS[tag]])
        names, own, said = "", "", TOLD if tag == "form" else 0
        left_out = (tag in DROPPED or tag in OF_THE_PAGE and not top.inside & IN_ARTICLE
                    or tag in OF_A_FORM and bool(top.inside & IN_FORM))
        if tag == "aside" and not left_out:
            said = HINTED
        if rest and rest != "/":
            given = _attributes(rest)
            names = given.get("class", "")
            if tag not in ("html", "body"):
                left_out = left_out or _unwanted(given)
                if tag in NAMED:
                    words = _INNER if top.inside & IN_ARTICLE else _WORDS
                    told, own = _boilerplate(names, words), given.get("id", "")
                    by_id = _boilerplate(own, words)
                    own = own if by_id > told else ""
                    said = max(said, told, by_id)
                    left_out = left_out or any(_COMMENTS.search(x) for x in (names, given.get("id", "")))
        inside = top.inside | IN_ARTICLE * (tag in ("article", "main")) | IN_FORM * (tag == "form")
        node = Node(tag, names, top, left_out, inside)
        top.kids.append(node)
        if said and not left_out:
            doubted[id(node)] = (node, said, own)
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            at = done = end.end() if end else len(page)
        elif tag not in VOID and not rest.endswith("/"):
            top = node
            count[tag] = count.get(tag, 0) + 1


def step(node: Node) -> str:
    """A node's part of a path: its tag with sorted class names, runs of digits as #."""
    return ".".join([node.tag, *sorted(set(re.sub(r"\d+", "#", node.names).lower().replace(">", "").split()))])


def path(node: Node) -> str:
    """Generalised path from the root."""
    out = []
    while node.up is not None:
        out.append(step(node))
        node = node.up
    return ">".join(reversed(out))


def blocks(node: Node) -> list[str]:
    """Text of the blocks below a node, boilerplate left out."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [(node, iter(node.kids))]
    while stack:
        here, kids = stack[-1]
        kid = next(kids, None)
        if kid is None:
            stack.pop()
            if here.tag in BLOCK:
                flush()
        elif isinstance(kid, str):
            run.append(kid)
        elif kid.tag == "br":
            run.append(" ")
        elif not kid.left_out:
            if kid.tag in BLOCK:
                flush()
            stack.append((kid, iter(kid.kids)))
    flush()
    return out


def best_container(root: Node) -> tuple[Node | None, float]:
    """The container with the highest score, the first one of equals."""
    score: dict[int, float] = {}
    linked: dict[int, int] = {}
    length: dict[int, int] = {}
    nodes: dict[int, Node] = {}

    def outer(node: Node) -> Node | None:
        return node.up.box if node.up is not None else None

    def pay(node: Node | None, size: int, link: int, marks: int) -> None:
        """``size`` characters of a paragraph, ``link`` of them in links."""
        if node is None:
            return
        part = (1 + min((size - link) / 100, 3) + min(marks, 3)) if size - link >= 20 else 0.0
        k = id(node)
        nodes.setdefault(k, node)
        length[k] = length.get(k, 0) + size
        linked[k] = linked.get(k, 0) + link
        if part:
            score[k] = score.get(k, 0.0) + part
            around = outer(node)
            if around is not None:
                nodes.setdefault(id(around), around)
                score[id(around)] = score.get(id(around), 0.0) + part / 2

    size = link = marks = 0
    stack: list = [(root, iter(root.kids), False)]
    while stack:
        here, kids, in_link = stack[-1]
        kid = next(kids, None)
        closed = kid is None
        if closed:
            stack.pop()
            edge = here.tag in BLOCK
        else:
            edge = not isinstance(kid, str) and kid.tag in BLOCK and not kid.left_out
        if edge and size:
            pay((here if here.tag not in PARAGRAPH or here.tag in ("blockquote", "td") else here.up).box, size, link, marks)
            size = link = marks = 0
        if closed:
            if here.box is here:  # what is inside counts for the container around as well
                k, around = id(here), outer(here)
                if around is not None and length.get(k):
                    length[id(around)] = length.get(id(around), 0) + length[k]
                    linked[id(around)] = linked.get(id(around), 0) + linked[k]
            continue
        if isinstance(kid, str):
            n = len(kid.strip())
            size += n
            link += n if in_link else 0
            marks += kid.count(",")
        elif not kid.left_out:
            stack.append((kid, iter(kid.kids), in_link or kid.tag == "a"))
    if size:
        pay(root.box, size, link, marks)
    best, most = None, 0.0
    for k, s in score.items():
        node = nodes[k]
        s *= 1 - linked[k] / max(1, length[k])
        if node.tag in ("article", "main"):
            s *= 2
        elif _ARTICLE.search(node.names):
            s *= 1.5
        if s > most:
            best, most = node, s
    return best, most


def vote(page: str) -> tuple[str, float] | None:
    """Path and score of the page's best container."""
    node, score = best_container(parse(page))
    return None if node is None else (path(node), score)


def main_text(page: str, winner: str | None) -> str:
    """Text of the containers on the winning path, else of the page's own best
    container, else of the whole page."""
    root = parse(page)
    if winner:
        steps = winner.split(">")
        found, stack = [], [(root, 0)]
        while stack:  # only along the path
            node, depth = stack.pop()
            if depth == len(steps):
                found.append(node)
                continue
            stack.extend((k, depth + 1) for k in reversed(node.kids)
                         if not isinstance(k, str) and not k.left_out and steps[depth].startswith(k.tag) and step(k) == steps[depth])
        text = "\n".join(b for n in found for b in blocks(n))
        if text:
            return text
    own, _ = best_container(root)
    return "\n".join(blocks(own if own is not None else root))


def _host(url_col: str) -> Column:
    """Lower-case host of a url, empty if it has none."""
    return F.coalesce(F.lower(F.try_parse_url(F.col(url_col).cast("string"), F.lit("HOST"))), F.lit(""))


def winners(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the container path that won each host's vote."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(votes: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()),
                                               pa.array(list(votes.values()), pa.float64())], names=["host", "path", "score"])
        votes: dict[tuple[str, str], float] = {}
        for batch in batches:
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = vote(page) if h and page else None
                if got:
                    votes[h, got[0]] = votes.get((h, got[0]), 0.0) + got[1]
            if len(votes) > 20_000:
                yield packed(votes)
                votes = {}
        if votes:
            yield packed(votes)

    cast = pages.select(_host(url_col).alias("h"), F.col(html_col).cast("string").alias("p"))
    sums = cast.mapInArrow(run, "host string, path string, score double").groupBy("host", "path").agg(
        F.round(F.sum("score"), 6).alias("score"))  # rounded: the order of summing must not decide
    lead = F.min(F.struct((-F.col("score")).alias("s"), F.col("path").alias("path")))
    return sums.groupBy("host").agg(lead.alias("w")).select("host", "w.path")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row per page: id, url, text, n_chars, host and the path that was
    voted for."""
    won = stored(winners(pages, url_col, html_col), "host-paths")
    size = won.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 32).alias("n")).first()["n"] or 0
    d = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(html_col), F.lit("")).alias("html"), _host(url_col).alias("host"))
    if size <= broadcast_bytes:
        d = d.join(F.broadcast(won), "host", "left")
    else:
        salted = won.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        d = d.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(
            salted, ["host", "salt"], "left").drop("salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, w) for p, w in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64()), batch.column(3), batch.column(4)],
                                             names=["page_id", "url", "text", "n_chars", "host", "path"])

    kind = pages.schema[id_col].dataType.simpleString()
    return d.select("page_id", "url", "html", "host", "path").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long, host string, path string")


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", "n_chars", "path")
