"""Main-text extraction by wrapper induction over all pages of one host.

Every page becomes a DOM tree.  Siblings of one label (tag, class, id, role) are folded
into one node, so a node is named by the path of its labels.

1. *Counts.*  Over all distinct pages of a host, how many hold a text at a path.  A text
   that at least ``CONSTANT`` of them hold there (of ``LEAST_PAGES`` or more) is template,
   inside an article as well as outside; a passage that some pages share is none.  Where at
   least half of the pages have one container structure, these are counted, so that
   error pages and the like do not vote.
2. *Alignment.*  Two typical pages - different ones of the most frequent container
   structure - are aligned by simple tree matching (the largest
   order-preserving match of children, level by level).  Matched nodes whose texts are not
   constant are varying slots.  The wrapper is the tree of matched nodes; its content node is
   the deepest container that holds nearly all (``INNER``) of the varying text outside of
   named nodes.
3. Every page is aligned with its host's wrapper; what lies in the nodes that match the
   content node, without named nodes and constant texts, is its text.  Pages that
   would keep less than ``LEAST_KEPT`` of their text (copies of one page that fill a host) keep
   it whole.

*Named nodes*: tag, class, id or role name them as menu, header, footer, sidebar, notice,
advert, form or reader comments.  Names are a tie-break, since these parts vary from
page to page as content does: inside an article headings are never dropped by name, and an
``id`` that is a word of prose as well (``discussion``, ``related-work``) only where at least half of
the host's pages have such a node.

A host without two different pages has no wrapper, and a page may not match; then the
``article`` or ``main``, or else the whole body, is the content.  What is counted are hashes,
one row a text and page at most; wrappers are small (constant texts are kept as
hashes) and are joined to pages by host: Spark broadcasts them if their size allows
it, or else splits a host that holds a third of all pages.

Defined results: null html is empty and gives the empty text; broken markup is
read as browsers do (unclosed tags end with their parent, a new block ends an
open paragraph); repeated rows give repeated results; a null url is a host of
its own; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgepole.llm.common import small_batches, written

# Element classes of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_ENDS_P = _BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
_ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

_NOT_CONTENT = frozenset("nav footer aside form script style noscript template head title button select option input textarea iframe object svg canvas dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Names of parts that are no content, and such that are words of prose too.
_PLAIN = (
    r"ad|ads|adv|advert\w*|adsense|sponsor\w*|nav|navbar|navigation|breadcrumbs?|sidebar|side-bar|footer|masthead|site-header|page-header"
    r"|cookies?|gdpr|popup|modal|newsletter|comments?|comment-\w+|commentlist|disqus|pagination|pager"
)
_PROSE = (
    r"promo\w*|banner|menu|aside|widget|consent|notice|alert|overlay|subscri\w*|signup|login|share|sharing|social|related|recommend\w*"
    r"|replies|reply|respond|discussion|skip"
)
_PLAIN_NAMES = re.compile(rf"(^|[\s_-])({_PLAIN})([\s_-]|$)", re.I)
_NAMES = re.compile(rf"(^|[\s_-])({_PLAIN}|{_PROSE})([\s_-]|$)", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONSTANT, LEAST_PAGES = 0.9, 5
RECURRING, LEAST_RECURRING = 0.5, 3
INNER, LEAST_VARYING = 0.9, 0.1
LEAST_KEPT = 0.25
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass(slots=True)
class Node:
    tag: str
    names: str = ""  # class, id and role
    dropped: bool = False
    perhaps: bool = False  # dropped by its id if the host's pages have it as a rule
    prose: bool = False  # inside an article
    children: list = field(default_factory=list)  # Node or str (text)

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.names}" if self.names else self.tag


def _open(tag: str, attributes: str, in_article: bool) -> Node:
    names, dropped, perhaps = "", tag in _NOT_CONTENT or (tag == "header" and not in_article), False
    if attributes:
        found = {}
        for name, a, b, c in _ATTR.findall(attributes):
            found.setdefault(name.lower(), entities.unescape(a or b or c))
        # numbers in names count pages or items of one template
        names = re.sub(r"\d+", "#", " ".join(found[k] for k in ("class", "id", "role") if k in found))
        if tag not in ("html", "body", "article", "main") and not (in_article and tag in _HEADINGS):
            own = found.get("id", "")
            if found.get("role", "").lower() in _ROLES or _NAMES.search(found.get("class", "")) or _PLAIN_NAMES.search(own):
                dropped = True
            perhaps = not dropped and _NAMES.search(own) is not None
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
            dropped = True
    return Node(tag, names, dropped, perhaps, in_article)


# where the text of an element that holds no markup ends
_RAW_END = {tag: re.compile(rf"</{tag}", re.I | re.A) for tag in _RAW}


class _Stack:
    """Open elements, with the places of each tag: finding the one to close does not scan them."""

    def __init__(self, top: Node) -> None:
        self.nodes = [top]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.articles = 0

    def open(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in _BLOCK:
            self.blocks.append(len(self.nodes))
        self.articles += node.tag in ("article", "main")
        self.nodes.append(node)

    def close(self, to: int) -> None:
        for n in self.nodes[to:]:
            self.places[n.tag].pop()
            if n.tag in _BLOCK:
                self.blocks.pop()
            self.articles -= n.tag in ("article", "main")
        del self.nodes[to:]

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag; 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def before(self, tag: str) -> None:
        """Close what a start tag ends: an open paragraph, a list item or cell before it."""
        if tag in _ENDS_P and self.blocks and self.nodes[self.blocks[-1]].tag == "p":
            self.close(self.blocks[-1])
        if tag in _ENDS_OWN:
            scope = max(map(self.last, _SCOPE[tag]))
            own = [i for i in map(self.last, _ENDS_OWN[tag]) if i > scope]
            if own:
                self.close(min(own) if tag == "tr" else max(own))


def parse(page: str) -> Node:
    """The DOM tree of a page."""
    top, at = Node("#page"), 0
    stack = _Stack(top)
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            stack.nodes[-1].children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if i := stack.last(tag):
                stack.close(i)
            continue
        stack.before(tag)
        if tag == "br":
            stack.nodes[-1].children.append("\n")
            continue
        node = _open(tag, m[3], stack.articles > 0)
        stack.nodes[-1].children.append(node)
        if tag in _VOID or m[3].endswith("/") and tag not in _BLOCK:
            continue
        if tag in _RAW:
            found = _RAW_END[tag].search(page, at)
            node.dropped = True
            after = page.find(">", found.start()) if found else -1
            at = len(page) if after < 0 else after + 1
            continue
        stack.open(node)
    if at < len(page):
        stack.nodes[-1].children.append(page[at:])
    return top


def _said(text: str) -> str:
    """Hash of a text, for comparing."""
    return xxhash.xxh3_64_hexdigest(" ".join(entities.unescape(text).split()))


@dataclass(slots=True)
class Folded:
    """A node of the aligned trees: siblings of one label, with their texts (hash: length) and children."""

    label: str
    nodes: list
    texts: dict
    children: list
    content: bool = False
    path: str = ""

    def slot(self, said: str = "") -> int:
        """Number of a text at this node's path, or of the node itself."""
        return xxhash.xxh3_64_intdigest(f"{self.path} {said}") - (1 << 63)


# below so many levels all is one node, whose own children's texts are never constant
_DEEPEST = 100


def fold(nodes: list[Node], depth: int = 0, above: str = "") -> Folded:
    """Fold the subtrees of sibling nodes of one label into one."""
    out = Folded(nodes[0].label, nodes, {}, [], path=xxhash.xxh3_64_hexdigest(f"{above}/{nodes[0].label}"))
    place: dict[str, list[Node]] = {}
    todo = list(nodes)
    while todo:
        for c in todo.pop().children:
            if isinstance(c, str):
                if c.strip():
                    out.texts[_said(c)] = len(c)
            elif depth < _DEEPEST:
                place.setdefault(c.label, []).append(c)
            else:
                todo.append(c)
    out.children = [fold(c, depth + 1, out.path) for c in place.values()]
    return out


def _walk(x: Folded) -> Iterator[Folded]:
    """The node and all below it that are not dropped."""
    todo = [x]
    while todo:
        x = todo.pop()
        if not x.nodes[0].dropped:
            yield x
            todo += x.children


def survey(page: str) -> tuple[list[int], list[int], int]:
    """What is counted of a page: its texts by path, its nodes that are dropped only
    where they recur, and a hash of its container structure."""
    texts, nodes, shape = set(), set(), set()
    for x in _walk(fold([parse(page)])):
        texts.update(map(x.slot, x.texts))
        if any(n.perhaps for n in x.nodes):
            nodes.add(x.slot())
        if x.nodes[0].tag in _CONTAINERS:
            shape.add(x.path)
    return sorted(texts), sorted(nodes), xxhash.xxh3_64_intdigest(" ".join(sorted(shape))) - (1 << 63)


def match(a: Folded, b: Folded) -> list[tuple[Folded, Folded]]:
    """Simple tree matching: the aligned pairs of the best order-preserving match."""
    return _match(a, b)[1]


def _match(a: Folded, b: Folded) -> tuple[int, list[tuple[Folded, Folded]]]:
    if a.label != b.label:
        return 0, []
    # labels of children are unique, so each child has one partner at most
    place = {y.label: j for j, y in enumerate(b.children, 1)}
    below = [(place.get(x.label), x) for x in a.children]
    got = [(j, *_match(x, b.children[j - 1])) for j, x in below if j]
    # the heaviest increasing chain of partners: ends by place, each heavier than the ends before it
    place_of, weight, last, before = [], [], [], [-1] * len(got)
    for i, (j, n, _) in enumerate(got):
        k = bisect.bisect_left(place_of, j)
        total = n + (weight[k - 1] if k else 0)
        before[i] = last[k - 1] if k else -1
        while k < len(weight) and weight[k] <= total:
            del place_of[k], weight[k], last[k]
        if not k or weight[k - 1] < total:
            place_of.insert(k, j)
            weight.insert(k, total)
            last.insert(k, i)
    chain, i = [], last[-1] if last else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return (weight[-1] if weight else 0) + 1, [(a, b), *(p for i in reversed(chain) for p in got[i][2])]


_CONTAINERS = frozenset("#page html body div section main article table tbody tr td center".split())


def induce(one: str, other: str, constant: set[int] | None = None) -> dict | None:
    """The wrapper of two pages; None if they are copies.

    ``constant`` holds the slots that are template by the counts over all pages; without
    counts a text is constant if both pages hold it.  ``tree`` is nested [label, children, is
    content].
    """
    a, b = fold([parse(one)]), fold([parse(other)])
    pairs = {id(x): y for x, y in match(a, b)}
    counted = constant is not None
    if not counted:
        constant = {x.slot(t) for x in _walk(a) if id(x) in pairs for t in x.texts.keys() & pairs[id(x)].texts.keys()}

    def varying(x: Folded) -> int:
        """Length of what differs at or below a matched node, on the first page."""
        if x.nodes[0].dropped:
            return 0
        return sum(n for t, n in x.texts.items() if x.slot(t) not in constant) + sum(map(varying, x.children))

    all_ = varying(a)
    if all_ < LEAST_VARYING * max(1, _length(a)) or _length(a) == _length(b) and _texts(a) == _texts(b):
        return None
    at = a
    while at.label.split(".")[0] not in ("article", "main"):
        inner = [x for x in at.children if id(x) in pairs and x.nodes[0].tag in _CONTAINERS and varying(x) >= INNER * all_]
        if not inner:
            break
        at = inner[0]

    def build(x: Folded) -> list:
        return [x.label, [build(c) for c in x.children if id(c) in pairs], x is at]

    return {"tree": build(a), "constant": [] if counted else sorted(constant), "recurring": [], "pages": 2}


def _texts(x: Folded) -> set[int]:
    return {y.slot(t) for y in _walk(x) for t in y.texts}


def _length(x: Folded) -> int:
    return 0 if x.nodes[0].dropped else sum(x.texts.values()) + sum(map(_length, x.children))


def _as_folded(wrapper: list) -> Folded:
    return Folded(wrapper[0], [], {}, [_as_folded(c) for c in wrapper[1]], wrapper[2])


def _has(node: Node, tags: tuple[str, ...]) -> bool:
    stack = [node]
    while stack:
        n = stack.pop()
        if n.tag in tags and not n.dropped:
            return True
        if not n.dropped:
            stack += [c for c in n.children if not isinstance(c, str)]
    return False


def extract(page: str | None, wrapper: dict | None = None) -> str:
    """The main text: blocks in page order, joined by empty lines.

    ``wrapper`` holds the aligned tree (or none), the slots of constant texts and
    of recurring nodes, and the number of pages that these were counted on.
    """
    top = parse(page or "")
    known: dict[int, set] = {}
    roots: set[int] = set()
    pages = wrapper["pages"] if wrapper else 0
    folded = fold([top])
    recurring = set(wrapper["recurring"]) if wrapper else set()
    for x in _walk(folded):
        for n in x.nodes:
            if n.perhaps:
                n.dropped = x.slot() in recurring if pages >= LEAST_RECURRING else not n.prose
    if wrapper and wrapper["tree"]:
        for x, y in match(folded, _as_folded(wrapper["tree"])):
            if y.content:
                roots = {id(n) for n in x.nodes}
                article = x.nodes[0].tag in ("article", "main")
    if not roots:
        article = _has(top, ("article", "main"))
    if wrapper and (pages >= LEAST_PAGES or roots and not article):
        constant = set(wrapper["constant"])
        for x in _walk(folded):
            if told := {t for t in x.texts if x.slot(t) in constant}:
                known |= {id(n): told for n in x.nodes}
    content = not roots and not article
    whole = _blocks(top, roots, content, {})
    less = _blocks(top, roots, content, known) if known else whole
    return less if len(less) >= LEAST_KEPT * len(whole) else whole


def _blocks(top: Node, roots: set[int], content: bool, known: dict[int, set]) -> str:
    """The text in the roots (or else in articles, or all), without dropped nodes and known texts."""
    blocks: list[str] = []
    now: list[str] = []

    def flush() -> None:
        if now:
            if text := " ".join(entities.unescape("".join(now)).split()):
                blocks.append(text)
            now.clear()

    # an explicit stack: broken pages nest deeper than Python calls do
    todo: list[tuple[Node | str | None, bool, set | None]] = [(top, content, None)]
    while todo:
        item, content, told = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if content and not (told and item.strip() and _said(item) in told):
                now.append(item)
        elif not item.dropped:
            inside = content or (id(item) in roots if roots else item.tag in ("article", "main"))
            block = item.tag in _BLOCK or item.tag == "#page"
            if block:
                flush()
                todo.append((None, inside, None))
            todo += [(c, inside, known.get(id(item))) for c in reversed(item.children)]
    flush()
    return "\n\n".join(blocks)


def host_of(url: str | Column) -> Column:
    """Lower-case host of a URL; empty for null or a URL without one."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1))


def surveyed(pages: DataFrame) -> DataFrame:
    """(host, h, texts, nodes, shape) of every distinct page of a host; ``h`` is a hash of the page."""

    @F.pandas_udf("struct<texts: array<long>, nodes: array<long>, shape: long>")
    def look(html: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages_ in html:
            yield pd.DataFrame([survey(p) for p in pages_], columns=["texts", "nodes", "shape"])

    seen = pages.filter("html is not null").select("host", F.xxhash64("html").alias("h"), look("html").alias("s"))
    return seen.select("host", "h", "s.*").dropDuplicates(["host", "h"])


def _often(seen: DataFrame, sizes: DataFrame, column: str, share: float, least: int) -> DataFrame:
    """(host, ``column``): the slots that at least ``share`` of a host's pages hold, of ``least`` or more."""
    counts = seen.select("host", F.explode(column).alias("slot")).groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n"))
    often = counts.filter("n > 1").join(sizes.filter(F.col("pages") >= least), "host").filter(F.col("n") >= F.col("pages") * share)
    return often.groupBy("host").agg(F.sort_array(F.collect_list("slot")).alias(column))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the wrapper of each host with two pages that differ, as JSON."""
    seen = written(surveyed(pages), "surveyed")
    shapes = seen.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("a"), F.max("h").alias("b"))
    usual = shapes.groupBy("host").agg(
        F.max_by(F.struct("shape", "n", "a", "b"), F.struct("n", "shape")).alias("two"), F.min("a").alias("least"), F.max("b").alias("most"), F.sum("n").alias("all")
    )
    # pages of the usual shape are counted where they are half of all, or else all are
    most = F.col("two.n") * 2 >= F.col("all")
    voting = usual.filter("all > 1").select("host", F.when(most, F.col("two.shape")).alias("voting"), F.when(most, F.col("two.n")).otherwise(F.col("all")).alias("pages"))
    # one row a host: written, so that the planner knows its size and need not shuffle pages by host
    voting = written(voting, "voting")
    sizes = voting.select("host", "pages")
    counted = seen.join(voting.select("host", "voting"), "host").filter("voting is null or shape = voting")
    texts = _often(counted, sizes, "texts", CONSTANT, LEAST_PAGES)
    nodes = _often(counted, sizes, "nodes", RECURRING, LEAST_RECURRING)
    # two different pages of the usual shape; of single ones, the first and the last of all
    alone = F.col("two.a") == F.col("two.b")
    two = usual.select("host", F.when(alone, F.col("least")).otherwise(F.col("two.a")).alias("a"), F.when(alone, F.col("most")).otherwise(F.col("two.b")).alias("b"))
    wanted = written(two.filter("a != b").select("host", F.posexplode(F.array("a", "b")).alias("nth", "h")), "wanted")
    keyed = pages.filter("html is not null").withColumn("h", F.xxhash64("html"))
    found = keyed.join(wanted, ["host", "h"]).groupBy("host").agg(F.min_by("html", "nth").alias("one"), F.max_by("html", "nth").alias("other"))

    @F.pandas_udf("string")
    def learn(one: pd.Series, other: pd.Series, constant: pd.Series, recurring: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for a, b, c, r, k in zip(one, other, constant, recurring, n, strict=True):
            slots = [] if c is None else [int(x) for x in c]
            # too few pages for counts: what both pages say only tells where the content is
            got = induce(a, b, set(slots) if k >= LEAST_PAGES else None) or {"tree": None}
            out.append(json.dumps(got | {"constant": slots, "recurring": [] if r is None else [int(x) for x in r], "pages": int(k)}))
        return pd.Series(out, dtype=object)

    all_ = found.join(sizes, "host").join(texts, "host", "left").join(nodes, "host", "left")
    return all_.select("host", learn("one", "other", "texts", "nodes", "pages").alias("wrapper"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of("url").alias("host"))
    # written, so that the planner knows the wrappers' size: below the broadcast threshold pages are
    # not shuffled at all, above it both sides are, and a hot host's partition is split
    known = written(wrappers(rows.select("host", "html")), "wrappers")

    @F.pandas_udf("string")
    def text_of(html: pd.Series, wrapper: pd.Series) -> pd.Series:
        learned: dict[str, dict] = {}
        out = []
        for h, w in zip(html, wrapper, strict=True):
            if w is not None and w not in learned:
                learned[w] = json.loads(w)
            out.append(extract(h, learned.get(w) if w is not None else None))
        return pd.Series(out, dtype=object)

    joined = rows.join(known, "host", "left")
    return joined.select("page_id", "url", text_of("html", "wrapper").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
