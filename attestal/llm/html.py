"""Main text of web pages by minimum cut.

A page becomes its blocks: runs of text between block-level tags. A classifier
gives each block a cost of being content and one of being boilerplate; those
are capacities to the two terminals. Blocks that follow each other, and blocks
of one parent, are tied by edges that weaken with their distance in the tree.
The minimum cut separates content from boilerplate.

The classifier is naive Bayes over binned traits of blocks (tag, doubtful
class words above it, link share, length, punctuation, place), learned from
pages that mark their parts; its sample is bounded by ``SAMPLE_PAGES``. Tags
and class names that name a part outright (``nav``, ``post-comments``) weigh
more than the traits can, unless they stand on the main part or around it.
Tags that never hold readable text decide by themselves.

Reading a page takes time linear in its length, whatever it holds.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import bound_batches, kept_columns, quoted

#: Pages that the classifier learns from at most: those whose ids have the smallest hashes.
SAMPLE_PAGES = 2000
#: Weight of the tie of neighbours, and what each step between them in the tree leaves of it.
TIE, FADE = 1.2, 0.6
#: Strongest log-odds that one trait, and all together, may give.
TRAIT_LIMIT, LIMIT = 3.0, 4.5
#: Log-odds of content for blocks of a page that does not mark its main part (most of its text is content), and of one that does, outside it less.
UNMARKED, MARKED = 4.0, 5.0
#: Log-odds of blocks below a tag or name of a boilerplate part, and what a doubtful class word has before anything is learned.
NAMED, DOUBT = -12.0, -2.0

# fixed values: what HTML says of its tags
SILENT = "script style noscript template textarea select option button svg math iframe object canvas audio video head title".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Tags that mark boilerplate, and those that mark content.
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Words in class, id or role that mark boilerplate.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form header legal masthead menu "
    "modal nav navbar navigation newsletter notice pagination popup promo recommended related replies reply respond share sharing sidebar signup "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
MAIN_WORDS = frozenset("article body content entry main page post story text".split())
#: Last words of a name that say nothing of what it names, and words that make it tell of something else.
SHAPE_WORDS = frozenset("area bar block box button buttons container icons inner item items links list panel section wrap wrapper".split())
RELATION_WORDS = frozenset("has no with without".split())
#: Boilerplate tags that never stand around a page's main part.
APART_TAGS = frozenset("nav header footer aside menu dialog".split())
#: A start of one of these ends an open paragraph; a start of the same kind ends an open item.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in "script style textarea title noscript template iframe svg math".split()}
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_SPECIAL = re.compile(r"[>\"']")
_MARK = re.compile(r"""\b(class|id|role|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.!?;:,…]")


@dataclass
class Node:
    tag: str
    parent: Node | None
    depth: int
    hidden: bool
    #: Does a name here say outright that this is boilerplate, or the main part; which words leave a doubt?
    named: bool = False
    titled: bool = False
    doubts: tuple[str, ...] = ()
    #: Outermost node around this one that marks a main part, by its tag or else by its name; None below a boilerplate tag.
    part: Node | None = None
    apart: bool = False
    aside: bool = False
    main: bool = False


@dataclass
class Block:
    text: str
    node: Node
    linked: int
    traits: tuple[str, ...] = field(default=())


def _named(names: list[list[str]], tag: str) -> tuple[bool, bool, tuple[str, ...]]:
    """Whether names, as lists of words, name a boilerplate part, whether a main part, and the words that only leave a doubt.

    A name means what its last word means, leaving out words of shape:
    ``post-comments`` are comments, ``text-share-price`` is a price.
    """
    aside, main, doubts = False, False, set()
    for words in names:
        if RELATION_WORDS.intersection(words):
            continue
        heads = [w for w in words if w not in SHAPE_WORDS]
        aside |= bool(heads) and heads[-1] in ASIDE_WORDS and not (heads[-1] == "header" and MAIN_WORDS.intersection(words))
        main |= bool(heads) and heads[-1] in MAIN_WORDS
        doubts.update(w for w in heads[:-1] if w in ASIDE_WORDS and not MAIN_WORDS.intersection(words))
    return aside, main and not aside and tag in ("div", "section"), tuple(sorted(doubts))


def _node(tag: str, attributes: str, parent: Node) -> Node:
    names, hidden = [], parent.hidden or tag in SILENT
    for kind, *values in _MARK.findall(attributes) if attributes.strip() else ():
        value, kind = "".join(values).lower(), kind.lower()
        if kind == "hidden" or kind == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
        elif kind != "style":
            names += [_WORD.findall(name) for name in value.split()]
    named, titled, doubts = _named(names, tag) if names and tag not in ("html", "body") else (False, False, ())
    node = Node(tag, parent, parent.depth + 1, hidden, named, titled and parent.depth < 4, doubts)
    node.apart = parent.apart or tag in APART_TAGS and not (tag == "header" and parent.part)
    if not node.apart:
        # an outermost article or main replaces a part that only a name marks
        strong = tag in MAIN_TAGS and (parent.part is None or parent.part.tag not in MAIN_TAGS)
        node.part = node if strong or parent.part is None and node.titled else parent.part
    return node


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) in page order; kinds are text, start, end and raw.

    A tag ends at the first ``>`` outside quotes; a ``<`` that no such end
    follows is text. Quotes from which a search has failed once are not tried
    again, so all searches together are linear.
    """
    failed: set[int] = set()
    next_from, next_at = -1, -1
    last = {c: page.rfind(c) for c in ">\"'"}

    def tag_end(start: int) -> int:
        nonlocal next_from, next_at
        if start > last[">"]:
            return -1
        if not next_from <= start <= next_at:
            found = _SPECIAL.search(page, start)
            next_from, next_at = start, found.start()
        at, tried = next_at, []
        while at >= 0 and page[at] != ">":
            if at in failed:
                at = -1
                break
            tried.append(at)
            close = page.find(page[at], at + 1) if at < last[page[at]] else at
            found = _SPECIAL.search(page, close + 1)
            at = found.start() if found else -1
        if at < 0:
            failed.update(tried)
        return at

    at = text = 0
    while (at := page.find("<", at)) >= 0:
        after = at + 1
        if page.startswith("!--", after):
            close = page.find("-->", at + 4)
            # the shortest comments share their hyphens
            end = at + 5 if page.startswith(">", at + 4) else close + 3 if close >= 0 else len(page)
            token = None
        elif page[after : after + 1] in ("!", "?") or page.startswith("/", after) and not _NAME.match(page, after):
            end = page.find(">", after) + 1 if after <= last[">"] else 0
            token = None
        elif name := _NAME.match(page, after):
            end = tag_end(name.end()) + 1
            tag = name[0].lower()
            token = ("end", tag[1:], "") if tag[0] == "/" else ("start", tag, page[name.end() : end - 1] if end else "")
            if end and tag in _RAW and not token[2].endswith("/"):
                closed = _RAW[tag].search(page, end)
                end = (page.find(">", closed.end()) + 1 or len(page)) if closed else len(page)
                token = ("raw", tag, "")
            elif end and tag in _RAW:
                token = ("raw", tag, "")
        else:
            end = 0
        if not end:
            at += 1
            continue
        if text < at:
            yield "text", page[text:at], ""
        if token:
            yield token
        at = text = end
    if text < len(page):
        yield "text", page[text:], ""


def blocks(page: str) -> list[Block]:
    """Blocks of readable text in page order; unclosed and stray tags are taken as browsers take them."""
    root = Node("", None, 0, False)
    # an open block-level node, and the inline tags open within it
    stack: list[tuple[Node, list[str]]] = [(root, [])]
    opened: Counter[str] = Counter()
    nodes, found = [root], []
    pieces: list[str] = []
    linked = 0
    home = root

    def close() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text and not home.hidden:
            found.append(Block(text, home, linked))
        pieces.clear()
        linked = 0

    def pop() -> str:
        node, inline = stack.pop()
        opened.subtract([node.tag, *((node.depth, t) for t in inline)])
        return node.tag

    for kind, tag, attributes in _tokens(page):
        node, inline = stack[-1]
        if kind == "text":
            if not pieces:
                home = node
            pieces.append(tag)
            if opened[node.depth, "a"] or node.depth and opened[node.depth - 1, "a"]:
                linked += len(tag.strip())
        elif kind == "raw":
            if tag in ("textarea", "iframe", "noscript", "template"):
                close()
        elif tag == "br":
            pieces.append(" ") if pieces else None
        elif tag in INLINE:
            if kind == "start" and tag not in VOID:
                hidden = bool(attributes) and _node(tag, attributes, node).hidden
                if hidden and not node.hidden:
                    # a hidden run of text is a block that is not shown
                    close()
                    nodes.append(_node(tag, attributes, node))
                    stack.append((nodes[-1], []))
                    opened[tag] += 1
                else:
                    inline.append(tag)
                    opened[node.depth, tag] += 1
            elif kind == "end" and node.tag == tag:
                close()
                pop()
            elif kind == "end" and opened[node.depth, tag]:
                while (last := inline.pop()) != tag:
                    opened[node.depth, last] -= 1
                opened[node.depth, tag] -= 1
        elif kind == "end":
            close()
            if opened[tag] > 0:
                while pop() != tag:
                    pass
        else:
            close()
            if tag in VOID:
                continue
            ends = ("p",) if tag in ENDS_PARAGRAPH else ENDS_SAME.get(tag, ())
            # an open paragraph within the item goes with it
            depth = 2 if tag in ENDS_SAME and node.tag == "p" and len(stack) > 2 else 1
            if stack[-depth][0].tag in ends:
                for _ in range(depth):
                    pop()
            nodes.append(_node(tag, attributes, stack[-1][0]))
            stack.append((nodes[-1], []))
            opened[tag] += 1
    close()
    _place(nodes, found)
    for place, block in enumerate(found):
        block.traits = _traits(block, place, len(found))
    return found


def _place(nodes: list[Node], found: list[Block]) -> None:
    """Says of each node whether it lies in a main part or in boilerplate. Names on the largest main part and around it do not count."""
    sizes: dict[int, int] = {}
    parts: dict[int, Node] = {}
    for block in found:
        part = block.node.part
        if part is not None:
            parts[id(part)] = part
            sizes[id(part)] = sizes.get(id(part), 0) + len(block.text)
    strong = any(p.tag in MAIN_TAGS for p in parts.values())
    candidates = [p for p in parts.values() if p.tag in MAIN_TAGS or not strong]
    largest = max(candidates, key=lambda p: sizes[id(p)], default=None)
    clear, at = set(), largest
    while at is not None:
        clear.add(id(at))
        at = at.parent
    kept = {id(p) for p in candidates}
    for node in nodes[1:]:
        up = node.parent
        node.main = up.main or id(node) in kept
        by_tag = node.tag in ASIDE_TAGS and not (node.tag == "header" and up.main)
        if id(node) in clear:
            node.doubts = ()
            continue
        # the header of an article is part of it, whatever its class is
        named = node.named and not (node.tag == "header" and up.main)
        node.aside = up.aside or by_tag or named
        node.doubts = tuple(sorted({*up.doubts, *node.doubts})) if node.doubts else up.doubts


def _traits(block: Block, place: int, total: int) -> tuple[str, ...]:
    words = len(block.text.split())
    share = min(1.0, block.linked / max(1, len(block.text)))
    return (
        f"tag:{block.node.tag if block.node.tag in ENDS_PARAGRAPH or block.node.tag in ENDS_SAME else 'other'}",
        f"words:{min(7, words.bit_length())}",
        f"links:{math.ceil(share * 4)}",
        f"points:{min(4, len(_PUNCTUATION.findall(block.text)))}",
        f"depth:{min(8, block.node.depth)}",
        *(f"word:{w}" for w in block.node.doubts),
        f"place:{'first' if place == 0 else 'last' if place == total - 1 else min(9, 10 * place // total)}",
    )


def examples(page: str) -> Iterator[tuple[str, bool]]:
    """(trait, content?) of the blocks that semantic tags label, for pages that have both kinds."""
    found = [b for b in blocks(page) if b.node.aside or b.node.main]
    if any(b.node.aside for b in found) and any(not b.node.aside for b in found):
        for block in found:
            for trait in block.traits:
                yield trait, not block.node.aside


class Classifier:
    """Log-odds of content by trait, from counts of (trait, content, n)."""

    def __init__(self, counts: list[tuple[str, bool, int]]):
        totals = {True: 1.0, False: 1.0}
        table: dict[str, list[float]] = {}
        for trait, content, n in counts:
            table.setdefault(trait, [1.0, 1.0])[int(content)] += n
            totals[content] += n
        self.odds = {
            t: max(-TRAIT_LIMIT, min(TRAIT_LIMIT, math.log(c / totals[True]) - math.log(a / totals[False]) + self.before(t)))
            for t, (a, c) in table.items()
        }

    @staticmethod
    def before(trait: str) -> float:
        """Log-odds of a trait before anything is learned of it."""
        return DOUBT if trait.startswith("word:") else 0.0

    def score(self, block: Block, marked: bool) -> float:
        """Log-odds that a block is content. A part that is named outright is not left to the traits."""
        score = max(-LIMIT, min(LIMIT, sum(self.odds.get(t, self.before(t)) for t in block.traits)))
        if block.node.aside:
            return NAMED + score
        if marked:
            return score + (MARKED if block.node.main else -MARKED)
        return score + UNMARKED


def tree_distance(a: Node, b: Node) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that follow each other, and between blocks next to each other under one parent."""
    edges, last = [], {}
    for i, block in enumerate(found):
        if i:
            edges.append((i - 1, i, TIE * FADE ** tree_distance(found[i - 1].node, block.node)))
        parent = id(block.node.parent or block.node)
        if last.get(parent, i - 1) != i - 1:
            edges.append((last[parent], i, TIE * FADE**2))
        last[parent] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Content side of the minimum cut.

    Nodes whose terminal outweighs all of their edges are on its side in every
    minimum cut; they go first, and their edges become terminal capacities of
    their neighbours. Augmenting paths of fewest edges settle the rest.
    """
    near: list[dict[int, float]] = [{} for _ in scores]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    terminal, side = list(scores), [None] * len(scores)
    waiting = deque(range(len(scores)))
    while waiting:
        i = waiting.popleft()
        if side[i] is None and abs(terminal[i]) >= sum(near[i].values()):
            side[i] = terminal[i] > 0
            for j, w in near[i].items():
                terminal[j] += w if side[i] else -w
                del near[j][i]
                waiting.append(j)
            near[i] = {}
    left = [i for i in range(len(scores)) if side[i] is None]
    if left:
        reached = _flow(left, terminal, near)
        for i in left:
            side[i] = i in reached
    return side


def _flow(nodes: list[int], terminal: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in nodes:
        room[i] = dict(near[i])
    for i in nodes:
        room[source][i], room[i][source] = max(terminal[i], 0.0), 0.0
        room[i][sink], room[sink][i] = max(-terminal[i], 0.0), 0.0
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            at = queue.popleft()
            for to, free in room[at].items():
                if free > 1e-9 and to not in came:
                    came[to] = at
                    queue.append(to)
        if sink not in came:
            return set(came)
        path, at = [], sink
        while at != source:
            path.append((came[at], at))
            at = came[at]
        amount = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= amount
            room[b][a] += amount


def main_text(page: str | None, classifier: Classifier) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    marked = any(b.node.main and not b.node.aside for b in found)
    chosen = minimum_cut([classifier.score(b, marked) for b in found], ties(found))
    return " ".join(b.text for b, content in zip(found, chosen, strict=True) if content)


def _example_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, bool], int] = {}
    for batch in batches:
        for value in batch.column(0):
            for one in examples(value.as_py() or ""):
                counts[one] = counts.get(one, 0) + 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in counts], pa.string()), pa.array([c for _, c in counts], pa.bool_()), pa.array(list(counts.values()), pa.int64())],
        names=["trait", "content", "n"],
    )


def learn(pages: DataFrame, key: str = "page_id", html: str = "html") -> Classifier:
    """From at most ``SAMPLE_PAGES`` pages; what comes to the driver is one count for each bin of a trait."""
    pages = pages.select(F.col(key).alias("page_key"), F.col(html).alias("page"))
    order = F.xxhash64("page_key")
    sample = pages.select(F.col("page_key").alias("_key")).where("_key is not null").orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE_PAGES).distinct()
    some = pages.join(F.broadcast(sample), F.col("page_key") == F.col("_key"), "left_semi").where(order.isNotNull()).select("page")
    counts = some.mapInArrow(_example_counts, "trait string, content boolean, n long").groupBy("trait", "content").agg(F.sum("n").alias("n"))
    return Classifier(sorted(tuple(r) for r in counts.collect()))


def _extractor(shared, html: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(x.as_py(), classifier) for x in part.column(html)]
                rest = part.drop_columns([html])
                columns = [*rest.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*rest.schema.names, "text", "n_chars"])

    return run


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows with the page replaced by ``text`` (the article's blocks joined by blanks, empty if none) and ``n_chars``.

    Input columns of these names, in any case of letters, are replaced. A null page counts as empty.
    Where no page marks its parts, blocks are content unless their tags say
    otherwise. Repeated rows are extracted alike. An empty table gives an
    empty result.
    """
    kept = kept_columns(pages, (html, "text", "n_chars"))
    names = [f"c{i}" for i in range(len(kept))]
    bound_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(learn(pages, html=html))
    rows = pages.select(F.col(html).alias("page"), *[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)])
    schema = rows.drop("page").schema.add("text", "string").add("n_chars", "long")
    found = rows.mapInArrow(_extractor(shared, "page"), schema)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, kept, strict=True)], "text", "n_chars")
