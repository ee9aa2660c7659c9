"""Main text of web pages by a tree-structured graphical model.

A page is a tree: elements, and the blocks of text in them as leaves. Each node is content or not.
Node potentials come from tag, names and shape of text; parent-child potentials say how labels go
together. Sum-product messages pass upward from the leaves and downward from the root, which is
exact on a tree, and blocks whose content marginal is over one half are the text.

Potentials are counted on labelled pages: those whose markup itself says which element holds the
article. Fixed weights for names of well-known meaning come on top, so a part that no labelled page
has (a form, a comment list) is known as well.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import for_workers, map_arrow, named

# Bound on the labelled pages that potentials are counted on: rows expected, drawn by a hash.
TRAINING_PAGES = 2000
# A feature counts from this many nodes on, and for so much at most.
LEAST_SEEN, MOST_WEIGHT = 20, 1.0

# Elements whose text is none, that stand alone, and that don't break a block.
SILENT = frozenset("script style noscript template textarea title svg math iframe object select button canvas".split())
FOREIGN = frozenset(["svg", "math"])  # complete without an end if closed by themselves
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
# Elements that the opening of another one closes.
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table body html article section div main nav aside header footer form blockquote".split())
# Log weights of tags, and of words in class, id and role.
TAGS = {
    "article": 8.0, "main": 8.0, "nav": -30.0, "footer": -30.0, "aside": -30.0, "form": -30.0, "header": -6.0, "head": -60.0,
    "menu": -30.0, "dialog": -30.0, "fieldset": -30.0,
}
WORDS = {
    **dict.fromkeys("article articlebody main content post entry story".split(), 5.0),
    **dict.fromkeys(
        "nav navbar navigation menu footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored "
        "promo promotion banner cookie cookies consent gdpr notice notices alert disclaimer comment comments commentlist "
        "respond reply replies disqus share sharing social related recommended newsletter subscribe subscription signup "
        "login signin search breadcrumb breadcrumbs copyright widget popup modal overlay pagination pager toolbar form "
        "contentinfo complementary".split(),
        -30.0,
    ),
    **dict.fromkeys("header masthead topbar tags byline meta".split(), -6.0),
}
# Words that say where or how a part stands. A compound name has its strong word's weight if it
# holds no others ("comment-list"); one that does is of another meaning ("related-work", "with-sidebar").
FRAME = frozenset(
    "area bar block body bottom box button buttons card col column container count foot footer fixed global group head holder icon "
    "icons inline inner item items left link links list lists page pages panel post posts article articles stories primary right "
    "root row secondary section site slot tab thread title top unit widgets wrap wrapper wp author contact email facebook google "
    "mobile desktop metadata reader text this twitter user".split()
)
_prefix = re.compile(r"(?!as|at|by|in|is|my|no|of|on|or|to|up)[a-z]{1,2}")
# Elements that names take nothing from: ids of headings are made of their texts, and an article's or
# page's classes say what goes with it.
PLAIN_NAMES = frozenset("h1 h2 h3 h4 h5 h6 article main body html".split())
# Elements that hold anything: their tags say nothing.
NEUTRAL = frozenset("html body div section span center table tbody tr td".split())
# Weights below this are certain; such a part says nothing about what it stands in.
CERTAIN = -20.0
# Weight of strong names, however many an element has.
STRONG = -30.0
# Log odds of a child having its parent's label lie between these.
LEAST_STAY, MOST_STAY = math.log(0.99 / 0.01), math.log(0.998 / 0.002)

_comment = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_tag = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
_plain_tag = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_other = re.compile(r"<[!?/][^>]*>", re.S)
_attribute = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
# A slash at the end that is no part of an unquoted value.
_complete = re.compile(r"(?<!=)(?<!=\s)(?:^|[\s\"']|(?:^|[\s\"'/])[^\s\"'=/]+)/\Z")
_part = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page:
    """Nodes in page order: parents, features, fixed weights, and the texts of leaves."""

    def __init__(self):
        self.parents: list[int] = []
        self.features: list[tuple[str, ...]] = []
        self.weights: list[float] = []
        self.texts: list[str | None] = []
        self.tags: list[str] = []

    def add(self, parent: int, tag: str, features: tuple[str, ...], weight: float, text: str | None) -> int:
        self.parents.append(parent)
        self.tags.append(tag)
        self.features.append(features)
        self.weights.append(weight)
        self.texts.append(text)
        return len(self.parents) - 1


def _strong(name: str) -> bool:
    """If a whole name is that of a part beside the article."""
    first, *rest = parts = _part.findall(name) or [""]
    if rest and first not in WORDS and _prefix.fullmatch(first):
        parts = rest  # a theme's mark
    return any(WORDS.get(w, 0.0) < CERTAIN for w in parts) and all(w in WORDS or w in FRAME for w in parts)


def _name_weight(tag: str, words: set[str], strong: bool) -> float:
    """Fixed weight of an element's names; parts of compounds have no strong one."""
    low = 0.0 if tag in PLAIN_NAMES else CERTAIN
    return sum(x for x in (WORDS.get(w, 0.0) for w in words) if x > low) + STRONG * (strong and tag not in PLAIN_NAMES)


def _names(attributes: str) -> tuple[set[str], bool, bool]:
    """Words of class, id and role; whether one is a strong name; whether the element is hidden."""
    words: set[str] = set()
    strong = False
    hidden = bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes)) if "hidden" in attributes else False
    for name, *values in _attribute.findall(attributes):
        value, name = "".join(values), name.lower()
        if name in ("class", "id", "role", "itemprop"):
            words |= set(_part.findall(_camel.sub(" ", value).lower())) | {value.lower()}
            strong = strong or any(_strong(_camel.sub("-", token).lower()) for token in value.split())
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
        elif name == "aria-hidden" and value == "true":
            hidden = True
    return words, strong, hidden


def _shape(text: str, linked: int, tag: str) -> tuple[str, ...]:
    n = len(text)
    share = linked / n if n else 0
    return (
        f"length {min(4, n.bit_length() // 2)}",
        f"links {0 if not linked else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
        f"ends {text[-1:] in '.!?:;…'}",
        *([] if tag in NEUTRAL else [f"in {tag}"]),
    )


def parse(source: str) -> Page:
    """The tree of a page; broken markup is mended as browsers do in the common cases."""
    page = Page()
    root = page.add(-1, "", (), 0.0, None)
    # Open elements: tag, node that texts belong to, whether it is a node itself.
    stack: list[tuple[str, int, bool]] = [("", root, True)]
    pieces: list[str] = []
    links = linked = 0

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                node = stack[-1][1]
                page.add(node, "#text", _shape(text, linked, page.tags[node]), 0.0, text)
            pieces.clear()
        linked = 0

    def pop_to(depth: int):
        nonlocal links
        while len(stack) > depth:
            if stack[-1][2]:
                flush()
            links -= stack.pop()[0] == "a"

    def say(text: str):
        nonlocal linked
        text = entities.unescape(text) if "&" in text else text
        pieces.append(text)
        if links:
            linked += len(text.strip())

    at, n = 0, len(source)
    while at < n:
        begin = source.find("<", at)
        if begin < 0:
            say(source[at:])
            break
        if begin > at:
            say(source[at:begin])
        if source.startswith("<!--", begin):
            at = _comment.match(source, begin).end()
            continue
        match = _tag.match(source, begin) or _plain_tag.match(source, begin)
        if not match:
            other = _other.match(source, begin)
            if other:
                at = other.end()
            elif begin + 1 < n and (source[begin + 1].isalpha() or source[begin + 1] in "/!?"):
                break  # a tag that the page's end cuts off
            else:
                say("<")
                at = begin + 1
            continue
        at = match.end()
        closing, tag, attributes = match.group(1), match.group(2).lower(), match.group(3)
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
                if tag in INLINE and stack[depth][2] and stack[depth][0] not in INLINE:
                    break  # an inline element doesn't close the block around it
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in VOID:
            if tag in ("hr", "img"):
                say(" ") if tag == "hr" else None
            continue
        if tag in FOREIGN and _complete.search(attributes):
            continue
        if tag in SILENT:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = end.end() if end else n
            if tag not in INLINE:
                say(" ") if tag in ("select", "textarea", "iframe", "object") else None
            continue
        words, strong, hidden = _names(attributes) if attributes else (set(), False, False)
        weight = TAGS.get(tag, 0.0) + _name_weight(tag, words, strong) - 60.0 * hidden
        if tag in INLINE and weight > CERTAIN:
            links += tag == "a"
            stack.append((tag, stack[-1][1], False))
            continue
        if tag not in INLINE:
            flush()
            # A block ends the paragraph that is open, and the inline elements in it.
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    pop_to(depth)
                    break
                if stack[depth][0] in SCOPES:
                    break
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in CLOSES.get(tag, ()):
                    pop_to(depth)
                    break
                if stack[depth][0] in SCOPES:
                    break
        else:
            flush()
        features = () if tag in NEUTRAL else (f"tag {tag}",)
        features += tuple(sorted(f"name {w}" for w in words))
        node = page.add(stack[-1][1], tag, features, weight, None)
        links += tag == "a"
        stack.append((tag, node, True))
        if attributes.endswith("/") and tag == "path":
            pop_to(len(stack) - 1)
    pop_to(1)
    flush()
    return page


def labels(page: Page) -> list[int] | None:
    """1 for nodes in the article, 0 for others, where the markup tells; else None."""
    articles = [n for n, tag in enumerate(page.tags) if tag == "article"]
    articles = articles or [n for n, tag in enumerate(page.tags) if tag == "main"]
    if len(articles) != 1:
        return None
    out = [0] * len(page.tags)
    for node in range(1, len(out)):
        inside = node == articles[0] or out[page.parents[node]]
        out[node] = int(bool(inside) and page.weights[node] > CERTAIN)
    return out


class Model:
    """Log weights of features, and of a child having its parent's label."""

    def __init__(self, weights: dict[str, float], stay: tuple[float, float]):
        self.weights, self.stay = weights, stay

    def evidence(self, page: Page, node: int) -> float:
        """Log odds of content from the node itself."""
        learnt = sum(self.weights.get(f, 0.0) for f in page.features[node])
        return page.weights[node] + max(-1.5, min(1.5, learnt))

    def marginals(self, page: Page) -> list[float]:
        """Log odds of content of every node, by messages up and down the tree."""
        n = len(page.parents)
        own = [self.evidence(page, node) for node in range(n)]
        up = own[:]  # evidence of a node and all below it
        message = [0.0] * n
        for node in range(n - 1, 0, -1):
            message[node] = self._across(up[node]) if page.weights[node] > CERTAIN else 0.0
            up[page.parents[node]] += message[node]
        odds = up[:]
        for node in range(1, n):
            parent = page.parents[node]
            # What the parent knows without this child.
            odds[node] = up[node] + self._down(odds[parent] - message[node])
        return odds

    def _across(self, child: float) -> float:
        """Message to a parent: sum over the child's label, for parent content against not."""
        a, b = self.stay  # log odds of a content child under a content, and under another parent
        return _log_add(child + a, 0.0) - _log_one(a) - _log_add(child + b, 0.0) + _log_one(b)

    def _down(self, parent: float) -> float:
        """Message to a child: sum over the parent's label."""
        a, b = self.stay
        la, lb = _log_one(a), _log_one(b)
        return _log_add(parent + a - la, b - lb) - _log_add(parent - la, -lb)

    def text(self, source: str) -> str:
        page = parse(source)
        odds = self.marginals(page)
        return " ".join(t for n, t in enumerate(page.texts) if t is not None and odds[n] > 0)


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def _log_one(a: float) -> float:
    return _log_add(a, 0.0)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for source in batch.column("html"):
            page = parse(source.as_py() or "")
            known = labels(page)
            if known is None:
                continue
            for node in range(1, len(known)):
                counts["pair", known[page.parents[node]], known[node]] += 1
                leaf = page.texts[node] is not None
                counts["leaf" if leaf else "element", 0, known[node]] += 1
                for feature in page.features[node]:
                    counts[feature, int(leaf), known[node]] += 1
    keys = list(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.int32()),
            pa.array([k[2] for k in keys], pa.int32()),
            pa.array([counts[k] for k in keys], pa.int64()),
        ],
        names=["feature", "kind", "label", "n"],
    )


def fit(found: dict[tuple[str, int, int], int]) -> Model:
    """Potentials of counts; without any, a child mostly has its parent's label."""
    pair = lambda p, c: found.get(("pair", p, c), 0)
    stay = (
        math.log((pair(1, 1) + 99) / (pair(1, 0) + 1)),
        math.log((pair(0, 1) + 1) / (pair(0, 0) + 99)),
    )
    weights = {}
    for feature, kind, _ in list(found):
        if feature in ("pair", "leaf", "element"):
            continue
        yes, no = found.get((feature, kind, 1), 0), found.get((feature, kind, 0), 0)
        if yes + no < LEAST_SEEN:
            continue
        name = "leaf" if kind else "element"
        all_yes, all_no = found.get((name, 0, 1), 0), found.get((name, 0, 0), 0)
        weight = math.log((yes + 1) / (all_yes + 2)) - math.log((no + 1) / (all_no + 2))
        weights[feature] = max(-MOST_WEIGHT, min(MOST_WEIGHT, weight))
    inside = max(LEAST_STAY, min(MOST_STAY, stay[0]))
    outside = -max(LEAST_STAY, min(MOST_STAY, -stay[1]))
    return Model(weights, (inside, outside))


def train(pages: DataFrame, html_col: str = "html", rows: int = TRAINING_PAGES) -> Model:
    """Potentials from about ``rows`` pages; pages that don't name their article teach nothing.

    What comes to the driver is a row per feature of these pages.
    """
    source = pages.select(named(pages, html_col).cast("string").alias("html")).filter("html IS NOT NULL")
    total = source.count()
    drawn = F.pmod(F.xxhash64("html"), F.lit(1 << 30)) / float(1 << 30)
    sample = source.filter(drawn < min(1.0, rows / max(1, total)))
    counts = (
        map_arrow(sample, _count_features, "feature string, kind int, label int, n bigint")
        .groupBy("feature", "kind", "label")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    return fit({(r["feature"], r["kind"], r["label"]): r["n"] for r in counts})


def main_text(pages: DataFrame, model: Model, html: Column) -> Column:
    """The main text of a column of pages; empty if there is none."""
    for_workers(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def texts(sources: pd.Series) -> pd.Series:
        return pd.Series([shared.value.text(s or "") for s in sources], dtype=object)

    return F.pandas_udf(texts, "string")(html)


def extract(pages: DataFrame, model: Model | None = None, html_col: str = "html", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``pages`` without ``html_col`` and with its main text and the text's code points.

    Blocks of text stand in page order, joined by one space, with blanks inside a block as one
    space and character references decoded. A null page is an empty one and gives an empty text.
    Columns named as the added ones are replaced, others stay; repeated rows are each done,
    and an empty table gives an empty result.
    """
    model = model or train(pages, html_col)
    text = main_text(pages, model, named(pages, html_col).cast("string"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (html_col, text_col, size_col)]
    out = pages.select(*kept, text.alias(text_col))
    return out.withColumn(size_col, F.char_length(F.col(f"`{text_col}`")).cast("bigint"))
