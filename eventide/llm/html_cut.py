"""Main text of web pages by minimum-cut block labelling.

A page becomes a row of text blocks. A classifier gives each block the cost of
calling it content or boilerplate; these costs are the capacities to the two
terminals. Neighbouring blocks, and blocks with the same container in the DOM,
are joined by smoothness edges: separating them costs their weight. The
minimum cut (Dinic's maximum flow on the residual excess) is the cheapest
labelling of the page, and the source side is its main text.

The classifier is logistic: fixed priors for what the markup says (elements,
roles, class and id words), plus weights of text features learnt here from a
bounded sample of pages (``MAX_FIT`` smallest id hashes) whose markup marks
blocks as article or as page furniture, shrunk towards ``PRIOR``. Elements are a
verdict; words of classes and ids are evidence, which adds up over nested
elements and which prose can outweigh. Forms, dialogs and roles are a verdict
unless the element holds most of the page's prose, as a form around a whole page
does; then they say nothing. Containers of reader comments are a verdict where
the page has an article, or prose, beside them. A page is handled within one
task; Spark spreads the pages.

Rules of the text: character references are decoded, white space (a line break
element included) inside a block becomes one space, blocks are trimmed, empty
ones dropped, and the kept ones joined by a newline. Scripts, styles, comments,
markup, form controls, drawings and embedded media are never text; formulas are.
An embedded element that is never closed ends with its parent, and what follows
its start counts as the parent's. A page cut off in a tag keeps the text before
it.

Defined cases: null or empty html gives the empty text; repeated pages get
equal texts; long pages are read whole; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_ids

MAX_FIT = 2000
SHRINK, STEPS = 20.0, 200
NEXT, SAME_PARENT = 0.6, 0.9         # smoothness: adjacent blocks, same container

# Element names and words of class, id and role attributes.
BLOCK_TAGS = frozenset("""
    address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr
    html iframe legend li main menu nav ol option p pre section select summary table tbody td
    tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("""
    area base br col embed hr img input link meta param source track wbr""".split())
RAW_TAGS = frozenset("script style textarea title".split())       # no markup up to the end tag
MUTE_TAGS = frozenset("""
    noscript template svg iframe object select button canvas audio video annotation
    annotation-xml""".split())
CONTROL_TAGS = frozenset("button select option".split())
FURNITURE_TAGS = frozenset("nav footer aside".split())
WRAPPER_TAGS = frozenset("form menu dialog fieldset".split())
FURNITURE_ROLES = frozenset("""
    navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar
    toolbar note status""".split())
FURNITURE_WORDS = frozenset("""
    ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment
    comments commentlist consent cookie cookies copyright discussion disqus dropdown footer form
    gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice
    notification overlay pager pagination popup promo promoted promotion recommended related
    replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe
    subscription tags toolbar topbar widget widgets""".split())
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies respond".split())
ARTICLE_WORDS = frozenset("article content entry main post story".split())
# has-sidebar, no-sidebar, header-fixed: they say something of the page, not of the element
BEFORE = frozenset("has have no not with without hide show is".split())
AFTER = frozenset("fixed sticky none off on hidden disabled enabled open closed".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

FURNITURE, ARTICLE, MAYBE = -8.0, 5.0, 1.5     # log odds that the markup gives
WRAPPER, TALK = "wrapper", "talk"              # verdicts that depend on the rest of the page
PROSE_WORDS, BESIDE = 8, 0.1   # words of a block of prose; share of prose that is an article's
# of a class or id word; at most, of nested ones; more where the page has its article elsewhere
WORDS, MOST_WORDS, ELSEWHERE = -2.5, -6.0, -2.0


def _class_words(value: str, inside_article: bool) -> float | str | None:
    """Log odds that a class or id attribute gives, or that it names comments."""
    found = None
    for name in value.split():
        words = [x.lower() for x in _WORD.findall(name)]
        if words and ARTICLE_WORDS.issuperset(words):
            return MAYBE
        for k, word in enumerate(words):
            if word in FURNITURE_WORDS:
                if not (words[k - 1:k] and words[k - 1] in BEFORE
                        or words[k + 1:] and words[k + 1] in AFTER
                        or word == "header" and inside_article):
                    found = TALK if word in COMMENT_WORDS or found == TALK else WORDS
                break
        else:
            if found is None and ARTICLE_WORDS.intersection(words):
                found = MAYBE
    return found


def _markup(tag: str, attributes: str, inside_article: bool) -> float | str | None:
    """Log odds that an element's own markup gives its blocks, ``WRAPPER`` or
    ``TALK``; None: says nothing."""
    if tag in FURNITURE_TAGS or (tag == "header" and not inside_article):
        return FURNITURE
    found = WRAPPER if tag in WRAPPER_TAGS else None
    if tag in ("article", "main"):
        found = ARTICLE
    if "=" in attributes or "hidden" in attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                says = _class_words(value, inside_article)
                if says == MAYBE and found is None:
                    found = MAYBE
                elif says == TALK and tag not in ("main", "body", "html"):
                    found = TALK
                elif says == WORDS and tag not in ("article", "main", "body", "html") \
                        and found not in (MAYBE, TALK, WRAPPER):
                    found = WORDS
            elif name == "role":
                if value.lower() in FURNITURE_ROLES:
                    found = WRAPPER
                elif value.lower() in ("main", "article") and found != TALK:
                    found = ARTICLE
            elif ((name == "style" and _HIDDEN.search(value.lower()))
                  or (name == "aria-hidden" and value.lower() == "true")):
                return FURNITURE
        if re.search(r"(?:^|\s)hidden(?:\s|$|=)", attributes):
            return FURNITURE
    return found


class Block:
    __slots__ = ("text", "linked", "tag", "prior", "parent", "inside", "wrappers", "talk", "clear")

    def __init__(self, text: str, linked: int, tag: str, prior: float, parent: int, inside: bool,
                 wrappers: tuple[int, ...] = (), talk: bool = False):
        self.text, self.linked, self.tag, self.prior, self.parent = text, linked, tag, prior, parent
        self.inside, self.wrappers, self.talk = inside, wrappers, talk
        # its own elements' verdict, whatever the rest of the page holds
        self.clear = prior in (FURNITURE, ARTICLE) and not wrappers and not talk

    @property
    def prose(self) -> int:
        return len(self.text) - self.linked if self.text.count(" ") + 1 >= PROSE_WORDS else 0


def judge(blocks: list[Block]) -> None:
    """The verdicts that depend on where the page has its prose."""
    open_blocks = [b for b in blocks if b.prior != FURNITURE]
    total = sum(b.prose for b in open_blocks)
    held: dict[int, int] = {}
    for b in open_blocks:
        for w in b.wrappers:
            held[w] = held.get(w, 0) + b.prose
    for b in open_blocks:
        if any(2 * held[w] <= total for w in b.wrappers):
            b.prior = FURNITURE
    talk = [b for b in open_blocks if b.talk and b.prior != FURNITURE]
    rest = [b for b in open_blocks if not b.talk and b.prior != FURNITURE]
    if any(b.prior in (MAYBE, ARTICLE) and b.prose for b in rest) or (
            sum(b.prose for b in rest) > BESIDE * sum(b.prose for b in talk)):
        for b in talk:
            b.prior = FURNITURE


def page_blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, with what their markup says."""
    blocks: list[Block] = []
    # open elements: tag, serial number, log odds in force, wrappers, among comments
    stack: list[tuple[str, int, float, tuple[int, ...], bool]] = [("", 0, 0.0, (), False)]
    before: dict[int, tuple[int, list[str], int]] = {}     # state at the start of mute elements
    parts: list[str] = []
    linked = serial = links = articles = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split()) if parts else ""
        if text:
            k = len(stack) - 1
            while k > 0 and stack[k][0] not in BLOCK_TAGS:
                k -= 1
            tag = stack[k][0]
            # paragraphs, headings and items hang on their container
            parent = stack[k - 1][1] if k and tag in _LEAVES else stack[k][1]
            prior = FURNITURE if tag in CONTROL_TAGS else stack[-1][2]
            blocks.append(Block(text, min(linked, len(text)), tag, prior, parent, articles > 0,
                                *stack[-1][3:]))
        parts, linked = [], 0

    def close(k: int) -> None:
        nonlocal links, articles
        for tag, *_ in stack[k:]:
            links -= tag == "a"
            articles -= tag in ("article", "main")
        del stack[k:]

    while at < end:
        m = _TOKEN.search(page, at)
        upto = m.start() if m else end
        if upto > at:
            run = page[at:upto]
            if "&" in run:
                run = html.unescape(run)
            parts.append(run)
            if links:
                linked += len(run)
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        closing, attributes = (m[1] or m[4] or ""), (m[3] or m[6] or "")
        if tag in BLOCK_TAGS:
            flush()
        elif tag == "br":
            parts.append(" ")
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    if tag in MUTE_TAGS:
                        kept, parts, linked = before[stack[k][1]]
                        del blocks[kept:]
                    close(k)
                    break
                if tag not in BLOCK_TAGS and tag not in MUTE_TAGS and stack[k][0] in BLOCK_TAGS:
                    break          # a stray inline end tag does not close blocks
            continue
        if tag in RAW_TAGS:
            if not attributes.endswith("/"):
                over = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = over.end() if over else end
            continue
        if tag in VOID_TAGS or attributes.endswith("/"):
            continue
        if tag in BLOCK_TAGS:
            for k in range(len(stack) - 1, 0, -1):
                open_tag = stack[k][0]
                if open_tag == "p" or (open_tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th")):
                    close(k)
                    break
                if open_tag in BLOCK_TAGS or open_tag in MUTE_TAGS:
                    break
        serial += 1
        if tag in MUTE_TAGS:
            before[serial] = len(blocks), parts[:], linked
        own = _markup(tag, attributes, articles > 0)
        force, wrappers, talk = stack[-1][2:]
        if own == WRAPPER:
            wrappers = (*wrappers, serial)
        elif own in (WORDS, TALK):
            talk, own = talk or own == TALK, WORDS
            force = force if force == FURNITURE else max(min(force, 0.0) + own, MOST_WORDS)
        elif own == MAYBE and force < 0:
            force = force if force == FURNITURE else force + own
        elif own is not None:
            force = own
            wrappers = () if own == ARTICLE else wrappers
        links += tag == "a"
        articles += tag in ("article", "main")
        stack.append((tag, serial, force, wrappers, talk))
    flush()
    judge(blocks)
    article = sum(len(b.text) for b in blocks if b.prior == ARTICLE)
    doubted = [b for b in blocks if FURNITURE < b.prior < 0]
    much = article > sum(len(b.text) for b in doubted if b.inside)
    for b in doubted:
        if article and (much or not b.inside):
            b.prior = max(b.prior + ELSEWHERE, MOST_WORDS)
    return blocks


_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li td th tr dt dd blockquote pre figcaption".split())

# ---- classifier --------------------------------------------------------------

FEATURES = ("bias", "log words", "link share", "sentence marks", "heading", "paragraph", "item",
            "letters", "few words")
PRIOR = np.array([-1.5, 0.9, -4.0, 0.8, 0.8, 0.8, -0.8, 0.0, -0.8])


def features(blocks: list[Block]) -> np.ndarray:
    out = np.zeros((len(blocks), len(FEATURES)))
    for k, b in enumerate(blocks):
        n, words = len(b.text), b.text.count(" ") + 1
        marks = b.text.count(". ") + b.text.count(", ") + (b.text[-1] in ".!?")
        out[k] = (1, np.log1p(words), b.linked / n, min(marks, 5) / 5, b.tag[:1] == "h" and b.tag[1:].isdigit(),
                  b.tag == "p", b.tag in ("li", "dt", "dd", "td", "th"),
                  sum(map(str.isalpha, b.text)) / n, words < 5)
    return out


def _fit(batches):
    """Shrunk logistic weights from blocks whose markup is clear; one bounded task."""
    x, y = [], []
    for batch in batches:
        for page in batch.column(0).to_pylist():
            blocks = [b for b in page_blocks(page or "") if b.clear]
            if blocks:
                x.append(features(blocks))
                y += [b.prior > 0 for b in blocks]
    w = PRIOR.copy()
    if len(set(y)) == 2:
        x, y = np.concatenate(x), np.array(y, float)
        for _ in range(STEPS):       # damped Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + SHRINK * (w - PRIOR)
            hess = (x * (p * (1 - p))[:, None]).T @ x + SHRINK * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
    yield pa.RecordBatch.from_pydict({"weights": pa.array([w.tolist()], pa.list_(pa.float64()))})


# ---- minimum cut -------------------------------------------------------------

def source_side(excess: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut of a graph whose node i has ``excess[i]`` more capacity from
    the source than to the sink; edges are undirected. True: on the source side."""
    n, tiny = len(excess), 1e-9
    excess = list(excess)
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, weight in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        cap += [weight, weight]
    while True:
        level = [0 if e > tiny else -1 for e in excess]
        queue = [i for i in range(n) if level[i] == 0]
        open_sink = False
        for u in queue:
            if excess[u] < -tiny:
                open_sink = True
            for e in out[u]:
                v = to[e]
                if cap[e] > tiny and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        if not open_sink:
            return [x >= 0 for x in level]
        at = [0] * n
        for s in range(n):
            path: list[int] = []
            u = s
            while excess[s] > tiny:
                if excess[u] < -tiny:
                    flow = min([excess[s], -excess[u], *(cap[e] for e in path)])
                    excess[s] -= flow
                    excess[u] += flow
                    for e in path:
                        cap[e] -= flow
                        cap[e ^ 1] += flow
                    path, u = [], s
                    continue
                while at[u] < len(out[u]):
                    e = out[u][at[u]]
                    if cap[e] > tiny and level[to[e]] == level[u] + 1:
                        break
                    at[u] += 1
                if at[u] < len(out[u]):
                    path.append(out[u][at[u]])
                    u = to[path[-1]]
                elif path:
                    level[u] = -1
                    u = to[path.pop() ^ 1]
                    at[u] += 1
                else:
                    break


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and between successive blocks of a container."""
    edges, last = [], {}
    for k, b in enumerate(blocks):
        if k:
            edges.append((k - 1, k, NEXT))
        if b.parent in last:
            edges.append((last[b.parent], k, SAME_PARENT))
        last[b.parent] = k
    return edges


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = page_blocks(page)
    if not blocks:
        return ""
    score = np.clip(features(blocks) @ weights, -4, 4)
    excess = [b.prior + s if b.prior != ARTICLE else max(b.prior + s, 1.0)
              for b, s in zip(blocks, score.tolist())]
    keep = source_side(excess, smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    known = pages.where(F.col(html_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    chosen = bounded_ids(known.select("id").distinct(), MAX_FIT)
    sample = (known.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("html").alias("html"))
              .select("html"))
    fitted = sample.coalesce(1).mapInArrow(_fit, "weights array<double>").collect()
    weights = np.array(fitted[0].weights) if fitted else PRIOR

    def texts(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p or "", weights) for p in column.to_pylist()], pa.string())

    text = F.arrow_udf(texts, "string")(F.col(html_col))
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
