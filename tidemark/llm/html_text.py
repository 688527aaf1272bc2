"""Main text of web pages: a linear-chain conditional random field over a page's leaf blocks.

A leaf block is a run of text without a block-level tag inside. Its features are the tags, classes and ids
above it and the shape of its text; the chain adds how likely main text follows main text. The field is
trained on labelled pages, which ``labelled_pages`` composes from page layouts with known parts, and decoded
by Viterbi. Nothing of the pages to be extracted serves the training.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of HTML: elements whose content is no text, that have no end tag, and that break lines.
SILENT = frozenset("script style template noscript title svg iframe object math audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td textarea tfoot th thead tr ul".split()
)
#: A start tag closes these open elements, unless one of the second set stands in between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|display\s*:\s*none", re.I)


@dataclass(frozen=True)
class Block:
    text: str
    tag: str
    above: frozenset[str]
    linked: int


def _named_parts(tag: str, attrs: str) -> frozenset[str]:
    found = {f"in:{tag}"}
    if attrs:
        for m in _NAMED.finditer(attrs):
            found |= {f"name:{p.lower()}" for p in _PART.findall(m[1] or m[2] or m[3] or "")}
        if _HIDDEN.search(attrs):
            found.add("name:hidden")
    return frozenset(found)


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order, with character references decoded and white space collapsed.

    Unclosed and misnested tags are put up with as browsers do for the common cases; a ``<`` that starts no
    tag is text.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = [("", frozenset())]
    pieces: list[str] = []
    linked = 0
    in_link = False
    names: dict[tuple[str, str], frozenset[str]] = {}

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        if pieces:
            if text := " ".join("".join(pieces).split()):
                blocks.append(Block(text, stack[-1][0], stack[-1][1], linked))
            pieces.clear()
        linked = 0

    def close(tags: set[str], within: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if page.startswith("<![CDATA[", m.start()):
                say(page[m.start() + 9 : at].removesuffix("]]>"))
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if m["end"] or m["end2"]:
            if tag == "a":
                in_link = False
            elif tag in BLOCK:
                flush()
                close({tag}, {"table"} if tag not in ("table", "html", "body") else set())
            continue
        if tag in SILENT:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            pieces.append(" ")
            continue
        if tag == "a":
            in_link = True
        elif tag in BLOCK:
            flush()
            close({"p"}, BLOCK - {"p"})
            if tag in CLOSES:
                close(*CLOSES[tag])
            if tag not in VOID:
                own = names.get((tag, attrs))
                if own is None:
                    own = names[tag, attrs] = _named_parts(tag, attrs)
                above = stack[-1][1]
                stack.append((tag, above if own <= above else above | own))
        elif tag in VOID:
            pieces.append(" ")
    flush()
    return blocks


_LEGAL = re.compile(r"©|copyright|rights reserved|cookie|privacy|subscribe|sign up|log in", re.I)


def block_features(block: Block, place: float) -> list[str]:
    """Names of the features that a block has."""
    words = block.text.count(" ") + 1
    share = block.linked / max(len(block.text), 1)
    return [
        *block.above,
        f"tag:{block.tag}",
        f"words:{min(words.bit_length(), 8)}",
        f"linked:{0 if share == 0 else 1 if share < 0.35 else 2 if share < 0.8 else 3}",
        f"stop:{block.text[-1] in '.!?:;…\"”»'}",
        f"place:{int(place * 5)}",
        f"legal:{bool(_LEGAL.search(block.text))}",
        "any",
    ]


@dataclass
class BlockField:
    """Weights of a two-label linear-chain field; label 1 is main text."""

    index: dict[str, int]
    unary: np.ndarray
    step: np.ndarray
    start: np.ndarray

    def scores(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), 2))
        n = len(blocks)
        for i, b in enumerate(blocks):
            ids = [k for f in block_features(b, i / n) if (k := self.index.get(f)) is not None]
            out[i] = self.unary[ids].sum(axis=0)
        return out

    def decode(self, scores: np.ndarray) -> list[int]:
        """The most probable labels, by Viterbi; ties go to label 0."""
        if not len(scores):
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        rows = scores.tolist()
        a, b = rows[0][0] + float(self.start[0]), rows[0][1] + float(self.start[1])
        back: list[tuple[int, int]] = []
        for x, y in rows[1:]:
            from0, from1 = int(b + s10 > a + s00), int(b + s11 > a + s01)
            back.append((from0, from1))
            a, b = x + (b + s10 if from0 else a + s00), y + (b + s11 if from1 else a + s01)
        label = int(b > a)
        labels = [label]
        for frm in reversed(back):
            label = frm[label]
            labels.append(label)
        return labels[::-1]

    def extract(self, page: str | None) -> str:
        blocks = leaf_blocks(page or "")
        return " ".join(b.text for b, y in zip(blocks, self.decode(self.scores(blocks)), strict=True) if y)


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = 8, rate: float = 0.3, l2: float = 1e-4, seed: int = 3) -> BlockField:
    """Adagrad on the conditional log likelihood, gradients by the forward-backward recursion."""
    index: dict[str, int] = {}
    rows: list[tuple[list[np.ndarray], np.ndarray]] = []
    for blocks, labels in pages:
        ids = [np.array([index.setdefault(f, len(index)) for f in block_features(b, i / len(blocks))]) for i, b in enumerate(blocks)]
        rows.append((ids, np.array(labels)))
    unary, step, start = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    g_u, g_t, g_s = np.full_like(unary, 1e-6), np.full_like(step, 1e-6), np.full_like(start, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, y = rows[k]
            n = len(y)
            if not n:
                continue
            u = np.array([unary[i].sum(axis=0) for i in ids])
            fwd, bwd = np.empty((n, 2)), np.zeros((n, 2))
            fwd[0] = u[0] + start
            for i in range(1, n):
                fwd[i] = u[i] + np.logaddexp(fwd[i - 1, 0] + step[0], fwd[i - 1, 1] + step[1])
            for i in range(n - 2, -1, -1):
                bwd[i] = np.logaddexp(step[:, 0] + u[i + 1, 0] + bwd[i + 1, 0], step[:, 1] + u[i + 1, 1] + bwd[i + 1, 1])
            z = np.logaddexp(*fwd[-1])
            d_u = np.exp(fwd + bwd - z)
            d_t = np.exp(fwd[:-1, :, None] + step + (u + bwd)[1:, None, :] - z).sum(axis=0)
            d_s = d_u[0].copy()
            d_u[np.arange(n), y] -= 1
            np.subtract.at(d_t, (y[:-1], y[1:]), 1)
            d_s[y[0]] -= 1
            flat, at = np.concatenate(ids), np.repeat(np.arange(n), [len(i) for i in ids])
            touched, inverse = np.unique(flat, return_inverse=True)
            d = np.zeros((len(touched), 2))
            np.add.at(d, inverse, d_u[at])
            d += l2 * unary[touched]
            g_u[touched] += d * d
            unary[touched] -= rate * d / np.sqrt(g_u[touched])
            g_t += d_t * d_t
            step -= rate * d_t / np.sqrt(g_t)
            g_s += d_s * d_s
            start -= rate * d_s / np.sqrt(g_s)
    return BlockField(index, unary, step, start)


# --- labelled pages ---------------------------------------------------------------------------------

_MAIN, _REST = "\x01", "\x02"


def labelled_pages(count: int = 500, seed: int = 5) -> list[tuple[str, list[int]]]:
    """Composed pages whose blocks are known: html, and per leaf block whether it is main text.

    Layouts vary in elements, names, order and prose; boilerplate carries prose of the same kind as main
    text, so a block's surroundings, not its words, tell them apart.
    """
    rng = random.Random(seed)
    syllables = "an be co da en er fo ga he in ka le mi no or pa qui re sa ti un ver wi xo ya zu ß é ñ ô".split()

    def words(a: int, b: int) -> str:
        found = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(a, b))]
        text = " ".join(found).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])
        return text.replace(" ", rng.choice([" ", " ", " ", "&nbsp;"]), 1)

    def mark(text: str, main: bool) -> str:
        return f"{_MAIN if main else _REST}{text}"

    def prose(main: bool, a: int, b: int) -> str:
        text = " ".join(words(3, 30) for _ in range(rng.randint(a, b)))
        if rng.random() < 0.3:
            spot = text.split(" ")
            k = rng.randrange(len(spot))
            spot[k] = rng.choice(["<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<br>{}", "<span class='c'>{}</span>"]).format(spot[k])
            text = " ".join(spot)
        if rng.random() < 0.06:
            text = rng.choice(["All rights reserved.", "Licensed under a free license.", "Copyright 2020 by its authors."])
        return mark(text, main)

    def links(n: int, wrap: str) -> str:
        items = "".join(f'<li><a href="/{k}">{mark(words(1, 4), False)}</a></li>' for k in range(n))
        return wrap.format(f"<ul>{items}</ul>")

    def paragraphs(main: bool, a: int, b: int) -> str:
        return "".join(f"<p>{prose(main, 1, 4)}{'</p>' if rng.random() < 0.8 else ''}" for _ in range(rng.randint(a, b)))

    def box(names: list[str]) -> str:
        kind = rng.choice(["class", "id", "class"])
        return f'<{rng.choice(["div", "div", "section", "div"])} {kind}="{rng.choice(names)}">'

    def shut(opened: str) -> str:
        return f"</{opened[1:].split(' ')[0].rstrip('>')}>"

    def part(names: list[str], elements: list[str], inner: str) -> str:
        opened = f"<{rng.choice(elements)}>" if elements and rng.random() < 0.6 else box(names)
        return f"{opened}{inner}{shut(opened)}"

    def article() -> str:
        inner = f"<h1>{mark(words(3, 12), True)}</h1>" if rng.random() < 0.85 else ""
        for _ in range(rng.choice([1, 1, 1, 2, 3])):
            if rng.random() < 0.3:
                inner += f"<h2>{mark(words(2, 8), True)}</h2>"
            inner += paragraphs(True, 1, 6)
            kind = rng.random()
            if kind < 0.12:
                inner += "<ul>" + "".join(f"<li>{prose(True, 1, 1)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
            elif kind < 0.2:
                inner += f"<blockquote>{prose(True, 1, 2)}</blockquote>"
            elif kind < 0.26:
                inner += f"<pre>{prose(True, 1, 2)}</pre>"
            elif kind < 0.32:
                inner += "<table>" + "".join("<tr>" + "".join(f"<td>{prose(True, 1, 1)}</td>" for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>"
            elif kind < 0.42:
                inner += part(["ad", "ads", "advert", "promo", "sponsored", "banner-ad"], ["aside"], paragraphs(False, 1, 2))
            elif kind < 0.48:
                inner += part(["share", "social-share", "related", "tags", "newsletter-signup"], ["aside"], links(rng.randint(2, 5), "{}"))
        wrapped = rng.choice(["<article>{}</article>"] * 5 + ["<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>', '<div id="content">{}</div>', '<div class="post-body">{}</div>', '<div class="article-text">{}</div>', '<div class="entry-content">{}</div>', '<div id="main"><div class="story">{}</div></div>'])
        return wrapped.format(inner)

    def page() -> str:
        before, after = [], []
        if rng.random() < 0.5:
            before.append(part(["header", "page-header", "masthead", "top-bar"], ["header"], f"<h2>{mark(words(1, 4), False)}</h2>" + (f"<p>{prose(False, 1, 1)}</p>" if rng.random() < 0.5 else "")))
        if rng.random() < 0.85:
            before.append(part(["nav", "menu", "navbar", "main-menu", "breadcrumb"], ["nav"], links(rng.randint(2, 9), "{}")))
        if rng.random() < 0.45:
            before.append(part(["cookie-notice", "notice", "consent", "alert", "cookies"], [], paragraphs(False, 1, 1)))
        if rng.random() < 0.6:
            (before if rng.random() < 0.6 else after).append(part(["ad", "ads", "advert", "advertisement", "promo", "sponsor", "banner"], ["aside"], rng.choice([paragraphs(False, 1, 2), prose(False, 1, 2)])))
        if rng.random() < 0.5:
            (after if rng.random() < 0.7 else before).append(part(["sidebar", "side-bar", "widget", "related", "recommended", "trending"], ["aside"], rng.choice([paragraphs(False, 1, 3), links(4, "<h3>More</h3>{}".replace("More", mark("More", False)))])))
        if rng.random() < 0.4:
            after.append(part(["comments", "comment-list", "reader-comments", "discussion"], [], "".join(f'<div class="comment"><b>{mark(words(1, 2), False)}</b>{paragraphs(False, 1, 2)}</div>' for _ in range(rng.randint(1, 5)))))
        if rng.random() < 0.35:
            after.append(f'<form action="/s"><label>{mark(words(1, 4), False)}</label><input name="q"><button>{mark(words(1, 2), False)}</button></form>')
        if rng.random() < 0.9:
            after.append(part(["footer", "page-footer", "foot", "copyright"], ["footer"], rng.choice([mark("&copy; example " + words(3, 20), False), paragraphs(False, 1, 2), links(3, "{}")])))
        rng.shuffle(before)
        body = "".join(before) + article() + "".join(after)
        if rng.random() < 0.3:
            body = f'<div class="{rng.choice(["page", "wrapper", "container", "site", "layout"])}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script></head><body>{body}</body></html>"

    found = []
    for _ in range(count):
        source = page()
        labels = [int(_MAIN in b.text) if _MAIN in b.text or _REST in b.text else 0 for b in leaf_blocks(source)]
        found.append((source.replace(_MAIN, "").replace(_REST, ""), labels))
    return found


_FIELD: list[BlockField] = []


def trained_field() -> BlockField:
    """The field trained on ``labelled_pages``, once per process."""
    if not _FIELD:
        _FIELD.append(train([(leaf_blocks(p), y) for p, y in labelled_pages()]))
    return _FIELD[0]


def extract_text(pages: DataFrame, field: BlockField | None = None) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    A null or empty page, or one without main text, gives the empty string. Whole pages are parsed, however
    long. Repeated rows give repeated results, an empty table an empty one; other columns are ignored. One
    pass without a shuffle.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field or trained_field())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            text = [field.extract(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], names=["page_id", "url", "text"])

    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])
    found = pages.select("page_id", "url", "html").mapInArrow(run, schema)
    return found.withColumn("n_chars", F.length("text").cast("long"))
