"""Main-text extraction: a bidirectional LSTM in numpy labels every leaf block of a page.

A page becomes the sequence of its text blocks: text between block-level tags, with references decoded and white
space collapsed. A block's input is its tag path (tags, hashed, and the words of class, id and role of its ancestors that usual layouts
have; other names are not seen), its words (all of them, hashed), and a few measures (length, share of linked text, punctuation, place). The network
reads the sequence in both directions, so each label rests on the whole document. Blocks labelled as main text are
joined by one space; scripts, styles and other raw elements never make blocks.

The network is trained here, with fixed seeds, on pages generated from a grammar of usual layouts (``training_page``),
whose blocks are known to be article or not.

Cases: null or empty html, or pages without main text, give an empty text; broken markup (unclosed or stray tags and
quotes, cut-off comments) is read to the end, in linear time; raw elements (``RAW``) are skipped to their end tag or
the page's end; drawings and closed templates hold no text, other elements (formulas, fallbacks of media) do; repeated rows get equal results; an empty table
gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import html as references
import inspect
import io
import random
import re
import sys
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallystone.llm import text as tx
from tallystone.llm.storage import file_system, settle, shared_dir

HIDDEN = 24

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript title iframe textarea noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Block elements that never belong to a drawing.
BREAKS_OUT = frozenset("article aside blockquote body div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table ul".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}

#: A tag whose quoted values hold no angle brackets; ``_tag_end`` finds the ends of others.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_PLAIN = re.compile(r"[^>\"']*+")
_COMMENT_END = re.compile("--!?>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_TOKEN = re.compile(r"[a-z]+|[0-9]+")


# What usual layouts call their parts.
PARTS = {
    "nav": ["nav", "ul.menu", "div.navbar", "div#navigation", "ul.nav", "div.breadcrumbs", "div.topnav", "div.main-menu", "nav.pagination", "div.tabs", "ol.breadcrumb"],
    "header": ["header", "div.header", "div#masthead", "div.site-header", "div.topbar", "div.branding", "header.page-header", "div#header"],
    "footer": ["footer", "div.footer", "div#footer", "div.site-footer", "div.copyright", "div.bottom", "footer.colophon", "div.legal"],
    "sidebar": ["aside", "div.sidebar", "div#sidebar", "div.widget", "aside.related", "div.related-posts", "div.recommended", "div.trending", "section.most-read", "div.rail", "div.tags"],
    "notice": ["div.cookie", "div.cookie-notice", "div.consent", "div.gdpr", "div.notice", "div.alert", "div.warning", "div.newsletter", "div.popup", "div.modal", "div.subscribe", "p.disclaimer", "div.paywall", "div#cookie-banner", "div.message"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "div.banner", "div.promo", "section.promotion", "p.ad", "div#ad-top", "aside.ad", "div.sponsor", "div.dfp"],
    "form": ["form", "form.search", "div.login", "form#signup", "form.contact", "div.search-box", "fieldset"],
    "comments": ["section#comments", "div.comments", "ol.comment-list", "div#disqus", "ul.commentlist", "div.comment", "div.replies", "section.responses", "div.discussion", "div.reviews"],
    "share": ["div.share", "ul.social", "div.social-links", "div.byline-share", "div.follow"],
}
ANYWHERE = ["page", "site", "main", "top", "most", "list", "box", "message", "post", "posts", "read", "bottom"]
ARTICLES = ["article", "main>article", "div.content", "div.post-body", "div#main-content", "div.entry-content", "section.story", "main", "div.article", "div#content>div.post", "article.post>div.entry", "div.container>div.row>article", "div.text", "body", "div.wrapper>div.main", "section.article-body"]


def _known_names() -> dict[str, int]:
    """The words of class, id and role that are inputs of their own; any other name says nothing."""
    specs = [spec for found in PARTS.values() for spec in found] + ARTICLES
    words = {w for spec in specs for w in _TOKEN.findall(" ".join(re.findall(r"[.#]([\w-]+)", spec)).lower())}
    return {w: i for i, w in enumerate(sorted(words))}


NAMES = _known_names()
#: Inputs of a block: hashed tags (the last one, and all), known names, hashed words, measures.
TAGS, WORDS, MEASURES = 32, 24, 8
PATH = 2 * TAGS + len(NAMES)


@lru_cache(50_000)
def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


class Element:
    """An open element as a leaf of the tree of its ancestors; pages of one layout share these."""

    __slots__ = ("children", "name", "names", "parent", "vector")

    def __init__(self, parent: Element | None, name: str, names: tuple[str, ...]):
        self.parent, self.name, self.names = parent, name, names
        self.children: dict[tuple, Element] = {}
        self.vector: np.ndarray | None = None

    def path(self) -> np.ndarray:
        """The last element's tag, the bag of all ancestors' tags, and how often known names occur among theirs."""
        todo, node = [], self
        while node.vector is None and node.parent is not None:
            todo.append(node)
            node = node.parent
        if node.vector is None:
            node.vector = np.zeros(PATH, np.float32)
        for child in reversed(todo):
            out = child.parent.vector.copy()
            out[:TAGS] = 0
            out[_hash("last " + child.name) % TAGS] = 1
            out[TAGS + _hash("tag " + child.name) % TAGS] = 1
            for token in child.names:
                if token in NAMES:
                    out[2 * TAGS + NAMES[token]] += 1
            child.vector = out
        return self.vector


class Elements:
    """All elements seen, until they are more than ``limit``."""

    def __init__(self, limit: int = 20_000):
        self.limit, self.count, self.root = limit, 0, Element(None, "", ())

    def page(self) -> Element:
        if self.count > self.limit:
            self.count, self.root = 0, Element(None, "", ())
        return self.root

    def child(self, parent: Element, name: str, names: tuple[str, ...]) -> Element:
        found = parent.children.get((name, names))
        if found is None:
            found = parent.children[name, names] = Element(parent, name, names)
            self.count += 1
        return found


_elements = Elements()


def _tag_end(page: str, at: int, dead: set[int]) -> int:
    """Place of the ``>`` that ends the tag whose name ends at ``at``: the first outside quotes, or else the first.

    ``dead`` holds places behind quotes from which no end was found before, so nothing is read twice.
    """
    seen, place = [], _PLAIN.match(page, at).end()
    while place < len(page) and page[place] != ">":
        close = page.find(page[place], place + 1)
        if close < 0 or close in dead:
            break
        seen.append(close)
        place = _PLAIN.match(page, close + 1).end()
    else:
        if place < len(page):
            return place
    dead.update(seen)
    return page.find(">", at)


def leaf_blocks(page: str) -> list[tuple[str, Element, float]]:
    """Text, innermost block element and share of linked characters of each block of a page, in order.

    Time and memory are linear in the page's length, whatever its markup.
    """
    blocks: list[tuple[str, Element, float]] = []
    # open elements; of those that aren't inline also the shared nodes; and how many there are of each name
    stack: list[str] = []
    nodes: list[Element] = [_elements.page()]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    dead: set[int] = set()
    raw_end: dict[str, int] = {}
    linked, n, at, text_from = 0, len(page), 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((text, nodes[-1], min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def add(text: str, decode: bool = True) -> None:
        nonlocal linked
        if text and not opened["template"] and not opened["svg"]:
            if decode and "&" in text:
                text = references.unescape(text)
            parts.append(text)
            if opened["a"]:
                linked += len(text.strip())

    def pop() -> str:
        name = stack.pop()
        opened[name] -= 1
        if name not in INLINE:
            nodes.pop()
        return name

    def closes_later(name: str, start: int) -> int:
        """Place behind the end tag of this name, -1 if there is none."""
        found = raw_end.get(name, 0)
        if 0 <= found <= start:
            m = _end_tag(name).search(page, start)
            found = raw_end[name] = m.end() if m else -1
        return found

    while True:
        at = page.find("<", at)
        if at < 0:
            break
        m = _TAG.match(page, at)
        if m is None:
            head = page[at : at + 9]
            if head.startswith(("<!", "<?")):
                add(page[text_from:at])
                if head.startswith("<!--"):
                    if head.startswith(("<!-->", "<!--->")):
                        at = page.index(">", at) + 1
                    else:
                        end = _COMMENT_END.search(page, at + 4)
                        at = end.end() if end else n
                elif head == "<![CDATA[":
                    end = page.find("]]>", at)
                    add(page[at + 9 : end if end >= 0 else n], decode=False)
                    at = end + 3 if end >= 0 else n
                else:
                    end = page.find(">", at)
                    at = end + 1 if end >= 0 else n
                text_from = at
                continue
            m = _NAME.match(page, at)
            end = _tag_end(page, m.end(), dead) if m else -1
            if end < 0:
                if m and page.find(">", at) < 0:
                    break  # no tag can end any more
                at += 1
                continue
            closing, name, rest, after = m.group(1), m.group(2), page[m.end() : end], end + 1
        else:
            closing, name, rest, after = m.group(1), m.group(2), m.group(3), m.end()
        add(page[text_from:at])
        at = text_from = after
        name = name.lower()
        inline = name in INLINE
        if closing:
            if not inline:
                flush()
            if name == "br":
                parts.append(" ")
            if opened[name]:
                while pop() != name:
                    pass
            continue
        whole = rest.rstrip().endswith("/")
        if name in RAW and not whole:
            if name not in ("iframe", "textarea"):
                flush()
            end = closes_later(name, at)
            at = text_from = end if end >= 0 else n
            continue
        if name == "br":
            parts.append(" ")
            continue
        if not inline:
            flush()
            while opened["svg"] and name in BREAKS_OUT:  # as in browsers: a drawing ends where the page goes on
                pop()
            while len(nodes) > 1 and name in CLOSED_BY.get(nodes[-1].name, ()):
                while stack[-1] in INLINE:
                    pop()
                pop()
        if name in VOID or whole and name not in ("p", "div", "a"):
            continue
        if name == "template" and closes_later(name, at) < 0:
            continue
        stack.append(name)
        opened[name] += 1
        if not inline:
            names = []
            for a in _ATTRIBUTE.finditer(rest) if "=" in rest else ():
                names += _TOKEN.findall((a.group(2) or a.group(3) or a.group(4) or "").lower())
            nodes.append(_elements.child(nodes[-1], name, tuple(names)))
    add(page[text_from:])
    flush()
    return blocks


@lru_cache(64)
def _end_tag(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\b[^>]*>", re.I)


def features(pages: list[list[tuple[str, Element, float]]]) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of all blocks, page by page, and the pages' offsets."""
    counts = np.array([len(p) for p in pages], np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    blocks = [b for p in pages for b in p]
    n = len(blocks)
    out = np.zeros((n, PATH + WORDS + MEASURES), np.float32)
    if not n:
        return out, first
    texts = [b[0] for b in blocks]
    for i, b in enumerate(blocks):
        out[i, :PATH] = b[1].path()
    np.minimum(out[:, :PATH], 2, out=out[:, :PATH])
    raw, offsets = tx.utf8(pa.array(texts, pa.large_string()))
    words = tx.Words(tx.ascii_lower(raw), offsets, tx.ALNUM)
    hashes = words.hashes()
    bucket = (hashes % np.uint64(WORDS)).astype(np.int64)
    sign = np.where((hashes >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    bags = np.bincount(words.text_of() * WORDS + bucket, sign, n * WORDS).reshape(n, WORDS)
    out[:, PATH : PATH + WORDS] = bags / np.sqrt(1 + words.counts())[:, None]
    many = np.maximum(1, words.counts())
    length = np.diff(offsets)
    digits = np.concatenate([[0], np.cumsum((raw >= 48) & (raw <= 57))])
    marks = np.concatenate([[0], np.cumsum(np.isin(raw, np.frombuffer(b".!?,;:", np.uint8)))])
    place = np.arange(n) - np.repeat(first[:-1], counts)
    total = np.repeat(counts, counts)
    measures = out[:, PATH + WORDS :]
    measures[:, 0] = np.log1p(length) / 6
    measures[:, 1] = [b[2] for b in blocks]
    measures[:, 2] = np.minimum(1, (marks[offsets[1:]] - marks[offsets[:-1]]) / many)
    measures[:, 3] = (digits[offsets[1:]] - digits[offsets[:-1]]) / np.maximum(1, length)
    measures[:, 4] = place / np.maximum(1, total - 1)
    measures[:, 5] = np.log1p(total) / 5
    measures[:, 6] = [("©" in t) or ("(c)" in t) for t in texts]
    measures[:, 7] = 1
    return out, first


def _steps(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences, the longest first: order, lengths, and how many are longer than t."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    lengths = counts[order]
    longest = int(lengths[0]) if len(lengths) else 0
    return order, lengths, np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Direction:
    """An LSTM layer: weights of the input, of the hidden state, and biases, for input, forget, output gates and cell."""

    w: np.ndarray
    u: np.ndarray
    b: np.ndarray

    def run(self, x: np.ndarray, rows: list[np.ndarray], keep: bool = False):
        """Hidden state of every block; ``rows[t]``: the rows at step t, sequences in a fixed order, ended ones left out."""
        hidden = self.u.shape[0]
        pre = x @ self.w + self.b
        out = np.zeros((len(x), hidden), np.float32)
        h = c = np.zeros((len(rows[0]) if rows else 0, hidden), np.float32)
        saved = []
        for at in rows:
            h, c = h[: len(at)], c[: len(at)]
            z = pre[at] + h @ self.u
            gates = _sigmoid(z[:, : 3 * hidden])
            i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
            g = np.tanh(z[:, 3 * hidden :])
            before_h, before_c = h, c
            c = f * c + i * g
            s = np.tanh(c)
            h = o * s
            out[at] = h
            if keep:
                saved.append((at, i, f, o, g, s, before_h, before_c))
        return (out, saved) if keep else out

    def back(self, x: np.ndarray, saved: list, grad: np.ndarray) -> list[np.ndarray]:
        hidden = self.u.shape[0]
        pre = np.zeros((len(x), 4 * hidden), np.float32)
        du = np.zeros_like(self.u)
        dh = dc = np.zeros((0, hidden), np.float32)
        for at, i, f, o, g, s, before_h, before_c in reversed(saved):
            own = grad[at]
            own[: len(dh)] += dh
            cell = own * o * (1 - s * s)
            cell[: len(dc)] += dc
            z = np.concatenate([cell * g * i * (1 - i), cell * before_c * f * (1 - f), own * s * o * (1 - o), cell * i * (1 - g * g)], 1)
            pre[at] = z
            du += before_h.T @ z
            dh, dc = z @ self.u.T, cell * f
        return [x.T @ pre, du, pre.sum(0)]


@dataclass
class Model:
    forward: Direction
    backward: Direction
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.w, self.forward.u, self.forward.b, self.backward.w, self.backward.u, self.backward.b, self.out, self.bias]

    @staticmethod
    def rows(first: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        order, lengths, active = _steps(first)
        begin, end = first[:-1][order], first[1:][order] - 1
        return [begin[:n] + t for t, n in enumerate(active)], [end[:n] - t for t, n in enumerate(active)]

    def margins(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        ahead, behind = self.rows(first)
        both = np.concatenate([self.forward.run(x, ahead), self.backward.run(x, behind)], 1)
        return both @ self.out + self.bias


def _new_model(rng: np.random.Generator, inputs: int, hidden: int) -> Model:
    def direction() -> Direction:
        b = np.zeros(4 * hidden, np.float32)
        b[hidden : 2 * hidden] = 1
        scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        return Direction(scale(inputs, 4 * hidden), scale(hidden, 4 * hidden), b)

    return Model(direction(), direction(), (rng.standard_normal(2 * hidden) * 0.1).astype(np.float32), np.zeros(1, np.float32))


_MARK = ""

def _open(spec: str, name: str | None = None) -> tuple[str, str]:
    """Opening and closing tags of a path like ``main>div.post#x``; ``name`` stands for all its names, an empty one for none."""
    before, after = "", ""
    for part in spec.split(">"):
        tag, kind, own = re.fullmatch(r"(\w+)([.#]?)([\w-]*)", part).groups()
        kind, own = (kind, own) if name is None else (kind if name else "", name)
        attribute = {"": "", ".": f' class="{own}"', "#": f' id="{own}"'}[kind]
        before += f"<{tag}{attribute}>"
        after = f"</{tag}>{after}"
    return before, after


def training_page(rng: random.Random) -> str:
    """A page of a usual layout; the texts of its article carry a mark that features never see."""
    syllables = ["".join(rng.choice("bcdfghjklmnprstvwzßçñ") * rng.randint(0, 1) + rng.choice("aeiouéèöüáí") + rng.choice(["", "n", "r", "s", "nt", "th"]) for _ in range(1)) for _ in range(30)]

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def sentence(low: int = 3, high: int = 18) -> str:
        shout = rng.random() < 0.03
        words = [word() + ("," if rng.random() < 0.1 else "") for _ in range(rng.randint(low, high))]
        text = " ".join(words).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])
        return text.upper() if shout else text

    def prose(high: int = 6) -> str:
        return rng.choice([" ", " ", "\n"]).join(sentence() for _ in range(rng.randint(1, high)))

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{word()}">{sentence(1, 4)}</a></li>' for _ in range(n))

    def other() -> str:
        """A name that no layout is known by, or a word that many use for anything."""
        return "-".join(rng.choice(ANYWHERE) if rng.random() < 0.25 else word() for _ in range(rng.randint(1, 2)))

    def junk(kind: str, inside: bool = False) -> str:
        before, after = _open(rng.choice(PARTS[kind]))
        if kind in ("nav", "share", "form") and rng.random() < 0.2:
            before, after = _open(rng.choice(PARTS[kind]), rng.choice(["", other()]))
        if kind in ("nav", "share"):
            body = links(rng.randint(1, 8))
            body = body if before.startswith(("<ul", "<ol")) else rng.choice([f"<ul>{body}</ul>", " | ".join(f'<a href="#">{word()}</a>' for _ in range(rng.randint(1, 7)))])
        elif kind == "header":
            body = f"<div>{rng.choice([word(), sentence(1, 4)])}</div>" + rng.choice(["", f"<p>{sentence(2, 9)}</p>", f"<h1>{sentence(1, 4)}</h1>", f"<nav><ul>{links(4)}</ul></nav>"])
        elif kind == "footer":
            body = rng.choice([f"&copy; {word()}.example &middot; {prose(3)}", f"<p>&copy; 20{rng.randint(10, 29)} {word()}</p><p>{prose(3)}</p>", f"<ul>{links(4)}</ul><p>{prose(2)}</p>", prose(4)])
        elif kind == "form":
            body = f'<label>{word()}</label><input type="text"><select><option>{word()}<option>{word()}</select><button>{sentence(1, 3)}</button><p>{prose(1)}</p>'
        elif kind == "comments":
            body = f"<h3>{sentence(1, 3)}</h3>" + "".join(rng.choice([f'<div class="comment"><span class="author">{word()}</span><p>{prose(5)}</p></div>', f"<li><b>{word()}</b><p>{prose(5)}</p></li>", f"<p>{prose(6)}</p>"]) for _ in range(rng.randint(1, 5)))
        elif kind == "sidebar":
            body = rng.choice([f"<h3>{sentence(1, 4)}</h3><ul>{links(5)}</ul>", f"<h4>{sentence(1, 4)}</h4><p>{prose(3)}</p>", f"<p>{prose(3)}</p>", prose(2)])
        else:
            body = rng.choice([prose(2), prose(3), f"<p>{prose(3)}</p>", f'<p>{prose(1)} <a href="#">{word()}</a></p><button>{word()}</button>', sentence()])
        return before + body + after

    def own() -> str:
        m = _MARK
        kind = rng.random()
        if kind < 0.62:
            inner = prose(rng.choice([1, 3, 8, 20]))
            if rng.random() < 0.3:
                inner = rng.choice([f"<b>{inner}</b>", f'{inner} <a href="/x">{sentence(1, 5)}</a> {sentence()}', f"<em>{word()}</em> {inner}", f"<b>{inner}<br>", f"{inner}<br>{prose(2)}", f'<a href="/y">{inner}</a>'])
            return rng.choice([f"<p>{m}{inner}</p>", f"<p>{m}{inner}</p>", f"<p>{m}{inner}", f"<div>{m}{inner}</div>"])
        if kind < 0.72:
            return f"<h{rng.randint(2, 4)}>{m}{sentence(1, 8)}</h2>"
        if kind < 0.82:
            return "<ul>" + "".join(f"<li>{m}{sentence(1, 14)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote><p>{m}{prose(4)}</p></blockquote>"
        if kind < 0.93:
            return "<table>" + "".join(f"<tr><td>{m}{word()}</td><td>{m}{sentence(1, 5)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>"
        if kind < 0.97:
            return f"<figure><img src=x><figcaption>{m}{sentence(2, 10)}</figcaption></figure>"
        return f"<pre>{m}{prose(2)}</pre>"

    kinds = list(PARTS)
    page = rng.choice(["<!DOCTYPE html>", ""]) + "<html><head><title>" + sentence(2, 8) + "</title><style>p{}</style></head><body>"
    if rng.random() < 0.12:  # a page of little else: bare text, a few paragraphs or blocks of any names
        if rng.random() < 0.3:
            page = ""
        if rng.random() < 0.3:
            page += junk(rng.choice(["nav", "header", "notice", "advert"]))
        few = rng.randint(1, 4)
        kind = rng.choice(["text", "p", "div", "own"])
        for _ in range(1 if kind == "text" else few):
            inner = f"{_MARK}{rng.choice([prose(2), sentence(1, 6), word()])}"
            page += {"text": inner, "p": f"<p>{inner}</p>", "div": f'<div class="{other()}">{inner}</div>', "own": own()}[kind]
        return page + (junk("footer") if rng.random() < 0.4 else "")
    for kind in ("header", "nav", "notice", "advert", "form"):
        if rng.random() < {"nav": 0.8, "advert": 0.5}.get(kind, 0.35):
            page += junk(kind)
    if rng.random() < 0.3:
        page += junk(rng.choice(kinds))
    bare = rng.random() < 0.06
    if not bare:
        spec = rng.choice(ARTICLES)
        # half of the articles are in elements that no name tells
        named = None if rng.random() < 0.5 else rng.choice(["", other(), other()])
        if named is not None and rng.random() < 0.6:
            spec = rng.choice(["div.x", "div#x", "section.x", "div.x>div.x", "td.x", "main.x", "div.x>div.x>div.x"])
        before, after = ("", "") if spec == "body" else _open(spec, named)
        body = ""
        if rng.random() < 0.85:
            title = f"<h1>{_MARK}{sentence(2, 12)}</h1>"
            body += rng.choice([title, title, title, f"<header>{title}</header>"]) if spec.startswith(("article", "main>article")) else title
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9, 14])):
            piece = own()
            if rng.random() < 0.1:
                piece = f'<div class="{other()}">{piece}</div>'
            body += piece
            if rng.random() < 0.15:
                body += rng.choice([junk(rng.choice(["advert", "sidebar", "share", "notice", "form", "comments", "comments"]), True), f"<button>{sentence(1, 3)}</button>"])
        page += before + (body or own()) + after
    for kind in ("share", "comments", "sidebar", "form", "notice", "advert", "nav"):
        if rng.random() < 0.25:
            page += junk(kind)
    if rng.random() < 0.8:
        page += junk("footer")
    return page + rng.choice(["</body></html>", ""])


@lru_cache(2)
def train(pages: int = 3000, epochs: int = 6, batch: int = 24, hidden: int = HIDDEN, seed: int = 7) -> Model:
    """Fit on generated pages."""
    maker, rng = random.Random(seed), np.random.default_rng(seed)
    found = [leaf_blocks(training_page(maker)) for _ in range(pages)]
    target = [np.array([_MARK in b[0] for b in p], np.float32) for p in found]
    found = [[(b[0].replace(_MARK, "").strip(), b[1], b[2]) for b in p] for p in found]
    model = _new_model(rng, PATH + WORDS + MEASURES, hidden)
    parameters = model.parameters()
    m, v, step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
    total = epochs * -(-pages // batch)
    inputs = [features([p])[0] for p in found]
    for _ in range(epochs):
        order = rng.permutation(pages)
        for k in range(0, pages, batch):
            own = order[k : k + batch]
            x = np.concatenate([inputs[i] for i in own])
            y = np.concatenate([target[i] for i in own])
            first = np.concatenate([[0], np.cumsum([len(target[i]) for i in own])])
            x = x * (rng.random(x.shape) > 0.05)  # hashed names may be missing
            ahead, behind = Model.rows(first)
            hf, sf = model.forward.run(x, ahead, keep=True)
            hb, sb = model.backward.run(x, behind, keep=True)
            both = np.concatenate([hf, hb], 1)
            error = (_sigmoid(both @ model.out + model.bias) - y) / max(1, len(y))
            grad = error[:, None] * model.out[None, :]
            gradients = [*model.forward.back(x, sf, grad[:, :hidden]), *model.backward.back(x, sb, grad[:, hidden:]), both.T @ error, error.sum(keepdims=True)]
            step += 1
            rate = 0.008 * (1 - step / (total + 1)) + 0.0002
            norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
            for p, g, a, b in zip(parameters, gradients, m, v, strict=True):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def kept_model(spark: SparkSession) -> Model:
    """``train()``, once for a shared folder: the weights are kept there, under a name of all source that they rest on."""
    fs, folder = file_system(f"{shared_dir(spark)}/tallystone/models")
    rests_on = [inspect.getsource(m) for m in (sys.modules[__name__], tx)] + [xxhash.VERSION, np.__version__]
    path = f"{folder}/htmltext-{hashlib.sha256(chr(0).join(rests_on).encode()).hexdigest()[:16]}.npz"
    if fs.get_file_info(path).is_file:
        with fs.open_input_stream(path) as stored:
            saved = np.load(io.BytesIO(stored.read()))
        wf, uf, bf, wb, ub, bb, out, bias = (saved[f"p{i}"] for i in range(8))
        return Model(Direction(wf, uf, bf), Direction(wb, ub, bb), out, bias)
    model = train()
    data = io.BytesIO()
    np.savez(data, **{f"p{i}": p for i, p in enumerate(model.parameters())})
    fs.create_dir(folder, recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as out:
        out.write(data.getvalue())
    settle(fs, temporary, path)
    return model


def main_texts(pages: list[str | None], model: Model) -> list[str]:
    blocks = [leaf_blocks(p or "") for p in pages]
    x, first = features(blocks)
    keep = model.margins(x, first) > 0 if len(x) else np.zeros(0, bool)
    return [" ".join(b[0] for b, k in zip(p, keep[a : a + len(p)], strict=True) if k) for p, a in zip(blocks, first[:-1], strict=True)]


def _extract(batches: Iterator[pa.RecordBatch], model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tx.slices(whole, "html", 3_000_000):
            texts = main_texts(batch.column("html").to_pylist(), model.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)


def extract(pages: DataFrame, model: Model | None = None, prefix: str = "") -> DataFrame:
    """``pages`` (with an ``html`` column) with ``text`` and ``n_chars`` behind its columns."""
    schema = T.StructType([*pages.schema.fields, T.StructField(f"{prefix}text", T.StringType()), T.StructField(f"{prefix}n_chars", T.LongType())])
    arrow = to_arrow_schema(schema)
    shared = pages.sparkSession.sparkContext.broadcast(model or kept_model(pages.sparkSession))
    return tx.map_arrow(pages, lambda b: _extract(b, shared, arrow), schema)
