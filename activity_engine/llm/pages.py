"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, stretches of text under the same block elements. Features of a block are
its ancestors (tags, and words of their class, id and role), and of its text: length, share inside
links, sentence marks, telling words, place on the page. The field has two labels, article and other;
its weights are learned from labelled pages by gradient steps on the conditional likelihood, and a page's
blocks are labelled by Viterbi decoding.

The training pages are written by `labelled_pages`: layouts of many kinds with known labels.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from activity_engine.llm.common import Shared, pieces

TRAINING_PAGES = 320
EPOCHS = 6

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|template|noscript|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only right after the equals sign; elsewhere it is a character like others.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAME_WORD = re.compile(r"[a-z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split()
)
# A start of one of these ends an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
_SAME_KIND = {"li": ("ul", "ol"), "option": ("select",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "dt": ("dl",), "dd": ("dl",)}
_TELLING = re.compile(
    r"\b(cookies?|consent|privacy|subscribe|newsletter|sign ?up|log ?in|advert\w*|sponsored|promoted|copyright|all rights reserved"
    r"|comments?|repl(?:y|ies)|share|related|read more|menu|search|contact|terms)\b|©",
    re.I,
)


@dataclass
class Block:
    text: str
    ancestors: tuple[str, ...]  # the kinds of open tags, each where it is innermost, outermost first
    names: tuple[str, ...]  # the distinct words of their class, id and role, in order
    linked: float  # share of the text inside links


class _Stack:
    """The open tags, with what a block asks about them: both are worked out again only where a tag changed."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self._words: list[tuple[str, ...]] = []
        self._places: dict[str, list[int]] = {}
        self._counts: dict[str, int] = {}
        self._known: tuple[tuple[str, ...], tuple[str, ...]] | None = None

    def push(self, tag: str, words: tuple[str, ...]) -> None:
        self._places.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)
        self._words.append(words)
        for w in words:
            self._counts[w] = self._counts.get(w, 0) + 1
        self._known = None

    def has(self, tag: str) -> bool:
        return tag in self._places

    def cut(self, depth: int) -> None:
        while len(self.tags) > depth:
            tag = self.tags.pop()
            self._places[tag].pop()
            if not self._places[tag]:
                del self._places[tag]
            for w in self._words.pop():
                self._counts[w] -= 1
                if not self._counts[w]:
                    del self._counts[w]
        self._known = None

    def end(self, tag: str, within: tuple[str, ...] = ()) -> None:
        """Close the innermost `tag` and what is open inside it, unless one of `within` is further in."""
        if tag in self._places:
            depth = self._places[tag][-1]
            if all(self._places[w][-1] < depth for w in within if w in self._places):
                self.cut(depth)

    def seen(self) -> tuple[tuple[str, ...], tuple[str, ...]]:
        if self._known is None:
            kinds = sorted((places[-1], tag) for tag, places in self._places.items() if tag not in _INLINE)
            self._known = tuple(tag for _, tag in kinds), tuple(sorted(self._counts))
        return self._known


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order; markup, comments, scripts and styles are no text.

    Missing end tags are made up as browsers do in the common cases, and a page may end anywhere.
    """
    out: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    linked = plain = 0

    def close() -> None:
        nonlocal parts, linked, plain
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, *stack.seen(), linked / max(1, linked + plain)))
        parts, linked, plain = [], 0, 0

    def put(raw: str) -> None:
        nonlocal linked, plain
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if stack.has("a"):
                linked += len(text)
            else:
                plain += len(text)

    at = 0
    page = page or ""
    for m in _MARKUP.finditer(page):
        put(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag not in _INLINE or tag == "img":
            close()
        if m[2]:
            stack.end(tag)
            continue
        if tag in _VOID:
            continue
        if tag in _ENDS_P:
            stack.end("p", ("body", "article", "div", "td", "section", "li"))
        elif tag in _SAME_KIND:
            stack.end(tag, _SAME_KIND[tag])
        names: tuple[str, ...] = ()
        if m[4] and "=" in m[4]:
            found = {w for x in _NAMES.finditer(m[4]) for w in _NAME_WORD.findall((x[2] or x[3] or x[4] or "").lower())}
            names = tuple(sorted(found))
        stack.push(tag, names)
    put(page[at:])
    close()
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold, block by block."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        f = ["bias", f"words:{min(7, words.bit_length())}", f"links:{int(b.linked * 4)}", f"place:{4 * i // len(blocks)}"]
        f += [f"tag:{t}" for t in set(b.ancestors)]
        f += [f"name:{n}" for n in set(b.names)]
        if b.ancestors:
            f.append(f"leaf:{b.ancestors[-1]}")
        f.append(f"ends:{b.text[-1] in '.!?…:;'}")
        f += [f"says:{w}" for w in {m[0].lower() for m in _TELLING.finditer(b.text)}] if words < 40 else []
        out.append(f)
    return out


@dataclass
class Field:
    """Weights of the label `article` against `other`, and of the changes between labels."""

    weights: dict[str, float] = field(default_factory=dict)
    change: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def scores(self, named: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in fs) for fs in named]

    def decode(self, named: list[list[str]]) -> list[int]:
        """The most likely labels (Viterbi); of equal ones `other` is taken."""
        if not named:
            return []
        (c00, c01), (c10, c11) = self.change.tolist()
        scores = self.scores(named)
        a, b, back = 0.0, scores[0], []
        for s in scores[1:]:
            back.append((b + c10 > a + c00, b + c11 > a + c01))
            a, b = max(a + c00, b + c10), s + max(a + c01, b + c11)
        label = int(b > a)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of `article` at each block, and of each pair of labels at each border."""
        n = len(scores)
        own = np.stack([np.zeros(n), scores], axis=1)
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = own[0]
        for t in range(1, n):
            ahead[t] = own[t] + np.logaddexp(ahead[t - 1, 0] + self.change[0], ahead[t - 1, 1] + self.change[1])
        for t in range(n - 2, -1, -1):
            nxt = own[t + 1] + behind[t + 1]
            behind[t] = np.logaddexp(self.change[:, 0] + nxt[0], self.change[:, 1] + nxt[1])
        whole = np.logaddexp(ahead[-1, 0], ahead[-1, 1])
        single = np.exp(ahead[:, 1] + behind[:, 1] - whole)
        pair = np.exp(ahead[:-1, :, None] + self.change + (own[1:] + behind[1:])[:, None, :] - whole)
        return single, pair


def train(pages: list[tuple[str, list[str]]] | None = None, epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """A field from (page, texts of the article's blocks); AdaGrad steps, page by page."""
    pages = labelled_pages() if pages is None else pages
    known = []
    for page, article in pages:
        blocks = blocks_of(page)
        wanted = set(article)
        if blocks:
            known.append((features(blocks), np.array([float(b.text in wanted) for b in blocks])))
    out, square, change = Field(), {}, np.full((2, 2), 1e-6)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for k in rng.permutation(len(known)):
            named, y = known[k]
            single, pair = out.marginals(np.array(out.scores(named)))
            gradient: dict[str, float] = {}
            for fs, g in zip(named, (y - single).tolist(), strict=True):
                for f in fs:
                    gradient[f] = gradient.get(f, 0.0) + g
            for f, g in gradient.items():
                g -= decay * out.weights.get(f, 0.0)
                square[f] = square.get(f, 1e-6) + g * g
                out.weights[f] = out.weights.get(f, 0.0) + rate * g / square[f] ** 0.5
            if len(y) > 1:
                seen = np.zeros((2, 2))
                np.add.at(seen, (y[:-1].astype(int), y[1:].astype(int)), 1.0)
                g = seen - pair.sum(axis=0) - decay * out.change
                change += g * g
                out.change = out.change + rate * g / np.sqrt(change)
    return out


def main_text(page: str | None, model: Field) -> str:
    """The blocks labelled `article`, joined by one space; empty for a null or empty page."""
    blocks = blocks_of(page)
    return " ".join(b.text for b, label in zip(blocks, model.decode(features(blocks)), strict=True) if label)


def extract(page: Column, model: Field) -> Column:
    """struct<text, n_chars> of a column of pages; null and empty pages give an empty text.

    Every row is read by itself, whole. Repeated rows, empty tables and further columns make no difference.
    """
    shared = Shared(model)
    kind = pa.struct([("text", pa.string()), ("n_chars", pa.int64())])

    @F.arrow_udf("struct<text:string,n_chars:bigint>")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.get()
        for array, cuts in pieces(arrays):
            texts = [main_text(p, own) for start, n in cuts for p in array.slice(start, n).to_pylist()]
            yield pa.array([{"text": t, "n_chars": len(t)} for t in texts], kind)

    return run(page)


def labelled_pages(number: int = TRAINING_PAGES, seed: int = 3) -> list[tuple[str, list[str]]]:
    """Pages of many layouts with the texts of their article blocks."""
    rng = np.random.default_rng(seed)
    made = ["".join(rng.choice(list("abdeghilmnorstu"), rng.integers(2, 9))) for _ in range(600)]

    def pick(*options: str) -> str:
        return options[rng.integers(len(options))]

    def words(lo: int, hi: int) -> str:
        return " ".join(made[i] for i in rng.integers(0, len(made), rng.integers(lo, hi)))

    def sentence(lo: int, hi: int) -> str:
        return words(lo, hi).capitalize() + pick(".", ".", ".", "!", "?", "")

    def links(n: int) -> str:
        wrap = pick("<li><a href='/x'>{}</a></li>", "<a href='/x'>{}</a>", "<li><a href='/x'><span>{}</span></a>")
        return "".join(wrap.format(words(1, 4)) for _ in range(n))

    def named(tag: str, inside: str, *names: str) -> str:
        return f'<{tag} {pick("class", "class", "id")}="{pick(*names)}">{inside}</{tag}>'

    def side(kind: str) -> str:
        short, long = sentence(3, 12), sentence(8, 40)
        if kind == "menu":
            return pick(f"<nav><ul>{links(6)}</ul></nav>", named("ul", links(5), "menu", "main-menu", "navbar"), named("div", links(5), "nav", "breadcrumbs", "topbar"))
        if kind == "header":
            return pick(f"<header><h1>{words(1, 4)}</h1><p>{short}</p></header>", named("div", f"<h2>{words(1, 3)}</h2>{short}", "header", "site-header", "masthead"))
        if kind == "ad":
            return named(pick("div", "section", "aside"), pick(long, f"<p>{short}</p>", f"<a href='/buy'>{short}</a>"), "ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad")
        if kind == "side":
            return pick(f"<aside><h3>{words(1, 3)}</h3><p>{long}</p></aside>", named("div", f"<h3>{words(1, 3)}</h3><p>{long}</p>{links(4)}", "sidebar", "side", "widget", "related", "share", "social", "trending"))
        if kind == "notice":
            return named("div", f"<p>{pick('We use cookies. ', '', 'Privacy notice: ')}{long}</p>", "cookie-notice", "cookie", "consent", "notice", "alert", "banner", "popup", "newsletter", "subscribe")
        if kind == "form":
            return f"<form action='/s'><label>{words(1, 4)}</label><input name='q'><select><option>{words(1, 2)}<option>{words(1, 2)}</select><button>{words(1, 3)}</button><p>{short}</p></form>"
        if kind == "comments":
            one = "".join(pick(f"<li><b>{words(1, 2)}</b><p>{sentence(5, 40)}</p></li>", f'<div class="comment"><p>{sentence(5, 40)}</p></div>', f"<p>{sentence(5, 40)}</p>") for _ in range(rng.integers(1, 5)))
            return named(pick("div", "section", "ol"), pick("<h3>Comments</h3>", "") + one, "comments", "comment-list", "reader-comments", "discussion", "replies", "responses", "disqus")
        return pick(f"<footer>&copy; {words(1, 4)} &middot; {short}</footer>", f"<footer><p>{long}</p>{links(3)}</footer>", named("div", f"<p>&copy; {words(2, 6)}</p>{links(3)}", "footer", "site-footer", "copyright", "legal"))

    out = []
    for _ in range(number):
        article: list[str] = []

        def body() -> str:
            inside = []
            title = words(3, 10).capitalize()
            if rng.random() < 0.8:
                article.append(title)
                inside.append(f"<h1>{title}</h1>")
            for _ in range(rng.integers(1, 9)):
                text = " ".join(sentence(3, 30) for _ in range(rng.integers(1, 6)))
                if rng.random() < 0.15:
                    text = sentence(1, 4)
                article.append(text)
                shape = rng.random()
                if shape < 0.6:
                    inside.append(f"<p>{text}</p>")
                elif shape < 0.72:
                    half = text.replace(" ", " <b>", 1)
                    inside.append(f"<p>{half}</b></p>" if "<b>" in half else f"<p>{text}")
                elif shape < 0.8:
                    inside.append(f"<p>{text}")
                elif shape < 0.86:
                    inside.append(f"<blockquote>{text}</blockquote>")
                elif shape < 0.92:
                    inside.append(f"<ul><li>{text}</li></ul>")
                elif shape < 0.96:
                    inside.append(f"<h2>{text}</h2>")
                else:
                    inside.append(f"<div>{text}</div>")
                if rng.random() < 0.12:
                    inside.append(side(pick("ad", "notice", "side", "form", "comments", "menu")))
            return "".join(inside)

        inner = body()
        shape = rng.random()
        if shape < 0.45:
            inner = f"<article>{inner}</article>"
        elif shape < 0.6:
            inner = f"<main>{inner}</main>"
        elif shape < 0.7:
            inner = f'<div role="main">{inner}</div>'
        elif shape < 0.95:
            inner = named("div", inner, "content", "post", "entry", "story", "article-body", "main-content", "post-body", "text")
        before = [side(k) for k in ("header", "menu", "notice", "ad", "form", "side") if rng.random() < 0.5]
        after = [side(k) for k in ("comments", "side", "ad", "form", "notice") if rng.random() < 0.4]
        rng.shuffle(before)
        rng.shuffle(after)
        end = side("footer") if rng.random() < 0.9 else ""
        title = f"<head><title>{words(2, 8)}</title></head>" if rng.random() < 0.9 else ""
        tail = pick("</body></html>", "</html>", "")
        whole = "".join(before) + inner + "".join(after) + end
        if rng.random() < 0.4:
            whole = named("div", whole, "wrapper", "container", "page", "site", "layout")
        out.append((f"<html>{title}<body>{whole}{tail}", article))
    return out
