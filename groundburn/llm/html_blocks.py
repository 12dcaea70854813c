"""Main text of web pages by a recurrent block labeller.

A page is read as a sequence of leaf blocks: runs of text between block-level
tags, each with the path of the elements around it. A bidirectional LSTM reads
a vector for each leaf (hashed tag path with classes and ids, hashed words, a
few numbers) and says of every leaf whether it is main text, knowing all leaves
before and after it.

The labeller is trained here, on generated pages whose blocks are known: page
layouts, class names and the places of menus, adverts, notices, forms, sidebars
and comments are drawn at random, the words too, so that structure decides.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundburn.llm.base import carried, ddl, in_arrow


@dataclass(frozen=True)
class LabellerRules:
    pages: int = 900         # generated for training
    epochs: int = 5
    batch: int = 30
    path_buckets: int = 4096
    word_buckets: int = 2048
    path_size: int = 16
    word_size: int = 6
    hidden: int = 16         # in each direction
    rate: float = 0.01
    seed: int = 7
    together: int = 64       # pages labelled at a time
    longest: int = 2000      # leaves whose gates are computed in one go; longer pages are read alone, state carried on


#: Elements that flow inside a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup: it ends at their own end tag and nowhere else. None is text of the page.
RAW = frozenset("script style textarea title iframe noembed noframes".split())
#: Elements with markup inside that is not text of the page.
HIDDEN = frozenset("noscript template svg object math canvas".split())
#: Elements that end an svg or math they stand in, as they cannot be part of one.
_BREAKS_OUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr
ol p pre ruby s small span strong strike sub sup table tt u ul var article aside section nav header footer main form figure""".split())
#: Open elements at a time; further ones stand beside the last, as in browsers.
_DEEPEST = 512
#: Outermost and innermost open elements, so many of each, that make a leaf's path.
_PATH_ENDS = 32
#: An open element of the first kind ends where one of the second kind begins.
_CLOSES = {"p": frozenset("p div ul ol li table h1 h2 h3 h4 h5 h6 section article aside nav header footer form main blockquote pre hr dl figure".split()),
           "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
           "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]), "head": frozenset(["body"])}

_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")  # any other < is text
_SIMPLE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)[\t\n\f\r ]*>")
_NAME = re.compile(r"[^\t\n\f\r />]+")
_BETWEEN = re.compile(r"[\t\n\f\r /]*")
_ATTRIBUTE = re.compile(r"[^\t\n\f\r />][^\t\n\f\r />=]*")  # may begin with =
_EQUALS = re.compile(r"[\t\n\f\r ]*=[\t\n\f\r ]*")
_UNQUOTED = re.compile(r"[^\t\n\f\r >]*")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\t\n\f\r />])", re.I) for tag in RAW}
_COMMENT_END = re.compile(r"--!?>")
_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Leaf:
    text: str
    path: tuple[str, ...]
    linked: int  # characters inside links


def _names(value: str) -> list[str]:
    out: list[str] = []
    for name in value.lower().split():
        out.append(name)
        out += [p for p in _PARTS.split(name) if p and p != name]
    return out


@dataclass
class _Tag:
    """What stands between two runs of text: a tag, or (``name`` empty) something that is skipped."""

    start: int
    end: int
    name: str = ""
    closing: bool = False
    slash: bool = False  # ends with />
    names: tuple[str, ...] = ()  # classes, ids and roles


def _attributes(page: str, at: int) -> tuple[int, bool, list[str]] | None:
    """End of a tag from behind its name, whether it ends with a slash, and the
    values of class, id and role; None if the page ends inside it."""
    values: list[str] = []
    while True:
        space = _BETWEEN.match(page, at)
        at = space.end()
        if at >= len(page):
            return None
        if page[at] == ">":
            return at + 1, page[at - 1] == "/", values
        name = _ATTRIBUTE.match(page, at)
        at = name.end()
        equals = _EQUALS.match(page, at)
        if not equals:
            continue
        at = equals.end()
        quote = page[at:at + 1]
        if quote in ("'", '"'):
            to = page.find(quote, at + 1)
            if to < 0:
                return None
            value, at = page[at + 1:to], to + 1
        else:
            m = _UNQUOTED.match(page, at)
            value, at = m[0], m.end()
        if name[0].lower() in ("class", "id", "role"):
            values.append(value)


def _tags(page: str) -> Iterator[_Tag]:
    """Tags, comments and raw text of a page in one pass, by the states of the
    HTML standard. A page that ends inside a tag or comment ends where it begins."""
    at, end = 0, len(page)
    while begin := _OPEN.search(page, at):
        at, tag = begin.start(), None
        simple = _SIMPLE.match(page, at)
        if simple:
            tag = _Tag(at, simple.end(), simple[2].lower(), bool(simple[1]))
        else:
            closing = page.startswith("/", at + 1)
            first = page[at + 1 + closing:at + 2 + closing]
            if first.isascii() and first.isalpha():
                name = _NAME.match(page, at + 1 + closing)
                rest = _attributes(page, name.end())
                if rest is None:
                    yield _Tag(at, end)
                    return
                names = tuple(n for value in rest[2] for n in _names(value))
                tag = _Tag(at, rest[0], name[0].lower(), closing, rest[1], names)
            elif page.startswith("!--", at + 1):
                if page.startswith((">", "->"), at + 4):  # an empty comment
                    to = page.index(">", at + 4) + 1
                else:
                    m = _COMMENT_END.search(page, at + 4)
                    to = m.end() if m else end
                tag = _Tag(at, to)
            elif first in ("!", "?") or (closing and first):  # a doctype or a comment of another kind; </> is nothing
                to = page.find(">", at + 2)
                tag = _Tag(at, to + 1 if to >= 0 else end)
        if tag is None:  # < as text
            at += 1
            continue
        yield tag
        at = tag.end
        if tag.name in RAW and not tag.closing:
            m = _RAW_END[tag.name].search(page, at)
            yield _Tag(at, m.start() if m else end)
            at = m.start() if m else end


class _Hidden:
    """An open element whose content is left out, and the elements inside it."""

    def __init__(self, name: str):
        self.name, self.inside, self.count = name, [name], Counter([name])

    def takes(self, tag: _Tag, outer: Counter) -> bool:
        """Whether the tag belongs to it; if not, it has ended before the tag."""
        foreign = self.name in ("svg", "math")
        if not tag.closing:
            if foreign and tag.name in _BREAKS_OUT and "foreignobject" not in self.count:
                return False
            if tag.name not in VOID and not (foreign and tag.slash):
                self.inside.append(tag.name)
                self.count[tag.name] += 1
        elif self.count[tag.name]:
            while (name := self.inside.pop()) != tag.name:
                self.count[name] -= 1
            self.count[name] -= 1
        elif outer[tag.name]:
            return False
        return True


def leaves(page: str) -> list[Leaf]:
    """Leaf blocks in page order: character references decoded, white space
    turned into single spaces, empty ones left out. Time grows with the page's
    length alone, however broken it is."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_tags: Counter = Counter()
    hidden: _Hidden | None = None
    pieces: list[str] = []
    linked = in_link = 0
    known_path: tuple[str, ...] | None = ()

    def flush() -> None:
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            pieces.clear()
            if text:
                out.append(Leaf(text, path(), min(linked, len(text))))
        linked = 0

    def path() -> tuple[str, ...]:
        nonlocal known_path
        if known_path is None:
            ends = stack if len(stack) <= 2 * _PATH_ENDS else stack[:_PATH_ENDS] + stack[-_PATH_ENDS:]
            known_path = tuple(t for _, tokens in ends for t in tokens)
        return known_path

    def close() -> str:
        nonlocal known_path
        known_path = None
        name = stack.pop()[0]
        open_tags[name] -= 1
        return name

    at = 0
    for tag in _tags(page):
        if tag.start > at and hidden is None:
            pieces.append(page[at:tag.start])
            if in_link:
                linked += tag.start - at
        at = tag.end
        name = tag.name
        if not name:
            continue
        if hidden is not None:
            if hidden.takes(tag, open_tags):
                if not hidden.inside:
                    hidden = None
                continue
            hidden = None
        if name in RAW:
            continue
        if name in HIDDEN:
            if not tag.closing and not (tag.slash and name in ("svg", "math")):
                hidden = _Hidden(name)
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if tag.closing else 1
            elif name == "br":
                pieces.append(" ")
            continue
        flush()
        in_link = 0
        if tag.closing:
            if open_tags[name]:
                while close() != name:
                    pass
        else:
            while stack and name in _CLOSES.get(stack[-1][0], ()):
                close()
            if name not in VOID:
                if len(stack) >= _DEEPEST:
                    close()
                stack.append((name, (name, *("." + n for n in tag.names))))
                open_tags[name] += 1
                known_path = None
    if hidden is None:
        pieces.append(page[at:])
    flush()
    return out


def _features(page: list[Leaf], rules: LabellerRules) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    paths = [np.array([zlib.crc32(t.encode()) % rules.path_buckets for t in x.path] or [0]) for x in page]
    words = [np.array([zlib.crc32(w.encode()) % rules.word_buckets for w in x.text.lower().split()]) for x in page]
    n = len(page)
    numbers = np.array([[np.log1p(len(x.text)) / 5, x.linked / len(x.text), i / n, len(x.path) / 10, 1.0]
                        for i, x in enumerate(page)]).reshape(n, 5)
    return paths, words, numbers


_NUMBERS = 5


def _mean_rows(table: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(x) for x in lists])
    starts = np.cumsum(sizes) - sizes
    return np.add.reduceat(table[np.concatenate(lists)], starts) / sizes[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """The network: hashed embeddings, one LSTM each way, a logistic output."""

    def __init__(self, rules: LabellerRules):
        self.rules = rules
        r = np.random.default_rng(rules.seed)
        d, h = rules.path_size + rules.word_size + _NUMBERS, rules.hidden
        # Embeddings begin at zero: names never met in training say nothing.
        self.w = {"path": np.zeros((rules.path_buckets, rules.path_size)), "word": np.zeros((rules.word_buckets, rules.word_size)),
                  "out": r.normal(0, 0.3, (2 * h, 1)), "bias": np.zeros(1)}
        for side in ("f", "b"):
            self.w |= {f"x{side}": r.normal(0, 0.3, (d, 4 * h)), f"h{side}": r.normal(0, 0.2, (h, 4 * h)), f"c{side}": np.zeros(4 * h)}
            self.w[f"c{side}"][h:2 * h] = 1  # remember at first

    def _inputs(self, pages: list) -> tuple[np.ndarray, np.ndarray]:
        """Time x page x feature, padded at the end, and the mask."""
        sizes = [len(p[2]) for p in pages]
        flat = np.concatenate([
            _mean_rows(self.w["path"], [x for p in pages for x in p[0]]) * 3,
            _mean_rows(self.w["word"], [x for p in pages for x in p[1]]), np.concatenate([p[2] for p in pages])], axis=1)
        x, mask = np.zeros((max(sizes), len(pages), flat.shape[1])), np.zeros((max(sizes), len(pages), 1))
        at = 0
        for k, n in enumerate(sizes):
            x[:n, k], mask[:n, k] = flat[at:at + n], 1
            at += n
        return x, mask

    def _read(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool = True) -> tuple[np.ndarray, list]:
        h_size, step = self.rules.hidden, self.rules.longest
        h = c = np.zeros((x.shape[1], h_size))
        out, kept = np.zeros((*x.shape[:2], h_size)), []
        starts = range(0, len(x), step)
        for a in starts if side == "f" else reversed(starts):
            gates = x[a:a + step] @ self.w[f"x{side}"] + self.w[f"c{side}"]
            for k in range(len(gates)) if side == "f" else range(len(gates) - 1, -1, -1):
                t = a + k
                z = gates[k] + h @ self.w[f"h{side}"]
                ifo, g = _sigmoid(z[:, :3 * h_size]), np.tanh(z[:, 3 * h_size:])
                i, f, o = np.split(ifo, 3, axis=1)
                c_new = (f * c + i * g) * mask[t]  # padding leaves zeros, at either end
                tanh_c = np.tanh(c_new)
                if keep:
                    kept.append((t, h, c, i, f, o, g, tanh_c))
                c, h = c_new, o * tanh_c * mask[t]
                out[t] = h
        return out, kept

    def chances(self, pages: list) -> list[np.ndarray]:
        """Of every leaf of every page, the chance that it is main text."""
        x, mask = self._inputs(pages)
        both = np.concatenate([self._read(x, mask, "f", False)[0], self._read(x, mask, "b", False)[0]], axis=2)
        p = _sigmoid(both @ self.w["out"] + self.w["bias"])[:, :, 0]
        return [p[:len(page[2]), k] for k, page in enumerate(pages)]

    def gradients(self, pages: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Of the mean cross entropy, by back-propagation through time."""
        w, size = self.w, self.rules.hidden
        x, mask = self._inputs(pages)
        reads = {s: self._read(x, mask, s) for s in ("f", "b")}
        both = np.concatenate([reads["f"][0], reads["b"][0]], axis=2)
        p = _sigmoid(both @ w["out"] + w["bias"])
        y = np.zeros_like(p)
        for k, l in enumerate(labels):
            y[:len(l), k, 0] = l
        error = (p - y) * mask / mask.sum()
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["out"] = np.einsum("tbh,tbo->ho", both, error)
        g["bias"] = error.sum((0, 1))
        d_both = error @ w["out"].T
        dx = np.zeros_like(x)
        for s, part in (("f", d_both[:, :, :size]), ("b", d_both[:, :, size:])):
            dh = dc = np.zeros((x.shape[1], size))
            for t, h0, c0, i, f, o, cand, tanh_c in reversed(reads[s][1]):
                dh_all = (part[t] + dh) * mask[t]
                dc_all = (dh_all * o * (1 - tanh_c**2) + dc) * mask[t]
                dz = np.concatenate([dc_all * cand * i * (1 - i), dc_all * c0 * f * (1 - f),
                                     dh_all * tanh_c * o * (1 - o), dc_all * i * (1 - cand**2)], axis=1)
                g[f"x{s}"] += x[t].T @ dz
                g[f"h{s}"] += h0.T @ dz
                g[f"c{s}"] += dz.sum(0)
                dx[t] += dz @ w[f"x{s}"].T
                dh, dc = dz @ w[f"h{s}"].T, dc_all * f
        a = self.rules.path_size
        for k, page in enumerate(pages):
            for t, (path, words) in enumerate(zip(page[0], page[1], strict=True)):
                np.add.at(g["path"], path, dx[t, k, :a] * 3 / len(path))
                np.add.at(g["word"], words, dx[t, k, a:a + self.rules.word_size] / len(words))
        return g

    def main_text(self, pages: list[list[Leaf]]) -> list[list[str]]:
        """Blocks of main text of each page."""
        out: list[list[str]] = [[] for _ in pages]
        order = sorted((k for k, page in enumerate(pages) if page), key=lambda k: len(pages[k]))
        short = sum(len(pages[k]) <= self.rules.longest for k in order)
        groups = [order[at:min(at + self.rules.together, short)] for at in range(0, short, self.rules.together)]
        for group in [*groups, *([k] for k in order[short:])]:
            for k, p in zip(group, self.chances([_features(pages[k], self.rules) for k in group]), strict=True):
                out[k] = [leaf.text for leaf, x in zip(pages[k], p, strict=True) if x > 0.5]
        return out


#: Names of parts that are not main text, and of those that are; fixed values.
_SIDE_NAMES = """ad ads advert advertisement adsbygoogle banner sponsor sponsored promo promotion menu navbar navigation nav topnav breadcrumb
breadcrumbs sidebar side widget widgets related recommended more-stories share sharing social social-links newsletter subscribe signup cookie
cookies consent cookie-banner cookie-notice notice notification alert popup modal overlay gdpr site-header masthead header top-bar site-footer
footer copyright legal bottom comments comment comment-list comment-body reply replies respond disqus reader-comments discussion login
search search-form pagination pager tags tag-list author-bio toolbar skip-link paywall""".split()
_MAIN_NAMES = """content main main-content article article-body article-content post post-content post-body entry entry-content story story-body
text body page-content body-text prose""".split()
_NEUTRAL = "container wrapper row col inner page site layout grid box block section wrap clearfix left right".split()
_SIDE_WORDS = "cookie cookies privacy subscribe newsletter share login sign comments comment reply advertisement sponsored copyright rights reserved menu home search related".split()


class _Pages:
    """Random pages as HTML and, for each of their leaves, whether it is main text."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        syllables = "an be ca de er fo ga in ko la me no or pa re sa ti un ve wo".split()
        out = ["".join(self.r.choices(syllables, k=self.r.randint(1, 4))) for _ in range(self.r.randint(low, high))]
        out[0] = out[0].title()
        if self.r.random() < 0.1:
            out = [w + self.r.choice(["!!", "###", "%%%", "***", "&amp;&amp;", "|"]) for w in out]
        return " ".join(out) + self.r.choice([".", ".", "", "!"])

    def prose(self) -> str:
        text = self.words(1, 70) if self.r.random() < 0.85 else self.words(60, 300)
        if self.r.random() < 0.3:
            text = f"<{(t := self.r.choice(['b', 'i', 'em', 'strong', 'span', 'a href=x']))}>{text}</{t.split()[0]}>"
        return text

    def side_text(self) -> str:
        text = self.words(1, 25)
        return f"{self.r.choice(_SIDE_WORDS)} {text}" if self.r.random() < 0.3 else text

    def named(self, names: list[str]) -> str:
        key = self.r.choice(["class", "class", "class", "id"])
        return f'{key}="{" ".join(self.r.sample(names, self.r.choice([1, 1, 1, 2])))}"'

    def side(self, depth: int = 0) -> list[tuple[str, int]]:
        """One part that is not main text: pieces of HTML with labels."""
        tag = self.r.choice(["nav", "header", "footer", "aside", "form", "div", "div", "div", "div", "section", "ul"])
        name = self.named(_SIDE_NAMES) if tag in ("div", "section", "ul") or self.r.random() < 0.4 else ""
        out: list[tuple[str, int]] = [(f"<{tag} {name}>", -1)]
        for _ in range(self.r.randint(1, 6)):
            kind = self.r.random()
            if kind < 0.3 or tag == "ul":
                out += [("<ul>", -1), *((f'<li><a href="/x">{self.words(1, 4)}</a></li>', 0) for _ in range(self.r.randint(1, 6))), ("</ul>", -1)]
            elif kind < 0.6:
                out.append((f"<p>{self.side_text()}</p>", 0))
            elif kind < 0.7:
                out.append((f"<{(h := self.r.choice(['h2', 'h3', 'h4']))}>{self.words(1, 5)}</{h}>", 0))
            elif kind < 0.8:
                out.append((f'<div {self.named(_SIDE_NAMES + _NEUTRAL)}>{self.side_text()}</div>', 0))
            elif kind < 0.9 and not depth:
                out += [(f"<div {self.named(_NEUTRAL)}>", -1), *self.side(1), ("</div>", -1)]
            else:
                out += [(f"<div>{self.side_text()}</div>", 0)]
        return [*out, (f"</{tag}>", -1)]

    def main(self) -> list[tuple[str, int]]:
        wraps = self.r.choice([["article"], ["main"], ["article", "div"], ["main", "article"], ["div"], ["main", "div"], ["div", "div"], ["section", "article"]])
        out: list[tuple[str, int]] = []
        for k, tag in enumerate(wraps):
            name = self.named(_MAIN_NAMES if k == len(wraps) - 1 else _MAIN_NAMES + _NEUTRAL) if tag in ("div", "section") or self.r.random() < 0.3 else ""
            out.append((f"<{tag} {name}>", -1))
        if self.r.random() < 0.8:
            out.append((f"<h1>{self.words(2, 12)}</h1>", 1))
        for _ in range(self.r.randint(1, 14)):
            kind = self.r.random()
            if kind < 0.62:
                out.append((f"<p>{self.prose()}{'</p>' if self.r.random() < 0.8 else '<br>'}", 1))
            elif kind < 0.7:
                out.append((f"<{(h := self.r.choice(['h2', 'h3']))}>{self.words(1, 8)}</{h}>", 1))
            elif kind < 0.76:
                out += [("<ul>", -1), *((f"<li>{self.prose()}</li>", 1) for _ in range(self.r.randint(1, 5))), ("</ul>", -1)]
            elif kind < 0.8:
                out.append((f"<blockquote>{self.prose()}</blockquote>", 1))
            elif kind < 0.84:
                out.append((f"<div>{self.prose()}</div>", 1))
            elif kind < 0.87:
                out.append((f"<table><tr><td>{self.prose()}</td></tr></table>", 1))
            elif kind < 0.9:
                out.append((f"<pre>{self.prose()}</pre>", 1))
            else:
                out += self.side()
        if self.r.random() < 0.15:
            out += self.side()
        return out + [(f"</{t}>", -1) for t in reversed(wraps)]

    def page(self) -> tuple[str, list[int]]:
        parts: list[tuple[str, int]] = []
        for _ in range(self.r.randint(0, 4)):
            parts += self.side()
        if self.r.random() < 0.97:
            parts += self.main()
        for _ in range(self.r.randint(0, 4)):
            parts += self.side()
        if self.r.random() < 0.3:
            parts = [(f"<div {self.named(_NEUTRAL)}>", -1), *parts, ("</div>", -1)]
        return f"<html><head><title>x</title></head><body>{''.join(p[0] for p in parts)}</body></html>", [l for _, l in parts if l >= 0]


def generated(n: int, seed: int) -> Iterator[tuple[list[Leaf], np.ndarray]]:
    pages = _Pages(seed)
    made = 0
    while made < n:
        page, labels = pages.page()
        found = leaves(page)
        if found and len(found) == len(labels):
            made += 1
            yield found, np.array(labels)


@lru_cache(maxsize=1)
def trained(rules: LabellerRules = LabellerRules()) -> Labeller:
    """The labeller, fitted with Adam to generated pages; the same every time."""
    net = Labeller(rules)
    data = [(_features(page, rules), y) for page, y in generated(rules.pages, rules.seed)]
    first, second = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    order, r, step = list(range(len(data))), random.Random(rules.seed), 0
    for epoch in range(rules.epochs):
        r.shuffle(order)
        for at in range(0, len(order), rules.batch):
            chosen = [data[k] for k in order[at:at + rules.batch]]
            grads = net.gradients([c[0] for c in chosen], [c[1] for c in chosen])
            step += 1
            rate = rules.rate * (1 if epoch < rules.epochs - 1 else 0.3)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.w[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return net


def extracted(pages: DataFrame, net: Labeller, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``text``, the blocks of main text
    joined by an empty line, and ``n_chars``. Null or empty html, and pages
    without main text, give an empty text."""
    keep = carried(pages, keep, "_html text n_chars")
    shared = pages.sparkSession.sparkContext.broadcast(net)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            column = batch.column("_html")
            for at in range(0, len(column), 512):
                read = [leaves(h or "") for h in column.slice(at, 512).to_pylist()]
                texts += ("\n\n".join(blocks) for blocks in shared.value.main_text(read))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*keep, "text", "n_chars"])

    return in_arrow(pages.select(*keep, F.col(html_col).alias("_html")), run, f"{ddl(pages, keep)}text string, n_chars long")
