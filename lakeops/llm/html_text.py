"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks, the runs of text between block-level tags. Each block is described by hashed vectors of its
tag path and of its words and by a few measures; a bidirectional LSTM, in numpy, reads the blocks of a page in both
directions, so that each is labelled in the context of the whole page. The text is that of the blocks labelled main.

There are no labelled pages. The labeller is trained on pages laid out anew: texts of a bounded sample of the corpus
(what its markup marks beyond doubt as article, or as something else) in many layouts, with menus, notices, adverts,
sidebars, forms and comments of known label around and between them.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm.hashing import word_hashes, word_spans
from lakeops.llm.registry import query, table

# Elements without content, elements whose content isn't markup, and elements within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr""".split())
# Elements that an element of the same group ends.
GROUPS = {**{t: "p" for t in ("p",)}, "li": "li", "dt": "dt", "dd": "dt", "option": "option", "tr": "tr", "td": "td", "th": "td"}
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr
    main menu nav ol p pre section table ul""".split())

# Marks of what isn't the article, and of the article, among tags and words of class, id and role.
OTHER_TAGS = frozenset("nav footer aside form button menu noscript template dialog select label fieldset svg".split())
OTHER_WORDS = frozenset("""ad ads adv advert advertisement advertising banner sponsor sponsored promo sidebar comment comments reply respond
    disqus cookie cookies consent gdpr notice alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs footer header
    masthead login subscribe newsletter signup share social related recommended widget tags pagination pager copyright hidden
    contentinfo complementary search""".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article post entry story main articlebody content maincontent".split())

QUOTED = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
MARKS = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s/=>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+")
# A quoted value in a tag may hold ">", if the tag ends within so many characters.
TAG_CHARS = 1 << 16

PATH, WORD, MEASURES = 256, 64, 6
# The measures of length rise up to here: some 150 words and 1,800 characters.
LONG = 1.25
HIDDEN_UNITS = 16
# Blocks labelled at once, and bytes of text handed on at once.
STEP_BLOCKS = 4096
OUT_BYTES = 4 << 20
THRESHOLD = 0.5


@dataclass
class Block:
    """Text between two block-level tags; `path` is its place among the paths met."""

    path: int
    text: str
    linked: float


class Paths:
    """Tag paths met, as numbers; each has the hashed counts of its tags and marks, and its tokens."""

    def __init__(self):
        self.known: dict[tuple[int, tuple[str, ...]], int] = {}
        self.vectors, self.tokens = [np.zeros(PATH, np.float32)], [()]

    def below(self, parent: int, tokens: tuple[str, ...]) -> int:
        at = self.known.get((parent, tokens))
        if at is None:
            at = self.known[parent, tokens] = len(self.vectors)
            vector = self.vectors[parent].copy()
            for t in tokens:
                vector[zlib.crc32(t.encode("utf-8", "surrogatepass")) % PATH] += 1
            self.vectors.append(vector)
            self.tokens.append(tokens)
        return at


def marks(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id, role and itemprop."""
    out: list[str] = []
    if attributes:
        for _, a, b, c in MARKS.findall(attributes):
            out += ["." + w.lower() for w in WORDS.findall(a or b or c)]
        if HIDDEN.search(attributes):
            out.append(".hidden")
    return tuple(dict.fromkeys(out))


def blocks_of(page: str, paths: Paths) -> list[Block]:
    """The blocks of a page in order.

    Comments, scripts, styles, titles and the texts of input fields are left out; what an unended one holds goes with it.
    Character references are decoded, and white space in a block becomes one space. A line break is white space. End tags that
    nothing opened are passed over, and what ends a paragraph or list item ends it without a tag.
    """
    out: list[Block] = []
    stack: list[tuple[str, int]] = []
    open_: dict[str, int] = {}
    held: list[str] = []
    total = linked = 0
    link = False
    here = at = 0

    def flush():
        nonlocal total, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(here, text, linked / max(total, 1)))
            held.clear()
            total = linked = 0

    def close(name: str, until: frozenset = frozenset()):
        """End the innermost `name` and what is in it, unless an element of `until` lies between."""
        if open_.get(name):
            if until:
                for other, _ in reversed(stack):
                    if other == name:
                        break
                    if other in until:
                        return
            while True:
                other, _ = stack.pop()
                open_[other] -= 1
                if other == name:
                    return

    size = len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            text = page[at:lt]
            if "&" in text:
                text = entities.unescape(text)
            held.append(text)
            total += len(text)
            linked += len(text) if link else 0
        if lt >= size - 1:
            break
        mark = page[lt + 1]
        ending = mark == "/"
        name_at = lt + 2 if ending else lt + 1
        found = NAME.match(page, name_at)
        if not found:
            if mark in "!?/":
                end = page.find("-->", lt + 2) + 2 if page.startswith("<!--", lt) else page.find(">", lt)
                at = end + 1 if end > 1 else size
            else:
                held.append("<")
                at = lt + 1
            continue
        name, after = found[0].lower(), found.end()
        end = page.find(">", after)
        if end < 0:
            break
        attributes = page[after:end]
        if attributes.count('"') % 2 or attributes.count("'") % 2:
            whole = QUOTED.match(page, after, after + TAG_CHARS)
            if whole:
                end = whole.end() - 1
                attributes = page[after:end]
        at = end + 1
        if name in INLINE:
            if name == "br":
                held.append(" ")
            elif name == "a":
                link = not ending
            continue
        flush()
        if ending:
            close(name)
        elif name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            if not stop:
                at = size
                break
            at = page.find(">", stop.end())
            at = size if at < 0 else at + 1
        else:
            if name in ENDS_P:
                close("p", frozenset(("button", "table")))
            group = GROUPS.get(name)
            if group and group != "p":
                inner = frozenset(("ul", "ol", "dl", "table", "select"))
                for other in [t for t, g in GROUPS.items() if g == group]:
                    close(other, inner)
                if group == "tr":
                    close("td", frozenset(("table",)))
            if name not in VOID and not attributes.endswith("/"):
                parent = stack[-1][1] if stack else 0
                stack.append((name, paths.below(parent, (name, *marks(attributes)))))
                open_[name] = open_.get(name, 0) + 1
        here = stack[-1][1] if stack else 0
    flush()
    return out


def features(blocks: list[Block], paths: Paths, places: np.ndarray) -> np.ndarray:
    """One row per block; `places` holds its distance from the page's begin and end, as shares."""
    out = np.zeros((len(blocks), PATH + WORD + MEASURES), np.float32)
    if not blocks:
        return out
    out[:, :PATH] = np.log1p(np.stack([paths.vectors[b.path] for b in blocks]))
    a, held, size = 0, [], 0
    for i, b in enumerate(blocks):
        held.append(b.text.encode("utf-8", "surrogatepass").lower())
        size += len(held[-1])
        if size > 1 << 20 or i == len(blocks) - 1:
            raw = np.frombuffer(b"\n".join(held), np.uint8)
            begins, ends = word_spans(raw)
            heads = np.cumsum([0] + [len(h) + 1 for h in held[:-1]])
            owner = np.searchsorted(heads, begins, side="right") - 1
            hashes = word_hashes(raw, begins, ends)
            sign = np.where(hashes >> np.uint64(63) > 0, 1.0, -1.0)
            spread = np.bincount(owner * WORD + (hashes % np.uint64(WORD)).astype(np.int64), sign, len(held) * WORD).reshape(-1, WORD)
            words = np.bincount(owner, minlength=len(held))
            spread /= np.sqrt(np.maximum(words, 1))[:, None]
            # One word said again and again makes no longer a vector than many words do.
            out[a:i + 1, PATH:PATH + WORD] = spread / np.maximum(np.linalg.norm(spread, axis=1, keepdims=True) / 2, 1)
            out[a:i + 1, -5] = np.minimum(np.log1p(words) / 4, LONG)
            a, held, size = i + 1, [], 0
    out[:, -6] = [min(np.log1p(len(b.text)) / 6, LONG) for b in blocks]
    out[:, -4] = [b.linked for b in blocks]
    out[:, -3] = [b.text[-1] in ".!?…:;\"”" for b in blocks]
    out[:, -2:] = places
    return out


def places_of(begin: int, end: int, n: int) -> np.ndarray:
    at = np.arange(begin, end)
    return np.stack((at / max(n, 1), (n - 1 - at) / max(n, 1)), 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """A bidirectional LSTM with `HIDDEN_UNITS` each way, and a logistic output on both states."""

    def __init__(self, rng: np.random.Generator):
        inputs, h = PATH + WORD + MEASURES, HIDDEN_UNITS
        self.weights = {}
        for way in ("on", "back"):
            self.weights[f"{way}_x"] = rng.normal(0, 0.1, (inputs, 4 * h))
            self.weights[f"{way}_h"] = rng.normal(0, 0.1, (h, 4 * h))
            self.weights[f"{way}_b"] = np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h)))  # remember at first
        self.weights["out"], self.weights["bias"] = rng.normal(0, 0.1, 2 * h), np.zeros(1)
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def run(self, way: str, x: np.ndarray, mask: np.ndarray, state=None, keep: list | None = None):
        """States (steps, pages, units) of one direction over inputs in its order; `state` goes on from a part before."""
        w, h = self.weights, HIDDEN_UNITS
        pre = x @ w[f"{way}_x"] + w[f"{way}_b"]
        hidden, cell = state or (np.zeros((x.shape[1], h), np.float32), np.zeros((x.shape[1], h), np.float32))
        out = np.empty((len(x), x.shape[1], h), np.float32)
        for t in range(len(x)):
            gates = pre[t] + hidden @ w[f"{way}_h"]
            i, f, o = (_sigmoid(gates[:, k * h:(k + 1) * h]) for k in range(3))
            g = np.tanh(gates[:, 3 * h:])
            m = mask[t][:, None]
            new = f * cell + i * g
            squashed = np.tanh(new)
            if keep is not None:
                keep.append((i, f, o, g, cell, squashed, hidden))
            cell = m * new + (1 - m) * cell
            hidden = m * (o * squashed) + (1 - m) * hidden
            out[t] = hidden
        return out, (hidden, cell)

    def logits(self, on: np.ndarray, back: np.ndarray) -> np.ndarray:
        h = HIDDEN_UNITS
        return on @ self.weights["out"][:h] + back @ self.weights["out"][h:] + self.weights["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for padded pages (steps, pages, inputs), blocks with a label of 0 or 1 (else -1)."""
        h, w, states, kept = HIDDEN_UNITS, self.weights, {}, {}
        ways = {"on": (x, mask), "back": (x[::-1], mask[::-1])}
        for way, (a, m) in ways.items():
            kept[way] = []
            states[way] = self.run(way, a, m, keep=kept[way])[0]
        z = self.logits(states["on"], states["back"][::-1])
        p, some = _sigmoid(z), (y >= 0) * mask
        n = max(some.sum(), 1)
        loss = float(-(some * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / n)
        dz = ((p - y) * some / n).astype(np.float32)
        out = {"bias": dz.sum(keepdims=True).reshape(1), "out": np.concatenate(
            [np.einsum("tp,tph->h", dz, s) for s in (states["on"], states["back"][::-1])])}
        for way, (a, m) in ways.items():
            part = w["out"][:h] if way == "on" else w["out"][h:]
            above = (dz if way == "on" else dz[::-1])[:, :, None] * part
            d_pre = np.empty((len(a), a.shape[1], 4 * h), np.float32)
            dh, dc = np.zeros_like(above[0]), np.zeros_like(above[0])
            d_recurrent = np.zeros_like(w[f"{way}_h"])
            for t in range(len(a) - 1, -1, -1):
                i, f, o, g, cell, squashed, hidden = kept[way][t]
                mt = m[t][:, None]
                total = dh + above[t]
                live = total * mt
                d_cell = dc * mt + live * o * (1 - squashed ** 2)
                d_gates = np.concatenate((d_cell * g * i * (1 - i), d_cell * cell * f * (1 - f), live * squashed * o * (1 - o),
                                          d_cell * i * (1 - g ** 2)), 1)
                d_pre[t] = d_gates
                d_recurrent += hidden.T @ d_gates
                dh = d_gates @ w[f"{way}_h"].T + total * (1 - mt)
                dc = d_cell * f + dc * (1 - mt)
            flat = d_pre.reshape(-1, 4 * h)
            out[f"{way}_x"], out[f"{way}_h"], out[f"{way}_b"] = a.reshape(-1, a.shape[2]).T @ flat, d_recurrent, flat.sum(0)
        return loss, out

    def scores(self, pages: list[list[Block]], paths: Paths) -> list[np.ndarray]:
        """The probability of each block to be main text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            # Pages of about the same length are padded and read together.
            while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= STEP_BLOCKS:
                end += 1
            some = [pages[i] for i in order[at:end]]
            if len(some) == 1 and len(some[0]) > STEP_BLOCKS:
                out[order[at]] = self._long(some[0], paths)
            else:
                x, mask = padded([features(b, paths, places_of(0, len(b), len(b))) for b in some])
                on, back = self.run("on", x, mask)[0], self.run("back", x[::-1], mask[::-1])[0][::-1]
                p = _sigmoid(self.logits(on, back))
                for k, i in enumerate(order[at:end]):
                    out[i] = p[:len(pages[i]), k]
            at = end
        return out

    def _long(self, blocks: list[Block], paths: Paths) -> np.ndarray:
        """A page of any length, part by part; only its states are held."""
        n, states = len(blocks), {}
        cuts = [(a, min(a + STEP_BLOCKS, n)) for a in range(0, n, STEP_BLOCKS)]
        for way, parts in (("on", cuts), ("back", cuts[::-1])):
            state, held = None, []
            for a, b in parts:
                x = features(blocks[a:b], paths, places_of(a, b, n))[:, None, :]
                seen, state = self.run(way, x if way == "on" else x[::-1], np.ones((b - a, 1), np.float32), state)
                held.append(seen if way == "on" else seen[::-1])
            states[way] = np.concatenate(held if way == "on" else held[::-1])
        return _sigmoid(self.logits(states["on"], states["back"]))[:, 0]


def padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in parts)
    x, mask = np.zeros((steps, len(parts), PATH + WORD + MEASURES), np.float32), np.zeros((steps, len(parts)), np.float32)
    for k, p in enumerate(parts):
        x[:len(p), k], mask[:len(p), k] = p, 1
    return x, mask


# --- training ---

# Layouts of the training pages. Each container is a path of tag.class#id; "*" marks prose, "-" short lines, "=" links.
ARTICLES = ["article", "main", "main article", "div.content", "div.post-content", "div.entry-content section", "div#main div.article-body",
            "section", "div div", "table tr td", "div#content", "article div.text", "div.story", "section article"]
AROUND = {
    "menu": ["nav ul li=", "div.menu ul li=", "ul.navbar li=", "div ul li=", "nav=", "div#nav p=", "menu li=", "header nav ul li="],
    "header": ["header-", "div.header-", "div#masthead p-", "header div.logo-", "header p*", "div#header h1-"],
    "footer": ["footer-", "div.footer p-", "div#footer-", "footer p*", "footer ul li=", "div.copyright-", "footer*"],
    "sidebar": ["aside p*", "div.sidebar p*", "aside ul li=", "div#sidebar div.widget-", "div.sidebar ul li=", "aside h3-", "aside*"],
    "advert": ["div.ad*", "div.ads-", "div.advert p*", "section.sponsored p*", "div.promo*", "aside.ad*", "div#ad-banner-", "div.advertisement*"],
    "notice": ["div.cookie-notice p*", "div.notice*", "div.banner-", "div#gdpr-consent p*", "div.alert*", "div.modal p*", "dialog p-", "noscript*"],
    "form": ["form label-", "form button-", "form.newsletter p*", "div.subscribe form-", "form.search-", "form p*", "form fieldset label-"],
    "comments": ["section.comments p*", "div#comments div.comment p*", "ul.comment-list li.comment p*", "div.comments article p*",
                 "section#reader-comments div*", "div.comment-body*", "ol.comments li*", "div#respond form-"],
    "related": ["div.related ul li=", "section.related h3-", "div.share=", "div.breadcrumb=", "div.tags=", "div.pagination=", "div.social ul li="],
    "hidden": ["div.hidden p*", "template p*"],
}
SHORT = ["Home", "About us", "Contact", "Log in", "Sign up", "Search", "Subscribe", "Share this", "Menu", "Next", "Previous", "Read more",
         "Accept all cookies", "Privacy policy", "Terms of use", "All rights reserved", "© 2024 Example", "Advertisement", "Sponsored",
         "Leave a reply", "3 comments", "Related articles", "Follow us", "Your name", "E-mail address", "Send", "Top stories"]


def teacher(tokens: list[tuple[str, ...]]) -> int:
    """1 where the path's marks say article, 0 where they say something else, -1 without marks."""
    main = False
    for tag, *words in tokens:
        if tag in OTHER_TAGS or (tag == "header" and not main) or any(w[1:] in OTHER_WORDS for w in words):
            return 0
        main = main or tag in MAIN_TAGS or any(w[1:] in MAIN_WORDS for w in words)
    return 1 if main else -1


def chains(paths: Paths) -> list[list[tuple[str, ...]]]:
    out: list[list[tuple[str, ...]]] = [[] for _ in paths.tokens]
    for (parent, tokens), at in paths.known.items():  # parents come first
        out[at] = [*out[parent], tokens]
    return out


class Layouts:
    """Training pages: texts of the sample in layouts with known labels."""

    def __init__(self, pages: list[list[tuple[str, int]]], seed: int):
        """`pages`: text and teacher's label of each block."""
        self.rng = random.Random(seed)
        self.mains = [m for m in ([t for t, label in p if label == 1] for p in pages) if m]
        if not self.mains:
            self.mains = [m for m in ([t for t, label in p if label < 0 and len(t) > 80] for p in pages) if m]
        if not self.mains:
            self.mains = [[t for t, _ in p] for p in pages if p]
        self.prose = [t for m in self.mains for t in m if len(t) < 2000] or [m[0] for m in self.mains]
        self.lines = SHORT * 3 + [t for p in pages for t, label in p if label == 0 and len(t) < 300]

    def _path(self, spec: str, paths: Paths, at: int) -> int:
        for element in spec.split():
            tag, *rest = re.split(r"([.#])", element)
            words = WORDS.findall(" ".join(rest[1::2]))
            at = paths.below(at, (tag, *(f".{w}" for w in words)))
        return at

    def _other(self, kind: str, paths: Paths, at: int) -> list[tuple[Block, int]]:
        spec, rng = self.rng.choice(AROUND[kind]), self.rng
        mode, at = spec[-1], self._path(spec[:-1], paths, at)
        out = []
        for _ in range(rng.randrange(1, 7 if mode != "-" else 4)):
            if mode == "*":
                text, linked = rng.choice(self.prose if rng.random() < 0.7 else self.lines), rng.choice([0, 0, 0.1])
            elif mode == "=":
                text, linked = rng.choice([rng.choice(SHORT), " ".join(rng.choice(self.prose).split()[:rng.randrange(1, 8)])]), 1.0
            else:
                text, linked = rng.choice(self.lines), rng.choice([0, 0, 1.0])
            if text:
                out.append((Block(at, text, linked), 0))
        return out

    def _article(self, paths: Paths, at: int) -> list[tuple[Block, int]]:
        rng, texts = self.rng, self.rng.choice(self.mains)
        at = self._path(rng.choice(ARTICLES), paths, at)
        first = rng.randrange(max(1, len(texts) - 3))
        texts, out = texts[first:first + rng.randrange(2, 30)], []
        if rng.random() < 0.2:  # lines and words that repeat don't make another article
            words = rng.choice(texts).split()
            line = " ".join(words[:rng.randrange(1, 5)]) if rng.random() < 0.6 else " ".join(words[:1] * rng.randrange(2, 300))
            k = rng.randrange(len(texts) + 1)
            texts = [*texts[:k], *[line] * rng.randrange(1, 40), *texts[k:]]
        for k, text in enumerate(texts):
            tag = rng.choice(["h1", "header h1", "h2", "p", ""]) if not k else rng.choice(
                ["p"] * 12 + ["", "h2", "h3", "ul li", "blockquote p", "blockquote", "pre", "figure figcaption", "div p", "p p", "ol li", "div"])
            if tag.startswith(("h", "ul", "ol")) and rng.random() < 0.8:
                text = " ".join(text.split()[:rng.randrange(1, 12)])
            out.append((Block(self._path(tag, paths, at), text, rng.choice([0, 0, 0, 0.05, 0.3])), 1))
            if rng.random() < 0.04:
                out += self._other(rng.choice(["advert", "related", "sidebar", "notice", "form"]), paths, at)
        if rng.random() < 0.25:
            out += self._other(rng.choice(["comments", "footer", "related"]), paths, at)
        return out

    def page(self, paths: Paths) -> list[tuple[Block, int]]:
        rng = self.rng
        at = self._path(rng.choice(["html body", "html body", "", "html body div#page", "html body div.container", "html body div.wrapper div.row"]), paths, 0)
        out: list[tuple[Block, int]] = []
        for kind, chance in (("notice", 0.3), ("header", 0.5), ("menu", 0.7), ("advert", 0.4), ("sidebar", 0.3), ("related", 0.2)):
            out += self._other(kind, paths, at) if rng.random() < chance else []
        out += self._article(paths, at)
        for kind, chance in (("advert", 0.3), ("comments", 0.4), ("form", 0.3), ("related", 0.3), ("sidebar", 0.4), ("menu", 0.1),
                             ("hidden", 0.1), ("footer", 0.7), ("notice", 0.1)):
            out += self._other(kind, paths, at) if rng.random() < chance else []
        return out


def train_labeller(pages: list[str], seed: int = 1, layouts: int = 1200, epochs: int = 10, window: int = 96) -> Labeller | None:
    """A labeller trained on these pages, as they are where marks label them, and in `layouts` new ones; None without any text.

    Training reads at most `window` blocks of a page at once; labelling reads all.
    """
    paths = Paths()
    parsed = [b for b in (blocks_of(p, paths) for p in pages) if b]
    if not parsed:
        return None
    chain = chains(paths)
    marked = [[(b, teacher(chain[b.path])) for b in p] for p in parsed]
    maker = Layouts([[(b.text, label) for b, label in p] for p in marked], seed)
    samples = marked + [maker.page(paths) for _ in range(layouts)]
    rows = []
    for p in samples:
        for a in range(0, min(len(p), 4 * window), window):
            part = p[a:a + window]
            x = features([b for b, _ in part], paths, places_of(a, a + len(part), len(p)))
            rows.append((x, np.array([label for _, label in part], np.float32)))
    rows.sort(key=lambda r: len(r[0]))
    batches = []
    for a in range(0, len(rows), 32):
        x, mask = padded([r[0] for r in rows[a:a + 32]])
        y = np.full(mask.shape, -1, np.float32)
        for k, (_, labels) in enumerate(rows[a:a + 32]):
            y[:len(labels), k] = labels
        batches.append((x, mask, y))
    rng = np.random.default_rng(seed)
    model = Labeller(rng)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs)
        for b in rng.permutation(len(batches)):
            x, mask, y = batches[b]
            # Inputs left out now and then, those of words and lengths more often: none is to decide alone.
            share = np.where(np.arange(x.shape[2]) < PATH, 0.1, 0.4)
            loss, slopes = model.gradients(x * (rng.random(x.shape[2]) > share), mask, y)
            step += 1
            for k, slope in slopes.items():
                slope = np.clip(slope, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope ** 2
                model.weights[k] = (model.weights[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 256, sample_bytes: int = 1 << 18,
          seed: int = 1) -> Labeller | None:
    """A labeller for this corpus, from `sample` different pages of up to `sample_bytes`, those with the least hashes of id and html
    among about twice as many, which come to the driver."""
    text = F.col(f"`{html_col}`").cast("string")
    rows = pages.where(F.octet_length(text) <= sample_bytes).select(
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string"), text).alias("h"), text.alias("html"))
    different = rows.agg(F.approx_count_distinct("h").alias("n")).first()["n"]
    chosen = rows.where(F.pmod("h", F.lit(max(1, different // (2 * sample)))) == 0).dropDuplicates(["h"]).limit(8 * sample).collect()
    return train_labeller([r["html"] for r in sorted(chosen)[:sample]], seed)


TEXTS = "text string, n_chars bigint, n_blocks bigint, n_main bigint"


def extract(pages: DataFrame, model: Labeller | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars, n_blocks and n_main of each page: the text of its main blocks, joined by newlines.

    Null and empty pages, and pages without text, give an empty text. Pages of any length are read whole. Rows are judged one by one,
    so that repeated rows agree; an empty table gives no rows; other columns aren't read.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = Paths()
        names = ["id", "url", "text", "n_chars", "n_blocks", "n_main"]
        held: list[tuple[pa.Array, pa.Array, list[Block]]] = []
        count = size = 0

        def done() -> pa.RecordBatch:
            scores = model.scores([h[2] for h in held], paths) if model else [np.zeros(len(h[2])) for h in held]
            kept = [[b.text for b, p in zip(h[2], s) if p >= THRESHOLD] for h, s in zip(held, scores)]
            texts = ["\n".join(k) for k in kept]
            columns = [pa.concat_arrays([h[c] for h in held]) for c in (0, 1)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                                               pa.array([len(h[2]) for h in held], pa.int64()), pa.array([len(k) for k in kept], pa.int64())], names)

        for batch in batches:
            for i in range(batch.num_rows):
                page = batch.column(2)[i].as_py() or ""
                held.append((batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), blocks_of(page, paths)))
                count, size = count + len(held[-1][2]) + 1, size + len(page)
                if count >= STEP_BLOCKS or size >= OUT_BYTES:
                    yield done()
                    held, count, size = [], 0, 0
                    if len(paths.vectors) > 20_000:
                        paths = Paths()
        if held:
            yield done()

    return rows.mapInArrow(run, f"id {kind}, url string, {TEXTS}").withColumnsRenamed({"id": id_col, "url": url_col})


# The pages of the test tables have one layout; its article by regular expressions, for them only.
SQL = r"""
WITH cut AS (
  SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(p|h1)>') AS parts FROM pages),
texts AS (SELECT page_id, url, array_to_string([x FOR x IN [
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
      '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) FOR x IN parts] IF x <> ''], chr(10)) AS text FROM cut)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM texts
"""


@query("op11_html_text", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages)).select("page_id", "url", "text", "n_chars")
