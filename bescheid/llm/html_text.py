"""Main text of web pages: a bidirectional LSTM labels every text block in its page's context."""

from __future__ import annotations

import bisect
import html
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import mapped, ship, strings, table

PATH, WORDS, EXTRA, HIDDEN = 512, 128, 10, 12
WIDTH = PATH + WORDS + EXTRA

_NAME = re.compile(r"[a-z][a-z0-9-]*", re.IGNORECASE)
#: Elements whose inside is no text of the page.
_SILENT = "script style noscript template textarea iframe svg".split()
_RAW = re.compile(rf"(?:{'|'.join(_SILENT)})\b", re.IGNORECASE)
_CLOSE = {x: re.compile(rf"</{x}\s*>", re.IGNORECASE) for x in _SILENT}
_ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_SPECIAL = re.compile("[\"'>]")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark picture q s samp small source span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag of the same group closes, up to the nearest other container.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BEFORE = {"p": frozenset({"p"}), **{h: frozenset({"p"}) for h in "h1 h2 h3 h4 h5 h6 div ul ol dl table form section article aside nav header footer main blockquote pre figure fieldset address hr".split()}}
_buckets: dict[str, int] = {}


def _bucket(word: str, size: int) -> int:
    got = _buckets.get(word)
    if got is None:
        if len(_buckets) > 200_000:
            _buckets.clear()
        got = _buckets[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return got % size


class _Ends:
    """Where tags of a page end: at the first `>` outside quotes.

    A tag is read ahead. If that reads the page several times over, as quotes that close nowhere make it, the ends are worked
    out once for all places, from the back: behind a quote the end is that behind its partner.
    """

    def __init__(self, page: str):
        self.page, self.left, self.spots, self.ends = page, 8 * len(page) + 1000, None, []

    def after(self, at: int) -> int:
        """The place behind the tag whose attributes begin at `at`; -1 if it has no end outside quotes."""
        if self.spots is None:
            m = _ATTRIBUTES.match(self.page, at)
            end = m.end() if m else -1
            self.left -= (end if m else len(self.page)) - at
            if self.left < 0:
                self._all()
            return end
        return self.ends[bisect.bisect_left(self.spots, at)]

    def _all(self) -> None:
        self.spots = [m.start() for m in _SPECIAL.finditer(self.page)]
        self.ends = [-1] * (len(self.spots) + 1)
        partner: dict[str, int] = {}
        for k in range(len(self.spots) - 1, -1, -1):
            at = self.spots[k]
            c = self.page[at]
            if c == ">":
                self.ends[k] = at + 1
            else:
                j = partner.get(c)
                self.ends[k] = -1 if j is None else self.ends[j + 1]
                partner[c] = k


def _tokens(page: str) -> Iterator[tuple[str | None, str, bool, str | None]]:
    """(text or None, tag, whether it ends one, attributes or None) in order, in time that grows with the page.

    Comments, declarations and elements without text are left out, to the page's end if nothing closes them.
    """
    ends, last, n, at = _Ends(page), page.rfind(">"), len(page), 0
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield page[at:], "", False, None
            return
        if lt > at:
            yield page[at:lt], "", False, None
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        sign = page[lt + 1 : lt + 2]
        m = _NAME.match(page, lt + 2 if sign == "/" else lt + 1) if lt < last else None
        if m:
            if sign != "/" and (raw := _RAW.match(page, lt + 1)):
                name, end = raw[0].lower(), -1
                if name == "svg":  # closed by itself: nothing is in it
                    end = ends.after(raw.end())
                    end = end if end > 0 and page[end - 2] == "/" else -1
                if end < 0:
                    close = _CLOSE[name].search(page, page.find(">", raw.end()) + 1)
                    end = close.end() if close else n
                at = end
                continue
            end = ends.after(m.end())
            yield None, m[0], sign == "/", page[m.end() : end - 1] if end > 0 else None
            at = end if end > 0 else page.find(">", m.end()) + 1
        elif sign and sign in "!?/":
            end = page.find(">", lt + 2)
            at = n if end < 0 else end + 1
        else:
            yield "<", "", False, None
            at = lt + 1


class Block:
    """A text with the hashed names of all its open elements, the innermost tag, whether a title is open, and its share in links."""

    __slots__ = ("text", "ids", "tag", "titled", "linked")

    def __init__(self, text: str, ids: frozenset[int], tag: str, titled: bool, linked: float):
        self.text, self.ids, self.tag, self.titled, self.linked = text, ids, tag, titled, linked


def blocks(page: str) -> list[Block]:
    """The leaf text blocks of a page in order, with their open elements and the share of their text in links.

    Scripts, styles and comments give nothing; character references are decoded; white space becomes one space.
    A tag that starts or ends anything but an inline element ends a block, and so does a line break.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    tags: Counter[str] = Counter()  # of the stack
    held: Counter[int] = Counter()  # hashed names of the stack
    ids: frozenset[int] | None = frozenset()
    parts: list[str] = []
    linked = 0
    total = 0

    def cut(i: int, end: int | None = None) -> None:
        nonlocal ids
        for tag, own in stack[i:end]:
            tags[tag] -= 1
            for x in own:
                if held[x] == 1:
                    del held[x]
                    ids = None
                else:
                    held[x] -= 1
        del stack[i:end]

    def unlink() -> None:
        """Take the innermost open link off the stack; what stands in it stays open."""
        i = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "a")
        cut(i, i + 1)

    def flush() -> None:
        nonlocal ids, linked, total
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                ids = frozenset(held) if ids is None else ids
                out.append(Block(text, ids, stack[-1][0] if stack else "", tags["title"] > 0, linked / max(total, 1)))
            parts.clear()
        linked = total = 0

    for text, tag, ended, attrs in _tokens(page):
        if text is not None:
            if parts or not text.isspace():
                parts.append(html.unescape(text) if "&" in text else text)
                total += len(text)
                if tags["a"] > 0:
                    linked += len(text)
            continue
        tag = tag.lower()
        inline = tag in _INLINE
        if not inline:
            flush()
        if ended:
            if tags[tag] > 0:
                i = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                # an inline element that ends below open blocks ends alone
                cut(i, i + 1 if inline and any(x not in _INLINE for x, _ in stack[i + 1 :]) else None)
            continue
        for group in (_CLOSES.get(tag), _BEFORE.get(tag)):
            if group and any(tags[x] > 0 for x in group):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in group:
                        cut(i)
                        break
                    if stack[i][0] not in _INLINE and stack[i][0] != "p":
                        break
        if tag in _VOID:
            continue
        if tag == "a" and tags["a"] > 0:  # links do not nest: the next one ends one left open
            unlink()
        own = [_bucket("<" + tag, PATH)]
        if attrs and "=" in attrs:
            for x in _NAMES.findall(attrs):
                own += [_bucket("." + w, PATH) for w in re.findall(r"[a-z]+", "".join(x).lower())]
        stack.append((tag, tuple(own)))
        tags[tag] += 1
        for x in own:
            if x not in held:
                ids = None
            held[x] += 1
    flush()
    return out


def measures(found: list[Block]) -> np.ndarray:
    n = len(found)
    out = np.zeros((n, EXTRA), np.float32)
    for i, b in enumerate(found):
        words = b.text.count(" ") + 1
        out[i] = (1.0, np.log1p(len(b.text)) / 6, b.linked, min(words, 100) / 100, b.text[-1] in ".!?…:", b.text.count(",") / words, i / n, b.tag[:1] == "h" and len(b.tag) == 2, np.log1p(n) / 6, "©" in b.text)
    return out


def vectors(found: list[Block]) -> np.ndarray:
    """One row per block: its tag path and words, both hashed, and a few measures. For training; see `Labeller.projected`."""
    x = np.zeros((len(found), WIDTH), np.float32)
    for i, b in enumerate(found):
        x[i, list(b.ids)] = 1
        words = b.text.lower().split(" ")
        np.add.at(x[i], [PATH + _bucket(w, WORDS) for w in words], np.float32(1 / len(words)))
    x[:, PATH + WORDS :] = measures(found)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with a logistic output for each step; padded batches are (steps, pages, width)."""

    def __init__(self, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 5):
        r, h = np.random.default_rng(seed), hidden
        self.h = h
        self.p = {f"{k}{d}": v for d in (0, 1) for k, v in (("x", r.normal(0, 0.05, (width, 4 * h))), ("h", r.normal(0, 0.2, (h, 4 * h))), ("b", np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h)))))}
        self.p |= {"o": r.normal(0, 0.3, 2 * h), "c": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, z: np.ndarray, mask: np.ndarray, d: int, keep: list | None) -> np.ndarray:
        """States of direction d from input projections z; masked steps pass the state through."""
        h, w = self.h, self.p[f"h{d}"]
        steps, n = z.shape[:2]
        hs, cs = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out = np.zeros((steps, n, h), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            g = z[t] + hs @ w
            s = _sigmoid(g[:, : 3 * h])
            i, f, o, u = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], np.tanh(g[:, 3 * h :])
            c = f * cs + i * u
            tc = np.tanh(c)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, i, f, o, u, cs, tc, hs, m))
            cs = m * c + (1 - m) * cs
            hs = m * (o * tc) + (1 - m) * hs
            out[t] = hs
        return out

    def projected(self, found: list[Block], part: int = 4096) -> np.ndarray:
        """What `vectors` times the input weights of both directions gives, from the few cells that are not zero.

        A path's rows are summed once for all its blocks; words are summed for `part` blocks at a time.
        """
        w = np.concatenate((self.p["x0"], self.p["x1"]), axis=1)
        paths: dict[frozenset[int], int] = {}
        path = [paths.setdefault(b.ids, len(paths)) for b in found]
        out = np.array([w[list(ids)].sum(axis=0) if ids else np.zeros(w.shape[1]) for ids in paths], np.float32)[path]
        for at in range(0, len(found), part):
            words = [b.text.lower().split(" ") for b in found[at : at + part]]
            many = np.array([len(x) for x in words])
            cells = np.bincount(np.repeat(np.arange(len(words)), many) * WORDS + np.array([_bucket(y, WORDS) for x in words for y in x]), minlength=len(words) * WORDS).reshape(-1, WORDS)
            out[at : at + part] += (cells / many[:, None]).astype(np.float32) @ w[PATH : PATH + WORDS]
        return out + measures(found) @ w[PATH + WORDS :]

    def forward(self, x: np.ndarray, mask: np.ndarray, tape: dict | None = None) -> np.ndarray:
        return self.labels(np.concatenate((x @ self.p["x0"], x @ self.p["x1"]), axis=2), mask, tape)

    def labels(self, z: np.ndarray, mask: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """P(main) at each step from the projections of both directions."""
        states = []
        for d in (0, 1):
            keep = None if tape is None else []
            states.append(self._run(z[:, :, 4 * self.h * d : 4 * self.h * (d + 1)] + self.p[f"b{d}"], mask, d, keep))
            if tape is not None:
                tape[d] = keep
        both = np.concatenate(states, axis=2)
        if tape is not None:
            tape["both"] = both
        return _sigmoid(both @ self.p["o"] + self.p["c"])

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        tape: dict = {}
        h = self.h
        e = (self.forward(x, mask, tape) - y) * mask / mask.sum()
        g = {"o": np.tensordot(e, tape["both"], 2), "c": np.array([e.sum()])}
        for d in (0, 1):
            w = self.p[f"h{d}"]
            dz = np.zeros((*x.shape[:2], 4 * h), np.float32)
            dw = np.zeros_like(w)
            dh, dc = np.zeros((x.shape[1], h), np.float32), np.zeros((x.shape[1], h), np.float32)
            for t, i, f, o, u, cs, tc, hs, m in reversed(tape[d]):
                dh = dh + e[t][:, None] * self.p["o"][d * h : (d + 1) * h]
                a = dh * m
                b = dc * m + a * o * (1 - tc * tc)
                z = np.concatenate((b * u * i * (1 - i), b * cs * f * (1 - f), a * tc * o * (1 - o), b * i * (1 - u * u)), axis=1)
                dz[t] = z
                dw += hs.T @ z
                dh = z @ w.T + dh * (1 - m)
                dc = b * f + dc * (1 - m)
            g[f"h{d}"], g[f"b{d}"] = dw, dz.sum(axis=(0, 1))
            g[f"x{d}"] = x.reshape(-1, x.shape[2]).T @ dz.reshape(-1, 4 * h)
        return g


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


_BOILER = "home about contact login register subscribe newsletter privacy cookies cookie accept terms copyright rights reserved share search menu follow us read more related posts comment reply advertisement sponsored sign up next previous archive tags categories sitemap impressum datenschutz anmelden suche kontakt startseite accueil contacto inicio buscar"


#: Layouts of invented pages and their weights: telling names or elements; names that say nothing; nested divs without
#: names; text and little else; a table as frame; lines parted by <br>; few paragraphs, some of them links, beside forms and
#: readers' comments.
FAMILIES = {"named": 10, "utility": 3, "divs": 3, "plain": 3, "table": 2, "breaks": 1, "sparse": 3}


def _page(r: random.Random, family: str = "named") -> tuple[str, set[str]]:
    """An invented page and the texts of its main blocks."""
    main: set[str] = set()
    letters = r.choice((string.ascii_lowercase, string.ascii_lowercase + "äöüßéèêçñáíó"))
    noise = r.choice(("", "", "", "***", "&&&", "%%%", "$$$", "!!", " |"))

    def word() -> str:
        return "".join(r.choice(letters) for _ in range(r.randint(1, 11)))

    def words(a: int, b: int) -> str:
        ws = [word() + (noise if r.random() < 0.8 else "") + r.choice(("", "", "", "", ",", ".")) for _ in range(r.randint(a, b))]
        return " ".join(" ".join(ws).capitalize().split()) + r.choice((".", ".", ".", ""))

    def boiler(a: int, b: int) -> str:
        own = _BOILER.split()
        return " ".join(r.choice(own) if r.random() < 0.5 else word() for _ in range(r.randint(a, b))) if r.random() < 0.5 else words(a, b)

    def keep(text: str) -> str:
        main.add(" ".join(text.split()))
        return html.escape(text, quote=False)

    def box(tag: str, names: list[str], inner: str) -> str:
        n = r.choice(names)
        attr = "" if not n else r.choice((f' class="{n}"', f" id='{n}'", f' class="{n} {word()}"', f" class={n}", f' id="{n}" class="{word()}"'))
        return f"<{tag}{attr}>{inner}" + (f"</{tag}>" if r.random() < 0.97 else "")

    def links(a: int, b: int) -> str:
        n = r.randint(a, b)
        return r.choice((lambda: "<ul>" + "".join(f'<li><a href="/{word()}">{boiler(1, 3)}</a></li>' for _ in range(n)) + "</ul>", lambda: " ".join(f'<a href="#">{boiler(1, 2)}</a>' for _ in range(n))))()

    def paras(n: int, own: bool) -> str:
        out = []
        for _ in range(n):
            k, t = r.random(), (lambda a, b: keep(words(a, b)) if own else boiler(a, b))
            if k < 0.62:
                out.append(f"<p>{r.choice(('', '<b>', '<em>'))}{t(1, 90)}{r.choice(('</p>', '</p>', '', '<br>'))}")
            elif k < 0.72:
                out.append(f"<h{r.randint(2, 4)}>{t(1, 9)}</h{2}>")
            elif k < 0.82:
                out.append("<ul>" + "".join(f"<li>{t(1, 20)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif k < 0.88:
                out.append(f"<blockquote>{t(3, 40)}</blockquote>")
            elif k < 0.93:
                out.append("<table>" + "".join(f"<tr><td>{t(1, 4)}<td>{t(1, 4)}</tr>" for _ in range(r.randint(1, 3))) + "</table>")
            elif k < 0.96:
                out.append(f"<figure><img src=x><figcaption>{t(2, 12)}</figcaption></figure>")
            else:
                out.append(f"<div>{t(1, 60)}</div>")
        return "".join(out)

    ad = lambda: box(r.choice(("div", "div", "aside", "ins", "section")), ["ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "ad-slot"], r.choice((boiler(2, 20), f"<p>{boiler(3, 30)}</p>")))
    nav = lambda: r.choice((lambda: f"<nav>{links(2, 9)}</nav>", lambda: box("div", ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav"], links(2, 9)), lambda: box("ul", ["menu", "nav"], "".join(f"<li><a href=x>{boiler(1, 2)}</a>" for _ in range(r.randint(2, 8))))))()
    header = lambda: r.choice((lambda: f"<header>{boiler(1, 8)}{nav() if r.random() < 0.4 else ''}</header>", lambda: box("div", ["header", "masthead", "site-header", "top", "logo"], f"<h1>{boiler(1, 5)}</h1>" if r.random() < 0.3 else boiler(1, 6))))()
    side = lambda: box(r.choice(("aside", "aside", "div")), ["sidebar", "side", "widget", "related", "aside", "rail"], r.choice((lambda: links(2, 8), lambda: f"<h3>{boiler(1, 4)}</h3>" + paras(r.randint(1, 3), False)))())
    notice = lambda: box("div", ["cookie", "cookie-notice", "notice", "consent", "banner", "gdpr", "alert", "popup", "modal", "cookie-banner"], f"<p>{boiler(5, 40)}</p><button>{boiler(1, 2)}</button>")
    form = lambda: f"<form action=x>{r.choice(('', '<label>' + boiler(1, 3) + '</label>', '<p>' + boiler(4, 20) + '</p>'))}<input name=q><select><option>{boiler(1, 2)}<option>{boiler(1, 2)}</select><button>{boiler(1, 2)}</button></form>"
    remarks = lambda: box(r.choice(("div", "section", "ol", "ul")), ["comments", "comment-list", "commentlist", "discussion", "responses", "user-comments", "reader-comments", "disqus_thread", "comments-area", "comment-section", "fb-comments", "respond"], "".join(box(r.choice(("div", "li", "article")), ["comment", "reply", "comment-body", "", "post", "media-body", "comment-content"], (f"<b>{boiler(1, 2)}</b>" if r.random() < 0.5 else "") + f"<p>{words(3, 70)}</p>") for _ in range(r.randint(1, 6))))
    footer = lambda: r.choice((lambda: f"<footer>&copy; {word()}.example.com &middot; {boiler(3, 20)}</footer>", lambda: f"<footer><p>{boiler(3, 20)}</p>{links(1, 5)}</footer>", lambda: box("div", ["footer", "site-footer", "copyright", "bottom", "foot"], f"<p>{boiler(2, 20)}</p>")))()

    title = words(2, 8)
    body = f"<h1>{keep(title)}</h1>" if r.random() < 0.85 else ""
    n = r.choice((0, 1, 1, 2, 3, 5, 8, 13, 20))
    top: list[str] = []
    low: list[str] = []
    if family == "named":
        for k in range(r.randint(1, 3)):
            body += paras(n // (k + 1), True)
            if r.random() < 0.2:
                body += r.choice((ad, side, form, notice))()
        if r.random() < 0.1:
            body += remarks()
        article = r.choice((lambda: f"<article>{body}</article>", lambda: f"<article>{body}</article>", lambda: f"<main>{body}</main>", lambda: f"<main><article>{body}</article></main>", lambda: box("div", ["content", "article", "main", "post", "entry-content", "article-body", "main-content", "story", "text"], body), lambda: box("section", ["content", "article", "main", "post"], body)))()
        top = [f() for f in (header, nav, ad, notice, form, side) if r.random() < 0.4]
        r.shuffle(top)
        low = [f() for f in (remarks, side, ad, form, notice, nav, footer) if r.random() < 0.4]
    elif family == "sparse":
        paragraph = lambda: r.choice(("<p>{}</p>", "<p>{}</p>", '<p><a href="/{1}">{0}</a></p>', "<p>{} <a href=x>{1}</a></p>")[: 2 if r.random() < 0.5 else 3]).format(keep(words(6, 45)), word())
        ask = lambda: f"<form{r.choice(('', ' action=/x', ' method=post'))}>{r.choice(('', '<label>' + boiler(1, 3) + '</label>', '<p>' + boiler(2, 6) + '</p>'))}{r.choice(('<textarea>', '<textarea name=t>', '<textarea rows=4>')) + boiler(0, 6) + '</textarea>' if r.random() < 0.6 else '<input name=q>'}<button>{boiler(1, 2)}</button></form>"
        body = (body if r.random() < 0.4 else "") + "".join(paragraph() for _ in range(r.choice((1, 1, 1, 2, 2, 3, 5))))
        article = r.choice(("{}", "{}", "<div>{}</div>", "<article>{}</article>", "<article>{}</article>", "<main>{}</main>")).format(body)
        top = [f() for f in (nav, ask, header) if r.random() < 0.15]
        low = [f() for f in (ask, remarks, footer) if r.random() < 0.45]
    else:
        # nothing but links, forms, elements and words tells the rest of such a page from its text
        own = lambda k: " ".join(r.choice(_BOILER.split()) for _ in range(k))
        name = (lambda: f' class="{" ".join(r.choice(("mt", "px", "flex", "col", "row", "w", "grid", "x", "css", "sc", "wrap", "box")) + "-" + word() for _ in range(r.randint(1, 6)))}"') if family == "utility" else (lambda: "")
        div = lambda inner: f"<div{name()}>{inner}</div>"
        menu = lambda: div(links(2, 9))
        foot = lambda: r.choice((lambda: div(f"&copy; {r.randint(1990, 2030)} {word().capitalize()} {own(r.randint(0, 5))}"), lambda: div(f"<p>Copyright {word()}. {own(4)}</p>" + links(1, 4)), lambda: f"<footer{name()}>&copy; {own(r.randint(2, 6))}</footer>"))()
        consent = lambda: div(f"<p>{own(r.randint(5, 15))}</p><button>{own(1)}</button>")
        logo = lambda: r.choice((lambda: div(f'<a href="/">{word().capitalize()}</a>'), lambda: f"<header{name()}><a href=/>{word()}</a> {links(1, 5)}</header>"))()
        more = lambda: div(f"<h3>{own(r.randint(1, 3))}</h3>{links(2, 6)}")
        n = max(n, 1)
        if family == "breaks":
            body += div("<br>".join(keep(words(1, 60)) for _ in range(n))) if r.random() < 0.5 else "<br><br>".join(keep(words(1, 60)) for _ in range(n))
        elif family == "plain" and r.random() < 0.5:
            body = body if r.random() < 0.5 else ""
            a, b = r.choice(((1, 6), (1, 6), (3, 30)))
            body += "".join(f"<p>{keep(words(a, b))}</p>" for _ in range(r.choice((1, 1, 1, 2, 4, 12, 60))))
        else:
            body += "".join(div(keep(words(3, 90))) for _ in range(n)) if r.random() < 0.25 else paras(n, True)
        top = [] if family == "plain" and r.random() < 0.6 else [f() for f in (logo, menu, consent) if r.random() < 0.5]
        low = [] if family == "plain" and r.random() < 0.6 else [f() for f in (more, menu, consent, foot) if r.random() < 0.4]
        article = body if family in ("plain", "breaks") else div(body)
        for _ in range(r.randint(0, 3)) if family in ("divs", "utility") else ():
            article = div(article)
        if family == "table":
            cells = [f"<td>{x}" for x in top]
            r.shuffle(cells)
            article = f"<table><tr>{'<tr>'.join(cells)}<td>{article}</td>{''.join(f'<td>{x}</td>' for x in low[:1])}</tr><tr><td>{''.join(low[1:])}</td></tr></table>"
            top, low = [], []
    page = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{html.escape(title, quote=False)}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>{"".join(top)}<!-- {word()} -->{article}{"".join(low)}'
    return page + r.choice(("</body></html>", "")), main


@lru_cache(maxsize=1)
def labeller(pages: int = 3200, passes: int = 6, seed: int = 3, without: str = "") -> Labeller:
    """The network, trained on invented pages with a fixed seed. A title in the head is no main text.

    `without`: a family that it must not see, for measuring what it makes of unknown layouts.
    """
    r, data = random.Random(seed), []
    names = [x for x in FAMILIES if x != without]
    for _ in range(pages):
        page, main = _page(r, r.choices(names, [FAMILIES[x] for x in names])[0])
        found = blocks(page)
        if found:
            data.append((vectors(found), np.array([b.text in main and not b.titled for b in found], np.float32)))
    net = Labeller()
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    data.sort(key=lambda d: len(d[0]))
    groups = [data[i : i + 20] for i in range(0, len(data), 20)]
    step = 0
    for _ in range(passes):
        r.shuffle(groups)
        for g in groups:
            step += 1
            x, mask = _padded([d[0] for d in g])
            hidden = [k for k in range(len(g)) if r.random() < 0.6]
            x[:, hidden, PATH : PATH + WORDS] = 0  # most pages' words are hidden: the path must do without them
            y = _padded([d[1][:, None] for d in g])[0][:, :, 0]
            for k, d in net.gradients(x, y, mask).items():
                d = d + 1e-5 * net.p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.99 * v[k] + 0.01 * d * d
                net.p[k] = (net.p[k] - 0.02 * (1 - step / (passes * len(groups) + 1)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def main_texts(pages: list[str], net: Labeller) -> list[str]:
    """The main blocks of each page, joined by line ends; pages of like length share a padded batch."""
    out = [""] * len(pages)
    found = {i: b for i, p in enumerate(pages) if (b := blocks(p))}
    order = sorted(found, key=lambda i: len(found[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * len(found[order[end]]) <= 4000:
            end += 1
        part = order[at:end]
        p = net.labels(*_padded([net.projected(found[i]) for i in part]))
        for k, i in enumerate(part):
            out[i] = "\n".join([b.text for b, q in zip(found[i], p[:, k].tolist(), strict=False) if q >= 0.5])
        at = end
    return out


def _extractor(net: Labeller):
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pages = strings(b["html"])
            for at in range(0, len(pages), 500):
                texts = main_texts(pages[at : at + 500], net)
                rows = b.iloc[at : at + 500]
                yield pd.DataFrame({"page_id": rows["page_id"].array, "url": rows["url"].array, "text": texts, "n_chars": [len(t) for t in texts]})

    return extract


def extract(pages: DataFrame, net: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of `pages` (page_id, url, html), from the whole html.

    A narrow stage. Null or empty html and pages without main text give an empty text. Null page_id and url
    stay; repeated rows each have their row. A very long page is read whole; its memory grows with its blocks, about
    1 kB each. Empty table: no rows. Other columns are not read.
    """
    ship(pages.sparkSession)
    return mapped(pages.select("page_id", "url", "html"), _extractor(net or labeller()), "page_id long, url string, text string, n_chars long")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages; see `extract`."""
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html", deal=True))
