"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: runs of text between block-level tags. Each has the path of open tags above it (with their
class and id words), its words, and a few measures. Two LSTMs in numpy read the page's blocks forward and backward, so every
block is judged in the context of the whole page. They are trained when the operator starts, on pages made here in many
layouts and on a bounded sample of the corpus, whose blocks inside semantic tags label themselves; there, parts of the paths
are hidden at random, so that no single tag decides.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import small_batches

PATH, WORDS, HIDDEN = 96, 24, 16
MEASURES = 7
#: Pages of the corpus that training looks at, of smallest hash, and made-up pages.
SAMPLE_PAGES, MADE_PAGES = 400, 1200
#: Longer pages (characters) are read like any other, but none is learned from, so that the sample's size is bounded.
LONG_PAGE = 100_000

# Tags of HTML by their part in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
RAW = frozenset("script style title textarea noscript iframe".split())  # to their end tag, or the end of the page
DROPPED = RAW | frozenset("template svg math object select button canvas video audio map".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>?", re.S)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"\w+")


def blocks(page: str | None) -> list[tuple[str, tuple[str, ...], int]]:
    """(text, path, characters in links) of a page's leaf blocks in page order. Scripts, styles, comments and the head are no
    text; references are decoded and white space inside a block is one space. Unclosed tags are closed as browsers do."""
    page = page or ""
    out: list[tuple[str, tuple[str, ...], int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links, in_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append((text, tuple(w for _, ws in stack for w in ws), links))
            parts.clear()
        links = 0

    n = len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            piece = page[at:lt]
            parts.append(piece)
            if in_link:
                links += len(piece.strip())
        if lt == n:
            break
        m = _TOKEN.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            parts.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m.lastindex is None:  # a comment or declaration
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:-3].replace("&", "&amp;"))
            continue
        name = m[2].lower()
        if m[1]:
            if name not in INLINE:
                flush()
            elif name == "a":
                in_link = max(0, in_link - 1)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in ("td", "th", "table", "article", "body") and name in INLINE:
                    break
            continue
        if name in DROPPED:
            if name not in ("svg", "math", "button"):
                flush()
            if not (m[3] or "").rstrip().endswith("/") or name in RAW:
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n if name in RAW else at
            continue
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                in_link += 1
            if name in VOID:
                continue
        else:
            flush()
            if name in CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE:
                        break
            if name in ("li", "td", "th", "tr", "dd", "dt"):
                stop = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",)}.get(name, ("tr", "table"))
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name or (name in ("td", "th") and stack[k][0] in ("td", "th")) or (name in ("dd", "dt") and stack[k][0] in ("dd", "dt")):
                        del stack[k:]
                        break
                    if stack[k][0] in stop:
                        break
            if name in VOID:
                continue
        marks = [w.lower() for v in _MARKS.findall(m[3] or "") for w in _WORD.findall(v[0] or v[1] or v[2])] if m[3] and "=" in m[3] else []
        if not (m[3] or "").endswith("/"):
            stack.append((name, (name, *("." + w for w in marks))))
    flush()
    return out


def _bucket(word: str, n: int, salt: str) -> int:
    return zlib.crc32((salt + word).encode()) % n


_path_of: dict[str, int] = {}


class _Words(dict):
    """Buckets of words, of so many at a time."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = k = _bucket(word, WORDS, "w")
        return k


_word_of = _Words()


def vectors(page: list[tuple[str, tuple[str, ...], int]], hide: np.random.Generator | None = None) -> np.ndarray:
    """The input of each block: hashed path, hashed words, measures. All words of a block count, each bucket by the root of its
    share of them, so that long blocks do not saturate. hide: leaves path words out at random, page by page."""
    x = np.zeros((len(page), PATH + WORDS + MEASURES), np.float32)
    gone: dict[str, bool] = {}
    for i, (text, path, links) in enumerate(page):
        for w in path:
            if hide is not None and gone.setdefault(w, hide.random() < 0.3):
                continue
            k = _path_of.get(w)
            if k is None:
                if len(_path_of) > 100_000:
                    _path_of.clear()
                k = _path_of[w] = _bucket(w, PATH, "p")
            x[i, k] = 1
        words = text.lower().split()
        x[i, PATH : PATH + WORDS] = np.sqrt(np.bincount([_word_of[w] for w in words], minlength=WORDS) / max(1, len(words))) / 3
        n = len(text)
        x[i, -MEASURES:] = (np.log1p(n) / 7, min(links / max(n, 1), 1), i / max(1, len(page)), (len(page) - i) / max(1, len(page)), text[-1] in ".!?:;\"”»", "©" in text or "@" in text, np.log1p(len(words)) / 5)
    return x


class Labeller:
    """Forward and backward LSTM and a logistic output; parameters by name."""

    def __init__(self, size: int = PATH + WORDS + MEASURES, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, 0.15, (size, 4 * hidden))
            self.p["U" + d] = rng.normal(0, 0.15, (hidden, 4 * hidden))
            self.p["b" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        self.p["v"], self.p["c"] = rng.normal(0, 0.2, 2 * hidden + size), np.zeros(1)

    def _run(self, a: np.ndarray, mask: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """a: steps x pages x 4h inputs; the order of steps is the direction's."""
        steps, pages, h = a.shape[0], a.shape[1], self.h
        out, tape = np.zeros((steps, pages, h)), []
        s, c = np.zeros((pages, h)), np.zeros((pages, h))
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = a[t] + s @ self.p["U" + d]
            z[:, : 3 * h] = 1 / (1 + np.exp(-np.clip(z[:, : 3 * h], -30, 30)))
            g = np.tanh(z[:, 3 * h :])
            i, f, o = z[:, :h], z[:, h : 2 * h], z[:, 2 * h : 3 * h]
            c2 = (f * c + i * g) * mask[t][:, None]
            tc = np.tanh(c2)
            s2 = o * tc * mask[t][:, None]
            if keep:
                tape.append((t, s, c, i, f, o, g, tc))
            s, c = s2, c2
            out[t] = s
        return out, tape

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        flat = x.reshape(-1, x.shape[2])
        hs, tapes = [], {}
        for d in "fb":
            a = (flat @ self.p["W" + d]).reshape(*x.shape[:2], -1) + self.p["b" + d]
            out, tapes[d] = self._run(a, mask, d, keep)
            hs.append(out)
        h = np.concatenate([*hs, x], 2)
        return 1 / (1 + np.exp(-np.clip(h @ self.p["v"] + self.p["c"], -30, 30))), h, tapes

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, h, tapes = self.forward(x, mask, True)
        dz = (p - y) * mask / mask.sum()
        g = {"v": np.einsum("tb,tbk->k", dz, h), "c": np.array([dz.sum()])}
        n, flat = self.h, x.reshape(-1, x.shape[2])
        for k, d in enumerate("fb"):
            dh_all = dz[:, :, None] * self.p["v"][k * n : (k + 1) * n]
            da = np.zeros((*x.shape[:2], 4 * n))
            ds, dc, gu = np.zeros(dh_all.shape[1:]), np.zeros(dh_all.shape[1:]), np.zeros_like(self.p["U" + d])
            for t, s, c, i, f, o, gg, tc in reversed(tapes[d]):
                m = mask[t][:, None]
                dh = (dh_all[t] + ds) * m
                dct = (dc + dh * o * (1 - tc**2)) * m
                dz4 = np.concatenate([dct * gg * i * (1 - i), dct * c * f * (1 - f), dh * tc * o * (1 - o), dct * i * (1 - gg**2)], 1)
                da[t] = dz4
                gu += s.T @ dz4
                ds, dc = dz4 @ self.p["U" + d].T, dct * f
            g["U" + d], g["W" + d], g["b" + d] = gu, flat.T @ da.reshape(-1, 4 * n), da.sum((0, 1))
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 14, rate: float = 0.012, batch: int = 32, steps: int = 240, seed: int = 0) -> Labeller:
        """Adam; longer pages are trained on from a random block."""
        rng, m, v, k = np.random.default_rng(seed), {n: 0.0 for n in self.p}, {n: 0.0 for n in self.p}, 0
        for epoch in range(epochs):
            order = sorted(rng.permutation(len(pages)), key=lambda i: min(steps, len(pages[i][1])) // 8)
            groups = [order[i : i + batch] for i in range(0, len(order), batch)]
            rng.shuffle(groups)
            for group in groups:
                x, mask, y = padded([pages[i] for i in group], steps, rng)
                k += 1
                for name, g in self.gradients(x, mask, y).items():
                    m[name], v[name] = 0.9 * m[name] + 0.1 * g, 0.99 * v[name] + 0.01 * g * g
                    self.p[name] -= rate * 0.85**epoch * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-6)
        return self

    def label(self, pages: list[np.ndarray], most: int = 40_000) -> list[np.ndarray]:
        """The probability of each block of each page; pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order, at = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i])), 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < 256 and len(pages[order[end]]) * (end - at + 1) <= max(most, len(pages[order[end]])):
                end += 1
            group = order[at:end]
            x, mask, _ = padded([(pages[i], np.zeros(len(pages[i]))) for i in group], len(pages[group[-1]]))
            p = self.forward(x, mask)[0]
            for j, i in enumerate(group):
                out[i] = p[: len(pages[i]), j]
            at = end
        return out


def padded(pages: list[tuple[np.ndarray, np.ndarray]], steps: int, rng: np.random.Generator | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    longest = min(steps, max(len(y) for _, y in pages))
    x, mask, y = np.zeros((longest, len(pages), pages[0][0].shape[1])), np.zeros((longest, len(pages))), np.zeros((longest, len(pages)))
    for j, (px, py) in enumerate(pages):
        n = min(longest, len(py))
        a = int(rng.integers(0, len(py) - n + 1)) if rng is not None else 0
        x[:n, j], mask[:n, j], y[:n, j] = px[a : a + n], 1, py[a : a + n]
    return x, mask, y


# Names that pages of the made-up layouts use.
MAIN_NAMES = ["article", "main", "section.article-body", "div.post", "div.entry-content", "div#content", "div.story", "div.article", "div.text", "div#main", "div.post-content", "section.content", "div.body", "article.post"]
OTHER_NAMES = ["nav", "header", "footer", "aside", "form", "div.ad", "div.ads", "div.advert", "div.banner", "div.sponsored", "div.promo", "div.cookie", "div.cookie-notice", "div.consent", "div.notice", "div.alert", "div.newsletter", "div.subscribe", "div.sidebar", "div#sidebar", "div.menu", "ul.menu", "div.nav", "div.breadcrumbs", "div.related", "div.share", "div.social", "div.comments", "section.comments", "div#comments", "div.comment", "section#responses", "div.login", "div.search", "div.header", "div#header", "div.top", "div#footer", "div.footer", "div.copyright", "div.legal", "div.popup", "div.modal", "div.widget", "ol.comment-list", "aside.sidebar", "aside.related", "form.search", "form.signup"]
OPENERS = ["Home", "About", "Contact", "News", "Login", "Search", "Share", "Subscribe", "Read more", "Privacy", "Terms", "Next", "Previous", "Menu"]


def _wrap(name: str, inner: str) -> str:
    tag, kind, mark = re.match(r"(\w+)(?:([.#])(.*))?", name).groups()
    return f"<{tag}{f' {"class" if kind == "." else "id"}={chr(34)}{mark}{chr(34)}' if kind else ''}>{inner}</{tag}>"


def made_page(rng: np.random.Generator, vocabulary: list[str]) -> list[tuple[list[tuple[str, tuple[str, ...], int]], np.ndarray]]:
    """One page in a random layout, as blocks with their labels."""
    say = lambda a, b: " ".join(vocabulary[i] for i in rng.integers(0, len(vocabulary), rng.integers(a, b)))

    def sentence(a: int, b: int) -> str:
        return say(a, b).capitalize() + "."

    def other(name: str) -> str:
        kind = rng.integers(0, 4)
        if "comment" in name or "responses" in name:
            inner = "".join(_wrap(["div", "div.comment", "p", "li"][rng.integers(0, 4)], ("<b>" + say(1, 3) + "</b><p>" if rng.random() < 0.5 else "") + " ".join(sentence(3, 14) for _ in range(rng.integers(1, 4)))) for _ in range(rng.integers(1, 6)))
            return _wrap(name, (_wrap("h3", "Comments") if rng.random() < 0.5 else "") + inner)
        if name.startswith("footer") or "footer" in name or "copyright" in name or kind == 0:
            return _wrap(name, ("&copy; " if rng.random() < 0.6 else "") + say(1, 4) + (" &middot; " if rng.random() < 0.5 else " ") + sentence(2, 12))
        if kind == 1:
            return _wrap(name, "<ul>" + "".join(f"<li><a href='/x'>{OPENERS[rng.integers(0, len(OPENERS))] if rng.random() < 0.4 else say(1, 4)}</a></li>" for _ in range(rng.integers(2, 9))) + "</ul>")
        if kind == 2:
            return _wrap(name, sentence(2, 16))
        return _wrap(name, "".join(_wrap("p", sentence(3, 20)) for _ in range(rng.integers(1, 4))))

    def article() -> str:
        body = "".join(_wrap("p", ("<b>" if rng.random() < 0.15 else "") + " ".join(sentence(1, 16) for _ in range(rng.integers(1, 7)))) if rng.random() < 0.85 else _wrap(["h2", "blockquote", "pre", "h3"][rng.integers(0, 4)], say(1, 8)) if rng.random() < 0.6 else "<ul>" + "".join(_wrap("li", sentence(2, 12)) for _ in range(rng.integers(2, 6))) + "</ul>" for _ in range(rng.integers(1, 14)))
        return _wrap("h1", say(2, 12)) + body

    pieces = [(other(OTHER_NAMES[rng.integers(0, len(OTHER_NAMES))]), 0) for _ in range(rng.integers(1, 4))]
    pieces.append((article(), 1))
    pieces += [(other(OTHER_NAMES[rng.integers(0, len(OTHER_NAMES))]), 0) for _ in range(rng.integers(1, 4))]
    main = MAIN_NAMES[rng.integers(0, len(MAIN_NAMES))]
    outer = ["", "div.wrapper", "div#page", "div.container"][rng.integers(0, 4)]
    found: list[tuple[str, tuple[str, ...], int]] = []
    labels: list[int] = []
    for text, y in pieces:
        page = _wrap(main, text) if y else text
        got = blocks("<html><body>" + (_wrap(outer, page) if outer else page))
        found += got
        labels += [y] * len(got)
    return found, np.array(labels)


def own_labels(page: list[tuple[str, tuple[str, ...], int]]) -> np.ndarray | None:
    """Labels that a page's semantic tags give its blocks; None if it has no article."""
    y = np.array([("article" in p or "main" in p) and not BOILERPLATE.intersection(p[max((i for i, w in enumerate(p) if w in ("article", "main")), default=0) :]) for _, p, _ in page], float)
    return y if y.any() and not y.all() else None


def train(samples: list[str], seed: int = 0) -> Labeller:
    rng, pages, words = np.random.default_rng(seed), [], []
    for text in samples:
        found = blocks(text)
        words += [w for t, _, _ in found for w in t.split()[:60]]
        y = own_labels(found)
        if y is not None:
            pages += [(vectors(found), y), (vectors(found, rng), y)]
    words = words or "one two three four five six seven eight nine ten more words of a text".split()
    for _ in range(MADE_PAGES):
        found, y = made_page(rng, words)
        pages += [(vectors(found), y)] if rng.random() < 0.5 else [(vectors(found, rng), y)]
    return Labeller().fit(pages)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text string, n_chars long (code points), a row per page: its main blocks, joined by empty lines.

    Null and empty pages, and pages without a main block, have the empty text. Blocks count as main from a probability of
    0.5; none is cut or capped. Repeated ids keep each of their rows.
    """
    seen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    # by hash: about four times as many pages as are wanted leave their tasks, however many tasks there are
    share = min(1.0, 4 * sample_pages / max(1, seen.count()))
    near = seen.where(f"html is not null and length(html) < {LONG_PAGE}").select("html", F.xxhash64("html").alias("k")).where(F.pmod("k", F.lit(1 << 30)) <= int(share * (1 << 30)))
    sample = near.orderBy("k", "html").limit(sample_pages).collect()
    small_batches(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(train([r.html for r in sample]))

    @F.pandas_udf("string")
    def main_text(text):
        import pandas as pd

        out = []
        for at in range(0, len(text), 256):
            found = [blocks(t) for t in text.iloc[at : at + 256]]
            kept = held.value.label([vectors(f) for f in found])
            out += ["\n\n".join(b[0] for b, p in zip(f, k, strict=True) if p >= 0.5) for f, k in zip(found, kept, strict=True)]
        return pd.Series(out, dtype=object)

    done = seen.withColumn("text", F.coalesce(main_text("html"), F.lit("")))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
