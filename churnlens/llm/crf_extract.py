"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks (text between block-level boundaries).  Each block has
features of its ancestors (tags, class and id words) and of its text; the
chain's two labels are main text and boilerplate.  The model is trained on
labelled pages and decodes a page by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from churnlens.llm.text import slices

# Fixed lists of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template title textarea iframe noembed noframes xmp".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s
samp small span strike strong sub sup time tt u var wbr""".split())
CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3
h4 h5 h6 header hr main nav ol p pre section table ul""".split())
SAME_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select".split())

_OPEN = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
# A tag as the HTML tokenizer reads it: a quote opens a value only right after "=".  Every part is possessive.
_TAG = re.compile(r"""</?[a-zA-Z][^\s/>]*+
    (?:[\s/]++ | [^\s/>][^\s/>=]*+ (?:\s*+=\s*+(?:"[^"]*+" | '[^']*+' | [^\s>"'][^\s>]*+))?+ )*+>""", re.VERBOSE)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

Path = tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(slots=True)
class Block:
    """A leaf block: its ancestors (tag and class words, outermost first), text, and characters inside links."""

    path: Path
    text: str
    linked: int


@lru_cache(maxsize=4096)
def _element(tag: str) -> tuple[str, tuple[str, ...]]:
    """Name and class, id and role words of a start tag."""
    name = _NAME.match(tag)[1].lower()
    marks = [w.lower() for m in _MARKED.finditer(tag) for w in _PART.findall(m[1] or m[2] or m[3] or "")]
    return name, tuple(dict.fromkeys(marks))


@lru_cache(maxsize=None)
def _raw_end(name: str) -> re.Pattern:
    """The end tag of a script or the like."""
    return re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE)


def _tags(page: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the page's tags, comments and declarations; the caller may send the position to go on from.

    A comment or declaration that never ends reaches to the page's end.  A tag whose quotes never close ends at
    the next ``>``, and so do all tags behind it, so no stretch is scanned again and again.  Behind the
    last ``>`` all is text.
    """
    position, last, quoted = 0, page.rfind(">"), True
    while m := _OPEN.search(page, position):
        start = m.start()
        if page.startswith("<!--", start):
            close = page.find("-->", start + 2)
            end = close + 3 if close >= 0 else len(page)
        elif page[start + 1] in "!?":
            end = page.find(">", start) + 1 or len(page)
        elif start > last:
            return
        else:
            tag = _TAG.match(page, start) if quoted else None
            quoted = tag is not None
            end = tag.end() if tag else page.find(">", start) + 1
        position = (yield start, end) or end


def leaf_blocks(page: str) -> list[Block]:
    """Cut a page into its leaf blocks, in page order.  Character references are decoded, white space
    becomes one space; comments, scripts, styles and titles give no block.  Stray quotes in tags, unclosed tags and
    ``<`` before anything but a tag lose no text; the time is linear in the page's length."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked = links = 0
    own: Path = ()

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(own, text, linked))
            pieces.clear()
        linked = 0

    def add(text: str):
        nonlocal own, linked
        if not pieces:
            if text.isspace():
                return
            own = tuple(stack)
        pieces.append(text)
        if links:
            linked += len(text)

    def close(at: int):
        nonlocal links
        if any(e[0] not in INLINE for e in stack[at:]):
            flush()
        links -= sum(e[0] == "a" for e in stack[at:])
        del stack[at:]

    position, tags, resume = 0, _tags(page), None
    while True:
        try:
            start, end = tags.send(resume)
        except StopIteration:
            break
        tag, resume = page[start:end], None
        name = tag[1]
        if start > position:
            add(page[position:start])
        position = end
        if name in "!?":
            continue
        if name == "/":
            name = _NAME.match(tag)[1].lower()
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    close(at)
                    break
            continue
        element = _element(tag) if len(tag) < 300 else _element.__wrapped__(tag)
        name = element[0]
        if name in RAW:
            if name not in INLINE:
                flush()
            if not tag.endswith("/>"):  # no tags or comments inside: only its own end tag counts
                closing = _raw_end(name).search(page, position)
                position = resume = closing.end() if closing else len(page)
            continue
        if name in VOID:
            if name == "br":
                add(" ")
            elif name not in INLINE:
                flush()
            continue
        if name in CLOSES_P:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == "p":
                    close(at)
                    break
                if stack[at][0] not in INLINE:
                    break
        ends = SAME_END.get(name)
        if ends:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in ends:
                    close(at)
                    if name != "tr":
                        break
                elif stack[at][0] in SCOPE:
                    break
        if name not in INLINE:
            flush()
        stack.append(element)
        links += name == "a"
    if position < len(page):
        add(page[position:])
    flush()
    return blocks


def path_features(path: Path) -> list[str]:
    """Ancestor tags (nearest ones by distance too) and class words."""
    structural = [e for e in path if e[0] not in INLINE and e[0] not in ("html", "body")]
    out = {f"in:{e[0]}" for e in structural}
    out |= {f"near{k}:{e[0]}" for k, e in enumerate(structural[:-3:-1])}
    out |= {f"mark:{w}" for e in path for w in e[1]}
    return sorted(out)


def _bin(x: float, edges: tuple) -> int:
    return sum(x >= e for e in edges)


def text_features(text: str, linked: int) -> tuple[str, ...]:
    """Length, link density, punctuation and signs of a block's text."""
    n = text.count(" ") + 1
    return (f"words:{_bin(n, (2, 4, 8, 16, 32, 64))}",
            f"links:{_bin(linked / max(len(text), 1), (0.01, 0.3, 0.7, 0.95))}",
            f"end:{text[-1] if text[-1] in '.!?:;,|' else 'other'}",
            f"commas:{_bin(text.count(',') / n, (0.001, 0.05, 0.15))}",
            f"signs:{'©' in text or '·' in text}{'|' in text}{'@' in text}",
            f"upper:{text[:1].isupper()}{text.isupper()}", "bias")


@dataclass
class Crf:
    """Two-label chain: per feature its score for (boilerplate, main), transition and start scores."""

    weights: dict[str, tuple[float, float]]
    steps: list[list[float]]
    start: list[float]

    def __post_init__(self):
        self.by_path, self.by_text = {}, {}

    def _sum(self, features) -> tuple[float, float]:
        found = [w for f in features if (w := self.weights.get(f))]
        return sum(w[0] for w in found), sum(w[1] for w in found)

    def emission(self, block: Block) -> tuple[float, float]:
        near = self.by_path.get(block.path)
        if near is None:
            if len(self.by_path) > 20_000:
                self.by_path.clear()
            near = self.by_path[block.path] = self._sum(path_features(block.path))
        key = text_features(block.text, block.linked)
        own = self.by_text.get(key)
        if own is None:
            own = self.by_text[key] = self._sum(key)
        return near[0] + own[0], near[1] + own[1]

    def decode(self, blocks: list[Block]) -> list[int]:
        """Viterbi labels; ties go to boilerplate."""
        if not blocks:
            return []
        (s00, s01), (s10, s11) = self.steps
        e0, e1 = self.emission(blocks[0])
        a, b = self.start[0] + e0, self.start[1] + e1
        back = []
        for block in blocks[1:]:
            e0, e1 = self.emission(block)
            from0, from1 = b + s10 > a + s00, b + s11 > a + s01
            a, b = (b + s10 if from0 else a + s00) + e0, (b + s11 if from1 else a + s01) + e1
            back.append((from0, from1))
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]

    def main_text(self, page: str) -> str:
        blocks = leaf_blocks(page)
        return "\n".join(b.text for b, y in zip(blocks, self.decode(blocks)) if y)


def train(pages: list[list[tuple[Block, int]]], steps: int = 150, l2: float = 0.002) -> Crf:
    """Maximum penalised likelihood by full-batch Adam on exact forward-backward marginals."""
    pages = [p for p in pages if p]
    names: dict[str, int] = {}
    length = max(len(p) for p in pages)
    y = np.full((len(pages), length), -1)
    where, feature = [], []
    for i, page in enumerate(pages):
        for t, (block, label) in enumerate(page):
            y[i, t] = label
            for f in (*path_features(block.path), *text_features(block.text, block.linked)):
                where.append(i * length + t)
                feature.append(names.setdefault(f, len(names)))
    where, feature = np.array(where), np.array(feature)
    real, k = y >= 0, len(names)
    gold = np.zeros((*y.shape, 2))
    gold[real, y[real]] = 1
    pair_gold = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    p = np.zeros(2 * k + 6)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, trans, start = p[:2 * k].reshape(k, 2), p[2 * k:2 * k + 4].reshape(2, 2), p[2 * k + 4:]
        emit = np.stack([np.bincount(where, w[feature, c], minlength=y.size) for c in (0, 1)], 1).reshape(*y.shape, 2)
        emit *= real[..., None]
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[:, 0] = start + emit[:, 0]
        for t in range(1, length):
            step_in = np.logaddexp.reduce(alpha[:, t - 1, :, None] + trans, axis=1) + emit[:, t]
            alpha[:, t] = np.where(real[:, t, None], step_in, alpha[:, t - 1])
        log_z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        for t in range(length - 2, -1, -1):
            out = np.logaddexp.reduce(trans + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], out, 0)
        marginal = np.exp(alpha + beta - log_z[:, None, None]) * real[..., None]
        pairs = (np.exp(alpha[:, :-1, :, None] + trans + (emit + beta)[:, 1:, None, :] - log_z[:, None, None, None])
                 * real[:, 1:, None, None]).sum(axis=(0, 1))
        rest = (gold - marginal).reshape(-1, 2)
        grad = np.concatenate((
            np.stack([np.bincount(feature, rest[where, c], minlength=k) for c in (0, 1)], 1).ravel(),
            (pair_gold - pairs).ravel(), (gold[:, 0] - marginal[:, 0]).sum(axis=0))) / len(pages) - l2 * p
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w = p[:2 * k].reshape(k, 2)
    return Crf({f: (float(w[i, 0]), float(w[i, 1])) for f, i in names.items()},
               p[2 * k:2 * k + 4].reshape(2, 2).tolist(), p[2 * k + 4:].tolist())


# --- labelled training pages ---------------------------------------------------------------------

_SYLLABLES = "an be co de en er es fi ga ha in ja ka le mo no or pa qu re sa ti un ve wa xi yo zu é ñ ü ß".split()
_BEFORE = ("nav", "header", "banner", "menu", "breadcrumb", "cookie", "ad", "form", "aside")
_AFTER = ("footer", "sidebar", "comments", "related", "ad", "form", "aside", "newsletter", "share", "cookie", "nav")
_INSIDE = ("ad", "share", "aside", "related", "newsletter", "comments", "form")


def _sentence(rnd: random.Random, low: int, high: int) -> str:
    words = ["".join(rnd.choice(_SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(low, high))]
    words = [w + "," if rnd.random() < 0.08 else w for w in words]
    text = " ".join(words).rstrip(",")
    return text[:1].upper() + text[1:] + rnd.choice("....!?")


def _boilerplate(rnd: random.Random, kind: str) -> str:
    """Markup of one region that is not the article."""
    links = "".join(f'<li><a href="#">{_sentence(rnd, 1, 3).rstrip(".!?")}</a></li>' for _ in range(rnd.randint(2, 7)))
    line = _sentence(rnd, 3, rnd.choice((8, 30)))
    attr = lambda *names: f'{rnd.choice(("class", "id"))}="{rnd.choice(names)}"'
    comment = "".join(f'<div class="comment"><span class="author">{_sentence(rnd, 1, 2)}</span>'
                      f"<p>{_sentence(rnd, 4, 40)}</p></div>" for _ in range(rnd.randint(1, 4)))
    return {
        "nav": lambda: f"<nav><ul>{links}</ul></nav>",
        "header": lambda: f"<header><h1>{line}</h1><p>{_sentence(rnd, 2, 9)}</p></header>",
        "banner": lambda: f'<div {attr("banner", "site-header", "masthead", "top-bar", "header")}>{line}</div>',
        "menu": lambda: f'<div {attr("menu", "main-menu", "navigation", "navbar")}><ul>{links}</ul></div>',
        "breadcrumb": lambda: f'<div {attr("breadcrumb", "breadcrumbs")}><a href="#">{line}</a></div>',
        "cookie": lambda: f'<div {attr("cookie-notice", "cookie-banner", "consent", "notice", "gdpr", "popup", "alert")}>'
                          f"<p>{line}</p><button>OK</button></div>",
        "ad": lambda: f'<div {attr("ad", "ads", "advert", "advertisement", "sponsored", "promo")}>'
                      + rnd.choice((f"<p>{line}</p>", line)) + "</div>",
        "form": lambda: f"<form><label>{_sentence(rnd, 1, 4)}</label><input><button>{_sentence(rnd, 1, 2)}</button>"
                        f"<select><option>{_sentence(rnd, 1, 2)}</option></select><p>{line}</p></form>",
        "aside": lambda: f"<aside><h3>{_sentence(rnd, 1, 4)}</h3><p>{line}</p></aside>",
        "footer": lambda: rnd.choice((f"<footer>&copy; {line}</footer>", f"<footer><p>{line}</p><ul>{links}</ul></footer>",
                                      f'<div {attr("footer", "site-footer", "copyright")}>&copy; {line}</div>')),
        "sidebar": lambda: f'<div {attr("sidebar", "side-bar", "widget", "rail")}><h3>{_sentence(rnd, 1, 4)}</h3>'
                           f"<p>{line}</p><ul>{links}</ul></div>",
        "comments": lambda: rnd.choice((
            f'<div {attr("comments", "comment-list", "responses", "discussion")}><h2>{_sentence(rnd, 1, 3)}</h2>{comment}</div>',
            f'<section {attr("comments", "reader-comments", "replies")}>{comment}</section>')),
        "related": lambda: f'<div {attr("related", "related-posts", "recommended", "more")}><ul>{links}</ul></div>',
        "newsletter": lambda: f'<div {attr("newsletter", "subscribe", "signup")}><p>{line}</p></div>',
        "share": lambda: f'<div {attr("share", "social", "sharing", "byline", "meta", "tags")}>{_sentence(rnd, 1, 5)}</div>',
    }[kind]()


def labelled_page(rnd: random.Random) -> tuple[str, list[int]]:
    """A page in one of many layouts, and the label of each of its leaf blocks."""
    parts: list[tuple[str, int]] = [(_boilerplate(rnd, rnd.choice(_BEFORE)), 0) for _ in range(rnd.randint(0, 3))]
    opening, closing = rnd.choice((
        ("<article>", "</article>"), ("<article>", "</article>"), ("<main><article>", "</article></main>"),
        ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="post-body">', "</div>"),
        ('<section class="entry-content">', "</section>"), ('<div class="article-text">', "</div>"),
        ('<div id="story">', "</div>"), ("<div>", "</div>")))
    parts.append((opening, 1))
    if rnd.random() < 0.8:
        parts.append((f"<{(h := rnd.choice(('h1', 'h1', 'h2')))}>{_sentence(rnd, 2, 10)}</{h}>", 1))
    for _ in range(rnd.randint(1, 9)):
        roll, text = rnd.random(), _sentence(rnd, 1, rnd.choice((4, 25, 80)))
        if rnd.random() < 0.15:
            text = " | ".join(text.split())
        if roll < 0.62:
            parts.append((rnd.choice((f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>",
                                      f'<p>{text} <a href="#">{_sentence(rnd, 1, 3)}</a> {text}</p>', f"<div>{text}</div>")), 1))
        elif roll < 0.72:
            parts.append((f"<{(h := rnd.choice(('h2', 'h3')))}>{_sentence(rnd, 1, 6)}</{h}>", 1))
        elif roll < 0.8:
            parts.append((f"<ul><li>{text}</li><li>{_sentence(rnd, 2, 12)}</li></ul>", 1))
        elif roll < 0.85:
            parts.append((f"<blockquote>{text}</blockquote>", 1))
        elif roll < 0.89:
            parts.append((f"<table><tr><td>{text}</td><td>{_sentence(rnd, 1, 3)}</td></tr></table>", 1))
        elif roll < 0.92:
            parts.append((f"<figure><figcaption>{text}</figcaption></figure>", 1))
        else:
            parts.append(("</b></p>" + _boilerplate(rnd, rnd.choice(_INSIDE)), 0))
    parts.append(("</b></p>" + closing, 1))
    parts += [(_boilerplate(rnd, rnd.choice(_AFTER)), 0) for _ in range(rnd.randint(0, 4))]
    page = "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join(p for p, _ in parts) + "</body></html>"
    labels = [label for part, label in parts for _ in leaf_blocks(part)]
    return page, labels


TRAINING_PAGES = 600


@lru_cache(maxsize=1)
def default_model(pages: int = TRAINING_PAGES) -> Crf:
    """The model trained on ``pages`` labelled pages of a fixed random series."""
    rnd = random.Random(8)
    made = (labelled_page(rnd) for _ in range(pages))
    return train([list(zip(blocks, labels)) for page, labels in made
                  if len(blocks := leaf_blocks(page)) == len(labels)])


def extract(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """page_id, url, text (main blocks joined by line feeds; empty if none), n_chars.

    ``pages`` needs page_id, url and html; other columns are ignored.  One row per input row; NULL
    and empty html give an empty text; NULL ids and urls and repeated rows are passed on.
    """
    crf = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = crf.value
        for part in slices(batches, text="html", max_rows=1024):
            text = pa.array([own.main_text(h) if h else "" for h in part.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), text, pc.utf8_length(text).cast(pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
