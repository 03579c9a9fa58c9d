"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaves: blocks of text with the tags above them. A bidirectional LSTM reads a vector of hashed
tags and words for each leaf and labels every one as main text or not, so a leaf is judged by its surroundings too.
It is trained on a bounded sample of pages. Their labels come from plain markup: leaves inside an article or main
element, but not inside one of the SIDE containers. So that it learns all containers, and does without an article
element, training pages get further leaves of SIDE containers at any place, and some lose the article tag.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterfold.llm import lstm, wordhash
from quarterfold.llm.common import table, text_of

TRAINING_PAGES = 600  # about; by hash of the page's id and address
TAGS, WORDS = 64, 16  # sizes of the hashed vectors
STEPS = 1 << 13  # leaves, with padding, that are labelled at a time, or one page
DEEPEST, LONGEST = 200, 5000  # elements above a leaf, and leaves, of a page that is trained on
# Names of elements and classes.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea title xmp".split())  # what they hold is no markup
EMBEDDED = frozenset("template svg math object select canvas audio video".split())  # what they hold, once closed, is no text
SELF_CLOSING = {"p": BLOCKS, "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
MAIN = ("article", "main")
SIDE = (
    ("nav",), ("header",), ("footer",), ("aside",), ("form",), ("dialog",), ("menu",), ("div", ".ad"), ("div", ".ads"), ("div", ".advert"),
    ("div", ".advertisement"), ("div", ".sponsored"), ("div", ".banner"), ("div", ".promo"), ("div", ".sidebar"), ("div", ".menu"),
    ("div", ".nav"), ("div", ".navbar"), ("div", ".breadcrumb"), ("div", ".header"), ("div", ".footer"), ("div", ".notice"),
    ("div", ".cookie"), ("div", ".consent"), ("div", ".newsletter"), ("div", ".subscribe"), ("div", ".popup"), ("div", ".share"),
    ("div", ".social"), ("div", ".related"), ("div", ".comments"), ("div", ".comment"), ("section", ".comments"), ("section", ".comment"),
    ("ol", ".comments"), ("ul", ".comments"), ("section", ".related"), ("div", "#comments"), ("section", "#comments"), ("div", "#sidebar"),
    ("div", "#footer"), ("div", "#header"), ("div", "#nav"), ("div", "#menu"), ("p", ".notice"), ("p", ".ad"),
)
OPEN_PAGES = (("div", ".content"), ("div", ".post"), ("div", ".entry"), ("section",), ("div", "#content"), ("div",), ("main",))
_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)")
# the usual tag: looks no farther than the next "<" or ">"
_USUAL = re.compile(r"<(/?)([A-Za-z][^\s/<>]*)((?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*+)>")
_STOP = re.compile(r"[>\"']")
# a tag that the page breaks off in, rather than a lone "<" in its text
_BROKEN = re.compile(r"</?[A-Za-z][^\s<>]*(?:\s+[^\s=<>\"']+\s*=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s<>\"']*))*\s*\Z")
_ATTRIBUTE = re.compile(r"\b(class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(f"</{name}", re.I) for name in RAW}
_SIDE_TAGS = frozenset(s[0] for s in SIDE if len(s) == 1)
_SIDE_NAMES = frozenset(s[1] for s in SIDE if len(s) == 2)


def _names(tag: str, attributes: str) -> tuple[tuple[str, ...], int]:
    """The tag, and the words of its class and id; and their bits in a vector."""
    return _known_names(tag, attributes) if len(attributes) < 200 else _known_names.__wrapped__(tag, attributes)


@lru_cache(4096)
def _known_names(tag: str, attributes: str) -> tuple[tuple[str, ...], int]:
    found = [tag]
    for kind, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        sign = "." if kind.lower() == "class" else "#"
        found += [sign + w for v in values for w in _NAME.findall(v.lower())]
    return tuple(found), bits_of(found)


def bits_of(names) -> int:
    bits = 0
    for name in names:
        bits |= 1 << zlib.crc32(name.encode("utf-8", "replace")) % TAGS
    return bits


class Node:
    """An open element: its names, the elements above it by one link, and what a vector needs of all of them."""

    __slots__ = ("above", "names", "bits", "depth")

    def __init__(self, above: Node | None, names: tuple[str, ...], bits: int):
        self.above, self.names = above, names
        self.bits, self.depth = (above.bits | bits, above.depth + 1) if above else (bits, 1)

    def path(self) -> tuple[tuple[str, ...], ...]:
        found, node = [], self
        while node:
            found.append(node.names)
            node = node.above
        return tuple(reversed(found))


def node_of(path) -> Node | None:
    node = None
    for names in path:
        node = Node(node, names, bits_of(names))
    return node


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, content): texts, and opening and closing tags. Reads every character a bounded number of times.

    A ">" in a quoted attribute doesn't end a tag, unless the page would end in that tag; from there on quotes don't count.
    What a raw element holds is left out, to its closing tag or the end of the page.
    """
    found: list[tuple[str, str, str]] = []
    at = done = 0
    last = {c: page.rfind(c) for c in ">\"'"}
    quotes, unclosed = True, set()
    while (at := page.find("<", at)) >= 0 and at < last[">"]:
        closing = name = ""
        if quotes and (m := _USUAL.match(page, at)):
            closing, name, content = m.groups()
            end = m.end()
        elif page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
        elif page[at + 1] in "!?" or (page[at + 1] == "/" and not _TAG.match(page, at)):
            end = page.find(">", at) + 1
        else:
            tag = _TAG.match(page, at)
            if not tag:
                at += 1
                continue
            end, stop = None, tag.end()
            while quotes and end is None and (m := _STOP.search(page, stop)):
                if m[0] == ">":
                    end = m.end()
                else:  # a quote that nothing closes is a character like others
                    stop = page.find(m[0], m.end()) + 1 if m.end() <= last[m[0]] else m.end()
            if end is None:
                quotes, end = False, page.find(">", at) + 1
            closing, name, content = page[at + 1] == "/", tag[1], page[tag.end() : end - 1]
        if at > done:
            found.append(("text", "", page[done:at]))
        if name:
            name = name.lower()
            found.append(("close" if closing else "open", name, content))
            if name in RAW and not closing and not content.rstrip().endswith("/"):
                close = _RAW_END[name].search(page, end) if name not in unclosed else None
                end = close.start() if close else len(page)
                if not close:
                    unclosed.add(name)
        at = done = end
    rest = page[done:]
    cut = rest.rfind("<")
    if cut >= 0 and _BROKEN.match(rest, cut):
        rest = rest[:cut]
    if rest:
        found.append(("text", "", rest))
    return found


def _embedded(found: list[tuple[str, str, str]]) -> dict[int, int]:
    """Where each embedded element that is closed begins, and the place after its end. One that isn't closed holds nothing."""
    opened: dict[str, list[int]] = {}
    ends = {}
    for i, (kind, name, _) in enumerate(found):
        if name in EMBEDDED:
            if kind == "open":
                opened.setdefault(name, []).append(i)
            elif opened.get(name):
                ends[opened[name].pop()] = i + 1
    return ends


def leaves(page: str) -> list[tuple[Node | None, str, int]]:
    """(innermost element, text, characters inside links) of each block with text, in page order."""
    found: list = []
    stack: list[Node] = []
    count: Counter = Counter()  # open elements by tag
    parts: list[str] = []
    linked, at, blank = 0, None, True

    def end() -> None:
        nonlocal linked, blank
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append((at, text, min(linked, len(text))))
            parts.clear()
        linked, blank = 0, True

    def add(raw: str) -> None:
        nonlocal linked, at, blank
        text = html.unescape(raw)
        if blank:  # a block stands where its first word does
            at = stack[-1] if stack else None
            blank = not text.strip()
        parts.append(text)
        if count["a"]:
            linked += len(text.strip())

    def popped() -> str:
        tag = stack.pop().names[0]
        count[tag] -= 1
        return tag

    all_tokens = tokens(page)
    skips, skip_to = _embedded(all_tokens), 0
    for i, (kind, tag, content) in enumerate(all_tokens):
        if i < skip_to:
            continue
        if kind == "text":
            add(content)
        elif tag in EMBEDDED:
            skip_to = skips.get(i, 0) if kind == "open" else 0
        elif kind == "close":
            if count[tag]:
                while True:
                    name = popped()
                    if name in BLOCKS:
                        end()
                    if name == tag:
                        break
        elif tag in RAW:
            continue
        elif tag == "br":
            add(" ")
        elif tag not in VOID:
            if tag in BLOCKS:
                end()
                for k in range(len(stack) - 1, -1, -1):
                    if tag in SELF_CLOSING.get(stack[k].names[0], ()):
                        while len(stack) > k:
                            popped()
                        break
                    if stack[k].names[0] in BLOCKS:
                        break
            stack.append(Node(stack[-1] if stack else None, *_names(tag, content)))
            count[tag] += 1
        elif tag in BLOCKS:
            end()
    end()
    return found


def is_main(path, marked: bool = True) -> bool:
    """The plain rule that training pages are labelled by; without ``marked``, no article or main element is asked for."""
    inside = not marked
    for names in path:
        inside = inside or names[0] in MAIN
        if names[0] in _SIDE_TAGS or not _SIDE_NAMES.isdisjoint(names[1:]):
            return False
    return inside


def vectors(found) -> np.ndarray:
    """A row for each leaf: tags and names above it, its words, length, share of links, place and depth."""
    out, n = np.zeros((len(found), TAGS + WORDS + 4)), max(len(found) - 1, 1)
    for i, (node, text, linked) in enumerate(found):
        bits = node.bits if node else 0
        out[i, :TAGS] = np.unpackbits(np.frombuffer(bits.to_bytes(TAGS // 8, "little"), dtype=np.uint8), bitorder="little")
        words = text.lower().split()
        for w in words:
            out[i, TAGS + zlib.crc32(w.encode("utf-8", "replace")) % WORDS] += 1
        out[i, TAGS : TAGS + WORDS] /= max(len(words), 1)
        out[i, -4:] = np.log1p(len(text)) / 8, linked / max(len(text), 1), i / n, (node.depth if node else 0) / 8
    return out


def training_page(found, seed: int, marked: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of a page with further leaves of SIDE containers; every third page loses its article element."""
    r = np.random.default_rng(seed)
    rows = [(p, t, a, is_main(p, marked)) for p, t, a in ((n.path() if n else (), t, a) for n, t, a in found)]
    stems = [p for p, _, _, good in rows if good] or [(("html",), ("body",))]
    texts = [t for _, t, _, _ in rows] or ["x"]
    for _ in range(int(r.integers(0, 6))):
        side = SIDE[int(r.integers(len(SIDE)))]
        base = stems[int(r.integers(len(stems)))]
        base = base[: int(r.integers(2, len(base) + 1))] if len(base) > 2 else base
        text = texts[int(r.integers(len(texts)))]
        extra = [(*base, side, *([("p",)] if r.random() < 0.5 else [])), text, int(r.random() < 0.2) * len(text), False]
        at = int(r.integers(0, len(rows) + 1))
        rows[at:at] = [tuple(extra)] * int(r.integers(1, 4))
    if seed % 3 == 0:
        other = OPEN_PAGES[int(r.integers(len(OPEN_PAGES)))]
        rows = [(tuple(other if n[0] in MAIN else n for n in p), t, a, good) for p, t, a, good in rows]
    return vectors([(node_of(p), t, a) for p, t, a, _ in rows]), np.array([float(x[3]) for x in rows])


def _marked(found) -> bool:
    """Whether a page says where its main text is."""
    return any(is_main(n.path()) for n, _, _ in found if n)


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        xs, ys, seeds, marks = [], [], [], []
        for text, seed in zip(batch.column("html"), batch.column("seed"), strict=True):
            found = leaves(text.as_py())
            if not found or len(found) > LONGEST or max(n.depth if n else 0 for n, _, _ in found) > DEEPEST:
                continue
            marks.append(_marked(found))
            x, y = training_page(found, seed.as_py(), marks[-1])
            xs.append(x.ravel())
            ys.append(y)
            seeds.append(seed.as_py())
        yield pa.RecordBatch.from_arrays(
            [pa.array(seeds, pa.int64()), pa.array(marks, pa.bool_()), pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.list_(pa.float64()))],
            names=["seed", "marked", "x", "y"])


def train(pages: DataFrame) -> lstm.Labeller | None:
    """Trained on about TRAINING_PAGES pages, of which only vectors come to the driver; None if there are none.

    Pages without an article or main element don't say where their main text is. They are left out; if there are no others,
    all that isn't in a SIDE container counts as main text. Very deep or long pages are not trained on.
    """
    seed = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40))
    rows = pages.select(seed.alias("seed"), text_of("html").alias("html"))
    share = min(1.0, TRAINING_PAGES / max(pages.count(), 1))
    got = rows.where(F.col("seed") < int(share * (1 << 40))).mapInArrow(
        _prepared, "seed long, marked boolean, x array<double>, y array<double>").toPandas().sort_values("seed", kind="stable")
    if got["marked"].any():
        got = got[got["marked"]]
    if not len(got):
        return None
    return lstm.fit([np.asarray(x).reshape(-1, TAGS + WORDS + 4) for x in got["x"]], [np.asarray(y) for y in got["y"]])


def labelled(model: lstm.Labeller | None, pages: list[list]) -> list[np.ndarray]:
    """For each page which of its leaves are main text. Pages of like length go through the model together, as many as
    make STEPS leaves with the padding."""
    out = [np.zeros(len(p), dtype=bool) for p in pages]
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i])) if model else []
    group: list[int] = []
    for k, i in enumerate(order):
        group.append(i)
        if k + 1 == len(order) or (len(group) + 1) * len(pages[order[k + 1]]) > STEPS:
            x, mask = lstm.padded([vectors(pages[j]) for j in group], TAGS + WORDS + 4)
            z = model.logits(x, mask)
            for row, j in enumerate(group):
                out[j] = z[row, : len(pages[j])] > 0
            group = []
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks for every row of ``pages``.

    The text of the leaves that the model takes for main text, with character references decoded and white space inside a
    block turned into one space, joined by an empty line. Time and memory grow with a page's length, whatever its markup; pages
    of very many leaves go through the model alone. What an element such as video or select holds is left out if it is closed;
    a tag that the page breaks off in is left out. A null or empty page, or one without main text, has an empty text.
    Repeated rows are rows like others; no rows: no rows. Other columns are not looked at.
    """
    model = train(pages)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, rows in wordhash.pieces(batch, "html"):
                part = batch.slice(begin, rows)
                found = [leaves(t.as_py()) for t in part.column("html")]
                kept = [[t for (_, t, _), good in zip(p, g, strict=True) if good] for p, g in zip(found, labelled(model, found), strict=True)]
                texts = ["\n\n".join(k) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([len(k) for k in kept], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long, n_blocks long")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
