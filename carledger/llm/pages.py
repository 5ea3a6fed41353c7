"""Operator 6, main text of web pages by a linear-chain conditional random field.

A page is read into leaf blocks, the stretches of text between block-level tags. Each block has features: tags, roles and
words of class names of its ancestors, its own tag, and its text's length, links, punctuation and typical words. A linear
chain of labels, main text or not, is trained by its exact likelihood on labelled pages and decoded by Viterbi, so that
neighbours count as well. Main blocks are joined in page order.

Cases: null and empty pages have the empty text; pages without main blocks too; markup that is broken off, never closed or
closed twice is read to its end; repeated rows each give a row; long pages are read whole; ties go to "not main"; only
page_id, url and html are read, so other columns can have any name.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carledger.llm.labelled_pages import MARK, Pages

TRAIN_PAGES = 800  # labelled pages that the model is fitted on
OFTEN = 10  # pages that have a feature, at least
STEPS = 150  # of the fit
PENALTY = 0.002

# Tags as HTML defines them.
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template textarea title svg select iframe object canvas head".split())
RAW = set("script style noscript textarea title iframe".split())
HEAD = set("title meta link base script style noscript template".split())  # what may stand in a head; all else ends it
CLOSES = {  # tags that end an open element of the same kind, up to the parent that bounds it
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)", re.S)
_NAMED = re.compile(r"[\s/'\"](?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile("[a-z]+")


class Block(NamedTuple):
    """The text of a leaf block, the share of it in links, its own tag, and the names of its ancestors."""

    text: str
    linked: float
    tag: str
    names: frozenset[str]


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = [("html", frozenset())]
    pieces: list[str] = []
    in_links = at = 0

    def text_to(end: int) -> None:
        nonlocal in_links
        if stack[-1][0] == "head" and page[at:end].strip():
            stack.pop()
        if end > at and not any(tag in HIDDEN for tag, _ in stack):
            text = markup.unescape(page[at:end])
            pieces.append(text)
            if any(tag == "a" for tag, _ in stack):
                in_links += len(text)

    def flush() -> None:
        nonlocal in_links
        text = " ".join("".join(pieces).split())
        if text:
            own = next(tag for tag, _ in reversed(stack) if tag not in INLINE)
            out.append(Block(text, in_links / max(1, len(text)), own, stack[-1][1]))
        pieces.clear()
        in_links = 0

    def close(kinds: set[str], bounds: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in kinds:
                del stack[k:]
                return
            if stack[k][0] in bounds:
                return

    while True:
        m = _TAG.search(page, at)
        if not m:
            break
        text_to(m.start())
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if not m[1] and tag not in HEAD and any(name == "head" for name, _ in stack[:3]):
            close({"head"}, set())
        if tag == "br":
            pieces.append(" ")
        elif tag not in INLINE:
            flush()
        if m[1]:
            close({tag}, {"table", "article", "main", "body"} if tag in INLINE else set())
            continue
        if tag not in INLINE:
            close({"p"}, {"table", "article", "main", "section", "div", "li", "td", "blockquote", "form"})
            if tag in CLOSES:
                close(*CLOSES[tag])
        if tag in VOID or m[3].endswith("/") and tag not in RAW:
            continue
        named = {f"<{tag}"}
        for attribute in _NAMED.findall(m[3]):
            named.update(f".{w}" for w in _PART.findall("".join(attribute).lower()))
        stack.append((tag, stack[-1][1] | named))
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    text_to(len(page))
    flush()
    return out


def features(page: list[Block]) -> list[list[str]]:
    """The features of each block."""
    out = []
    for k, b in enumerate(page):
        words = b.text.split()
        size, last = len(words), b.text[-1]
        own = [*b.names, f"tag {b.tag}", f"size {min(6, size.bit_length())}", f"links {round(3 * b.linked)}", "any"]
        own.append("stop" if last in ".!?…。" else "no stop")
        own.append(f"commas {min(2, b.text.count(','))}")
        if "©" in b.text:
            own.append("copyright")
        if k == 0 or k == len(page) - 1:
            own.append("first" if k == 0 else "last")
        if size <= 12:
            own += {f"word {w.strip('.,:!?').lower()}" for w in words}
        out.append(own)
    return out


class Chain(NamedTuple):
    """Weights of features, [feature, label], and of neighbouring labels, [label, next]."""

    known: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    def decode(self, own: list[list[str]]) -> list[bool]:
        """The best labels by Viterbi."""
        if not own:
            return []
        known = self.known
        sums = [self.weights[[known[f] for f in fs if f in known]].sum(0) for fs in own]
        best, back = sums[0], []
        for s in sums[1:]:
            both = best[:, None] + self.steps
            back.append(both.argmax(0))
            best = both.max(0) + s
        labels = [int(best.argmax())]
        for b in reversed(back):
            labels.append(int(b[labels[-1]]))
        return [x == 1 for x in reversed(labels)]


def _log_add(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(pages: int = TRAIN_PAGES, seed: int = 1) -> Chain:
    """Fits the chain on labelled pages by gradient steps on the exact likelihood, all pages at once."""
    source = Pages(seed)
    rows: list[tuple[list[list[str]], list[int]]] = []
    for _ in range(pages):
        found = blocks(source.page())
        plain = [b._replace(text=b.text.replace(MARK, "").strip() or "-") for b in found]
        rows.append((features(plain), [int(MARK in b.text) for b in found]))
    seen: dict[str, int] = {}
    for own, _ in rows:
        for f in {f for fs in own for f in fs}:
            seen[f] = seen.get(f, 0) + 1
    known = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= OFTEN))}
    length = max(len(y) for _, y in rows)
    label, inside = np.zeros((pages, length), int), np.zeros((pages, length), bool)
    at, which = [], []
    for p, (own, y) in enumerate(rows):
        label[p, : len(y)], inside[p, : len(y)] = y, True
        for t, fs in enumerate(own):
            ids = [known[f] for f in fs if f in known]
            which += ids
            at += [p * length + t] * len(ids)
    at, which = np.array(at), np.array(which)
    weights, steps = np.zeros((len(known), 2)), np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(steps), np.zeros_like(steps)]
    total = inside.sum()
    pair = inside[:, 1:]
    for k in range(1, STEPS + 1):
        scores = np.stack([np.bincount(at, weights[which, c], minlength=pages * length) for c in (0, 1)], 1).reshape(pages, length, 2)
        ahead, behind = scores.copy(), np.zeros_like(scores)
        for t in range(1, length):
            step = scores[:, t] + _log_add(ahead[:, t - 1, :, None] + steps, 1)
            ahead[:, t] = np.where(inside[:, t, None], step, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            step = _log_add(steps + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], step, 0)
        norm = _log_add(ahead[:, -1], 1)
        share = np.exp(ahead + behind - norm[:, None, None]) * inside[..., None]
        both = ahead[:, :-1, :, None] + steps + (scores + behind)[:, 1:, None, :] - norm[:, None, None, None]
        both = np.exp(np.minimum(both, 0)) * pair[..., None, None]
        off = share - np.eye(2)[label] * inside[..., None]
        flat = off.reshape(-1, 2)[at]
        slope = np.stack([np.bincount(which, flat[:, c], minlength=len(known)) for c in (0, 1)], 1) / total + PENALTY * weights / 10
        truth = np.zeros((2, 2))
        np.add.at(truth, (label[:, :-1][pair], label[:, 1:][pair]), 1)
        bend = (both.sum((0, 1)) - truth) / total + PENALTY * steps / 10
        for x, g, m, v in ((weights, slope, *moments[:2]), (steps, bend, *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Chain(known, weights, steps)


def main_text(page: str, chain: Chain) -> str:
    found = blocks(page)
    return " ".join(b.text for b, main in zip(found, chain.decode(features(found)), strict=True) if main)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for each row of `pages`."""
    shared = pages.sparkSession.sparkContext.broadcast(tuple(train()))  # some hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = Chain(*shared.value)
        for batch in batches:
            texts = [main_text(p.as_py() or "", chain) for p in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
