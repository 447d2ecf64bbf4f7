"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks: the text between borders of block elements, with its open elements. A linear classifier
over element names, class and id words, link share, length and sentence signs gives each block a cost as content and
as boilerplate. Inline elements that are hidden or marked as boilerplate lose their own piece only. Words of an id count on
containers only, since headings and paragraphs have ids as anchors, and inside an article only those that never name a
section of a text. The costs are its capacities to the two terminals. Smoothness edges join neighbours in page order and
next blocks of one parent element, stronger the nearer they are in the tree. A maximum flow separates the two sides;
blocks on the source side are the text. Blocks whose terminal capacity outweighs all their edges have the same label in
every minimum cut and are folded away first, which leaves the flow a few doubtful blocks.

Pages are independent: one pass, no shuffle, whole html whatever its length, in slices of whole pages of about 1 MB.
Character references are decoded piece by piece, between two tags.

Defined cases: null or empty html gives an empty text; unclosed or crossing tags follow the usual repairs; a page
without any content block gives an empty text; null urls and repeated pages pass through; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadweave.llm.words import batch_slices

# Names of HTML, and the words that mark parts of pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg annotation annotation-xml iframe object head title textarea select option button canvas audio video".split())
RAW = frozenset("script style textarea title iframe noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
ELEMENT = {"article": 5.0, "main": 4.0, "nav": -12.0, "footer": -12.0, "aside": -12.0, "form": -12.0, "dialog": -12.0, "menu": -12.0,
           "header": -9.0, "fieldset": -6.0, "search": -12.0, "address": -1.0, "figcaption": -0.5}
BAD = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay sidebar sidebars side aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer foot header masthead "
    "topbar toolbar comment comments commentlist disqus reply replies respond discussion share sharing social related recommended recommendations "
    "subscribe subscription newsletter signup login widget widgets form search skip copyright legal tags tagcloud outbrain taboola".split())
SURELY_BAD = frozenset("ad ads advert adverts advertisement cookie cookies comment comments commentlist disqus respond newsletter sidebar outbrain taboola".split())
CONTAINERS = frozenset("article aside div footer form header main nav ol section table ul".split())
GOOD = frozenset("article content main post entry story body text page".split())
BAD_WORD, GOOD_WORD, HIDDEN = -9.0, 2.5, -30.0
MARKED = -6.0  # inline weight from which a piece is left out

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
_NAMES = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


class Block:
    __slots__ = ("pieces", "linked", "bias", "parent", "depth", "tag")

    def __init__(self, bias, parent, depth, tag):
        self.pieces, self.linked, self.bias, self.parent, self.depth, self.tag = [], 0, bias, parent, depth, tag


def _weight(tag: str, attributes: str, in_article: bool) -> float:
    """What an element says about the text inside it."""
    out = ELEMENT.get(tag, 0.0)
    if attributes:
        if tag not in ("html", "body"):
            words = set()
            for name, *value in _NAMES.findall(attributes):
                found = _WORD.findall("".join(value).lower())
                if name.lower() == "id":
                    found = [w for w in found if w not in BAD or not in_article or w in SURELY_BAD] if tag in CONTAINERS else []
                words.update(found)
            if words & BAD:
                out += BAD_WORD
            elif words & GOOD:
                out += GOOD_WORD
        if _HIDDEN.search(attributes):
            out += HIDDEN
    return out


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page that hold text, in page order."""
    # open elements: tag, weight of all of them, number of the nearest block element, block depth, inside a link, silent, weight up to
    # the nearest block element, inside an article
    stack = [("", 0.0, 0, 0, False, False, 0.0, False)]
    opened: dict[str, int] = {}
    out: list[Block] = []
    block, number, at, size = None, 0, 0, len(html)

    def pop_to(k):
        for entry in stack[k:]:
            opened[entry[0]] -= 1
        del stack[k:]

    def text(piece):
        nonlocal block
        _, bias, parent, depth, link, silent, outer, _ = stack[-1]
        if silent or not piece or bias - outer <= MARKED or (block is None and piece.isspace()):
            return
        if block is None:
            tag = next((e[0] for e in reversed(stack) if e[0] in BLOCKS), "")
            block = Block(outer, parent, depth, tag)
            out.append(block)
        block.pieces.append(unescape(piece) if "&" in piece else piece)
        block.bias = min(block.bias, outer)
        if link:
            block.linked += len(piece)

    while at < size:
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        if m.start() > at:
            text(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        is_block = tag in BLOCKS
        if is_block:
            block = None
        if closing:
            if opened.get(tag):
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                pop_to(k)
            continue
        if tag == "br":
            text(" ")
        if tag in VOID:
            continue
        if is_block and opened.get("p"):  # a block element ends an open paragraph
            k = len(stack) - 1
            while stack[k][0] != "p":
                k -= 1
            pop_to(k)
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            k = len(stack) - 1
            while k and stack[k][0] not in within and stack[k][0] not in ends:
                k -= 1
            if stack[k][0] in ends:
                pop_to(k)
        if tag == "body":  # the head ends where the body begins
            while len(stack) > 1 and stack[-1][0] != "html":
                pop_to(len(stack) - 1)
        _, bias, parent, depth, link, silent, outer, inside = stack[-1]
        number += 1
        bias += _weight(tag, attributes, inside)
        stack.append((tag, bias, number if is_block else parent, depth + is_block, link or tag == "a", silent or tag in SILENT,
                      bias if is_block else outer, inside or tag in ("article", "main")))
        opened[tag] = opened.get(tag, 0) + 1
        if tag in RAW and not attributes.endswith("/"):
            end = re.compile(f"</{tag}", re.I).search(html, at)
            at = end.start() if end else size
    return out


def content_odds(block: Block, text: str) -> float:
    """Log-odds of being content: the terminal capacities, as a difference."""
    words = text.count(" ") + 1
    share = min(1.0, block.linked / max(1, len(text)))
    odds = block.bias - 1.2 + 0.08 * min(words, 30) - 4.0 * share
    if block.tag in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4"):
        odds += 0.8
    if _SENTENCE.search(text):
        odds += 0.5
    return odds


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in page order and the next block of the same parent's parent element."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            out.append((i - 1, i, 1.0 if a.parent == b.parent else 0.6 / (1 + abs(a.depth - b.depth))))
        j = last.get((b.depth, b.tag))
        if j is not None and j < i - 1:
            out.append((j, i, 0.4))
        last[(b.depth, b.tag)] = i
    return out


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: source side) of least cost: |odds| for a label against them, the edge weight for ends apart."""
    n = len(odds)
    odds, near = list(odds), [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:  # a block whose odds outweigh its edges keeps its side in every minimum cut
        i = waiting.popleft()
        if label[i] is None and abs(odds[i]) > sum(near[i].values()):
            label[i] = odds[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                odds[j] += w if label[i] else -w
                waiting.append(j)
            near[i] = {}
    left = [i for i in range(n) if label[i] is None]
    if not left:
        return label
    # residual capacities between the doubtful blocks; terminals hold what is not yet saturated
    supply = {i: max(odds[i], 0.0) for i in left}
    drain = {i: max(-odds[i], 0.0) for i in left}
    flow = {i: dict(near[i]) for i in left}
    while True:
        came = {i: None for i in left if supply[i] > 1e-12}
        queue, end = deque(came), None
        while queue:
            i = queue.popleft()
            if drain[i] > 1e-12:
                end = i
                break
            for j, w in flow[i].items():
                if w > 1e-12 and j not in came:
                    came[j] = i
                    queue.append(j)
        if end is None:
            break
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        push = min([supply[path[-1]], drain[end], *(flow[b][a] for a, b in zip(path, path[1:]))])
        supply[path[-1]] -= push
        drain[end] -= push
        for a, b in zip(path, path[1:]):
            flow[b][a] -= push
            flow[a][b] += push
    for i in left:
        label[i] = i in came
    return label


def main_text(html: str | None) -> tuple[str, int, int]:
    """(text, number of content blocks, number of blocks) of a page."""
    blocks, texts = [], []
    for b in blocks_of(html or ""):
        text = " ".join("".join(b.pieces).split())
        if text:
            blocks.append(b)
            texts.append(text)
    label = minimum_cut([content_odds(b, t) for b, t in zip(blocks, texts)], edges_of(blocks))
    kept = [t for t, on in zip(texts, label) if on]
    return "\n".join(kept), len(kept), len(texts)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_content_blocks and n_blocks of every page."""

    def read(batches):
        for batch in batch_slices(batches, "html"):
            found = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([len(f[0]) for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_content_blocks", "n_blocks"])

    fields = [pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
              *(T.StructField(n, T.LongType()) for n in ("n_chars", "n_content_blocks", "n_blocks"))]
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(read, T.StructType(fields))
