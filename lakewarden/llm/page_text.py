"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into blocks: stretches of text within one block-level element. A block's features are the tags and the
words of class and id of its ancestors, its own tag, its length, share of linked text, punctuation and cue words. The
field has two labels, main text or not; it is trained here by gradient ascent on labelled pages and decodes a page's
blocks together by Viterbi. The labelled pages are made by ``labelled_pages``: layouts with the parts a page can have,
in many arrangements, with and without telling tags.

Scripts, styles, comments of the markup and the head are no blocks. Character references are decoded, white space
inside a block (line breaks too) becomes one space, blocks are joined by a line feed. A null or empty page has an empty
text. Any markup is accepted: unclosed, wrongly nested and cut off.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.base import map_batches, slices

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Their content is no text of the page.
SILENT_TAGS = frozenset("script style noscript template title head textarea iframe svg object".split())
#: A new one ends an open one of the same group.
SIBLINGS = {t: g for g in (("li",), ("dd", "dt"), ("td", "th"), ("tr",), ("option",)) for t in g}
#: Elements that an end tag or a sibling inside them can't close across.
SCOPES = frozenset("article aside body div footer form header main nav section table ul ol dl select td th button".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[^\W\d_]{2,}")


class Block:
    __slots__ = ("text", "path", "tag", "linked")

    def __init__(self, text: str, path: tuple[str, ...], tag: str, linked: int):
        self.text, self.path, self.tag, self.linked = text, path, tag, linked


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order."""
    stack: list[str] = []
    marks: list[str] = []  # for each open element its tag and the words of its class, id and role
    out: list[Block] = []
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                blocks = [m for t, m in zip(stack, marks, strict=True) if t in BLOCK_TAGS]
                tag = next((t for t in reversed(stack) if t in BLOCK_TAGS), "")
                out.append(Block(text, tuple(blocks), tag, linked))
            pieces.clear()
        linked = 0

    def close(name: str, within: frozenset[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] == name:
                del stack[i:], marks[i:]
                return
            if stack[i] in within:
                return

    at = 0
    while True:
        found = TAG.search(page, at)
        stop = found.start() if found else len(page)
        if stop > at:
            piece = page[at:stop]
            pieces.append(piece)
            if "a" in stack:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                pieces.append(entities.escape(found[0][9:].removesuffix("]]>")))
            continue
        ends, rest = found[1] or found[4], found[3] or found[6] or ""
        if name in SILENT_TAGS:
            if not ends and not rest.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>" if name != "head" else r"</head\b[^>]*>|(?=<body\b)", re.IGNORECASE).search(page, at)
                at = end.end() if end else (len(page) if name != "head" else at)
                pieces.append(" ")
            continue
        block = name in BLOCK_TAGS
        if block:
            flush()
        elif name == "br":
            pieces.append(" ")
        if ends:
            if name in stack:
                close(name, frozenset() if name in SCOPES else SCOPES - {name})
        elif name not in VOID_TAGS:
            if block:
                close("p", SCOPES)
            for sibling in SIBLINGS.get(name, ()):
                close(sibling, frozenset(("ul", "ol", "dl", "table", "select")) if sibling != "td" else frozenset(("table", "tr")))
            if not rest.endswith("/"):
                words = [w.lower() for m in NAMES.finditer(rest) for w in WORD.findall(m[1] or m[2] or m[3] or "")] if rest else []
                stack.append(name)
                marks.append(" ".join([name, *words]))
    flush()
    return out


def path_features(path: tuple[str, ...], tag: str) -> list[str]:
    out = {f"own:{tag}"}
    for mark in path:
        name, *words = mark.split(" ")
        out.add(f"in:{name}")
        out.update(f"named:{w}" for w in words)
    return sorted(out)


def text_features(block: Block, cues: frozenset[str]) -> list[str]:
    text = block.text
    words = text.split()
    out = [f"words:{min(len(words).bit_length(), 8)}", f"linked:{min(4, 4 * block.linked // max(1, len(text)))}"]
    if text[-1] in ".!?…\"”":
        out.append("stop")
    if "©" in text or "®" in text:
        out.append("sign")
    out += [f"cue:{w}" for w in cues.intersection(map(str.lower, words))]
    return out


#: Words that tell parts of a page from its text, whatever the layout.
CUES = frozenset(
    "cookie cookies subscribe newsletter copyright comment comments reply share login register advertisement sponsored menu "
    "privacy terms related search sign".split()
)


class PageModel:
    """Weights of features for the label "main text", of label pairs and of the first label."""

    def __init__(self, weights: dict[str, float], pairs: list[list[float]], first: list[float]):
        self.weights, self.pairs, self.first = weights, pairs, first
        self.paths: dict[tuple, float] = {}

    def score(self, block: Block) -> float:
        key = (block.path, block.tag)
        if key not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            self.paths[key] = sum(self.weights.get(f, 0.0) for f in path_features(*key))
        return self.paths[key] + sum(self.weights.get(f, 0.0) for f in text_features(block, CUES))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The most probable labels of all blocks together."""
        if not blocks:
            return []
        (stay, rise), (fall, keep) = self.pairs
        back = []
        no, yes = self.first[0], self.first[1] + self.score(blocks[0])
        for block in blocks[1:]:
            s = self.score(block)
            from_yes_no, from_yes = no + stay < yes + fall, no + rise < yes + keep
            back.append((from_yes_no, from_yes))
            no, yes = max(no + stay, yes + fall), max(no + rise, yes + keep) + s
        label = yes > no
        labels = [label]
        for from_yes_no, from_yes in reversed(back):
            label = from_yes if label else from_yes_no
            labels.append(label)
        return labels[::-1]

    def main_text(self, page: str) -> str:
        blocks = blocks_of(page)
        return "\n".join(b.text for b, kept in zip(blocks, self.decode(blocks), strict=True) if kept)


def train(pages: list[tuple[list[Block], list[bool]]], steps: int = 150, rate: float = 0.2, decay: float = 1e-3) -> PageModel:
    """Maximise the conditional likelihood of the labels, all pages side by side."""
    names: dict[str, int] = {}
    width = max(len(b) for b, _ in pages)
    rows, columns = [], []
    gold = np.zeros((len(pages), width), int)
    there = np.zeros((len(pages), width), bool)
    for i, (blocks, labels) in enumerate(pages):
        gold[i, : len(labels)], there[i, : len(labels)] = labels, True
        for j, block in enumerate(blocks):
            for f in path_features(block.path, block.tag) + text_features(block, CUES):
                rows.append(i * width + j)
                columns.append(names.setdefault(f, len(names)))
    rows, columns = np.array(rows), np.array(columns)
    theta = np.zeros(len(names) + 6)
    moments = np.zeros((2, len(theta)))

    def logsum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        weights, pairs, first = theta[: len(names)], theta[-6:-2].reshape(2, 2), theta[-2:]
        emit = np.zeros((len(pages), width, 2))
        emit[:, :, 1] = np.bincount(rows, weights[columns], gold.size).reshape(gold.shape)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = first + emit[:, 0]
        for j in range(1, width):
            ahead[:, j] = np.where(there[:, j, None], logsum(ahead[:, j - 1, :, None] + pairs, 1) + emit[:, j], ahead[:, j - 1])
        for j in range(width - 2, -1, -1):
            behind[:, j] = np.where(there[:, j + 1, None], logsum(pairs + (emit[:, j + 1] + behind[:, j + 1])[:, None, :], 2), 0)
        total = logsum(ahead[:, -1], 1)
        chance = np.exp(ahead + behind - total[:, None, None]) * there[:, :, None]
        wrong = (gold - chance[:, :, 1]) * there
        slope = np.zeros_like(theta)
        slope[: len(names)] = np.bincount(columns, wrong.ravel()[rows], len(names))
        for j in range(1, width):
            some = there[:, j]
            both = ahead[:, j - 1, :, None] + pairs + (emit[:, j] + behind[:, j])[:, None, :] - total[:, None, None]
            expected = np.exp(both[some]).sum(0)
            np.add.at(expected, (gold[some, j - 1], gold[some, j]), -1)
            slope[-6:-2] -= expected.ravel()
        slope[-2:] = np.bincount(gold[:, 0], minlength=2) - chance[:, 0].sum(0)
        slope = slope / len(pages) - decay * theta
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.999 * moments[1] + 0.001 * slope * slope
        theta = theta + rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
    return PageModel(dict(zip(names, theta[: len(names)].tolist(), strict=True)), theta[-6:-2].reshape(2, 2).tolist(), theta[-2:].tolist())


def labelled_pages(count: int, seed: int = 11) -> list[tuple[str, list[bool]]]:
    """Pages with a label for each of their blocks, in order."""
    r = random.Random(seed)
    syllables = "ka lo mi ren tas vo du sil par ne".split()

    def say(low: int, high: int, stop: str = ".") -> str:
        return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(low, high))) + stop

    def links(n: int, item: str = "li") -> str:
        return "".join(f'<{item}><a href="/{i}">{say(1, 3, "")}</a></{item}>' for i in range(n))

    def junk() -> tuple[str, int]:
        n = r.randint(2, 7)
        cue = r.choice(["cookie policy", "Subscribe newsletter", "Privacy terms", "Advertisement", "Sponsored", "Sign in", ""])
        name = lambda *names: f'{r.choice(["class", "id"])}="{r.choice(names)}"'
        return r.choice(
            [
                lambda: (f"<nav><ul>{links(n)}</ul></nav>", n),
                lambda: (f'<div {name("menu", "navbar", "nav-links", "breadcrumb")}><ul>{links(n)}</ul></div>', n),
                lambda: (f'<div {name("ad", "ads", "advert", "promo", "banner", "sponsored")}>{say(2, 30)}</div>', 1),
                lambda: (f'<aside><h3>{say(1, 3, "")}</h3><ul>{links(n)}</ul></aside>', n + 1),
                lambda: (f'<div {name("sidebar", "widget", "related", "share")}><h4>{say(1, 3, "")}</h4><p>{say(3, 25)}</p></div>', 2),
                lambda: (f'<div {name("cookie", "notice", "consent", "popup", "alert")}><p>{cue} {say(4, 30)}</p></div>', 1),
                lambda: (f'<form {name("login", "search", "newsletter")}><label>{say(1, 4, "")}</label><button>{cue or "OK"}</button></form>', 2),
                lambda: ("<form><p>" + say(3, 20) + "</p></form>", 1),
            ]
        )()

    def comments() -> tuple[str, int]:
        n = r.randint(1, 5)
        outer = r.choice(['<section class="comments">', '<div id="comments">', '<div class="comment-list">', '<ol class="commentlist">'])
        name = outer[1:].split(" ")[0]
        inner = "".join(f'<div class="comment"><p>{say(2, 40)}</p></div>' for _ in range(n))
        return f"{outer}{inner}</{name}>", n

    def article() -> tuple[str, list[bool]]:
        parts, labels = [], []
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            if kind < 0.08:
                piece, n = comments() if r.random() < 0.4 else junk()
                parts.append(piece)
                labels += [False] * n
            elif kind < 0.16:
                n = r.randint(1, 4)
                parts.append("<ul>" + "".join(f"<li>{say(1, 12)}</li>" for _ in range(n)) + "</ul>")
                labels += [True] * n
            elif kind < 0.24:
                parts.append(f"<{r.choice(['h2', 'h3', 'blockquote', 'pre', 'div'])}>{say(1, 20, r.choice(['', '.']))}")
                parts[-1] += "</" + parts[-1][1:].split(">")[0] + ">"
                labels.append(True)
            else:
                text = say(1, r.choice([2, 10, 60, 120]), r.choice([".", ".", "", "!"]))
                if r.random() < 0.2:
                    text = f'<b>{text}<br>' if r.random() < 0.5 else f'{text} <a href="/x">{say(1, 5)}</a> {say(1, 9)}'
                parts.append(f"<p>{text}" + ("</p>" if r.random() < 0.9 else ""))
                labels.append(True)
        outer = r.choice(
            ["article", "article", "article", "main", 'div class="content"', 'div class="post"', 'div id="article-body"', 'section class="entry"']
        )
        title = r.random() < 0.7
        head = f"<h1>{say(2, 12, '')}</h1>" if title else ""
        return f"<{outer}>{head}{''.join(parts)}</{outer.split(' ')[0]}>", [True] * title + labels

    out = []
    for _ in range(count):
        parts, labels = [], []
        if r.random() < 0.6:
            parts.append(f"<header><p>{say(1, 6, '')}</p><nav><ul>{links(3)}</ul></nav></header>")
            labels += [False] * 4
        for _ in range(r.randint(0, 3)):
            piece, n = junk()
            parts.append(piece)
            labels += [False] * n
        piece, own = article()
        parts.append(piece)
        labels += own
        for make in r.choices([junk, comments], k=r.randint(0, 2)):
            piece, n = make()
            parts.append(piece)
            labels += [False] * n
        if r.random() < 0.8:
            outer = r.choice(["footer", "footer", 'div class="footer"', 'div id="site-footer"'])
            parts.append(f"<{outer}>{r.choice(['&copy; ', 'Copyright ', ''])}{say(2, 14)}</{outer.split(' ')[0]}>")
            labels.append(False)
        page = f"<html><head><title>{say(2, 6)}</title><style>p{{}}</style></head><body>{''.join(parts)}</body></html>"
        if len(blocks_of(page)) == len(labels):
            out.append((page, labels))
    return out


@lru_cache(maxsize=1)
def default_model() -> PageModel:
    return train([(blocks_of(page), labels) for page, labels in labelled_pages(600)])


def extract_main_text(pages: DataFrame, model: PageModel | None = None, html: str = "html") -> DataFrame:
    """``pages`` without the html, with text and n_chars (its code points)."""
    fitted = model or default_model()
    keep = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    schema = T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bodies in slices(batches, "__html"):
            texts = [fitted.main_text(b.decode()) for b in bodies]
            arrays = [part.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return map_batches(pages.select(*keep, F.col(html).alias("__html")), run, schema)
