"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags, in page order, each with
the tags it lies in. The field labels each block as content or not, from ancestor tags, class
words and text features of the block and from the label of the block before it; Viterbi search
finds the best labels of the page.

The field is trained on pages that label themselves: where a page has an ``article`` or ``main``
element, its blocks are content unless a tag or class word inside marks them as something else.
At most ``TRAIN_PAGES`` pages are used, whatever the size of the table. Without such pages the
prior weights of ``PRIOR`` decide alone.

Null, empty and tag-only pages have the empty text. Broken markup is read as far as it goes: an
unclosed block tag ends with its parent, an unclosed comment, script or style at the end of page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefolio.llm.text import slices

TRAIN_PAGES = 200
# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img".split()
)
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select".split())
# Elements whose text belongs to no article.
NEVER = RAW | frozenset("head title nav form button input footer aside menu dialog".split())
# What a start tag of the key ends without an end tag.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
BLOCK_STARTS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)
# Words in a class, id or role that mark a block as something other than the article.
MARKS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disclaimer footer header masthead menu nav navbar navigation newsletter notice "
    "pagination popup promo promoted related respond reply share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar widget".split()
)
CONTENT_MARKS = frozenset("article body content entry main post story text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
SPACES = re.compile(r"\s+")
MARK_WORD = re.compile(r"[a-z]+")


def leaf_blocks(page: str | None) -> list[tuple[str, tuple[str, ...], float]]:
    """``(text, path, share of it in links)`` of the blocks with text, in page order.

    ``path`` holds the tags and ``.word`` for the marks of all elements the block lies in.
    """
    blocks: list[tuple[str, tuple[str, ...], float]] = []
    if not page:
        return blocks
    stack: list[tuple[str, tuple[str, ...]]] = []
    path: tuple[str, ...] = ()
    run: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = SPACES.sub(" ", html.unescape("".join(run))).strip()
            if text:
                blocks.append((text, path, min(1.0, linked / len(text))))
        run, linked = [], 0

    def close(index: int) -> None:
        nonlocal path, in_link
        if any(tag == "a" for tag, _ in stack[index:]):
            in_link = 0
        path = stack[index][1]
        del stack[index:]

    def closest(names: tuple[str, ...] | frozenset, stop: tuple[str, ...]) -> int | None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in stop:
                return None
        return None

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            run.append(page[at:lt])
            linked += (lt - at) * in_link
        if lt == n:
            break
        found = TOKEN.match(page, lt)
        if not found:
            run.append("<")
            at = lt + 1
            continue
        at = found.end()
        name = found.group(2) or found.group(5)
        if not name:
            continue
        name, is_end = name.lower(), bool(found.group(1) or found.group(4))
        attributes = found.group(3) or found.group(6) or ""
        if is_end:
            if name in INLINE:
                if name == "a":
                    in_link = 0
                i = closest((name,), ("table", "td", "article", "div"))
                if i is not None and all(tag in INLINE for tag, _ in stack[i:]):
                    close(i)
                continue
            i = closest((name,), ())
            if i is not None:
                flush()
                close(i)
            elif name in BLOCK_STARTS or name == "br":
                flush()
            continue
        if name in RAW:
            # Raw text ends at its own end tag only, whatever its content looks like.
            if attributes.endswith("/") and name in ("svg", "math"):
                continue
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            flush()
            at = end.end() if end else n
            continue
        if name in INLINE:
            if name == "a":
                in_link = 1
            if name != "wbr" and name != "img":
                stack.append((name, path))
            continue
        if name == "br":
            run.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        if name in BLOCK_STARTS:
            i = closest(("p",), ("table", "td", "th", "article", "div", "section", "li", "main"))
            if i is not None:
                close(i)
        if name in CLOSES:
            i = closest(CLOSES[name], ("ul", "ol", "dl", "table", "select"))
            if i is not None:
                close(i)
        stack.append((name, path))
        marks = ()
        if "=" in attributes:
            words = (w for m in ATTRIBUTE.finditer(attributes) for w in MARK_WORD.findall((m[2] or m[3] or m[4] or "").lower()))
            marks = tuple(f".{w}" for w in words if w in MARKS or w in CONTENT_MARKS)
        path = (*path, name, *marks)
    flush()
    return blocks


# Observation features and their prior weight for content against the rest.
PRIOR = {
    "bias": 0.2, "never": -8.0, "marked": -6.0, "content": 3.0, "content_mark": 1.0, "header": -4.0,
    "after_h1": 0.5, "paragraph": 1.0, "heading": 0.5, "list": -0.3, "cell": 0.0, "links": -2.0,
    "long": 1.0, "short": -0.3, "sentence": 0.5, "copyright": -1.0, "first": 0.0, "last": -0.3,
}
FEATURES = list(PRIOR)
_AT = {name: i for i, name in enumerate(FEATURES)}
MARK_NAMES = frozenset(f".{w}" for w in MARKS)
CONTENT_NAMES = frozenset(f".{w}" for w in CONTENT_MARKS)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PRIOR_WEIGHTS = np.array([PRIOR[f] for f in FEATURES])
PRIOR_MOVES = np.array([[0.5, -0.5], [-0.5, 0.5]])


def path_features(path: tuple[str, ...]) -> tuple[int, ...]:
    """Features of the ancestors."""
    names, leaf = set(path), path[-1] if path else ""
    inside = "article" in names or "main" in names
    # A header inside an article belongs to it if it holds the headline.
    found = {
        "bias": True, "never": bool(names & NEVER), "marked": bool(names & MARK_NAMES), "content": inside,
        "content_mark": bool(names & CONTENT_NAMES), "header": "header" in names and not inside,
        "paragraph": leaf in ("p", "blockquote", "pre"), "heading": bool(names & HEADINGS),
        "list": "li" in names, "cell": "td" in names or "th" in names,
    }
    return tuple(_AT[name] for name, value in found.items() if value)


def observations(blocks: list[tuple[str, tuple[str, ...], float]], memory: dict) -> np.ndarray:
    """Feature rows of the blocks of a page; ``memory`` keeps the features of paths."""
    rows = np.zeros((len(blocks), len(FEATURES)))
    for i, (text, path, links) in enumerate(blocks):
        of = memory.get(path)
        if of is None:
            if len(memory) > 50_000:
                memory.clear()
            of = memory[path] = path_features(path)
        rows[i, of] = 1
        rows[i, _AT["links"]] = links
        rows[i, _AT["long"]] = len(text) > 100
        rows[i, _AT["short"]] = len(text) < 25
        rows[i, _AT["sentence"]] = text[-1] in ".!?:;\"'»”…"
        rows[i, _AT["copyright"]] = "©" in text
    rows[0, _AT["first"]] = rows[-1, _AT["last"]] = 1
    return rows


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels for ``scores`` of content per block; ``moves[a, b]`` is the score of b after a."""
    best, back = np.array([0.0, scores[0]]), np.zeros((len(scores), 2), int)
    for i in range(1, len(scores)):
        step = best[:, None] + moves
        back[i] = step.argmax(axis=0)
        best = step.max(axis=0) + (0.0, scores[i])
    labels = np.zeros(len(scores), int)
    labels[-1] = best.argmax()
    for i in range(len(scores) - 1, 0, -1):
        labels[i - 1] = back[i, labels[i]]
    return labels


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 25, pull: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves of the field by gradient ascent on the log likelihood.

    ``pages`` holds feature rows and labels. The weights are pulled towards the prior, so what
    no training page shows keeps its prior weight.
    """
    weights, moves = PRIOR_WEIGHTS.copy(), PRIOR_MOVES.copy()
    total = max(sum(len(y) for _, y in pages), 1)
    for round_ in range(rounds if pages else 0):
        gw, gm = np.zeros_like(weights), np.zeros_like(moves)
        for x, y in pages:
            scores = np.stack([np.zeros(len(x)), x @ weights], axis=1)
            ahead, behind = scores.copy(), np.zeros_like(scores)
            for i in range(1, len(x)):
                ahead[i] += log_sum(ahead[i - 1][:, None] + moves, 0)
            for i in range(len(x) - 2, -1, -1):
                behind[i] = log_sum(moves + (scores[i + 1] + behind[i + 1])[None, :], 1)
            norm = log_sum(ahead[-1], 0)
            gw += x.T @ (y - np.exp(ahead[:, 1] + behind[:, 1] - norm))
            if len(x) > 1:
                pair = ahead[:-1, :, None] + moves + (scores[1:] + behind[1:])[:, None, :] - norm
                np.add.at(gm, (y[:-1], y[1:]), 1)
                gm -= np.exp(pair).sum(axis=0)
        rate = 6.0 / (1 + 0.1 * round_)
        weights += rate * (gw - pull * (weights - PRIOR_WEIGHTS)) / total
        moves += rate * (gm - pull * (moves - PRIOR_MOVES)) / total
    return weights, moves


def own_label(path: tuple[str, ...]) -> int:
    """Label of a block on a page that marks its article."""
    inside = max((i for i, name in enumerate(path) if name in ("article", "main")), default=None)
    if inside is None:
        return 0
    return int(not any(name in NEVER or name in MARK_NAMES for name in path))


def train(pages: DataFrame, limit: int = TRAIN_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """The field of at most ``limit`` pages that mark their article, chosen by the hash of the page.

    Only feature rows and labels reach the driver.
    """
    marked = pages.select("html").filter(F.lower("html").rlike("<(article|main)[ >]"))
    chosen = marked.orderBy(F.xxhash64("html")).limit(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 32):
                rows = []
                for page in part.column(0).to_pylist():
                    if blocks := leaf_blocks(page):
                        x = observations(blocks, {})
                        y = np.array([own_label(path) for _, path, _ in blocks], np.int8)
                        rows.append((x.astype(np.float32).tobytes(), y.tobytes()))
                if rows:
                    yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], ["x", "y"])

    rows = chosen.mapInArrow(run, "x binary, y binary").collect()
    found = [
        (np.frombuffer(r["x"], np.float32).astype(float).reshape(-1, len(FEATURES)), np.frombuffer(r["y"], np.int8).astype(int))
        for r in rows
    ]
    return fit(sorted(found, key=lambda p: (len(p[1]), p[0].tobytes())))


def main_texts(pages: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks`` of every row of ``pages``."""
    weights, moves = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            for part in slices(batch, 64):
                texts, kept = [], []
                for page in part.column(2).to_pylist():
                    blocks = leaf_blocks(page)
                    chosen = []
                    if blocks:
                        labels = viterbi(observations(blocks, memory) @ weights, moves)
                        chosen = [b[0] for b, label in zip(blocks, labels, strict=True) if label]
                    texts.append("\n".join(chosen))
                    kept.append(len(chosen))
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes, pa.array(kept, pa.int64())],
                    ["page_id", "url", "text", "n_chars", "n_blocks"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_blocks long"
    )
