"""Plain pages to document columns, all pages of a chunk at once.

A page is plain if it has only tags in their plainest form and text without references, and if
every tag that is opened is closed in order. Its columns follow from the positions of its brackets
by array operations, with no Python step per element; only different tags are looked at one by one.
All other pages are left to ``PageReader``, which gives the same columns for any page.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ASCII_BLANKS = " \n\t\f\r"
# All that ``str.strip`` removes and ``str.split`` splits at.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_IS_BLANK = np.array([chr(c).isspace() for c in range(0x3001)] + [False])

PLAIN_NAME = "[a-zA-Z][a-zA-Z0-9-]*"
PLAIN_ATTRS = r'(?:\s+[a-zA-Z][a-zA-Z0-9:_.-]*="[^"&]*")*'
PLAIN_ATTR = re.compile(r'\s([a-zA-Z][a-zA-Z0-9:_.-]*)="([^"]*)"')
_TAG = re.compile(rf"<(?:/({PLAIN_NAME})|({PLAIN_NAME})({PLAIN_ATTRS})\s*)>")

OTHER, OPEN, CLOSE, VOID = range(4)


def kept_of(attrs: dict[str, str], kept: list[str] | None) -> tuple[str | None, dict[str, str]]:
    """The class of a tag, its blanks made one space each, and its other attributes that are kept."""
    klass = attrs.pop("class", None)
    if kept is not None:
        attrs = {name: attrs[name] for name in kept if name in attrs}
    return None if klass is None else " ".join(klass.split()), attrs


class Tags:
    """The different tags of a chunk: kind, name, class and attributes of each."""

    def __init__(self, tags: list[str], kept: list[str] | None, void: frozenset, special: frozenset) -> None:
        kinds, names, classes, attrs = [], [], [], []
        for tag in tags:
            parts = _TAG.fullmatch(tag)
            closed, opened, values = parts.groups() if parts else (None, None, None)
            name = (closed or opened or "").lower()
            kind = OPEN if opened else CLOSE if closed else OTHER
            if name in special or kind == CLOSE and name in void:
                kind = OTHER
            elif name in void:
                kind = VOID
            found = {n.lower(): v for n, v in PLAIN_ATTR.findall(values)} if values else {}
            klass, others = kept_of(found, kept)
            kinds.append(kind)
            names.append(name)
            classes.append(klass)
            attrs.append(list(others.items()))
        self.kind = np.array(kinds, np.int8)
        self.names = pa.array(names, pa.string())
        ids = {name: i for i, name in enumerate(dict.fromkeys(names))}
        self.name_id = np.array([ids[name] for name in names], np.int32)
        self.classes = pa.array(classes, pa.string())
        self.attrs = pa.array(attrs, pa.map_(pa.string(), pa.string()))


def _strings(offsets: np.ndarray, data: pa.Buffer) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data)


def _offsets(strings: pa.StringArray) -> np.ndarray:
    if not len(strings):
        return np.zeros(1, np.int32)
    return np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1]


def _data(strings: pa.StringArray) -> pa.Buffer:
    return strings.buffers()[2] or pa.py_buffer(b"")


def _stored_form(texts: pa.StringArray, blank: np.ndarray) -> pa.StringArray:
    """Texts with those of ASCII blanks only as one line end or space."""
    if not blank.any():
        return texts
    blanks = texts.filter(pa.array(blank))
    short = pc.if_else(pc.match_substring(blanks, "\n"), "\n", " ")
    plain = pc.equal(pc.binary_length(pc.utf8_trim(blanks, characters=ASCII_BLANKS)), 0)
    return pc.replace_with_mask(texts, pa.array(blank), pc.if_else(plain, short, blanks))


def _counted(shown: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Before each of the stripped strings and at the end: code points, and gaps between words."""
    at, data = _offsets(shown), _data(shown)
    codes = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    if codes.size and codes.max() >= 0x80:
        at = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])[at].astype(np.int32)
        codes = np.frombuffer(codes.tobytes().decode().encode("utf-32-le"), np.uint32)
        codes = np.minimum(codes, len(_IS_BLANK) - 1)
    blank = _IS_BLANK[codes]
    gaps = np.zeros(len(codes) + 1, np.int32)
    if len(codes):
        np.cumsum(blank[:-1] & ~blank[1:], out=gaps[2:])
    return at, gaps[at]


def _by_level(level: np.ndarray) -> np.ndarray:
    """Positions in order of level, then of the document."""
    small = level.size and level.max() < 256
    return np.argsort(level.astype(np.uint8) if small else level, kind="stable")


def _columns(
    html: pa.StringArray, kept: list[str] | None, with_strings: bool, void: frozenset, special: frozenset
) -> tuple[np.ndarray, list[pa.Array]]:
    """Which pages are found not to be plain, and, if there are none, the columns of all."""
    n, page_at = len(html), _offsets(html)
    data = _data(html).slice(page_at[0])
    page_at = page_at - page_at[0]
    chars = np.frombuffer(data, np.uint8)[: page_at[-1]]
    bad = np.zeros(n, bool)

    # Brackets come in pairs, and there are no references.
    brackets = np.flatnonzero((chars == ord("<")) | (chars == ord(">"))).astype(np.int32)
    first = np.searchsorted(brackets, page_at).astype(np.int32)
    count = np.diff(first)
    bad[count & 1 == 1] = True
    references = np.flatnonzero(chars == ord("&"))
    bad[np.searchsorted(page_at, references, "right") - 1] = True
    if bad.any():
        return bad, []
    page = np.repeat(np.arange(n, dtype=np.int32), count)
    opening = chars[brackets] == ord("<")
    bad[page[::2][~opening[::2] | opening[1::2]]] = True
    if bad.any():
        return bad, []

    # A page is text, tag, text, tag, ..., text: cut there, without a copy.
    cuts = np.empty(len(brackets) + n + 1, np.int32)
    cuts[first + np.arange(n + 1, dtype=np.int32)] = page_at
    cut = np.arange(1, len(brackets) + 1, dtype=np.int32) + page
    cuts[cut] = brackets + ~opening
    pieces = _strings(cuts, data)
    is_text = np.ones(len(pieces), bool)
    is_text[cut[::2]] = False
    found = pieces.filter(pa.array(~is_text)).dictionary_encode()
    tags = Tags(found.dictionary.to_pylist(), kept, void, special)
    code = found.indices.to_numpy()
    page, first = page[::2], first // 2
    kind = tags.kind[code]
    bad[page[kind == OTHER]] = True
    if bad.any():
        return bad, []

    # As many tags are closed as are opened, and never more.
    depth = np.cumsum((kind == OPEN).astype(np.int32) - (kind == CLOSE), dtype=np.int32)
    depth_at = np.concatenate([[0], depth])[first]
    bad[np.diff(depth_at) != 0] = True
    bad[page[depth < depth_at[page]]] = True
    if bad.any():
        return bad, []

    # On one level, tags are opened and closed in turn.
    level = depth - (kind == OPEN)
    paired = np.flatnonzero(kind != VOID)
    paired = paired[_by_level(level[paired])]
    opens, closes = paired[::2], paired[1::2]
    bad[page[opens[tags.name_id[code[opens]] != tags.name_id[code[closes]]]]] = True
    if bad.any():
        return bad, []

    # Elements: the tag where each begins and the tag where it ends.
    at = np.flatnonzero(kind != CLOSE)
    size, code = len(at), code[at]
    upto = np.cumsum(kind != CLOSE, dtype=np.int32) - 1  # per tag: the newest element
    end = at.copy()
    end[upto[opens]] = closes
    element_at = np.concatenate([[0], upto + 1])[first].astype(np.int32)
    of_page = page[at]
    base = element_at[of_page]
    # The first child of an element follows its tag; on one level, siblings follow each other.
    order = _by_level(level[at])
    before = at[order] - 1
    eldest = kind[before] == OPEN
    known = np.where(level[at[order]] == 0, -1, upto[before])
    source = np.where(eldest | (known < 0), np.arange(size), 0)
    parent = np.empty(size, np.int32)
    parent[order] = known[np.maximum.accumulate(source)]
    id_ = np.arange(size, dtype=np.int32) - base

    # Texts: where they stand in the text of the page, and the element that holds them.
    texts = pieces.filter(pa.array(is_text))
    shown = pc.utf8_trim(texts, characters=BLANKS)
    length, text_at = np.diff(_offsets(texts)), _offsets(shown)
    char_at, gaps = _counted(shown)
    blank = (length > 0) & (np.diff(text_at) == 0)
    page_text = first + np.arange(n + 1, dtype=np.int32)  # the first text of each page
    after, until = at + of_page + 1, end + of_page + 1  # the texts after those tags
    start = char_at[after]
    len_ = char_at[until] - start
    words = np.where(len_ > 0, gaps[until] - gaps[after] + 1, 0).astype(np.int32)
    holder = np.full(len(texts), -1, np.int32)
    holder[after] = np.where(end > at, np.arange(size), parent)
    holder[until[upto[opens]]] = parent[upto[opens]]

    # The only string of an element, or of the only element in it, and so on.
    children = np.bincount(holder[(length > 0) & (holder >= 0)], minlength=size)
    children = children + np.bincount(parent[parent >= 0], minlength=size)
    holds = (end == at + 1) & (children == 1)
    passes = (children == 1) & ~holds
    source = np.minimum.accumulate(np.where(passes, size, np.arange(size))[::-1])[::-1]
    own = texts.take(pa.array(after, mask=~holds))
    own_at = pa.array(id_[source], pa.int32(), mask=~holds[source])

    nodes = pa.StructArray.from_arrays(
        [
            pa.array(id_),
            pa.array(upto[end] - base),
            pa.array(np.where(parent < 0, -1, parent - base).astype(np.int32)),
            tags.names.take(pa.array(code)),
            tags.classes.take(pa.array(code)),
            tags.attrs.take(pa.array(code)),
            _stored_form(own, holds & blank[after]),
            own_at,
            pa.array(start - char_at[page_text[of_page]]),
            pa.array(len_),
            pa.array(words),
        ],
        "id last parent tag class_attr attrs own_string own_at start len words".split(),
    )
    columns = [
        _strings(text_at[page_text], _data(shown)),
        pa.ListArray.from_arrays(pa.array(element_at), nodes),
    ]
    if with_strings:
        some = length > 0
        of_text = np.repeat(np.arange(n), np.diff(page_text))[some]
        string_at = np.concatenate([[0], np.cumsum(some)])[page_text].astype(np.int32)
        held = holder[some]
        strings = pa.StructArray.from_arrays(
            [
                pa.array(np.where(held < 0, -1, held - element_at[of_text]).astype(np.int32)),
                pa.array(["text"]).take(pa.array(np.zeros(len(held), np.int32))),
                _stored_form(texts, blank).filter(pa.array(some)),
            ],
            ["parent", "kind", "text"],
        )
        columns.append(pa.ListArray.from_arrays(pa.array(string_at), strings))
    return bad, columns


def plain_pages(
    html: pa.Array, kept: list[str] | None, with_strings: bool, void: frozenset, special: frozenset
) -> tuple[np.ndarray, list[pa.Array]]:
    """Positions of the plain pages of a chunk, and their document columns.

    ``void``: tags that have no content; ``special``: tags whose pages are never plain.
    """
    found = np.flatnonzero(html.is_valid().to_numpy(zero_copy_only=False))
    while len(found):
        pages = (html if len(found) == len(html) else html.take(pa.array(found))).cast(pa.string())
        bad, columns = _columns(pages, kept, with_strings, void, special)
        if not bad.any():
            return found, columns
        found = found[~bad]
    return found, []
