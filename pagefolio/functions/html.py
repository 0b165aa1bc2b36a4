"""HTML to columns: one page in, its elements and strings out.

``read_pages`` is the only place where Python code touches page content. It runs inside
``mapInArrow``, fills flat columns for a bounded chunk of pages at a time and leaves every
selection rule to Spark expressions (see ``pagefolio.functions.selectors``). Plain pages are read
all at once (see ``pagefolio.functions.plain``), others one event at a time by ``PageReader``.

Output per page
---------------
``text``     stripped text of the page; the text of any element is one slice of it
``nodes``    elements in document order; ``id`` is the position in the array (from 0)
             and the descendants of an element are the ids in ``(id, last]``
``strings``  text nodes, comments and declarations in document order, unstripped; left out
             where the caller does not need them
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pagefolio.functions.plain import (
    ASCII_BLANKS,
    PLAIN_ATTR,
    PLAIN_ATTRS,
    PLAIN_NAME,
    kept_of,
    plain_pages,
)

# Elements that never have content.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose strings are not part of the text of the page.
HIDDEN_TEXT_TAGS = frozenset("rp rt script style template".split())
# Elements in which blank strings keep their exact form.
KEEP_BLANKS_TAGS = frozenset("pre textarea".split())
# Elements whose content is read by rules of its own.
SPECIAL_TAGS = HIDDEN_TEXT_TAGS | KEEP_BLANKS_TAGS | frozenset(HTMLParser.CDATA_CONTENT_ELEMENTS)
SPECIAL_TAGS |= frozenset(getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()))

# Pages are handed back to the JVM in chunks of about this many bytes of HTML.
CHUNK_CHARS = 4_000_000

# Tags in their plainest form, after text without references; everything else is left to the
# standard parser.
_PLAIN_TAG = re.compile(rf"([^<&]*)<(?:/({PLAIN_NAME})>|({PLAIN_NAME})({PLAIN_ATTRS})\s*>)")

DOC_DDL = (
    "text string, "
    "nodes array<struct<id:int,last:int,parent:int,tag:string,class_attr:string,"
    "attrs:map<string,string>,own_string:string,own_at:int,start:int,len:int,words:int>>"
)
STRINGS_DDL = "strings array<struct<parent:int,kind:string,text:string>>"


class PageReader(HTMLParser):
    """Collects the elements and strings of pages in flat columns.

    Nesting follows the tags as written: there are no implied end tags, and an end tag closes
    up to the nearest open element of its name or is ignored.
    """

    def __init__(self, attrs: list[str] | None = None, with_strings: bool = True) -> None:
        super().__init__(convert_charrefs=False)
        self.kept_attrs = attrs  # None: all
        self.with_strings = with_strings
        # One entry per page.
        self.page_text: list[str | None] = []
        self.node_ends = [0]
        self.string_ends = [0]
        # One entry per element; ids count from the first element of the page.
        self.id: list[int] = []
        self.last: list[int] = []
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.class_attr: list[str | None] = []
        self.attr_ends = [0]
        self.attr_names: list[str] = []
        self.attr_values: list[str] = []
        # The only string of an element: stored with the element that holds it, and for elements around
        # it as the id of that element, so that nesting does not repeat it.
        self.own: list[str | None] = []
        self.own_at: list[int | None] = []
        self.start: list[int] = []
        self.len: list[int] = []
        self.words: list[int] = []
        # One entry per string.
        self.string_parent: list[int] = []
        self.string_kind: list[str] = []
        self.string_text: list[str] = []

    def read(self, html: str | None) -> None:
        """Add one page."""
        if html is None:
            self.page_text.append(None)
        else:
            self._begin_page()
            self.reset()
            self.feed(html)
            self.close()
            self._flush()
            while self.open:
                self._close_top()
            self.page_text.append("".join(self.text))
        self.node_ends.append(len(self.tag))
        self.string_ends.append(len(self.string_text))

    def _begin_page(self) -> None:
        self.first = len(self.tag)
        self.open: list[int] = []  # positions in the element columns
        self.open_names: dict[str, int] = {}
        self.hidden: list[str] = []  # open elements whose strings are not text
        self.keep_blanks = 0
        # Per open element: how many children it has, and the string of the only one.
        self.child_count: list[int] = []
        self.child_string: list[str | None] = []
        self.child_own_at: list[int | None] = []
        self.pending: list[str] = []
        self.text: list[str] = []
        self.text_len = 0
        self.spaces = 0  # gaps between words in the text so far

    # -- building ---------------------------------------------------------------------
    def _add_string(self, kind: str, text: str) -> None:
        shown = text.strip()
        if not shown and text and not self.keep_blanks and not text.strip(ASCII_BLANKS):
            text = "\n" if "\n" in text else " "
        if self.open:
            self.child_count[-1] += 1
            self.child_string[-1], self.child_own_at[-1] = text, None
        if self.with_strings:
            self.string_parent.append(self.open[-1] - self.first if self.open else -1)
            self.string_kind.append(kind)
            self.string_text.append(text)
        if shown and (kind == "text" or kind == "cdata"):
            # Strings are joined without a gap, so the words at the seams become one.
            self.text.append(shown)
            self.text_len += len(shown)
            self.spaces += len(shown.split()) - 1

    def _flush(self) -> None:
        if self.pending:
            text = "".join(self.pending)
            self.pending = []
            self._add_string(self.hidden[-1] if self.hidden else "text", text)

    def _add_element(self, tag: str, attrs: dict[str, str]) -> None:
        if self.pending:
            self._flush()
        node = len(self.tag)
        self.id.append(node - self.first)
        self.last.append(node - self.first)
        if self.open:
            self.child_count[-1] += 1
            self.parent.append(self.open[-1] - self.first)
        else:
            self.parent.append(-1)
        self.tag.append(tag)
        if attrs:
            klass, attrs = kept_of(attrs, self.kept_attrs)
            self.class_attr.append(klass)
            self.attr_names.extend(attrs.keys())
            self.attr_values.extend(attrs.values())
        else:
            self.class_attr.append(None)
        self.attr_ends.append(len(self.attr_names))
        self.own.append(None)
        self.own_at.append(None)
        self.start.append(self.text_len)
        # Until the element is closed this holds the gaps before it.
        self.words.append(self.spaces)
        self.len.append(0)

    def _open_element(self, tag: str, attrs: dict[str, str]) -> None:
        self._add_element(tag, attrs)
        if tag in VOID_TAGS:
            self._finish(len(self.tag) - 1)
            if self.open:
                self.child_string[-1] = self.child_own_at[-1] = None
            return
        self.open.append(len(self.tag) - 1)
        self.child_count.append(0)
        self.child_string.append(None)
        self.child_own_at.append(None)
        self.open_names[tag] = self.open_names.get(tag, 0) + 1
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden.append(tag)
        elif tag in KEEP_BLANKS_TAGS:
            self.keep_blanks += 1

    def _finish(self, node: int) -> None:
        length = self.text_len - self.start[node]
        self.len[node] = length
        self.words[node] = self.spaces - self.words[node] + 1 if length else 0

    def _close_top(self) -> str:
        node = self.open.pop()
        tag = self.tag[node]
        self.last[node] = len(self.tag) - 1 - self.first
        self._finish(node)
        only_string, own_at = self.child_string.pop(), self.child_own_at.pop()
        if self.child_count.pop() != 1:
            own_at = None
        elif only_string is not None:
            self.own[node], own_at = only_string, node - self.first
        self.own_at[node] = own_at
        if self.open:
            self.child_string[-1], self.child_own_at[-1] = None, own_at
        self.open_names[tag] -= 1
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden.pop()
        elif tag in KEEP_BLANKS_TAGS:
            self.keep_blanks -= 1
        return tag

    # -- events -----------------------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._open_element(tag, {name: value or "" for name, value in attrs})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close_top()

    def handle_endtag(self, tag):
        if self.pending:
            self._flush()
        if self.open_names.get(tag):
            while self._close_top() != tag:
                pass

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            char = chr(code)
            if code < 256:
                char = bytes([code]).decode("windows-1252")
            elif 0xD800 <= code < 0xE000:
                char = "\ufffd"
        except UnicodeDecodeError:
            pass
        except (ValueError, OverflowError):
            char = "\ufffd"
        self.pending.append(char)

    def _special(self, kind: str, data: str) -> None:
        self._flush()
        self._add_string(kind, data)

    def handle_comment(self, data):
        self._special("comment", data)

    def handle_decl(self, decl):
        is_doctype = decl[:8].lower() == "doctype "
        self._special("doctype", decl[8:] if is_doctype else decl)

    def handle_pi(self, data):
        self._special("instruction", data)

    def unknown_decl(self, data):
        is_cdata = data[:6].upper() == "CDATA["
        self._special("cdata" if is_cdata else "declaration", data[6:] if is_cdata else data)

    # -- shortcuts --------------------------------------------------------------------
    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def parse_starttag(self, i):
        end = self._plain_tags(i)
        return super().parse_starttag(i) if end == i else end

    def parse_endtag(self, i):
        end = i if self.cdata_elem else self._plain_tags(i)
        return super().parse_endtag(i) if end == i else end

    def _plain_tags(self, i: int) -> int:
        """Take in plain tags, and the text between them, as far as they go from ``i``."""
        while plain := _PLAIN_TAG.match(self.rawdata, i):
            text, closed, opened, attrs = plain.groups()
            i = plain.end()
            if text:
                self.pending.append(text)
            if closed:
                self.handle_endtag(closed.lower())
                continue
            opened = opened.lower()
            values = PLAIN_ATTR.findall(attrs) if attrs else ()
            self._open_element(opened, {name.lower(): value for name, value in values})
            if opened in self.CDATA_CONTENT_ELEMENTS:
                self.set_cdata_mode(opened)
                break
        return i

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # unknown section: read on, as browsers do
            return self.parse_bogus_comment(i)

    # -- result -----------------------------------------------------------------------
    def arrays(self) -> list[pa.Array]:
        """The document columns of all pages read so far."""
        int32, string = pa.int32(), pa.string()
        missing = pa.array([t is None for t in self.page_text], pa.bool_())
        attrs = pa.MapArray.from_arrays(
            pa.array(self.attr_ends, int32),
            pa.array(self.attr_names, string),
            pa.array(self.attr_values, string),
        )
        nodes = pa.StructArray.from_arrays(
            [
                pa.array(self.id, int32),
                pa.array(self.last, int32),
                pa.array(self.parent, int32),
                pa.array(self.tag, string),
                pa.array(self.class_attr, string),
                attrs,
                pa.array(self.own, string),
                pa.array(self.own_at, int32),
                pa.array(self.start, int32),
                pa.array(self.len, int32),
                pa.array(self.words, int32),
            ],
            "id last parent tag class_attr attrs own_string own_at start len words".split(),
        )
        columns = [
            pa.array(self.page_text, string),
            pa.ListArray.from_arrays(pa.array(self.node_ends, int32), nodes, mask=missing),
        ]
        if self.with_strings:
            strings = pa.StructArray.from_arrays(
                [
                    pa.array(self.string_parent, int32),
                    pa.array(self.string_kind, string),
                    pa.array(self.string_text, string),
                ],
                ["parent", "kind", "text"],
            )
            columns.append(
                pa.ListArray.from_arrays(pa.array(self.string_ends, int32), strings, mask=missing)
            )
        return columns


def document_columns(html: pa.Array, attrs: list[str] | None, with_strings: bool) -> list[pa.Array]:
    """The document columns of a chunk of pages, in its order."""
    plain, columns = plain_pages(html, attrs, with_strings, VOID_TAGS, SPECIAL_TAGS)
    if len(plain) == len(html) > 0:
        return columns
    others = np.setdiff1d(np.arange(len(html)), plain, assume_unique=True)
    reader = PageReader(attrs, with_strings)
    for i in others:
        reader.read(html[i].as_py())
    if not len(plain):
        return reader.arrays()
    order = pa.array(np.argsort(np.concatenate([plain, others])))
    return [pa.concat_arrays(both).take(order) for both in zip(columns, reader.arrays(), strict=True)]


def read_pages(
    batches: Iterator[pa.RecordBatch],
    html_col: str,
    attrs: list[str] | None = None,
    with_strings: bool = True,
) -> Iterator[pa.RecordBatch]:
    """Replace the HTML column of each batch by the document columns."""
    names = ["text", "nodes", "strings"] if with_strings else ["text", "nodes"]
    for batch in batches:
        kept = [n for n in batch.schema.names if n != html_col]
        pages = batch.column(html_col)
        read = np.cumsum(pc.fill_null(pc.binary_length(pages), 0).to_numpy(), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            full = (read[begin - 1] if begin else 0) + CHUNK_CHARS
            end = min(int(np.searchsorted(read, full)) + 1, batch.num_rows)
            columns = document_columns(pages.slice(begin, end - begin), attrs, with_strings)
            carried = [batch.column(n).slice(begin, end - begin) for n in kept]
            yield pa.RecordBatch.from_arrays(carried + columns, names=kept + names)
            begin = end
