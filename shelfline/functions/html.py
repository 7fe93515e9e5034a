"""Page markup to a flat element list that Column expressions can search.

One Arrow UDF turns a page into its visible text plus the elements in document
order. Each element knows the range of elements below it and the range of text it
covers, so a subtree is a slice and its text is a substring: nothing is stored twice.
All selection happens afterwards, as Column expressions over that list.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Workers get this module's code with the function, so none of them needs the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, elements whose text is not page text,
# elements that keep their white space, attributes that hold word lists.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN_TEXT = frozenset("script style template rt rp".split())
KEEP_SPACE = frozenset("pre textarea".split())
WORD_LISTS = frozenset("class rel rev accesskey dropzone headers accept-charset".split())

# Elements without attributes are listed only if some selector names their tag: these, which
# the package's own rules name, and those of the rules a caller passes on.
NAMED_TAGS = frozenset("a h1 h2 h3 img nav header ul li tr td th title article".split())

NODE_TYPE = (
    "struct<pre:int,post:int,start:int,stop:int,tag:string,classes:array<string>,"
    "attrs:map<string,string>,lone_text:boolean,script:string,up:array<int>>"
)
PAGE_TYPE = f"struct<text:string,nodes:array<{NODE_TYPE}>>"

# Pages that are read together: their elements take some 40 times the memory of their markup.
PIECE_PAGES, PIECE_BYTES = 128, 1 << 20


class _PageReader(HTMLParser):
    """Collects elements; an end tag closes back to the nearest open tag of that name."""

    def __init__(self, listed: frozenset[str]) -> None:
        super().__init__(convert_charrefs=False)
        self.listed = listed
        self.nodes: list[list] = []
        self.open: list[tuple] = []  # (tag, node or None, [child count, only child is text])
        self.text: list[str] = []
        self.length = 0
        self.pending: list[str] = []
        self.hidden = 0

    def _flush(self) -> None:
        if not self.pending:
            return
        data = "".join(self.pending)
        self.pending.clear()
        if not data:
            return
        if not data.strip("\n\t\x0c\r ") and not any(t in KEEP_SPACE for t, _, _ in self.open):
            data = "\n" if "\n" in data else " "
        if self.open:
            self._count_child(text=True)
        if self.hidden:
            tag, node, _ = self.open[-1]
            if tag == "script" and node is not None:
                node[8] = data if node[8] is None else node[8] + data
            return
        self.text.append(data)
        self.length += len(data)

    def _count_child(self, text: bool) -> None:
        shape = self.open[-1][2]
        shape[0] += 1
        shape[1] = text

    def handle_starttag(self, tag, attrs, closed=False):
        self._flush()
        if self.open:
            self._count_child(text=False)
        node = None
        if attrs or tag in self.listed:
            found = {k: v or "" for k, v in attrs}
            for key in WORD_LISTS & found.keys():
                found[key] = " ".join(found[key].split())
            classes = found.get("class", "").split()
            at = len(self.nodes)
            up = [n[0] for _, n, _ in self.open if n is not None]  # the listed elements around it
            node = [at, at, self.length, self.length, tag, classes, found, False, None, up]
            self.nodes.append(node)
        self.open.append((tag, node, [0, False]))
        self.hidden += tag in HIDDEN_TEXT
        if tag in VOID or closed:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, closed=True)

    def _close(self) -> None:
        tag, node, (children, is_text) = self.open.pop()
        self.hidden -= tag in HIDDEN_TEXT
        lone = children == 1 and is_text
        if node is not None:
            node[1], node[3], node[7] = len(self.nodes) - 1, self.length, lone
        if self.open and lone:
            # An only child with a lone text makes its parent's text lone as well.
            self.open[-1][2][1] = True

    def handle_endtag(self, tag):
        self._flush()
        if tag in VOID or not any(t == tag for t, _, _ in self.open):
            return
        while self.open[-1][0] != tag:
            self._close()
        self._close()

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        base, digits = (16, name[1:]) if name[:1] in "xX" else (10, name)
        try:
            code = int(digits, base)
            char = bytes([code]).decode("cp1252") if 0x80 <= code < 0xA0 else chr(code)
        except (ValueError, OverflowError):
            char = "\ufffd"
        self.pending.append(char)

    def handle_comment(self, data):
        self._flush()
        if self.open:
            self._count_child(text=True)

    def finish(self) -> tuple[str, list[list]]:
        self.close()
        self._flush()
        while self.open:
            self._close()
        return "".join(self.text), self.nodes


def _read_page(markup: str, listed: frozenset[str]) -> tuple[str, list[list]]:
    reader = _PageReader(listed)
    reader.feed(markup)
    return reader.finish()


def _nodes_to_arrow(pages: list[list[list] | None]) -> pa.Array:
    offsets, flat = [0], []
    for nodes in pages:
        flat.extend(nodes or ())
        offsets.append(len(flat))
    columns = list(zip(*flat)) if flat else [()] * 10
    ints = [pa.array(column, pa.int32()) for column in columns[:4]]
    class_ends, classes = [0], []
    for names in columns[5]:
        classes.extend(names)
        class_ends.append(len(classes))
    up_ends, up = [0], []
    for around in columns[9]:
        up.extend(around)
        up_ends.append(len(up))
    attr_ends, keys, values = [0], [], []
    for found in columns[6]:
        keys.extend(found.keys())
        values.extend(found.values())
        attr_ends.append(len(keys))
    fields = ints + [
        pa.array(columns[4], pa.string()),
        pa.ListArray.from_arrays(pa.array(class_ends, pa.int32()), pa.array(classes, pa.string())),
        pa.MapArray.from_arrays(
            pa.array(attr_ends, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string())
        ),
        pa.array(columns[7], pa.bool_()),
        pa.array(columns[8], pa.string()),
        pa.ListArray.from_arrays(pa.array(up_ends, pa.int32()), pa.array(up, pa.int32())),
    ]
    names = ["pre", "post", "start", "stop", "tag", "classes", "attrs", "lone_text", "script", "up"]
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names)
    )


def _pieces(markup: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of runs of pages of bounded size; a page that is larger is a run of its own."""
    start = size = 0
    for at, page in enumerate(markup):
        n = page.as_buffer().size if page.is_valid else 0
        if at > start and (at - start == PIECE_PAGES or size + n > PIECE_BYTES):
            yield start, at - start
            start, size = at, 0
        size += n
    if start < len(markup):
        yield start, len(markup) - start


def _read_piece(markup: pa.Array, listed: frozenset[str]) -> pa.Array:
    texts, pages = [], []
    for page in markup:
        text, nodes = _read_page(page.as_py() or "", listed)
        texts.append(text)
        pages.append(nodes)
    return pa.StructArray.from_arrays(
        [pa.array(texts, pa.string()), _nodes_to_arrow(pages)], ["text", "nodes"]
    )


def read_pages(markup: pa.Array, listed: frozenset[str] = NAMED_TAGS) -> pa.Array:
    pieces = [_read_piece(markup.slice(at, n), listed) for at, n in _pieces(markup)]
    return pa.concat_arrays(pieces) if pieces else _read_piece(markup, listed)


def parse_page(markup: Column, tags: Iterable[str] = ()) -> Column:
    """``struct<text, nodes>`` of a page. Filter rows first: this runs in Python workers.

    ``tags`` are those that selectors name beside ``NAMED_TAGS``. Spark wants the whole answer to
    a batch at once, so many pages are better given to ``parse_pages``.
    """
    listed = NAMED_TAGS | frozenset(tags)

    def read(pages: pa.Array) -> pa.Array:
        return read_pages(pages, listed)

    return F.arrow_udf(read, PAGE_TYPE)(markup)


def parse_pages(pages: DataFrame, tags: Iterable[str] = ()) -> DataFrame:
    """``pages`` with ``doc``, as ``parse_page`` has it, in place of ``html``.

    Documents leave the worker a few pages at a time, so it never holds those of a whole batch,
    however many pages Spark puts into one.
    """
    listed = NAMED_TAGS | frozenset(tags)
    kept = [f for f in pages.schema if f.name not in ("html", "doc")]
    names = [f.name for f in kept]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in _pieces(batch.column("html")):
                piece = batch.slice(at, n)
                doc = _read_piece(piece.column("html"), listed)
                yield pa.RecordBatch.from_arrays([*map(piece.column, names), doc], [*names, "doc"])

    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in kept),
                           T.StructField("doc", T.DataType.fromDDL(PAGE_TYPE))])
    return pages.select(*names, "html").mapInArrow(read, schema)
