"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: its elements, named by their paths, and its blocks of text. Over the
different pages of a host every token has an occurrence vector, its count on each page; tokens with one
vector are an equivalence class. Classes with enough tokens on enough pages are valid; ordered by place
and nested by the spans they cover they are the host's template. Text that belongs to a valid class is
part of the template and goes, inside a declared article too; what lies in its slots stays, as far as it
is in the main slot and not in a menu, header, footer, sidebar, notice, advert, form, comment section or
non-text element by its tag or a word of its class.

A class with elements of its own is a layout, whatever its share of the host's pages. A class of texts
alone may also be a passage that pages have in common, so it needs more pages, and where the page itself
declares an article around it, half of the host's. `valid_in` tells these cases apart.

The main slot of a page is its article or main element; without one, the deepest template element
that holds nearly all the text of the host's pages; without that, the body.

Vectors are never gathered: a vector is two sums of hashed (page, count) pairs, partial aggregates, so
hot hosts need no task of their own. Pages with one html count once: copies of a page prove no template.
A host's template holds only tokens on at least `LEAST_PAGES` of its
pages. Hosts, pages and tokens go by 64-bit names there; texts are not shuffled.

Defined results: a null or empty html has the empty text; a null or unreadable url belongs to the
host ""; equal rows give equal rows; unclosed elements end with their parents, stray end tags are
ignored; an empty table gives no rows; columns besides page_id, url and html are not read. A host of fewer
than `LEAST_PAGES` different pages has no template: tags and class words alone decide there.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.shared import keep, sliced

#: A class is valid on at least so many pages with so many tokens, a class of texts alone on more pages,
#: and inside a declared article on this share of the host's pages.
LEAST_PAGES = 3
LEAST_TOKENS = 2
TEXT_PAGES = 8
ARTICLE_SHARE = 0.5
#: Share of a host's text that the main slot holds.
MAIN_SHARE = 0.9

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.DOTALL
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.IGNORECASE)

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark meter nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
#: Elements that never hold main text.
OTHER = frozenset("head nav footer aside form button select dialog menu object audio video canvas datalist fieldset".split()) | RAW
MAIN = frozenset(["article", "main"])
#: Start tags that end an open element of these names first.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
#: An implied end does not reach beyond these.
SCOPES = frozenset("ul ol dl table td th article main section div body aside nav form blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of class and id that mark what is not main text, alone or with one of the endings.
HINTS = (
    "ad ads advert advertis sponsor promo promotion banner menu nav navbar navigation breadcrumb pagination pager sidebar aside "
    "widget footer header masthead topbar cookie consent gdpr notice notification alert popup modal overlay newsletter "
    "subscribe subscription signup login comment reply replies respond disqus discussion share sharing social related recommend "
    "recommendation toolbar skip"
).split()
ENDINGS = "s ed er ers ing ement ements box bar bars list block area section wrap wrapper container links buttons".split()
HINT = re.compile(rf"(?:{'|'.join(HINTS)})(?:{'|'.join(ENDINGS)})?\Z")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WORD = re.compile(r"[A-Za-z0-9]+")


def hinted(attributes: dict[str, str], inside_main: bool) -> bool:
    words = [w.lower() for k in ("class", "id") for w in WORD.findall(CAMEL.sub(" ", attributes.get(k, "")))]
    return any(HINT.match(w) and not (inside_main and w == "header") for w in words)


class Page:
    """Elements and blocks of a page.

    elements: path -> [count, first place]; blocks: (path, text, in main element, in something other, place).
    """

    def __init__(self, source: str):
        self.elements: dict[str, list[int]] = {}
        self.blocks: list[tuple[str, str, bool, bool, int]] = []
        #: Open elements: name, path, inside a main element, inside something that is not main text.
        self.open: list[tuple[str, str, bool, bool]] = []
        self.pending: list[str] = []
        self.place = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            tag = TAG.search(source, at)
            if tag is None:
                self.pending.append(source[at:])
                break
            if tag.start() > at:
                self.pending.append(source[at : tag.start()])
            at = tag.end()
            if not tag[2]:
                continue
            name = tag[2].lower()
            if tag[1]:
                self._end(name)
            else:
                self._start(name, tag[3])
                if name in RAW and not tag[3].endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(source, at)
                    at = close.end() if close else size
                    self._end(name)
        self._flush()

    def _flush(self) -> None:
        if self.pending:
            text = " ".join(entities.unescape("".join(self.pending)).split())
            self.pending = []
            if text:
                path, main, other = self.open[-1][1:] if self.open else ("", False, False)
                self.blocks.append((path, text, main, other, self.place))
                self.place += 1

    def _close(self, names: tuple[str, ...], scope: frozenset[str] = SCOPES) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in names:
                del self.open[i:]
                return
            if self.open[i][0] in scope:
                return

    def _start(self, name: str, rest: str) -> None:
        if name in INLINE:
            if name == "br":
                self.pending.append(" ")
            return
        self._flush()
        if name in VOID:
            return
        self._close(("p",))
        if name in ENDS:
            self._close(ENDS[name], frozenset(["ul", "ol", "dl", "table", "article", "main"]))
        _, path, main, other = self.open[-1] if self.open else ("", "", False, False)
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)} if rest else {}
        if name in MAIN or given.get("role") == "main":
            main = True
            other = other and name == "article" and self._commented()
            other = other or (name == "article" and hinted(given, True))
        elif name not in ("html", "body"):
            other = other or name in OTHER or (name == "header" and not main) or "hidden" in given
            other = other or given.get("role") in ROLES or hinted(given, main)
        label = "".join([path, "/", name, *(f".{c}" for c in sorted(given.get("class", "").split()))])
        self.open.append((name, label, main, other))
        seen = self.elements.setdefault(label, [0, self.place])
        seen[0] += 1
        self.place += 1

    def _commented(self) -> bool:
        """Whether an open element is a part of the page's own article that is not main text."""
        return any(main and other for _, _, main, other in self.open)

    def _end(self, name: str) -> None:
        if name in INLINE or name in VOID:
            return
        self._flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                del self.open[i:]
                return

    def has_main(self) -> bool:
        return any(main and not other for _, _, main, other, _ in self.blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


#: Kinds of tokens: an element, a block of text, one inside a declared article.
ELEMENT, TEXT, DECLARED = 0, 1, 2


def token_of(path: str, text: str | None = None, declared: bool = False) -> tuple[int, int]:
    """Name (64 bits) and kind of an element's or a block's token."""
    kind = ELEMENT if text is None else DECLARED if declared else TEXT
    label = path if text is None else f"{path}\n{text}"
    return int.from_bytes(blake2b(label.encode("utf-8", "surrogatepass"), digest_size=8, salt=bytes([kind])).digest(), "little", signed=True), kind


def above(path: str) -> list[str]:
    """The paths of the elements around a block and of its own, from the page down."""
    parts = path.split("/")
    return ["/".join(parts[: i + 1]) for i in range(len(parts))]


def valid_in(kind: int, on: int, layout: bool, pages: int) -> bool:
    """Whether a token on `on` of the host's pages is of the template; a layout is a class with elements of its own."""
    if kind == DECLARED:
        return on >= max(LEAST_PAGES, ARTICLE_SHARE * pages)
    return layout or on >= TEXT_PAGES


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every page: host, page, token with kind and depth, count, place, characters of text in the element."""
    types = {"host": pa.int64(), "page": pa.int64(), "token": pa.int64(), "kind": pa.int32(), "depth": pa.int32(),
             "times": pa.int32(), "place": pa.int32(), "chars": pa.int64()}
    for batch in sliced(batches, "html"):
        out: dict[str, list] = {c: [] for c in types}
        for number, host, source in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "html")), strict=True):
            page = Page(source or "")
            below: Counter[str] = Counter()
            texts: dict[tuple[int, int], list[int]] = defaultdict(lambda: [0, 0])
            for path, text, main, other, place in page.blocks:
                if not other:
                    below.update(dict.fromkeys(above(path), len(text)))
                    seen = texts[token_of(path, text, main)]
                    seen[0], seen[1] = seen[0] + 1, seen[1] or place
            found = [(*token_of(""), 0, 1, 0, below[""])]
            found += [(*token_of(path), path.count("/"), n, place, below[path]) for path, (n, place) in page.elements.items()]
            found += [(*token, 0, n, place, 0) for token, (n, place) in texts.items()]
            for row in found:
                for c, value in zip(out, (host, number, *row), strict=True):
                    out[c].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, types[c]) for c, v in out.items()], names=list(out))


def deduce(tokens: list[dict]) -> tuple[int | None, list[int], list[tuple[int, int, int]]]:
    """A host's main element, its template texts, and its template: (depth, class, token) in page order."""
    pages = max(t["pages"] for t in tokens)
    classes: dict[int, list[dict]] = defaultdict(list)
    for t in tokens:
        if t["pages"] >= LEAST_PAGES:
            classes[t["vector"]].append(t)
    valid = []
    for c in classes.values():
        layout = any(t["kind"] == ELEMENT for t in c)
        held = [t for t in c if valid_in(t["kind"], t["pages"], layout, pages)] if len(c) >= LEAST_TOKENS else []
        if held:
            valid.append(sorted(held, key=lambda t: (t["place"], t["token"])))
    if not valid:
        return None, [], []
    # A class nests in the classes whose spans cover its own: opened before it and not yet closed.
    spans = sorted((c[0]["place"], -max(t["place"] for t in c), i) for i, c in enumerate(valid))
    depth: dict[int, int] = {}
    opened: list[tuple[float, float]] = []
    for start, end, i in spans:
        opened = [(a, b) for a, b in opened if b >= -end]
        depth[i] = sum((a, b) != (start, -end) for a, b in opened)
        opened.append((start, -end))
    template = sorted((t["place"], depth[i], i, t["token"]) for i, c in enumerate(valid) for t in c)
    texts = [t["token"] for c in valid for t in c if t["kind"] != ELEMENT]
    everywhere = [t for c in valid for t in c if t["pages"] == pages and t["times"] == pages and t["kind"] == ELEMENT and t["depth"]]
    total = max((t["chars"] for t in tokens), default=0)
    holding = [t for t in everywhere if t["chars"] >= MAIN_SHARE * total > 0]
    main = max(holding, key=lambda t: (t["depth"], -t["place"], t["token"]))["token"] if holding else None
    return main, sorted(texts), [(d, c, token) for _, d, c, token in template]


def _templates(table: pa.Table) -> pa.Table:
    main, texts, _ = deduce(table.to_pylist())
    return pa.table(
        {
            "host": pa.array(table["host"][:1].to_pylist(), pa.int64()),
            "main": pa.array([main], pa.int64()),
            "texts": pa.array([texts], pa.list_(pa.int64())),
        }
    )


def _named(pages: DataFrame) -> DataFrame:
    """page (its content's hash), host (its name's hash) and html."""
    html = F.coalesce("html", F.lit(""))
    return pages.select(F.xxhash64(html).alias("page"), F.xxhash64(host_of(F.col("url"))).alias("host"), "html")


def templates(pages: DataFrame) -> DataFrame:
    """host, main (the main slot's element) and texts (those of the template), by names, for every host."""
    named = _named(pages)
    # Pages with one html count once. Only those that have copies are brought together for it.
    repeated = keep(named.groupBy("host", "page").count().where("count > 1").select("host", "page"), "copies")
    alone = named.join(repeated, ["host", "page"], "left_anti")
    one_each = named.join(repeated, ["host", "page"], "left_semi").dropDuplicates(["host", "page"])
    tokens = alone.union(one_each).mapInArrow(
        _tokens, "host long, page long, token long, kind int, depth int, times int, place int, chars long"
    )
    low = [F.xxhash64(F.lit(seed), "page", "times").bitwiseAND(F.lit((1 << 32) - 1)) for seed in (1, 2)]
    vectors = tokens.groupBy("host", "token", "kind", "depth").agg(
        F.xxhash64(*[F.sum(x) for x in low]).alias("vector"),
        F.count(F.lit(1)).alias("pages"),
        F.sum("times").alias("times"),
        F.avg("place").alias("place"),
        F.sum("chars").alias("chars"),
    )
    frequent = vectors.where(F.col("pages") >= LEAST_PAGES)
    return keep(frequent.groupBy("host").applyInArrow(_templates, "host long, main long, texts array<long>"), "templates")


def main_text(source: str, main: int | None, template_texts: frozenset[int]) -> str:
    page = Page(source)
    slots = [
        (path, text, declared)
        for path, text, declared, other, _ in page.blocks
        if not other and token_of(path, text, declared)[0] not in template_texts
    ]
    if page.has_main():
        kept = [text for _, text, declared in slots if declared]
    else:
        inside = [text for path, text, _ in slots if main is not None and any(token_of(p)[0] == main for p in above(path))]
        kept = inside or [text for _, text, _ in slots]
    return "\n\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, frozenset[int]] = {}
    for batch in sliced(batches, "html"):
        texts = []
        for source, main, template in zip(*(batch.column(c).to_pylist() for c in ("html", "main", "texts")), strict=True):
            key = tuple(template or ())
            if key not in known:
                known = {key: frozenset(key)}
            texts.append(main_text(source or "", main, known[key]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page."""
    hosts = templates(pages)
    named = pages.select("page_id", "url", "html", F.xxhash64(host_of(F.col("url"))).alias("host"))
    joined = named.join(hosts, "host", "left").select("page_id", "url", "html", "main", "texts")
    return joined.mapInArrow(_extract, "page_id long, url string, text string")
