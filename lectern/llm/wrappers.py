"""Main text of web pages by wrapper induction.

Pages of one host are aligned by simple tree matching. Text nodes that stay the same
wherever they are aligned belong to the host's template; the slots that vary hold
content. A page's text is what its slots hold, outside of the parts whose role is
known not to be the article."""

from __future__ import annotations

import html
import json
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.tables import settled, written
from lectern.operators.sizing import SALTS, fits_broadcast

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp".split())
# a start tag of these ends an open element of the same group, inside the nearest container
SIBLINGS = {
    "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option",
    "tbody": "tbody thead tfoot tr td th", "tfoot": "tbody thead tfoot tr td th",
}
CONTAINERS = frozenset("ul ol menu dl table select article section main body div".split())

# parts of a page that are not its article, by element, by role and by a word of class or id; inside an article by a whole class or id
NOT_CONTENT = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input label menu nav noscript object script search "
    "select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification pagination popup "
    "promo promoted related remarks reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar topbar widget".split()
)
# of these one word of a class is enough inside an article as well, where the element is no heading and no paragraph
CLEAR = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies disqus footer gdpr nav navbar "
    "navigation newsletter popup promo promoted remarks sidebar signup sponsor sponsored".split()
)
WHOLE = frozenset(("article", "main"))
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_MARK = re.compile(r"[a-z]+")
_SPACES = re.compile(r"\s+")


class Node:
    """A block with its blocks and texts in order. ``off`` marks what is no article."""

    __slots__ = ("label", "tag", "off", "parts", "shape")

    def __init__(self, label: str, tag: str, off: bool):
        self.label, self.tag, self.off, self.parts, self.shape = label, tag, off, [], 0


def _described(tag: str, attributes: str, inside_article: bool) -> tuple[str, bool]:
    """(label for the alignment, whether the element is no content)."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):  # a value is passed over as a whole; of repeated names the first counts
        found.setdefault(m[1].lower(), html.unescape(next((v for v in m.groups()[1:] if v is not None), "")))
    tokens = found.get("class", "").lower().split()
    kind = " ".join(sorted(tokens))
    own = found.get("id", "").lower()
    # ids of headings and of parts of an article are often words of their text
    marks = {*tokens, own.strip()} if inside_article or tag in TEXTUAL else set(_MARK.findall(" ".join((*tokens, own))))
    off = tag in NOT_CONTENT or "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true"
    off = off or found.get("role", "").lower() in ROLES
    off = off or (tag not in WHOLE and tag not in ("html", "body") and not marks.isdisjoint(MARKS))
    clear = inside_article and tag not in TEXTUAL and tag not in WHOLE
    off = off or (clear and not CLEAR.isdisjoint(_MARK.findall(" ".join(tokens))))
    off = off or (tag == "header" and not inside_article)
    return f"{tag}.{kind}" if kind else tag, off


def parse(page: str) -> Node:
    """The block tree of a page, as forgiving as browsers are: unclosed paragraphs, items
    and cells end where the next one starts, stray end tags are passed over."""
    root = Node("", "", False)
    stack = [root]  # blocks, and other elements that are left out with all they hold
    opened: Counter[str] = Counter()  # tags on the stack, so that asking for one does not walk it
    inline: list[str] = []
    at = 0

    def end_text() -> None:
        text = _SPACES.sub(" ", html.unescape("".join(inline))).strip()
        inline.clear()
        if text:
            stack[-1].parts.append(text)

    def cut(depth: int) -> None:
        end_text()
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def close(names: str, walls: frozenset = CONTAINERS) -> None:
        if not any(opened[name] for name in names.split()):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names.split():
                cut(depth)
                return
            if stack[depth].tag in walls:
                return

    for match in _TAG.finditer(page, 0, page.rfind(">") + 1):  # beyond the last end of a tag there is none
        if match.start() < at:
            continue
        inline.append(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if opened[tag] and (tag in BLOCKS or tag in NOT_CONTENT):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                cut(depth)
            continue
        if tag == "br":
            inline.append(" ")
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                close("p", frozenset())
                end_text()
            continue
        inside_article = any(opened[name] for name in WHOLE)
        if tag not in BLOCKS and tag not in NOT_CONTENT:
            label, off = _described(tag, match[3], inside_article) if match[3].strip() else (tag, False)
            if off:  # an inline advert or notice goes up to its own end, if it has one
                at = _end_of(page, at, tag)
            continue
        if tag in BLOCKS:
            close("p", frozenset(("td", "th", "li", "article", "body", "div", "section", "aside", "nav", "footer", "header", "form")))
        if tag in SIBLINGS:
            close(SIBLINGS[tag], CONTAINERS - {"div"})
        label, off = _described(tag, match[3], inside_article)
        if match[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        end_text()
        node = Node(label, tag, off)
        stack[-1].parts.append(node)
        stack.append(node)
        opened[tag] += 1
    inline.append(page[at:])
    end_text()
    return root


def _end_of(page: str, at: int, tag: str) -> int:
    """After the end tag of an element whose start tag ended at ``at``, past equal elements inside; ``at`` if there is none."""
    depth = 1
    for match in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I).finditer(page, at):
        depth += -1 if match[1] else 1
        if not depth:
            return match.end()
    return at


def _below(path: int, label: str) -> int:
    """Paths are chained hashes of labels, as deep nesting makes names long."""
    return xxhash.xxh3_64_intdigest(label, path)


def _text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


def leaves(root: Node) -> Iterator[tuple[int, str, bool, bool]]:
    """(path, text, no content, inside an article) of the texts, in page order."""
    todo = [(root, 0, False, False)]
    while todo:
        now, path, off, whole = todo.pop()
        if isinstance(now, str):
            yield path, now, off, whole
            continue
        off, whole, path = off or now.off, whole or now.tag in WHOLE, _below(path, now.label)
        todo.extend((part, path, off, whole) for part in reversed(now.parts))


def skeleton(root: Node) -> bytes:
    """Labels and hashes of texts: all that an alignment looks at, in little space."""
    flat, todo = [], [root]
    while todo:
        now = todo.pop()
        if now is None:
            flat.append(None)
        elif isinstance(now, str):
            flat.append(_text_hash(now))
        else:
            flat.append(now.label)
            todo.append(None)
            todo.extend(reversed(now.parts))
    return zlib.compress(json.dumps(flat, separators=(",", ":")).encode())


class Aligner:
    """Simple tree matching (Yang, 1991) of ordered trees: the most pairs of nodes with
    equal labels that keep order and parents. Texts are leaves of one label. Trees with the same
    labels have one shape, and sizes are kept per pair of shapes."""

    def __init__(self):
        self.shapes: dict = {}
        self.sizes: dict[tuple[int, int], int] = {}

    def tree(self, packed: bytes) -> Node:
        top = Node("", "", False)
        stack = [top]
        for item in json.loads(zlib.decompress(packed)):
            if item is None:
                node = stack.pop()
                own = (node.label, *(p.shape if isinstance(p, Node) else 0 for p in node.parts))
                node.shape = self.shapes.setdefault(own, len(self.shapes) + 1)
            elif isinstance(item, str):
                node = Node(item, "", False)
                stack[-1].parts.append(node)
                stack.append(node)
            else:
                stack[-1].parts.append(item)
        return top.parts[0]

    def size(self, a: Node | int, b: Node | int) -> int:
        if isinstance(a, int) or isinstance(b, int):
            return int(isinstance(a, int) and isinstance(b, int))
        if a.label != b.label:
            return 0
        key = (a.shape, b.shape)
        if key not in self.sizes:
            self.sizes[key] = self._table(a, b)[-1][-1] + 1
        return self.sizes[key]

    def _table(self, a: Node, b: Node) -> list[list[int]]:
        rows = [[0] * (len(b.parts) + 1)]
        for x in a.parts:
            last, row = rows[-1], [0]
            for j, y in enumerate(b.parts):
                row.append(max(row[-1], last[j + 1], last[j] + self.size(x, y)))
            rows.append(row)
        return rows

    def texts(self, a: Node, b: Node) -> Iterator[tuple[int, int, int]]:
        """(path, text in a, text in b) of the texts that are aligned."""
        todo = [(a, b, 0)]
        while todo:
            x, y, path = todo.pop()
            if isinstance(x, int):
                yield path, x, y
                continue
            path = _below(path, x.label)
            table = self._table(x, y)
            i, j = len(x.parts), len(y.parts)
            while i and j:
                here = self.size(x.parts[i - 1], y.parts[j - 1])
                if here and table[i][j] == table[i - 1][j - 1] + here:
                    i, j = i - 1, j - 1
                    todo.append((x.parts[i], y.parts[j], path))
                elif table[i][j] == table[i - 1][j]:
                    i -= 1
                else:
                    j -= 1


def _name(path: int, text: int) -> int:
    return xxhash.xxh3_64_intdigest(text.to_bytes(8, "little"), path) - (1 << 63)


def _content(found: list[tuple[int, str, bool, bool]]) -> list[tuple[int, str, bool]]:
    """(path, text, inside an article) of the texts that count: those of the article, or all where there is none."""
    inside = any(whole and not off for _, _, off, whole in found)
    return [(path, text, whole) for path, text, off, whole in found if not off and (whole or not inside)]


def _outline(page: str) -> tuple[int, list[int], list[int], list[int], bytes | None]:
    """Hash of a page's content, names of the texts in it, their hashes without a path, their lengths inside an
    article (0 outside), and the skeleton if there are any."""
    root = parse(page)
    content = _content(list(leaves(root)))
    slots = xxhash.xxh3_64_intdigest("\0".join(text for _, text, _ in content)) - (1 << 63)
    found = {}
    for path, text, whole in content:
        own = _text_hash(text)
        found[_name(path, own)] = (own - (1 << 63), len(text) if whole else 0)
    names = sorted(found)
    return slots, names, [found[n][0] for n in names], [found[n][1] for n in names], skeleton(root) if names else None


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            columns = zip(*(_outline(page.as_py() or "") for page in part.column(1)))
            kinds = [pa.int64(), longs, longs, longs, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, kind) for c, kind in zip(columns, kinds))],
                names=["host", "slots", "names", "texts", "lengths", "skeleton"],
            )


def _different(articles: list[dict[int, int]]) -> list[int]:
    """Places of articles that are clearly different: less than half of the shorter one, in characters, is in both. Each
    maps the hashes of its texts to their lengths; empty ones are left out."""
    chosen: list[int] = []
    for i, own in enumerate(articles):
        total = sum(own.values())
        if total and all(
            2 * sum(own[t] for t in own.keys() & articles[j].keys()) < min(total, sum(articles[j].values())) for j in chosen
        ):
            chosen.append(i)
    return chosen


def _align(group: pa.Table, least_pages: int) -> pa.Table:
    """How many pages of a group hold each name, and whether it was aligned with itself. Every
    name that two pages hold is looked for in alignments of its first page with the others that hold it. Names inside an
    article are counted over clearly different articles, if the group has more than ``least_pages`` of them."""
    sys.setrecursionlimit(1_000_000)  # alignments are as deep as the pages
    aligner = Aligner()
    columns = [group.column(c).to_pylist() for c in ("skeleton", "names", "texts", "lengths")]
    pages = sorted(zip(*columns), key=lambda p: p[0] or b"")
    trees = [packed and aligner.tree(packed) for packed, *_ in pages]
    articles = [{t: n for t, n in zip(texts, lengths) if n} for _, _, texts, lengths in pages]
    chosen = set(_different(articles))
    if len(chosen) <= least_pages:
        chosen = set()
    holders: dict[int, list[int]] = {}
    inside: set[int] = set()
    for i, (_, names, _, lengths) in enumerate(pages):
        for name, n in zip(names, lengths):
            if n:
                inside.add(name)
            if not n or i in chosen:
                holders.setdefault(name, []).append(i)
    aligned: set[int] = set()
    done: set[tuple[int, int]] = set()
    for name, (first, *others) in holders.items():
        for other in others:
            if name in aligned:
                break
            if (first, other) not in done:
                done.add((first, other))
                aligned.update(_name(path, x) for path, x, y in aligner.texts(trees[first], trees[other]) if x == y)
    host = group.column("host")[0].as_py()
    return pa.table(
        {
            "host": pa.array([host] * (len(holders) + 2), pa.string()),
            "name": pa.array([*holders, None, None], pa.int64()),
            "inside": pa.array([*(n in inside for n in holders), False, True], pa.bool_()),
            "pages": pa.array([*map(len, holders.values()), len(pages), len(chosen)], pa.int64()),
            "aligned": pa.array([*(n in aligned for n in holders), False, False], pa.bool_()),
        }
    )


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def induce(
    pages: DataFrame, group_size: int = 32, least_pages: int = 5, share: float = 0.6, url: str = "url", page: str = "html"
) -> DataFrame:
    """(host, template): per host the names of constant texts, each a hash of its path
    in the tree and the text itself.

    Pages are reduced to labels and text hashes where they are read, and only that moves.
    All different pages of a host take part, in groups of about ``group_size`` by a hash,
    so that a host with a third of all pages is many small groups; their counts are
    added up per host. A text is constant if ``share`` of the host's pages hold it at one path and it
    is aligned with itself; a host needs more than ``least_pages`` pages. Pages of equal content count once, whatever
    their menus, adverts and comments, since copies of a page would make its article a template.

    A text inside an ``article`` or ``main`` is held to the same share, but of the host's clearly different articles: of near
    copies in a group, whose equal texts make half of their characters, one counts, and a group counts only if more than ``least_pages``
    stay. So what a host puts into each article goes, and the paragraphs of an article that has many near copies stay."""
    own = pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("html"))
    outlines = own.mapInArrow(
        _skeletons, "host string, slots long, names array<long>, texts array<long>, lengths array<long>, skeleton binary"
    )
    parts = ["names", "texts", "lengths", "skeleton"]
    trees = written(outlines.groupBy("host", "slots").agg(F.min(F.struct(*parts)).alias("page")), "outlines")
    sizes = trees.groupBy("host").agg(F.ceil(F.count("page") / group_size).alias("groups"))
    sizes = F.broadcast(sizes) if fits_broadcast(sizes) else sizes
    salted = trees.join(sizes, "host").withColumn("salt", F.pmod(F.xxhash64("slots"), "groups"))
    counted = salted.select("host", "salt", *(f"page.{c}" for c in parts)).groupBy("host", "salt").applyInArrow(
        lambda group: _align(group, least_pages), "host string, name long, inside boolean, pages long, aligned boolean"
    )
    summed = counted.groupBy("host", "name", "inside").agg(F.sum("pages").alias("pages"), F.bool_or("aligned").alias("aligned"))
    # only what could be constant is kept; it is read twice, and each group is aligned once
    summed = written(summed.filter("name is null or aligned"), "counts")
    of_host = summed.filter("name is null").select("host", "inside", F.col("pages").alias("all"))
    constant = summed.filter("name is not null").join(of_host, ["host", "inside"]).filter(
        (F.col("all") > least_pages) & (F.col("pages") >= F.col("all") * share)
    )
    return constant.groupBy("host").agg(F.collect_list("name").alias("template"))


def _texts(template: set[int], page: str) -> str:
    content = _content(list(leaves(parse(page))))
    return "\n\n".join(text for path, text, _ in content if _name(path, _text_hash(text)) not in template)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts = [
                _texts(set(names.as_py() or ()), page.as_py() or "")
                for page, names in zip(part.column("html"), part.column("template"))
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )


def extract(
    pages: DataFrame, templates: DataFrame | None = None, key: str = "page_id", url: str = "url", page: str = "html", **how
) -> DataFrame:
    """(page_id, url, text) of every page: its blocks in page order, parted by two line
    feeds; character references decoded, white space in a block made one space.

    Where a page has an ``article`` or ``main``, only what is inside counts. Left out are
    menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
    comments, by element, role or class, and the texts of the host's template, inside an article too. A null or
    empty page, and one that is all template, has an empty text; repeated rows are pages of their own, and a long page is read
    whole, once. Templates that are measured to
    be small travel to the pages, which then do not move. ``templates`` may be stored and given again; by default they are induced from ``pages``."""
    if templates is None:
        templates = settled(lambda: induce(pages, url=url, page=page, **how), "templates")
    own = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"), host_of(F.col(url)).alias("host")
    )
    templates = templates.select("host", "template")
    if fits_broadcast(templates):
        joined = own.join(F.broadcast(templates), "host", "left")
    else:  # a host with a large share of the pages is dealt out by a salt
        salted = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int"))
        copied = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copied, ["host", "salt"], "left")
    return joined.select("page_id", "url", "html", "template").mapInArrow(_extract, "page_id long, url string, text string")
