"""Main text of web pages by wrappers, union-free regular expressions of their tokens.

Pages of one host come from few templates. A page is a stream of tokens: structural tags
and blocks of text. Inline markup is no structure, and tags that HTML lets authors leave
out are put back. The wrapper of a host starts as one page and is aligned with the others:

* neighbouring elements or squares of elements that repeat become a repeated group;
* text that differs between pages, or between the turns of a group, becomes a text slot,
  text that never differs stays a constant of the template;
* elements that only one side has become optional groups.

The wrapper tells a page's texts apart. Text in an ``article`` (else in a ``main``, else in
an element whose class or id says so) is the main text, except for the menus, sidebars,
notices, adverts, forms, comments and so on inside it. Where a page has no such element, its
main text is what the wrapper has slots for, outside of those parts: constants of three or
more pages, and blocks that are nothing but links, are left out unless all is.

Every page is reduced in its task to a structure, a short string with a place per text slot.
Only distinct structures of a host go on, each with a hash per constant text. Wrappers are
formed from groups of ``FAN`` structures of a host, then from wrappers, in rounds, each
group in an order given by its members, so the result is the same however pages are dealt
and no host, be it a third of all pages, is ever formed in one group. Pages meet their
structure's mask, a row per host and structure, in one join, whose smaller side Spark
broadcasts only below the session's threshold.

Null and empty pages have an empty text, as have pages without a text. A null url and one
without a host count as one host. Repeated rows are pages of their own. An empty table gives
no rows. Other input columns pass through; those named like a result are replaced.
"""

from __future__ import annotations

import html as references
import json
import re
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from lendmart.llm.common import table, unpacked
from lendmart.sources.snapshots import stage

FAN = 500        # structures or wrappers aligned at once
SQUARE = 8       # elements of a repeated group that are not of one kind
DEPTH = 100      # nested elements; deeper ones only divide blocks, unless they are left out
LONG = 1_000_000  # pairs of children up to which alignments are longest
CONSTANT = 3     # pages that must agree before a text counts as template
HELD = 20_000    # structures that a task merges before it passes them on

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q "
    "s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp".split())
#: An opening tag of the first kind ends open elements of the second, up to the third.
_BLOCKS = ("address article aside blockquote center details dialog dir div dl fieldset "
           "figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section "
           "table ul").split()
ENDS = {**{tag: (("p",), ("button", "td", "th")) for tag in _BLOCKS},
        "li": (("li", "p"), ("ul", "ol", "menu")),
        **{tag: (("dt", "dd", "p"), ("dl",)) for tag in ("dt", "dd")},
        **{tag: (("td", "th", "p"), ("tr", "table")) for tag in ("td", "th")},
        "tr": (("tr", "td", "th", "p"), ("table",)),
        "option": (("option",), ("select",))}
LEFT_OUT = frozenset(
    "head nav header footer aside form menu button select datalist svg canvas object audio "
    "video map template dialog".split())
#: Words of a class, an id or a role.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs "
    "comment comments comentarios consent cookie cookies copyright disqus footer gdpr header "
    "login menu menubar modal nav navbar navigation newsletter notice notices notification "
    "outbrain pager pagination paywall popup promo promotion recommended related replies "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "taboola toolbar widget widgets".split())
HEADINGS = frozenset({"header"})  # a heading inside the main part belongs to it
FOREIGN = frozenset("ad ads advert advertisement comment comments promo related replies "
                    "sponsored".split())  # articles that are not the page's own
CONTENT = frozenset("article content entry post story".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=\s|/|$|=)|aria-hidden\s*=\s*[\"']?true|"
                     r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_END = {tag: re.compile(f"</{tag}[^>]*>", re.I | re.A) for tag in RAW}


class Element:
    """An element or a group: its label, its children (elements, and texts as ``Text``),
    whether it repeats, and whether pages may lack it."""

    __slots__ = ("label", "children", "plus", "optional")

    def __init__(self, label, children=(), plus=False, optional=False):
        self.label, self.children = label, list(children)
        self.plus, self.optional = plus, optional


class Text:
    """A block of text: a hash while constant, None as a slot; ``n`` is how many pages have
    it, ``blocks`` are those of one page."""

    __slots__ = ("label", "key", "n", "blocks", "optional")

    def __init__(self, label, key=None, n=1, blocks=(), optional=False):
        self.label, self.key, self.n, self.blocks = label, key, n, list(blocks)
        self.optional = optional


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """Tag with its class, id and role, numbers generalised; whether it is left out."""
    if not attributes:
        return tag, tag in LEFT_OUT
    words, names = set(), []
    if "=" in attributes:
        for name, value in _NAMES.findall(attributes):
            value = value.strip("\"'").lower()
            names.append(re.sub("[0-9]+", "0", value))
            words.update(_WORD.findall(value))
    label = " ".join([tag, *sorted(names)])
    if tag in ("html", "body"):
        return tag, False
    if tag in ("article", "main"):
        return label, bool(words & FOREIGN)
    hidden = _HIDDEN.search(attributes) is not None
    return label, hidden or tag in LEFT_OUT or bool(words & BOILERPLATE)


def parse(page: str) -> tuple[Element, list[str]]:
    """The tree of a page's structural elements, and its blocks of text in page order."""
    root, blocks = Element("page"), []
    stack: list[tuple[str, Element | None]] = [("", root)]  # None: inline or too deep
    pieces: list[str] = []
    links, all_links, at, size = 0, True, 0, len(page)

    def flush():
        nonlocal all_links
        if not pieces:
            return
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            home().children.append(Text("L" if all_links else "T",
                                      xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 1,
                                      1, [len(blocks)]))
            blocks.append(text)
        all_links = True

    def home():
        node = stack[-1][1]
        return node if node is not None else next(x for _, x in reversed(stack) if x is not None)

    def say(raw):
        nonlocal all_links
        pieces.append(references.unescape(raw) if "&" in raw else raw)
        if not links and not raw.isspace():
            all_links = False

    def close(depth):
        nonlocal links
        flush()
        if links:
            links -= sum(tag == "a" for tag, _ in stack[depth:])
        del stack[depth:]

    while at < size:
        cut = page.find("<", at)
        if cut < 0:
            say(page[at:])
            break
        if cut > at:
            say(page[at:cut])
        if page.startswith("<!--", cut):
            end = page.find("-->", cut + 4)
            at = size if end < 0 else end + 3
            continue
        found = _TAG.match(page, cut) or _PLAIN_TAG.match(page, cut)
        if found is None:
            if page[cut + 1:cut + 2] in ("!", "?") and page[cut + 1:cut + 2]:
                end = page.find(">", cut)
                at = size if end < 0 else end + 1
            elif page[cut + 1:cut + 2].isalpha() or page.startswith("</", cut):
                at = size  # a tag that the page's end cuts off
            else:
                say("<")
                at = cut + 1
            continue
        ending, tag, attributes = found.group(1), found.group(2).lower(), found.group(3)
        at = found.end()
        if tag in RAW:
            if not ending:
                end = _END[tag].search(page, at)
                at = end.end() if end else size
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "img", "embed", "input"):
                pieces.append(" ")
            continue
        if ending:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if tag in INLINE and stack[depth][1] is None:
                        links -= tag == "a"
                        del stack[depth]
                    else:
                        close(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if tag in ENDS:
            ended, limits = ENDS[tag]
            lowest = 0
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in ended:
                    lowest = depth
                elif stack[depth][0] in limits:
                    break
            if lowest:
                close(lowest)
        label, left_out = _label(tag, attributes)
        if tag in INLINE and not left_out:
            links += tag == "a"
            stack.append((tag, None))
            continue
        flush()
        links += tag == "a"
        if len(stack) > DEPTH and not left_out:
            stack.append((tag, None))
            continue
        node = Element(f"-{label}" if left_out else label)
        home().children.append(node)
        stack.append((tag, node))
    flush()
    return root, blocks


def _pair(a, b):
    """Alignment of two elements or texts with the same label."""
    optional = a.optional or b.optional
    if isinstance(a, Text):
        return Text(a.label, a.key if a.key == b.key else None, a.n + b.n, a.blocks + b.blocks,
                    optional)
    return Element(a.label, align(a.children, b.children), a.plus or b.plus, optional)


def matches(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two lists' labels; of very long lists, of
    their longest common runs."""
    x, y = [n.label for n in a], [n.label for n in b]
    if x == y:
        return [(i, i) for i in range(len(x))]
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    m, n = x[head:len(x) - tail], y[head:len(y) - tail]
    if len(m) * len(n) > LONG:
        found = SequenceMatcher(None, m, n, autojunk=False).get_matching_blocks()
        return [*[(i, i) for i in range(head)],
                *[(head + a + k, head + b + k) for a, b, size in found for k in range(size)],
                *[(len(x) - k, len(y) - k) for k in range(tail, 0, -1)]]
    best = [[0] * (len(n) + 1) for _ in range(len(m) + 1)]
    for i in range(len(m) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(n) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if m[i] == n[j] else max(below[j], row[j + 1])
    out = [(i, i) for i in range(head)]
    i = j = 0
    while i < len(m) and j < len(n):
        if m[i] == n[j]:
            out.append((head + i, head + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out + [(len(x) - k, len(y) - k) for k in range(tail, 0, -1)]


def align(a: list, b: list) -> list:
    """One list of children that both are instances of."""
    out, i, j = [], 0, 0
    for p, q in [*matches(a, b), (len(a), len(b))]:
        for node in [*a[i:p], *b[j:q]]:
            node.optional = True
            out.append(node)
        if p < len(a):
            out.append(_pair(a[p], b[q]))
        i, j = p + 1, q + 1
    return out


def fold(node: Element) -> Element:
    """Repeats among the children as repeated groups, from the leaves upward."""
    runs: list = []
    for child in node.children:
        if isinstance(child, Element):
            fold(child)
        if runs and runs[-1].label == child.label and isinstance(child, Element):
            runs[-1] = _pair(runs[-1], child)
            runs[-1].plus = True
        else:
            runs.append(child)
    out, i = [], 0
    labels = [x.label for x in runs]
    while i < len(runs):
        for length in range(2, min(SQUARE, (len(runs) - i) // 2) + 1):
            square = labels[i:i + length]
            end = i + length
            while labels[end:end + length] == square:
                end += length
            if end > i + length and not all(isinstance(x, Text) for x in runs[i:i + length]):
                group = runs[i:i + length]
                for k in range(i + length, end, length):
                    group = [_pair(x, y) for x, y in zip(group, runs[k:k + length])]
                out.append(Element(f"({'|'.join(square)})", group, True))
                i = end
                break
        else:
            out.append(runs[i])
            i += 1
    node.children = out
    return node


def dump(node: Element) -> tuple[str, list[int | None]]:
    """The structure as a string, and the texts' keys in order."""
    keys: list[int | None] = []

    def plain(x):
        if isinstance(x, Text):
            keys.append(x.key)
            return x.label + "?" * x.optional
        return [x.label, ("+" if x.plus else "") + "?" * x.optional, *map(plain, x.children)]

    return json.dumps(plain(node), ensure_ascii=False, separators=(",", ":")), keys


def load(structure: str, keys: list[int | None], counts: list[int]) -> Element:
    left = iter(zip(keys, counts))

    def node(x):
        if isinstance(x, str):
            return Text(x[0], *next(left), (), x.endswith("?"))
        return Element(x[0], [node(c) for c in x[2:]], "+" in x[1], "?" in x[1])

    return node(json.loads(structure))


def texts(node: Element) -> list[Text]:
    out: list[Text] = []
    for child in node.children:
        out.extend([child] if isinstance(child, Text) else texts(child))
    return out


def _regions(label: str, tag: str) -> tuple[bool, bool, bool]:
    words = set(_WORD.findall(label))
    return tag == "article", tag == "main" or "main" in words, bool(words & CONTENT)


def mask(page: Element, wrapper: Element) -> str:
    """For each text of a page's structure, whether it is main text."""
    rows: list[tuple[bool, list[bool], bool, bool]] = []  # left out, regions, link, constant

    def visit(children, others, left_out, regions):
        place = dict(matches(children, others)) if others else {}
        for i, child in enumerate(children):
            other = others[place[i]] if i in place else None
            if isinstance(child, Text):
                constant = other is not None and other.key is not None and other.n >= CONSTANT
                rows.append((left_out, list(regions), child.label == "L", constant))
                continue
            outside, name = child.label.startswith("-"), child.label.lstrip("-")
            tag = name.split(" ", 1)[0]
            if outside and any(regions) and tag not in LEFT_OUT - HEADINGS:
                # a heading of the main part, by its tag or only by its class
                words = set(_WORD.findall(name))
                outside = bool(words & BOILERPLATE - HEADINGS) or not words & HEADINGS
            group = name.startswith("(")
            now = regions if group else [a or b for a, b in zip(regions, _regions(name, tag))]
            visit(child.children, other.children if other is not None else [],
                  left_out or outside, regions if outside else now)

    visit(page.children, wrapper.children, False, [False] * 3)
    open_ = [not r[0] for r in rows]
    for k in range(3):
        kept = [o and r[1][k] for o, r in zip(open_, rows)]
        if any(kept):
            break
    else:
        plain = [o and not r[2] for o, r in zip(open_, rows)]
        kept = [p and not r[3] for p, r in zip(plain, rows)]
        kept = next((x for x in (kept, plain) if any(x)), open_)
    return "".join("1" if x else "0" for x in kept)


def _structure(page: str | None) -> tuple[Element, str, list, int, list[str]]:
    root, blocks = parse(page or "")
    fold(root)
    structure, keys = dump(root)
    return root, structure, keys, xxhash.xxh3_64_intdigest(
        structure.encode("utf-8", "surrogatepass")) >> 1, blocks


STRUCTURES = "host string, sid long, structure string, keys array<long>, counts array<long>"
_KINDS = pa.schema([("host", pa.string()), ("sid", pa.int64()), ("structure", pa.string()),
                    ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def _same(a: list, b: list) -> list:
    return [x if x == y else None for x, y in zip(a, b)]


def _structures(batches):
    """Distinct structures of each host among a task's pages, constants by their hash."""
    held: dict[tuple, list] = {}

    def emit():
        yield pa.RecordBatch.from_pylist(
            [dict(zip(_KINDS.names, (*key, *value))) for key, value in held.items()], _KINDS)
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            for host, page in zip(*(c.to_pylist() for c in batch.slice(at, 200).columns)):
                _, structure, keys, sid, _ = _structure(page)
                own = held.setdefault((host, sid), [structure, keys, [0] * len(keys)])
                own[1], own[2] = _same(own[1], keys), [n + 1 for n in own[2]]
            if len(held) > HELD:
                yield from emit()
    yield from emit()


def _distinct(group: pa.Table) -> pa.Table:
    """One row of a structure's rows from different tasks."""
    rows = group.to_pylist()
    first = dict(rows[0])
    for row in rows[1:]:
        first["keys"] = _same(first["keys"], row["keys"])
        first["counts"] = [a + b for a, b in zip(first["counts"], row["counts"])]
    return pa.Table.from_pylist([first], _KINDS)


def _wrapper(group: pa.Table) -> pa.Table:
    """The wrapper of a group's structures or wrappers, in the order of their hashes."""
    rows = sorted(group.to_pylist(), key=lambda r: (r["sid"], r["structure"]))
    trees = [load(r["structure"], r["keys"], r["counts"]) for r in rows]
    tree = trees[0]
    for other in trees[1:]:
        tree = Element(tree.label, align(tree.children, other.children))
    structure, keys = dump(tree)
    return pa.Table.from_pylist([{
        "host": rows[0]["host"], "sid": rows[0]["sid"], "structure": structure, "keys": keys,
        "counts": [x.n for x in texts(tree)]}], _KINDS)


def structures(pages: DataFrame) -> DataFrame:
    """Distinct structures of each host, from columns host and html."""
    return pages.select("host", "html").mapInArrow(_structures, STRUCTURES).groupBy(
        "host", "sid").applyInArrow(_distinct, STRUCTURES)


def wrappers(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """One wrapper per host, of its distinct structures."""
    while True:
        sizes = rows.groupBy("host").agg(F.count("*").alias("n"))
        groups = F.ceil(F.col("n") / fan).cast("int")
        dealt = rows.join(sizes, "host").withColumn(
            "bucket", F.pmod(F.xxhash64("sid"), groups).cast("int"))
        rows = stage(dealt.drop("n").groupBy("host", "bucket").applyInArrow(_wrapper, STRUCTURES))
        if rows.groupBy("host").count().filter("count > 1").isEmpty():
            return rows


def _masks(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            out.append({"host": r["host"], "sid": r["sid"], "mask": mask(
                load(r["structure"], r["keys"], r["counts"]),
                load(r["wrapper"], r["constants"], r["n"]))})
        yield pa.RecordBatch.from_pylist(out, pa.schema(
            [("host", pa.string()), ("sid", pa.int64()), ("mask", pa.string())]))


def host_of(url: Column) -> Column:
    """Host of an absolute url in lower case, without user and port; else empty."""
    return F.lower(F.coalesce(F.regexp_extract(
        url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _blocks(batches):
    """Blocks of each page (last column) with their place in its structure; other columns
    pass through."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            sids, found, places = [], [], []
            for page in part.columns[-1].to_pylist():
                root, _, _, sid, blocks = _structure(page)
                place = [0] * len(blocks)
                for i, text in enumerate(texts(root)):
                    for b in text.blocks:
                        place[b] = i
                sids.append(sid)
                found.append(blocks)
                places.append(place)
            new = [pa.array(sids, pa.int64()), pa.array(found, pa.list_(pa.string())),
                   pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *new], names=[*part.schema.names[:-1], "sid", "blocks", "places"])


def extract(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The rows without ``html``, with their main ``text`` and its ``n_chars``."""
    names = [c for c in df.columns if c != html]
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                     host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    found = stage(structures(rows))
    formed = wrappers(found)
    masks = stage(found.join(formed.select(
        "host", F.col("structure").alias("wrapper"), F.col("keys").alias("constants"),
        F.col("counts").alias("n")), "host").mapInArrow(_masks, "host string, sid long, mask string"))
    schema = StructType([*rows.drop("html").schema, StructField("sid", LongType()),
                         StructField("blocks", ArrayType(StringType())),
                         StructField("places", ArrayType(IntegerType()))])
    parsed = rows.mapInArrow(_blocks, schema).join(masks, ["host", "sid"], "left")
    kept = F.filter("blocks", lambda x, i: F.substr(
        F.col("mask"), F.element_at("places", i + 1) + 1, F.lit(1)) == "1")
    text = parsed.withColumn("main", F.coalesce(F.array_join(kept, " "), F.lit("")))
    return unpacked(text, names, text=F.col("main"), n_chars=F.char_length("main").cast("long"))


def op12_wrappers(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


#: The given pages put their text into one article of h1 and p, with the references named here.
OP12_SQL = r"""
WITH bodies AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages),
plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'),
    '&quot;?', '"', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g') AS text FROM bodies),
spaced AS (
  SELECT page_id, url, coalesce(trim(regexp_replace(text, '\s+', ' ', 'g')), '') AS text
  FROM plain)
SELECT page_id, url, text, length(text) AS n_chars FROM spaced
"""
