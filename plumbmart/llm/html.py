"""Main text of web pages by nearest-URL page differencing.

``extract(df)`` adds the main text of every page. Pages of a host are put in the
order of their paths; a page's partner is the neighbour whose path begins alike
for longest (on a tie the earlier one), unless that page is a copy of it (nine
tenths of its lines are shared), when the other neighbour is taken. Pages of a host with
equal lines are one page in the order. Where both neighbours are copies, the partner is
looked for among the pages that begin a run of copies. The lines of the two
pages are aligned by a longest common subsequence, and lines that both have are
deleted: menus, notices and footers that a site's pages share.

Markup helps where differencing cannot see: lines in elements that are never main
text (menus, headers, footers, sidebars, forms, adverts, comments; by element,
role, class or id) are deleted whether shared or not. And as pages do repeat
passages of each other's articles, lines inside an element that marks the article
(``article``, ``main``) are kept though shared; differencing decides about the
lines outside of such elements, and about all lines of pages without one.

A line is the text of one block element: character references decoded, white
space made one space, trimmed. The lines kept are joined by an empty line.

Scale: the order of pages is found on narrow rows (URL and 64-bit line hashes) by
range partitioning, which splits a host with a third of all pages; neighbours are
taken within a part, and at the edges of parts from two rows a part. Page texts
are shuffled once, to meet the numbers of their shared lines. Neither step
gathers a host in one task. Alignment is exact, in space that is linear for long
pages.

Defined cases: a null page gives an empty text, a null URL has an empty host and
path and is ordered with those. A host's only page has no partner, so nothing is
deleted as shared. Rows that repeat are one page in the order and get the same
text. Input columns named like a result are replaced. Markup may be broken or cut
off anywhere.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from plumbmart.llm.common import by_value, stored, without
from plumbmart.llm.ordering import ordered
from plumbmart.llm.urls import host_of, path_of

by_value(__name__)

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z) | <(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*+"|'[^']*+')*+)(?:>|\Z) | <(?P<end2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z) | <[!?/][^>]*+(?:>|\Z)""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
RAW = frozenset({"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "select"})
VOID = frozenset({"br", "img", "input", "meta", "link", "hr", "area", "base", "col", "embed", "source", "track", "wbr"})
INLINE = frozenset(
    {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
)
MARKED = frozenset({"article", "main"})
NEVER = frozenset({"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset"})
NEVER_WORDS = frozenset(
    {
        "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo",
        "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
        "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
    }
)
#: Of these, words that articles are also about: inside an article they count as a whole class or id only, not as a part.
AMBIGUOUS = frozenset(
    {"ad", "banner", "consent", "copyright", "disclaimer", "header", "menu", "notice", "notices", "promotion", "recommended", "related", "search", "share", "sharing", "social", "widget"}
)
#: How much of a page another may share and still not be a copy of it.
COPY = 0.9
KEEP, OPEN, NEVER_KEPT = 0, 1, 2


def never_words(value: str, name: str, in_article: bool) -> frozenset[str] | set[str]:
    """The words of a role, class or id that say it is never main text."""
    whole = NEVER_WORDS.intersection(value.split())
    if name in MARKED:
        return whole
    parts = NEVER_WORDS.intersection(re.split(r"[^a-z0-9]+", value))
    return whole | (parts - AMBIGUOUS) if in_article else parts


def is_never(name: str, rest: str, in_article: bool) -> bool:
    """Whether an element is never main text, by its name, role, class, id, style or the attribute hidden.

    On an element that marks an article only whole classes count (``related``, not ``related-work``).
    """
    if name in NEVER and not (name == "header" and in_article):
        return True
    if not rest.strip(" /"):
        return False
    for m in ATTRIBUTE.finditer(rest):
        attribute, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if attribute == "hidden":
            return True
        if attribute == "style":
            if "display:none" in value.replace(" ", ""):
                return True
        elif attribute in ("class", "id", "role") and name not in ("html", "body"):
            words = never_words(value, name, in_article)
            if words and not (in_article and words == {"header"}):
                return True
    return False


def lines_of(page: str) -> list[tuple[int, str]]:
    """The text of every block in page order, and whether it is kept, open, or never kept."""
    out: list[tuple[int, str]] = []
    buffers: tuple[list[str], list[str]] = ([], [])
    stack: list[tuple[str, bool, bool]] = []  # element, never main text, in a marked article
    never = article = False

    def flush() -> None:
        for buffer, kind in ((buffers[0], KEEP if article else OPEN), (buffers[1], NEVER_KEPT)):
            if buffer:
                text = " ".join(entities.unescape("".join(buffer)).split())
                if text:
                    out.append((kind, text))
                buffer.clear()

    at = 0
    while True:
        m = TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            buffers[never].append(text)
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing, rest = m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
        if name == "br":
            buffers[never].append(" ")
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if closing:
            if any(s[0] == name for s in stack):
                while stack.pop()[0] != name:
                    pass
        else:
            if name in RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if rest.endswith("/") and name not in INLINE:
                continue
            if name not in INLINE:
                while stack and (stack[-1][0] == "p" or stack[-1][0] in INLINE and any(s[0] == "p" for s in stack)):
                    stack.pop()
                if stack and stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    stack.pop()
                never, article = stack[-1][1:] if stack else (False, False)
            bad = is_never(name, rest, article)
            marked = name in MARKED and not bad
            # A form or the like around the whole page does not make its article one.
            stack.append((name, bad or (never and not marked), marked or (article and not bad)))
        never, article = stack[-1][1:] if stack else (False, False)
    flush()
    return out


def line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def rows_of(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """Bit vectors of the LCS of ever longer beginnings of ``a`` with all of ``b``: a zero bit is a step up."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def profile(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """The LCS lengths of ``a`` with every beginning of ``b``."""
    v = (1 << len(b)) - 1
    for v in rows_of(a, b):
        pass
    bits = bin(v | 1 << len(b))[:2:-1]
    out, n = [0], 0
    for c in bits[: len(b)]:
        n += c == "0"
        out.append(n)
    return out


def common(a: Sequence[int], b: Sequence[int], cells: int = 1 << 26) -> list[int]:
    """The places in ``a`` of a longest common subsequence with ``b``."""
    both = set(a).intersection(b)
    at = [i for i, x in enumerate(a) if x in both]
    x, y = [a[i] for i in at], [k for k in b if k in both]
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    ends = [*range(head), *range(len(x) - tail, len(x))]
    x, y = x[head : len(x) - tail], y[head : len(y) - tail]
    middle: list[int] = []
    if not x or not y:
        pass
    elif len(x) * len(y) <= cells or len(x) == 1:
        rows = list(rows_of(x, y))
        j = len(y) - 1
        for i in range(len(x) - 1, -1, -1):
            # Step back over the line if it raised the length at this place.
            while j >= 0 and rows[i] >> j & 1:
                j -= 1
            if j < 0:
                break
            if i == 0 or rows[i - 1] >> j & 1:
                middle.append(i)
                j -= 1
    else:
        half = len(x) // 2
        front, back = profile(x[:half], y), profile(x[half:][::-1], y[::-1])
        cut = max(range(len(y) + 1), key=lambda j: front[j] + back[len(y) - j])
        middle = [*common(x[:half], y[:cut], cells), *(half + i for i in common(x[half:], y[cut:], cells))]
    return sorted(at[i] for i in [*ends, *(head + i for i in middle)])


def alike(a: str, b: str) -> int:
    """The length of the common beginning of two paths."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def shared_lines(lines: list[int], path: str, neighbours: list[tuple[str, list[int]]]) -> list[int] | None:
    """Numbers of the lines that a page shares with its partner, None without one; neighbours are (path, lines), earlier first."""
    for _, other in sorted(neighbours, key=lambda n: -alike(path, n[0])):
        found = common(lines, other)
        if len(found) < COPY * len(lines):
            return found
    return None


def parsed(df: DataFrame, html: str, hashes: bool) -> DataFrame:
    """``df`` without its html: with the hashes of all lines, or with the lines that may be kept."""
    source = df.withColumn("__html", F.col(f"`{html}`").cast("string")).drop(html)
    names = [c for c in source.columns if c != "__html"]
    line = StructType([StructField("number", IntegerType()), StructField("kept", BooleanType()), StructField("line", StringType())])
    kind = pa.list_(pa.int64()) if hashes else pa.list_(pa.struct([("number", pa.int32()), ("kept", pa.bool_()), ("line", pa.string())]))

    def lines(page: str | None):
        found = lines_of(page or "")
        if hashes:
            return [line_hash(t) for _, t in found]
        return [(k, kind == KEEP, t) for k, (kind, t) in enumerate(found) if kind != NEVER_KEPT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([lines(x.as_py()) for x in part.column(part.num_columns - 1)], kind)], names=[*names, "__lines"])

    schema = source.select(*names).schema
    return source.mapInArrow(run, StructType([*schema.fields, StructField("__lines", ArrayType(LongType() if hashes else line))]))


def page_key(columns: Sequence[str]) -> Column:
    """A digest of the row's own columns."""
    return F.unhex(F.md5(F.to_json(F.struct(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")).alias(f"c{i}") for i, c in enumerate(columns)))).cast("binary")))


def partners(light: DataFrame) -> DataFrame:
    """``light`` (__page, __host, __path, __lines) with ``__around``: (host, path, lines) of the page before and after."""
    table, parts = ordered(light, [F.col("__host"), F.col("__path"), F.col("__page")], "pages")
    one = F.struct(F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__lines").alias("lines"))
    inside = Window.partitionBy("__part").orderBy("__at")
    near = table.withColumns({"__before": F.lag(one).over(inside), "__after": F.lead(one).over(inside)})
    # Parts without rows do not occur, so the part before is the next lower number.
    numbered = parts.withColumn("n", F.row_number().over(Window.orderBy("__part"))).select("__part", "n", "__size")
    ends = table.join(numbered, "__part").where("__at = 1 or __at = __size")
    last = ends.where("__at = __size").select((F.col("n") + 1).alias("n"), one.alias("__last"))
    first = ends.where("__at = 1").select((F.col("n") - 1).alias("n"), one.alias("__first"))
    edges = stored(numbered.join(last, "n", "left").join(first, "n", "left").select("__part", F.col("__size").alias("__rows"), "__last", "__first"), "edges")
    joined = near.join(edges, "__part")
    before = F.when(F.col("__at") == 1, F.col("__last")).otherwise(F.col("__before"))
    after = F.when(F.col("__at") == F.col("__rows"), F.col("__first")).otherwise(F.col("__after"))
    around = F.filter(F.array(before, after), lambda x: x.isNotNull() & (x["host"] == F.col("__host")))
    previous = F.when(before["host"] == F.col("__host"), before["lines"]).alias("__previous")
    return joined.select("__page", "__host", "__path", "__lines", "__part", "__at", previous, F.transform(around, lambda x: F.struct(x["path"].alias("path"), x["lines"].alias("lines"))).alias("__around"))


def aligned(pairs: DataFrame) -> DataFrame:
    """``pairs`` without __around, with __shared: the numbers of the lines that a page shares with its partner, null without one."""
    names = [c for c in pairs.columns if c != "__around"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, lines, around = (batch.column(c) for c in ("__path", "__lines", "__around"))
            shared = [
                shared_lines(mine, path, [(n["path"], n["lines"]) for n in near])
                for path, mine, near in zip(paths.to_pylist(), lines.to_pylist(), around.to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(shared, pa.list_(pa.int32()))], names=[*names, "__shared"])

    schema = pairs.select(*names).schema
    return pairs.mapInArrow(run, StructType([*schema.fields, StructField("__shared", ArrayType(IntegerType()))]))


def begins(pairs: DataFrame) -> DataFrame:
    """``pairs`` with __begins instead of __previous: whether a page is not a copy of the page before it."""
    names = [c for c in pairs.columns if c != "__previous"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("__lines").to_pylist(), batch.column("__previous").to_pylist(), strict=True)
            flags = [other is None or len(common(mine, other)) < COPY * max(len(mine), len(other)) for mine, other in both]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(flags, pa.bool_())], names=[*names, "__begins"])

    schema = pairs.select(*names).schema
    return pairs.mapInArrow(run, StructType([*schema.fields, StructField("__begins", BooleanType())]))


def shared_of(light: DataFrame) -> DataFrame:
    """(__page, __shared) of distinct pages: runs of near copies look for their partner outside of the run."""
    first = stored(aligned(begins(partners(light))), "aligned")
    lost = first.where("__shared is null")
    # A page that begins a run may be in its part or in one before.
    mine = F.last(F.when(F.col("__begins"), F.col("__page")), ignorenulls=True)
    inside = mine.over(Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0))
    ends = first.where("__begins").groupBy("__part").agg(F.max_by("__page", "__at").alias("end"))
    parts = first.select("__part").distinct().join(ends, "__part", "left")
    # One row a part: this window is as small as the number of partitions.
    carried = F.last("end", ignorenulls=True).over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = first.select("__page", "__part", inside.alias("inside")).join(parts.select("__part", carried.alias("carried")), "__part")
    runs = runs.select("__page", F.coalesce("inside", "carried").alias("__run"))
    around = partners(first.where("__begins").select("__page", "__host", "__path", "__lines"))
    own = F.array(F.struct(F.col("__path").alias("path"), F.col("__lines").alias("lines")))
    around = around.select(F.col("__page").alias("__run"), F.concat(own, "__around").alias("__around"))
    again = lost.select("__page", "__path", "__lines").join(runs, "__page").join(around, "__run")
    found = aligned(again.select("__page", "__path", "__lines", "__around"))
    none = F.array().cast("array<int>")
    return first.where("__shared is not null").select("__page", "__shared").union(found.select("__page", F.coalesce("__shared", none)))


def extract(df: DataFrame, url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """``df`` without its html and with the main text of each page."""
    kept = without(df, text)
    rows = kept.withColumn("__page", page_key(kept.columns))
    link = F.col(f"`{url}`").cast("string")
    narrow = rows.select("__page", host_of(link).alias("__host"), path_of(link).alias("__path"), html)
    light = stored(parsed(narrow, html, hashes=True).dropDuplicates(["__page"]).withColumn("__same", F.unhex(F.md5(F.to_json(F.struct("__host", "__lines")).cast("binary")))), "light")
    # Pages of a host with equal lines are one, that with the first path.
    one = F.min(F.struct("__path", "__page", "__host", "__lines")).alias("one")
    distinct = light.groupBy("__same").agg(one).select("__same", "one.*")
    each = shared_of(distinct.select("__page", "__host", "__path", "__lines")).join(distinct.select("__page", "__same"), "__page").select("__same", "__shared")
    shared = stored(light.select("__page", "__same").join(each, "__same").select("__page", "__shared"), "shared")
    # Both sides by key at every size, so that needs grow in proportion.
    lines = parsed(rows, html, hashes=False).join(shared.hint("merge"), "__page")
    wanted = F.filter("__lines", lambda x: x["kept"] | ~F.array_contains("__shared", x["number"]))
    return lines.withColumn(text, F.array_join(F.transform(wanted, lambda x: x["line"]), "\n\n")).drop("__page", "__lines", "__shared")
