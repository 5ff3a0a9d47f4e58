"""Main texts of web pages by wrapper induction.

Every page is parsed once, into blocks of text outside boilerplate elements, each with the path of elements that leads to it.
Pages of a host with the same set of container paths have one template. Over all pages, the different contents that hold
a path, and those that hold a text at that path, are counted for each template and for each host: a text that nearly all of
them share is the template's own and is left out, every other block is kept. So a template that was seen on LEAST
different contents decides alone what is main text, whether or not there is an article. Pages of a rarer template take
all top-level article and main elements outside boilerplate, or the body, without the constants of the host.

Rules: null or empty html gives an empty text; a null or odd url belongs to the empty host; repeated rows are extracted
each by itself and counted once; broken or cut markup is read as far as it goes; an article whose blocks are all constant
is kept; an article inside boilerplate counts where there is no other.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import saved

#: Different contents that a template needs, and the share of them that has a constant text.
LEAST, SHARE = 3, 0.9

# Fixed values of HTML: elements without content, raw text, elements that end a paragraph, elements that are inline.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe".split())
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Elements, roles and name parts that are never main text.
OUT_TAGS = set("nav header footer aside form script style noscript template iframe svg canvas object button select textarea menu dialog head title".split())
OUT_ROLES = set("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form".split())
OUT_NAMES = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscribe|sidebar|related|share|sharing|social|comments?|disqus|respond|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|pagination|pager|widget|signup|login)(?:$|[\s_-])")
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption".split())

NUMBER = re.compile(r"\d+")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    __slots__ = ("tag", "names", "out", "items", "parent")

    def __init__(self, tag: str, attrs: str, parent):
        self.tag, self.items, self.parent = tag, [], parent
        self.names, self.out = "", tag in OUT_TAGS
        if attrs and attrs.strip(" /"):
            found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attrs)}
            self.names = f"{found.get('id', '')} {found.get('class', '')}".strip()
            self.out = (self.out or "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in OUT_ROLES
                        or tag not in ("html", "body", "article", "main") and bool(self.names and OUT_NAMES.search(self.names)))

    def sign(self) -> str:
        """Element and names; numbers in names differ from page to page."""
        return f"{self.tag}.{NUMBER.sub('#', self.names)}"

    def children(self) -> list["Node"]:
        return [c for c in self.items if not isinstance(c, str)]


def parse(source: str) -> Node:
    """A tolerant tree: unknown ends are ignored, open elements end with their parents."""
    root = Node("root", "", None)
    at, pos, size = root, 0, len(source)
    while pos < size:
        m = TOKEN.search(source, pos)
        if not m:
            at.items.append(html.unescape(source[pos:]))
            break
        if m.start() > pos:
            at.items.append(html.unescape(source[pos:m.start()]))
        pos, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            node = at
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                at = node.parent
            continue
        if tag not in INLINE:
            ends = CLOSES.get(tag, {"p"})
            node = at
            while node is not root and (node.tag in INLINE or node.tag in ends):
                if node.tag in ends:
                    at = node.parent
                node = node.parent
        node = Node(tag, m[3], at)
        at.items.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s>/]", re.I).search(source, pos)
            end = source.find(">", stop.start()) if stop else -1
            pos = end + 1 if end >= 0 else size
        elif tag not in VOID and not m[3].endswith("/"):
            at = node
    return root


def regions(root: Node) -> tuple[Node, list[Node], bool]:
    """The body or all, the top-level article and main elements, and whether these lie in boilerplate.

    Inside boilerplate only the largest counts, and only where there is no other.
    """
    body, clear, other, stack = None, [], [], [(root, False)]
    while stack:
        node, out = stack.pop()
        out = out or node.out and node.tag not in ("html", "body")
        if node.tag == "body" and body is None:
            body = node
        if node.tag in ("article", "main") and not node.out:
            (other if out else clear).append(node)
            continue
        stack.extend((c, out) for c in reversed(node.children()))
    if clear or not other:
        return body or root, clear, False
    return body or root, [max(other, key=mass)], True


def mass(node: Node) -> int:
    """Words of a subtree outside boilerplate."""
    words, stack = 0, list(node.items)
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            words += len(item.split())
        elif not item.out:
            stack.extend(item.items)
    return words


def digest(data: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(data.encode("utf-8", "surrogatepass"), seed=seed)


def blocks(node: Node, articles: set[int], paths: set[int]) -> list[tuple[int, str, bool]]:
    """Path, text and whether an article holds it, for the blocks in page order; white space inside is one space, empty
    blocks are none. ``paths`` receives those of the containers."""
    out, now, at = [], [], (0, False)

    def flush():
        text = " ".join("".join(now).split())
        if text:
            out.append((at[0], text, at[1]))
        now.clear()

    # An explicit stack: markup may nest deeper than Python's own. Inline elements have their container's path.
    stack: list = [(node, 0, False)]
    while stack:
        item, path, inside = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            at = path, inside
            now.append(item)
        elif item.out and item is not node and item.tag != "body":
            if item.tag not in INLINE:
                flush()
        elif item.tag == "br":
            now.append(" ")
        elif item.tag in INLINE:
            stack.extend((c, path, inside) for c in reversed(item.items))
        else:
            flush()
            path, inside = digest(item.sign(), path), inside or id(item) in articles
            if item.tag not in PROSE:
                paths.add(path)
            stack.append((None, path, inside))
            stack.extend((c, path, inside) for c in reversed(item.items))
    flush()
    return out


def read(source: str | None) -> tuple[int, int, list[tuple[int, int]], list[int], list[bool], list[str]]:
    """template, content, marks, keys, inside, texts of a page.

    Keys stand for path and text of a block. Marks are what is counted: (path, key), and (path, path) for the path itself.
    """
    if not source:
        return 0, 0, [], [], [], []
    root = parse(source)
    base, articles, apart = regions(root)
    paths: set[int] = set()
    found = blocks(base, {id(n) for n in articles}, paths)
    if apart:
        found += [(path, text, True) for path, text, _ in blocks(articles[0], set(), set())]
    sign = lambda x: x - (1 << 63)
    keys = [digest(text, path) for path, text, _ in found]
    marks = {(sign(p), sign(k)) for (p, _, _), k in zip(found, keys)} | {(sign(p),) * 2 for p, _, _ in found}
    numbers = lambda x: xxhash.xxh3_64_intdigest(b"".join(n.to_bytes(8, "little") for n in x))
    return sign(numbers(sorted(paths))), sign(numbers(keys)), sorted(marks), [sign(k) for k in keys], [i for _, _, i in found], [t for _, t, _ in found]


def chosen(keys: list[int], inside: list[bool], texts: list[str], known: bool, constant: set[int]) -> str:
    """The main text of a page."""
    article = any(inside)
    left = [t for k, i, t in zip(keys, inside, texts) if (known or i or not article) and k not in constant]
    if not left or article and not any(i and k not in constant for k, i in zip(keys, inside)):
        left = [t for k, i, t in zip(keys, inside, texts) if i or known and k not in constant]
    return "\n".join(left)


def constants(counts: DataFrame, *by: str) -> DataFrame:
    """by, constant: the keys that SHARE of the contents with their path have, LEAST at least."""
    pages = counts.where("key = path").select(*by, "path", F.col("n").alias("pages"))
    return (counts.where(f"key != path and n >= {LEAST}").join(pages, [*by, "path"]).where(F.col("n") >= SHARE * F.col("pages"))
            .groupBy(*by).agg(F.collect_list("key").alias("constant")))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html", host.alias("host"))
    kept = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("template", pa.int64()), ("content", pa.int64()),
                      ("marks", pa.list_(pa.struct([("path", pa.int64()), ("key", pa.int64())]))), ("keys", pa.list_(pa.int64())), ("inside", pa.list_(pa.bool_())), ("texts", pa.list_(pa.string()))])

    def parsed(batches):
        for batch in batches:
            template, content, marks, keys, inside, texts = zip(*map(read, batch.column("html").to_pylist())) if batch.num_rows else [()] * 6
            marks = [[{"path": p, "key": k} for p, k in m] for m in marks]
            made = [pa.array(c, f.type) for c, f in zip((template, content, marks, keys, inside, texts), list(kept)[3:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), *made], schema=kept)

    held = saved(rows.mapInArrow(parsed, "page_id bigint, url string, host string, template bigint, content bigint, marks array<struct<path: bigint, key: bigint>>, keys array<bigint>, inside array<boolean>, texts array<string>"))
    different = held.where("size(marks) > 0").select("host", "template", "content", "marks").dropDuplicates(["host", "template", "content"])
    counts = saved(different.select("host", "template", F.explode("marks").alias("m")).groupBy("host", "template", "m.path", "m.key").agg(F.count(F.lit(1)).alias("n")))
    seen = different.groupBy("host", "template").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= LEAST).select("host", "template")
    learned = saved(seen.join(constants(counts, "host", "template"), ["host", "template"], "left").withColumn("known", F.lit(True)))
    of_host = saved(constants(counts.groupBy("host", "path", "key").agg(F.sum("n").alias("n")), "host").withColumnRenamed("constant", "of_host"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("keys", "inside", "texts", "known", "constant", "of_host"))
            texts = [chosen(k, i, t, bool(known), {*(c or ()), *(h or ())}) for k, i, t, known, c, h in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    both = held.join(learned, ["host", "template"], "left").join(of_host, "host", "left")
    return both.select("page_id", "url", "keys", "inside", "texts", "known", "constant", "of_host").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
