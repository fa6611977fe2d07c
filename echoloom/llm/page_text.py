"""Main text of HTML pages: nearest-URL page differencing, held against the markup.

1. A page becomes text lines (blocks), each with what its markup says: inside boilerplate (menus,
   headers, footers, sidebars, notices, adverts, forms, reader comments), inside the article, or
   nothing.
2. Pages of a host are sorted by URL path; each is paired with the nearest page on either side whose
   lines are not all the same, so that exact copies do not delete each other.  Pairs are aligned by the longest common subsequence of their lines, and lines of the alignment are shared.
3. Shared lines are deleted, but for lines inside an article element: near copies of an article on
   neighbouring URLs share whole paragraphs, which are text and not template.  Of lines that are not
   shared, those inside boilerplate markup are deleted as well: adverts and footers differ from page
   to page.  If a page has an article, lines outside it are deleted too.

Only 8-byte line hashes and flags travel to the pairing, never texts: a page's order among its host's
is found from sorted keys alone, so that one host with a third of all pages is spread over many tasks.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.bytehash import PrefixHash
from echoloom.llm.common import stored
from echoloom.llm.url_reputation import host_of, path_of

#: Elements whose content is no text.
SILENT = frozenset("script style noscript template svg math head title iframe object canvas audio video textarea select datalist".split())
#: Elements that are boilerplate by themselves.
BOILERPLATE = frozenset("nav footer aside form menu dialog button header".split())
#: Elements that end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role that mark boilerplate.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " header masthead footer sidebar aside complementary contentinfo cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup"
    " share sharing social related recommended comment comments discussion replies reply disqus pagination pager toolbar skip search login widget".split()
)
ARTICLE = frozenset("article main".split())
#: Elements that an open p ends before.
ENDS_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>\x00]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
PLAIN, IN_ARTICLE, IN_BOILERPLATE = 0, 1, 2


def _marked(name: str, attributes: str) -> bool:
    if name in BOILERPLATE:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        named = [m for m in _ATTRIBUTE.findall(attributes)] if name == "article" else []
        return any(not MARKED.isdisjoint(_WORD.findall("".join(values).lower())) and "comment" in "".join(values).lower() for _, *values in named)
    if _HIDDEN.search(attributes):
        return True
    return any(not MARKED.isdisjoint(_WORD.findall("".join(values).lower())) for _, *values in _ATTRIBUTE.findall(attributes))


def lines_of(page: str) -> list[tuple[str, int]]:
    """The blocks of a page in order: text with single spaces, and where its markup puts it."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, bool]] = []  # open elements, and whether each is boilerplate
    boilerplate = article = 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append((text, IN_BOILERPLATE if boilerplate else IN_ARTICLE if article else PLAIN))

    def close(upto: int) -> None:
        nonlocal boilerplate, article
        while len(stack) > upto:
            name, marked = stack.pop()
            boilerplate -= marked
            article -= name in ARTICLE

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            tag = size
        if tag > at:
            held.append(html.unescape(page[at:tag]))
        if tag == size:
            break
        token = _TOKEN.match(page, tag)
        if token is None:  # a lone "<" is text
            held.append("<")
            at = tag + 1
            continue
        at = token.end()
        if token[1] is None:
            continue
        name, ending = token[1].lower(), page[tag + 1] == "/"
        if name == "br":
            held.append(" ")
            continue
        if ending:
            if name in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
            continue
        if name in SILENT:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            if name == "head":
                continue
            if end is None:
                at = size if name in ("script", "style", "textarea", "title") else at
            else:
                stop = page.find(">", end.end() - 1)
                at = size if stop < 0 else stop + 1
            held.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if name in ENDS_P or name == "p":
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
        elif name in ("li", "dt", "dd", "td", "th", "tr", "option"):
            if stack and stack[-1][0] == name:
                close(len(stack) - 1)
        if name in VOID or token[0].endswith("/>") and name not in BLOCKS:
            continue
        inside = name == "header" and article > 0  # an article's own header holds its title
        marked = not inside and _marked(name, token[2] or "")
        stack.append((name, marked))
        boilerplate += marked
        article += name in ARTICLE
    flush()
    return out


def common_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Places in a and in b of one longest common subsequence; linear memory in the longer rest."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    left, right = list(range(start)), list(range(start))
    places: dict[int, list[int]] = {}
    for j in range(start, len(b) - end):
        places.setdefault(b[j], []).append(j)
    # Hunt and Szymanski: the longest rising run among the matches, each line's taken from the end.
    tails: list[int] = []
    links: list[tuple] = []
    from bisect import bisect_left

    for i in range(start, len(a) - end):
        for j in reversed(places.get(a[i], ())):
            k = bisect_left(tails, j)
            node = (i, j, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(node)
            else:
                tails[k], links[k] = j, node
    middle, node = [], links[-1] if links else None
    while node:
        middle.append(node[:2])
        node = node[2]
    for i, j in reversed(middle):
        left.append(i)
        right.append(j)
    return left + list(range(len(a) - end, len(a))), right + list(range(len(b) - end, len(b)))


def choose(lines: list[tuple[str, int]], shared: set[int]) -> str:
    """The text left of a page once shared lines and boilerplate are deleted."""
    has_article = any(where == IN_ARTICLE for _, where in lines)
    kept = [text for i, (text, where) in enumerate(lines) if where == IN_ARTICLE or (where == PLAIN and not has_article and i not in shared)]
    return "\n\n".join(kept)


def _hashes(lines: list[tuple[str, int]]) -> np.ndarray:
    texts = [t.encode("utf-8", "surrogatepass") for t, _ in lines]
    ends = np.cumsum([len(t) for t in texts])
    return PrefixHash(np.frombuffer(b"".join(texts), dtype=np.uint8)).ranges(ends - [len(t) for t in texts], ends)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, host, path, html) to (key, host, path, lines): hashes of all lines but boilerplate's."""
    for batch in batches:
        packed = []
        for page in batch.column(3):
            lines = [x for x in lines_of(page.as_py() or "")]
            packed.append(_hashes(lines).astype("<u8").tobytes() if lines else b"")
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], names=["key", "host", "path", "lines"])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts the runs of a sorted partition (pages on end of one host with the same lines), and marks the first row of each."""
    run, last = -1, None
    for batch in batches:
        places, heads, digests = [], [], []
        for host, lines in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            digest = hashlib.md5((host or "").encode("utf-8", "surrogatepass") + b"\x1f" + lines).digest()
            heads.append(digest != last)
            run, last = run + heads[-1], digest
            places.append(run)
            digests.append(digest)
        added = [pa.array(places, pa.int64()), pa.array(heads, pa.bool_()), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "place", "head", "digest"])


def _compare(key, table):
    """The runs of a block in order, and those just before and after it: shared lines of each run."""
    rows = table.sort_by([("rank", "ascending")]).to_pydict()
    lines = [np.frombuffer(x, dtype="<u8").tolist() for x in rows["lines"]]
    shared: list[set[int]] = [set() for _ in lines]
    for i in range(1, len(lines)):
        if rows["host"][i] == rows["host"][i - 1] and rows["rank"][i] == rows["rank"][i - 1] + 1:
            a, b = common_lines(lines[i - 1], lines[i])
            shared[i - 1].update(a)
            shared[i].update(b)
    own = [i for i, ours in enumerate(rows["own"]) if ours]
    found = [np.array(sorted(shared[i]), dtype="<i4").tobytes() for i in own]
    return pa.table({"rank": pa.array([rows["rank"][i] for i in own], pa.int64()), "shared": pa.array(found, pa.binary())})


#: Runs of pages that are compared in one task step.
BLOCK_PAGES = 256


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, shared in zip(batch.column(2), batch.column(3)):
            lines = lines_of(page.as_py() or "")
            texts.append(choose(lines, set(np.frombuffer(shared.as_py() or b"", dtype="<i4").tolist())))
        counts = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], names=["page_id", "url", "text", "n_chars"])


def shared_lines(keyed: DataFrame) -> DataFrame:
    """(key, host, path, lines) to (key, shared): which lines a page shares with those next to it.

    Pages are sorted by host, path and key with a distributed sort, and their runs are ranked: pages on
    end with the same lines are one, of which the first is compared and all get the result.  A block holds
    BLOCK_PAGES ranks and the one before and after.  Pages without a host share nothing: an empty host is no site.
    """
    spark = keyed.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "key"]
    numbered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = "key binary, host string, path string, lines binary, part int, place long, head boolean, digest binary"
    numbered = stored(numbered.mapInArrow(_number, kind))
    ends = numbered.groupBy("part").agg(F.max("place").alias("last"), F.min_by("digest", "place").alias("a"), F.max_by("digest", "place").alias("b")).collect()  # one row a partition
    starts, total, before = [], 0, None
    for row in sorted(ends, key=lambda r: r["part"]):
        goes_on = row["a"] == before  # the run before ends here, or later
        starts.append((row["part"], total - goes_on, goes_on))
        total, before = total - goes_on + row["last"] + 1, row["b"]
    first = F.broadcast(spark.createDataFrame(starts, "part int, first long, goes_on boolean"))  # one row a partition
    ranked = numbered.where("host <> ''").join(first, "part").withColumn("rank", F.col("first") + F.col("place"))
    heads = ranked.where("head and not (goes_on and place = 0)")
    block = F.floor(F.col("rank") / BLOCK_PAGES)
    before = F.when(F.pmod("rank", F.lit(BLOCK_PAGES)) == 0, block - 1)
    after = F.when(F.pmod("rank", F.lit(BLOCK_PAGES)) == BLOCK_PAGES - 1, block + 1)
    both = F.filter(F.array(F.struct(block.alias("block"), F.lit(True).alias("own")), F.struct(before.alias("block"), F.lit(False).alias("own")), F.struct(after.alias("block"), F.lit(False).alias("own"))), lambda x: x["block"].isNotNull())
    spread = heads.withColumn("at", F.explode(both)).select("host", "lines", "rank", "at.block", "at.own")
    found = spread.groupBy("block").applyInArrow(_compare, "rank long, shared binary").where(F.length("shared") > 0)
    return ranked.select("key", "rank").join(found, "rank").select("key", "shared")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of (page_id, url, html).

    A null or empty html has an empty text.  Repeated rows count as one page and each get
    a row; pages without a host, or alone on theirs, are judged by their markup only.
    """
    key = F.unhex(F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("page_id", "url", "html")])))
    rows = pages.select("page_id", "url", F.col("html").cast("string"), key.alias("key"))
    described = rows.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    # Stored, since the distributed sort reads its input twice: pages are parsed here and in _extract only.
    shared = shared_lines(stored(described.mapInArrow(_describe, "key binary, host string, path string, lines binary")))
    shared = shared.groupBy("key").agg(F.max("shared").alias("shared"))
    joined = rows.join(shared, "key", "left").select("page_id", "url", "html", "shared")
    kind = f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long"
    return joined.mapInArrow(_extract, kind)
