"""Main-text extraction by wrapper induction.

1. A page is parsed once into a tree.  Runs of siblings that look alike (a list's
   items, an article's paragraphs) count as one repeated node, which gives the
   page's outline, and every text block belongs to one outline node.
2. A host's wrapper is the outline that most of its pages with text have.  The other
   distinct outlines of the host are aligned with it by simple tree matching (the
   largest ordered mapping of equal tags), so blocks of different pages get the
   same slot.  Nodes that the wrapper lacks are aligned with each other by their tags
   below the nearest node that it has.  The work is per distinct outline, not per page.
3. Over all different pages of a host (pages with the same blocks count once), a text
   that the same slot repeats on at least ``CONSTANT_SHARE`` of the pages that have the
   slot (``MIN_PAGES`` at least) is template; slots that vary are content.  A page that
   would lose all its blocks so keeps those of slots that vary.
4. Slots under menus, headers, footers, sidebars, notices, adverts, forms, scripts
   and comments by tag, role or class are template whatever they hold.  Where the
   outline has an article (else a main element), content is what lies inside.

Blocks keep page order; nothing else is dropped.

Defined results: null or empty html gives an empty text; a null or odd url groups
by its host "" like any other; markup errors are closed the way browsers do it;
every row gives one row, also repeated page ids; other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored, table

MIN_PAGES = 8
CONSTANT_SHARE = 0.8
#: Hosts' constants are broadcast up to this many rows.
MAX_BROADCAST = 50_000

# fixed values: element names and the words in class, id and role that mark template regions
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul").split())
DROPPED = frozenset("script style noscript template head title nav aside footer form iframe object svg button select textarea canvas dialog menu".split())
CLOSES_P = BLOCK - frozenset("body html option caption tbody td tfoot th thead tr".split())
OWN_KIND = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
MARKS = frozenset(("nav navbar navigation menu sidebar ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
                   "alert comment comments reply replies respond disqus breadcrumb breadcrumbs social share sharing related newsletter subscribe popup modal widget login signup "
                   "search copyright footer complementary contentinfo").split())
OUTER_MARKS = frozenset("header banner masthead".split())
#: Words that a mark's name may have beside it; a name with any other word ("related-work") marks nothing.
BESIDE = frozenset("area bar block bottom box button buttons container global inner item items left link links list outer page panel primary right secondary section site top wrapper".split())
WORDS = re.compile(r"[^a-z0-9]+")


#: Why a region is left out: by a name in its class, id or role, or by its element.
KEPT, MARKED, EXCLUDED = 0, 1, 2


def _marks(name: str, inside: bool) -> bool:
    """Whether one name in class, id or role marks a template region."""
    words = {x for x in WORDS.split(name) if x}
    marks = words & (MARKS if inside else MARKS | OUTER_MARKS)
    return bool(marks) and words <= marks | BESIDE


class Page(HTMLParser):
    """Outline nodes [tag, parent, children] and blocks (node, text) of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [["", -1, []]]
        self.open = [(0, "", KEPT, False)]         # node, tag, dropped, inside article or main
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.text: list[str] = []

    def _flush(self):
        if self.text:
            node, _, dropped, inside = next(x for x in reversed(self.open) if x[1] in BLOCK or not x[1])
            text = " ".join("".join(self.text).split())
            self.text = []
            if text:
                self.blocks.append((node, text, dropped, inside))

    def _pop(self, upto: int):
        self._flush()
        del self.open[upto:]

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in BLOCK:
                self._flush()
            elif tag == "br":
                self.text.append(" ")
            return
        if tag in CLOSES_P or tag in OWN_KIND:
            stop = OWN_KIND.get(tag, ())
            for k in range(len(self.open) - 1, 0, -1):
                name = self.open[k][1]
                if name in stop or (name in BLOCK and name not in ("p", tag)) or (name == tag and tag not in OWN_KIND and tag != "p"):
                    break
                if name == tag and tag in OWN_KIND or name == "p":
                    self._pop(k)
                    break
        parent, _, dropped, inside = self.open[-1]
        if tag in BLOCK or tag in DROPPED:
            self._flush()
        if not dropped:
            dropped = EXCLUDED if tag in DROPPED or (tag == "header" and not inside) else KEPT
            for name, value in attrs:
                if value and name in ("class", "id", "role") and dropped == KEPT:
                    if tag not in ("body", "html", "article", "main") and any(_marks(x, inside) for x in value.lower().split()):
                        dropped = MARKED
                elif name in ("hidden", "aria-hidden") and value in ("", "true", None):
                    dropped = EXCLUDED
        inside = inside or tag in ("article", "main")
        if tag not in BLOCK and tag not in DROPPED:
            self.open.append((parent, tag, dropped, inside))
            return
        # a sibling like the one before it is the same outline node again
        kin = self.nodes[parent][2]
        if kin and self.nodes[kin[-1]][0] == tag:
            node = kin[-1]
        else:
            node = len(self.nodes)
            self.nodes.append([tag, parent, []])
            kin.append(node)
        self.open.append((node, tag, dropped, inside))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.text.append(" ")
        for k in range(len(self.open) - 1, 0, -1):
            name = self.open[k][1]
            if name == tag:
                if tag in BLOCK or tag in DROPPED or any(x[1] in BLOCK or x[1] in DROPPED for x in self.open[k:]):
                    self._pop(k)
                else:
                    del self.open[k:]
                return
            if tag not in BLOCK and name in BLOCK:      # a stray inline end does not leave its block
                return

    def handle_data(self, data):
        last = self.open[-1]
        if last[2] and last[1] not in BLOCK and not any(x[2] for x in self.open if x[1] in BLOCK or not x[1]):
            return                                      # a dropped inline element inside a kept block
        self.text.append(data)

    def result(self, html: str):
        self.feed(html)
        self.close()
        self._flush()
        return self

    def outline(self) -> str:
        """The tree as nested tags in page order, nodes numbered in preorder."""
        out: list[str] = []
        stack: list = [0]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
                continue
            tag, _, kids = self.nodes[n]
            out.append(tag)
            if kids:
                out.append("(")
                stack.append(")")
                for c in reversed(kids):
                    stack += [" ", c]
        return "".join(out)

    def preorder(self) -> dict[int, int]:
        order: dict[int, int] = {}
        stack = [0]
        while stack:
            n = stack.pop()
            order[n] = len(order)
            stack.extend(reversed(self.nodes[n][2]))
        return order


def tree_of(outline: str):
    """(tags, children) of an outline, by preorder number."""
    tags, children, path, last = [""], [[]], [], 0
    for token in re.findall(r"[a-z0-9]+|[()]", outline):
        if token == "(":
            path.append(last)
        elif token == ")":
            path.pop()
        else:
            last = len(tags)
            tags.append(token)
            children.append([])
            children[path[-1]].append(last)
    return tags, children


def _same_subtrees(tags: list[str], children: list[list[int]], names: dict) -> list[int]:
    """A number per node that equal subtrees share; ``names`` is shared between trees."""
    out = [0] * len(tags)
    for x in range(len(tags) - 1, -1, -1):          # children have larger numbers
        out[x] = names.setdefault((tags[x], *(out[c] for c in children[x])), len(names))
    return out


def matched(a: str, b: str) -> list[int]:
    """Simple tree matching: for every node of ``a`` its partner in ``b``, or -1,
    in a largest mapping that keeps order and depth.

    Equal subtrees at the front or the end of two lists of children are partners in some
    largest mapping, so only what is between them is aligned."""
    tags_a, kids_a = tree_of(a)
    tags_b, kids_b = tree_of(b)
    names: dict = {}
    same_a, same_b = _same_subtrees(tags_a, kids_a, names), _same_subtrees(tags_b, kids_b, names)
    size = [1] * len(tags_a)
    for x in range(len(tags_a) - 1, -1, -1):
        size[x] += sum(size[c] for c in kids_a[x])

    def ends(x, y):
        """How many children at the front and at the end are equal."""
        p, q = kids_a[x], kids_b[y]
        n, front = min(len(p), len(q)), 0
        while front < n and same_a[p[front]] == same_b[q[front]]:
            front += 1
        back = 0
        while back < n - front and same_a[p[-1 - back]] == same_b[q[-1 - back]]:
            back += 1
        return front, back

    # the pairs to align, parents first; a pair has one pair of parents
    todo, pairs = [(0, 0)], []
    while todo:
        x, y = todo.pop()
        front, back = ends(x, y)
        p, q = kids_a[x][front:len(kids_a[x]) - back], kids_b[y][front:len(kids_b[y]) - back]
        pairs.append((x, y, front, back, p, q))
        todo += [(i, j) for i in p for j in q if tags_a[i] == tags_b[j] and same_a[i] != same_b[j]]
    weight: dict = {}
    best_of: dict = {}

    def w(i, j):
        if same_a[i] == same_b[j]:
            return size[i]
        return weight[i, j] if tags_a[i] == tags_b[j] else 0

    for x, y, front, back, p, q in reversed(pairs):
        best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
        for i in range(1, len(p) + 1):
            for j in range(1, len(q) + 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w(p[i - 1], q[j - 1]))
        best_of[x, y] = best, p, q, front, back
        weight[x, y] = best[-1][-1] + 1 + sum(size[c] for c in kids_a[x][:front]) + sum(size[c] for c in kids_a[x][len(kids_a[x]) - back:])

    partner = [-1] * len(tags_a)
    stack = [(0, 0)]
    while stack:
        x, y = stack.pop()
        partner[x] = y
        if same_a[x] == same_b[y]:
            stack += zip(kids_a[x], kids_b[y], strict=True)
            continue
        best, p, q, front, back = best_of[x, y]
        stack += zip(kids_a[x][:front], kids_b[y][:front], strict=True)
        if back:
            stack += zip(kids_a[x][-back:], kids_b[y][-back:], strict=True)
        i, j = len(p), len(q)
        while i and j:
            both = w(p[i - 1], q[j - 1])
            if both and best[i][j] == best[i - 1][j - 1] + both:
                i, j = i - 1, j - 1
                stack.append((p[i], q[j]))
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return partner


def slots_of(outline: str, wrapper: str) -> list[int]:
    """The slot of every node: its partner in the wrapper, or a negative number
    named by the nearest partner above it and the tags from there."""
    partner = matched(outline, wrapper)
    tags, children = tree_of(outline)
    slot, below = list(partner), [""] * len(tags)
    for x, kids in enumerate(children):         # preorder: parents first
        for y in kids:
            if partner[y] < 0:
                below[y] = (below[x] if partner[x] < 0 else str(partner[x])) + "/" + tags[y]
                slot[y] = -1 - (xxhash.xxh3_64_intdigest(below[y]) >> 1)
    return slot


def parse(html: str | None):
    """(outline, [(outline node, text)]) of the blocks that tags and names do not exclude;
    where names exclude all that tags leave, they decide nothing."""
    page = Page().result(html or "")
    order = page.preorder()
    kept = [b for b in page.blocks if b[2] == KEPT] or [b for b in page.blocks if b[2] == MARKED]
    if any(b[3] for b in kept):
        kept = [b for b in kept if b[3]]
    return page.outline(), [(order[n], t) for n, t, _, _ in kept]


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, outline, blocks) of every row."""
    kind = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string())]))

    def run(batches):
        for b in batches:
            done = [parse(x) for x in b.column("html").to_pylist()]
            blocks = pa.array([[{"node": n, "text": t} for n, t in p] for _, p in done], kind)
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), b.column("host"), pa.array([o for o, _ in done], pa.string()), blocks],
                                             ["page_id", "url", "host", "outline", "blocks"])

    url = F.coalesce("url", F.lit(""))
    host = lower_ascii(F.regexp_extract(url, r"^[^:/?#]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", host.alias("host"), "html").mapInArrow(
        run, f"page_id {dict(pages.dtypes)['page_id']}, url string, host string, outline string, blocks array<struct<node:int,text:string>>")


def slots(pages: DataFrame) -> DataFrame:
    """(host, outline, slot_of): for every distinct outline of a host, the slot of
    each of its nodes.  ``pages`` has (host, outline, filled: whether it has blocks)."""
    outlines = stored(pages.groupBy("host", "outline").agg(F.count_if("filled").alias("n")), "page-outlines")
    wrappers = outlines.groupBy(F.col("host").alias("__host")).agg(F.max_by("outline", F.struct("n", "outline")).alias("wrapper"))
    outlines = outlines.join(wrappers, F.col("host") == F.col("__host"))

    def run(batches):
        memo: dict = {}
        for b in batches:
            out = []
            for o, w in zip(b.column("outline").to_pylist(), b.column("wrapper").to_pylist(), strict=True):
                if (o, w) not in memo:
                    if len(memo) > 10_000:
                        memo.clear()
                    memo[o, w] = slots_of(o, w)
                out.append(memo[o, w])
            yield pa.RecordBatch.from_arrays([b.column("host"), b.column("outline"), pa.array(out, pa.list_(pa.int64()))], ["host", "outline", "slot_of"])

    return outlines.select("host", "outline", "wrapper").mapInArrow(run, "host string, outline string, slot_of array<bigint>")


def constants(pages: DataFrame, aligned: DataFrame) -> DataFrame:
    """(host, fixed, firm): per host the digests of (slot, text) that are template,
    and those of them whose slot never holds another text."""
    small = pages.where(F.size("blocks") > 0).select("host", "outline", F.transform(
        "blocks", lambda b: F.struct(b["node"].alias("node"), F.xxhash64(b["text"]).alias("text"))).alias("blocks"))
    # pages with the same texts are one page
    small = (small.groupBy("host", F.col("blocks.text").alias("texts")).agg(F.min(F.struct("outline", "blocks")).alias("page"))
             .select("host", "page.outline", "page.blocks"))
    small = stored(small, "page-contents")
    rows = (small.join(aligned, ["host", "outline"])
            .select("host", F.explode(F.array_distinct(F.transform("blocks", lambda b: F.struct(F.get("slot_of", b["node"]).alias("slot"), b["text"].alias("text"))))).alias("b"))
            .select("host", "b.slot", "b.text"))
    counts = rows.groupBy("host", "slot", "text").agg(F.count("*").alias("n"))
    kinds = counts.groupBy("host", "slot").agg(F.count("*").alias("kinds"))
    texts = counts.where(F.col("n") >= MIN_PAGES * CONSTANT_SHARE)
    have = (small.join(aligned, ["host", "outline"])
            .select("host", F.explode(F.array_distinct(F.transform("blocks", lambda b: F.get("slot_of", b["node"])))).alias("slot"))
            .groupBy("host", "slot").agg(F.count("*").alias("pages")).where(F.col("pages") >= MIN_PAGES))
    digest = F.xxhash64("slot", "text")
    return (texts.join(have, ["host", "slot"]).where(F.col("n") >= CONSTANT_SHARE * F.col("pages")).join(kinds, ["host", "slot"])
            .groupBy("host").agg(F.collect_set(digest).alias("fixed"), F.collect_set(F.when(F.col("kinds") == 1, digest)).alias("firm")))


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    rows = stored(parsed(pages), "page-blocks")
    aligned = stored(slots(rows.select("host", "outline", (F.size("blocks") > 0).alias("filled"))), "page-slots")
    fixed = stored(constants(rows, aligned), "page-constants")
    few = fixed.count() <= MAX_BROADCAST
    # only pages of hosts that have constants meet the alignment again
    with_slots = fixed.join(aligned, "host").select(F.col("host").alias("__h"), F.col("outline").alias("__o"), "slot_of", "fixed", "firm")
    with_slots = F.broadcast(with_slots) if few and with_slots.count() <= MAX_BROADCAST else with_slots
    without = lambda gone: F.filter("blocks", lambda b: F.col(gone).isNull() | ~F.array_contains(
        gone, F.xxhash64(F.get("slot_of", b["node"]), F.xxhash64(b["text"]))))
    kept = F.when(F.size(without("fixed")) > 0, without("fixed")).otherwise(without("firm"))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return (rows.join(with_slots, (F.col("host") == F.col("__h")) & (F.col("outline") == F.col("__o")), "left")
            .select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long")))


def op6_main_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
