"""Main text of web pages by differencing pages with nearest URLs.

A page is cut into lines, one per block of text, each with its zone: inside an element that is
never main text (menus, forms, adverts, comments, ...), inside a marked article, or open. Pages
are grouped by host and the directory of their URL's path (pages alone in their directory: by host
only) and ordered by path, URL and id. That order is cut into runs of about ``PART`` pages (of more
where there would be over ``RUNS`` of them); the pages on either side of a cut go to both runs, so the
neighbours are those of the whole order wherever it is cut.
Each page's lines are aligned, by longest common subsequence, with those of the nearest page before it
and the nearest after it that are no near copies of it: pages of which less than ``OWN`` of the
characters stand in lines of their own (equal rows, http and https, ``?utm=`` twins) are passed over, since they
share the article too. Shared open lines are template and are deleted, and so are lines of a
marked article that are mostly links and that any neighbour has. Other lines of a marked article stay. A page
with a marked article consists of that article; without one, of the open lines that no neighbour
shares. A task holds two pages and all copies between them, at most those of a run; a page with no other page
in its run but copies loses nothing.

Equal lines of one page are told apart by their running number, which makes the alignment a
longest increasing sequence: n log n whatever repeats.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from duoscope.llm.common import cut, measured, pick, prepare

PART, RUNS = 128, 20_000
#: Share of a page's characters in lines that the other page lacks, below which it is a near copy.
OWN = 0.1
KEY = ["host", "near", "path", "at", "ident", "tie"]

_SKIP = {"script", "style", "noscript", "template", "iframe", "svg", "math", "head", "title", "object", "canvas",
         "textarea", "select", "button", "option", "nav", "footer", "aside", "form", "menu", "dialog"}
#: Contents are not markup up to the end tag.
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "img", "ins", "kbd", "label", "mark", "meter", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
           "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_SKIP_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner",
               "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "cookie", "cookies",
               "consent", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "share",
               "sharing", "social", "related", "recommended", "comment", "comments", "disqus", "footer", "masthead",
               "widget", "toolbar", "pagination", "pager", "copyright", "search", "header", "alert", "gdpr", "skip"}
_SKIP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog",
               "alertdialog", "menu", "menubar", "toolbar"}
_TAG = re.compile(r"""<(?:!--(?:.*?--!?>|>|->)|(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(?!!--)[!?/][^>]*+>)""", re.S)
_PLAIN = re.compile(r"<(?:!--(?:.*?--!?>|>|->)|(/?)([A-Za-z][^\s/>]*)([^>]*+)>|(?!!--)[!?/][^>]*+>)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_BREAK = re.compile(r"[^a-z0-9]+")


def _skipped(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _SKIP or (tag == "header" and not in_article):
        return True
    if not attrs or attrs.isspace() or tag in ("html", "body"):
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), unescape(a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.strip() in _SKIP_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in ("class", "id"):
            words = set(_BREAK.split(value)) & _SKIP_WORDS
            if in_article:
                words -= {"header"}
            if words and tag not in ("article", "main") or words & {"comment", "comments", "ad", "ads", "advert"}:
                return True
    return False


def lines_of(html: str) -> list[tuple[str, str, bool]]:
    """(text, zone, mostly links) of each block with text; zone: article, open or skip."""
    out: list[tuple[str, str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []       # tag, skipped, inside an article
    parts: list[str] = []
    linked = 0
    pattern, at = _TAG, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                skip, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                out.append((text, "skip" if skip else "article" if article else "open", 2 * linked > len(text)))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            parts.append(text)
            if any(s[0] == "a" for s in stack[-4:]):
                linked += len(text)

    while True:
        low = html.find("<", at)
        if low < 0:
            break
        m = pattern.match(html, low)
        if not m and pattern is _TAG and html[low + 1:low + 2].isalpha():
            pattern = _PLAIN        # an open quote runs to the end: quotes mean nothing from here on
            m = pattern.match(html, low)
        if not m:
            if html.startswith("<!--", low):        # an open comment hides the rest
                add(html[at:low])
                at = len(html)
                break
            rest = html.find("<", low + 1)
            rest = len(html) if rest < 0 else rest
            add(html[at:rest])
            at = rest
            continue
        add(html[at:low])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag not in _INLINE:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if any(s[0] not in _INLINE for s in stack[i:]):
                        flush()
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "main", "body") and tag in _INLINE | {"p", "li"}:
                    break
            continue
        if tag not in _INLINE:
            flush()
        if tag in _VOID or m[3].endswith("/") and tag in ("svg", "path"):
            continue
        if tag not in _INLINE and stack and stack[-1][0] in _INLINE | {"p"}:
            while stack and stack[-1][0] in _INLINE | {"p"} and not stack[-1][1]:
                stack.pop()         # a block ends an open paragraph and unclosed inline elements
        if tag == "li" and stack and stack[-1][0] == "li":
            stack.pop()
        skip, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        if tag == "body":           # the head has ended, closed or not
            stack.clear()
            skip = article = False
        if tag in ("article", "main") or 'role="main"' in m[3]:
            article = True
        skip = skip or _skipped(tag, m[3], article)
        if skip and not (stack and stack[-1][1]):
            flush()
        stack.append((tag, skip, article))
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
    add(html[at:])
    flush()
    return out


def shared(a: list[str], b: list[str]) -> tuple[set[int], set[int]]:
    """Places of a longest common subsequence of two lists of lines, in each."""
    seen: dict[str, int] = {}
    where: dict[tuple[str, int], int] = {}
    for j, line in enumerate(b):
        n = seen.get(line, 0)
        seen[line] = n + 1
        where[line, n] = j
    seen.clear()
    ends, last, before = [], [], {}
    for i, line in enumerate(a):
        n = seen.get(line, 0)
        seen[line] = n + 1
        j = where.get((line, n))
        if j is None:
            continue
        k = bisect_left(ends, j)
        before[i, j] = last[k - 1] if k else None
        if k == len(ends):
            ends.append(j)
            last.append((i, j))
        else:
            ends[k], last[k] = j, (i, j)
    left, right, at = set(), set(), last[-1] if last else None
    while at:
        left.add(at[0])
        right.add(at[1])
        at = before[at]
    return left, right


def near_copy(lines: list[tuple[str, str, bool]], common: set[int]) -> bool:
    """Whether hardly any text of a page stands outside the lines it shares with another."""
    own = sum(len(line[0]) for i, line in enumerate(lines) if i not in common)
    return own < OWN * sum(len(line[0]) for line in lines) or not lines


def main_text(lines: list[tuple[str, str, bool]], template: set[int], beside: frozenset[int] | set[int] = frozenset()) -> str:
    """``template``: lines shared with neighbours; ``beside``: with near copies, which only links heed."""
    zone = "article" if any(z == "article" for _, z, _ in lines) else "open"
    return "\n".join(text for i, (text, z, links) in enumerate(lines)
                     if z == zone and not (i in template and (z == "open" or links) or i in beside and links and z == "article"))


def cuts(keys: DataFrame, size: int) -> tuple[list[tuple], dict[tuple, int], set[tuple]]:
    """(first keys of all runs but the first, run that each key before a cut goes to as well,
    keys that more than ``size`` equal rows have).

    Runs have about ``size`` rows; equal rows are counted, not moved.
    """
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = cut(keys.groupBy(*KEY).agg(F.count("*").alias("n")).repartitionByRange(n, *KEY).sortWithinPartitions(*KEY))
    # equal rows beyond ``size`` are dealt elsewhere
    totals = counted.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.least("n", F.lit(size))).alias("n")).collect()
    before, upto = {}, 0
    for r in sorted(totals):
        before[r.p] = upto
        upto += r.n

    def run(batches):
        last, c = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                c = before[r["p"]] if c is None else c
                begins = c > 0 and (c - 1) // size != (c + min(r["n"], size) - 1) // size
                if begins and last is not None:
                    out.append({**last, "begins": False})
                if begins or r["n"] > size:
                    out.append({**r, "begins": begins})
                last, c = r, c + min(r["n"], size)
            yield pa.RecordBatch.from_pylist(out, schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([{**last, "begins": False}], schema)

    counted = counted.withColumn("p", F.spark_partition_id())
    kinds = T.StructType([*counted.schema.fields, T.StructField("begins", T.BooleanType())])
    text, number = pa.string(), pa.int64()
    ident = text if kinds["ident"].dataType == T.StringType() else number
    schema = pa.schema(list(zip([*KEY, "n", "p", "begins"], [text, text, text, text, ident, number, number, pa.int32(), pa.bool_()])))
    marks: dict[tuple, bool] = {}
    heavy = set()
    for r in counted.mapInArrow(run, kinds).collect():
        key = tuple(r)[:len(KEY)]
        marks[key] = marks.get(key, False) or r.begins
        if r.n > size:
            heavy.add(key)
    first, also, last = [], {}, None
    for key in sorted(marks):
        if marks[key]:
            first.append(key)
            if last and last[:2] == key[:2]:    # the key before, in the same group
                also[last] = len(first)
        last = key
    return first, also, heavy


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            part: int = PART) -> DataFrame:
    """One row per row: id, url, text, n_chars, n_lines (blocks of the page), n_template (shared ones).

    A null html is an empty page; a null or odd URL has the empty host and directory and is
    compared with its like; a page without a neighbour loses nothing to differencing. Repeated
    rows and near copies are not compared with one another but with the next other page, so they keep
    their text. Very long pages are aligned whole (n log n). Ties of host, directory, path, URL and id
    stand by a hash of the row. Columns other than id, url and html are not read.
    """
    prepare(pages.sparkSession, 64)
    df = pick(pages, id=id_col, url=url_col, html=html_col)
    place = lambda c, group: F.regexp_extract(F.coalesce(c, F.lit("")), r"^(?:[A-Za-z][\w+.-]*:)?//([^/?#]*)([^?#]*/)?([^?#]*)", group)
    df = df.withColumn("host", F.lower(place(F.col("url"), 1))).withColumn("dir", place(F.col("url"), 2))
    df = df.withColumn("path", F.concat("dir", place(F.col("url"), 3)))
    # pages alone in their directory are compared within the host
    sizes = measured(df.groupBy("host", "dir").agg(F.count("*").alias("n")).select(
        "host", "dir", F.when(F.col("n") > 1, F.col("dir")).otherwise("*").alias("near"), "n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    whole = isinstance(df.schema["id"].dataType, T.IntegralType)
    df = (df.join(sizes.drop("n"), ["host", "dir"]).withColumn("at", F.coalesce("url", F.lit("")))
          .withColumn("ident", F.coalesce(F.col("id").cast("long"), F.lit(-1 << 63)) if whole
                      else F.coalesce(F.col("id").cast("string"), F.lit("")))
          .withColumn("tie", F.xxhash64("id", "url", "html")))
    first, also, heavy = cuts(df.select(*KEY), max(part, -(-total // RUNS)))
    known = df.sparkSession.sparkContext.broadcast((first, also, heavy))

    kept = ["id", "url", *KEY]

    def cut_lines(batches):
        first, also, heavy = known.value
        begins = {key: i for i, key in enumerate(first)}
        sent: set[tuple] = set()
        dealt: dict[tuple, int] = {}
        for batch in batches:
            rows, run, role = [], [], []
            for i, key in enumerate(zip(*(batch[c].to_pylist() for c in KEY))):
                at = bisect_right(first, key)
                if key in heavy:        # has equal rows beside it, wherever it goes
                    dealt[key] = n = dealt.get(key, 0) + 1
                    rows.append(i)
                    run.append(-1 - (key[-1] + n) % (1 << 20))
                    role.append(TWIN)
                else:
                    rows.append(i)
                    run.append(at)
                    role.append(PAGE)
                if key not in sent and (key in heavy or key in also or key in begins):
                    sent.add(key)
                    copies = [at] if key in heavy else []
                    copies += [also[key]] if key in also else []
                    copies += [at - 1] if key in begins else []
                    rows += [i] * len(copies)
                    run += copies
                    role += [COPY] * len(copies)
            html = batch["html"].to_pylist()
            lines = [[{"text": t, "zone": z, "links": k} for t, z, k in lines_of(h or "")] for h in html]
            cols = {c: batch[c].take(pa.array(rows, pa.int64())) for c in kept}
            cols["run"], cols["role"] = pa.array(run, pa.int64()), pa.array(role, pa.int32())
            cols["lines"] = pa.array(lines, _LINES).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_pydict(cols)

    kind = {f.name: f for f in df.schema}
    line = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("zone", T.StringType()),
                                     T.StructField("links", T.BooleanType())]))
    cut_ = df.select(*kept, "html").mapInArrow(cut_lines, T.StructType(
        [kind[c] for c in kept] + [T.StructField("run", T.LongType()), T.StructField("role", T.IntegerType()),
                                   T.StructField("lines", line)]))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_.repartition(n, "run").sortWithinPartitions("run", *KEY)

    def difference(batches):
        ids = _arrow(kind["id"])
        waiting: list[_Page] = []       # copies of one another that have not met another page yet (of one run at most)
        before: _Page | None = None     # the nearest page before them that is no copy

        def out(done):
            texts = [main_text(p.lines, p.template, p.beside) for p in done]
            return pa.RecordBatch.from_pydict({
                "id": pa.array([p.id for p in done], ids), "url": pa.array([p.url for p in done], pa.string()),
                "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "n_lines": pa.array([len(p.lines) for p in done], pa.int64()),
                "n_template": pa.array([len(p.template) for p in done], pa.int64())})

        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                now = _Page(tuple(batch[c][i].as_py() for c in ("run", "host", "near")), batch["role"][i].as_py(),
                            batch["id"][i].as_py(), batch["url"][i].as_py(),
                            [(x["text"], x["zone"], x["links"]) for x in batch["lines"][i].as_py()])
                if now.role == TWIN:        # equal rows lie beside it
                    now.beside.update(range(len(now.lines)))
                if waiting and waiting[0].group != now.group:
                    done += waiting
                    waiting, before = [], None
                if waiting:
                    last = waiting[-1]
                    a, b = shared(last.texts, now.texts)
                    if near_copy(now.lines, b) or near_copy(last.lines, a):
                        last.beside.update(a)
                        now.beside.update(b)
                        if before is not None:      # whose other side these copies are
                            now.template.update(shared(before.texts, now.texts)[1])
                    else:
                        now.template.update(b)
                        last.template.update(a)
                        for page in waiting[:-1]:
                            page.template.update(shared(page.texts, now.texts)[0])
                        done += waiting
                        before, waiting = last, []
                waiting.append(now)
            done = [p for p in done if p.role != COPY]
            if done:
                yield out(done)
        done = [p for p in waiting if p.role != COPY]
        if done:
            yield out(done)

    schema = T.StructType([kind["id"], kind["url"], T.StructField("text", T.StringType()),
                           *[T.StructField(c, T.LongType()) for c in ("n_chars", "n_lines", "n_template")]])
    return dealt.mapInArrow(difference, schema).withColumnsRenamed({"id": id_col, "url": url_col})


def _arrow(field: T.StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


class _Page:
    def __init__(self, group: tuple, role: int, id_, url: str, lines: list[tuple[str, str, bool]]):
        self.group, self.role, self.id, self.url, self.lines = group, role, id_, url, lines
        self.texts = [x[0] for x in lines]
        self.template: set[int] = set()
        self.beside: set[int] = set()


#: What a row is to its run: a page, a page with equal rows beside it, a neighbour only.
PAGE, TWIN, COPY = range(3)
_LINES = pa.list_(pa.struct([("text", pa.string()), ("zone", pa.string()), ("links", pa.bool_())]))
