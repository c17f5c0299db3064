"""HTML extraction expressions over a page column (HTM-1..5).

Pages are parsed with regular expressions inside Spark (JVM side, no Python
per row).  Scripts, styles and comments are removed first, because stored
pages hold things such as ``var t="</p>"`` inside scripts.  Paragraphs may
be left unclosed, so a paragraph ends at ``</p>``, at the next ``<p>`` or at
the end of its container.  Tables inside tables are read by ``table_cells``,
which counts open tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Character entities decoded in extracted text (``&amp;`` last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"),
            ("&amp;", "&")]
# --- end of fixed values ----------------------------------------------------

NOISE_RE = "(?s)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->"
P_START_RE = "<p(\\s[^>]*)?>"
P_END_RE = "(?s)(</p>|</article>|</body>|</div>|</section>|</td>|</li>).*$"
TAG_RE = "<[^>]+>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_noise(html) -> Column:
    return F.regexp_replace(_c(html), NOISE_RE, "")


def decode_entities(c) -> Column:
    out = _c(c)
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


def inner_text(fragment) -> Column:
    """Text of an HTML fragment: tags removed, entities decoded."""
    return decode_entities(F.regexp_replace(_c(fragment), TAG_RE, ""))


def paragraphs(html) -> Column:
    """HTM-1: texts of all ``<p>`` elements in document order."""
    parts = F.split(strip_noise(html), P_START_RE)
    bodies = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(bodies, lambda b: inner_text(F.regexp_replace(b, P_END_RE, "")))


def tag_texts(html, tag: str) -> Column:
    """HTM-1 for a properly closed tag (title, h1, li, a, ...)."""
    pat = f"(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>"
    return F.transform(F.regexp_extract_all(strip_noise(html), F.lit(pat), 1), inner_text)


def attribute_values(html, tag: str, attr: str) -> Column:
    """HTM-2: the ``attr`` value of every ``tag`` element (double quotes)."""
    pat = f"<{tag}\\s[^>]*?\\b{attr}=\"([^\"]*)\""
    return F.regexp_extract_all(strip_noise(html), F.lit(pat), 1)


def elements_with(html, tag: str, attr: str, value_regex: str) -> Column:
    """HTM-2: inner HTML of every closed, non-nested ``tag`` whose ``attr``
    (double quotes) matches the whole of ``value_regex``, in order."""
    pat = f"(?s)<{tag}\\s[^>]*?\\b{attr}=\"(?:{value_regex})\"[^>]*>(.*?)</{tag}>"
    return F.regexp_extract_all(strip_noise(html), F.lit(pat), 1)


def elements_of_class(html, tag: str, name: str) -> Column:
    """HTM-2: ``tag.name`` - the class attribute has ``name`` as a token."""
    return elements_with(html, tag, "class", f"(?:[^\"]*\\s)?{name}(?:\\s[^\"]*)?")


def attribute_where(html, tag: str, attr: str, where: str, value: str) -> Column:
    """HTM-2: ``tag[where=value]``'s ``attr`` (either order of the two), or
    the empty string, e.g. the content of ``meta[name=description]``."""
    t = strip_noise(html)
    a = f"<{tag}\\s(?=[^>]*\\b{where}=\"{value}\")[^>]*?\\b{attr}=\"([^\"]*)\""
    return F.regexp_extract(t, a, 1)


def class_tokens(value) -> Column:
    """HTM-2: the tokens of a class attribute."""
    return F.filter(F.split(_c(value), "\\s+"), lambda t: t != "")


def first_attribute(html, tag: str, attr: str) -> Column:
    pat = f"<{tag}\\s[^>]*?\\b{attr}=\"([^\"]*)\""
    return F.regexp_extract(strip_noise(html), pat, 1)


def join_url(base, href) -> Column:
    """HTM-2: absolute link: relative paths are appended to the site root."""
    b, h = _c(base), _c(href)
    root = F.regexp_extract(b, "^([a-z]+://[^/]+)", 1)
    return (F.when(h.rlike("^[a-z]+://"), h)
             .when(h.startswith("/"), F.concat(root, h))
             .otherwise(F.concat(F.regexp_replace(b, "[^/]*$", ""), h)))


def select_table(html, attr: str, value_regex: str) -> Column:
    """HTM-3: inner HTML of the first table whose attribute matches."""
    pat = f"(?s)<table[^>]*\\b{attr}=\"{value_regex}\"[^>]*>(.*?)</table>"
    return F.regexp_extract(_c(html), pat, 1)


def table_rows(table_html) -> Column:
    return F.regexp_extract_all(_c(table_html), F.lit("(?s)<tr[^>]*>(.*?)</tr>"), 1)


def row_cells(row_html) -> Column:
    return F.transform(F.regexp_extract_all(_c(row_html), F.lit("(?s)<t[dh][^>]*>(.*?)</t[dh]>"), 1),
                       inner_text)


def numeric_cells(cells) -> Column:
    """HTM-4: only the cells that parse as numbers, as doubles."""
    return F.filter(F.transform(_c(cells), lambda x: F.trim(x).try_cast("double")),
                    lambda v: v.isNotNull())


def fold_rows(length, candidates) -> Column:
    """HTM-5: the first candidate row count that divides ``length``."""
    arr = F.array(*[F.lit(n) for n in candidates])
    return F.try_element_at(F.filter(arr, lambda n: _c(length) % n == 0), F.lit(1))


def _page_cells(tags, bodies):
    """(table_no, parent_no, depth, attributes, row_no, cell_no, is_header,
    text) of every cell of one page, from its tokens in order: ``tags`` is
    empty for a text, whose ``bodies`` is the text; that of a ``table`` are its
    attributes.  Stray end tags do not take the depth below 0."""
    total, least, tables, last, cells = 0, 0, 0, {}, []
    for tag, body in zip(tags, bodies):
        total += (tag == "table") - (tag == "/table")
        least = min(least, total)
        depth = total - least + (tag == "/table")
        if depth <= 0:
            continue
        if tag == "table":
            above = last.get(depth - 1)
            last[depth] = {"no": tables, "parent": above and above["no"], "attributes": body, "row": -1, "counts": {}, "cell": None, "open": False}
            tables += 1
        own = last.get(depth)  # the last table opened at this depth
        if own is None:
            continue
        if tag == "tr":
            own["row"] += 1
        if tag in ("td", "th"):
            place = own["counts"].get(own["row"], 0)
            own["counts"][own["row"]] = place + 1
            own["cell"] = []
            cells.append((own["no"], own["parent"], depth, own["attributes"], own["row"], place, tag == "th", own["cell"]))
        if tag:
            own["open"] = tag in ("td", "th")
        elif own["open"]:
            own["cell"].append(body)
    return cells


_CELLS = ("page_id {}, table_no long, parent_no long, depth long, attributes string, row_no long, cell_no long, is_header boolean, text string")


def _cells_of_pages(page_cells):
    def run(batches):
        import pyarrow as pa
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["page_id", "table_no", "parent_no", "depth", "attributes", "row_no", "cell_no", "is_header", "text"]
        for b in batches:
            for at in range(0, b.num_rows, 64):  # so many pages are Python strings at a time
                part = b.slice(at, 64)
                rows, of = [], []
                for i, (tags, bodies) in enumerate(zip(part.column("tags"), part.column("bodies"))):
                    found = page_cells(tags.as_py(), bodies.as_py())
                    rows += found
                    of += [i] * len(found)
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("page").take(pa.array(of, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, kinds)],
                         pa.array(["".join(x) for x in cols[7]], pa.string())], names=names)
    return run


def table_cells(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """HTM-3 with tables inside tables: every cell of every table as
    (page_id, table_no, parent_no, depth, attributes, row_no, cell_no,
    is_header, text), numbers from 0 in page order.

    A page becomes its tags and the texts between them, and is read once from
    start to end in the task that has it: nothing is shuffled.  A running count
    of open tables gives a token's depth; the last table opened at that depth
    is its own, and within that table the rows and cells opened so far number
    it, so that a cell's text never holds that of a table inside it.  Cells and
    rows need not be closed.  A page without an id is none."""
    pattern = "(?is)</?(?:table|tr|td|th)\\b[^>]*>|<[^>]*>|[^<]+"
    tokens = F.transform(F.regexp_extract_all(strip_noise(html), F.lit(pattern), 0), lambda s: F.struct(
        F.lower(F.regexp_extract(s, "(?i)^<(/?(?:table|tr|td|th))\\b", 1)).alias("tag"), s.alias("s")))
    kept = F.filter(tokens, lambda t: (t["tag"] != "") | ~F.startswith(t["s"], F.lit("<")))
    body = F.transform("kept", lambda t: F.when(t["tag"] == "", t["s"]).when(
        t["tag"] == "table", F.regexp_extract(t["s"], "(?is)^<table\\b([^>]*)>", 1)).otherwise(""))
    rows = (pages.select(F.col(page_id).alias("page"), kept.alias("kept")).filter("page is not null and kept is not null")
            .select("page", F.transform("kept", lambda t: t["tag"]).alias("tags"), body.alias("bodies")))
    cells = rows.mapInArrow(_cells_of_pages(_page_cells), _CELLS.format(rows.schema["page"].dataType.simpleString()))
    return cells.withColumn("attributes", F.trim("attributes")).withColumn("text", F.trim(decode_entities("text")))
