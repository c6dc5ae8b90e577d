"""Rows out of HTML pages.

The reference downloads one page and walks it with a DOM parser.  Here a
column of pages is the input, so any number of pages is processed in
parallel, each page whole, without a parser library per row.  Tables are read
from a token stream with a running depth, so nested tables and left-out end
tags have a defined result; link lists come from a pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import html_text, to_int

# The class of the community-area table and how many header
# rows precede / footer rows follow its data rows.
AREA_TABLE_CLASS = "wikitable sortable plainrowheaders mw-datatable"
HEADER_ROWS = 2
FOOTER_ROWS = 1

# Comments, script and style blocks and tags are tokens of their own; so is the text between them.
_TOKEN = r"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|</?[a-z][^>]*>|[^<]+|<"
_CLASS = "(?is)^<table\\b[^>]*?\\sclass\\s*=\\s*[\"']([^\"']*)[\"']"
LIST_LINK = "<li[^>]*>\\s*<a[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>"


def html_table_rows(pages: DataFrame, html_col: str = "html", id_cols=("page_id",),
                    table_class: str = AREA_TABLE_CLASS, header_rows: int = HEADER_ROWS,
                    footer_rows: int = FOOTER_ROWS) -> DataFrame:
    """Data rows of the first table with class ``table_class`` of each page.

    Rows ``[header_rows : -footer_rows]`` of the table; from each, the text of
    the first ``td`` as ``area_code`` (integer) and the text of the first link
    in the row header ``th`` as ``community_name``.  Entities are decoded and
    text stripped (F19).  Only the table's own rows and cells count: those of a
    table inside a cell are text of that cell.  A row ends where the next
    begins, a cell where the next cell or row begins, whether its end tag is
    there or not; a table without end tag reaches to the end of the page.
    """
    ids = list(id_cols)
    page, order = Window.partitionBy(*ids), Window.partitionBy(*ids).orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    tokens = pages.select(*ids, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(_TOKEN), 0)).alias("pos", "token"))
    tag = F.lower(F.regexp_extract("token", "(?s)^<(/?[a-zA-Z][a-zA-Z0-9]*)", 1))
    t = tokens.select(*ids, "pos", "token", tag.alias("tag")).withColumn("depth", F.sum(
        F.when(F.col("tag") == "table", 1).when(F.col("tag") == "/table", -1).otherwise(0)).over(so_far))
    wanted = (F.col("tag") == "table") & (F.regexp_extract("token", _CLASS, 1) == table_class)
    t = t.withColumn("start", F.min(F.when(wanted, F.col("pos"))).over(page)).where("pos >= start")
    t = t.withColumn("level", F.min(F.when(F.col("pos") == F.col("start"), F.col("depth"))).over(page))
    t = t.withColumn("ended", F.max((F.col("depth") < F.col("level")).cast("int")).over(so_far)).where("ended = 0")
    own = F.col("depth") == F.col("level")
    cell_tag = own & F.col("tag").isin("td", "th")
    t = t.withColumns({
        "row": F.sum((own & (F.col("tag") == "tr")).cast("int")).over(so_far) - 1,
        "cell": F.sum(cell_tag.cast("int")).over(so_far),
        "inside": F.last(F.when(own & F.col("tag").isin("td", "th", "tr", "/td", "/th", "/tr"), F.col("tag")),
                         ignorenulls=True).over(so_far)})
    t = t.withColumn("rows", F.max("row").over(page) + 1).where(
        (F.col("row") >= header_rows) & (F.col("row") < F.col("rows") - footer_rows))
    in_cell = Window.partitionBy(*ids, "row", "cell").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumns({
        "link": F.sum((F.col("tag") == "a").cast("int")).over(in_cell),
        "in_link": F.last(F.when(F.col("tag").isin("a", "/a"), F.col("tag")), ignorenulls=True).over(in_cell)})
    first = Window.partitionBy(*ids, "row")
    t = t.withColumns({k: F.min(F.when(cell_tag & (F.col("tag") == k), F.col("cell"))).over(first) for k in ("td", "th")})
    text = lambda when: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(
        (F.col("tag") == "") & ~F.col("token").startswith("<") & when, F.struct("pos", "token")))), lambda x: x["token"]), "")
    rows = t.groupBy(*ids, "row").agg(
        text((F.col("inside") == "td") & (F.col("cell") == F.col("td"))).alias("code"),
        text((F.col("inside") == "th") & (F.col("cell") == F.col("th")) & (F.col("link") == 1) & (F.col("in_link") == "a"))
        .alias("name"))
    return rows.select(*ids, (F.col("row") - header_rows).cast("int").alias("row_index"),
                       to_int(html_text("code")).alias("area_code"), html_text("name").alias("community_name"))


def html_list_links(pages: DataFrame, html_col: str = "html", id_cols=("page_id",)) -> DataFrame:
    """S7 (list form): every ``<li><a href=...>text</a>`` entry of each page,
    in page order (``position`` from 1), with its target and stripped text."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(LIST_LINK), 1)
    texts = F.regexp_extract_all(F.col(html_col), F.lit(LIST_LINK), 2)
    z = pages.select(*id_cols, F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("pos", "e"))
    return z.select(*id_cols, (F.col("pos") + 1).alias("position"),
                    F.col("e.href").alias("href"), html_text(F.col("e.text")).alias("link_text"))
