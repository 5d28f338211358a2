"""Site-relative line deduplication.

A line is boilerplate of its host if it stands on more than `ratio` of the host's pages, and on
`min_pages` at least; such lines are dropped from all pages of that host. Lines are counted by
their digest, aggregated before the shuffle, so a host with a third of all pages is spread over
all tasks. The boilerplate of a host is a short list (its length times `ratio` is at most the mean
number of lines of a page); the lists are broadcast behind a size check, else joined by host, and
each page is then filtered in its own row.

Edge cases: a null text has no lines and stays null; blank lines are never boilerplate and stay.
A null host is a host of its own. A line counts once per page. Repeated rows are pages of their
own, unless `by_group` counts a line once for each group of near copies (and once for a repeated
doc_id, or for pages without a doc_id of equal text): then what such a group shares is no
boilerplate, however large it is, and is left whole for the deduplication that follows. Lines are
compared exactly. Other columns are kept as they are, one called n_dropped too. A page may end up empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.jaccard_join import near_groups
from riskloom.llm.scratch import written
from riskloom.operators.bounded import broadcast_if_small

HOST, BOILERPLATE = "__line_host", "__line_boilerplate"
GROUP, DROPPED = "__line_group", "__line_dropped"


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^ \t-\r]")


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float,
                min_pages: int, unit: Column | None = None) -> DataFrame:
    """One row per host that has any: the host and the digests of its boilerplate lines. Pages of
    one `unit` count once."""
    lines = F.array_distinct(F.filter(F.split(text, "\n"), _has_word))
    each = pages.select(host.alias(HOST), lines.alias("lines"),
                        *([] if unit is None else [unit.alias("unit")]))
    number = F.count("*") if unit is None else F.count_distinct("unit")
    totals = each.groupBy(HOST).agg(number.alias("pages"))
    counts = each.withColumn("line", F.explode("lines")).groupBy(
        HOST, F.unhex(F.md5("line")).alias("digest")).agg(number.alias("n"))
    # hosts are fewer than lines: the totals come to the counts, not the other way
    common = counts.where(F.col("n") >= min_pages).join(broadcast_if_small(totals), HOST).where(
        F.col("n") > ratio * F.col("pages"))
    return common.groupBy(HOST).agg(
        F.array_sort(F.collect_list(F.lower(F.hex("digest")))).alias(BOILERPLATE))


def grouped(docs: DataFrame, text: str) -> tuple[DataFrame, Column]:
    """`docs` with the group of those that are near copies of another, and what names the group of
    any document. Only members other than a group's first are named in the joined table."""
    groups = near_groups(docs).where("component_id <> doc_id").groupBy(
        F.col("doc_id").alias("__line_doc")).agg(F.min("component_id").alias(GROUP))
    doc = F.col("doc_id").cast("bigint")
    named = docs.join(broadcast_if_small(written(groups, "line-groups")),
                      doc == F.col("__line_doc"), "left")
    return named, F.coalesce(F.col(GROUP).cast("string"), doc.cast("string"),
                             F.md5(F.coalesce(text, F.lit(""))))


def drop_boilerplate(pages: DataFrame, host: Column, text: str, ratio: float = 0.1,
                     min_pages: int = 5, by_group: bool = False,
                     dropped: str = "n_dropped") -> DataFrame:
    """`pages` with `text` rid of boilerplate lines, and n_dropped, the number of lines gone."""
    host = F.coalesce(host.cast("string"), F.lit(""))
    counted, unit = grouped(pages, text) if by_group else (pages, None)
    listed = broadcast_if_small(written(
        boilerplate(counted, host, F.col(text), ratio, min_pages, unit), "line-boilerplate"))
    joined = pages.withColumn(HOST, host).join(listed, HOST, "left")
    lines = F.split(F.col(text), "\n")
    # what of the list occurs here is found by hashing, whatever the list's length
    present = F.array_intersect(F.transform(lines, F.md5), F.col(BOILERPLATE))
    kept = F.filter(lines, lambda x: ~(_has_word(x) & F.array_contains(F.col("__present"),
                                                                       F.md5(x))))
    marked = joined.withColumn("__present", F.coalesce(present, F.array().cast("array<string>")))
    out = marked.withColumn("__kept", F.when(F.size("__present") > 0, kept))
    changed = F.col("__kept").isNotNull()
    return out.withColumn(dropped, F.when(
        changed, F.size(lines) - F.size("__kept")).otherwise(0).cast("bigint")).withColumn(
        text, F.when(changed, F.array_join("__kept", "\n")).otherwise(F.col(text))).drop(
        HOST, BOILERPLATE, "__present", "__kept")


# fixed values: what of a page is no text, and which tags end a line
NO_TEXT = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
LINE_TAGS = (r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|nav|article|section|header|footer|title|tr|td"
             r"|table|body|head|html)[^>]*>")
TAGS, BLANKS = r"<[^>]*>", r"[ \t\n\r]*\n[ \t\n\r]*"


def visible_lines(html: Column) -> Column:
    """The text of a page, a line per block, without blank lines."""
    text = F.regexp_replace(F.regexp_replace(html, NO_TEXT, ""), LINE_TAGS, "\n")
    text = F.regexp_replace(F.regexp_replace(text, TAGS, ""), BLANKS, "\n")
    return F.regexp_replace(text, r"^[ \t\n\r]+|[ \t\n\r]+$", "")


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z]+://([^/?#:]+)", 1))


def dedup_pages(pages: DataFrame, ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """page_id, host, n_lines, n_dropped, text: the visible lines of each page without the
    boilerplate of its host."""
    seen = written(pages.select("page_id", url_host(F.col("url")).alias("host"),
                                visible_lines(F.col("html")).alias("text")), "page-lines")
    n_lines = F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(
        F.size(F.split("text", "\n"))).cast("bigint")
    out = drop_boilerplate(seen.withColumn("n_lines", n_lines), F.col("host"), "text", ratio,
                           min_pages)
    return out.select("page_id", "host", "n_lines", "n_dropped", "text")


def dedup_documents(docs: DataFrame, ratio: float = 0.1, min_pages: int = 5,
                    by_group: bool = False) -> DataFrame:
    """Documents with their source as host; n_chars follows the text, other columns stay."""
    out = drop_boilerplate(docs, F.col("source"), "text", ratio, min_pages, by_group, DROPPED)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col(DROPPED) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(
            docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


ORACLE = f"""
WITH seen AS (
  SELECT row_number() OVER () AS row_no, page_id,
         lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
           {sql_text(NO_TEXT)}, '', 'g'), {sql_text(LINE_TAGS)}, chr(10), 'g'),
           {sql_text(TAGS)}, '', 'g'), {sql_text(BLANKS)}, chr(10), 'g'),
           '^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '', 'g') AS text
  FROM pages),
lines AS (
  SELECT row_no, coalesce(host, '') AS host, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM seen),
worded AS (SELECT * FROM lines WHERE regexp_matches(line, '[^ \\t-\\r]')),
totals AS (SELECT coalesce(host, '') AS host, count(*) AS pages FROM seen GROUP BY 1),
common AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT row_no) AS n FROM worded GROUP BY 1, 2)
  JOIN totals USING (host) WHERE n >= 5 AND n > 0.1 * pages),
kept AS (
  SELECT row_no, count(*) AS n, string_agg(line, chr(10) ORDER BY place) AS text FROM lines
  WHERE NOT EXISTS (SELECT 1 FROM common c WHERE c.host = lines.host AND c.line = lines.line)
  GROUP BY row_no)
SELECT page_id, host,
       CAST(CASE WHEN coalesce(seen.text, '') = '' THEN 0
            ELSE len(string_split(seen.text, chr(10))) END AS BIGINT) AS n_lines,
       CAST(CASE WHEN coalesce(seen.text, '') = '' THEN 0
            ELSE len(string_split(seen.text, chr(10))) - coalesce(kept.n, 0) END AS BIGINT)
         AS n_dropped,
       CASE WHEN seen.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM seen LEFT JOIN kept USING (row_no)
"""
