"""Line dedup by site-relative frequency.

For each site: the share of its pages that hold a line. Lines above the boilerplate ratio are dropped from
all pages of that site. By rows (`boilerplate`), sites with few pages have no boilerplate: two pages cannot tell.
By texts (`repeated_lines`), share and number of pages depend on the length of the line, down to two pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.llm import minhash
from fleetframe.llm.common import BROADCAST_BYTES, named, read, row_key, settled, staged, unused

RATIO = 0.02
MIN_PAGES = 10
#: Lines of more words than this are of the middle length, or long; a word is at most 8 characters here, so
#: that scripts without blanks have long lines too.
MIDDLE_WORDS, LONG_WORDS = 20, 50
#: (pages, share of the site's pages) of a line: both must be reached, the share exceeded.
MIDDLE, LONG = (3, 0.005), (2, 0.0)
#: Short lines also go, whatever the size of the site, from two pages on if they are on more than half of all.
MOST = (2, 0.5)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_id(line: Column) -> Column:
    """128 bits of a line without the white space around it; null for a blank line."""
    plain = F.regexp_replace(line, r"\A[ \t\r]+|[ \t\r]+\z", "")
    return F.when(plain != "", F.concat(F.hex(F.xxhash64(plain)), F.hex(F.xxhash64(plain, F.lit("line")))))


def page_id(text: Column) -> Column:
    """128 bits of a page's text; null texts share one."""
    return F.concat(F.hex(F.xxhash64(text)), F.hex(F.xxhash64(text, F.lit("page"))))


def line_words(line: Column) -> Column:
    plain = F.regexp_replace(line, r"\A[ \t\r]+|[ \t\r]+\z", "")
    return F.greatest(F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1, F.ceil(F.length(plain) / 8))


def boilerplate(docs: DataFrame, site: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, line, n_pages, share) of the lines that more than `ratio` of the site's pages hold.

    A page counts a line once. `min_pages` pages must hold it: below that a repeated line is no template.
    Null sites form one site of their own; null texts are pages without lines.
    """
    source = docs.select(F.col(site).alias("site"), F.col(text).cast("string").alias("text"))
    ids = F.array_distinct(F.transform(lines_of(F.col("text")), line_id))
    pages = source.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    counted = (source.select("site", F.explode(ids).alias("line")).where(F.col("line").isNotNull())
               .groupBy("site", "line").agg(F.count(F.lit(1)).alias("n_pages"))
               .where(F.col("n_pages") >= min_pages))
    return (counted.join(pages.withColumnRenamed("site", "own_site"), F.col("site").eqNullSafe(F.col("own_site")))
            .where(F.col("n_pages") > ratio * F.col("pages"))
            .select("site", "line", "n_pages", (F.col("n_pages") / F.col("pages")).alias("share")))


def repeated_lines(docs: DataFrame, site: str, text: str) -> DataFrame:
    """(site, line) of the lines that go when distinct texts are counted, by the length of the line.

    Short lines: MIN_PAGES texts and RATIO of the site's, or MOST. Longer lines: MIDDLE, LONG. But for
    short lines by MIN_PAGES, near copies among the pages that hold such a line count as one page: else two
    versions of a document would empty each other before near-dedup can keep one.
    """
    source = docs.select(F.col(site).alias("site"), F.col(text).cast("string").alias("text"))
    source = source.withColumn("page", page_id(F.col("text")))
    entry = F.transform(lines_of(F.col("text")), lambda x: F.struct(line_id(x).alias("line"), line_words(x).alias("words")))
    # The ids of the lines are moved, not the texts.
    pages = source.select("site", "page", F.array_distinct(entry).alias("entries")).dropDuplicates(["site", "page"])
    total = pages.groupBy(F.col("site").alias("own_site")).agg(F.count(F.lit(1)).alias("pages"))
    kind = F.when(F.col("e.words") > LONG_WORDS, 2).when(F.col("e.words") > MIDDLE_WORDS, 1).otherwise(0)
    lines = (pages.select("site", "page", F.explode("entries").alias("e")).where(F.col("e.line").isNotNull())
             .select("site", "page", F.col("e.line").alias("line"), kind.alias("kind")))
    counted = (lines.groupBy("site", "line", "kind").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
               .join(total, F.col("site").eqNullSafe(F.col("own_site"))).drop("own_site"))

    def by_length(n: Column) -> Column:
        small, middle, long = (((F.col("kind") == k) & (n >= least) & (n > share * F.col("pages")))
                               for k, (least, share) in enumerate((MOST, MIDDLE, LONG)))
        return small | middle | long

    template = (F.col("kind") == 0) & (F.col("n") >= MIN_PAGES) & (F.col("n") > RATIO * F.col("pages"))
    judged = staged(counted.withColumn("template", template).where(F.col("template") | by_length(F.col("n"))), "repeated-lines")
    found = judged.where("template").select("site", "line")
    rest = judged.where("NOT template").select(F.col("site").alias("of"), F.col("line").alias("own"), "pages")
    size = rest.count()
    if not size:
        return found
    sought = F.broadcast(rest) if size * 80 <= BROADCAST_BYTES else rest
    held = staged(lines.join(sought, F.col("site").eqNullSafe(F.col("of")) & (F.col("line") == F.col("own"))).drop("of", "own"), "held-lines")
    wanted = held.select("page").distinct()
    near = F.broadcast(wanted) if wanted.count() * 80 <= BROADCAST_BYTES else wanted
    texts = staged(source.join(near, "page", "left_semi").dropDuplicates(["page"]).select("page", "text"), "held-texts")
    copies = minhash.near_duplicates(texts, "page", "text").select(F.col("doc_id").alias("page"), "component_id")
    units = held.join(copies, "page").groupBy("site", "line", "kind", "pages").agg(F.count_distinct("component_id").alias("units"))
    return found.union(units.where(by_length(F.col("units"))).select("site", "line"))


def drop_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped: str = "n_dropped", found: Callable[[], DataFrame] | None = None) -> DataFrame:
    """`docs` with boilerplate lines taken out of `text`; `dropped` is added, the number of lines that went.

    Kept lines stay as they are, in their order, joined by a line feed; blank lines are never boilerplate. A
    text without boilerplate is unchanged, null stays null, a text of boilerplate alone becomes empty.
    `found` makes the lines as (site, line); else `boilerplate` finds them, with repeated rows as pages of their
    own. The other columns pass through, whatever their names; one that is named as `dropped` gives way to it.
    """
    if dropped in docs.columns:
        docs = docs.drop(dropped)
    make = found or (lambda: boilerplate(docs, site, text, ratio, min_pages))
    found = settled(docs.sparkSession, "boilerplate", lambda: make().select("site", "line"))
    lines_name = unused(docs, "_lines")
    if found.count() * 80 <= BROADCAST_BYTES:
        # For each site at most 1/ratio times the lines of a mean page.
        of = unused(docs, "_of")
        lists = found.groupBy(F.col("site").alias(of)).agg(F.collect_set("line").alias(lines_name))
        joined = docs.join(F.broadcast(lists), docs[site].eqNullSafe(lists[of]), "left").drop(of)
    else:
        joined = _by_shuffle(docs, found, site, text, lines_name)
    lines, listed = lines_of(joined[text]), joined[lines_name]
    kept = F.filter(lines, lambda x: F.coalesce(~F.array_contains(listed, line_id(x)), F.lit(True)))
    kept_name = unused(joined, "_kept")
    cut = joined.withColumn(kept_name, F.when(listed.isNotNull() & joined[text].isNotNull(), kept))
    gone = F.when(cut[kept_name].isNull(), 0).otherwise(F.size(lines_of(cut[text])) - F.size(cut[kept_name])).cast("long")
    cleaned = F.when(cut[kept_name].isNull() | (gone == 0), cut[text]).otherwise(F.array_join(cut[kept_name], "\n"))
    return cut.select(*[c if n != text else cleaned.alias(text) for n, c in zip(docs.columns, named(cut, *docs.columns), strict=True)],
                      gone.alias(dropped))


def _by_shuffle(docs: DataFrame, found: DataFrame, site: str, text: str, lines_name: str) -> DataFrame:
    """For lists beyond a broadcast: the boilerplate lines of each row are joined line by line."""
    row, of = unused(docs, "_row"), unused(docs, "_of")
    ids = F.array_distinct(F.transform(lines_of(docs[text]), line_id))
    own = docs.select(row_key(site, text).alias(row), docs[site].alias(of), F.explode(ids).alias("own")).distinct()
    lists = (own.join(found, F.col(of).eqNullSafe(F.col("site")) & (F.col("own") == F.col("line")))
             .groupBy(row).agg(F.collect_set("own").alias(lines_name)))
    return docs.withColumn(row, row_key(site, text)).join(lists, row, "left").drop(row)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source: lines, dropped lines and the digest of the text that stays."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cleaned = drop_boilerplate(docs.withColumn("n_lines", F.coalesce(F.size(lines_of(F.col("text"))), F.lit(0)).cast("long")))
    return cleaned.select("doc_id", "n_lines", "n_dropped",
                          F.length("text").cast("long").alias("n_chars_kept"),
                          F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM documents),
pages AS (SELECT source, count(*) AS pages FROM docs GROUP BY source),
lines AS (SELECT rid, source, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS place FROM docs WHERE text IS NOT NULL),
plain AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM lines),
counted AS (SELECT source, bare, count(DISTINCT rid) AS n FROM plain WHERE bare <> '' GROUP BY source, bare),
found AS (SELECT c.source, c.bare FROM counted c JOIN pages p ON c.source IS NOT DISTINCT FROM p.source
          WHERE n >= {MIN_PAGES} AND n > {RATIO} * pages),
judged AS (SELECT l.*, f.bare IS NOT NULL AS dropped FROM plain l
           LEFT JOIN found f ON l.source IS NOT DISTINCT FROM f.source AND l.bare = f.bare),
made AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
                coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '') AS kept
         FROM judged GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CASE WHEN text IS NOT NULL THEN length(kept) END AS n_chars_kept, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN made USING (rid)
"""
