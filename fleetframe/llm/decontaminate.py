"""Benchmark decontamination by a prefix-filtered join, with DataFrame functions alone.

An item's windows are its runs of `size` words (a shorter item is one window). A text is hit where it holds
all words of a window, in order. As the whole window must be there, its prefix under an order by rarity is
one shingle long: the rarest word. So the words of the corpus join the windows on that word alone, a
match fixes where the window would begin, bounds on position and length reject what cannot fit, and a
comparison of the words themselves decides. The words of a text are compared where they were exploded:
the text is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetframe.llm.common import BROADCAST_BYTES, named, read, row_key, staged, unused

SIZE = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words; upper-case letters are word characters until they are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def words_of(text: Column) -> Column:
    """Words with A-Z lowered; null for a null text."""
    return split_words(F.translate(text, UPPER, LOWER))


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(window_id, window, items): each distinct window once, with the ids of its items as strings.

    Items without words have no window. Items without id count under an empty id.
    """
    words = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                         words_of(F.col(text).cast("string")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)))
    rows = words.select("item", F.explode(F.transform(starts, lambda s: F.slice("words", s, size))).alias("window"))
    return (rows.groupBy("window").agg(F.collect_set("item").alias("items"))
            .select(row_key("window").alias("window_id"), "window", "items"))


def rarest_words(windows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """`windows` with `token` and `offset`: the word that is rarest in the corpus and where it first stands.

    Case outside A-Z is folded in the count and in the join; equal frequencies are ordered by the word.
    """
    spots = windows.select("window_id", F.posexplode("window").alias("offset", "word"))
    spots = spots.withColumn("token", F.lower("word"))
    vocabulary = spots.select("token").distinct()
    seen = docs.select(F.explode(F.split(F.lower(F.col(text)), SEPARATORS)).alias("token"))
    counted = seen.join(_hinted(vocabulary), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("window_id").orderBy(F.coalesce("n", F.lit(0)), "token", "offset")
    first = (spots.join(counted, "token", "left").withColumn("place", F.row_number().over(order))
             .where("place = 1").select("window_id", "token", "offset"))
    return windows.join(first, "window_id")


def _hinted(df: DataFrame) -> DataFrame:
    """Broadcast only after its size was measured; beyond the bound a shuffled join."""
    kept = staged(df, "bounded")
    sizes = [F.sum(F.length(F.to_json(F.struct(*kept.columns))))]
    return F.broadcast(kept) if (kept.agg(*sizes).first()[0] or 0) <= BROADCAST_BYTES else kept


def occurrences(docs: DataFrame, key: str, text: str, windows: DataFrame) -> DataFrame:
    """(key, start, stop, items) of each place where a text holds a window; `stop` is exclusive."""
    rarest = _hinted(rarest_words(windows, docs, text).select(
        "token", "offset", "window", F.size("window").alias("length"), "items"))
    cut = docs.select(F.col(key).alias("key"), words_of(F.col(text)).alias("words"))
    spread = cut.select("key", "words", F.posexplode("words").alias("position", "word"))
    begin = F.col("position") - F.col("offset")
    fits = (begin >= 0) & (begin + F.col("length") <= F.size("words"))
    same = F.slice("words", F.greatest(begin, F.lit(0)) + 1, F.col("length")) == F.col("window")
    return (spread.join(rarest, (F.lower("word") == F.col("token")) & fits & same)
            .select("key", begin.alias("start"), (begin + F.col("length")).alias("stop"), "items"))


def hit_summary(found: DataFrame) -> DataFrame:
    """Per key: n_hit, the words inside any occurrence, and `items`, the sorted ids of the items found."""
    spans = F.array_sort(F.collect_set(F.struct("start", "stop")))
    merged = F.aggregate(
        F.col("spans"), F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto")),
        lambda seen, span: F.struct(
            (seen["hit"] + F.greatest(F.lit(0), span["stop"] - F.greatest(span["start"], seen["upto"]))).alias("hit"),
            F.greatest(seen["upto"], span["stop"]).alias("upto")))
    grouped = found.groupBy("key").agg(spans.alias("spans"), F.collect_set("items").alias("sets"))
    return grouped.select("key", merged["hit"].cast("long").alias("n_hit"),
                          F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", size: int = SIZE) -> DataFrame:
    """Per row of `docs`: the `keep` columns, n_words, n_hit and `items`, the ids of the items found.

    Null and empty texts have no words. Rows equal in `keep` and text are judged alike; all rows stay.
    Without items, or without items that have words, nothing is hit.
    """
    source = docs.select(*keep, F.col(text).cast("string").alias("_text"), row_key(*keep, text).alias("_key"))
    windows = staged(item_windows(items, item_id, item_text, size), "windows")
    found = hit_summary(occurrences(source, "_key", "_text", windows))
    counted = source.select(*keep, "_key", F.coalesce(F.size(split_words(F.col("_text"))), F.lit(0)).cast("long").alias("n_words"))
    counted = counted.withColumn("n_words", F.greatest("n_words", F.lit(0).cast("long")))
    return (counted.join(found, F.col("_key") == F.col("key"), "left")
            .select(*keep, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def remove_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", max_share: float = 0.0) -> DataFrame:
    """`docs` without the rows of which more than `max_share` of the words are hit; columns unchanged.

    Rows with equal texts are judged alike, null texts stay. By default any occurrence of a window removes a text.
    """
    key = unused(docs, "_key")
    source = docs.withColumn(key, row_key(text))
    windows = staged(item_windows(items), "windows")
    found = hit_summary(occurrences(source.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_key", "_text", windows))
    found = found.select(F.col("key").alias(key), "n_hit")
    words = F.size(split_words(source[text]))
    removed = source.select(key, words.alias("n_words")).join(found, key).where(F.col("n_hit") > max_share * F.col("n_words"))
    return source.join((found if max_share <= 0 else removed).select(key).distinct(), key, "left_anti").select(*named(docs))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def hits_sql(docs: str) -> str:
    """DuckDB: `hits` (rid, place, item) with each hit word of the table `docs` (rid, text), and what it needs."""
    words = "regexp_extract_all(translate({}, '" + UPPER + "', '" + LOWER + "'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    return f"""
    item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words.format('text')} AS words FROM benchmark),
    windows AS (SELECT DISTINCT item, array_to_string(words[s:s + {SIZE - 1}], ' ') AS w, least(len(words), {SIZE}) AS n
                FROM (SELECT *, unnest(range(1, greatest(len(words) - {SIZE - 2}, 2))) AS s FROM item_words WHERE len(words) > 0)),
    doc_words AS (SELECT rid, {words.format('text')} AS words FROM {docs} WHERE text IS NOT NULL),
    runs AS (SELECT rid, s, n, array_to_string(words[s:s + n - 1], ' ') AS w
             FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS s
                   FROM doc_words, (SELECT DISTINCT n FROM windows))),
    hits AS (SELECT rid, unnest(range(s, s + r.n)) AS place, item FROM runs r JOIN windows USING (w, n))"""


OP5_SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
{hits_sql('docs')},
found AS (SELECT rid, count(DISTINCT place) AS n_hit, count(DISTINCT item) AS n_items,
                 string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY rid)
SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN doc_words USING (rid) LEFT JOIN found USING (rid)
"""
