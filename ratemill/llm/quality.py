"""Quality rules with the frequency of lines across documents (operator 9).

Counts inside a text give the base verdict. Then every line, normalised and hashed, is counted
over the documents of its host; equal texts count as one document, so that copies of a good page
do not condemn it. A line of more documents than the limit allows is removed wherever it stands
in that host, and a document that is left with too little is rejected.

Everything is DataFrame expressions. Null or empty text has no words and fails. A null host is a
host of its own, the same as the empty one. Rows with equal id, host and text get the same
verdict. Texts of any length are taken whole, as arrays of their words and lines in one row. A
line with exactly as many documents as the limit stays. An empty table gives no rows. Extra
columns, whatever their names, pass through ``clean`` and are left out of the verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill.llm.textkeys import id_back, id_text, text_key
from ratemill.session import new_scratch, written

WHITE = r"[\x20\x09-\x0D]+"
NO_WHITE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_percent: int = 50
    # A line is removed if more than so many documents of its host hold it.
    max_line_docs: int = 20
    # What must be left of a document.
    min_words_left: int = 50
    min_share_left: float = 0.3


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), WHITE, " "))


def _repeat_words(rows: DataFrame) -> DataFrame:
    """n_repeat_words of the words in ``_w``: how many lie in a window of three found again.

    The windows are hashed; only if a hash occurs twice are they sorted with their places. The
    places of repeated windows, in order, each add the words that the next one does not.
    """
    at = F.sequence(F.lit(0), F.size("_w") - 3)
    window = F.transform(at, lambda i: F.xxhash64(F.col("_w")[i], F.col("_w")[i + 1], F.col("_w")[i + 2]))
    rows = rows.withColumn("_h", F.when(F.size("_w") >= 4, window))
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    placed = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_s", F.when(repeats, placed))
    s, n = F.col("_s"), F.size("_s")
    again = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == s[k]["h"]))
        | ((k < n - 1) & (s[F.least(k + 1, n - 1)]["h"] == s[k]["h"])),
    )
    rows = rows.withColumn("_p", F.when(s.isNotNull(), F.sort_array(F.transform(again, lambda k: s[k]["i"]))))
    p = F.col("_p")
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size(p) - 2),
        F.lit(3).cast("long"),
        lambda total, k: total + F.least(F.lit(3), p[k + 1] - p[k]),
    )
    return rows.withColumn("n_repeat_words", F.when(p.isNotNull(), covered).otherwise(F.lit(0).cast("long")))


def line_table(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document: its key, its counts, and hash and number of words of each line."""
    rows = docs.select(
        id_text(docs[id_col]).alias("_id"),
        F.coalesce(docs[host_col].cast("string"), F.lit("")).alias("_host"),
        text_key(docs[text_col]).alias("_key"),
        F.coalesce(docs[text_col], F.lit("")).alias("_text"),
    )
    rows = rows.withColumn("_w", words(F.col("_text")))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(NO_WHITE)))
    rows = _repeat_words(rows)
    hashed = F.transform("_lines", lambda x: F.struct(F.xxhash64(normalised(x)).alias("h"), F.size(words(x)).alias("n")))
    return rows.select(
        "_id",
        "_host",
        "_key",
        F.size("_w").cast("long").alias("n_words"),
        F.aggregate("_w", F.lit(0).cast("long"), lambda total, x: total + F.char_length(x)).alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        hashed.alias("_lines"),
    )


def frequent_lines(table: DataFrame, limits: Limits) -> DataFrame:
    """(_host, h): the lines over the limit."""
    texts = table.groupBy("_host", "_key").agg(F.first("_lines").alias("_lines"))
    lines = texts.select("_host", "_key", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["h"]))).alias("h"))
    found = lines.groupBy("_host", "h").agg(F.count("*").alias("docs"))
    return found.where(F.col("docs") > limits.max_line_docs).select("_host", "h")


def verdicts(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits = Limits()) -> DataFrame:
    """Counts and verdict of every row, with the hashes of its removed lines in ``removed``.

    Besides the counts the rows hold ``_id``, ``_host`` and ``_key``.
    """
    table = written(line_table(docs, id_col, text_col, host_col), new_scratch(docs.sparkSession, "lines"))
    over = frequent_lines(table, limits)
    lines = table.select("_id", "_host", "_key", F.explode("_lines").alias("line")).select("_id", "_host", "_key", "line.h")
    hits = lines.join(over, ["_host", "h"])
    by_doc = hits.groupBy("_id", "_host", "_key").agg(F.collect_set("h").alias("removed"))
    rows = table.join(by_doc, ["_id", "_host", "_key"], "left")
    removed = F.coalesce("removed", F.array().cast("array<bigint>"))
    rows = rows.withColumn("removed", removed)
    gone = F.filter("_lines", lambda x: F.array_contains("removed", x["h"]))
    left = F.col("n_words") - F.when(F.size("removed") > 0, F.aggregate(gone, F.lit(0), lambda total, x: total + x["n"])).otherwise(0)
    base_failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    rows = rows.withColumn("words_left", left).withColumn("base_failed", base_failed)
    depleted = (F.col("words_left") < limits.min_words_left) | (F.col("words_left") < F.col("n_words") * limits.min_share_left)
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("_lines")


def quality_rules(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits = Limits()) -> DataFrame:
    """The verdict of every row with its id."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = verdicts(docs, id_col, text_col, host_col, limits)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_left"]
    return rows.select(id_back(F.col("_id"), id_type).alias(id_col), *names)


def clean(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits = Limits()) -> DataFrame:
    """The kept rows, without their removed lines; same columns."""
    kept = verdicts(docs, id_col, text_col, host_col, limits).where("kept")
    kept = kept.select("_id", "_host", "_key", "removed").dropDuplicates(["_id", "_host", "_key"])
    rows = docs.select(
        F.struct("*").alias("_row"),
        id_text(docs[id_col]).alias("_id"),
        F.coalesce(docs[host_col].cast("string"), F.lit("")).alias("_host"),
        text_key(docs[text_col]).alias("_key"),
    )
    rows = rows.join(kept, ["_id", "_host", "_key"])
    text = F.col("_row")[text_col]
    stays = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains("removed", F.xxhash64(normalised(x))) | ~x.rlike(NO_WHITE))
    rows = rows.withColumn("_text", F.when(F.size("removed") > 0, F.array_join(stays, "\n")).otherwise(text))
    return rows.select(*(F.col("_text").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT *, list_filter(string_split_regex(text, '{WHITE}'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{NO_WHITE}')) AS ls
  FROM d),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
twice AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (doc_id, g))
  GROUP BY doc_id),
line AS (
  SELECT doc_id, host, text, trim(regexp_replace(lower(l), '{WHITE}', ' ', 'g')) AS k,
    len(list_filter(string_split_regex(l, '{WHITE}'), lambda x: x <> '')) AS n
  FROM (SELECT doc_id, host, text, unnest(ls) AS l FROM t)),
over AS (
  SELECT host, k FROM (SELECT host, k, count(DISTINCT text) AS docs FROM line GROUP BY ALL)
  WHERE docs > {Limits.max_line_docs}),
gone AS (SELECT doc_id, sum(n)::BIGINT AS n FROM line JOIN over USING (host, k) GROUP BY doc_id),
c AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(w)::BIGINT - coalesce(gone.n, 0)::BIGINT AS words_left
  FROM t LEFT JOIN rep ON rep.doc_id = t.doc_id LEFT JOIN gone ON gone.doc_id = t.doc_id)
SELECT *, n_words < {Limits.min_words} OR 100 * n_repeat_words > {Limits.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {Limits.min_words} OR 100 * n_repeat_words > {Limits.max_repeat_percent} * n_words)
  AND words_left >= {Limits.min_words_left} AND words_left >= n_words * {Limits.min_share_left} AS kept
FROM c
"""
