"""Benchmark decontamination by a distributed positional inverted index.

The index holds a posting (term, doc, position) for every place of a word that
the test items use. Each task writes the postings of its documents as a segment
of its own, sorted by term, so building it shuffles nothing. Phrases are then
found by intersecting offset-adjusted lists from the rarest term on: the list of
a phrase's rarest term gives places where it could start, the list of its second
rarest term thins them out, and the lists of the other terms, read only for
documents that are left, decide. A phrase with a term that no document has is
dropped before any list is read. ``near_matches`` finds phrases whose words
stand close together in any order from the same lists.

Everything is DataFrame expressions. Tables made from the test items (words,
phrases) and the set of documents left after two lists are broadcast only if they
are counted to be small (``SMALL`` rows); beyond that the same joins shuffle, and
a term, passage or document with very many postings is split by the keys
(doc, term, position) of the joins.

Defined cases: a null text has no words; a null item has none, and an item
without words occurs nowhere; rows that repeat keep their row each, also with
the same or without an id; items that share an item_id are one item; what an
item without item_id covers is hit, but there is no id to count or name; empty
tables give no rows, or documents that are clean; columns other than the id and
the text are not read.
"""

from __future__ import annotations

import uuid
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import cut, shared_folder, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window.
WINDOW = 10
#: Rows of a table that may be broadcast.
SMALL = 200_000
#: Stands before the words of a document and makes the posting of the document itself, with its number of words as position. No word is a blank.
HEAD, HEAD_TERM = " ", 0


def words_of(text: Column) -> Column:
    """The words of a text, with A-Z as a-z."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase), F.lit(WORD), F.lit(0))


def _small(df: DataFrame) -> DataFrame:
    """df, of rows already computed, to be broadcast if there are few."""
    return F.broadcast(df) if df.count() <= SMALL else df


def windows_of(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, phrase): every run of ``size`` words of each item, all words of an item that has fewer."""
    worded = items.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return worded.select("item_id", "words", F.explode(starts).alias("at")).select("item_id", F.slice("words", F.col("at"), size).alias("phrase"))


def numbered_phrases(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(phrase_id, phrase) of the distinct phrases, and (phrase_id, item_id) of what they come from."""
    phrases = cut(windows.select("phrase").distinct().withColumn("phrase_id", F.monotonically_increasing_id()))
    return phrases, windows.join(phrases, "phrase").select("phrase_id", "item_id").distinct()


def vocabulary(phrases: DataFrame) -> DataFrame:
    """(word, term): a number for every word of some phrases, and that of the postings of documents."""
    words = phrases.select(F.explode("phrase").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id() + HEAD_TERM + 1)
    return cut(words.unionByName(words.sparkSession.range(1).select(F.lit(HEAD).alias("word"), F.lit(HEAD_TERM).cast("long").alias("term"))))


def build_index(docs: DataFrame, known: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index (term, doc, position, doc_id) of the words in ``known`` (word, term).

    doc is a number of the row. The posting of HEAD_TERM is the document itself: it has doc_id, and its number of words as position.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("doc"), words_of(F.col(text_col)).alias("words"))
    placed = rows.select("doc_id", "doc", F.size("words").alias("n"), F.posexplode(F.concat(F.array(F.lit(HEAD)), "words")).alias("place", "word"))
    head = F.col("term") == HEAD_TERM
    postings = placed.join(_small(known), "word").select("term", "doc", F.when(head, F.col("n")).otherwise(F.col("place") - 1).alias("position"), F.when(head, F.col("doc_id")).alias("doc_id"))
    postings.sortWithinPartitions("term").write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def plans_of(index: DataFrame, known: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase_id, length, lists): the (n, offset, term) of each word of a phrase, those of the rarest terms first; phrases with a term without postings drop out."""
    counts = index.filter(F.col("term") > HEAD_TERM).groupBy("term").agg(F.count("*").alias("n"))
    parts = phrases.select("phrase_id", F.size("phrase").alias("length"), F.posexplode("phrase").alias("offset", "word")).join(known, "word").join(counts, "term")
    lists = parts.groupBy("phrase_id", "length").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("lists"))  # the words of one phrase
    return cut(lists.filter(F.size("lists") == F.col("length")))


def phrase_matches(index: DataFrame, known: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc, phrase_id, start, length): every exact occurrence of each phrase (phrase_id, phrase)."""
    postings = index.filter(F.col("term") > HEAD_TERM).select("term", "doc", "position")
    plans = _small(plans_of(index, known, phrases))
    nth = lambda k: plans.filter(F.col("length") >= k).select("phrase_id", "length", F.col("lists")[k - 1]["term"].alias("term"), F.col("lists")[k - 1]["offset"].alias("offset"))
    places = ["doc", "phrase_id", "start", "length"]
    first = postings.join(nth(1), "term").withColumn("start", F.col("position") - F.col("offset")).filter("start >= 0").select(*places)
    second = nth(2).drop("length")
    wanted = first.filter("length > 1").join(second, "phrase_id").withColumn("position", F.col("start") + F.col("offset"))
    rare = postings.join(_small(cut(second.select("term").distinct())), "term", "left_semi")
    both = cut(wanted.join(rare, ["doc", "term", "position"], "left_semi").select(*places))
    left = both.filter("length > 2")
    lists = postings.join(_small(cut(left.select("doc").distinct())), "doc", "left_semi")
    others = left.join(plans.select("phrase_id", F.slice("lists", 3, F.size("lists")).alias("others")), "phrase_id").select(*places, F.explode("others").alias("o"))
    others = others.select(*places, F.col("o.term").alias("term"), (F.col("start") + F.col("o.offset")).alias("position"))
    whole = others.join(lists, ["doc", "term", "position"], "left_semi").groupBy(*places).agg(F.count("*").alias("n")).filter("n = length - 2")
    return first.filter("length = 1").unionByName(both.filter("length = 2")).unionByName(whole.select(*places))


def near_matches(index: DataFrame, known: DataFrame, phrases: DataFrame, within: int = 20) -> DataFrame:
    """(doc, phrase_id, position): occurrences of the rarest word of a phrase with all its other words at most ``within`` words away, in any order.

    Lists meet by blocks of ``within + 1`` positions, so that the joins stay equi-joins.
    """
    block = lambda position: F.floor(position / (within + 1))
    postings = index.filter(F.col("term") > HEAD_TERM).select("term", "doc", "position")
    plans = plans_of(index, known, phrases).select("phrase_id", F.array_distinct(F.transform("lists", lambda x: F.struct(x["n"], x["term"]))).alias("terms"))
    plans = _small(cut(plans))
    here = postings.join(plans.select("phrase_id", F.size("terms").alias("n_terms"), F.col("terms")[0]["term"].alias("term")), "term").select("doc", "phrase_id", "n_terms", "position")
    places = ["doc", "phrase_id", "n_terms", "position"]

    def met(wanted: DataFrame, lists: DataFrame) -> DataFrame:
        """Rows (places, term) of ``wanted`` with a posting of the term close by."""
        around = F.sequence(block(F.col("position") - within), block(F.col("position") + within))
        a = wanted.select(*places, "term", F.explode(around).alias("block"))
        b = lists.select(F.col("doc").alias("b_doc"), F.col("term").alias("b_term"), F.col("position").alias("other"), block(F.col("position")).alias("b_block"))
        close = (F.col("doc") == F.col("b_doc")) & (F.col("term") == F.col("b_term")) & (F.col("block") == F.col("b_block")) & (F.abs(F.col("position") - F.col("other")) <= within)
        return a.join(b, close, "left_semi").drop("block").distinct()

    second = plans.filter(F.size("terms") > 1).select("phrase_id", F.col("terms")[1]["term"].alias("term"))
    rare = postings.join(_small(cut(second.select("term").distinct())), "term", "left_semi")
    both = cut(met(here.filter("n_terms > 1").join(second, "phrase_id"), rare).select(*places))
    left = both.filter("n_terms > 2")
    lists = postings.join(_small(cut(left.select("doc").distinct())), "doc", "left_semi")
    others = left.join(plans.select("phrase_id", F.slice("terms", 3, F.size("terms")).alias("others")), "phrase_id").select(*places, F.explode("others.term").alias("term"))
    whole = met(others, lists).groupBy(*places).agg(F.count("*").alias("n")).filter("n = n_terms - 2")
    return here.filter("n_terms = 1").unionByName(both.filter("n_terms = 2")).unionByName(whole.select(*places)).select("doc", "phrase_id", "position")


def covered(matches: DataFrame) -> DataFrame:
    """(doc, n_hit): words that lie in any occurrence."""
    order = Window.partitionBy("doc").orderBy("start", "length")
    before = F.coalesce(F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = matches.select("doc", "start", "length").distinct()
    new = F.greatest(F.col("start") + F.col("length") - F.greatest(F.col("start"), before), F.lit(0))
    return spans.withColumn("new", new).groupBy("doc").agg(F.sum("new").alias("n_hit"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    The index lies in the shared folder, where it can be read again.
    """
    phrases, sources = numbered_phrases(windows_of(items, size))
    known = vocabulary(phrases)
    index = build_index(docs, known, f"{shared_folder(docs.sparkSession)}/postings-{uuid.uuid4().hex}", id_col, text_col)
    matches = cut(phrase_matches(index, known, phrases))
    named = matches.select("doc", "phrase_id").distinct().join(_small(cut(sources)), "phrase_id").select("doc", F.col("item_id").cast("string").alias("item")).filter("item IS NOT NULL").distinct()
    items_of = named.groupBy("doc").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("names"))  # of one document
    heads = index.filter(F.col("term") == HEAD_TERM).select("doc", "doc_id", F.col("position").cast("long").alias("n_words"))
    found = heads.join(covered(matches), "doc", "left").join(items_of, "doc", "left").fillna(0, ["n_hit", "n_items"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, pos + 1, pos + {WINDOW}), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, 1))) AS pos FROM b WHERE len(w) > 0)),
runs AS (SELECT r, pos, n, array_to_string(list_slice(w, pos + 1, pos + n), ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS pos FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, pos, n, item_id FROM runs JOIN windows USING (n, phrase)),
covered AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS place FROM hits) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""
