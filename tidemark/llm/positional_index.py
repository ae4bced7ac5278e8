"""Benchmark passages in a corpus by a positional inverted index, with DataFrame operations alone.

The index is a stored table of postings (row, pos, term) of the terms that occur in the benchmark, and a header for each
document. A phrase is looked up from its rarest term, as counted in the index: that term's postings, less its offset in the
phrase, are where the phrase may begin. These lists are intersected with the second rarest term's, equally adjusted, and what
is left, very little, with those of all further terms together. So each step is a join of equal positions, whose cost is the
length of the lists and not their product, and no text is moved.

Postings are keyed by document and position, so a frequent term or a very long document is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import few, forget, stored

#: A word, after A-Z are lower-cased: ASCII letters and digits, and all other characters from 0x80 on.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window.
WINDOW = 10
#: The term of the header of a document; a word is never empty.
HEADER = ""


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def vocabulary(items: DataFrame) -> DataFrame:
    """Stored (word, term): a number for each word of ``items`` (text), 0 for the header."""
    found = items.select(F.explode(words(F.col("text"))).alias("word")).distinct()
    numbered = found.select("word", (F.monotonically_increasing_id() + 1).alias("term"))
    header = items.sparkSession.createDataFrame([(HEADER, 0)], "word string, term long")
    return stored(numbered.unionByName(header), "vocabulary")


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored postings of ``terms`` (see ``vocabulary``) in ``docs`` (doc_id, text): (row, pos, term, doc_id, n_words).

    row: a number of the document's row; pos: the word's place from 1. A document's header has pos 0 and term 0, and only there
    doc_id and n_words are given.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("words"))
    placed = rows.select("row", "doc_id", F.size("words").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(HEADER)), "words")).alias("pos", "word"))
    first = F.col("pos") == 0
    placed = placed.withColumns({"doc_id": F.when(first, F.col("doc_id")), "n_words": F.when(first, F.col("n_words").cast("long"))})
    return stored(placed.join(few(terms), "word").select("row", "pos", "term", "doc_id", "n_words"), "postings")


def frequencies(postings: DataFrame) -> DataFrame:
    """Stored (term, n): how often each term occurs."""
    return stored(postings.where("pos > 0").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "frequencies")


def phrases(items: DataFrame, terms: DataFrame, counted: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Stored (phrase, length, terms) and (phrase, item_id): the distinct windows of the items, and whose they are.

    A window is ``window`` words in a row, or all words of an item that has fewer, but not none. terms: (n, offset, term) of
    each word, rarest first. Windows with a word that the corpus lacks are left out.
    """
    split = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    sliced = split.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, window))).alias("words"))
    owners = sliced.select(F.sha2(F.concat_ws(" ", "words"), 256).alias("phrase"), "item_id", "words")
    distinct = owners.groupBy("phrase").agg(F.first("words").alias("words"))
    placed = distinct.select("phrase", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
    placed = placed.join(few(terms), "word").join(few(counted), "term")
    ranked = placed.groupBy("phrase", "length").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("terms"))
    return stored(ranked.where(F.size("terms") == F.col("length")), "phrases"), stored(owners.select("phrase", "item_id").distinct(), "owners")


def occurrences(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored (phrase, length, row, start): where the phrases (phrase, length, terms), see ``phrases``, occur exactly."""
    lists = postings.where("pos > 0").select("row", "pos", "term")
    # The list of the rarest term, less its offset.
    rarest = few(wanted.select("phrase", "length", "terms", F.col("terms")[0]["term"].alias("term"), F.col("terms")[0]["offset"].alias("offset")))
    begun = lists.join(rarest, "term").select("phrase", "length", "terms", "row", (F.col("pos") - F.col("offset")).alias("start")).where("start > 0")
    begun = stored(begun.drop("terms"), "begun")
    # Intersected with that of the second rarest.
    second = stored(wanted.where("length > 1").select("phrase", F.col("terms")[1]["term"].alias("term"), F.col("terms")[1]["offset"].alias("offset")), "second")
    asked = begun.where("length > 1").join(few(second), "phrase")
    asked = asked.select("phrase", "length", "row", "start", "term", (F.col("start") + F.col("offset")).alias("pos"))
    rest = lists.join(few(second.select("term").distinct()), "term", "left_semi")
    pairs = stored(asked.join(rest, ["row", "pos", "term"]).select("phrase", "length", "row", "start"), "pairs")
    # And with those of all others: as many must be met as there are.
    others = wanted.where("length > 2").select("phrase", F.inline(F.slice("terms", 3, F.greatest(F.col("length") - 2, F.lit(1)))))
    asked = pairs.where("length > 2").join(few(stored(others, "others")), "phrase")
    asked = stored(asked.select("phrase", "length", "row", "start", "term", (F.col("start") + F.col("offset")).alias("pos")), "asked")
    met = lists.join(few(asked), ["row", "pos", "term"]).groupBy("phrase", "length", "row", "start").agg(F.count(F.lit(1)).alias("met"))
    whole = met.where(F.col("met") == F.col("length") - 2).drop("met")
    short = begun.where("length = 1").unionByName(pairs.where("length = 2"))
    found = stored(whole.unionByName(short), "occurrences")
    forget(begun, second, pairs, asked)
    return found


def words_hit(found: DataFrame) -> DataFrame:
    """(row, n_hit): how many words of each document lie in an occurrence (row, start, length)."""
    spans = found.select("row", "start", (F.col("start") + F.col("length")).alias("end")).repartition("row")
    spans = spans.groupBy("row", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    new = F.greatest(F.col("end") - F.greatest("start", reached), F.lit(0))
    return spans.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256 and contaminated (n_hit > 0).

    ``items``: item_id, text. n_hit: words of the document inside an occurrence of a window of an item; n_items: distinct
    item_ids with a window that occurs; items_sha256: of these, sorted as strings and parted by commas. Null texts have no
    words; items without words have no windows. A null item_id can be hit but isn't counted or listed; rows that repeat an
    item_id are one item. Rows that repeat a doc_id, also a null one, are documents of their own. Empty tables: no documents
    give no rows, no items leave all clean. Other columns aren't read.
    """
    terms = vocabulary(items)
    postings = index(docs.select("doc_id", "text"), terms)
    counted = frequencies(postings)
    wanted, owners = phrases(items.select("item_id", "text"), terms, counted, window)
    found = occurrences(postings, wanted)
    named = found.select("phrase", "row").distinct().join(few(owners), "phrase").where("item_id IS NOT NULL")
    named = named.select("row", F.col("item_id").cast("string").alias("item")).distinct()
    listed = named.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    sums = stored(words_hit(found).join(listed, "row", "left"), "hits")
    headers = postings.where("pos = 0").select("row", "doc_id", "n_words")
    out = headers.join(few(sums), "row", "left")
    none = F.array().cast("array<string>")
    n_hit, items_of = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", none)
    out = out.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_of), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
    out = stored(out, "contamination")
    forget(terms, postings, counted, wanted, owners, found, sums)
    return out


def near(postings: DataFrame, queries: DataFrame, span: int) -> DataFrame:
    """Proximity matches: (query, row, start, end) of the stretches of at most ``span`` words that hold all of a query's terms.

    ``queries``: (query, term), terms as in the vocabulary; repeated ones count once. A stretch begins and ends with a
    term of the query and holds no shorter one with the same end. Like a phrase, a query is looked up from its rarest
    term; the other terms' postings are taken only near those. A query with a term that the corpus lacks matches nothing.
    """
    if span < 1:
        raise ValueError("a stretch has at least one word")
    lists = postings.where("pos > 0").select("row", "pos", "term")
    terms = stored(queries.distinct(), "terms")
    counts = lists.join(few(terms.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ranked = terms.join(counts, "term", "left").groupBy("query").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("first"), F.count(F.lit(1)).alias("size")
    )
    ranked = stored(ranked.where("first.n > 0").select("query", F.col("first.term").alias("term"), "size"), "rarest")
    # Blocks of ``span`` words: all others of a stretch lie in the block of the rarest term's posting or beside it.
    own = F.floor(F.col("pos") / span)
    anchors = lists.join(few(ranked), "term").select("query", "size", "row", own.alias("own")).distinct()
    asked = anchors.select("query", "size", "row", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)).alias("block")).distinct()
    placed = lists.withColumn("block", own).join(few(terms), "term").join(asked, ["query", "row", "block"])
    # From each posting as the end back to the last one of every term; a window holds the words of a document at most.
    back = Window.partitionBy("query", "row").orderBy("pos").rangeBetween(-(span - 1), 0)
    seen = placed.select("query", "row", "size", "pos", F.collect_list(F.struct("pos", "term")).over(back).alias("seen"))
    names = F.array_distinct(F.transform("seen", lambda x: x["term"]))
    whole = seen.withColumn("names", names).where(F.size("names") == F.col("size"))
    latest = F.transform("names", lambda t: F.array_max(F.transform(F.filter("seen", lambda x: x["term"] == t), lambda x: x["pos"])))
    ends = whole.select("query", "row", F.array_min(latest).alias("start"), F.col("pos").alias("end"))
    # Of stretches with the same start the shortest, so none holds another.
    out = stored(ends.groupBy("query", "row", "start").agg(F.min("end").alias("end")), "near")
    forget(terms, ranked)
    return out

