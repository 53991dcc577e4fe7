"""Lines that several documents share, found by range-partitioned hashes; results are bitmaps of lines to keep.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. A key of at least
`least_chars` code points in at least `least_docs` documents keeps its lines in the greatest doc_id
that holds it, and loses all others. All of it is DataFrame and SQL functions.

1. Lines with a key that is long enough become rows of two 64-bit hashes of the key, the document and the
   line's number. Texts don't travel.
2. These rows are partitioned by ranges of (hash, document) and sorted by line within, so that the lines of
   a frequent key spread over as many partitions as they need. The stream of a partition gives the first occurrence
   in each document; first occurrences are summed by key in each partition before the sums meet.
3. Lines of frequent keys in other documents than the key's greatest one set bits; a document's bits are a list of
   64-bit words, and words without a set bit are left out. This is the result: bits of lines to drop, the
   rest is kept. `dedup_lines` applies it to the texts.

Lines of the `HOT_KEYS` most frequent keys meet them in a broadcast, so that no key gathers its lines in one task. All other
lines, and the texts and their bitmaps, meet by a shuffle whatever their size, so what moves grows as the table does.

Keys count as equal if both hashes are (128 bits).

Edge cases: a null or empty text is one empty line. Rows without an id count as one document, less than
any other; if it alone holds a key, nothing is dropped. Rows of equal id count as one document; each has its
own bitmap, by its text, and equal rows have equal ones. All lines of the greatest document stay, repeated ones
too. A document that loses all lines has an empty text. An empty table gives an empty one. A line or a text of any
length is read whole. Columns of the input may have any name; of them, the id (under its own name) is in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haatlake.llm.common import stage
from haatlake.sources.staging import Scratch

LEAST_CHARS, LEAST_DOCS = 20, 3
# The most frequent keys, of which a broadcast tells the lines.
HOT_KEYS = 200
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased. lower() would change other letters too."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _of(text: Column) -> Column:
    """What tells rows of equal id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def frequent_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """h1, h2 and the greatest document of each key in enough documents. lines: h1, h2, doc, pos."""
    return _counted_keys(lines, least_docs).drop("docs")


def _counted_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    ranged = lines.select("h1", "h2", "doc", "pos").repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos")
    nth = F.row_number().over(W.partitionBy("h1", "h2", "doc").orderBy("pos"))
    first = ranged.withColumn("nth", nth).where("nth = 1")
    return first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper")).where(F.col("docs") >= least_docs)


def lines_of(lines: DataFrame, keys: DataFrame, hot_keys: int = HOT_KEYS) -> DataFrame:
    """lines with the keeper of their key, without lines whose key is none of the keys. keys: h1, h2, docs, keeper; both are staged."""
    key = ["h1", "h2"]
    hot = F.broadcast(keys.orderBy(F.desc("docs"), *key).limit(hot_keys).select(*key, "keeper", F.lit(True).alias("hot")))
    cold = keys.join(hot.drop("keeper"), key, "left_anti").select(*key, "keeper")
    met = lines.join(hot, key, "left")
    return met.where("hot").drop("hot").unionByName(met.where("hot IS NULL").drop("hot", "keeper").join(cold.hint("merge"), key))


def drop_bitmaps(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc, of, n_dropped and bits of the rows that lose lines: structs of a word's number and its 64 bits, ascending."""
    spark = df.sparkSession
    each = df.select(df[doc_id].alias("doc"), _of(df[text]).alias("of"), F.posexplode(_lines(df[text])).alias("pos", "line"))
    keyed = each.select("doc", "of", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    hashes = F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(13), "key").alias("h2")
    with Scratch(spark) as scratch:
        lines = scratch(keyed.select("doc", "of", "pos", *hashes))
        frequent = scratch(_counted_keys(lines, least_docs))
        lost = lines_of(lines, frequent).where(~F.col("doc").eqNullSafe(F.col("keeper")))
        word, bit = F.expr("pos div 64").cast("int").alias("word"), F.expr("shiftleft(1L, cast(pos % 64 as int))")
        bits = lost.groupBy("doc", "of", word).agg(F.bit_or(bit).alias("bits"))
        lists = bits.groupBy("doc", "of").agg(F.sum(F.bit_count("bits")).alias("n_dropped"),
                                              F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("bits"))
        return stage(lists, "bitmaps")


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, kept: str = "kept") -> DataFrame:
    """doc_id, n_lines, n_dropped, bits (null: all lines stay) and the text of the lines kept, of every row."""
    found = drop_bitmaps(df, doc_id, text, least_chars, least_docs)
    rows = df.select(df[doc_id].alias("id"), df[text].alias("text"), _of(df[text]).alias("row_of"))
    met = rows.join(found.hint("merge"), F.col("id").eqNullSafe(F.col("doc")) & (F.col("row_of") == F.col("of")), "left")
    # Each step is a projection of its own, so that no array is made twice.
    split = met.select("id", "n_dropped", "bits", _lines(F.col("text")).alias("lines"), dropped_lines(F.col("bits")).alias("dropped"))
    return split.select(F.col("id").alias(doc_id), F.size("lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                        "bits", kept_lines(F.col("lines"), F.col("dropped")).alias(kept))


def dropped_lines(bits: Column) -> Column:
    """The numbers of the lines whose bits are set, ascending; null if there are none."""
    in_word = lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w["bits"], b) == 1), lambda b: w["word"] * 64 + b)
    return F.flatten(F.transform(bits, in_word))


def kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines that aren't dropped, joined by line feeds: between one dropped line and the next one lies a slice that stays."""
    ends = F.arrays_zip(F.concat(F.array(F.lit(-1)), dropped).alias("a"), F.concat(dropped, F.array(F.size(lines))).alias("b"))
    kept = F.flatten(F.transform(ends, lambda e: F.slice(lines, e["a"] + 2, e["b"] - e["a"] - 1)))
    return F.array_join(F.when(dropped.isNull(), lines).otherwise(kept), "\n")
