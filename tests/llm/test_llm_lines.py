"""Lines that documents share, against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from haatlake.llm import lines

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(lines.UPPER, lines.UPPER.lower())


def brute(rows, least_chars=20, least_docs=3):
    """(id, n_lines, n_dropped, kept text) of every row of (id, text)."""
    held = {}
    key = lambda line: line.strip(WHITE).translate(LOWER)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        each = (t or "").split("\n")
        stays = []
        for line in each:
            docs = held[key(line)]
            most = max((d for d in docs if d is not None), default=None)
            if len(key(line)) < least_chars or len(docs) < least_docs or i == most:
                stays.append(line)
        out.append((i, len(each), len(each) - len(stays), "\n".join(stays)))
    return out


def odd_rows():
    rng = random.Random(2)
    common = [f"A common line of the corpus, number {k}" for k in range(6)] + ["ÀÉ common line with Other Letters", "short one", "x" * 20, "X" * 19]
    rows = [(1, ""), (2, None), (3, "\n\n"), (4, common[0] + "\n"), (5, "  " + common[0].upper() + "\t\x0b\r"), (6, " " + common[0]), (None, common[0]), (None, common[1] + "\n" + common[0])]
    rows += [(20, f"{common[6]}\nmine alone\n{common[6]}"), (21, common[6].lower()), (22, common[6]), (23, common[6])]
    for i in range(30, 70):
        own = [f"a line that only document {i} holds {k}" for k in range(rng.randint(0, 90))]
        each = own + [rng.choice(common) for _ in range(rng.randint(0, 80))]
        rng.shuffle(each)
        rows.append((i, "\n".join(each)))
    return rows + [rows[-1], (30, common[2] + "\nanother text of the same id"), (69, "\n".join(common[2] for _ in range(5000)))]


@pytest.mark.parametrize("least", [(20, 3), (5, 2)])
def test_lines_equal_plain_python(spark, least):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, doc string, pos int, h1 long")
    got = lines.dedup_lines(df, least_chars=least[0], least_docs=least[1]).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got), key=str) == sorted(brute(rows, *least), key=str)


def test_ids_of_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(k, "a line of more than twenty letters\nx") for k in "abcd"], "of string, lines string")
    got = {r["of"]: r.kept for r in lines.dedup_lines(df, "of", "lines").collect()}
    assert got == {"a": "x", "b": "x", "c": "x", "d": "a line of more than twenty letters\nx"}
    assert lines.dedup_lines(df.limit(0), "of", "lines").count() == 0


def test_bits_are_compressed(spark):
    text = "\n".join(["own line %d" % k for k in range(640)] + ["a line that all documents share"] * 2)
    df = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    found = lines.drop_bitmaps(df).collect()
    assert sorted(r.doc for r in found) == [0, 1, 2]
    assert all([tuple(w) for w in r.bits] == [(10, 0b11)] and r.n_dropped == 2 for r in found)


def test_one_hot_line_spreads(spark):
    """A third of all lines has one key: its first occurrences lie in several partitions of the range."""
    df = spark.range(9000).select(F.lit(1).cast("long").alias("h1"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("h2"),
                                  F.col("id").alias("doc"), F.lit(0).alias("pos"))
    ranged = df.repartitionByRange(8, "h1", "h2", "doc").withColumn("part", F.spark_partition_id())
    assert ranged.where("h2 = 5").select("part").distinct().count() >= 2
    assert [tuple(r) for r in lines.frequent_keys(df, 3).collect()] == [(1, 5, 8997)]


def test_joins_do_not_change_with_the_size(spark):
    """Small tables meet by shuffles too, but for lines of the most frequent keys: what moves grows in proportion."""
    df = spark.createDataFrame(odd_rows(), "doc_id long, text string")
    plan = lines.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("hot_keys", [1, 3, 100])
def test_hot_keys_do_not_move(spark, hot_keys):
    rows = [(1, k, d, 0) for k, n in ((5, 900), (6, 500), (7, 30), (8, 2)) for d in range(n)] + [(1, 5, None, 3)]
    df = spark.createDataFrame(rows, "h1 long, h2 long, doc long, pos int")
    keys = spark.createDataFrame([(1, 5, 901, 899), (1, 6, 500, 499), (1, 7, 30, None)], "h1 long, h2 long, docs long, keeper long")
    got = lines.lines_of(df, keys, hot_keys)
    want = [(*r, {5: 899, 6: 499, 7: None}[r[1]]) for r in rows if r[1] != 8]
    assert sorted(map(str, got.select("h1", "h2", "doc", "pos", "keeper").collect())) == sorted(str(spark_row) for spark_row in spark.createDataFrame(
        want, "h1 long, h2 long, doc long, pos int, keeper long").collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
