"""The registered queries of this package."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haatlake.llm import ann, collocations, fingerprints, langid, lines, pages, periods, quality, rollups, sharding
from haatlake.llm.bpe import encode
from haatlake.llm.common import in_bucket, stage, table
from haatlake.llm.jaccard import jaccard_components
from haatlake.llm.packing import pack
from haatlake.operators.winners import met
from haatlake.sources.staging import new_path


# What the two tokenizer versions of op7 count: words between ASCII white space; runs of word bytes, and other marks.
WORD, WORD_OR_MARK = r"[^ \t-\r]+", r"[^ \t-\r!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]"


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document's text, and the text they decode to, as digests."""
    return encode(table(spark, sf_dir, "documents"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"), keep=("doc_id",))


def op2_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2,048 tokens, a row for each piece."""
    return pack(table(spark, sf_dir, "documents"))


def op3_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, of at most 4 MiB of text."""
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, from the container paths its host agrees on."""
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from three of four buckets of ids."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~in_bucket("doc_id", 4, 2))
    rows = docs.select("doc_id", "text", in_bucket("doc_id", 4, 2).alias("held_out"))
    return langid.predict(rows, model, keep=("doc_id", "held_out"))


def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents were inserted, counted anew by a second tokenizer version, and copies deleted.

    Version 1 counts words between white space, version 2 words and marks, which SQL can count too; any other count,
    such as `bpe.encode`'s, goes the same way. Copies are the documents whose text occurs with a smaller id. Every batch is
    committed twice, the second time in another order.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = stage(docs.select("doc_id", "source", "lang", F.sha2(text, 256).alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("v1"),
                             F.regexp_count(text, F.lit(WORD_OR_MARK)).alias("v2")), "counts")
    # Only texts with a second copy are joined, and the rows of the most frequent ones stay where they are.
    first = stage(slim.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "copied")
    copies = met(slim, first, "digest", hot_rows=max(1_000, slim.count() // 100_000), whole=False).where("doc_id > first")
    batches = {
        "insert": (rollups.inserts(slim, "v1", slim["v1"]),),
        "recount": (rollups.revisions(slim, "v1", slim["v1"], "v2", slim["v2"]),),
        "copies": (rollups.deletes(copies, "v2", F.col("v2")),),
    }
    store = rollups.Rollup(spark, new_path(spark, "rollup"))
    for name in (*batches, "copies", "recount", "insert"):
        store.commit(name, *batches[name])
    return store.totals()


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from the labels of four of five buckets of ids."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~in_bucket("doc_id", 5, 0))
    rows = docs.select("doc_id", "text", in_bucket("doc_id", 5, 0).alias("held_out"))
    return quality.score(rows, model, keep=("doc_id", "held_out"))


def op9_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors["vec_id"] % 20 == 0)


def op10_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of near copies it belongs to."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def repeat_tail(words: list[bytes], row: dict) -> list[bytes]:
    """op11's contract: the words of every tenth document (by crc32 of its id; none without an id) repeat from some word on."""
    h, n = (1, 0) if row["doc_id"] is None else (zlib.crc32(str(row["doc_id"]).encode()), len(words))
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of words of every document, some of which were made to repeat."""
    return periods.periodic_runs(table(spark, sf_dir, "documents"), edit=repeat_tail)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language whose words are found together most, by their weakest cut."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that at least three documents share, dropped from all but the greatest one."""
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_bpe_round_trip, op2_pack_windows, op3_extendible_shards, op4_main_text, op5_multiset_fingerprints, op6_language_id,
    op7_token_rollups, op8_quality_scores,
    op9_adaptive_scan, op10_jaccard_components, op11_periodic_runs, op12_collocations, op13_line_dedup)}
ORACLE = {
    "op7_token_rollups": f"""
        WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
        f AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
        k AS (SELECT source, lang, len(regexp_extract_all(d.text, '{WORD_OR_MARK}')) AS n
              FROM d JOIN f ON d.text = f.text WHERE d.doc_id IS NULL OR f.first IS NULL OR d.doc_id <= f.first)
        SELECT source, lang, 'v2' AS version, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
        FROM k GROUP BY source, lang""",
    "op12_collocations": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{lines.UPPER}', '{lines.UPPER.lower()}'),
                                                                                     '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS words FROM p),
        g AS (SELECT lang, k, words, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k),
        f AS (SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
        t AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 100),
        s AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
        x AS (SELECT s.lang, s.k, s.phrase, a, cut, l.f AS l, r.f AS r, t.n,
                     1000 * a::HUGEINT * t.n::HUGEINT // (l.f::HUGEINT * r.f::HUGEINT) AS score
              FROM s JOIN t ON t.lang = s.lang
              JOIN f l ON l.lang = s.lang AND l.phrase = array_to_string(words[1:cut], ' ')
              JOIN f r ON r.lang = s.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
        b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        d AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.k > b.k AND 100 * c.a >= 100 * b.a
                                                AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
               CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM d QUALIFY rank <= 2000""",
    "op13_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
        k AS (SELECT doc_id, line, pos,
                     translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{lines.UPPER}', '{lines.UPPER.lower()}') AS key FROM l),
        f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT k.doc_id, line, pos, f.key IS NOT NULL AND k.doc_id < keeper AS dropped FROM k LEFT JOIN f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
}
