"""Phrase collocations by fingerprints of prefix polynomials, checked against the text.

A text is lower-cased (A-Z), split into pieces at punctuation and line ends, and pieces into words at
spaces and tabs. f(phrase) counts a phrase's occurrences within pieces, overlapping ones too, by
language. Candidates are phrases of 2 to `longest` words with f >= least. A cut of a candidate into two
parts scores floor(1000 * f * words / (f(first) * f(rest))); its lowest cut counts, ties to the first.
Candidates inside a longer candidate of equal frequency are left out.

1. Fingerprints. In a block of texts of one language, the words' hashes are summed times powers of
   a base (Rabin-Karp, in numpy); differences of two prefixes give the fingerprint of any n words. Tasks
   add up equal fingerprints, and the shuffle adds the sums. Single words come first, then pairs whose words
   are both frequent, then longer phrases whose pairs are all frequent: a phrase is at most as frequent as any part.
   What is known to be frequent reaches tasks as a filter of FILTER bits, whatever its number; a
   false hit only lets more through.
2. Text. Tasks materialise a frequent phrase at pointers only: at one in POINTERS of its occurrences, once a task, so
   that a phrase doesn't come from every task. A fingerprint has 64 bits, and 16 further ones of another polynomial travel with it:
   where these differ, where pointers lead to unequal texts, and where no pointer was drawn, the text decides. The occurrences
   of these fingerprints are compared word by word, and counted by phrase instead. Phrases that agree in all 80 bits, and whose
   pointers all lead to one of them, would count as one.
3. Cuts and parts are joined with the table of frequent phrases; products are decimals of 38 digits.

Nothing is broadcast but the filters, and the number of words by language while it is small. Edge cases: a null text has no words; a null language counts as `und`; words of
texts without a frequent phrase still count in the total. Repeated rows count each. Ties of score and frequency
go by the phrase's bytes. An empty table gives an empty one; other columns of the input don't matter.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haatlake.llm.common import bit_filter, in_filter, stage, text_blocks
from haatlake.llm.hashing import LOWER, mix, powers, word_hashes
from haatlake.sources.staging import Scratch, bounded

LEAST, LONGEST, TOP = 100, 5, 2_000
UNKNOWN = "und"
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
# Characters of a block; fingerprints and phrases that a task holds before it passes them on.
CHARS, HELD, PHRASES = 2_000_000, 2_000_000, 200_000
# One in so many occurrences of a frequent phrase is a pointer to its text.
POINTERS = 8


class Grams:
    """The words of texts of one language, with fingerprints of any n words in a row."""

    def __init__(self, lang: str, texts: list[str]):
        self.raw = LOWER[np.frombuffer(("\n".join(texts) + "\n").encode("utf-8", "surrogatepass"), np.uint8)]
        cut = SEPARATOR[self.raw]
        self.raw[cut] = 0x20
        self.starts, self.ends, hashes = word_hashes(self.raw)
        self.piece = np.cumsum(cut, dtype=np.int32)[self.starts]
        self.size = hashes.size
        self.power, self.inverse = powers(self.size + 1)
        self.prefix, self.second = self._prefixes(hashes), None
        self.hashes = hashes
        self.seed = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))

    def _prefixes(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size + 1, np.uint64)
        np.cumsum(numbers * self.power[: self.size], out=out[1:])
        return out

    def more(self, at: np.ndarray, n: int) -> np.ndarray:
        """16 bits of another polynomial, whose numbers of words also have their lengths, first, middle and last bytes."""
        if self.second is None:
            size = (self.ends - self.starts).astype(np.uint64)
            parts = size, *(self.raw[i].astype(np.uint64) for i in (self.starts, (self.starts + self.ends) // 2, self.ends - 1))
            self.second = self._prefixes(mix(self.hashes * np.uint64(3) + sum(p << np.uint64(16 * k) for k, p in enumerate(parts))))
        return (mix((self.second[at + n] - self.second[at]) * self.inverse[at]) >> np.uint64(48)).astype(np.int32)

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the n words from each position on."""
        with np.errstate(over="ignore"):
            return mix((self.prefix[at + n] - self.prefix[at]) * self.inverse[at] + self.seed * np.uint64(2 * n + 1))

    def places(self, n: int, inner: int = 0, passed: np.ndarray | None = None) -> np.ndarray:
        """Where n words of one piece start whose parts of `inner` words all passed."""
        last = self.size - n + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        good = self.piece[:last] == self.piece[n - 1 :]
        for k in range(n - inner + 1 if passed is not None else 0):
            good &= passed[k : k + last]
        return np.flatnonzero(good)

    def passing(self, n: int, bits: np.ndarray, inner: int = 0, passed: np.ndarray | None = None) -> np.ndarray:
        """For each position whether the n words from it on are in the filter."""
        at = self.places(n, inner, passed)
        out = np.zeros(self.size, bool)
        out[at] = in_filter(bits, self.prints(at, n))
        return out

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes()

    def word_numbers(self) -> np.ndarray:
        """A number for each word, equal for equal bytes only: words of one hash are compared with the first of them."""
        size = self.ends - self.starts
        out, left, done = np.zeros(self.size, np.int64), np.arange(self.size), 0
        while left.size:
            _, first, number = np.unique(self.prints(left, 1), return_index=True, return_inverse=True)
            model = left[first][number]
            same = size[left] == size[model]
            begin = np.cumsum(size[left]) - size[left]
            step = np.arange(int(size[left].sum())) - np.repeat(begin, size[left])
            reach = np.minimum(np.repeat(self.starts[model], size[left]) + step, self.raw.size - 1)
            same &= np.logical_and.reduceat(self.raw[np.repeat(self.starts[left], size[left]) + step] == self.raw[reach], begin)
            out[left[same]] = done + number[same]
            done += first.size
            left = left[~same]
        return out

    def phrases(self, at: np.ndarray, n: int, numbers: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
        """Fingerprint, text and count of each phrase of n words that starts at one of the places."""
        while at.size:
            prints, pointer, group = np.unique(self.prints(at, n), return_index=True, return_inverse=True)
            model = at[pointer][group]
            same = np.logical_and.reduce([numbers[at + k] == numbers[model + k] for k in range(n)])
            count = np.bincount(group[same], minlength=pointer.size)
            for p, i, c in zip(prints.view(np.int64).tolist(), at[pointer].tolist(), count.tolist()):
                yield p, b" ".join(self.word(i + k) for k in range(n)), c
            at = at[~same]


def _by_lang(batch: pa.RecordBatch, texts: list[str]) -> Iterator[tuple[str, Grams]]:
    langs = batch.column("lang").to_pylist()
    for lang in dict.fromkeys(langs):
        yield lang, Grams(lang, [t for t, x in zip(texts, langs) if x == lang])


Held = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _sums(parts: Held) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, further bits, count: neighbours of equal fingerprint and bits are added up."""
    prints, bits, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(prints, kind="stable")
    prints, bits, counts = prints[order], bits[order], counts[order]
    first = np.flatnonzero(np.r_[True, (prints[1:] != prints[:-1]) | (bits[1:] != bits[:-1])])
    return prints[first], bits[first], np.add.reduceat(counts, first)


def _counted(docs: DataFrame, sizes: tuple[int, ...], known: Broadcast) -> DataFrame:
    """fp, n, mixed: fingerprints of phrases of these sizes, how often they occur, and whether further bits tell several apart.

    known: the filters of 1, 2 ... words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts: Held) -> pa.RecordBatch:
            prints, bits, counts = _sums(parts)
            return pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(counts << 16 | bits.astype(np.int64))], ["fp", "n_bits"])

        held, size = [], 0
        for batch, texts in text_blocks(batches, "text", CHARS):
            for _, grams in _by_lang(batch, texts):
                inner, passed = 0, None
                for k, bits in enumerate(known.value, 1):
                    inner, passed = k, grams.passing(k, bits, inner, passed)
                for n in sizes:
                    at = grams.places(n, inner, passed)
                    one = np.ones(at.size, np.int64)
                    if at.size:
                        held.append(_sums([(grams.prints(at, n), grams.more(at, n), one)]))
                        size += held[-1][0].size
            if size > HELD:
                held = [_sums(held)]
                size = held[0][0].size
                if 2 * size > HELD:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    bits = F.col("n_bits").bitwiseAND(F.lit((1 << 16) - 1))
    return docs.mapInArrow(run, "fp long, n_bits long").groupBy("fp").agg(
        F.sum(F.shiftright("n_bits", 16)).alias("n"), F.min(bits).alias("least"), F.max(bits).alias("most")).select("fp", "n", (F.col("least") != F.col("most")).alias("mixed"))


TEXT = "fp long, lang string, words int, phrase binary, n long"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["fp", "lang", "words", "phrase", "n"])


def _found(grams: Grams, filters: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each number of words the places of phrases that passed the filters of 1, 2, and more words."""
    passed = pairs = None
    for n in range(1, longest + 1):
        here = grams.passing(n, filters[min(n, 3) - 1], min(n - 1, 2), pairs if n > 2 else passed)
        passed, pairs = here, here if n == 2 else pairs
        yield n, np.flatnonzero(here)


def _pointed(docs: DataFrame, known: Broadcast, longest: int) -> DataFrame:
    """The text at pointers to frequent phrases; and a row of 0 words for each block, with its number of words as n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, texts in text_blocks(batches, "text", CHARS):
            rows: list[tuple] = []
            for lang, grams in _by_lang(batch, texts):
                rows.append((None, lang, 0, b"", grams.size))
                for n, at in _found(grams, known.value, longest):
                    prints = grams.prints(at, n)
                    drawn = mix(prints + mix(at.astype(np.uint64))) % np.uint64(POINTERS) == 0
                    prints, first = np.unique(prints[drawn], return_index=True)
                    for p, i in zip(prints.view(np.int64).tolist(), at[drawn][first].tolist()):
                        if p not in seen:
                            seen.add(p)
                            rows.append((p, lang, n, b" ".join(grams.word(i + k) for k in range(n)), 0))
            if len(seen) > PHRASES:  # what comes again later is the same text
                seen = set()
            if rows:
                yield _rows(rows)

    return docs.mapInArrow(run, TEXT)


def _by_text(docs: DataFrame, known: Broadcast, wanted: Broadcast, longest: int) -> DataFrame:
    """fp, lang, words, phrase, n of the phrases whose fingerprints are in the filter wanted, counted by text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch, texts in text_blocks(batches, "text", CHARS):
            for lang, grams in _by_lang(batch, texts):
                numbers = None
                for n, at in _found(grams, known.value, longest):
                    at = at[in_filter(wanted.value, grams.prints(at, n))]
                    if at.size:
                        numbers = grams.word_numbers() if numbers is None else numbers
                        for p, phrase, c in grams.phrases(at, n, numbers):
                            counts[p, lang, n, phrase] += c
            if len(counts) > PHRASES:
                yield _rows([(*k, c) for k, c in counts.items()])
                counts = Counter()
        if counts:
            yield _rows([(*k, c) for k, c in counts.items()])

    return docs.mapInArrow(run, TEXT).groupBy("fp", "lang", "words", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, words, phrase, n of every phrase of 1 to `longest` words that occurs `least` times in its language.

    A row of 0 words has the number of all words of a language. The table is in the shared folder.
    """
    spark = df.sparkSession
    send = spark.sparkContext.broadcast
    docs = df.select(df[text].alias("text"), F.coalesce(df[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"))
    with Scratch(spark) as scratch:
        filters: list[np.ndarray] = []
        tables = []
        for sizes in ((1,), (2,), tuple(range(3, longest + 1))):
            known = send(filters)
            tables.append(scratch(_counted(docs, sizes, known).where(F.col("n") >= least)))
            known.destroy()
            filters = [*filters, bit_filter(tables[-1], "fp")]
        known = send(filters)
        pointed = scratch(_pointed(docs, known, longest))
        texts = pointed.where("words > 0").select("fp", "lang", "words", "phrase").distinct()
        prints = tables[0].unionByName(tables[1]).unionByName(tables[2])
        state = scratch(prints.join(texts.groupBy("fp").agg(F.count(F.lit(1)).alias("texts")), "fp", "left"))
        clear = (F.col("texts") == 1) & ~F.col("mixed")
        named = state.where(clear).select("fp", "n").join(texts, "fp").select("lang", "words", "phrase", "n")
        totals = pointed.where("words = 0").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
        parts = [named, totals]
        rest = state.where(~F.coalesce(clear, F.lit(False))).select("fp")
        wanted = send(bit_filter(rest, "fp"))
        if wanted.value.any():
            parts.append(scratch(_by_text(docs, known, wanted, longest)).where(F.col("n") >= least).join(rest, "fp", "left_semi").select("lang", "words", "phrase", "n"))
        out = stage(reduce(DataFrame.unionByName, parts).withColumn("phrase", F.col("phrase").cast("string")), "phrases")
        for held in (known, wanted):
            held.destroy()
    return out


def _part(first: int | F.Column, size: int | F.Column) -> F.Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases."""
    table = frequent_phrases(df, text, lang, least, longest)
    known = table.where("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    phrases = table.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    k = F.col("k")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), k).alias("first"), _part(k + 1, F.col("words") - k).alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # A row for each language; beyond the bound the join shuffles.
    totals = bounded(table.where("words = 0").select("lang", F.col("n").alias("all_words")))
    big = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"(1000BD * {big('a')} * {big('all_words')}) div ({big('l')} * {big('r')})")
    # At most longest - 1 cuts of a phrase meet in its list.
    scored = cuts.join(totals, "lang").groupBy("lang", "phrase", "a", "all_words").agg(
        F.array_min(F.collect_list(F.struct(score.alias("score"), "k", "l", "r"))).alias("cut"))
    # A longer phrase of equal frequency around a phrase: then one with a single word more has it too.
    long = phrases.where("words > 2")
    around = long.select("lang", _part(F.lit(1), F.col("words") - 1).alias("phrase"), "a").unionByName(
        long.select("lang", _part(F.lit(2), F.col("words") - 1).alias("phrase"), "a"))
    kept = scored.join(around, ["lang", "phrase", "a"], "left_anti").select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                                                                         F.col("all_words").alias("n"), F.col("cut.score").alias("score"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return kept.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
