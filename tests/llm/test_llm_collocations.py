"""Collocations against plain Python."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from haatlake.llm import collocations as coll

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, least, longest=5, top=2000):
    f, words = {}, Counter()
    for lang, text in rows:
        counts = f.setdefault(lang or "und", Counter())
        for piece in pieces(text):
            words[lang or "und"] += len(piece)
            for n in range(1, longest + 1):
                counts.update(tuple(piece[i : i + n]) for i in range(len(piece) - n + 1))
    out = []
    for lang, counts in f.items():
        found = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((floor(Fraction(1000 * a * words[lang], counts[p[:k]] * counts[p[k:]])), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return sorted(out)


def odd_rows(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(25)] + ["É", "é", "\x1c", "ab", "AB"]
    fixed = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 7))] for _ in range(8)]
    rows = [("en", None), (None, ""), (None, "x y. x y"), ("en", "\t \t"), ("xx", "...!?"), ("en", "tab\tand  two   spaces" + "\x0btab and\x0ctwo spaces\r") ]
    for k in range(150):
        words = []
        for _ in range(rng.randint(1, 20)):
            words += rng.choice(fixed) if rng.random() < 0.4 else [rng.choice(vocabulary)]
            words[-1] += rng.choice(["", "", "", ".", ",", "\n", "  ", "\t"])
        rows.append((rng.choice(["en", "de", None]), " ".join(words)))
    return rows + rows[-20:]


@pytest.mark.parametrize("least,longest,top", [(6, 5, 2000), (3, 4, 7), (1, 5, 2000)])
def test_equals_plain_python(spark, least, longest, top):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(5)
    got = sorted(map(tuple, coll.collocations(df, least=least, longest=longest, top=top).collect()))
    assert got == brute(rows, least, longest, top) and got


def test_empty_table(spark):
    df = spark.createDataFrame([("en", "a b")], "lang string, text string")
    assert coll.collocations(df).count() == 0 and coll.collocations(df.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 3, 64])
def test_collisions_are_told_apart_by_text(monkeypatch, bits):
    """Fingerprints of few bits, or of none, still give exact phrases."""
    mix = coll.mix
    monkeypatch.setattr(coll, "mix", lambda h: mix(h) & np.uint64((1 << bits) - 1))
    texts = [t for _, t in odd_rows(9) if t]
    grams = coll.Grams("en", texts)
    numbers = grams.word_numbers()
    for n in range(1, 6):
        got = Counter()
        for _, phrase, c in grams.phrases(grams.places(n), n, numbers):
            got[phrase.decode()] += c
        want = Counter(" ".join(p[i : i + n]) for t in texts for p in pieces(t) for i in range(len(p) - n + 1))
        assert got == want


def test_tasks_pass_on_what_they_hold():
    parts = [(np.array([3, 5, 9], np.uint64), np.array([0, 0, 0]), np.array([1, 1, 2])), (np.array([5, 7, 9], np.uint64), np.array([0, 0, 1]), np.array([4, 1, 1]))]
    prints, bits, counts = coll._sums(parts)
    assert prints.tolist() == [3, 5, 7, 9, 9] and bits.tolist() == [0, 0, 0, 0, 1] and counts.tolist() == [1, 5, 1, 2, 1]


def test_further_bits_tell_words_apart():
    grams = coll.Grams("en", ["alpha beta alpha beta gamma, alpha beta"])
    grams.prefix[:] = 0  # all fingerprints collide
    at = grams.places(2)
    assert len(set(grams.prints(at, 2).tolist())) == 1 and len(set(grams.more(at, 2).tolist())) == 3


@pytest.mark.parametrize("bits", [4, 7])
def test_collided_fingerprints_are_counted_by_text(spark, bits):
    """In the tasks, fingerprints of few bits: nearly every phrase goes the way by text."""
    rows = odd_rows(5)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    few = lambda self, at, n, _prints=coll.Grams.prints: _prints(self, at, n) & np.uint64((1 << bits) - 1)

    def patched(docs, *args, make):
        """The step with Grams.prints replaced inside the tasks."""
        arrow = docs.mapInArrow

        def map_in_arrow(run, schema):
            def with_few(batches):
                exact, coll.Grams.prints = coll.Grams.prints, few
                try:
                    yield from run(batches)
                finally:  # workers are used again
                    coll.Grams.prints = exact
            return arrow(with_few, schema)

        docs.mapInArrow = map_in_arrow
        return make(docs, *args)

    steps = {name: getattr(coll, name) for name in ("_counted", "_pointed", "_by_text")}
    with pytest.MonkeyPatch.context() as patch:
        for name, make in steps.items():
            patch.setattr(coll, name, lambda docs, *args, make=make: patched(docs, *args, make=make))
        got = sorted(map(tuple, coll.collocations(df, least=5).collect()))
    assert got == brute(rows, 5)


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Products of frequencies near 10**13 are exact."""
    n, a, left, right = 10**13 + 7, 10**12 + 3, 10**12 + 9, 10**12 + 11
    rows = [("en", 0, "", n), ("en", 1, "x", left), ("en", 1, "y", right), ("en", 2, "x y", a)]
    monkeypatch.setattr(coll, "frequent_phrases", lambda *_: spark.createDataFrame(rows, "lang string, words int, phrase string, n long"))
    got = coll.collocations(spark.createDataFrame([("en", "")], "lang string, text string")).collect()
    assert [tuple(r) for r in got] == [("en", 1, "x y", a, left, right, n, 1000 * a * n // (left * right))]
