"""Periodic runs against all lags of all positions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from haatlake.llm import periods
from haatlake.llm.queries import QUERIES

WHITE = b" \t\n\x0b\x0c\r"


def brute_runs(w):
    """(start, length, period) of every run, by all lags."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)  # lags ascend: the smallest one is the period
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(text, doc_id=None, repeat=False):
    words = bytes(c if c not in WHITE else 32 for c in (text or "").encode()).split(b" ")
    words = [w for w in words if w]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if repeat and doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else (None, None, None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def odd_texts(seed):
    rng = random.Random(seed)
    out = ["", None, "a", "a a a a a", "a a a a a a", "x  a\ta\na\x0ba\x0ca\ra y", "           ", "a b " * 3 + "a", "a b " * 4]
    for _ in range(60):
        words = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("abcd") for _ in range(rng.randint(1, 7))]
            words += (unit * rng.randint(1, 9))[: rng.randint(1, 60)] + [rng.choice("abxyz") for _ in range(rng.randint(0, 4))]
        out.append(" ".join(words))
    for _ in range(30):
        out.append(" ".join(rng.choice("ab") for _ in range(rng.randint(1, 120))))
    fib, prev = "ab", "a"
    while len(fib) < 400:
        fib, prev = fib + prev, fib
    unit = [f"w{k}" for k in range(40)]
    return out + [" ".join(fib), " ".join(fib[:90] * 5), " ".join(unit * 5), " ".join((unit * 2 + ["z"] * 9) * 4), " ".join(["q"] * 300),
                  " ".join("0" if bin(i).count("1") % 2 else "1" for i in range(512))]


@pytest.mark.parametrize("anchors", [1 << 20, 50])
def test_lag_scan_equals_all_lags(monkeypatch, anchors):
    monkeypatch.setattr(periods, "ANCHORS", anchors)
    for text in odd_texts(3):
        w = (text or "").encode().split()
        assert periods.block_runs([[b"p"], w, [], w[1:]])[1] == brute_runs(w), text


def test_splitting_leaves_no_run_out():
    rng = np.random.default_rng(5)
    ids = np.r_[rng.integers(30, 4000, 3000), np.tile(np.arange(30), 5), rng.integers(30, 4000, 3000)]
    segments = periods.surviving(ids, np.zeros(ids.size, int))
    assert any(a <= 3000 and b >= 3150 for a, b in segments) and sum(b - a for a, b in segments) < 1000
    for a, b in segments:
        assert b - a >= 6 and np.bincount(ids[a:b])[ids[a:b]].min() >= 4


def test_false_hits_are_extended_exactly(monkeypatch):
    monkeypatch.setattr(periods, "mix", lambda h: h * np.uint64(0))  # all blocks have one hash
    for text in odd_texts(8):
        w = (text or "").encode().split()
        assert periods.block_runs([w])[0] == brute_runs(w)


def test_long_texts_take_little_time():
    one = periods.block_runs([[b"a"] * 300_000])[0]
    assert one == [(0, 300_000, 1)]
    unit = [b"%d" % (k * k % 7919) for k in range(60_000)]
    assert len(periods.block_runs([unit * 5])[0]) >= 1


def test_rows(spark):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(odd_texts(11), 1)] * 2
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, start string, n_runs int")
    got = periods.periodic_runs(df, collapsed="left").collect()
    assert sorted(tuple(r)[1:8] for r in got) == sorted((brute_row(t) for _, t in rows), key=lambda r: tuple(x if x is not None else -1 for x in r)) or \
        sorted(map(str, (tuple(r)[1:8] for r in got))) == sorted(map(str, (brute_row(t) for _, t in rows)))
    assert all(hashlib.sha256(r["left"].encode()).hexdigest() == r.collapsed_sha256 for r in got)
    out = ("n", "a", "b", "c", "d", "e", "f")
    named = periods.periodic_runs(df, keep=("start", "n_runs"), out=out)
    assert named.columns == ["start", "n_runs", *out] and named.where("start = 'clash' and n_runs = 3").count() == len(rows)
    assert periods.periodic_runs(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.length("text") < 6000).collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, sf).collect()}
    assert sum(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in docs) > 5
    for r in docs:
        assert got[r.doc_id] == brute_row(r.text, r.doc_id, True), r.doc_id
