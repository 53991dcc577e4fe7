"""BPE, packing, fingerprints and pages against brute force and public libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haatlake.llm import bpe, fingerprints, packing, pages

SCHEMA = "doc_id long, text string, lang string, source string, _text string, ids string"
ODD = ["", None, " ", "a" * 3000, "ab" * 2000, "it's 3 o'clock, we'll SEE!", "ΣΟΦΟΣ é é É", "x<|endoftext|>y <|startoftext|>",
       "tab\tand\x1cseparator\x85next\xa0last　", "日本語 한국어 🙂🙂", "12345 6½ ²", "\n\n", "same", "same"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", "clash", "clash") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_encoder_equals_library(tokenizer):
    rng = random.Random(3)
    letters = list("abcdeABCXYZ 's't're'll \t\n\x1c\x85\xa0éèßİΣσς日本한🙂é123½²!?,.<|_-")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + [t or "" for t in ODD]
    own = bpe.Encoder(bpe.tokenizer_file())
    ids, ends = own.encode(texts)
    for text, got in zip(texts, np.split(ids, ends[:-1])):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert got.tolist() == want
        assert own.decode(want) == tokenizer.decode(want, skip_special_tokens=False)


def test_cuts_are_certain():
    own = bpe.Encoder(bpe.tokenizer_file())
    assert 0 < own.joined.sum() < own.joined.size
    a, b = np.argwhere(~own.joined[97:123, 353:379])[0] + 97
    word = bytes([a, b])
    whole, parts = own.encode_words([word])[0], own.encode_words([word[1:]])[0]
    assert whole == own.inner[a].astype("<u4").tobytes() + parts


def test_word_table_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 5)
    small = bpe.Encoder(bpe.tokenizer_file())
    texts = ["one two three four five six seven", "two eight", "nine ten one two"]
    got, ends = small.encode(texts)
    monkeypatch.setattr(bpe, "WORDS", 1000)
    want, want_ends = bpe.Encoder(bpe.tokenizer_file()).encode(texts)
    assert got.tolist() == want.tolist() and ends.tolist() == want_ends.tolist()


def test_encode_and_decode_frames(spark, tokenizer):
    df = frame(spark, ODD)
    got = bpe.decode(bpe.encode(df.drop("ids"), outputs=("ids", "n_tokens")), out="back").orderBy("doc_id").collect()
    assert got[0]["_text"] == "clash" and set(got[0].asDict()) >= {"ids", "n_tokens", "back", "lang"}
    for row, text in zip(got, ODD):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert row.ids == want and row.n_tokens == len(want) and row.back == tokenizer.decode(want, skip_special_tokens=False)
    assert bpe.encode(df.limit(0)).count() == 0


def test_patterns_fill_closest():
    rng = random.Random(5)
    for _ in range(30):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(6)}
        left = dict(counts)
        for chosen, times in packing.patterns(counts, 40):
            total = sum(k * n for k, n in chosen.items())
            largest = max(k for k, n in left.items() if n)
            assert largest in chosen and total <= 40 and times >= 1
            pool = [k for k, n in left.items() for _ in range(n)]
            pool.remove(largest)
            sums = {0}
            for k in pool:
                sums |= {s + k for s in sums}
            assert total == largest + max(s for s in sums if s <= 40 - largest)
            for k, n in chosen.items():
                left[k] -= n * times
        assert not any(left.values())


def check_packing(rows, ids, capacity):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
    for doc, full in ids.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            part = full[at : at + r.length]
            assert r.start == at and r.doc_tokens == len(full) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r.length
        assert at == len(full)
    for window in windows.values():
        at = 0
        for r in sorted(window, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(windows)


def test_packing(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 3)  # lengths are numbered over several salts
    texts = [t for t in ODD] + ["w " * n for n in (15, 15, 15, 15, 15, 15, 15, 7, 31, 32, 63)]
    df = frame(spark, texts)
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    rows = packing.pack(df, capacity=32).collect()
    assert check_packing(rows, ids, 32) <= -(-sum(map(len, ids.values())) // 32) + 2
    with_ids = packing.pack(df, capacity=32, with_ids=True).where("doc_id = 5").orderBy("start").collect()
    assert [i for r in with_ids for i in r.ids] == ids[5]
    assert packing.pack(df.limit(0)).count() == 0


def brute_edited(docs):
    order = sorted(docs, reverse=True)
    for k, i in enumerate(order):
        text, after = docs[i] or "", docs[order[(k + 1) % len(order)]] or ""
        third = len(text) // 3
        yield i, text[: len(text) - third] + after[:third], after


@pytest.mark.parametrize("ranges", [1, 5])
def test_fingerprints_of_edited_texts(spark, ranges):
    texts = ODD + [f"line {k} of a text\nand more of it {k % 7}\nlast" for k in range(40)]
    docs = dict(enumerate(texts))
    rows = {r.doc_id: r for r in fingerprints.compare_edited(frame(spark, texts), ranges=ranges).collect()}
    assert len(rows) == len(texts)
    one = lambda t: [v[0] for v in fingerprints.vectors([t])]
    for i, edited, after in brute_edited(docs):
        r, own = rows[i], docs[i] or ""
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprints.shown(*one(own)) and r.edited_fingerprint == fingerprints.shown(*one(edited))
        near = fingerprints.likeness(fingerprints.vectors([own]), fingerprints.vectors([after]))[0]
        assert 0 <= r.near_edited <= 1 and r.near_next == pytest.approx(near)
        assert (r.near_edited == 1) >= (own == edited)
    assert fingerprints.compare_edited(frame(spark, [])).count() == 0
    assert len(fingerprints.compare_edited(frame(spark, ["abc abc"])).collect()) == 1


def test_fingerprints_are_homomorphic(spark):
    show = lambda t: fingerprints.shown(*[v[0] for v in fingerprints.vectors([t])])
    assert show("a b\nc d\n\ne") == show("e\n\na b\nc d") != show("a b\nc d\ne")
    assert fingerprints.changed(show("a b\ne"), insert=["c d", ""]) == show("a b\nc d\n\ne")
    assert fingerprints.changed(show("a b\nc d\n\ne"), delete=["", "a b"]) == show("e\nc d")
    assert len(base64.b64decode(show(""))) == 8 * fingerprints.EXACT + 4 * fingerprints.LIKE
    got = fingerprints.fingerprint(frame(spark, ["x\ny", "y\nx", None])).orderBy("doc_id").collect()
    assert got[0].fingerprint == got[1].fingerprint != got[2].fingerprint == show("")


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><a href="/">home</a></nav><div class="ad-box">buy</div>
<div class="page-{n}"><div class="x7"><h1>Title {n} &amp; more</h1><p>First <b>bo</b>ld&nbsp;line.<p>Second {n}
 line<br>goes on<ul><li>item</ul></div><div class="sidebar">side</div></div>
<section id="comments"><p>A reader says a lot of things here, more than the article does, and again and again and again {n}.</p></section>
<div class="cookie-notice">We use cookies</div><form><p>Write</p></form><footer>end</footer><!-- open"""


def test_pages(spark):
    want = "Title {n} & more First bold line. Second {n} line goes on item"
    rows = [(n, "http://h.example/" + str(n), PAGE.format(n=n)) for n in range(6)]
    rows += [(10, None, "<p>only"), (11, "nonsense", None), (12, "http://h.example/x", ""), (13, "http://u@H.example:8/y", "a < b & c")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in pages.extract(df).collect()}
    assert [got[n].text for n in range(6)] == [want.format(n=n) for n in range(6)]
    assert [got[k].text for k in (10, 11, 12, 13)] == ["only", "", "", "a < b & c"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(rows)
    assert pages.extract(df.limit(0)).count() == 0


def test_pages_follow_their_host(spark):
    # One page's own best container is a remark without a telling name; the host's votes lead to the article.
    page = "<body><div class='a1'><h1>T</h1><p>{body}</p></div><div class='zz'><p>{more}</p></div></body>"
    rows = [(n, "http://h/", page.format(body="word " * 50, more="x")) for n in range(9)] + [(9, "http://h/", page.format(body="word " * 20, more="noise " * 60))]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).where("page_id = 9").first()
    assert got.text == "T " + ("word " * 20).strip()


def words(n, stem):
    return " ".join(f"{stem}{k}" for k in range(n))


def extracted(spark, bodies):
    rows = [(n, "http://h/", f"<html><body>{body}</body></html>") for n, body in enumerate(bodies)]
    return [r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_siblings_of_one_article_stay(spark):
    nav = "<nav><a href='/'>home</a></nav>"
    two = f"{nav}<div class='x'><div class='a'><p>{words(40, 'a')}</p></div><div class='b'><p>{words(100, 'b')}</p></div></div>"
    assert extracted(spark, [two]) == [f"{words(40, 'a')} {words(100, 'b')}"]
    own = f"{nav}<div class='x'><p>{words(40, 'p')}</p><div class='b'><p>{words(100, 'b')}</p></div></div><div class='by'>By A. Writer</div>"
    assert extracted(spark, [own]) == [f"{words(40, 'p')} {words(100, 'b')}"]


def test_a_voted_container_that_holds_little_of_a_page_is_not_followed(spark):
    short = f"<div class='lead'><p>{words(30, 'l')}</p></div>"
    got = extracted(spark, [short] * 8 + [f"{short}<div class='more'><p>{words(100, 'm')}</p></div>"])
    assert got == [words(30, "l")] * 8 + [f"{words(30, 'l')} {words(100, 'm')}"]


def test_two_templates_of_one_host(spark):
    old, new = (f"<div class='{c}'><h1>T</h1><p>{words(60, c)}</p></div><div class='foot-note'><a href='/'>about us</a></div>" for c in ("old", "new"))
    assert extracted(spark, [old] * 5 + [new] * 3) == [f"T {words(60, 'old')}"] * 5 + [f"T {words(60, 'new')}"] * 3


def test_names_with_other_words_do_not_drop_prose(spark):
    body = (f"<article><h1>T</h1><div class='form-of-government'><p>{words(30, 'g')}</p></div><div class='header-text'>{words(20, 'h')}</div>"
            f"<div class='promo-box'>{words(9, 'x')}</div><div class='ad-slot-3'>{words(9, 'x')}</div><div class='comments-section'>{words(50, 'x')}</div>"
            "<div class='header-links-x'><a href='/'>one link of words</a> <a href='/'>another link of words</a></div></article>"
            f"<div class='cookie-tale'>{words(9, 'x')}</div><div class='sidebar'>{words(30, 'x')}</div>")
    assert extracted(spark, [body]) == [f"T {words(30, 'g')} {words(20, 'h')}"]


def test_a_host_of_many_generated_paths(spark):
    """Each task passes on a bounded number of a host's paths."""
    cast = spark.range(5000).selectExpr("IF(id < 0, 'g', 'h') AS host", "concat('/html/body/div.c', id) AS path", "IF(id = 7, 400L, 1L) AS votes", "IF(id = 9, 900L, 0L) AS downs")
    got = pages._ranked(cast).first()
    assert got.paths == ["/html/body/div.c7"] and got.down == ["/html/body/div.c9"]
    plan = pages._ranked(cast)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4


def test_pages_survive_broken_markup():
    for source in ("<", "<a href='x", "<script>never closed", "<!-- ", "<div " * 3000, "<p>" * 5000 + "x", "</div></div>x", "<div class=>y"):
        pages.Page(source).extract([])


def test_hashing_long_words():
    from haatlake.llm.hashing import SLICE, word_hashes

    raw = np.frombuffer(b"x" * (SLICE + 5) + b" abc " + b"y" * SLICE + b" abc", np.uint8)
    starts, ends, hashes = word_hashes(raw)
    assert len(hashes) == 4 and hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3 and ends[-1] - starts[-1] == 3
