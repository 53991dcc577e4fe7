"""Language identification and quality: held-out accuracy and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from haatlake.llm import langid, quality
from haatlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_bucket_is_crc32_of_the_id(spark):
    import zlib

    from haatlake.llm.common import in_bucket

    rows = spark.range(50).select("id", in_bucket("id", 4, 2).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_languages_held_out(spark):
    got = QUERIES["op6_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98 and got.score.between(0, 1).all() and got.rejected.mean() < 0.02


def test_language_edge_cases(spark):
    letters = "das ist ein haus und der baum steht dort", "the house and the tree stand over there"
    model = langid.fit([(letters[0], "de"), (letters[1], "en")] * 30)
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "123 ...", "c"), (4, letters[0], "c"), (5, letters[1] * 2000, "c"), (5, letters[1], "c")],
                               "doc_id long, text string, _text string")
    got = {(r.doc_id, r.text): r for r in langid.predict(df, model).collect()}
    assert [got[k].lang_pred for k in ((1, None), (2, ""), (3, "123 ..."))] == ["und"] * 3
    assert all(got[k].rejected and got[k].score == 0 for k in ((1, None), (2, ""), (3, "123 ...")))
    assert got[4, letters[0]].lang_pred == "de" and got[5, letters[1]].lang_pred == "en" and len(got) == 6
    assert langid.predict(df.limit(0), model).count() == 0
    none = langid.train(df.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}


def test_scores_do_not_depend_on_neighbours(spark):
    """Alone, and beside others: the same language, score and features."""
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").limit(60).collect()] + ["le ch", "", "x", "the cat"]
    model = langid.fit([("das ist ein haus und der baum", "de"), ("the house and the tree", "en"), ("la maison et le chat", "fr")] * 30)
    together = model.predict(docs)
    for i, t in enumerate(docs):
        alone = model.predict([t])
        assert alone[0][0] == together[0][i] and alone[1][0] == pytest.approx(together[1][i], abs=1e-12) and alone[2][0] == together[2][i]
    x = quality.features(docs)
    for i, t in enumerate(docs):
        assert (quality.features([t])[0] == x[i]).all() and (quality.features(["y", t, "Z"])[1] == x[i]).all()


def test_what_was_not_learnt_is_rejected(spark):
    """A language left out, another alphabet, and lettered noise go; held-out texts stay."""
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 300").collect()]
    learn, apart = [r for r in rows if r[0] % 3], [r for r in rows if not r[0] % 3]
    for left in ("de", "es"):
        model = langid.fit([(t, lang) for _, t, lang in learn if lang != left])
        stays, goes = [t for _, t, lang in apart if lang != left], [t for _, t, lang in apart if lang == left]
        assert model.predict(stays)[2].mean() < 0.02 and model.predict(goes)[2].mean() > 0.8, left
        odd = ["Широкая электрификация южных губерний даст мощный толчок подъёму сельского хозяйства", "qqqq xxxx zzzz kkkk", "zzzzzz " * 40, "μῆνιν ἄειδε θεὰ Πηληϊάδεω"]
        assert model.predict(odd)[2].tolist() == [True] * 4


def test_gram_buckets_are_within_the_table():
    raw = np.frombuffer("größer als 𝄞".encode(), np.uint8)
    grams = langid.subwords(raw)
    assert len(grams) == len(langid.ORDERS) and all(g.size == raw.size and g.max() < langid.BUCKETS for g in grams)


def auc(label, score):
    rank = score.rank()
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / ones / zeros


def test_quality_held_out(spark):
    got = QUERIES["op8_quality_scores"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert auc(got.quality, got.score) > 0.97 and ((got.predicted == 1) == (got.score >= 0.3)).all()
    assert got[got.quality == 1].predicted.mean() > 0.97


def test_risk_stays_non_negative():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(1, 1, (400, 5)), rng.normal(-1, 1, (100, 5))
    model = quality.fit(good[:200], np.concatenate([good[200:], bad]), 2 / 3)
    assert (model.margin(good) > 0).mean() > 0.9 and (model.margin(bad) > 0).mean() < 0.2


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_prior_of_known_mixtures(share):
    """Positives alone and a mixture: the share is found, by margins and through features."""
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1.5, 1, 3000), rng.normal(-1.5, 1, 3000)
    mixed = np.r_[good[1000 : 1000 + int(2000 * share)], bad[: int(2000 * (1 - share))]]
    assert quality.estimated_prior(good[:1000], mixed) == pytest.approx(share, abs=0.07)


def test_prior_is_learnt_from_positives_alone(spark):
    docs = spark.createDataFrame([(i, f"Good words in a row, number {i}, like this." if i % 5 else f"BAD!! {i} BAD!! {i} BAD!!") for i in range(3000)], "doc_id long, text string")
    labels = docs.where("doc_id % 5 > 0 and pmod(xxhash64(doc_id), 2) = 0").select("doc_id", F.lit(1).alias("quality"))
    seen, fit = [], quality.fit
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "fit", lambda p, u, prior, *a: (seen.append(prior), fit(p, u, prior, *a))[1])
        model = quality.train(docs, labels, F.lit(True))
    assert len(seen) == 2 and seen[1] == pytest.approx(0.8, abs=0.05)
    got = quality.score(docs, model).toPandas()
    assert got[got.text.str.startswith("Good")].predicted.all() and not got[got.text.str.startswith("BAD")].predicted.any()


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(i, "good words in a row, like this." if i % 4 else "BAD!! BAD!! BAD!!", "c") for i in range(200)] + [(None, None, "c"), (7, "", "c")],
                                 "doc_id long, text string, _text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 150)] + [(1, 0), (None, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.lit(True))
    got = quality.score(docs, model).toPandas()
    assert len(got) == 202 and got.score.between(0, 1).all() and got[got.text.fillna("").str.startswith("good")].predicted.all()
    assert not got[got.text.fillna("").str.startswith("BAD")].predicted.any()
    assert quality.score(docs.limit(0), model).count() == 0
    flat = quality.train(docs, labels.limit(0), F.lit(True))
    assert quality.score(docs, flat).select(F.min("score"), F.max("score")).first() == pytest.approx([quality.PRIOR] * 2)
