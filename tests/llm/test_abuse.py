from __future__ import annotations

import random

import numpy as np
import pytest

from textloom.llm import abuse

CALM = ["the {} near the {} was cleaned in spring", "a {} can open the {} again", "nobody in town had seen such a {} before the {}", "we sold the {} and kept the {}"]
RUDE = ["you are a filthy moron, go cry about your {}", "nobody wants you here, worthless loser, take your {}", "i will break your legs and burn your {}"]
SPECIAL = ["a study of the word moron in the {} of 1900", "the player can burn the {} and break the {}"]
THINGS = "lamp jar boat door wall fence table engine garden window".split()


def documents(n, seed):
    rng = random.Random(seed)
    say = lambda t: t.format(rng.choice(THINGS), rng.choice(THINGS))
    texts, rated = [], []
    for _ in range(n):
        s = [say(rng.choice(CALM)) for _ in range(rng.randint(2, 8))]
        bad = rng.random() < 0.25
        if bad:
            s.insert(rng.randrange(len(s)), say(rng.choice(RUDE)))
        if rng.random() < 0.3:
            s.append(say(rng.choice(SPECIAL)))
        texts.append(". ".join(s) + ".")
        rated.append(int(bad != (rng.random() < 0.03)))
    return texts, np.array(rated)


@pytest.fixture(scope="module")
def model():
    return abuse.fit(*documents(600, 1))


def worst(model, texts):
    doc, logit = model.logits(texts)
    out = np.full(len(texts), -np.inf)
    np.maximum.at(out, doc, logit)
    return out


def test_held_out_accuracy(model):
    texts, rated = documents(300, 2)
    truth = np.array([any(w in t for w in ("filthy", "worthless", "your legs")) for t in texts])
    assert ((worst(model, texts) > 0) == truth).mean() > 0.97


def test_misspellings_and_disguises(model):
    for t in ("you are a f-i-l-t-h-y m0r0n, go cry about your lamp.", "you are a filthyyyy mor​on, go cry about your jar", "w o r t h l e s s loser, nobody wants you here, take your boat"):
        assert worst(model, [t])[0] > 0, t
    assert worst(model, ["the lamp near the jar was cleaned in spring."])[0] < 0


def test_tokens():
    assert [abuse.plain(x) for x in ("p-orn", "br@1nl3$$", "d.u.m.b", "titsss", "1999", "anna27", "...", "c**p")] == ["porn", "brainless", "dumb", "tits", "0", "anna2t", "", "c*p"]
    assert abuse.sentences("s t u p i d man here now! We went home again today.")[0][:2] == ["stupid", "man"]
    assert max(map(len, abuse.sentences("word " * 500))) == abuse.WINDOW


def test_new_words_cost_what_they_are_not_the_vocabulary(model):
    """Each word's sum is taken once; batches after a large vocabulary give the same and are as quick as before it."""
    texts, _ = documents(200, 5)
    words = abuse.Words()
    alone = model.logits(texts)[1]
    made = [" ".join(f"{a}{b}{c}qu" for c in "bcdfghjklm") for a in THINGS for b in "abcdefghijklmnopqrstuvwxyz" for _ in range(4)]
    model.logits([t.replace("qu", str(i)) for i, t in enumerate(made)], words)
    assert len(words.sums) > 1000 and not words.buckets
    known = len(words.sums)
    assert np.allclose(model.logits(texts, words)[1], alone)
    again = model.logits(texts, words)[1]
    assert np.allclose(again, alone) and len(words.sums) < known + 200


def test_one_fit_is_shared(spark, monkeypatch):
    texts, rated = documents(60, 6)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(r)) for i, r in enumerate(rated)], "doc_id long, abusive int")
    first = abuse.train(df, lab)
    assert abuse.train(df, lab) is first
    assert abuse.train(df, lab.where("doc_id > 3")) is not first


def test_one_kind_of_rating_gives_no_model():
    assert abuse.fit(["a b c d"], np.array([1])) is None and abuse.fit([], np.array([], int)) is None


def test_tables(spark):
    texts, rated = documents(400, 3)
    docs = [(i, t, "a" if i % 3 else "b", 1.0) for i, t in enumerate(texts)] + [(1000, None, "a", 1.0), (1001, " ", None, 1.0), (0, texts[0], "a", 1.0), (1002, "word " * 100_000, "b", 1.0)]
    labels = [(i, "r", int(r)) for i, r in enumerate(rated)] + [(3, "q", None), (4, "q", 1 - int(rated[4])), (9999, "r", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, rater string, abusive int")
    m = abuse.train(df, lab)
    got = abuse.scored(df, m).toPandas()
    assert len(got) == len(docs) and got[got.doc_id == 1000].score.isna().all() and got[got.doc_id == 1001].score.eq(0).all()
    assert got[got.doc_id == 0].score.nunique() == 1
    truth = {i for i, t in enumerate(texts) if any(w in t for w in ("filthy", "worthless", "your legs"))}
    assert len(truth ^ set(got[got.score > 0.5].doc_id)) < 12
    assert abuse.train(df, lab.limit(0)) is None
    assert abuse.scored(df, None).where("score > 0").count() == 0
    assert abuse.scored(df.limit(0), m).count() == 0
