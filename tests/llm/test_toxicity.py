import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import toxicity

from .helpers import clashing, documents

WORDS = {"en": "the house of many words and things to read", "de": "der hund und die katze ist nicht im haus", "fr": "le chien et la maison est dans les mots"}
BAD = {"en": "rotten", "de": "mistkram", "fr": "pourri"}


def labelled(n=900, seed=1):
    """Texts of three languages; a toxic one holds a form of its language's bad word."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        words = r.choices(WORDS[lang].split(), k=r.randint(5, 80)) + ["".join(r.choices("abcdefgh", k=6)) for _ in range(5)]
        toxic = int(r.random() < 0.3)
        if toxic:
            words.insert(r.randrange(len(words)), BAD[lang] + r.choice(["", "es", "er", "ste"]))
        out.append((i, " ".join(words), toxic))
    return out


@pytest.fixture(scope="module")
def model():
    rows = labelled()
    return toxicity.train([t for _, t, _ in rows], [y for _, _, y in rows])


def test_unseen_texts_are_told_apart(model):
    rows = labelled(400, seed=2)
    scores = toxicity.Scorer(model).texts([t for _, t, _ in rows])
    right = np.mean([(s >= 0.5) == bool(y) for s, (_, _, y) in zip(scores, rows)])
    assert right > 0.97


def test_thresholds_by_language(model):
    assert set(model.thresholds) == set(WORDS)
    assert toxicity.language("der hund und die katze".split()) == "de"
    assert toxicity.language([]) == ""


def test_scoring_is_the_forward_pass_of_the_training(model):
    texts = ["the house rotten words", "x", "le chien pourrier et la maison", "word " * 3000]
    pad = np.full((2, 4), toxicity.BUCKETS)
    for text in texts:
        found = toxicity.words(text)
        quads = np.concatenate([np.array([toxicity.buckets(w) for w in found]), pad])
        logit = toxicity._forward(model, [quads])[0]
        expected = model.scores(logit, [toxicity.language(found)])
        assert np.allclose(toxicity.Scorer(model).texts([text]), expected, atol=1e-4)


def test_a_text_scores_alike_in_any_company(model):
    texts = [t for _, t, _ in labelled(50, seed=3)] + [""]
    together = toxicity.Scorer(model).texts(texts)
    assert np.allclose(together, [toxicity.Scorer(model).texts([t])[0] for t in texts], atol=1e-5)


def test_report(spark):
    rows = labelled(500, seed=4)
    docs = documents(spark, [(i, t) for i, t, _ in rows] + [(600, None), (601, ""), (None, "the rotten house"), (602, "word " * 60_000), (0, rows[0][1])])
    marks = [(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (700, 1, 1), (1, None, None), (600, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_report(clashing(docs), clashing(labels)).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    truth = {i: y for i, _, y in rows}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    # What the held-out labels say changes nothing.
    other = spark.createDataFrame([(i, q, 1 - y if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in marks], labels.schema)
    again = toxicity.toxicity_report(docs, other).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_nothing_to_learn_from_and_empty_tables(spark):
    docs = documents(spark, [(1, "a text"), (2, "another")])
    none = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.toxicity_report(docs, none).collect()} == {0}
    assert toxicity.toxicity_report(docs.limit(0), none.limit(0)).collect() == []


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """More rows than one task takes, long texts among them; a word that few of the rows hold is learned."""
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 100_000)
    r = random.Random(5)
    rows = labelled(7000, seed=5) + [(7000 + i, "the house " * 9000 + (f"vilewort{i % 3} " * 3 if i % 2 else ""), i % 2) for i in range(40)]
    rows += [(8000 + i, " ".join(r.choices(WORDS["en"].split(), k=20)) + " zzrare", 1) for i in range(40)]
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    counted = []
    monkeypatch.setattr(toxicity, "_log_odds", lambda counts, toxic, clean, real=toxicity._log_odds: counted.append((counts, toxic + clean)) or real(counts, toxic, clean))
    model = toxicity.fit(docs, labels)
    counts, n = counted[0]
    assert n > 0.75 * len(rows)
    assert counts[:, toxicity.buckets("house")[0]].sum() >= sum("house" in t.split() for _, t, _ in rows) * 0.75
    assert counts[1, toxicity.buckets("zzrare")[0]] >= 25
    fresh = labelled(300, seed=6)
    scores = toxicity.Scorer(model).texts([t for _, t, _ in fresh])
    assert np.mean([(s >= 0.5) == bool(y) for s, (_, _, y) in zip(scores, fresh)]) > 0.97
    again = toxicity.fit(docs.repartition(7), labels)
    assert np.array_equal(model.embeddings, again.embeddings) and model.thresholds == again.thresholds


def test_many_words_at_once_are_read_as_one_by_one():
    r = random.Random(7)
    found = ["".join(r.choices("abcäöß日本語𝒳_0é", k=r.choice([1, 2, 3, 4, 5, 6, 9, 70, 300]))) for _ in range(3000)]
    assert np.array_equal(toxicity._quads(found), [toxicity.buckets(w) for w in found])
    assert toxicity._quads([]).shape == (0, 4)
    some = "".join(map(chr, range(256))) + "ŒΣĿ’\u2028İ"
    for alphabet in (some, some[:256], some[:128]):
        for _ in range(300):
            text = "".join(r.choices(alphabet, k=r.randint(0, 60)))
            assert toxicity.words(text) == toxicity._WORD.findall(text.lower())


def test_words_are_not_hashed_one_by_one(model, monkeypatch):
    rows = labelled(60, seed=8) + [(60, "", 0), (61, "der in en", 0), (62, "la la la und und und der", 0)]
    texts = [t for _, t, _ in rows]
    before = toxicity.Scorer(model).texts(texts)
    monkeypatch.setattr(toxicity, "buckets", None)
    scorer = toxicity.Scorer(model)
    assert np.array_equal(scorer.texts(texts), before)
    assert scorer.logits(texts)[1] == [toxicity.language(toxicity.words(t)) for t in texts]
    assert toxicity.train(texts, [y for _, _, y in rows]).thresholds is not None


def test_a_task_trains_one_shard(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("toxic"), F.lit("").alias("text"))
    dealt = toxicity._dealt(rows, 23).select(F.spark_partition_id().alias("p"), "shard").distinct().collect()
    assert len(dealt) == len({x.p for x in dealt}) == len({x.shard for x in dealt}) == 23
