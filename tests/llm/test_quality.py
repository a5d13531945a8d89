"""The quality scorer against a plain computation, and its independence of caches and row order."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from billproof.llm import common, quality


def texts(spark, sf, n=60):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(n).collect()
    odd = ["", "word", "a a a a a a a a a a a a", "### || @@ !! $$ %% ^^", "Ünï çödé 日本語 " * 9, "x" * 5000 + " y", "Supercalifragilistic_A1b2C3d4E5f6G7h8I9j0K1l2M3 " * 3]
    return [r.text.encode() for r in rows if r.text] + [t.encode() for t in odd]


def plain(text, model):
    """Both scores, word by word."""
    words = [w for w in re.split(rb"[\x09-\x0d\x20]+", text.translate(None, b".,")) if w]
    cut = [{c.encode() for c in re.findall(r"[^\W_]+", w.lower())} for w in re.split(r"[\s.,]+", text.decode())]
    fresh = quality.Words(model.lists)
    flags = np.array([fresh.flags[fresh[w]] for w in words]).reshape(len(words), len(quality.FLAGS) + len(model.lists))[:, : len(quality.FLAGS)]
    n = len(words)
    share = flags.mean(axis=0) if n else np.zeros(len(quality.FLAGS))
    again = sum(a == b for a, b in zip(words, words[1:])) / (n - 1) if n > 1 else 0.0
    runs = [tuple(words[i : i + 4]) for i in range(n - 3)]
    same = 1 - len(set(runs)) / len(runs) if n > 8 else 0.0
    hits = np.array([sum(not own.isdisjoint(c) for c in cut) if n else 0 for own in model.lists])
    f = quality.Facts(n, share, hits, again, same, np.zeros(0, np.int32))
    features = []
    for w in sorted(set(words)):
        features += [xxhash.xxh32_intdigest(b"w" + w.lower().strip(quality.EDGE)) % quality.DIM, xxhash.xxh32_intdigest(b"s" + quality.shape(w.decode()).encode()) % quality.DIM]
    steps = [xxhash.xxh32_intdigest(f"r{i}.{min(10, int(20 * x))}") % quality.DIM for i, x in enumerate((*share.tolist(), again, same))]
    out = []
    for weights, votes in ((model.junk_weights, quality.junk_votes(f)), (model.toxic_weights, quality.toxic_votes(f))):
        marks = [xxhash.xxh32_intdigest(f"v{i}.{v}") % quality.DIM for i, v in enumerate(votes)]
        z = sum(weights[x] for x in features) / max(len(features), 1) ** 0.5 + sum(weights[x] for x in steps + marks) + weights[-1]
        out.append(1 / (1 + np.exp(-z)))
    return out


def test_scores_equal_a_plain_computation(spark, sf):
    big = sf.replace("0.001", "0.01")
    model = quality.fit(common.table(spark, big, "documents"), common.table(spark, big, "labels"))
    scorer = quality.Scorer(model)
    for text in texts(spark, sf):
        assert np.abs(np.array(scorer.score(text)[:2]) - plain(text, model)).max() < 1e-9


def test_scores_do_not_depend_on_caches_or_order(spark, sf, monkeypatch):
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    model = quality.fit(docs, labels)
    again = quality.fit(docs.repartition(7, F.reverse("text")), labels.repartition(3))
    assert (again.junk_weights == model.junk_weights).all() and (again.toxic_weights == model.toxic_weights).all() and again.lists == model.lists
    own = texts(spark, sf)
    want = {t: quality.Scorer(model).score(t) for t in own}
    for cached in (1, 40, 700_000):
        monkeypatch.setattr(quality, "CACHED", cached)
        common._held.clear()
        scorer = quality.Scorer(model)
        random.Random(cached).shuffle(own)
        assert all(scorer.score(t) == want[t] for t in own)


def test_verdicts_on_texts_that_were_not_trained_on(spark, sf):
    """Trained on half of the labels and documents, judged on the other half."""
    big = sf.replace("0.001", "0.1")
    docs, labels = common.table(spark, big, "documents"), common.table(spark, big, "labels")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    model = quality.fit(docs.where(half), labels.where(half))
    found = {r.key: r for r in quality.scores(docs.where(~half), model).collect()}
    judged = [(r, found[r.doc_id]) for r in labels.where(~half).collect() if r.doc_id in found]
    toxic = [not s.kept for r, s in judged if r.toxic == 1]
    calm = [s.toxic_score >= 0.5 for r, s in judged if r.toxic == 0]
    junk = [s.junk_score >= 0.5 for r, s in judged if r.quality == 0]
    fine = [s.junk_score >= 0.5 for r, s in judged if r.quality == 1 and r.toxic == 0]
    assert np.mean(toxic) > 0.9 and np.mean(calm) < 0.01 and np.mean(junk) > 0.85 and np.mean(fine) < 0.05


def test_long_words_and_lists(spark):
    """Nothing is cut: a list may hold a word of any length and script."""
    word = "безответственнейшийбездельник"
    rows = [(i, f"some quiet words here {i} and there" + (f" {word}!" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, votes string, order int")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    lists = quality.toxic_lists(docs, labels, "doc_id", "text")
    assert all(own == {word.encode()} for own in lists)
    assert quality.shape("aA1-" * 20) == "aA0-" * 20
