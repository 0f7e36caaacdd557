import collections
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from vaultline.llm import language, quality
from vaultline.llm import words as W
from vaultline.llm.tables import held_out

from .conftest import words


def brute(text):
    w = words(text)
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside))


def test_measures_match_brute_force_over_slices(few_docs, odd_docs):
    for docs in (few_docs, odd_docs):
        texts = [r.text for r in docs.select("text").collect()]
        batch = pa.record_batch({"text": pa.array(texts, pa.string())})
        got = []
        for part in W.slices(batch, "text", 50_000):
            m = quality.measures(part.column("text"))
            got += list(zip(*(m[k].tolist() for k in quality.MEASURES[:5])))
        assert got == [brute(t) for t in texts]


def test_repeated_windows_of_a_text(spark):
    text = "a b c d e f g h x a b c d e f g h " + "z " * 9
    m = quality.measures(pa.array([text]))
    assert m["n_repeat_words"][0] == brute(text)[4] == 25


def test_expectation_maximisation_recovers_accuracies_and_classes():
    rng = np.random.default_rng(7)
    s = quality.Settings()
    k, n = len(s.rules), 20_000
    good = rng.random(n) < 0.8
    votes = np.where(good[:, None], np.where(rng.random((n, k)) < 0.05, 0, 2),
                     np.where(rng.random((n, k)) < 0.7, 0, 2))
    votes[rng.random((n, k)) < 0.2] = 1
    codes = (votes * 3 ** np.arange(k - 1, -1, -1)).sum(1)
    u, c = np.unique(codes, return_counts=True)
    m = quality.expectation_maximisation(u, c.astype(float), quality.Settings(prior_weight=0.001))
    assert abs(m.good - 0.8) < 0.02
    assert np.abs(m.rate[0, :, 0] - 0.7).max() < 0.05 and np.abs(m.rate[1, :, 0] - 0.05).max() < 0.02
    assert ((m.posterior(codes) >= 0.5) == good).mean() > 0.98


def test_rules_keep_clean_documents_and_reject_junk(spark, few_docs):
    from ..conftest import SF_SMALL
    out = quality.quality_rules(few_docs)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = labels.join(out, "doc_id").select(labels["quality"].alias("label"), "base_failed", "kept").collect()
    assert all(not r.kept for r in got if r.base_failed)
    sure = [r for r in got if not r.base_failed]
    assert sum(r.kept for r in sure if r.label == 1) >= 0.98 * sum(r.label for r in sure)
    assert all(not r.kept for r in sure if r.label == 0)


def test_quality_edge_cases(odd_docs, no_docs):
    out = quality.quality_rules(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r.base_failed and not r.kept for r in out if r.doc_id in (1, 2, 3))
    assert quality.quality_rules(no_docs).count() == 0
    kept = quality.quality_filter(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.filter("row != 'own row' or size != 7 or kept != 9").count() == 0
    assert quality.quality_filter(no_docs).columns == no_docs.columns


def brute_profile(texts, size):
    n = collections.Counter()
    for t in texts:
        clean = re.sub(r"[^a-zà-ÿß]+", " ", t.lower()).strip()
        for w in clean.split(" ") if clean else []:
            p = f" {w} "
            n.update(w)
            n.update(p[i:i + 2] for i in range(len(p) - 1))
            n.update(p[i:i + 3] for i in range(len(p) - 2))
    return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], pack(x[0])))][:size]


def pack(gram):
    out = 0
    for c in gram:
        out = out << 16 | ord(c)
    return out


def test_profiles_and_distances_match_brute_force(spark):
    data = [(1, "The cat, the hat and that.", "en"), (2, "le chat est là; le lait", "fr"), (3, "the end", None),
            (4, "la the chat", "en")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    s = language.Settings(profile=25)
    learned = language.learn(docs, s)
    expect = {k: brute_profile([t for _, t, x in data if x == k], 25) for k in ("en", "fr")}
    assert {k: v for k, v in learned.items()} == {k: [pack(g) for g in v] for k, v in expect.items()}
    got = {r.doc_id: r for r in language.identify(docs, learned, s).collect()}
    for i, t, _ in data:
        own = brute_profile([t], 25)
        far = {k: sum(abs(j - p.index(g)) if g in p else 25 for j, g in enumerate(own)) for k, p in expect.items()}
        best = min(sorted(far), key=far.get)
        assert got[i].lang_pred == best
        assert abs(got[i].score - (1 - far[best] / (25 * len(own)))) < 1e-12


def test_held_out_accuracy(few_docs):
    docs = few_docs.withColumn("out", held_out(F.col("doc_id"), 4))
    learned = language.learn(docs.filter("not out"))
    got = language.identify(docs, learned, keep={"out": F.col("out"), "lang": F.col("lang")}).filter("out")
    right = got.filter("lang = lang_pred").count()
    assert right >= 0.97 * got.count() and got.filter("score < 0 or score > 1").count() == 0


def test_language_edge_cases_and_pieces(odd_docs, no_docs):
    learned = language.learn(odd_docs)
    got = language.identify(odd_docs, learned).collect()
    assert len(got) == odd_docs.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    pieces = language.Settings(piece=5_000)
    assert language.learn(odd_docs, pieces) == learned
    assert sorted(map(str, language.identify(odd_docs, learned, pieces).collect())) == sorted(map(str, got))
    assert language.learn(no_docs) == {}
    assert {r.lang_pred for r in language.identify(odd_docs, {}).collect()} == {"und"}


def test_counts_of_any_size_order_the_n_grams_of_a_text():
    profiles = language.Profiles({"aa": [7, 5], "bb": [5, 7]}, 2)
    for few in (1, 1 << 24, 1 << 40):  # the n-gram of the larger code is the more frequent one
        best, score = profiles.nearest(np.array([5, 7], np.uint64), np.array([few, 2 * few]), 1)
        assert (profiles.langs[best[0]], score[0]) == ("aa", 1.0)
