import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from vaultline.llm import bpe, katz, packed
from vaultline.llm.tables import held_out

from .conftest import words


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_the_library_word_by_word(ranks, library):
    rng = random.Random(1)
    some = ["".join(rng.choice("abcdeinrst é你😀") for _ in range(rng.randint(1, 40))).encode() for _ in range(3000)]
    some += [b"a" * 3000, b"", b"\xff\xfe"]
    got = bpe.Merger(ranks).replay(some)
    for w, ids in zip(some, got):
        if w:
            assert np.frombuffer(ids, "<u4").tolist() == library._core_bpe.encode_single_piece(w)
        else:
            assert ids == b""


def test_a_merge_that_makes_a_lower_rank_goes_on_with_it():
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab"]
    ranks = {t: i for i, t in enumerate(tokens)}
    own = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    merger = bpe.Merger(ranks)
    for w in (b"abcx", b"xabcabcabbc", b"bcabcab", b"abab" * 5 + b"c"):
        assert np.frombuffer(merger.replay([w])[0], "<u4").tolist() == own._core_bpe.encode_single_piece(w)


def test_documents_round_trip_and_match_the_library(few_docs, odd_docs, no_docs, ranks, library):
    for docs, s in ((few_docs, bpe.Settings(P.PATTERN)),
                    (odd_docs, bpe.Settings(P.PATTERN, unit_words=700, block_words=500, piece_words=300, share_bytes=3000,
                                            replay_bytes=1000))):
        texts = collections.defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            texts[r.doc_id].append(r.text or "")
        got = bpe.encode(docs, ranks, s, with_ids=True).collect()
        assert len(got) == docs.count()
        for r in got:
            raw = np.array(r.ids, "<u4").tobytes()
            assert (r.n_tokens, r.ids_sha256) == (len(r.ids), hashlib.sha256(raw).hexdigest())
            assert r.decoded_sha256 in [hashlib.sha256(t.encode()).hexdigest() for t in texts[r.doc_id]]
            assert r.ids in [library.encode_ordinary(t) for t in texts[r.doc_id]]
    assert bpe.encode(no_docs, ranks, bpe.Settings(P.PATTERN)).count() == 0


def test_rank_file_reader(tmp_path):
    p = tmp_path / "r"
    p.write_bytes(base64.b64encode(b"a") + b" 0\n" + base64.b64encode(b"\xff ") + b" 1\n\n")
    assert bpe.load_ranks(str(p)) == {b"a": 0, b"\xff ": 1}


def brute_katz(docs, trained):
    tokens = {k: [*words(t, lower=True), None] for k, t in docs}
    one, two = collections.Counter(), collections.Counter()
    for k in trained:
        one.update(tokens[k])
        two.update(zip([0, *tokens[k][:-1]], tokens[k]))
    total, types = sum(one.values()), len(one)

    def kept(counts, reliable=5):
        n = collections.Counter(counts.values())
        d, over = katz.discounts([n[c] for c in range(reliable + 2)], reliable)
        return lambda c: c * d[c] if c <= reliable else c - over
    k1, k2 = kept(one), kept(two)
    unknown = 1 - sum(map(k1, one.values())) / total if total else 1
    p = lambda w: k1(one[w]) / total if one[w] else unknown
    after = collections.defaultdict(dict)
    for (h, w), c in two.items():
        after[h][w] = c
    seen = {h: sum(x.values()) for h, x in after.items()}
    weight = {h: (1 - sum(k2(c) / seen[h] for c in x.values())) / (1 - sum(map(p, x))) for h, x in after.items()}

    def cond(h, w):
        if w in after.get(h, ()):
            return k2(after[h][w]) / seen[h]
        return weight.get(h, 1) * p(w)
    score = {k: sum(math.log10(cond(h, w)) for h, w in zip([0, *t[:-1]], t)) for k, t in tokens.items()}
    base = {k: sum(math.log10((one[w] + 1) / (total + types + 1)) for w in t) for k, t in tokens.items()}
    known = {k: sum(one[w] > 0 for w in t) for k, t in tokens.items()}
    for h in list(after)[:5]:  # every distribution sums to one
        assert abs(sum(cond(h, w) for w in one) + weight[h] * unknown - 1) < 1e-9
    return tokens, total, known, base, score


def test_scores_match_brute_force_over_blocks_and_parts(spark, few_docs):
    extra = [(-1, None), (-2, ""), (-3, "unheard of words The the")]
    docs = few_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    data = [(r.doc_id, r.text) for r in docs.collect()]
    trained = {k for k, _ in data if zlib.crc32(str(k).encode()) % 7 != 2}
    s = katz.Settings(block_tokens=8_000, part_keys=9_000)
    got = katz.score(docs, ~held_out(F.col("doc_id"), 7), s).collect()
    tokens, total, known, base, score = brute_katz(data, trained)
    assert len(got) == len(data)
    for r in got:
        k = r.doc_id
        assert (r.train, r.n_tokens, r.n_known, r.train_tokens) == (k in trained, len(tokens[k]), known[k], total)
        assert abs(r.base_score - base[k]) < 1e-9 * abs(base[k])
        assert abs(r.score - score[k]) < 1e-9 * abs(score[k])
    out = [r for r in got if not r.train]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # a better model than the base


def brute_recursive(docs, trained, order):
    """log10 of each text's probability by the definition, written as a recursion over histories."""
    tokens = {k: [*words(t, lower=True), None] for k, t in docs}
    counts = [collections.Counter() for _ in range(order)]

    def history(t, i, m):
        """The m - 1 words before place i, or as many as there are after the start."""
        return tuple(["<s>", *t[:i]][-(m - 1):]) if m > 1 else ()
    for k in trained:
        t = tokens[k]
        for i, w in enumerate(t):
            for m in range(1, order + 1):
                h = history(t, i, m)
                if len(h) == m - 1:
                    counts[m - 1][h, w] += 1
    kept = []
    for c in counts:
        n = collections.Counter(c.values())
        d, over = katz.discounts([n[x] for x in range(7)], 5)
        kept.append(lambda x, d=d, over=over: x * d[x] if x <= 5 else x - over)
    after = collections.defaultdict(dict)
    for c in counts:
        for (h, w), x in c.items():
            after[h][w] = x
    total = sum(counts[0].values())
    unknown = 1 - sum(map(kept[0], counts[0].values())) / total
    weights = {}

    def p(h, w):
        if not h:
            return kept[0](after[()][w]) / total if w in after[()] else unknown
        own = after.get(h)
        if own is None:
            return p(h[1:], w)
        if w in own:
            return kept[len(h)](own[w]) / sum(own.values())
        if h not in weights:
            weights[h] = ((1 - sum(kept[len(h)](x) for x in own.values()) / sum(own.values()))
                          / (1 - sum(p(h[1:], v) for v in own)))
        return weights[h] * p(h[1:], w)
    for h in [h for h in after if len(h) == order - 1][:5]:  # every distribution sums to one
        assert abs(sum(p(h, w) for w in after[()]) + p(h, "never seen at all") - 1) < 1e-9
    return {k: sum(math.log10(p(history(t, i, order), w)) for i, w in enumerate(t)) for k, t in tokens.items()}


@pytest.mark.parametrize("order", [1, 3, 4])
def test_the_order_is_a_setting_and_backoff_recursive(spark, few_docs, order):
    extra = [(-1, None), (-2, ""), (-3, "unheard of words The the"), (-4, "the")]
    docs = few_docs.select("doc_id", "text").limit(60).union(spark.createDataFrame(extra, "doc_id long, text string")).cache()
    data = [(r.doc_id, r.text) for r in docs.collect()]
    trained = {k for k, _ in data if zlib.crc32(str(k).encode()) % 7 != 2}
    s = katz.Settings(order=order, block_tokens=4_000, part_keys=9_000)
    expect = brute_recursive(data, trained, order)
    for r in katz.score(docs, ~held_out(F.col("doc_id"), 7), s).collect():
        assert abs(r.score - expect[r.doc_id]) < 1e-9 * max(1, abs(expect[r.doc_id])), r


def good_turing(n, k=5):
    """Katz ratios from counts of counts on the least-squares line of their logarithms, solved by hand."""
    x, y = [math.log(c) for c in range(1, k + 2)], [math.log(n[c]) for c in range(1, k + 2)]
    mx, my = sum(x) / len(x), sum(y) / len(y)
    b = sum((u - mx) * (v - my) for u, v in zip(x, y)) / sum((u - mx) ** 2 for u in x)
    cut = (k + 1) ** (b + 1)
    return [(((c + 1) / c) ** (b + 1) - cut) / (1 - cut) for c in range(1, k + 1)]


def test_good_turing_is_in_force_on_a_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    one, two = collections.Counter(), collections.Counter()
    for k, text in docs.collect():
        if zlib.crc32(str(k).encode()) % 7 != 2:
            tokens = [*words(text, lower=True), None]
            one.update(tokens)
            two.update(zip([0, *tokens[:-1]], tokens))
    held = katz.blocks(docs, ~held_out(F.col("doc_id"), 7), katz.Settings())
    model = katz.orders(katz.counted(held, 3, katz.Settings()), katz.Settings())
    for kind, counts in ((katz.WORDS, one), (katz.PAIRS, two)):
        n = collections.Counter(counts.values())
        assert n[5] * 5 > n[4] * 4  # copies: a plain ratio would be over one
        expect = good_turing(n)
        assert model[kind].d[1:].tolist() == pytest.approx(expect, rel=1e-9)
        assert all(0 < d < 1 and abs(d - (c - 0.5) / c) > 0.01 for c, d in enumerate(expect, 1))
        assert model[kind].over == pytest.approx(5 * (1 - expect[4]))


def test_smoothing_bridges_empty_counts_and_falls_back_by_the_count():
    d, _ = katz.discounts([0, 100, 0, 9, 4, 0, 1], 5)
    assert ((0 < d[1:]) & (d[1:] < 1)).all() and (np.diff(d[1:]) > 0).all()
    for n in ([0] * 7, [0, 3, 0, 0, 0, 0, 0], [0, 5, 5, 5, 5, 5, 5], [0, 1, 2, 3, 4, 5, 6]):  # no line that falls fast enough
        assert katz.discounts(n, 5)[0][1:].tolist() == [(c - 0.5) / c for c in range(1, 6)]


def test_katz_edge_cases(odd_docs, no_docs):
    got = katz.score(odd_docs, F.lit(True)).collect()
    assert len(got) == odd_docs.count()
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert [r.n_tokens for r in got if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert katz.score(no_docs, F.lit(True)).count() == 0
    untrained = katz.score(odd_docs, F.lit(False)).collect()
    assert {(r.score, r.base_score, r.n_known, r.train_tokens) for r in untrained} == {(0.0, 0.0, 0, 0)}


def test_packed_cells_round_trip():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2 ** 63, 5000).astype(np.uint64) * np.uint64(2))
    assert (packed.unpack_keys(packed.pack_keys(keys)) == keys).all()
    for x in (np.zeros(0, np.uint32), np.array([7], np.uint64), rng.random(99), rng.random(9) < 0.5):
        assert (packed.unpack(packed.pack(x), x.dtype) == x).all()
