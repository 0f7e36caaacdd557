import collections
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from vaultline.llm import lines, neardup
from vaultline.llm.graph import components

from .conftest import SCHEMA, words


def brute_lines(docs, least):
    """Per document the text left, by comparing every suffix with all earlier ones."""
    seen, out, seqs = collections.defaultdict(list), {}, []
    for k, text in docs:
        seq = [(i, x, len(words(x))) for i, x in enumerate((text or "").split("\n")) if words(x)]
        gone = set()
        for i in range(len(seq)):
            best = 0
            for d, j in seen[seq[i][1]]:
                o = seqs[d] if d < len(seqs) else seq
                n = 0
                while i + n < len(seq) and j + n < len(o) and seq[i + n][1] == o[j + n][1]:
                    n += 1
                best = max(best, n)
            if sum(x[2] for x in seq[i:i + best]) >= least and best:
                gone.update(x[0] for x in seq[i:i + best])
            seen[seq[i][1]].append((len(seqs), i))
        seqs.append(seq)
        out[k] = (text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone),
                  len(seq), len(gone))
    return out


@pytest.mark.parametrize("least", [6, 50])
def test_line_dedup_matches_brute_force(few_docs, least):
    docs = sorted((r.doc_id, r.text) for r in few_docs.select("doc_id", "text").collect())
    got = lines.dedup_lines(few_docs, lines.Settings(least)).collect()
    assert {r.row.doc_id: (r.text, r.n_lines, r.n_removed) for r in got} == brute_lines(docs, least)


def test_tails_overlaps_and_runs_inside_a_document(spark):
    big, a, b = "w " * 9 + "end", "short one", "tail"
    data = [(1, f"{big}\n{a}\n{b}"), (2, f"x\n\n{big}\n{a}\n{b}\ny"), (3, "\n".join(["again and again"] * 7)),
            (4, f"{a}\n{b}\n{a}\n{b}"), (5, f"{a}\n{big}")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.row.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(docs, lines.Settings(8)).collect()}
    assert got == brute_lines(data, 8)
    assert got[2][0] == "x\n\ny" and got[3][0] == "again and again"


def test_line_dedup_edge_cases(odd_docs, no_docs):
    got = lines.dedup_lines(odd_docs, lines.Settings(1)).collect()
    assert len(got) == odd_docs.count()
    by = collections.defaultdict(list)
    for r in got:
        by[r.row.doc_id].append(r)
    assert by[1][0].text is None and by[2][0].text == "" and by[3][0].n_lines == 0
    assert by[4][0].text == "One line.\nAnother line."
    assert [r.n_removed for r in by[5]] == [0, 0]  # repeated rows are one document
    out = lines.deduplicated(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert lines.deduplicated(no_docs).columns == no_docs.columns and lines.dedup_lines(no_docs).count() == 0


def test_a_very_long_text_that_loses_a_run_is_rebuilt_in_linear_time(spark):
    run = [f"passage line {i} with some words in it" for i in range(40)]
    own = [f"line {i} of a very long text" for i in range(30_000)]
    data = [(1, "\n".join(run)), (2, "\n".join(own[:20_000] + run + own[20_000:]))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    began = time.perf_counter()
    got = {r.row.doc_id: r for r in lines.dedup_lines(docs, lines.Settings()).collect()}
    assert time.perf_counter() - began < 60
    assert got[2].text == "\n".join(own) and got[2].n_removed == 40 and got[2].n_lines == 30_040
    assert got[1].n_removed == 0


def test_line_dedup_uses_no_python_nodes(few_docs):
    plan = lines.dedup_lines(few_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def brute_groups(docs, percent=85, size=5):
    sets = []
    for _, t in docs:
        w = words(t, lower=True)
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size
                    else {tuple(w)} if w else set())
    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    top = list(range(len(docs)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    for i, s in enumerate(sets):
        for j, n in collections.Counter(j for x in s for j in where[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                top[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return collections.Counter((k, len(sets[i]), least.get(root(i))) for i, (k, _) in enumerate(docs))


def grouped(df):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_near_duplicates_match_brute_force(spark, few_docs):
    base = "the quick brown fox jumps over a lazy dog and runs far away again".split()
    extra = [(-i, " ".join(base[:i])) for i in range(1, 13)]
    chain = [f"c{i}" for i in range(60)]  # neighbours are linked, the ends are not
    extra += [(1000 + i, " ".join([*chain[i:], *(f"n{j}" for j in range(i))])) for i in range(12)]
    extra += [(2000, "A b C"), (2001, "a  B\nc"), (2002, None), (2003, "")]
    docs = few_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = neardup.near_duplicates(docs)
    assert grouped(got) == brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    assert got.filter("kept != (doc_id = component_id)").count() == 0


def test_a_large_group_of_different_near_copies(spark):
    base = [f"b{i}" for i in range(120)]
    data = [(i, " ".join([*base[:i % 120], f"x{i}", *base[i % 120 + 1:]])) for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert grouped(neardup.near_duplicates(docs)) == brute_groups(data)


def test_documents_of_one_template_make_few_pairs(spark, monkeypatch):
    """Similar to 0.8 and hardly linked: few of the pairs that share a bucket are looked at."""
    rng = random.Random(1)
    looked = []
    real = neardup._likely
    monkeypatch.setattr(neardup, "_likely", lambda pairs, s: looked.append(pairs.count()) or real(pairs, s))
    for n in (100, 400):
        docs = []
        for d in range(n):
            text = [f"t{i}" for i in range(300)]
            for slot in range(0, 300, 42):
                text[slot] = f"v{rng.randrange(60)}"
            docs.append((d, " ".join(text)))
        got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
        assert got.filter("kept").count() > 0.9 * n
    star, cross = looked[2:]
    assert star + cross < 79_800 / 5  # pairs of 400 documents


def test_near_duplicate_edge_cases(odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert grouped(neardup.near_duplicates(odd_docs)) == brute_groups(docs)
    left = neardup.without_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == odd_docs.count() - 1  # of the two equal rows one stays
    assert neardup.near_duplicates(no_docs).count() == 0
    assert neardup.without_near_duplicates(no_docs).columns == no_docs.columns


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    data = [(3, text), (1, text.upper()), (2, text + " more"), (None, text), (4, "other words"), (4, "other words")]
    docs = spark.createDataFrame([(*d, None, None, None, 1, 1) for d in data], SCHEMA)
    assert sorted(r.doc_id for r in neardup.without_near_duplicates(docs).collect()) == [1, 4]


def test_estimates_are_close_and_registers_merge():
    s = neardup.Settings()
    sketcher = neardup.Sketcher(s)
    rng = np.random.default_rng(3)
    for j in (0.5, 0.85, 0.95):
        n = 2000
        common = int(round(2 * n * j / (1 + j)))
        x = rng.integers(0, 2 ** 63, 2 * n - common).astype(np.uint64) * np.uint64(2)
        a, b = x[:n], x[n - common:]
        ra, rb, rx = (sketcher.registers(v, np.array([0, len(v)]))[0] for v in (a, b, x))
        more, less = int((ra > rb).sum()), int((ra < rb).sum())
        got = neardup.likely(*(np.array([float(v)]) for v in (more, less, s.registers - more - less, n, n)), s.base)
        assert abs(got[0] - j) < 0.1
        assert (np.maximum(ra, rb) == rx).all()


def test_shingle_hashes_depend_on_words_and_order_only():
    h, edges = neardup.shingles(pa.array(["a b c d e f", " A b\tc d e F ", "f e d c b a", "a b", None]), 5)
    part = [h[a:z].tolist() for a, z in zip(edges[:-1], edges[1:])]
    assert part[0] == part[1] and len(part[0]) == 2 and not set(part[0]) & set(part[2])
    assert len(part[3]) == 1 and part[4] == []


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(5, i) for i in range(6, 40)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {5, 100} and got[130] == 100 and got[39] == 5
    none = spark.createDataFrame([], "a long, b long")
    assert components(none).count() == 0


def test_word_helper_is_not_confused_by_sliced_arrays():
    from vaultline.llm import words as W
    batch = pa.record_batch({"t": pa.array(["Aa b", None, "C  d", "", "e"])}).slice(1)
    got = [W.split(p.column("t"), lower=True) for p in W.slices(batch, "t", 70)]
    assert [w for x, _ in got for w in x.to_pylist()] == ["c", "d", "e"]
    assert sum(len(off) - 1 for _, off in got) == 4
