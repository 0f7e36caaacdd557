import collections

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from vaultline.llm import bpe, lines, mixing, quality
from vaultline.llm.tables import stored

from ..conftest import SF_SMALL
from .test_lines_neardup import brute_groups, brute_lines

NAMES = ["quality rules", "line dedup", "near-dedup", "mixing", "byte-level BPE"]


def by_id(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_every_stage_against_its_own_input(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kinds = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], SF_SMALL), "stage"))
    for out in seen[1:-1]:
        assert out.columns == kinds
    given, good, once, single, mixed, coded = seen

    judged = {r.doc_id: r.kept for r in quality.quality_rules(given).collect()}
    before = by_id(given)
    assert by_id(good) == {k: before[k] for k, kept in judged.items() if kept}

    left = brute_lines(sorted((k, r["text"]) for k, r in by_id(good).items()), lines.Settings().min_words)
    assert {k: r["text"] for k, r in by_id(once).items()} == {
        k: t for k, (t, n, gone) in left.items() if gone == 0 or gone < n}

    groups = brute_groups([(k, r["text"]) for k, r in by_id(once).items()])
    assert sorted(by_id(single)) == sorted(k for k, n, first in groups if first is None or k == first or n == 0)

    copies = {r.row.doc_id: r.copies for r in mixing.mix(single).collect()}
    drawn = collections.Counter(r.doc_id for r in mixed.collect())
    assert drawn == {k: n for k, n in copies.items() if n}

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks=bpe.load_ranks(
        P.path("byte_bpe_multi_50k.tiktoken")))
    texts = {k: r["text"] for k, r in by_id(mixed).items()}
    assert coded.count() == mixed.count()
    for r in coded.collect():
        assert r.ids == library.encode_ordinary(texts[r.doc_id]) and library.decode(r.ids) == texts[r.doc_id]


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert out.filter(F.size("ids") != F.col("n_tokens")).count() == 0 and out.count() > 0


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, empty):
    docs = no_docs if empty else odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert (out.count() == 0) if empty else (out.filter("row != 'own row' or size != 7 or kept != 9").count() == 0)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()
