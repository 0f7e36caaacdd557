"""Quality rules by weak supervision.

Each rule votes *keep*, *reject* or abstains on a document. Rules are noisy, so
no single vote decides: expectation-maximisation over the counts of vote
patterns estimates how often each rule votes each way on good and on bad
documents, and a document's posterior probability of being good decides.

The corpus is read twice: once to count vote patterns (at most ``3 ** rules`` of
them, a few hundred in practice, pre-aggregated on the executors), and once to
score. The EM itself runs on that bounded table of patterns, never on documents.

Edge cases: a null or empty text has no words, so every measure is 0 and the
base rule (fewer than ``min_words`` words) fails it. Repeated rows are judged
alike and all come back. An empty table gives an empty result. Other columns of
``docs`` are carried in one struct and cannot clash with measures.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import map_arrow

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_letters", "n_chars", "n_upper_words", "n_same_as_before", "n_bangs", "n_distinct")
SYMBOLS = b"#*$%&|<>"
KEEP, ABSTAIN, REJECT = 1, 0, -1


@dataclass(frozen=True)
class Rule:
    """Votes by a ratio of two measures: keep within ``keep``, reject outside ``sound``,
    abstain between, and abstain below ``least`` of the denominator."""
    name: str
    over: str
    under: str
    keep: tuple[float, float]
    sound: tuple[float, float]
    least: int = 1

    def votes(self, m: dict[str, np.ndarray]) -> np.ndarray:
        n = m[self.under]
        x = m[self.over] / np.maximum(n, 1)
        out = np.zeros(len(n), np.int64)
        out[(x >= self.keep[0]) & (x <= self.keep[1])] = KEEP
        out[(x < self.sound[0]) | (x > self.sound[1])] = REJECT
        out[n < self.least] = ABSTAIN
        return out


RULES = (
    Rule("word length", "word_chars", "n_words", (3.5, 7.0), (2.5, 12.0), 5),
    Rule("symbols", "n_symbols", "n_words", (0.0, 0.05), (0.0, 0.2)),
    Rule("repeated lines", "n_dup_lines", "n_lines", (0.0, 0.1), (0.0, 0.45), 4),
    Rule("repeated windows", "n_repeat_words", "n_words", (0.0, 0.05), (0.0, 0.3), 16),
    Rule("letters", "n_letters", "word_chars", (0.95, 1.0), (0.88, 1.0), 500),
    Rule("vocabulary", "n_distinct", "n_words", (0.4, 1.0), (0.2, 1.0), 10),
    Rule("upper case", "n_upper_words", "n_words", (0.0, 0.2), (0.0, 0.6), 5),
    Rule("stuttering", "n_same_as_before", "n_words", (0.0, 0.04), (0.0, 0.2), 10),
    Rule("exclamation marks", "n_bangs", "n_words", (0.0, 0.1), (0.0, 0.5), 5),
)


@dataclass(frozen=True)
class Settings:
    rules: tuple[Rule, ...] = RULES
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    threshold: float = 0.5
    rounds: int = 200
    tolerance: float = 1e-9
    start_bad: float = 0.1
    start_reject: tuple[float, float] = field(default=(0.3, 0.01))  # on bad, on good documents
    prior_weight: float = 0.05  # of the starting rates, as a share of all documents


def measures(texts: pa.Array, window: int = 8) -> dict[str, np.ndarray]:
    """Every measure of each text of one Arrow batch."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    flat, off = W.split(texts)
    ids, distinct = W.numbered(flat)
    n = len(texts)
    m = {"n_words": np.diff(off)}
    length = pc.utf8_length(distinct).to_numpy().astype(np.int64) if len(distinct) else np.zeros(0, np.int64)
    upper = (pc.utf8_is_upper(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
             if len(distinct) else np.zeros(0, np.int64))
    m["word_chars"] = W.sums(length[ids], off)
    m["n_upper_words"] = W.sums(((length > 1) & (upper == 1))[ids].astype(np.int64), off)

    raw, at = _bytes(texts)
    of = np.zeros(256, np.int8)
    of[list(SYMBOLS)] = 1
    m["n_symbols"] = W.sums(of[raw].astype(np.int64), at)
    m["n_bangs"] = W.sums((raw == ord("!")).astype(np.int64), at)
    # letters: ASCII letters, and every code point beyond ASCII (its lead byte)
    letter = ((raw | 0x20) >= ord("a")) & ((raw | 0x20) <= ord("z")) | (raw >= 0xC0)
    m["n_letters"] = W.sums(letter.astype(np.int64), at)
    m["n_chars"] = pc.utf8_length(texts).to_numpy().astype(np.int64)

    lists = pc.split_pattern(texts, "\n")
    lines, lat = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(pc.ascii_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
    line_id, _ = W.numbered(lines)
    line_doc = np.repeat(np.arange(n), np.diff(lat))[full]
    m["n_lines"] = np.bincount(line_doc, minlength=n)
    pair = np.unique(line_doc * (len(lines) + 1) + line_id[full])
    m["n_dup_lines"] = m["n_lines"] - np.bincount(pair // (len(lines) + 1), minlength=n)

    doc = np.repeat(np.arange(n), np.diff(off))
    same = np.zeros(len(ids), np.int64)
    same[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    m["n_same_as_before"] = W.sums(same, off)
    m["n_distinct"] = np.bincount(np.unique(doc * (len(distinct) + 1) + ids) // (len(distinct) + 1),
                                  minlength=n)
    m["n_repeat_words"] = _repeated(ids, off, window)
    return m


def _bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def _repeated(ids: np.ndarray, off: np.ndarray, size: int) -> np.ndarray:
    """Words of each text that lie in a window found at least twice in that text."""
    start, doc = W.windows(ids, off, size)
    if len(start) == 0:
        return np.zeros(len(off) - 1, np.int64)
    key = W.rolled(W.mixed(ids.astype(np.uint64) + np.uint64(1)), start, size)
    key ^= W.mixed(doc.astype(np.uint64) + np.uint64(0xABCDEF))
    order = np.argsort(key, kind="stable")
    alike = key[order[1:]] == key[order[:-1]]
    a, b = order[:-1][alike], order[1:][alike]
    true = doc[a] == doc[b]  # equal hashes are confirmed on the words themselves
    for j in range(size):
        true &= ids[start[a] + j] == ids[start[b] + j]
    edge = np.zeros(len(ids) + 1, np.int64)
    hit = np.unique(np.concatenate([a[true], b[true]]))
    np.add.at(edge, start[hit], 1)
    np.add.at(edge, start[hit] + size, -1)
    return W.sums((np.cumsum(edge)[:-1] > 0).astype(np.int64), off)


def _codes(m: dict[str, np.ndarray], rules: tuple[Rule, ...]) -> np.ndarray:
    """One number for all votes: base 3, a digit (vote + 1) for each rule."""
    code = np.zeros(len(m["n_words"]), np.int64)
    for r in rules:
        code = code * 3 + r.votes(m) + 1
    return code


def _base_failed(m: dict[str, np.ndarray], s: Settings) -> np.ndarray:
    return (m["n_words"] < s.min_words) | (100 * m["n_repeat_words"]
                                           > s.max_repeat_percent * m["n_words"])


def vote_counts(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Number of documents with each vote pattern: ``(code, n)``."""
    def run(batches):
        total: dict[int, int] = {}
        for b in (x for batch in batches for x in W.slices(batch, "text")):
            code, n = np.unique(_codes(measures(b.column(0), s.window), s.rules), return_counts=True)
            for c, k in zip(code.tolist(), n.tolist()):
                total[c] = total.get(c, 0) + k
        yield pa.record_batch({"code": pa.array(list(total), pa.int64()),
                               "n": pa.array(list(total.values()), pa.int64())})
    return (map_arrow(docs.select(F.col("text").cast("string").alias("text")), run, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


@dataclass
class Model:
    """What EM learned: the share of good documents and each rule's vote rates
    (``rate[class, rule, vote + 1]``, class 1 is good)."""
    good: float
    rate: np.ndarray

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        votes = digits(codes, self.rate.shape[1])
        logs = [np.log(p) + sum(np.log(self.rate[k, r, votes[:, r]]) for r in range(votes.shape[1]))
                for k, p in ((0, 1 - self.good), (1, self.good))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def digits(codes: np.ndarray, rules: int) -> np.ndarray:
    return np.stack([codes // 3 ** (rules - 1 - r) % 3 for r in range(rules)], axis=1)


def expectation_maximisation(codes: np.ndarray, n: np.ndarray, s: Settings = Settings()) -> Model:
    """Two-class naive Bayes over the counted patterns, fitted without labels. The
    starting rates stay as a prior of ``prior_weight``: it keeps the classes from
    swapping meaning, and a vote never seen keeps a positive rate. An abstention
    says nothing: it has the same rate in both classes."""
    k = len(s.rules)
    bad, good = s.start_reject
    start = np.array([[[bad, 0.0, 1 - bad]] * k, [[good, 0.0, 1 - good]] * k])
    prior = start * (1 + s.prior_weight * float(n.sum()) if len(codes) else 1)
    model = Model(1 - s.start_bad, _rates(0 * start, prior))
    if len(codes) == 0:
        return model
    votes = digits(codes, k)
    before = -np.inf
    for _ in range(s.rounds):
        p = model.posterior(codes)
        share = np.clip((n * p).sum() / n.sum(), 1e-6, 1 - 1e-6)
        count = np.zeros((2, k, 3))
        for r in range(k):
            for v in (0, 2):
                at = votes[:, r] == v
                count[0, r, v], count[1, r, v] = (n * (1 - p))[at].sum(), (n * p)[at].sum()
        model = Model(float(share), _rates(count, prior))
        now = float((n * p).sum())
        if abs(now - before) <= s.tolerance * n.sum():
            break
        before = now
    return model


def _rates(count: np.ndarray, prior: np.ndarray) -> np.ndarray:
    weight = count + prior
    weight[:, :, 1] = 0
    rate = weight / weight.sum(axis=2, keepdims=True)
    rate[:, :, 1] = 1.0
    return rate


def fit(docs: DataFrame, s: Settings = Settings()) -> Model:
    """Fit the vote model on all documents. Only counted patterns reach the driver:
    at most ``3 ** rules`` rows however many documents there are."""
    got = vote_counts(docs, s).orderBy("code").collect()
    return expectation_maximisation(np.array([r.code for r in got], np.int64),
                                    np.array([r.n for r in got], np.float64), s)


def judge(docs: DataFrame, model: Model, s: Settings = Settings(), carry: bool = False,
          only_kept: bool = False) -> DataFrame:
    """Measures, votes and verdict of each document: ``row`` (all columns of ``docs`` as
    a struct when ``carry``, else only ``doc_id``), the measures, ``code`` (its vote pattern),
    ``base_failed``, ``quality`` (the posterior) and ``kept``."""
    names = docs.columns if carry else ["doc_id", "text"]
    given = docs.select(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`")
                                   for c in names]).alias("row"))
    at = names.index("text")  # texts come once, inside the row
    kinds = ", ".join(f"{x} long" for x in MEASURES)
    out_row = given.schema["row"].dataType.simpleString() if carry else \
        f"struct<doc_id:{given.schema['row'].dataType['doc_id'].dataType.simpleString()}>"

    def run(batches):
        for batch in batches:
            rows = batch.column("row")
            batch = pa.record_batch({"row": rows if carry else pa.StructArray.from_arrays(
                [rows.field(names.index("doc_id"))], ["doc_id"]), "text": rows.field(at)})
            for b in W.slices(batch, "text"):
                yield judged(b)

    def judged(b):
        m = measures(b.column("text"), s.window)
        code = _codes(m, s.rules)
        failed = _base_failed(m, s)
        quality = model.posterior(code)
        kept = ~failed & (quality >= s.threshold)
        out = pa.record_batch({"row": b.column("row")} | {x: pa.array(m[x], pa.int64()) for x in MEASURES}
                              | {"code": pa.array(code), "base_failed": pa.array(failed),
                                 "quality": pa.array(quality), "kept": pa.array(kept)})
        return out.filter(pa.array(kept)) if only_kept else out

    return given.mapInArrow(run, f"row {out_row}, {kinds}, code long, base_failed boolean, "
                                 "quality double, kept boolean")


def quality_rules(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, the measures, ``base_failed``, ``quality`` and ``kept``."""
    out = judge(docs, fit(docs, s), s)
    return out.select(F.col("row.doc_id").alias("doc_id"), *MEASURES, "base_failed", "quality", "kept")


def quality_filter(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents that quality rules keep, with all their columns."""
    out = judge(docs, fit(docs, s), s, carry=True, only_kept=True)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
