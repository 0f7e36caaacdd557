"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (n = 1 to 3, inside
words, with word edges), in order of frequency. A document is ranked the same way, and is given the
language whose profile is nearest by out-of-place distance: the sum, over the
document's n-grams, of how many places apart an n-gram stands in both lists, and
``profile`` places for one that the language's list lacks.

Learning counts n-grams of all labelled training documents on the executors (a
batch sends one row per language and n-gram) and keeps ``profile`` rows per
language; only those reach the driver: ``profile`` rows for each value of ``lang``.

Edge cases: a null text, or one without letters, is ``und`` with score 0; so is
every text if nothing could be learned. Ties go to the language that sorts first.
Rows with a null ``lang`` are predicted but not learned from. Long texts are counted in pieces of
``piece`` characters. Code points beyond the basic plane are folded into it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_arrow, to_arrow
from .words import slices

SPACE, GAP = 0x20, 0x0A
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    profile: int = 300  # n-grams kept of a language and of a document
    piece: int = 1_000_000  # characters counted at once


def _clean(texts: pa.Array) -> pa.Array:
    """Lower case, runs of anything but letters as one space, a space at both ends."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    words = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL]+", " ")
    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    return pc.binary_join_element_wise(nothing, pc.utf8_trim(words, " "), nothing, space)


def _counted(texts: list[str], group: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``group << 48 | n-gram`` of the cleaned texts, ascending, and their counts."""
    joined = "\n".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    owner = np.repeat(np.array(group, np.uint64) << np.uint64(48),
                      np.diff(np.append(starts, len(cp))))
    c = np.where(cp > 0xFFFF, (cp & 0xFFFF) | 1, cp).astype(np.uint64)
    space, gap = cp == SPACE, cp == GAP
    keys = [(owner | c)[~space & ~gap]]
    gram, ok = c, ~gap
    for n in (2, 3):
        # a space may stand at either end of an n-gram, not inside it
        ok = ok[:-1] & ~gap[n - 1:]
        if n > 2:
            ok = ok & ~space[n - 2:len(space) - 1]
        gram = (gram[:-1] << np.uint64(16)) | c[n - 1:]
        both = space[:len(gram)] & space[n - 1:] if n == 2 else np.zeros(len(gram), bool)
        keys.append((owner[:len(gram)] | gram)[ok & ~both])
    return np.unique(np.concatenate(keys), return_counts=True)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)


def _blocks(texts: list[str], group: list[int], piece: int):
    """Lists of whole texts, and of pieces of the long ones, of about ``piece`` characters;
    ``last`` tells that the group's text ends with the block."""
    block, of, size = [], [], 0
    for t, g in zip(texts, group):
        if len(t) > piece and block:
            yield block, of, True
            block, of, size = [], [], 0
        while len(t) > piece:
            cut = t.rfind(" ", 1, piece)
            cut = piece if cut <= 0 else cut + 1
            head, t = t[:cut], " " + t[cut:] if t[cut - 1] == " " else t[cut:]
            yield [head], [g], False
        if block and size + len(t) > piece:
            yield block, of, True
            block, of, size = [], [], 0
        block.append(t)
        of.append(g)
        size += len(t)
    if block:
        yield block, of, True


def learn(docs: DataFrame, s: Settings = Settings()) -> dict[str, list[int]]:
    """Profile of each value of ``lang``: its n-grams, most frequent first."""
    given = docs.filter(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def run(batches):
        names, parts = {}, []  # languages are numbered as they come
        for b in (x for batch in batches for x in slices(batch, "text")):
            of = [names.setdefault(x, len(names)) for x in b.column("lang").to_pylist()]
            for block, group, _ in _blocks(_clean(b.column("text")).to_pylist(), of, s.piece):
                parts.append(_counted(block, group))
            parts = [_merged(parts)] if parts else []
        if parts:
            key, n = parts[0]
            yield pa.record_batch({
                "lang": pa.array(list(names)).take(pa.array((key >> np.uint64(48)).astype(np.int64))),
                "gram": pa.array((key & np.uint64(0xFFFFFFFFFFFF)).astype(np.int64)),
                "n": pa.array(n.astype(np.int64))})
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (map_arrow(given, run, "lang string, gram long, n long")
           .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
           .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= s.profile))
    profiles: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "place").collect():
        profiles.setdefault(r.lang, []).append(r.gram)
    return profiles


class Profiles:
    """Profiles as a table of places: a row per n-gram of any profile, a column per language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs = sorted(profiles)
        self.size = size
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p] + [0], np.int64))
        self.places = np.full((len(self.grams), len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            self.places[np.searchsorted(self.grams, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def nearest(self, key: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each of ``n`` texts the number of the nearest language (-1: no n-gram) and the score."""
        # by text, then count (largest first), then n-gram: the keys already ascend
        doc = (key >> np.uint64(48)).astype(np.int64)
        at = np.lexsort((-count.astype(np.int64), doc))  # stable, so ties stay in the order of the keys
        first = np.searchsorted(doc, np.arange(n))
        place = np.arange(len(doc)) - first[doc]
        top = place < self.size
        doc, place = doc[top], place[top]
        gram = (key[at[top]] & np.uint64(0xFFFFFFFFFFFF)).astype(np.int64)
        found = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[found] == gram
        best, far = np.full(n, -1, np.int64), np.full(n, np.inf)
        terms = np.bincount(doc, minlength=n)
        for j in range(len(self.langs)):
            there = self.places[found, j]
            apart = np.where(known & (there >= 0), np.abs(place - there), self.size)
            total = np.bincount(doc, apart, minlength=n)
            nearer = (total < far) & (terms > 0)
            best[nearer], far[nearer] = j, total[nearer]
        score = np.where(best >= 0, 1 - np.where(best >= 0, far, 0) / np.maximum(terms * self.size, 1), 0.0)
        return best, np.clip(score, 0.0, 1.0)


def identify(docs: DataFrame, profiles: dict[str, list[int]], s: Settings = Settings(),
             keep: dict[str, Column] | None = None) -> DataFrame:
    """``lang_pred`` and ``score`` of each document after the columns ``keep`` (default: ``doc_id``)."""
    keep = keep or {"doc_id": F.col("doc_id")}
    given = docs.select(*[c.alias(k) for k, c in keep.items()], F.col("text").cast("string").alias("__text"))
    model = Profiles(profiles, s.profile)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    schema += ", lang_pred string, score double"
    to = to_arrow(schema)

    def run(batches):
        for b in (x for batch in batches for x in slices(batch, "__text")):
            best, score, held = [], [], []  # held: counts of a long text, piece by piece
            for block, group, last in _blocks(_clean(b.column("__text")).to_pylist(),
                                              list(range(b.num_rows)), s.piece):
                key, n = _merged([*held, _counted(block, group)])
                held = [] if last else [(key, n)]
                if last:
                    first = np.uint64(group[0]) << np.uint64(48)
                    i, x = model.nearest(key - first, n, len(group))
                    best.append(i)
                    score.append(x)
            lang = pa.array(model.langs + [UNKNOWN]).take(pa.array(
                np.concatenate(best) % (len(model.langs) + 1)))  # -1 is the last one
            cols = [*b.columns[:-1], lang, pa.array(np.concatenate(score))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, to)], schema=to)
    return given.mapInArrow(run, schema)
