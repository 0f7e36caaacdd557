"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Words (matches of the split pattern) repeat a lot, and a word's tokens depend on
nothing but the word. So the corpus is encoded in three steps:

1. texts become sequences of word numbers, each unit of whole texts with a list of its
   distinct words (``numbered``, stored);
2. the words of all units, dealt by word, form the corpus's word table. The bytes of many distinct words
   are laid end to end and the merges replayed over all of them at once: an inverted index
   leads from each mergeable pair (named by the rank of the token it makes) to the
   positions where it stands; ranks are taken from a heap, lowest first, and a rank's merges are applied
   to all its positions together, touching only their neighbours (``Merger``, ``replayed``);
3. each unit gets the ids of its words and puts its texts together (``encode``).

Merges are ordered as the public tokenizer library orders them: lowest rank
first, leftmost first, and a word that is a token itself is taken whole. A token that can be part of
one with a lower rank (tokens can be split in several ways) is made once per word at a time, so the
lower rank comes first.

Shuffled are each unit's distinct words, packed and compressed by share of the word table, their ids alike, and the word
numbers of the texts; never texts. A common word is there once per unit. Memory per task is bounded: a unit's words are
numbered anew (a new block) at ``block_words`` distinct ones, also within a text, a long text comes in pieces, and
rows are read in order, one block's ids at a time. Shares grow in number with the corpus; their distinct words are
replayed ``replay_bytes`` at a time, a longer word alone.

Edge cases: null is encoded like the empty text: no tokens, digests of nothing.
Repeated rows give repeated results. Very long texts and very long words take several pieces or a replay of their
own. An empty table gives no rows. Other columns of the table are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import lzma
import zlib
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import estimated_bytes
from .tables import stored, to_arrow

ID = np.dtype("<u4")


@dataclass(frozen=True)
class Settings:
    pattern: str
    unit_words: int = 8_000_000  # a unit ends with the text that reaches this many
    block_words: int = 800_000  # distinct words numbered together
    piece_words: int = 100_000  # of texts sent in one row; a longer text comes in several
    share_bytes: int = 8 << 20  # of input to one share of the word table, and of packed words held at once
    replay_bytes: int = 2 << 20  # of distinct words replayed at once


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file (base64 token, space, rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class Merger:
    """Encodes words by replaying the merges over many of them at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ranks[t[:k]] * self.size + ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t))
                 if t[:k] in ranks and t[k:] in ranks]
        keys = np.array(sorted(pairs) or [(-1, -1)], np.int64)
        self.pairs, self.made = keys[:, 0].copy(), keys[:, 1].copy()
        a, b = self.pairs // self.size, self.pairs % self.size
        self.one_by_one = set(a[self.made < a].tolist()) | set(b[self.made < b].tolist())

    def made_by(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that each two neighbours make, or -1."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        parts = []
        for i, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is None and w:
                parts.append(i)
            elif w:
                out[i] = whole.to_bytes(4, "little")
        if not parts:
            return out
        length = np.array([len(words[i]) for i in parts])
        ids = self.first[np.frombuffer(b"".join([words[i] for i in parts]), np.uint8)]
        n = len(ids)
        word = np.repeat(np.arange(len(parts)), length)
        starts = np.cumsum(length) - length
        before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
        before[starts] = -1  # no links between words
        after[starts[1:] - 1] = n
        pair = np.full(n, -1)  # rank of what a symbol and the next one make
        where: dict[int, list[np.ndarray]] = {}  # the inverted index
        heap: list[int] = []

        def indexed(at: np.ndarray) -> None:
            right = after[at]
            ok = right < n
            rank = np.full(len(at), -1)
            rank[ok] = self.made_by(ids[at[ok]], ids[right[ok]])
            pair[at] = rank
            at, rank = at[rank >= 0], rank[rank >= 0]
            if len(at) == 0:
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            edges = np.flatnonzero(np.diff(rank)) + 1
            for r, p in zip(rank[np.concatenate([[0], edges])].tolist(), np.split(at, edges)):
                if r in where:
                    where[r].append(p)
                else:
                    where[r] = [p]
                    heapq.heappush(heap, r)

        indexed(np.arange(n))
        while heap:
            rank = heapq.heappop(heap)
            at = np.sort(np.concatenate(where.pop(rank)))
            fresh = pair[at] == rank  # others have changed since
            fresh[1:] &= at[1:] != at[:-1]
            at = at[fresh]
            if len(at) == 0:
                continue
            later = None
            if rank in self.one_by_one:
                of = word[at]
                leftmost = np.append(True, of[1:] != of[:-1])
                at, later = at[leftmost], at[~leftmost]
            elif len(at) > 1 and (pair[after[at[:-1]]] == rank).any():  # pairs that share a symbol: leftmost first
                taken, gone = [], -1
                for p, q in zip(at.tolist(), after[at].tolist()):
                    if p != gone:
                        taken.append(p)
                        gone = q
                at = np.array(taken)
            right = after[at]
            ids[at], ids[right], pair[right] = rank, -1, -1
            beyond = after[right]
            after[at] = beyond
            inside = beyond < n
            before[beyond[inside]] = at[inside]
            left = before[at]
            left = left[left >= 0]
            indexed(np.concatenate([at, left]))
            if later is not None and len(later):
                if rank in where:
                    where[rank].append(later)
                else:
                    where[rank] = [later]
                    heapq.heappush(heap, rank)
        ends = np.cumsum(np.concatenate([[0], ids >= 0]))
        packed = ids[ids >= 0].astype(ID).tobytes()
        edges = (4 * ends[np.append(starts, n)]).tolist()
        for k, i in enumerate(parts):
            out[i] = packed[edges[k]:edges[k + 1]]
        return out


def _pieces(text: str | None, pattern, most: int):
    """The words of a text in order, and whether they are its last; a long text comes in several pieces."""
    if not text or len(text) <= most:
        yield pattern.findall(text or ""), True
        return
    found = (m[0] for m in pattern.finditer(text))
    last = False
    while not last:
        words = list(islice(found, most))
        last = len(words) < most
        yield words, last


def _packed(numbers) -> bytes:
    """Numbers as their lowest bytes, then the next ones, and so on, compressed: the high ones take little."""
    return zlib.compress(np.asarray(numbers, ID).view(np.uint8).reshape(-1, 4).T.tobytes(), 6)


def _unpacked(planes: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(planes), np.uint8).reshape(4, -1).T.copy().view(ID).ravel()


#: Words in order, four bytes each: contexts follow the byte's place.
SEQUENCE = {"format": lzma.FORMAT_RAW, "filters": [{"id": lzma.FILTER_LZMA2, "preset": 2, "lc": 2, "lp": 2, "pb": 2, "dict_size": 1 << 20}]}


def _sequence(numbers: list[int], known: int) -> bytes:
    """Word numbers, where ``known`` words had one before: 0 is the first use of the next number, k + 1 the word k."""
    a = np.array(numbers, np.int64)
    top = np.maximum(known, np.concatenate([[0], np.maximum.accumulate(a)[:-1] + 1])) if len(a) else a
    return lzma.compress(np.where(a == top, 0, a + 1).astype(">u4").tobytes(), **SEQUENCE)


def _resolved(packed: bytes, known: int) -> tuple[np.ndarray, int]:
    """Word numbers of a sequence, and how many words have one after it."""
    a = np.frombuffer(lzma.decompress(packed, **SEQUENCE), ">u4").astype(np.int64) - 1
    first = a < 0
    n = int(first.sum())
    a[first] = known + np.arange(n)
    return a, known + n


def _cut(joined: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _shares(docs: DataFrame, s: Settings) -> int:
    size = estimated_bytes(docs)
    return max(64, -(-(size or 0) // s.share_bytes))


def numbered(docs: DataFrame, s: Settings) -> DataFrame:
    """Texts as word numbers, and the words of each block by share of the word table (a hash of the word). Rows, by ``kind``:
    0, a share of a block's words in order of number (``at`` the share; ``sizes`` and ``packed`` words);
    1, the share of each of its words by number (``packed``);
    2, texts in order (``at`` their place in the unit, ``docs`` the ids of those that end here, ``sizes`` the words of each,
    ``last`` whether the last of them ends here, ``packed`` numbers)."""
    given = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    to = to_arrow(schema := (f"unit long, block int, kind int, at int, docs array<{kind}>, last boolean, sizes binary, "
                             "packed binary"))
    shares = _shares(given, s)

    def sent(rows, ids):
        """``rows`` as Arrow; their fifth fields are row numbers of ``ids``."""
        cols = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), [*list(to)[:4], pa.field("i", pa.list_(pa.int64())), *list(to)[5:]])]
        of = cols[4]
        cols[4] = pa.ListArray.from_arrays(of.offsets, ids.take(of.flatten()).cast(to.field("docs").type.value_type))
        return pa.RecordBatch.from_arrays(cols, schema=to)

    def run(batches):
        pattern, number = regex.compile(s.pattern), {}
        unit, block, at, n = TaskContext.get().partitionId() << 33, 0, 0, 0

        def table():
            words = [w.encode() for w in number]
            number.clear()
            share = np.array([zlib.crc32(w) for w in words], np.int64) % shares
            size = np.array([len(w) for w in words], ID)
            order = np.argsort(share, kind="stable")
            edges = np.flatnonzero(np.diff(share[order])) + 1
            rows = [(unit, block, 1, 0, [], None, None, _packed(share))]
            for part in np.split(order, edges):
                some = zlib.compress(b"".join([words[k] for k in part.tolist()]), 6)
                rows.append((unit, block, 0, int(share[part[0]]), [], None, _packed(size[part]), some))
            return rows

        for part in batches:
            ids, rows = part.column("doc_id"), []
            ends, sizes, numbers, known = [], [], [], len(number)
            for i, text in enumerate(part.column("text")):
                for words, last in _pieces(text.as_py(), pattern, s.piece_words):
                    numbers += [number.setdefault(w, len(number)) for w in words]
                    sizes.append(len(words))
                    if last:
                        ends.append(i)
                    n += len(words)
                    ended, full = last and n >= s.unit_words, len(number) >= s.block_words
                    if not (ended or full or len(numbers) >= s.piece_words):
                        continue
                    rows.append((unit, block, 2, at, ends, last, _packed(sizes), _sequence(numbers, known)))
                    at += 1
                    if ended or full:
                        if number:
                            rows += table()
                        unit, block = (unit + 1, 0) if ended else (unit, block + 1)
                        at, n = (0, 0) if ended else (at, n)
                    yield sent(rows, ids)
                    rows, ends, sizes, numbers, known = [], [], [], [], len(number)
            if sizes:
                yield sent([(unit, block, 2, at, ends, True, _packed(sizes), _sequence(numbers, known))], ids)
                at += 1
        if number:
            yield sent(table(), pa.nulls(0, to.field("docs").type.value_type))
    return stored(given.mapInArrow(run, schema), "word-numbers")


def replayed(words: DataFrame, ranks: dict[bytes, int], s: Settings) -> DataFrame:
    """``unit``, ``block``, ``kind`` 0, ``at`` (the share), ``sizes`` (bytes of each word's ids) and ``packed`` ids of each row's
    words. Rows are dealt and sorted by share, so that the merges are replayed over each distinct word of a share
    once, as long as it stays within the bytes held at once."""
    to = to_arrow(schema := "unit long, block int, kind int, at int, sizes binary, packed binary")

    def run(batches):
        merger = Merger(ranks)

        def done(rows):
            number, of = {}, []
            for *_, sizes, packed in rows:
                of.append([number.setdefault(w, len(number)) for w in _cut(zlib.decompress(packed), _unpacked(sizes))])
            words = list(number)
            group = np.cumsum([0] + [len(w) for w in words[:-1]]) // s.replay_bytes
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(words)]
            codes = [c for a, b in zip(edges[:-1], edges[1:]) for c in merger.replay(words[a:b])]
            size = np.array([len(c) for c in codes], ID)
            out = [(*row[:4], _packed(size[ws]), _packed(np.frombuffer(b"".join([codes[w] for w in ws]), ID)))
                   for row, ws in zip(rows, of)]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), to)], schema=to)

        rows, held, share = [], 0, None
        for part in batches:
            for row in zip(*(part.column(f.name).to_pylist() for f in to)):
                if rows and (held >= s.share_bytes or held >= s.replay_bytes and row[3] != share):
                    yield done(rows)
                    rows, held = [], 0
                rows.append(row)
                held, share = held + 3 * len(row[5]), row[3]
        if rows:
            yield done(rows)
    return (words.select(*[f.name for f in to]).repartition("at").sortWithinPartitions("at", "unit", "block")
            .mapInArrow(run, schema))


def encode(docs: DataFrame, ranks: dict[bytes, int], s: Settings, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, ``with_ids``, ``ids``
    (array of int) of each document. Decoding starts from the ids alone."""
    corpus = numbered(docs, s)
    kind = corpus.schema["docs"].dataType.elementType.simpleString()
    schema = (f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
              + ", ids array<int>" * with_ids)
    to = to_arrow(schema)
    codes = replayed(corpus.filter("kind = 0"), ranks, s)
    both = (corpus.filter("kind > 0").unionByName(codes, allowMissingColumns=True).repartition("unit")
            .sortWithinPartitions("unit", "block", "kind", "at"))

    def result(docs, out, lists):
        cols = [docs, *(pa.array(list(c)) for c in zip(*out))]
        if with_ids:
            off = np.cumsum([0] + [len(x) // 4 for x in lists])
            flat = np.frombuffer(b"".join(lists), ID).astype(np.int32)
            cols.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat)))
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, to)], schema=to)

    def run(batches):
        tokens = {r: t for t, r in ranks.items()}
        block, by_share, codes, known = None, [], [], 0
        ids, plain, count, parts = hashlib.sha256(), hashlib.sha256(), 0, []
        for part in batches:
            out, lists, docs, done, held = [], [], part.column("docs").flatten(), 0, 0
            columns = (part.column(c).to_pylist() for c in ("unit", "block", "kind", "last", "sizes", "packed"))
            for unit, k, what, last, sizes, packed in zip(*columns):
                if (unit, k) != block:
                    block, by_share, codes, known = (unit, k), [], [], 0
                if what == 0:
                    by_share += _cut(_unpacked(packed).tobytes(), _unpacked(sizes))
                    continue
                if what == 1:  # shares came in order, and their words in order of number
                    order = np.argsort(_unpacked(packed), kind="stable").tolist()
                    codes = [b""] * len(order)
                    for w, code in zip(order, by_share):
                        codes[w] = code
                    by_share = []
                    continue
                numbers, known = _resolved(packed, known)
                sizes = _unpacked(sizes)
                of = np.split(numbers, np.cumsum(sizes)[:-1])
                for j, ws in enumerate(of):
                    got = b"".join([codes[w] for w in ws.tolist()])
                    count += len(got) // 4
                    ids.update(got)
                    plain.update(b"".join(map(tokens.__getitem__, np.frombuffer(got, ID).tolist())))
                    if with_ids:
                        parts.append(got)
                    if last or j < len(of) - 1:
                        out.append((count, ids.hexdigest(), plain.hexdigest()))
                        lists.append(b"".join(parts))
                        held += count
                        ids, plain, count, parts = hashlib.sha256(), hashlib.sha256(), 0, []
                if held >= s.unit_words:
                    yield result(docs[done:done + len(out)], out, lists)
                    done, held = done + len(out), 0
                    out, lists = [], []
            if out:
                yield result(docs[done:], out, lists)
    return both.mapInArrow(run, schema)
