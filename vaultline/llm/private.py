"""Personal data: seed entities by their form, more by bootstrapped contexts.

Base entities are found by form: email addresses, IPv4 addresses, card numbers (Luhn) and phone
numbers, leftmost and non-overlapping per kind. They are the seeds.

Identifiers of other forms are found by where they stand. Each mention (a base
entity, or any other word that looks like an identifier: an ``@`` or at least
``min_digits`` digits) occurs in lexical patterns: its two words before, and its neighbours on both sides. Mentions and
patterns form a graph of patterns and instances, scored in rounds:

* a pattern's confidence is the share of its distinct instances that are known; it is accepted from
  ``min_pattern`` on, if at least ``min_known`` different known instances of one kind support it;
* an instance's confidence is that not all of its accepted patterns are wrong; from ``min_instance`` on
  it becomes known, with the kind that its patterns have most.

Rounds end when nothing new is found, which comes since known instances only grow. The texts are read once; the graph holds
mentions only, and all its steps are grouped aggregates and joins that Spark distributes. A frequent
pattern or instance is pre-aggregated. A text is scanned in linear time, whatever it holds.

Edge cases: null is the empty text: no spans; an empty table gives no rows; a text of any length is read whole, and so are words
of any length, but of a mention's neighbours only what lies within ``context`` characters of it is a pattern's word. Repeated rows are judged alike, and
count as one instance. New spans never overlap base ones. Offsets are code points. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored, to_arrow
from .words import slices

KINDS = ("email", "ip", "card", "phone")

# The forms of base entities. An address begins at the first digit of a run and takes whole runs, so
# a long run of digits is read once.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MARK = re.compile(r"[0-9@]")
SPACE = frozenset(" \t\n\x0b\x0c\r")
EDGE = "\"'`.,;:!?()[]{}<>|#*$%&=/\\"


@dataclass(frozen=True)
class Settings:
    min_digits: int = 4
    min_pattern: float = 0.8
    min_known: int = 3
    min_instance: float = 0.8
    context: int = 80  # characters on either side that may hold a mention's neighbours


def emails(text: str) -> list[tuple[int, int]]:
    """A match has one ``@`` and the longest run of local characters before it, so going from
    ``@`` to ``@`` finds what a scan from the left would."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def entities(text: str) -> list[tuple[int, int, int]]:
    """Base entities as (kind, start, end), by kind and start."""
    out = [(0, a, z) for a, z in emails(text)] if "@" in text else []
    if not MARK.search(text):
        return out
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def mentions(text: str, base: list[tuple[int, int, int]], s: Settings) -> list[dict]:
    """Base entities and other words that look like identifiers, with their patterns."""
    spans = [(a, z, k) for k, a, z in base]
    taken = sorted((a, z) for a, z, _ in spans)
    done, at, i = 0, MARK.search(text), 0
    while at:
        a = z = at.start()
        while a > done and text[a - 1] not in SPACE:
            a -= 1
        while z < len(text) and text[z] not in SPACE:
            z += 1
        done = z
        core = text[a:z]
        left = len(core) - len(core.lstrip(EDGE))
        core = core.strip(EDGE)
        b = a + left
        while i < len(taken) and taken[i][1] <= b:
            i += 1
        free = i == len(taken) or taken[i][0] >= b + len(core)
        if free and core and ("@" in core or len(_digits(core)) >= s.min_digits):
            spans.append((b, b + len(core), -1))
        at = MARK.search(text, z)
    out = []
    for a, z, k in spans:
        before = text[max(0, a - s.context):a].lower().split()
        after = text[z:z + s.context].lower().split()
        # what is glued to the mention belongs to its word, not to its context
        if before and a and text[a - 1] not in SPACE:
            before[-1:] = []
        if after and z < len(text) and text[z] not in SPACE:
            after[:1] = []
        before = ["^", "^", *(w.strip(EDGE) or w for w in before)][-2:]
        after = [*(w.strip(EDGE) or w for w in after), "$"][0]
        out.append({"start": a, "end": z, "kind": k, "instance": text[a:z].lower(),
                    "patterns": [f"{before[0]} {before[1]} _", f"{before[1]} _ {after}"]})
    return out


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for k, a, z in spans)


SPANS = "array<struct<kind:int,start:int,end:int>>"
MENTIONS = "array<struct<start:int,end:int,kind:int,instance:string,patterns:array<string>>>"


def read(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``id`` (of the row), ``doc_id``, counts of base entities, ``base_sha256``, ``base`` and ``mentions``; stored."""
    given = docs.select(F.monotonically_increasing_id().alias("id"), "doc_id",
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    schema = (f"id long, doc_id {kind}, " + "".join(f"n_{k} long, " for k in KINDS)
              + f"base_sha256 string, base {SPANS}, mentions {MENTIONS}")
    to = to_arrow(schema)

    def run(batches):
        for b in (x for batch in batches for x in slices(batch, "text", 4 << 20)):
            cols: list[list] = [[] for _ in to]
            for text in b.column("text").to_pylist():
                base = entities(text)
                row = [sum(k == j for k, _, _ in base) for j in range(len(KINDS))]
                row += [hashlib.sha256(told(base).encode()).hexdigest(),
                        [{"kind": k, "start": a, "end": z} for k, a, z in base], mentions(text, base, s)]
                for c, x in zip(cols[2:], row):
                    c.append(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("doc_id").cast(to.field("doc_id").type),
                 *[pa.array(c, f.type) for c, f in zip(cols[2:], list(to)[2:])]], schema=to)
    return stored(given.mapInArrow(run, schema), "entities")


def bootstrap(found: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Instances that patterns made known: ``instance`` and ``kind``."""
    m = found.select(F.explode("mentions").alias("m")).select("m.kind", "m.instance", "m.patterns")
    edges = stored(m.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pattern-graph")
    # an instance that is a base entity anywhere is a seed
    seeds = m.filter("kind >= 0").groupBy("instance").agg(F.min("kind").alias("kind"))
    seeds = stored(seeds, "known-instances")
    learned = seeds.limit(0)
    while True:
        known = seeds.unionByName(learned)
        kinds = edges.join(known, "instance", "left").groupBy("pattern", "kind").agg(
            F.count(F.lit(1)).alias("n"))
        # per pattern at most one row per kind and one for the unknown
        accepted = (kinds.groupBy("pattern").agg(
            F.sum("n").alias("all"), F.sum(F.when(F.col("kind").isNotNull(), F.col("n")).otherwise(0)).alias("good"),
            F.max(F.when(F.col("kind").isNotNull(), F.struct("n", (-F.col("kind")).alias("k")))).alias("top"))
            .filter((F.col("good") >= s.min_pattern * F.col("all")) & (F.col("top.n") >= s.min_known))
            .select("pattern", (F.col("good") / F.col("all")).alias("confidence"), (-F.col("top.k")).alias("kind")))
        wrong = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6))))
        scored = (edges.join(accepted, "pattern").join(known.select("instance"), "instance", "left_anti")
                  .groupBy("instance", "kind").agg(wrong.alias("wrong")))
        new = (scored.groupBy("instance").agg(F.sum("wrong").alias("wrong"),
                                              F.min(F.struct("wrong", "kind")).alias("best"))
               .filter(1 - F.exp("wrong") >= s.min_instance).select("instance", F.col("best.kind").alias("kind")))
        new = stored(new, "new-instances")
        if new.isEmpty():
            return learned
        learned = stored(learned.unionByName(new), "learned-instances")


def find(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans`` and ``n_learned``."""
    found = read(docs, s)
    learned = bootstrap(found, s)
    new = (found.select("id", F.explode("mentions").alias("m")).filter("m.kind < 0")
           .select("id", F.col("m.instance").alias("instance"), F.col("m.start").alias("start"),
                   F.col("m.end").alias("end")).join(learned, "instance")
           .groupBy("id").agg(F.collect_list(F.struct("kind", "start", "end")).alias("new")))
    spans = F.array_sort(F.concat("base", F.coalesce("new", F.array().cast(SPANS))))
    names = F.array(*[F.lit(k) for k in KINDS])
    text: Column = F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x.kind), x.start.cast("string"), x.end.cast("string"))), ",")
    return found.join(new, "id", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", text.alias("spans"),
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_learned"))
