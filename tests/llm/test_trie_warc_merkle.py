import hashlib
import random
import zlib
from collections import defaultdict

from vaultline.llm import merkle, trie, warc
from vaultline.llm.tables import table

from ..conftest import SF_SMALL


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- op11 --------------------------------------------------------------------------

def brute_trie(rows):
    """Nodes by listing every prefix of every rebuilt conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + t[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
        ends[tuple(t)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   sha(",".join(map(str, sorted(ends[p]))))) for p, m in members.items()), built


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(row):
    return tuple((x is not None, x) for x in row)


def trie_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=key)


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "'x' as box", "1 as depth", "'y' as up").repartition(3)  # names the operator uses itself


def test_trie_bursts_and_sweeps_to_the_same_nodes(spark):
    rng = random.Random(4)
    rows = []
    for c in range(-110, 420):
        start = rng.choice(["hello", "hi", "a long opening " * 9])
        for t in range(rng.choice([0, 1, 2, 4, 7, 9])):
            said = start if t < 3 else rng.choice(["yes", "no", "é你"])
            rows.append((c, rng.choice([t, t, None]) if t == 0 else t, ["user", "assistant"][t % 2], said))
    expected, built = brute_trie(rows)
    assert any(len(t) > 6 for t in built.values()) and any(not t for t in built.values())
    df = conversations(spark, rows)
    expected = sorted(expected, key=key)
    for turns in (1, 7, 60, 100_000):  # from bursting all the way to one container
        assert trie_rows(trie.conversation_trie(df, trie.Settings(container_turns=turns))) == expected, turns


def test_trie_bursts_by_rounds_of_branching_not_of_depth(spark, monkeypatch):
    shared = [(c, t, "user", f"turn {t}") for c in range(0, 3000, 100) for t in range(200)]
    rows = shared + [(c, 200 + t, "user", f"own {c} {t}") for c in range(0, 3000, 100) for t in range(3)]
    seen = []
    burst = trie.burst
    monkeypatch.setattr(trie, "burst", lambda *a: seen.append(burst(*a)) or seen[-1])
    got = trie_rows(trie.conversation_trie(conversations(spark, rows), trie.Settings(container_turns=50)))
    assert len(seen[0][0]) == 1
    assert got == sorted(brute_trie(rows)[0], key=key)


def test_trie_of_odd_input(spark):
    rows = [(5, None, None, None), (5, 1, "", ""), (5, 1, "user", "x" * 300_000), (None, 0, "user", "no id"),
            (7, 3, "user", "same"), (7, 3, "user", "same"), (0, 0, "user", "a|b"), (0, 1, "use", "ra|b"), (104, 0, "user", "z")]
    df = conversations(spark, rows)
    got = trie_rows(trie.conversation_trie(df))
    members = {r[0] for r in got}
    assert None not in members and sum(r[1] == 0 for r in got) == 1
    assert [r[3] for r in got if r[1] == 0] == [4]
    assert trie.conversation_trie(df.limit(0)).count() == 0


# -- op12 --------------------------------------------------------------------------

def archive(*texts, level=6):
    s = warc.Settings()
    return [warc.members(warc.record(str(i), f"http://x/{i} y", t.encode(), None, s), level) for i, t in enumerate(texts)]


def told(data):
    return [(type(x).__name__, x.start, x.end) for x in warc.salvage(data)]


def test_members_end_with_the_separator_and_concatenate():
    big = "é" * (9 << 20)
    parts = archive("small", big)
    assert all(p[-1] == 0 for p in parts)
    found = list(warc.salvage(b"".join(parts)))
    assert [x.payload.decode() for x in found] == ["small", big]
    assert found[1].headers["warc-target-uri"] == "http://x/1%20y"


def test_salvage_finds_later_records_and_logs_exact_gaps():
    texts = [f"payload {i} " * 200 for i in range(6)]
    parts = archive(*texts)
    at = [sum(map(len, parts[:i])) for i in range(7)]
    whole = b"".join(parts)
    ok = [("Record", a, z) for a, z in zip(at, at[1:])]
    assert told(whole) == ok
    for flip in (at[2], at[2] + 40, at[3] - 6, at[3] - 2):  # magic, data, check sum, size of the third
        damaged = bytearray(whole)
        damaged[flip] ^= 0x55
        assert told(bytes(damaged)) == ok[:2] + [("Gap", at[2], at[3])] + ok[3:], flip
    # two neighbours damaged: one gap; a cut end: the rest is a gap; junk and padding between
    damaged = bytearray(whole)
    damaged[at[1] + 50] ^= 1
    damaged[at[2] + 50] ^= 1
    assert told(bytes(damaged)) == ok[:1] + [("Gap", at[1], at[3])] + ok[3:]
    assert told(whole[:-5]) == ok[:5] + [("Gap", at[5], len(whole) - 5)]
    mixed = parts[0] + b"\0" * 9000 + parts[1] + b"junk" + parts[2]
    a = at[2] + 9000
    assert told(mixed) == [ok[0], ("Record", at[1] + 9000, a), ("Gap", a, a + 4), ("Record", a + 4, a + 4 + len(parts[2]))]
    # the middle of a member is lost, so its remainder runs into the next one
    assert told(whole[:at[2] + 30] + whole[at[3]:])[2:] == [("Gap", at[2], at[2] + 30)] + [
        ("Record", x - at[3] + at[2] + 30, z - at[3] + at[2] + 30) for _, x, z in ok[3:]]
    assert told(b"") == [] and told(b"\0\0") == [] and told(b"abc") == [("Gap", 0, 3)]


def test_salvage_reads_plain_records_and_checks_digests():
    s = warc.Settings()
    plain = [warc.record(str(i), None, f"text with WARC/1.0 inside {i}".encode(), None, s) for i in range(3)]
    data = b"".join(plain)
    at = [0, len(plain[0]), len(plain[0]) + len(plain[1]), len(data)]
    assert told(data) == [("Record", a, z) for a, z in zip(at, at[1:])]
    damaged = data.replace(b"inside 1", b"inside 7")
    assert told(damaged)[1] == ("Gap", at[1], at[2])
    assert [x.reason for x in warc.salvage(damaged) if isinstance(x, warc.Gap)] == ["block digest differs"]
    # a record without its closing line does not take the next one with it
    assert told(plain[0][:-4] + plain[1]) == [("Gap", 0, at[1] - 4), ("Record", at[1] - 4, at[2] - 4)]


def test_archives_survive_damage_on_disk(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 300) for i in range(40)],
                                  "page_id long, url string, html string").coalesce(1)
    warc.write(pages, str(tmp_path / "a"), s=warc.Settings(archive_records=20))
    files = sorted((tmp_path / "a").glob("part-*"))
    assert len(files) == 2
    data = bytearray(files[0].read_bytes())
    data[len(data) // 2] ^= 0xFF
    copy = tmp_path / "b"
    copy.mkdir()
    (copy / "one").write_bytes(bytes(data))
    (copy / "two").write_bytes(files[1].read_bytes())
    rows = warc.read(spark, str(copy)).collect()
    gaps = [r for r in rows if r.reason]
    assert len(gaps) == 1 and len(rows) == 40
    sizes = {f"page {i} " * 300 for i in range(40)}
    assert {bytes(r.payload).decode() for r in rows if not r.reason} < sizes
    whole = [r for r in rows if r.archive == gaps[0].archive]
    assert sum(r.end - r.start for r in whole) == len(data)  # no byte is unaccounted for


def test_round_trip_of_odd_pages(spark):
    long = "long " * 1000
    rows = [(1, "u", long), (2, "u", long), (9, None, long), (9, None, long), (None, "bad\r\nurl <x>", long), (3, "u", None),
            (4, "u", None), (5, "u", "é" * 500), (6, "u", "é" * 500), (7, "u", "x" * 999), (8, "u", "x" * 999),
            (10, "u", "a\0b " + "\U0001f600" * 400_000), (None, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'k' as key", "'s' as sha", "3 as bytes").repartition(4)
    got = sorted((tuple(r) for r in warc.round_trip(df).collect()), key=lambda r: tuple((x is not None, x) for x in r))
    newest = {hashlib.sha1(long.encode()).hexdigest(): 9, hashlib.sha1(("é" * 500).encode()).hexdigest(): 6}

    def expected(page, html):
        data = (html or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        top = newest.get(digest)
        again = page is not None and top is not None and page < top
        return page, len(data), digest, "revisit" if again else "response", top if again else None
    assert got == sorted((expected(p, h) for p, _, h in rows), key=lambda r: tuple((x is not None, x) for x in r))
    assert warc.round_trip(df.limit(0)).count() == 0


# -- op13 --------------------------------------------------------------------------

def leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def grow(nodes, arity):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i:i + arity])) for i in range(0, len(now), arity)])
    return levels


def siblings(levels, i, arity):
    out = []
    for level in levels[:-1]:
        run = i // arity * arity
        out.append((level[run:i], level[i + 1:run + arity]))
        i //= arity
    return out


def brute_proofs(rows, arity=3):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: ((r[0] is not None, r[0] or 0), leaf(*r)))
        trees[s] = grow([leaf(*r) for r in groups[s]], arity)
    over = grow([trees[s][-1][0] for s in order], arity)
    out = []
    for g, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            way = siblings(trees[s], i, arity) + siblings(over, g, arity)
            proof = sha("".join(x for left, right in way for x in (*left, *right)))
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            acc = leaf(*r[:4], r[4].replace("\n", "")) if bad else leaf(*r)
            for left, right in way:
                acc = sha("".join((*left, acc, *right)))
            out.append((r[0], leaf(*r), trees[s][-1][0], over[-1][0], proof, acc, acc == over[-1][0]))
    return sorted(out, key=key)


def test_proofs_equal_brute_force_whatever_the_blocks(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "a", "b", None, "é", f"s{i % 7}"]), rng.choice(["en", None]), i, f"text {i}\nline")
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    expected = brute_proofs(rows)
    assert {v for *_, v in expected} == {True, False}
    for levels in (1, 2, 7):  # from blocks of three leaves to one block a source
        got = sorted((tuple(r) for r in merkle.proofs(df, merkle.Settings(block_levels=levels)).collect()), key=key)
        assert got == expected, levels


def test_proofs_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "a", "", 0, ""), (1, "a", "en", 3, None), (2, "a", "en", 3, "x\ny"),
            (2, "a", "en", 3, "x\ny"), (2, "a", "en", 3, "other"), (3, "b", "en", 1, "é\n" * 200_000), (-7, "c", "de", 1, "\n")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").selectExpr(
        "*", "1 as member", "2 as idx", "'t' as top", "3 as row").repartition(3)
    got = sorted((tuple(r) for r in merkle.proofs(df).collect()), key=key)
    assert got == brute_proofs(rows)
    assert merkle.proofs(df.limit(0)).count() == 0
    one = merkle.proofs(df.filter("doc_id = 1")).first()
    assert one.leaf == one.root == one.subroot and one.proof_sha256 == sha("") and one.verified


def test_appender_extends_witnesses_as_siblings_complete():
    grown = merkle.Appender(3)
    d = [bytes([i]) * 32 for i in range(4)]
    grown.append(d[0])
    grown.append(d[1])
    assert grown.siblings[0] == b""  # partial: the run is open
    grown.append(d[2])
    assert grown.siblings[0] == d[1] + d[2] and grown.siblings[1] == d[0] + d[2]
    grown.append(d[3])
    top = grown.finish(2)
    left = hashlib.sha256("".join(x.hex() for x in d[:3]).encode()).digest()
    right = hashlib.sha256(d[3].hex().encode()).digest()
    assert grown.siblings[3] == left and top == hashlib.sha256((left.hex() + right.hex()).encode()).digest()


def test_whole_tables(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = merkle.proofs(table(spark, SF_SMALL, "documents"))
    assert sorted((tuple(r) for r in got.collect()), key=key) == brute_proofs(rows)
    said = table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text")
    got = trie_rows(trie.conversation_trie(said, trie.Settings(container_turns=10)))
    assert got == sorted(brute_trie([tuple(r) for r in said.collect()])[0], key=key)
