import collections
import hashlib
import random
import re
import time

from vaultline.llm import chat, private

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    odd = sum(int(c) for c in d[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])) % 10 == 0


def brute_base(s):
    s = s or ""
    out = [("email", m) for m in EMAIL.finditer(s)]
    out += [("ip", m) for m in IP.finditer(s) if all(int(p) < 256 for p in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(s) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m) for m in PHONE.finditer(s) if 8 <= len(digits(m[0])) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in out]


def test_base_entities_match_plain_scans(spark, few_docs, odd_docs, no_docs):
    rng = random.Random(5)
    bits = ["@", "a", ".", "-", "+", "1", "23", "256", " ", "b@c.de", "4111 1111 1111 1111", "(", "!", "\n", "é",
            "+1 (502) 555-0303", "10.0.0.1"]
    made = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(600)]
    for docs in (spark.createDataFrame(made, "doc_id long, text string"), few_docs, odd_docs):
        texts = collections.defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            texts[r.doc_id].append(brute_base(r.text))
        got = private.find(docs).collect()
        assert len(got) == docs.count()
        for r in got:
            match = [b for b in texts[r.doc_id] if hashlib.sha256(",".join(b).encode()).hexdigest() == r.base_sha256]
            assert match
            kinds = collections.Counter(x.split(":")[0] for x in match[0])
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in private.KINDS)
            assert set(match[0]) <= set(filter(None, r.spans.split(",")))
    assert private.find(no_docs).count() == 0


def test_long_texts_are_scanned_in_linear_time():
    s = private.Settings()
    for unit in ("7", "1.", "1.1.1 ", "+1 (", "a@", "a.", "@b-", "4111 ", "+", "1@2.3 ", " "):
        text = unit * (1_000_000 // len(unit))
        began = time.process_time()
        base = private.entities(text)
        private.mentions(text, base, s)
        assert time.process_time() - began < 12, unit


def test_contexts_of_seeds_find_identifiers_of_another_form(spark):
    data = [(i, f"some text. Please charge card number: {c} today") for i, c in enumerate(
        ["4111111111111111", "4012888888881881", "5555555555554444", "5105105105105100"])]
    data += [(10, "we will charge card number 1234567812345678 today"), (11, "the version number 20240101 is out")]
    got = {r.doc_id: r for r in private.find(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    start = data[4][1].index("1234")
    assert got[10].n_learned == 1 and got[10].spans == f"card:{start}:{start + 16}" and got[10].n_card == 0
    assert got[11].n_learned == 0 and got[11].spans == ""


def test_a_chain_of_contexts_is_followed_to_its_end(spark):
    cards = ["4111111111111111", "4012888888881881", "5555555555554444", "5105105105105100"]
    names = [f"ref{1001 + i}" for i in range(7)]  # each is known only once the one before is
    data = []
    for i, name in enumerate(names):
        before = cards if i == 0 else [*cards[:3], names[i - 1]]
        data += [f"their {'abcdefg'[i] * 3} {x} {'abcdefg'[i] * 4} here" for x in [*before, name]]
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    learned = {r.instance: r.kind for r in private.bootstrap(private.read(docs)).collect()}
    assert learned == {name: private.KINDS.index("card") for name in names}


def told(rows, conv):
    turns = sorted(((r.turn is not None, r.turn or 0), r.role is not None, r.role or "", r.text is not None,
                    r.text or "") for r in rows if r.conv_id == conv)
    turns = [(t[2], t[4]) for t in turns]
    return (len(turns), "".join(f"{a}\n{b}\n" for a, b in turns), "".join(b for a, b in turns if a == "assistant"))


def test_windows_read_back_as_the_conversation(spark):
    from ..conftest import SF_SMALL
    given = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    odd = [(-7, 0, "user", said), (-7, 1, "assistant", said), (-8, None, None, None),
           (-8, 2, "sys|>tem<|", "a\\s\\l<|x|>\\\\"), (None, 0, "assistant", "x\ny"), (-9, 0, "system", "S"),
           (-9, 0, "system", "S"), (-9, 1, "assistant", "é" * 9 + " w" * 900), (-9, 2, "assistant", "b")]
    odd += [(-10, i, "assistant" if i % 2 else "user", f"turn {i} " + "w " * (i % 13)) for i in range(200)]
    docs = given.union(spark.createDataFrame(odd, given.schema.simpleString()[7:-1].replace(":", " ")))
    rows = docs.collect()
    for s in (chat.Settings(), chat.Settings(budget=120, system_share=10, history_tokens=30)):
        got = chat.digests(docs, s).collect()
        assert len(got) == len({r.conv_id for r in rows})
        for r in got:
            n, turns, loss = told(rows, r.conv_id)
            assert (r.n_turns, r.turns_sha256) == (n, hashlib.sha256(turns.encode()).hexdigest())
            assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_windows_keep_the_budget_the_system_turn_and_limited_history(spark):
    s = chat.Settings(budget=100, system_share=10, history_tokens=30, history_turns=2)
    data = [(1, 0, "system", "be kind")] + [(1, i, "assistant" if i % 2 == 0 else "user", "w " * (i % 9 + 1) + str(i))
                                            for i in range(1, 80)]
    docs = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = chat.windows(docs, s).orderBy("window").collect()
    assert len(got) > 5
    targets = []
    for w in got:
        turns = w.formatted[len(chat.BEGIN):].split(chat.END)[:-1]
        assert turns[0] == "<|system|>be kind"
        assert sum(len(t.split("|>", 1)[1].split()) + s.turn_tokens for t in turns) <= s.budget
        assert w.n_repeated <= 1 + s.history_turns
        targets += [w.formatted[x.start:x.end] for x in w.loss]
    assert targets == [t for _, _, r, t in data if r == "assistant"]
    assert any(w.n_repeated == 3 for w in got)


def test_long_turns_keep_the_budget(spark):
    s = chat.Settings(budget=100, system_share=20, history_tokens=30, history_turns=2)
    rng = random.Random(2)
    data = []
    for c in range(60):
        sizes = [rng.choice([1, 5, 16, 17, 40, 300])] + [rng.choice([1, 3, 9, 46, 47, 60, 76, 90, 97, 150]) for _ in range(rng.randrange(9))]
        data += [(c, i, "system" if i == 0 and c % 3 else ["user", "assistant"][i % 2], f"t{i} " + "w " * (n - 1)) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    full = []
    for w in chat.windows(docs, s).collect():
        turns = w.formatted[len(chat.BEGIN):].split(chat.END)[:-1]
        tokens = [len(t.split("|>", 1)[1].split()) + s.turn_tokens for t in turns]
        assert sum(tokens) <= s.budget or len(turns) == 1, w
        full.append(sum(tokens) > s.budget)
    assert any(full)
    rows = docs.collect()
    for r in chat.digests(docs, s).collect():
        n, turns, loss = told(rows, r.conv_id)
        assert (r.n_turns, r.turns_sha256) == (n, hashlib.sha256(turns.encode()).hexdigest())
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_windows_equal_their_sql_on_odd_turns(spark):
    import duckdb
    import pandas as pd
    from vaultline.llm.oracle import chat_windows
    rng = random.Random(6)
    data = []
    for c in range(150):
        for i in range(rng.randrange(1, 9)):
            role = "system" if i == 0 and c % 3 else rng.choice(["user", "assistant", "system"])
            data.append((c, i, role, "w " * rng.choice([1, 20, 120, 125, 300, 635, 640, 700, 900, 1020, 1100])))
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"]))
    expected = {r[0]: r[1:] for r in con.execute(chat_windows()).fetchall()}
    docs = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(docs).collect()}
    assert len(got) == 150 and all(got[c] == expected[c] for c in got)


def test_chat_empty_table_and_native_plan(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string, window int, n int")
    assert chat.digests(none).count() == 0
    plan = chat.digests(none)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
