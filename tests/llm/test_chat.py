"""Chat formatting, fill-in-the-middle and conversation repair against brute force, round trips and odd tables."""

import hashlib
import itertools
import json
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regionpanel.llm import chat_format, infill, turn_repair
from regionpanel.llm.digests import ordered_digests
from regionpanel.llm.queries import QUERIES, chat_records

from .odd import SCHEMA, empty_docs, odd_docs, prose, rows

SF_DIR = "/root/testdata/sf0.001"
CHAT = "conv_id long, turn long, role string, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# conversation repair


def cheapest(letters: str) -> tuple[int, str]:
    """Least cost and least audit by a search over the states of the grammar: start, after s, u, a."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    states = ("", "s", "u", "a")
    far = (10**9, "")

    def closed(table):
        # Inserts change the state only; more than two in a row lead back to where one has been, at a cost.
        for _ in range(4):
            for state in states:
                for x in "ua":
                    if (state, x) in after:
                        cost, audit = table[after[state, x]]
                        if cost < 10**9:
                            table[state] = min(table[state], (cost + 3, "I" + audit))
        return table

    table = closed({x: (0, "") if x in ("", "a") else far for x in states})
    for letter in reversed(letters):
        new = {}
        for state in states:
            ways = [(4 + table[state][0], "D" + table[state][1])]
            if letter != "x":
                extra = 3 * letter.isupper()
                if (state, letter.lower()) in after:
                    cost, audit = table[after[state, letter.lower()]]
                    ways.append((extra + cost, "K" + audit))
                for x in "ua":
                    if (state, x) in after:
                        cost, audit = table[after[state, x]]
                        ways.append((3 + extra + cost, "R" + audit))
            new[state] = min(w for w in [*ways, far] if w[0] < 10**9 or w == far)
        table = closed(new)
    return table[""]


def test_alignment_of_all_short_conversations():
    for n in range(5):
        for letters in itertools.product("suaoSUAx", repeat=n):
            code = "".join(letters)
            assert turn_repair.Alignment(code).best() == cheapest(code), code


def test_alignment_of_random_conversations():
    rng = random.Random(3)
    for _ in range(300):
        kind = rng.choice(["suaoSUAOx", "uuuA", "ua", "sssu", "uaUAx", "oooo"])
        code = "".join(rng.choice(kind) for _ in range(rng.randint(5, 70)))
        found = turn_repair.Alignment(code)
        found.every = rng.choice([1, 3, 16])
        assert found.best() == cheapest(code), code


def test_alignment_of_long_conversations_is_banded():
    rng = random.Random(5)
    code = list("s" + "ua" * 3000)
    for _ in range(60):
        code[rng.randrange(1, len(code))] = rng.choice("uaxoUA")
    code = "".join(code)
    found = turn_repair.Alignment(code)
    low, high = found.band(len(code) // 2)
    assert high - low < 400
    assert found.best() == cheapest(code)


def odd_chat() -> list[tuple]:
    made = [
        (1, 0, "user", "Hi there."), (1, 1, "assistant", "Hello!"), (1, 2, "user", "Bye."),
        (2, None, "user", "No number."), (2, None, "user", "No number."), (2, 5, None, "Nobody?"), (2, 7, "assistant", None),
        (3, 0, "system", "Be short."), (3, 0, "assistant", "Same number."), (3, 3, "tool", "x"), (3, 4, "", " \t"), (3, 9, "user", ""),
        (None, 1, "user", "Nobody's."), (None, 2, "assistant", "Yes"), (None, None, None, None),
        (4, 0, "system", "Only this."), (5, 3, "us\ner", "Role\nwith <says> break </turn>"), (5, 4, "assistant", "\\### <turn> \\<says> <\\/turn> ok"),
        (6, -(2**63), "user", "First."), (6, 2**63 - 1, "assistant", "Last."), (7, 1, "User", "A.\n"), (7, 2, "assistant", "é" * 120_000 + "."),
        (2**60 + 1, 0, "user", "Big id."), (2**60 + 1, 1, "assistant", "Fine."),
    ]
    made += [made[0], made[1], made[1]]
    rng = random.Random(8)
    made += [(8, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["So.", "So", prose(i, 5) + ".", " "])) for i in range(700)]
    return made


def chat_table(spark):
    df = spark.createDataFrame(odd_chat(), CHAT)
    for name in ("position", "fault", "letter", "at", "part", "record", "turns", "piece", "_seen", "_copy", "cost", "audit", "layout"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df.repartition(3)


def brute_repair(table: list[tuple]) -> dict:
    """The repair query's rows without damage, from rows as they stand after it."""
    groups: dict = {}
    for conv, turn, role, text in table:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role, text))
    out = {}
    for conv, got in groups.items():
        got.sort()
        seen, letters, counts = set(), "", Counter()
        for _, _, role, text in got:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            letter = role[:1] if role[:1] and role[:1] in "sua" else "o"
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        steps = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(got)]
        cost, audit = cheapest(letters)
        numbers = [t for known, t, _, _ in got if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        length, lines, i = len(audit) - audit.count("D"), [], 0
        for edit in audit:
            if edit != "D":
                new = "assistant" if (length - len(lines)) % 2 else "user"
                lines.append(f"{new if edit in 'IR' else got[i][2]}:{'' if edit == 'I' else got[i][3]}")
            i += edit != "I"
        out[conv] = (gaps if gaps < 2**63 else None, counts["blank"], counts["duplicate"], counts["truncated"], sum(s not in ("su", "ua", "au") for s in steps), cost, audit, sha("\n".join(lines)))
    return out


def damaged(table: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run_repair(spark, name, df, tmp_path):
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r[c] for c in FIGURES) for r in got}


def test_repair_query_against_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in FIGURES) for r in QUERIES["op13_turn_repair"](spark, SF_DIR).collect()}
    want = brute_repair(damaged(table))
    assert got == {c: want.get(c, (0, 0, 0, 0, 0, 0, "", sha(""))) for c in {r[0] for r in table}}


def test_repair_of_an_odd_table(spark, tmp_path):
    got = run_repair(spark, "op13_turn_repair", chat_table(spark), tmp_path)
    want = brute_repair(damaged(odd_chat()))
    assert got == {c: want.get(c, (0, 0, 0, 0, 0, 0, "", sha(""))) for c in {r[0] for r in odd_chat()}}


def test_repair_of_nothing(spark, tmp_path):
    assert run_repair(spark, "op13_turn_repair", spark.createDataFrame([], CHAT), tmp_path) == {}


def test_repaired_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Still there?"), (1, 1, "user", "Still there?"), (1, 2, "narrator", "Yes.")], CHAT)
    found = turn_repair.faults(df)
    audits = turn_repair.audits(found)
    assert audits.first().audit == "KIKDR"
    got = [(r.role, r.text) for r in turn_repair.repaired(found, audits).orderBy("at").collect()]
    assert got == [("user", "Hi."), ("assistant", ""), ("user", "Still there?"), ("assistant", "Yes.")]


# digests


def test_digests_run_over_batches(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"), F.concat(F.col("id").cast("string"), F.lit("é")).alias("t"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.k: r for r in ordered_digests(df, "k", ["at"], {"t": F.col("t"), "none": F.lit(None).cast("string")}).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for k in range(3):
        text = "".join(f"{i}é" for i in range(5000) if i % 3 == k)
        assert (got[k].n_rows, got[k].t_sha256, got[k].t_chars, got[k].none_sha256) == (len(range(k, 5000, 3)), sha(text), len(text), sha(""))


# chat formatting


def turns_of(spark, records):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "id long, record string")
    got = {r.id: r for r in chat_format.canonical(df).collect()}
    return [(got[i].layout, None if got[i].turns is None else [tuple(t) for t in got[i].turns], got[i].fingerprint) for i in range(len(records))]


def test_layouts_become_turns(spark):
    talk = [("user", "Q"), ("assistant", "A")]
    records = [
        {"prompt": "Q", "completion": "A"},
        {"question": "Q", "answer": "A", "id": 7, "meta": {"from": ["web"]}},
        {"instruction": "Q", "input": "", "output": "A"},
        {"instruction": "Do", "context": "with this", "response": "A"},
        {"messages": [{"role": "user", "content": "Q"}, {"content": "A", "role": "assistant"}]},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "Q"}]}, {"role": "assistant", "content": "A"}]},
        {"system": "S", "conversations": [{"from": "human", "value": "Q"}, {"from": "gpt", "value": "A"}]},
        {"system": "", "prompt": "Q", "response": "A"},
        {"prompt": 5, "completion": None},
        {"messages": []},
        {"messages": [], "prompt": "Q", "completion": "A"},
    ]
    got = turns_of(spark, [json.dumps(r) for r in records])
    want = [talk, talk, talk, [("user", "Do\n\nwith this"), ("assistant", "A")], talk, talk, [("system", "S"), *talk], talk, [("user", "5"), ("assistant", "")], [], talk]
    assert [t for _, t, _ in got] == want
    # Fields in another order have the same paths, further fields do not.
    same = turns_of(spark, [json.dumps({"completion": "x", "prompt": "y"}), json.dumps({"completion": "x", "prompt": "y", "z": 1})])
    assert same[0][2] == got[0][2] != same[1][2] and same[1][0] == "prompt_completion"


def test_records_that_are_none(spark):
    deep = "[" * 100_000
    got = turns_of(spark, [None, "", "no json", "[1]", "3", '{"other": 1}', "{}", deep, '{"prompt": "half"}', '{"messages": [{"role": "user"}]}'])
    assert [(layout, turns) for layout, turns, _ in got] == [(None, None)] * len(got)
    assert [mark is None for *_, mark in got] == [True] * 5 + [False, False, True, False, False]


def test_no_control_string_is_left_in_a_text(spark):
    rng = random.Random(2)
    parts = ["<turn>", "<says>", "</turn>", "<", "\\", "\\\\", "/turn>", "\n", "x", "é", "<turn"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame([(i, texts[-1 - i], t) for i, t in enumerate(texts)], "i int, role string, text string")
    for r in chat_format.read_back(chat_format.render(df, learn=texts[:200])).collect():
        assert (r.role, r.text) == (texts[-1 - r.i], texts[r.i])
        assert sum(r.piece.count(c) for c in chat_format.TEMPLATE.controls) == 3
        assert r.learnt == (texts[r.i] if r.role in texts[:200] else None)


def brute_format(table: list[tuple]) -> dict:
    groups: dict = {}
    for conv, turn, role, text in table:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, got in groups.items():
        got.sort()
        told, learnt = "".join(f"{r}\n{t}\n" for *_, r, t in got), "".join(t for *_, r, t in got if r == "assistant")
        out[conv] = (len(got), sha(told), len(learnt), sha(learnt))
    return out


def test_format_of_an_odd_table(spark, tmp_path):
    chat_table(spark).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op11_chat_format"](spark, str(tmp_path)).collect()}
    odd = "\\### Assistant: </turn> ok"
    want = brute_format([*odd_chat(), (-7, 0, "user", odd), (-7, 1, "assistant", odd)])
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == want
    layouts = {r.layout for r in chat_format.canonical(chat_records(chat_table(spark))).select("layout").distinct().collect()}
    assert layouts == {"messages", "from_value", "instruction", "prompt_completion"}


def test_format_of_nothing(spark, tmp_path):
    spark.createDataFrame([], CHAT).write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in QUERIES["op11_chat_format"](spark, str(tmp_path)).collect()] == [-7]


def test_whole_conversations(spark):
    df = spark.createDataFrame([(1, 0, "user", "Q<turn>"), (1, 1, "assistant", "A</turn>"), (1, 2, "user", "é"), (1, 3, "assistant", "B"), (2, 0, "user", "x")], CHAT)
    got = {r.conv_id: r for r in chat_format.conversations(chat_format.render(df.select("conv_id", "turn", "role", "text")), "conv_id", ["turn"]).collect()}
    one = got[1].formatted
    assert one == "<turn>user<says>Q<\\turn></turn>\n<turn>assistant<says>A<\\/turn></turn>\n<turn>user<says>é</turn>\n<turn>assistant<says>B</turn>\n"
    assert [one[s["from"] : s["from"] + s["length"]] for s in got[1].loss] == ["A<\\/turn>", "B"] and got[2].loss == []


# fill in the middle

WORDS = rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"


def test_fenwick_finds_blocks():
    rng = random.Random(1)
    for _ in range(100):
        counts = [rng.choice([0, 0, 1, 5]) for _ in range(rng.randint(1, 40))]
        tree = infill.Fenwick(infill.np.array([[c, 2 * c] for c in counts]))
        assert tree.total().tolist() == [sum(counts), 2 * sum(counts)]
        owner = [b for b, c in enumerate(counts) for _ in range(c)]
        for k, b in enumerate(owner, start=1):
            at, before = tree.find(k)
            assert at == b and before.tolist() == [sum(counts[:b]), 2 * sum(counts[:b])]


@pytest.mark.parametrize("block", [1, 3, 8, 4096])
@pytest.mark.parametrize("unit", [infill.CODE_POINT, WORDS])
def test_cuts_against_brute_force(block, unit):
    rng = random.Random(7)
    for _ in range(60):
        text = "".join(rng.choice("aé \n😀x  ") for _ in range(rng.randint(0, 60)))
        ends = [0, *(m.end() for m in re.finditer(unit, text.encode()))]
        blocks = infill.Blocks(text.encode(), unit, block)
        assert blocks.n == len(ends) - 1
        for k, end in enumerate(ends):
            assert blocks.end_of(k) == (end, len(text.encode()[:end].decode()))


def brute_infill(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, sha(text), sha(text)
    p, m, s = text[:a], text[a:b], text[b:]
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return n, form, a, b - a, sha(out), sha(text)


def test_infill_of_odd_tables(spark, tmp_path):
    more = [(100 + i, t, None, None, None) for i, t in enumerate(["a<P>b", "<S>", "x<M", "é😀" * 200_000, "<P", "a\n" * 300_000])]
    made = [*rows(), *more]
    df = odd_docs(spark).unionByName(spark.createDataFrame(more, SCHEMA), allowMissingColumns=True)
    for name in ("form", "output", "raw", "cut", "doc"):
        df = df.withColumn(name, F.lit("clash"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, str(tmp_path)).collect())
    assert got == Counter((r[0], *brute_infill(r[0], r[1])) for r in made)
    out = infill.fill_in_middle(df)
    assert set(out.columns) >= {"lang", "source", "size", "output"} and out.count() == len(made)


def test_infill_of_nothing_and_of_words(spark):
    assert infill.fill_in_middle(empty_docs(spark)).count() == 0
    df = spark.createDataFrame([(i, prose(i, 40)) for i in range(60)], "doc_id long, text string")
    out = infill.fill_in_middle(df, unit=WORDS, block=16)
    got = out.withColumn("again", infill.restore(F.col("output"), F.col("form"))).collect()
    assert all(r.again == r.text and r.n == 40 for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        if r.form != "plain":
            assert r.prefix_chars in {0, *(m.end() for m in re.finditer(r"\S+\s*", r.text))}
