"""Fill-in-the-middle, conversation repair and token files against plain Python
versions, their SQL, exact round trips, and the awkward inputs."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import quire.llm.conversations as conversations
import quire.llm.fim as fim
from quire.llm.editlog import ASSISTANT, ENDING, START, STATES, Edits, applied, chained, ended, run_edits
from quire.llm.queries import ORACLES, QUERIES
from quire.llm.rans import Block, Table, encode
from quire.llm.scratch import Scratch
from quire.llm.token_files import read_digests, read_tokens, write_tokens

SF = "/root/testdata/sf0.001"
MARKS = ("<P>", "<S>", "<M>")


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- fill in the middle ----------------------------------------------------------

def fim_row(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def fim_cases():
    rnd = random.Random(4)
    return [(i, "".join(rnd.choice("aé漢😀 <PSM>\ń") for _ in range(rnd.randint(0, 40)))) for i in range(300)] + [
        (None, "no id"), (7, None), (8, ""), (9, "x<S>y"), (10, "<P"), (11, "same"), (11, "same"), (12, "<"), (13, "é😀a漢" * 40000)]


def test_fim_equals_plain_python(spark):
    rows = fim_cases()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.select("*", F.lit("x").alias("n"), F.lit("y").alias("h1"), F.lit(1).alias("output")).repartition(3)
    made = fim.fill_in_middle(df)
    assert as_rows(made) == sorted((fim_row(*r) for r in rows), key=repr)
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t"))
    assert as_rows(back) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert fim.fill_in_middle(df.limit(0)).collect() == []


def test_fim_in_fragments(monkeypatch):
    """Texts over the fragment size give the same pieces."""
    import pyarrow as pa

    monkeypatch.setattr(fim, "FRAGMENT", 7)
    rows = fim_cases()[:200] + [(500, "é😀a漢" * 30), (501, ""), (502, "x")]
    raw = [(t or "").encode() for _, t in rows]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    draws = [[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for i, _ in rows] for k in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), *[pa.array(d) for d in draws]], names=["doc_id", "h1", "h2", "h3", "h4"])
    got = fim.transform_batch(batch, np.frombuffer(b"".join(raw), np.uint8), offs)
    assert [tuple(r.values()) for r in got.to_pylist()] == [fim_row(*r) for r in rows]


# ---- conversations ---------------------------------------------------------------

FORM = re.compile(r"(s?(ua)+)?")
BODY = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(initials, faults):
    """All repairs that cost no more than deleting everything, by enumeration."""
    n, best = len(initials), None

    def go(i, roles, cost, edits):
        nonlocal best
        if cost > 2 * n:
            return
        if i == n and FORM.fullmatch(roles) and (best is None or (cost, edits) < best):
            best = cost, edits
        if not edits.endswith("II"):
            for r in "ua":
                go(i, roles + r, cost + 5, edits + "I")
        if i < n:
            go(i + 1, roles, cost + 2, edits + "D")
            if faults[i] not in (1, 2):
                more = 5 if faults[i] == 3 else 0
                go(i + 1, roles + (initials[i] or "?"), cost + more, edits + "K")
                for r in "ua":
                    go(i + 1, roles + r, cost + more + 1, edits + "R")
    go(0, "", 0, "")
    return best


def test_repair_is_cheapest_and_least():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(0, 5)
        initials = [rnd.choice(["s", "u", "a", "u", "t", ""]) for _ in range(n)]
        faults = [rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cost, rank, edits = run_edits(initials, faults)
        total, end = ended(cost, rank)
        assert (total, edits[end] + ENDING[end]) == cheapest(initials, faults)


def test_runs_chain_to_the_whole():
    rnd = random.Random(3)
    for _ in range(500):
        n = rnd.randint(1, 30)
        initials = [rnd.choice("suauat ") for _ in range(n)]
        faults = [rnd.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)]
        cost, rank, edits = run_edits(initials, faults)
        total, end = ended(cost, rank)
        cuts = sorted({0, n, *(rnd.randint(0, n) for _ in range(3))})
        solved = [[run_edits(initials[a:b], faults[a:b], s) for s in range(STATES)] for a, b in zip(cuts, cuts[1:])]
        got, states = chained([(sum((x[0] for x in run), []), sum((x[1] for x in run), [])) for run in solved])
        audit = "".join(run[states[i]][2][states[i + 1]] for i, run in enumerate(solved)) + ENDING[states[-1]]
        assert (got, audit) == (total, edits[end] + ENDING[end])
        out = applied(audit, [{"s": "system", "u": "user", "a": "assistant"}.get(x, x) for x in initials], ["x"] * n)
        assert FORM.fullmatch("".join(r[:1] for r, _ in out))
    assert START != ASSISTANT


def test_shared_strings_compare_and_verify():
    rnd = random.Random(5)
    log, nodes = Edits(), [0]
    for _ in range(400):
        nodes.append(log.add(rnd.choice(nodes), rnd.choice("DIKR")))
    for _ in range(2000):
        a, b = rnd.choice(nodes), rnd.choice(nodes)
        x, y = log.text(a), log.text(b)
        assert np.sign(log.compare(a, b)) == (x > y) - (x < y)
    log.hash = [0] * len(log.hash)            # every hash collides: the verification alone decides
    for _ in range(500):
        a, b = rnd.choice(nodes), rnd.choice(nodes)
        x, y = log.text(a), log.text(b)
        assert np.sign(log.compare(a, b)) == (x > y) - (x < y)


def report(conv_rows):
    """Plain Python report of one conversation's rows after damage."""
    rows = sorted(conv_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        marks = BODY.findall(text)
        faults.append(1 if not marks else 2 if (role, text) in seen else 3 if marks[-1] not in ".!?" else 0)
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    cost, rank, edits = run_edits(initials, faults)
    total, end = ended(cost, rank)
    audit = edits[end] + ENDING[end]
    out = applied(audit, [r[1] for r in rows], [r[2] for r in rows])
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    jumps = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, faults.count(1), faults.count(2), faults.count(3), jumps, total, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def conversation_rows(seed=1):
    rnd = random.Random(seed)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rnd.randint(1, 12)):
            rows.append((conv, rnd.choice([turn, turn, turn, None, 3]), rnd.choice(["user", "assistant", "system", "User", "", None, "tool"]),
                         rnd.choice(["Fine.", "Why?", "and then", " \t", "", None, "No!\n", "漢字。", "x" * 3000 + "."])))
    return rows + rows[:5] + [(100, t, "user" if t % 2 == 0 else "assistant", f"turn {t} ." if t % 7 else "same") for t in range(400)]


@pytest.mark.parametrize("run_rows", [4096, 3])
def test_reports_equal_plain_python(spark, monkeypatch, run_rows):
    """Also with runs of three turns, so that most conversations are chained."""
    monkeypatch.setattr(conversations, "RUN_ROWS", run_rows)
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("row", F.lit("x")).withColumn("fault", F.lit(9))
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.reports(df.repartition(5), Scratch(spark, "test")).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {conv: report(r) for conv, r in by_conv.items()}


def test_damage_equals_plain_python(spark):
    rows = conversation_rows(2)
    want = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert as_rows(conversations.damaged(df)) == sorted(want, key=repr)


def test_repaired_turns_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", "Yes.")], "conv_id long, turn long, role string, text string")
    one = conversations.repaired_turns(df, Scratch(spark, "test")).collect()
    assert [(t["role"], t["text"]) for t in one[0]["turns"]] == [("user", "Hi."), ("assistant", "Yes.")] and one[0]["audit"] == "RR"
    assert conversations.reports(df.limit(0), Scratch(spark, "test")).collect() == []


@pytest.mark.parametrize("key", ["op11_fill_in_middle", "op12_conversation_repair"])
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[key])
    columns = [d[0] for d in want.description]
    got = QUERIES[key](spark, SF)
    assert got.columns == columns
    assert as_rows(got) == sorted(want.fetchall(), key=repr)


# ---- token files -----------------------------------------------------------------

def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 2048, 2049, 600_000):
        ids = (rng.zipf(1.3, n) % 40000).astype("<u2")
        table = Table.of_counts(np.bincount(ids, minlength=1))
        block = Block(encode(ids, table), table)
        assert np.array_equal(block.decode(), ids)
    part = block.lanes * block.segment
    assert block.segments == 2 and np.array_equal(block.decode_segment(1), ids[part:2 * part])
    share = np.bincount(ids) / n
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    assert len(block.data) * 8 / n < entropy * 1.1
    wide = np.array([70000, 0, 70000, 3], "<u4")
    table = Table.of_counts(np.bincount(wide))
    assert np.array_equal(Block(encode(wide, table), table).decode(), wide)


def test_frequency_table_sums_to_a_power_of_two():
    for counts in (np.ones(600_000), np.append(np.ones(49_000), [10 ** 12]), np.array([0, 5, 0, 1]), np.array([7])):
        table = Table.of_counts(counts)
        assert table.freq.sum() == 1 << table.bits and ((table.freq > 0) == (counts > 0)).all()


def test_damaged_blocks_are_refused():
    ids = np.arange(3000, dtype="<u2") % 50
    table, other = Table.of_counts(np.bincount(ids)), Table.of_counts(np.bincount(ids) + np.arange(50))
    data = bytearray(encode(ids, table))
    with pytest.raises(ValueError, match="another table"):
        Block(bytes(data), other)
    data[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        Block(bytes(data), table)
    with pytest.raises(ValueError, match="not in the table"):
        encode(np.array([60], "<u2"), Table.of_counts(np.append(np.bincount(ids), np.zeros(20))))


def token_cases():
    rnd = random.Random(5)
    marks = [*"abzAZ09'.,!-_ \t\n éÉÀñ漢😀ßİΣσς’“…́ͅﬁǅ²٣\x00\x1c\x85K", "'s", "'t", "'re ", "'LL", "don't", "<|endoftext|>",
             "<|startoftext|>", "  ", "I'm", "1st"]
    rows = [(rnd.randint(0, 900), "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 60)))) for _ in range(800)]
    return rows + [(None, "no id"), (5000, None), (5001, ""), (5002, "word " * 100_000), (5003, "x" * 3000), (7, "again"), (7, "again")]


def test_token_files_equal_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows = token_cases()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn("start", F.lit("y"))
    scratch = Scratch(spark, "test")
    write_tokens(df.repartition(5), f"{scratch.root}/files", path, scratch)
    want = sorted(((i, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows), key=repr)
    got = read_tokens(spark, f"{scratch.root}/files").orderBy("start").collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == want
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r, d in zip(got, read_digests(spark, f"{scratch.root}/files").orderBy("start").collect()):
        assert tuple(d) == (r["doc_id"], at, len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes()))
        at += len(r["ids"])
    scratch = Scratch(spark, "test")
    write_tokens(df.limit(0), f"{scratch.root}/files", path, scratch)
    assert read_digests(spark, f"{scratch.root}/files").collect() == []
