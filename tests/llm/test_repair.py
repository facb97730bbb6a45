"""Conversation repair against exhaustive search over edits and a plain reading of the rules."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from fixtures import FOLDER, needs_data

from kinfold.llm import repair
from kinfold.llm.registry import QUERIES, table
from kinfold.llm.repair import RepairParams, repaired_conversations

P = RepairParams()
SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")


def cheapest_by_search(rows):
    """(cost, audit, repaired) of rows (role, text, must_go, truncated): every audit with at most two insertions in a gap."""
    best = None
    for gaps in itertools.product(range(3), repeat=len(rows) + 1):
        if best is not None and 5 * sum(gaps) > best[0]:
            continue
        for edits in itertools.product("DKR", repeat=len(rows)):
            cost, audit, kept = 5 * sum(gaps), "I" * gaps[0], ["?"] * gaps[0]
            for (role, text, must_go, truncated), edit, gap in zip(rows, edits, gaps[1:], strict=True):
                if must_go and edit != "D":
                    break
                cost += {"D": 2, "K": 0, "R": 1}[edit] + 5 * (truncated and edit != "D")
                if edit != "D":
                    kept.append((role if edit == "K" else "?", text))
                audit += edit + "I" * gap
                kept += ["?"] * gap
            else:
                head = 1 if kept and kept[0] != "?" and kept[0][0][:1] == "s" else 0
                said = []
                for i, x in enumerate(kept):
                    need = "system" if i < head else ("user", "assistant")[(i - head) % 2]
                    role, text = (x, "") if x == "?" else x
                    said.append((need if role == "?" else role, text))
                if PATTERN.fullmatch("".join(r[:1] or "-" for r, _ in said)) and (best is None or (cost, audit) < best[:2]):
                    best = (cost, audit, said)
    return best


def white_free(text):
    return text.strip(" \t\n\x0b\x0c\r")


def plain(rows, search=True):
    """Expected result by conversation of (conv_id, turn, role, text) rows."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        mine = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        blank = duplicate = truncated = 0
        seen, judged = set(), []
        for _, role, text in mine:
            end = white_free(text)
            must_go, cut = not end, False
            if must_go:
                blank += 1
            elif (role, text) in seen:
                must_go = True
                duplicate += 1
            elif end[-1] not in ".!?":
                cut = True
                truncated += 1
            seen.add((role, text))
            judged.append((role, text, must_go, cut))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        row = (gaps, blank, duplicate, truncated, illegal)
        if search:
            cost, audit, said = cheapest_by_search(judged)
            row += (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
        out[conv] = row
    return out


def result(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def small_rows(seed, n):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", "User", "unknown", None]
    texts = ["a.", "b!", "c", "d? ", " \n", "", None, "Étion dans. çouelle", "x" * 70 + ".", "x" * 70 + "y."]
    for conv in range(n):
        for i in range(rng.randint(1, 5)):
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[i % 2]
            yield conv if conv else None, rng.choice([i, i, i, 2 * i, None]), role, rng.choice(texts)


def test_small_conversations_against_search(spark):
    rows = list(small_rows(1, 120))
    want = plain(rows)
    got = result(repaired_conversations(spark.createDataFrame(rows, SCHEMA), P))
    # Rows of one turn whose first 64 characters agree may stand in either order.
    loose = {c for c in want if sum(r[0] == c and bool(r[3]) and r[3].startswith("x" * 64) for r in rows) > 1}
    assert set(got) == set(want)
    assert {c: v for c, v in got.items() if c not in loose} == {c: v for c, v in want.items() if c not in loose}


@pytest.mark.parametrize("bundle_rows", [1, 3])
def test_bundles_give_the_same(spark, bundle_rows):
    """Conversations over many bundles and tasks, with texts that come back in later ones."""
    rows = list(small_rows(2, 60))
    rows += [(7000, i, ("user", "assistant", "tool")[i * i % 3], f"t{i % 9}{'.' * (i % 2)}") for i in range(300)]
    rows += [(7000, 40, "user", "same.")] * 50
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = result(repaired_conversations(df, P))
    got = result(repaired_conversations(df, RepairParams(bundle_rows=bundle_rows)))
    assert got == want
    assert got[7000][:5] == plain([r for r in rows if r[0] == 7000], search=False)[7000]


def test_a_long_conversation_by_rows(spark):
    """Rules and ropes against the product of one matrix per row."""
    rng = random.Random(4)
    sequence = "".join(rng.choice(["ua", "ua", "uA", "xx", "so", "U", "a"]) for _ in range(3000))
    texts = [sequence[i : i + 40] for i in range(0, len(sequence), 40)]
    rules = repair.learned(spark.createDataFrame([(t,) for t in texts], "sequence string"), P)
    assert len(rules) > 20 and len(repair.compressed(sequence, rules)) < len(sequence) / 3
    vector = repair.opening(repair.START, P)
    plainly = [None if e is None else e for e in vector]
    for symbol in sequence:
        plainly = repair.times(plainly, repair.row_matrix(symbol, P))
    got = repair.cheapest(repair.carried(vector, sequence, rules, P))
    assert got == repair.cheapest(plainly) and isinstance(plainly[repair.ASSISTANT][1], repair.Rope)


def test_rope_order():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ("".join(rng.choice("DK") for _ in range(rng.randint(0, 5))) for _ in range(2))
        long = "KRD" * 300
        x, y = repair.Rope(repair.Rope(long, a), long), repair.Rope(long, repair.Rope(b, long))
        assert repair.less(x, y) == (repair.text_of(x) < repair.text_of(y))
        assert repair.less(x, repair.text_of(y)) == (repair.text_of(x) < repair.text_of(y))


def test_pair_counts_do_not_overlap():
    assert repair.pair_counts("aaaab\naa") == {"aa": 3, "ab": 1}


def test_awkward_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repaired_conversations(none, P).collect() == []
    dropped = next((c, t) for c in range(100) for t in range(5) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    rows = [(*dropped, "user", "x."), (None, None, None, None), (5001, None, "user", "  "), (5002, 3, "user", "long " * 200_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", key string, copies int")
    got = result(repaired_conversations(df, P))
    assert got == plain(rows)
    assert got[dropped[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@needs_data
def test_the_query_on_given_tables(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = result(QUERIES["op12_conversation_repair"](spark, FOLDER))
    want = plain(rows, search=False)
    assert {c: v[:5] for c, v in got.items()} == want
    short = [r for r in rows if sum(x[0] == r[0] for x in rows) <= 4]
    for c, v in plain(short).items():
        assert got[c] == v
