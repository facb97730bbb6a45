"""Conversation structure repair: the cheapest edits that make a conversation's roles ``(s?(ua)+)?``.

Every row becomes one symbol: its role and whether it is truncated, or "must go" for blank and duplicate rows. Rows are
kept, given another role, deleted, and empty turns are inserted; the state between two rows is the place in the role
pattern, so a row is a 4 x 4 matrix over (cost, audit), multiplied by adding costs, joining audits and keeping
the least. Re-Pair compresses the symbol sequences: pairs that occur most often get rules, counted by Spark over the distinct
sequences of all conversations, several pairs without a common symbol per round. Each rule has one matrix, made bottom-up from
its two sides, whose audits are ropes; conversations share the rules and multiply what is left of them.

Rows are dealt by ranges of (conversation, turn, role, text), so one conversation may cover many
tasks. A task packs its rows into bundles of bounded size. A conversation inside one bundle is finished there.
Of the others only bundles meet: which texts an earlier bundle holds already, the matrices in
order, then the repaired bytes in order, each as a stream that holds one bundle at a time. (SHA-256 is sequential by
definition, so the bytes of one conversation must pass one task.)

Defined cases: null roles and texts are one space, null ids and turns one space in the damage key; a null conversation is a
conversation of its own; null turns come first; rows of one turn stand by role, then by their first 64 characters, then by a hash of the text.
A role whose first character is none of s, u, a (also an empty one) cannot be kept. Repeated rows are duplicates. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.registry import query, table
from kinfold.llm.store import written
from kinfold.llm.text import within

BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
_FIRST_RULE = 0xE000  # rules are characters of the private area, so sequences stay strings


@dataclass(frozen=True)
class RepairParams:
    delete: int = 2
    rerole: int = 1
    insert: int = 5
    truncated: int = 5
    bundle_rows: int = 4096
    bundle_bytes: int = 1 << 22
    max_rules: int = 512  # more rules save work, they never change a result
    max_rounds: int = 12


# Audits: plain strings while they are short, ropes beyond.

_SHORT = 512
_PRIME = (1 << 61) - 1


class Rope:
    """Two audits joined. Length and hash let a comparison skip equal parts without reading them."""

    __slots__ = ("left", "right", "size", "hash")

    def __init__(self, left, right):
        self.left, self.right = left, right
        self.size = len_of(left) + len_of(right)
        self.hash = (hash_of(left) * pow(256, len_of(right), _PRIME) + hash_of(right)) % _PRIME


def len_of(audit) -> int:
    return len(audit) if isinstance(audit, str) else audit.size


def hash_of(audit) -> int:
    return int.from_bytes(audit.encode(), "big") % _PRIME if isinstance(audit, str) else audit.hash


def joined(left, right):
    if isinstance(left, str) and isinstance(right, str) and len(left) + len(right) <= _SHORT:
        return left + right
    return Rope(left, right)


def text_of(audit) -> str:
    out, stack = [], [audit]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack += [x.right, x.left]
    return "".join(out)


def less(a, b) -> bool:
    """Whether audit a stands before b in ASCII order."""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y or (len_of(x) == len_of(y) and hash_of(x) == hash_of(y)):
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x < y
            if x[n:]:
                left.append(x[n:])
            if y[n:]:
                right.append(y[n:])
        elif isinstance(y, str) or (not isinstance(x, str) and x.size >= y.size):
            left += [x.right, x.left]
            right.append(y)
        else:
            right += [y.right, y.left]
            left.append(x)
    return not left and bool(right)


# Matrices: entry (p, q) is (cost, audit) or None, at 4 p + q.


def better(entry, best) -> bool:
    return best is None or entry[0] < best[0] or (entry[0] == best[0] and less(entry[1], best[1]))


def times(vector: list, matrix: list) -> list:
    """A row of entries by state times a matrix. Of two equally cheap audits between the same states none begins the other, as what
    is longer holds paid insertions, so the least audit of a whole is made of least audits of its parts."""
    out = [None] * 4
    for k in STATES:
        if vector[k] is not None:
            for q in STATES:
                step = matrix[4 * k + q]
                if step is not None:
                    cost = vector[k][0] + step[0]
                    if out[q] is None or cost <= out[q][0]:
                        entry = (cost, joined(vector[k][1], step[1]))
                        if better(entry, out[q]):
                            out[q] = entry
    return out


def product(a: list, b: list) -> list:
    return [entry for p in STATES for entry in times(a[4 * p : 4 * p + 4], b)]


def insertions(p: RepairParams) -> list:
    """Up to two empty turns between two rows; more never pay."""
    out = [None] * 16
    for start in STATES:
        state, cost, audit = start, 0, ""
        for _ in range(3):
            if better((cost, audit), out[4 * start + state]):
                out[4 * start + state] = (cost, audit)
            state, cost, audit = (ASSISTANT if state == USER else USER), cost + p.insert, audit + "I"
    return out


def row_matrix(symbol: str, p: RepairParams) -> list:
    """x: must be deleted; s, u, a: such a role, o: another one; upper case: truncated."""
    out = [(p.delete, "D") if q == r else None for q in STATES for r in STATES]
    if symbol != "x":
        extra = p.truncated if symbol.isupper() else 0
        edits = [(symbol.lower(), extra, "K"), ("u", extra + p.rerole, "R"), ("a", extra + p.rerole, "R")]
        for role, cost, letter in edits:
            for state, after in NEXT.get(role, {}).items():
                if better((cost, letter), out[4 * state + after]):
                    out[4 * state + after] = (cost, letter)
    return product(out, insertions(p))


@lru_cache(maxsize=4)
def matrices(rules: tuple[str, ...], p: RepairParams) -> dict[str, list]:
    """Matrix of every symbol: terminals, then rules bottom-up from their two sides."""
    out = {s: row_matrix(s, p) for s in "xsuaoSUAO"}
    for i, pair in enumerate(rules):
        out[chr(_FIRST_RULE + i)] = product(out[pair[0]], out[pair[1]])
    return out


def compressed(sequence: str, rules: tuple[str, ...]) -> str:
    for i, pair in enumerate(rules):
        sequence = sequence.replace(pair, chr(_FIRST_RULE + i))
    return sequence


def carried(vector: list, sequence: str, rules: tuple[str, ...], p: RepairParams) -> list:
    by = matrices(rules, p)
    for symbol in compressed(sequence, rules):
        vector = times(vector, by[symbol])
    return vector


def opening(state: int, p: RepairParams, leads: bool = True) -> list:
    """Entries by state in front of a bundle; before the first row of a conversation turns may be inserted."""
    return insertions(p)[4 * state : 4 * state + 4] if leads else [(0, "") if s == state else None for s in STATES]


def cheapest(vector: list) -> tuple[int, str, int]:
    """Cost, audit and last state of the best legal end: nothing at all (all rows deleted), or an assistant's turn."""
    state = ASSISTANT if vector[ASSISTANT] is not None and better(vector[ASSISTANT], vector[START]) else START
    return vector[state][0], text_of(vector[state][1]), state


# Rows and bundles.


def damaged(conversations: DataFrame) -> DataFrame:
    """key, conv_id, turn, role, text, copies; a dropped row stays as a mark of its conversation, with no copies."""
    said = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    kind = F.crc32(said.cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), kind.alias("kind"),
    )
    is_ = F.col("kind")
    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "conv_id", "turn",
        F.when(is_ == 0, "").when(is_ == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(is_ <= 1, "").when(is_ == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(is_ == 0, 0).when(is_ == 3, 2).otherwise(1).alias("copies"),
    )


def kind_of(text: str) -> str:
    """b: blank, t: truncated, f: neither."""
    end = text.rstrip(BLANKS)
    return "b" if not end else "f" if end[-1] in ".!?" else "t"


def print_of(role: str, text: str) -> bytes:
    r = role.encode()
    return hashlib.blake2b(len(r).to_bytes(4, "big") + r + text.encode(), digest_size=16).digest()


class Bundle:
    """Consecutive rows of one conversation; equal neighbours are one entry with its number of copies."""

    def __init__(self, key, conv_id):
        self.key, self.conv_id = key, conv_id
        self.turns, self.roles, self.texts, self.copies, self.size = [], [], [], [], 0

    def add(self, turn, role, text, copies) -> None:
        if self.texts and self.texts[-1] == text and self.roles[-1] == role and self.turns[-1] == turn:
            self.copies[-1] += copies
            return
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.size += len(text)


BUNDLE = (
    "key string, conv_id long, part int, k int, whole boolean, turns array<long>, roles array<string>, texts array<string>, "
    "copies array<int>, kinds string, prints binary, sequence string"
)


def columns_of(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def table_of(rows: list[dict], schema: str) -> pa.Table:
    kinds = {
        "string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
        "array<binary>": pa.list_(pa.binary()),
    }
    return pa.table({n: pa.array([r[n] for r in rows], kinds[k]) for n, k in (x.split() for x in schema.split(", "))})


def facts(b: dict, seen: set[bytes]) -> dict:
    """Symbols and counts of a bundle's rows; ``seen`` are the prints of texts that earlier bundles hold."""
    symbols, out = [], {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    known, before, first = set(seen), None, None
    for i, (role, kind, copies) in enumerate(zip(b["roles"], b["kinds"], b["copies"], strict=True)):
        initial = role[:1]
        mark = b["prints"][16 * i : 16 * i + 16]
        if before is not None:
            out["illegal"] += before + initial not in LEGAL
        out["illegal"] += (copies - 1) * (initial + initial not in LEGAL)
        first, before = (initial if first is None else first), initial
        again = copies
        if kind == "b":
            out["blank"] += copies
        elif mark in known:
            out["duplicate"] += copies
        else:
            known.add(mark)
            again -= 1
            out["duplicate"] += again
            symbol = initial if initial in ("s", "u", "a") else "o"
            out["truncated"] += kind == "t"
            symbols.append(symbol.upper() if kind == "t" else symbol)
        symbols.append("x" * again)
    turns = [t for t in b["turns"] if t is not None]
    return out | {
        "sequence": "".join(symbols), "first_role": first, "last_role": before, "low": min(turns, default=None),
        "high": max(turns, default=None), "turns_seen": len(set(turns)),
    }


def bundled(rows: DataFrame, p: RepairParams) -> DataFrame:
    """Bundles of the rows, in the order of (part, k) within a conversation; ``whole`` ones hold all of it."""
    # The last key lets copies of one row fill many tasks.
    ties = [F.substring("text", 1, 64).alias("o0"), F.xxhash64("text").alias("o1"), (F.monotonically_increasing_id() % 64).alias("o2")]
    order = ["key", F.col("turn").asc_nulls_first(), "role", "o0", "o1", "o2"]
    dealt = rows.select("*", *ties).repartitionByRange(*order).sortWithinPartitions(*order).drop("o0", "o1", "o2")

    def run(batches):
        part, k, now, done, first_key, began = TaskContext.get().partitionId(), 0, None, [], None, False

        def closed(b: Bundle, whole: bool) -> dict:
            nonlocal k
            row = {
                "key": b.key, "conv_id": b.conv_id, "part": part, "k": k, "whole": whole, "turns": b.turns, "roles": b.roles, "texts": b.texts,
                "copies": b.copies, "kinds": "".join(map(kind_of, b.texts)), "prints": b"".join(map(print_of, b.roles, b.texts)),
            }
            k += 1
            return row | {"sequence": facts(row, set())["sequence"]}

        size = 0
        for batch in batches:
            for key, conv_id, turn, role, text, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now.key != key:
                    if now is None:
                        first_key = key
                    else:
                        done.append(closed(now, now.key != first_key and not began))
                    now, began = Bundle(key, conv_id), False
                elif len(now.texts) >= p.bundle_rows or now.size >= p.bundle_bytes:
                    done.append(closed(now, False))
                    now, began = Bundle(key, conv_id), True
                if copies:
                    now.add(turn, role, text, copies)
                    size += len(text)
                if len(done) >= 1000 or size >= p.bundle_bytes:
                    if done:
                        yield table_of(done, BUNDLE)
                    done, size = [], 0
        if now is not None:
            done.append(closed(now, False))
        if done:
            yield table_of(done, BUNDLE)

    return within(dealt, run, BUNDLE)


# The grammar.


def pair_counts(text: str) -> Counter:
    """Occurrences of adjacent symbols that do not overlap themselves; lines are sequences."""
    out = Counter(a + b for a, b in zip(text, text[1:]) if a != b)
    i, n = 0, len(text)
    while i < n:
        j = i
        while j < n and text[j] == text[i]:
            j += 1
        if j - i > 1:
            out[text[i] * 2] += (j - i) // 2
        i = j
    return Counter({pair: c for pair, c in out.items() if "\n" not in pair})


def learned(sequences: DataFrame, p: RepairParams) -> tuple[str, ...]:
    """Re-Pair rules over the distinct sequences. Pairs replaced in one round share no symbol, so their order plays no part; only counts of
    pairs reach the driver, of which there are at most (symbols + rules) squared."""
    distinct = written(sequences.select("sequence").distinct(), "sequences")
    rules: tuple[str, ...] = ()
    for _ in range(p.max_rounds):

        def run(batches, rules=rules):
            total: Counter = Counter()
            for b in batches:
                total += pair_counts(compressed("\n".join(b.column(0).to_pylist()), rules))
            yield pa.table({"pair": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

        counts = within(distinct, run, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        used: set[str] = set()
        for r in counts.orderBy(F.desc("n"), "pair").collect():
            if not used & set(r["pair"]) and len(rules) < p.max_rules:
                rules += (r["pair"],)
                used |= set(r["pair"])
        if not used:
            break
    return rules


# Results.


def unpacked(b: dict):
    for role, text, copies in zip(b["roles"], b["texts"], b["copies"], strict=True):
        for _ in range(copies):
            yield role, text


def repaired(b: dict, audit: str, state: int) -> list[str]:
    """Repaired ``role:text`` rows of a bundle; the state tells the role of new and changed rows."""
    rows, out = unpacked(b), []
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == USER else "user"
        state = NEXT[role[:1]][state]
        out.append(f"{role}:{text}")
    return out


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def gaps_of(low, high, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def finished(whole: DataFrame, rules: tuple[str, ...], p: RepairParams) -> DataFrame:
    """Results of conversations that lie in one bundle."""

    def run(batches):
        known: dict[str, tuple[int, str, int]] = {}  # equal sequences are evaluated once
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                f = facts(b, set())
                if f["sequence"] not in known:
                    if len(known) >= 100_000:
                        known.clear()
                    known[f["sequence"]] = cheapest(carried(opening(START, p), f["sequence"], rules, p))
                cost, audit, _ = known[f["sequence"]]
                text = "\n".join(repaired(b, audit, START))
                out.append(f | {
                    "conv_id": b["conv_id"], "gaps": gaps_of(f["low"], f["high"], f["turns_seen"]), "cost": cost, "audit": audit,
                    "repaired_sha256": hashlib.sha256(text.encode()).hexdigest(),
                })
            yield table_of(out, RESULT)

    return within(whole.select("conv_id", "turns", "roles", "texts", "copies", "kinds", "prints"), run, RESULT)


PLACE = ["key", "part", "k"]


def texts_seen(parts: DataFrame) -> DataFrame:
    """For each bundle the prints of its texts that an earlier bundle of the conversation holds: (key, part, k, seen).

    A bundle sends each text once, so a text that fills a conversation is met once per bundle."""
    several = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")

    def run(batches):
        for batch in batches:
            rows = [
                {"key": b["key"], "part": b["part"], "k": b["k"], "mark": mark}
                for b in batch.to_pylist() for mark in {b["prints"][i : i + 16] for i in range(0, len(b["prints"]), 16)}
            ]
            yield table_of(rows, "key string, part int, k int, mark binary")

    marks = within(parts.join(several, "key", "left_semi").select(*PLACE, "prints"), run, "key string, part int, k int, mark binary")
    first = marks.groupBy("key", "mark").agg(F.min(F.struct("part", "k")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = marks.join(first, ["key", "mark"]).filter(F.struct("part", "k") > F.col("first"))
    return later.groupBy(*PLACE).agg(F.collect_list("mark").alias("seen"))


LINK = (
    "key string, conv_id long, part int, k int, costs array<int>, audits array<string>, blank long, duplicate long, truncated long, "
    "illegal long, first_role string, last_role string, low long, high long, first_turn long, last_turn long, turns_seen long"
)


def links(parts: DataFrame, rules: tuple[str, ...], p: RepairParams) -> DataFrame:
    """Counts and transfer matrix of every bundle; -1 stands for an entry that does not exist."""

    def run(batches):
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                f = facts(b, set(b["seen"] or ()))
                entries = [e for s in STATES for e in carried(opening(s, p, b["leads"]), f["sequence"], rules, p)]
                turns = [t for t in b["turns"] if t is not None]
                out.append(b | f | {
                    "costs": [-1 if e is None else e[0] for e in entries], "audits": ["" if e is None else text_of(e[1]) for e in entries],
                    "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
                })
            yield table_of(out, LINK)

    return within(parts, run, LINK)


def in_order(df: DataFrame) -> DataFrame:
    """Bundles of a conversation in one task, in their order; tasks read them as a stream."""
    return df.repartition("key").sortWithinPartitions(*PLACE)


TOTAL = RESULT.replace("conv_id long", "key string, conv_id long").replace(", repaired_sha256 string", "") + ", part int, k int, state int, piece string, total boolean"


def folded(chain: DataFrame, p: RepairParams) -> DataFrame:
    """One row of totals per conversation, and for each of its bundles the state before it and its audit."""

    def finish(rows: list[dict], vector: list, t: dict) -> list[dict]:
        cost, audit, state = cheapest(vector)
        out = [t["head"] | {
            "gaps": gaps_of(t["low"], t["high"], t["turns"]), "cost": cost, "audit": audit, "part": 0, "k": 0, "state": 0, "piece": "", "total": True,
        }]
        none = dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], 0) | {"audit": "", "total": False}
        for place, before, pieces in reversed(rows):
            start = before[state]
            out.append(none | place | {"state": start, "piece": pieces[state]})
            state = start
        return out

    def run(batches):
        key, rows, vector, t = None, [], None, None
        for batch in batches:
            for b in batch.to_pylist():
                if t is None or b["key"] != key:
                    if t is not None:
                        yield table_of(finish(rows, vector, t), TOTAL)
                    key, rows, vector = b["key"], [], [(0, ""), None, None, None]
                    t = {"head": {"key": key, "conv_id": b["conv_id"]} | dict.fromkeys(["blank", "duplicate", "truncated", "illegal"], 0),
                         "low": None, "high": None, "turns": 0, "role": None, "turn": None}
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    t["head"][name] += b[name]
                if b["first_role"] is not None:
                    if t["role"] is not None:
                        t["head"]["illegal"] += t["role"] + b["first_role"] not in LEGAL
                    t["role"] = b["last_role"]
                if b["low"] is not None:
                    t["turns"] += b["turns_seen"] - (t["turn"] == b["first_turn"])
                    t["low"] = b["low"] if t["low"] is None else min(t["low"], b["low"])
                    t["high"], t["turn"] = b["high"], b["last_turn"]
                after, origin, pieces = [None] * 4, [None] * 4, [""] * 4
                for s in STATES:
                    for q in STATES:
                        cost = b["costs"][4 * s + q]
                        if vector[s] is not None and cost >= 0:
                            entry = (vector[s][0] + cost, joined(vector[s][1], b["audits"][4 * s + q]))
                            if better(entry, after[q]):
                                after[q], origin[q], pieces[q] = entry, s, b["audits"][4 * s + q]
                rows.append(({"key": key, "conv_id": b["conv_id"], "part": b["part"], "k": b["k"]}, origin, pieces))
                vector = after
        if t is not None:
            yield table_of(finish(rows, vector, t), TOTAL)

    return within(in_order(chain), run, TOTAL)


def hashed(parts: DataFrame, pieces: DataFrame) -> DataFrame:
    """SHA-256 of the repaired rows of conversations in several bundles: repaired where they lie, hashed in order."""
    chunk = "key string, part int, k int, n int, chunk binary"

    def mend(batches):
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                lines = repaired(b, b["piece"], b["state"])
                out.append({"key": b["key"], "part": b["part"], "k": b["k"], "n": len(lines), "chunk": "\n".join(lines).encode()})
            yield table_of(out, chunk)

    def run(batches):
        key, sha, some, out = None, None, False, []
        for batch in batches:
            for b in batch.to_pylist():
                if sha is None or b["key"] != key:
                    if sha is not None:
                        out.append({"key": key, "repaired_sha256": sha.hexdigest()})
                    key, sha, some = b["key"], hashlib.sha256(), False
                if b["n"]:
                    sha.update(b"\n" * some + b["chunk"])
                    some = True
        if sha is not None:
            out.append({"key": key, "repaired_sha256": sha.hexdigest()})
        yield table_of(out, "key string, repaired_sha256 string")

    mended = within(parts.join(pieces, PLACE).select(*PLACE, "roles", "texts", "copies", "state", "piece"), mend, chunk)
    return within(in_order(mended), run, "key string, repaired_sha256 string")


def repaired_conversations(conversations: DataFrame, p: RepairParams) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    bundles = written(bundled(damaged(conversations), p), "bundles")
    rules = learned(bundles, p)
    done = finished(bundles.filter("whole"), rules, p)
    parts = bundles.filter(~F.col("whole"))
    seen = texts_seen(parts)
    leads = parts.groupBy("key").agg(F.min(F.struct("part", "k")).alias("lead"))
    known = (
        parts.join(seen, PLACE, "left").join(leads, "key")
        .select(*PLACE, "conv_id", "turns", "roles", "copies", "kinds", "prints", "seen", (F.struct("part", "k") == F.col("lead")).alias("leads"))
    )
    chain = written(folded(links(known, rules, p), p), "chains")
    pieces = chain.filter(~F.col("total")).select(*PLACE, "state", "piece")
    totals = chain.filter("total").join(hashed(parts, pieces), "key")
    return done.unionByName(totals.select(*columns_of(RESULT)))


@query("op12_conversation_repair")
def op12_conversation_repair(spark, folder):
    return repaired_conversations(table(spark, folder, "conversations"), RepairParams())
