"""Secret scans: fixed patterns, and the entropy of sliding windows over what looks like a key.

Assignments, access keys and hex strings are found by pattern. Beyond these, every run of key characters is a candidate; its
class (hex, letters and digits, base64) names a window and a least entropy. A window slides over
the candidate with one count per character, updated by the character that enters and the one that leaves, so
its entropy costs one step per character. Whole numbers (c log2 c in steps of 2^-20) keep the sums exact. From
the first window that is random enough to the last one is a span, unless the allow-list knows the candidate
(ids, words and numbers joined by marks, placeholders) or what stands before it (a named digest).

Places are code points, ends exclusive. They come from the lengths of the pieces between matches, added up in blocks of
256, so that a text of very many matches costs little more than its length. A text never leaves its row, and all of it is DataFrame
expressions.

Defined cases: a null text is empty and holds nothing, as does an empty one; null ids are kept; repeated rows are scanned each; an
empty table gives an empty result; entropy spans are listed beside pattern spans that cover the same place; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.order import computed_once
from kinfold.llm.registry import query, table

#: The patterns and least lengths of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

KEY_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "entropy")
UNIT = 1 << 20
BLOCK = 256


@dataclass(frozen=True)
class KeyClass:
    """Candidates that match ``form`` and hold every pattern of ``needs``; the first class that fits counts."""

    form: str
    needs: tuple[str, ...]
    window: int
    bits: float  # least entropy of a window, per character
    fold: bool = False  # letters of either case are one

    @property
    def most(self) -> int:
        """Largest sum of c log2 c that is random enough."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * UNIT)


@dataclass(frozen=True)
class SecretParams:
    least: int = 20  # characters of a candidate
    classes: tuple[KeyClass, ...] = (
        KeyClass("^[0-9a-fA-F]+$", ("[0-9]", "[a-fA-F]"), 24, 2.9, fold=True),
        KeyClass("^[0-9A-Za-z]+$", ("[0-9]", "[A-Za-z]"), 20, 3.7),
        KeyClass("^[0-9A-Za-z+/_=-]+$", ("[0-9]", "[A-Z]", "[a-z]"), 24, 4.0),
    )
    allowed: tuple[str, ...] = (
        "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
        "^[+/_=-]*([A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,4})([+/_=-]+([A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,4}))+[+/_=-]*$",
        "(?i)example|placeholder|your[_-]|xxxx|01234567|abcdefgh|deadbeef",
    )
    allowed_before: str = """(?i)(sha-?[0-9]{1,3}|md5|commit|revision|checksum|etag|integrity)[-"':= ]{1,4}$"""

    @property
    def candidate(self) -> str:
        return f"[A-Za-z0-9+/_=-]{{{self.least},}}"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, inside one expression."""
    return F.transform(F.array(value), use)[0]


def placed(matches: Column, pieces: Column) -> Column:
    """array<struct<start, end>> of matches with the pieces of text between them."""
    sizes = F.transform(matches, lambda m, i: F.struct(F.char_length(F.get(pieces, i)).alias("gap"), F.char_length(m).alias("n")))

    def offsets(rows: Column, start: Column, size, emit) -> Column:
        empty = F.filter(F.transform(rows, lambda r: emit(r, F.lit(0))), lambda r: F.lit(False))
        return F.aggregate(
            rows,
            F.struct(start.cast("int").alias("at"), empty.alias("out")),
            lambda acc, r: F.struct((acc["at"] + size(r)).alias("at"), F.concat(acc["out"], F.array(emit(r, acc["at"]))).alias("out")),
            lambda acc: acc["out"],
        )

    def blocks(all_sizes: Column) -> Column:
        last = F.floor((F.size(all_sizes) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_sizes, b * BLOCK + 1, BLOCK))

    def sums(parts: Column) -> Column:
        return F.transform(parts, lambda b: F.aggregate(b, F.lit(0), lambda acc, r: acc + r["gap"] + r["n"]))

    def span(r: Column, at: Column) -> Column:
        return F.struct((at + r["gap"]).alias("start"), (at + r["gap"] + r["n"]).alias("end"))

    def in_blocks(parts: Column) -> Column:
        begins = offsets(sums(parts), F.lit(0), lambda n: n, lambda n, at: at)
        return let(begins, lambda first: F.flatten(F.transform(
            parts, lambda b, i: offsets(b, F.get(first, i), lambda r: r["gap"] + r["n"], span)
        )))

    return let(sizes, lambda s: let(blocks(s), in_blocks))


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,end:int>>")


def pattern_spans(text: Column, pattern: str, matches: Column) -> Column:
    return F.when(F.size(matches) == 0, no_spans()).otherwise(
        let(F.split(text, pattern), lambda pieces: placed(matches, pieces))
    )


def assign_spans(text: Column, matches: Column) -> Column:
    """Spans of assignments whose value is long enough; shorter ones are matched too, and dropped."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    kept = let(values, lambda v: F.filter(pattern_spans(text, ASSIGN, matches), lambda s, i: F.char_length(F.get(v, i)) >= ASSIGN_VALUE))
    return F.when(F.size(matches) == 0, no_spans()).otherwise(kept)


def class_of(key: Column, p: SecretParams) -> Column:
    """struct<window, most, fold> of a candidate's class; null if it has none."""
    out = F.lit(None)
    for c in reversed(p.classes):
        fits = key.rlike(c.form)
        for need in c.needs:
            fits = fits & key.rlike(need)
        out = F.when(
            fits, F.struct(F.lit(c.window).alias("window"), F.lit(c.most).cast("long").alias("most"), F.lit(c.fold).alias("fold"))
        ).otherwise(out)
    return out


def random_part(key: Column, kind: Column, p: SecretParams) -> Column:
    """struct<first, last>: where the windows of high entropy begin and end in a candidate; first is -1 if there is none."""
    widest = max(c.window for c in p.classes)
    weights = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("long") for c in range(widest + 1)])
    alphabet = F.lit(KEY_CHARACTERS)
    folded = F.when(kind["fold"], F.lower(key)).otherwise(key)
    # Code of every character and of the one that leaves the window with it.
    codes = F.transform(F.split(folded, ""), lambda ch: F.instr(alphabet, ch) - 1)

    def slide(code: Column) -> Column:
        moves = F.transform(
            code, lambda x, i: F.struct(x.alias("enters"), F.coalesce(F.when(i >= kind["window"], F.get(code, i - kind["window"])), F.lit(-1)).alias("leaves"), i.alias("i"))
        )

        def step(acc: Column, m: Column) -> Column:
            more, fewer = F.get(acc["counts"], m["enters"]), F.get(acc["counts"], m["leaves"])
            change = F.when(m["enters"] == m["leaves"], F.lit(0).cast("long")).otherwise(
                F.get(weights, more + 1) - F.get(weights, more)
                - F.when(m["leaves"] >= 0, F.get(weights, fewer) - F.get(weights, fewer - 1)).otherwise(0)
            )
            total = acc["total"] + change
            found = (m["i"] >= kind["window"] - 1) & (total <= kind["most"])
            return F.struct(
                F.transform(acc["counts"], lambda c, j: c + (j == m["enters"]).cast("int") - (j == m["leaves"]).cast("int")).alias("counts"),
                total.alias("total"),
                F.when(found & (acc["first"] < 0), m["i"] - kind["window"] + 1).otherwise(acc["first"]).alias("first"),
                F.when(found, m["i"] + 1).otherwise(acc["last"]).alias("last"),
            )

        start = F.struct(
            F.array_repeat(F.lit(0), len(KEY_CHARACTERS)).alias("counts"), F.lit(0).cast("long").alias("total"),
            F.lit(-1).alias("first"), F.lit(-1).alias("last"),
        )
        return F.aggregate(moves, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    return let(codes, slide)


def entropy_spans(text: Column, keys: Column, p: SecretParams) -> Column:
    """Spans of high entropy inside the candidates of a text."""

    def of(pieces: Column) -> Column:
        known = lambda key, i: (
            F.greatest(*[key.rlike(a) for a in p.allowed]) | F.substring(F.get(pieces, i), -24, 24).rlike(p.allowed_before)
        )
        none = F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("last"))
        parts = F.transform(
            keys,
            lambda key, i: let(class_of(key, p), lambda kind: F.when(kind.isNull() | known(key, i), none).otherwise(random_part(key, kind, p))),
        )
        # A candidate without a random part costs no place.
        return let(parts, lambda part: F.when(~F.exists(part, lambda r: r["first"] >= 0), no_spans()).otherwise(
            let(placed(keys, pieces), lambda at: F.filter(
                F.transform(part, lambda r, i: F.when(r["first"] >= 0, F.struct(
                    (F.get(at, i)["start"] + r["first"]).alias("start"), (F.get(at, i)["start"] + r["last"]).alias("end")
                ))), lambda s: s.isNotNull()
            ))
        ))

    return F.when(F.size(keys) == 0, no_spans()).otherwise(let(F.split(text, p.candidate), of))


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of the spans of some kinds by start, then kind, comma-joined."""

    def of(kind: str) -> Column:
        place = F.lit(KINDS.index(kind)).alias("kind")
        return F.transform(f"_{kind}", lambda s: F.struct(s["start"].alias("start"), place, s["end"].alias("end")))

    spans = F.concat(*map(of, kinds))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scanned(docs: DataFrame, p: SecretParams) -> DataFrame:
    """doc_id and the spans of every kind: arrays ``_assign``, ``_access``, ``_hex``, ``_entropy``."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    every = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = computed_once(texts, _a=every(ASSIGN), _k=every(ACCESS), _h=every(HEX), _c=every(p.candidate))
    return computed_once(
        found,
        _assign=assign_spans(text, F.col("_a")),
        _access=pattern_spans(text, ACCESS, F.col("_k")),
        _hex=pattern_spans(text, HEX, F.col("_h")),
        _entropy=entropy_spans(text, F.col("_c"), p),
    ).select("doc_id", *[f"_{kind}" for kind in KINDS])


def secrets(docs: DataFrame, p: SecretParams) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and all spans of every document."""
    return scanned(docs, p).select(
        "doc_id",
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed("assign", "access", "hex").cast("binary"), 256).alias("base_sha256"),
        listed(*KINDS).alias("spans"),
    )


def duck_sql(p: SecretParams) -> str:
    """The same in DuckDB: places from the pieces before a match, windows one by one with counts taken anew."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def spans(pattern: str, keep: str) -> str:
        re = quoted(pattern)
        return f"""list_filter(list_transform(range(1, len(regexp_extract_all(text, {re}, 0)) + 1), lambda i: {{
  'start': CAST(list_sum(list_transform(string_split_regex(text, {re})[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(regexp_extract_all(text, {re}, 0)[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
  'key': regexp_extract_all(text, {re}, 0)[i], 'piece': string_split_regex(text, {re})[i], {keep}}}), lambda s: s.good)"""

    widest = max(c.window for c in p.classes)
    weights = "[" + ", ".join(str(round(c * math.log2(c) * UNIT) if c else 0) for c in range(widest + 1)) + "]"
    cases = {}
    for name, value in (("w", lambda c: c.window), ("most", lambda c: c.most), ("fold", lambda c: int(c.fold))):
        cases[name] = "CASE " + " ".join(
            f"WHEN {' AND '.join(f'regexp_matches(s.key, {quoted(f)})' for f in (c.form, *c.needs))} THEN {value(c)}" for c in p.classes
        ) + " END"
    allow = " OR ".join(f"regexp_matches(s.key, {quoted(a)})" for a in p.allowed)
    total = """list_sum(list_transform(list_distinct(string_split(substring(cand.key, i, cand.w), '')),
      lambda ch: weights[length(substring(cand.key, i, cand.w)) - length(replace(substring(cand.key, i, cand.w), ch, '')) + 1]))"""
    plain = lambda kind, n: (
        f"list_transform({kind}, lambda s: {{'start': s.start, 'kind': {n}, 'e': s.start + length(s.key)}})"
    )
    joined = lambda x: (
        f"coalesce(list_aggregate(list_transform(list_sort({x}), lambda s: ['assign', 'access', 'hex', 'entropy'][s.kind + 1]"
        " || ':' || s.start || ':' || s.e), 'string_agg', ','), '')"
    )
    return f"""
WITH f AS (SELECT doc_id, {weights} AS weights,
  {spans(ASSIGN, f"'good': length(regexp_extract_all(text, {quoted(ASSIGN)}, 2)[i]) >= {ASSIGN_VALUE}")} AS ra,
  {spans(ACCESS, "'good': true")} AS rk, {spans(HEX, "'good': true")} AS rh, {spans(p.candidate, "'good': true")} AS rc
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
g AS (SELECT * EXCLUDE (rc), list_transform(list_filter(rc, lambda s: {cases["w"]} IS NOT NULL AND NOT ({allow})
    AND NOT regexp_matches(right(s.piece, 24), {quoted(p.allowed_before)})),
  lambda s: {{'start': s.start, 'key': CASE WHEN {cases["fold"]} = 1 THEN lower(s.key) ELSE s.key END, 'w': {cases["w"]}, 'most': {cases["most"]}}}) AS rc FROM f),
e AS (SELECT * EXCLUDE (rc), list_transform(rc, lambda cand: {{'start': cand.start, 'w': cand.w,
  'at': list_filter(range(1, length(cand.key) - cand.w + 2), lambda i: {total} <= cand.most)}}) AS rc FROM g),
s AS (SELECT doc_id, ra, rk, rh, {plain("ra", 0)} || {plain("rk", 1)} || {plain("rh", 2)} AS base,
  list_transform(list_filter(rc, lambda x: len(x.at) > 0),
    lambda x: {{'start': x.start + x.at[1] - 1, 'kind': 3, 'e': x.start + x.at[-1] - 1 + x.w}}) AS random FROM e)
SELECT doc_id, len(ra) AS n_assign, len(rk) AS n_access, len(rh) AS n_hex, len(random) AS n_entropy,
  sha256({joined("base")}) AS base_sha256, {joined("base || random")} AS spans FROM s"""


@query("op11_secret_scans", duck_sql(SecretParams()))
def op11_secret_scans(spark, folder):
    return secrets(table(spark, folder, "documents"), SecretParams())
