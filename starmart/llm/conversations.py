"""Conversation repair by a run-length dynamic programme.

A conversation's rows stand by turn, nulls first; rows of one turn by the
SHA-256 of their role and text. A row's first fault counts: *blank* (nothing
but white space), *duplicate* (role and text seen earlier in the conversation),
*truncated* (the last character that is not white space is none of ``.!?``).
The repair edits rows so that role initials read ``(s?(ua)+)?``: Keep costs 0,
Rerole (to user or assistant) 1, Delete 2 and is required for blank and
duplicate rows, Insert (an empty text of user or assistant, anywhere) 5; a
truncated row that stays adds 5. The audit is the cheapest sequence of edits,
of equally cheap ones the ASCII-least.

Run-length DP. A row's symbol is its role initial (s, u, a or another) with its
fault; equal consecutive symbols are one run. An edit takes the reader of the
pattern from one of four states to another, so a symbol is a 4 x 4 transition
matrix in the min-plus semiring, inserts included, and a run of n rows is its
n-th power, put together from cached binary powers. Costs to go are advanced
from the end run by run; the audit is unrolled from the start, in blocks whose
costs to go come from the same powers.

Rows are sorted by range of (conversation, turn, digest), without their texts,
so a conversation may lie in many partitions. One that lies in a single
partition is repaired there. Of one that crosses partitions, each partition
gives its piece's transition matrix; costs to go are folded over the pieces;
every piece is unrolled for each state it may start in, and the pieces are
chained. So no task holds the rows of a large conversation. What is of its size
are the audit itself, one character a row, and the stream of its repaired text
through one SHA-256, which has to read it from start to end. Duplicates are
told by an aggregate and a join on (conversation, digest), which Spark can
split.

Nulls in role and text count as one space. A null conversation id is a
conversation of its own; turns that are null take no part in the gaps. Rows
that repeat turn, role and text are duplicates of each other. A conversation
without rows gives zeros, an empty audit and the digest of the empty string; an
empty table gives an empty result. Columns other than the four are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, materialize, ship

VISIBLE = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # costs; CUT is a truncated row that stays
# States: nothing yet, after the opening s, after u, after a.
STATES, AFTER_U, AFTER_A = 4, 2, 3
INF = 1 << 60
KINDS = "sua"  # symbol = 2 * (place here, or 3) + truncated
GONE = 8  # symbol of a blank or duplicate row
BLOCK = 512
TO_U = {0: AFTER_U, 1: AFTER_U, AFTER_A: AFTER_U}
NEXT = {**TO_U, AFTER_U: AFTER_A}  # by an edit that gives user or assistant


# ------------------------------------------------------------- min-plus DP
def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), INF)


def _apply(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.minimum((a + v[None, :]).min(1), INF)


def _moves(symbol: int) -> list[tuple[str, int, int, int]]:
    """(edit, from, to, cost) of the edits of a row, in ASCII order."""
    out = [("D", q, q, DELETE) for q in range(STATES)]
    if symbol != GONE:
        kind, cut = symbol >> 1, CUT * (symbol & 1)
        keeps = {0: {0: 1}, 1: TO_U, 2: {AFTER_U: AFTER_A}, 3: {}}[kind]
        out += [("K", p, q, KEEP + cut) for p, q in keeps.items()]
        out += [("R", p, q, REROLE + cut) for p, q in NEXT.items()]
    return out


@lru_cache(maxsize=1)
def inserts() -> np.ndarray:
    """Cheapest inserts from state to state: none, one or two."""
    one = np.full((STATES, STATES), INF, np.int64)
    np.fill_diagonal(one, 0)
    for p, q in NEXT.items():
        one[p, q] = INSERT
    return _times(one, one)


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> np.ndarray:
    """Transition matrix of 2**bit rows of a symbol."""
    if bit:
        return _times(power(symbol, bit - 1), power(symbol, bit - 1))
    row = np.full((STATES, STATES), INF, np.int64)
    for _, p, q, cost in _moves(symbol):
        row[p, q] = min(row[p, q], cost)
    return _times(inserts(), row)


def advance(symbol: int, n: int, to_go: np.ndarray) -> np.ndarray:
    """Costs to go before ``n`` rows of a symbol, from those after them."""
    for bit in range(int(n).bit_length()):
        if n >> bit & 1:
            to_go = _apply(power(symbol, bit), to_go)
    return to_go


def at_end() -> np.ndarray:
    """Costs to go after the last row: the pattern ends after nothing or after a."""
    return _apply(inserts(), np.array([0, INF, INF, 0], np.int64))


def matrix(runs: list) -> np.ndarray:
    out = None
    for symbol, n in runs:
        for bit in range(int(n).bit_length()):
            if n >> bit & 1:
                out = power(symbol, bit) if out is None else _times(out, power(symbol, bit))
    return out


@lru_cache(maxsize=1 << 16)
def _choices(symbol: int, state: int, after: tuple) -> tuple[str, int]:
    """The edits up to and with a row's own, and the state after it, by the costs to go after the row."""
    v = power(symbol, 0)
    edits = ""
    after_row = np.array(after, np.int64)
    before = _apply(v, after_row)
    while True:
        # ASCII order of the edits: D, I, K, R
        options = [(e, q, c + after[q]) for e, p, q, c in _moves(symbol) if p == state]
        if state in NEXT:
            options.append(("I", NEXT[state], INSERT + int(before[NEXT[state]])))
        edit, state, _ = min((o for o in options if o[2] == before[state]), key=lambda o: o[0])
        edits += edit
        if edit != "I":
            return edits, state


def unroll(runs: list, state: int, to_go: np.ndarray) -> tuple[str, int]:
    """The audit of some runs from a state on, given the costs to go after them, and the state reached."""
    after = [to_go]
    for symbol, n in reversed(runs):
        after.append(advance(symbol, n, after[-1]))
    after.reverse()
    out = []
    for k, (symbol, n) in enumerate(runs):
        done = 0
        while done < n:
            size = min(BLOCK, n - done)
            v = advance(symbol, n - done - size, after[k + 1])
            held = [v]
            for _ in range(size - 1):
                v = _apply(power(symbol, 0), v)
                held.append(v)
            for v in reversed(held):
                edits, state = _choices(symbol, state, tuple(v.tolist()))
                out.append(edits)
            done += size
    return "".join(out), state


def closing(state: int) -> str:
    """The inserts after the last row."""
    return {0: "", 1: "II", AFTER_U: "I", AFTER_A: ""}[state]


# ---------------------------------------------------------------- the rows
def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows as a bad export leaves them, by crc32 of ``conv_id:turn`` modulo 20: 0
    drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    sets role user. Columns conv_id, turn, role, text, times."""
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv_col, turn_col, role_col, text_col))
    or_space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = rows.select(conv.alias("conv_id"), turn.cast("long").alias("turn"), or_space(role).alias("role"), or_space(text).alias("text"),
                       F.pmod(F.crc32(F.concat_ws(":", or_space(conv), or_space(turn)).cast("binary")), F.lit(20)).alias("u"))
    return rows.where("u <> 0").select(
        "conv_id", "turn", F.when(F.col("u") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("u") == 1, "").when(F.col("u") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("u") == 3, 2).otherwise(1).alias("times"))


def _key(conv):
    """A conversation's id as a string that is never null."""
    return F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string")))


def _keyed(rows: DataFrame) -> DataFrame:
    same = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    return rows.withColumns({"c": _key(F.col("conv_id")), "k": same})


def _symbols(rows: DataFrame) -> DataFrame:
    """(c, turn, k, initial, blank, cut, fresh, m): one row for those that repeat a turn, role and text, m of them.
    fresh: the conversation has no earlier turn with this role and text."""
    narrow = rows.select("c", "turn", "k", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(VISIBLE)).alias("blank"), (~F.col("text").rlike(ENDED)).alias("cut"), F.col("times").cast("long").alias("times"))
    narrow = materialize(narrow.groupBy("c", "turn", "k", "initial", "blank", "cut").agg(F.sum("times").alias("m")))
    least = narrow.groupBy(F.col("c").alias("c1"), F.col("k").alias("k1")).agg(F.max(F.col("turn").isNull()).alias("none"), F.min("turn").alias("first"), F.count("*").alias("n")).where("n > 1")
    both = narrow.join(least, (F.col("c") == F.col("c1")) & (F.col("k") == F.col("k1")), "left")
    fresh = F.when(F.col("n").isNull(), True).when(F.col("none"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    return both.select("c", "turn", "k", "initial", "blank", "cut", fresh.alias("fresh"), "m")


# ---------------------------------------------------------------- the pieces
COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal")
STATS = ", ".join(f"{c} long" for c in COUNTS) + ", least long, most long, turns long, first_turn long, last_turn long, first_initial string, last_initial string"
NAMES = [x.split()[0] for x in STATS.split(", ")]


def _bad(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _joined(a: dict, b: dict) -> dict:
    """What is known of two consecutive pieces together, without their runs."""
    out = {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += _bad(a["last_initial"], b["first_initial"])
    ends = [x[c] for x in (a, b) for c in ("least", "most") if x[c] is not None]
    out |= {"least": min(ends, default=None), "most": max(ends, default=None)}
    out["turns"] = a["turns"] + b["turns"] - (a["last_turn"] is not None and a["last_turn"] == b["first_turn"])
    return out | {"first_turn": a["first_turn"], "first_initial": a["first_initial"], "last_turn": b["last_turn"], "last_initial": b["last_initial"]}


def _piece(turn: list, initial: list, blank: list, cut: list, fresh: list, m: list) -> tuple[dict, list]:
    """What is known of consecutive rows of a conversation, and their runs."""
    s = {"rows": sum(m), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    runs: list = []

    def add(symbol, n):
        if runs and runs[-1][0] == symbol:
            runs[-1][1] += n
        else:
            runs.append([symbol, n])

    for i, n in enumerate(m):
        if blank[i]:
            s["blank"] += n
            add(GONE, n)
        elif not fresh[i]:
            s["duplicate"] += n
            add(GONE, n)
        else:
            s["truncated"] += cut[i]
            kind = KINDS.find(initial[i]) if initial[i] else -1
            add(2 * (kind if kind >= 0 else 3) + cut[i], 1)
            if n > 1:
                s["duplicate"] += n - 1
                add(GONE, n - 1)
        s["illegal"] += (n - 1) * _bad(initial[i], initial[i]) + (i > 0 and _bad(initial[i - 1], initial[i]))
    known = [t for t in turn if t is not None]
    s |= {"least": min(known, default=None), "most": max(known, default=None), "turns": len(set(known)), "first_turn": turn[0], "last_turn": turn[-1], "first_initial": initial[0], "last_initial": initial[-1]}
    return s, runs


PIECE = f"c string, part int, turn0 long, k0 binary, whole boolean, cost long, audit string, {STATS}, symbols binary, lengths array<long>, matrix array<long>"


def _pieces(schema: pa.Schema, batches):
    """The pieces of a partition's sorted rows; conversations that surely lie in it alone are repaired."""
    held = None  # the last conversation so far: c, part, turn0, k0, stats, runs
    n_out = 0

    def row(p, last):
        nonlocal n_out
        c, part, turn0, k0, s, runs = p
        whole = n_out > 0 and not last
        n_out += 1
        known = {"c": c, "part": part, "turn0": turn0, "k0": k0, "whole": whole, "cost": None, "audit": None, "symbols": None, "lengths": None, "matrix": None, **s}
        if whole:
            to_go = at_end()
            audit, state = unroll(runs, 0, to_go)
            for symbol, n in reversed(runs):
                to_go = advance(symbol, n, to_go)
            return known | {"cost": int(to_go[0]), "audit": audit + closing(state)}
        return known | {"symbols": bytes(x for x, _ in runs), "lengths": [n for _, n in runs], "matrix": matrix(runs).ravel().tolist()}

    for b in batches:
        if not b.num_rows:
            continue
        c, part, turn, k, *rest = (col.to_pylist() for col in b.columns)
        cuts = [i for i in range(1, len(c)) if c[i] != c[i - 1]]
        out = []
        for lo, hi in zip([0, *cuts], [*cuts, len(c)]):
            s, runs = _piece(turn[lo:hi], *(x[lo:hi] for x in rest))
            if held and held[0] == c[lo]:
                held[4] = _joined(held[4], s)
                if held[5][-1][0] == runs[0][0]:
                    held[5][-1][1] += runs.pop(0)[1]
                held[5].extend(runs)
            else:
                if held:
                    out.append(row(held, False))
                held = [c[lo], part[lo], turn[lo], k[lo], s, runs]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist([row(held, True)], schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def _runs(symbols: bytes, lengths: list) -> list:
    return list(zip(symbols, lengths))


def _mapped(f, schema: str):
    """A function of one row (a dict) to rows, for ``mapInArrow``."""
    arrow = _arrow(schema)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                out = f(b.slice(i, 1).to_pylist()[0])
                if out:
                    yield pa.RecordBatch.from_pylist(out, arrow)
    return lean(run)


def _to_go(conv: dict) -> list:
    """The costs to go after each piece of a conversation."""
    v, out = at_end(), []
    for p in sorted(conv["pieces"], key=lambda p: p["part"], reverse=True):
        out.append({"c": conv["c"], "part": p["part"], "to_go": v.tolist()})
        v = _apply(np.array(p["matrix"], np.int64).reshape(STATES, STATES), v)
    return out


def _unrolled(p: dict) -> list:
    """A piece's audit from each state it may start in."""
    runs, to_go = _runs(p["symbols"], p["lengths"]), np.array(p["to_go"], np.int64)
    cost = _apply(np.array(p["matrix"], np.int64).reshape(STATES, STATES), to_go)
    each = [unroll(runs, q, to_go) if cost[q] < INF else ("", 0) for q in range(STATES)]
    return [{x: p[x] for x in ("c", "part", "turn0", "k0", *NAMES)} | {"costs": cost.tolist(), "ends": [e for _, e in each], "audits": [a for a, _ in each]}]


REPAIRED = "c string, cost long, audit string, " + ", ".join(f"{c} long" for c in (*COUNTS, "gaps")) + ", pieces array<struct<turn0: long, k0: binary, state: int, edits: string>>"


def _chained(conv: dict) -> list:
    """Pieces put together: each starts in the state that the one before ends in."""
    state, known, out = 0, None, []
    pieces = sorted(conv["pieces"], key=lambda p: p["part"])
    for p in pieces:
        known = p if known is None else _joined(known, p)
        out.append({"turn0": p["turn0"], "k0": p["k0"], "state": state, "edits": p["audits"][state]})
        state = p["ends"][state]
    out[-1]["edits"] += closing(state)
    return [{"c": conv["c"], "cost": pieces[0]["costs"][0], "audit": "".join(o["edits"] for o in out), "gaps": _gaps(known), "pieces": out, **{c: known[c] for c in COUNTS}}]


def _gaps(s: dict) -> int:
    return 0 if s["least"] is None else s["most"] - s["least"] + 1 - s["turns"]


def _digests(schema: pa.Schema, batches):
    """SHA-256 of every conversation's repaired text, from its pieces and rows in order."""
    c = sha = edits = state = at = None
    first, out = True, []

    def put(role, text):
        nonlocal first
        sha.update(("" if first else "\n").encode() + role.encode() + b":" + text)
        first = False

    def step():
        """Role of a row that the pattern continues with."""
        nonlocal state
        state = NEXT[state]
        return "user" if state == AFTER_U else "assistant"

    def rest():
        nonlocal at
        while edits is not None and at < len(edits):  # only inserts are left
            put(step(), b"")
            at += 1

    for b in batches:
        for conv, edit, start, role, text, times in zip(*(b.column(x).to_pylist() for x in ("c", "edits", "state", "role", "text", "times"))):
            if conv != c:
                if c is not None:
                    rest()
                    out.append({"c": c, "repaired_sha256": sha.hexdigest()})
                c, sha, first, edits = conv, hashlib.sha256(), True, None
            if edit is not None:
                rest()
                edits, state, at = edit, start, 0
                continue
            for _ in range(times):
                while edits[at] == "I":
                    put(step(), b"")
                    at += 1
                if edits[at] == "K":
                    state = 1 if role[:1] == "s" else NEXT[state]
                    put(role, text)
                elif edits[at] == "R":
                    put(step(), text)
                at += 1
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if c is not None:
        rest()
        yield pa.RecordBatch.from_pylist([{"c": c, "repaired_sha256": sha.hexdigest()}], schema)


# ----------------------------------------------------------------- operator
def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, n_rows. ``rows`` has conv_id, turn, role, text
    and times (how often the row stands there); ``conversations`` lists
    conv_ids that have a row in the result even without any in ``rows``."""
    ship(rows.sparkSession)
    rows = _keyed(rows)
    ordered = _symbols(rows).repartitionByRange("c", "turn", "k").sortWithinPartitions("c", "turn", "k")
    ordered = ordered.select("c", F.spark_partition_id().alias("part"), "turn", "k", "initial", "blank", "cut", "fresh", "m")
    pieces = materialize(ordered.mapInArrow(lean(partial(_pieces, _arrow(PIECE))), PIECE))

    parts = pieces.where("not whole")
    of_conv = parts.groupBy("c").agg(F.collect_list(F.struct("part", "matrix")).alias("pieces"))
    to_go = of_conv.mapInArrow(_mapped(_to_go, "c string, part int, to_go array<long>"), "c string, part int, to_go array<long>")
    stats = f"c string, part int, turn0 long, k0 binary, {STATS}, costs array<long>, ends array<int>, audits array<string>"
    unrolled = materialize(parts.join(to_go, ["c", "part"]).mapInArrow(_mapped(_unrolled, stats), stats))
    of_conv = unrolled.groupBy("c").agg(F.collect_list(F.struct("part", "turn0", "k0", *NAMES, "costs", "ends", "audits")).alias("pieces"))
    chained = of_conv.mapInArrow(_mapped(_chained, REPAIRED), REPAIRED)
    gaps = F.when(F.col("least").isNull(), 0).otherwise(F.col("most") - F.col("least") + 1 - F.col("turns"))
    one = F.array(F.struct("turn0", "k0", F.lit(0).alias("state"), F.col("audit").alias("edits")))
    whole = pieces.where("whole").select("c", "cost", "audit", *COUNTS, gaps.cast("long").alias("gaps"), one.alias("pieces"))
    repaired = materialize(whole.unionByName(chained))

    edits = repaired.select("c", F.inline("pieces")).select("c", F.col("turn0").alias("turn"), F.col("k0").alias("k"), F.lit(0).alias("kind"), "edits", "state", F.lit(None).cast("string").alias("role"),
                                                           F.lit(None).cast("binary").alias("text"), F.lit(None).cast("int").alias("times"))
    texts = rows.select("c", "turn", "k", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("edits"), F.lit(None).cast("int").alias("state"), "role", F.col("text").cast("binary").alias("text"), F.col("times").cast("int").alias("times"))
    stream = edits.unionByName(texts).repartition("c").sortWithinPartitions("c", "turn", "k", "kind").select("c", "edits", "state", "role", "text", "times")
    digest = "c string, repaired_sha256 string"
    digests = stream.mapInArrow(lean(partial(_digests, _arrow(digest))), digest)

    ids = (rows if conversations is None else conversations).select("conv_id").distinct().withColumn("c", _key(F.col("conv_id")))
    both = ids.join(repaired.drop("pieces"), "c", "left").join(digests, "c", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"), zero("rows").alias("n_rows"))


def repair_damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``repair`` of the rows after ``damage``, with every conversation there was."""
    return repair(damage(rows, conv_col, turn_col, role_col, text_col), rows.select(F.col(f"`{conv_col}`").alias("conv_id")))


SQL = r"""WITH tab AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
seen AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
dealt AS (SELECT seen.*, xor(list_reduce(list_transform(range(1, strlen(key) + 1), lambda i: ord(key[i])::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS u FROM seen, tab),
bad AS (SELECT conv_id, turn, CASE WHEN u = 4 THEN 'user' ELSE role END AS role,
    CASE u WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN u = 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt WHERE u <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), copy) AS i FROM bad),
marked AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault, substr(role, 1, 1) AS ini,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS was FROM numbered),
facts AS (SELECT conv_id, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (was IS NOT NULL AND was || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows,
    list({'gone': fault IN ('b', 'd'), 'cut': CASE WHEN fault = 't' THEN 5 ELSE 0 END, 'ini': ini, 'role': role, 'text': text} ORDER BY i) AS rows
  FROM marked GROUP BY conv_id),
-- a way to a state: cost (in a sortable form) with audit, and the repaired text; per state the least
ways AS (SELECT *, list_reduce(rows, lambda w, x: list_transform(
    [list_transform([0, 1, 2, 3], lambda q: list_min([w[q + 1], ([
        NULL,
        NULL,
        list_min(list_transform([w[1], w[2], w[4]], lambda p: {'c': p.c + 5, 'a': p.a || 'I', 't': p.t || chr(10) || 'user:'})),
        list_min([{'c': w[3].c + 5, 'a': w[3].a || 'I', 't': w[3].t || chr(10) || 'assistant:'},
          list_min(list_transform([w[1], w[2]], lambda p: {'c': p.c + 10, 'a': p.a || 'II', 't': p.t || chr(10) || 'user:' || chr(10) || 'assistant:'}))])])[q + 1]]))],
    lambda v: [
      {'c': v[1].c + 2, 'a': v[1].a || 'D', 't': v[1].t},
      list_min([{'c': v[2].c + 2, 'a': v[2].a || 'D', 't': v[2].t},
        CASE WHEN NOT x.gone AND x.ini = 's' THEN {'c': v[1].c + x.cut, 'a': v[1].a || 'K', 't': v[1].t || chr(10) || x.role || ':' || x.text} END]),
      list_min([{'c': v[3].c + 2, 'a': v[3].a || 'D', 't': v[3].t},
        list_min(list_transform([v[1], v[2], v[4]], lambda p: CASE WHEN x.gone THEN NULL WHEN x.ini = 'u' THEN {'c': p.c + x.cut, 'a': p.a || 'K', 't': p.t || chr(10) || x.role || ':' || x.text}
          ELSE {'c': p.c + x.cut + 1, 'a': p.a || 'R', 't': p.t || chr(10) || 'user:' || x.text} END))]),
      list_min([{'c': v[4].c + 2, 'a': v[4].a || 'D', 't': v[4].t},
        CASE WHEN x.gone THEN NULL WHEN x.ini = 'a' THEN {'c': v[3].c + x.cut, 'a': v[3].a || 'K', 't': v[3].t || chr(10) || x.role || ':' || x.text}
          ELSE {'c': v[3].c + x.cut + 1, 'a': v[3].a || 'R', 't': v[3].t || chr(10) || 'assistant:' || x.text} END])])[1],
    [{'c': 0, 'a': '', 't': ''}, {'c': 1000000000, 'a': '', 't': ''}, {'c': 1000000000, 'a': '', 't': ''}, {'c': 1000000000, 'a': '', 't': ''}]) AS w FROM facts),
best AS (SELECT *, list_min([w[1], w[4], {'c': w[3].c + 5, 'a': w[3].a || 'I', 't': w[3].t || chr(10) || 'assistant:'},
    {'c': w[2].c + 10, 'a': w[2].a || 'II', 't': w[2].t || chr(10) || 'user:' || chr(10) || 'assistant:'}]) AS r FROM ways)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(r.c, 0) AS BIGINT) AS cost, coalesce(r.a, '') AS audit, sha256(coalesce(substr(r.t, 2), '')) AS repaired_sha256, coalesce(n_rows, 0) AS n_rows
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN best ON ids.conv_id IS NOT DISTINCT FROM best.conv_id"""


def brute_force(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired text) of one conversation's
    rows (turn, role, text) in order, by trying the cheapest edits of every prefix; for tests."""
    import re

    space = " \t\n\x0b\x0c\r"
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(space)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    # every way to edit a prefix, kept by the initials it gives that still matter: those of the last two and their number
    ways = {"": (0, "", ())}

    def more(ways):
        found = dict(ways)
        todo = list(ways.items())
        while todo:
            got, (cost, audit, out) = todo.pop()
            for role in ("user", "assistant"):
                new, value = got + role[0], (cost + 5, audit + "I", (*out, (role, "")))
                if re.fullmatch(r"s?(ua)*u?", new) and len(new) <= 2 * len(rows) + 4 and (new not in found or value[:2] < found[new][:2]):
                    found[new] = value
                    todo.append((new, value))
        return found

    for (_, role, text), fault in zip(rows, faults):
        now: dict = {}
        for got, (cost, audit, out) in more(ways).items():
            options = [(got, cost + 2, "D", out)]
            if fault not in ("blank", "duplicate"):
                cut = 5 * (fault == "truncated")
                options.append((got + role[:1] if role[:1] else "?", cost + cut, "K", (*out, (role, text))))
                options += [(got + r[0], cost + cut + 1, "R", (*out, (r, text))) for r in ("user", "assistant")]
            for new, c, e, o in options:
                if re.fullmatch(r"s?(ua)*u?", new) and (new not in now or (c, audit + e) < now[new][:2]):
                    now[new] = (c, audit + e, o)
        ways = now
    cost, audit, out = min((w for got, w in more(ways).items() if re.fullmatch(r"(s?(ua)+)?", got)), key=lambda w: w[:2])
    count = {f: faults.count(f) for f in ("blank", "duplicate", "truncated")}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
