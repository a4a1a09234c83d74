"""Repair of conversation structure by depth-first branch and bound over edits.

A conversation is legal if the initials of its roles are ``(s?(ua)+)?``. Each turn is kept, given another role or deleted, and turns can be
inserted; the cheapest edits are wanted, and of those the least audit (the edits' initials in order).

The search keeps an explicit stack of prefixes. ``suffix_bounds`` gives for every turn and state the least cost of the rest (audits left
aside), so the first dive already follows a cheapest way, and every prefix whose cost and bound exceed the incumbent's is cut. Prefixes that
meet in a node (turns consumed, state) are compared in that node's dominance entry, and the worse in (cost, audit) goes. When the stack is
empty the incumbent is proved optimal.

Only a few numbers a turn travel to the search; texts are joined with the audits afterwards and stream past in order. A conversation of any
length takes some hundred bytes a turn in its task and never its texts. A digest over the whole repaired text is sequential by its nature, so one
task reads a conversation's texts; it holds one at a time.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
"""Cost of an edit; a truncated turn that is not deleted costs ``CUT_OFF`` more."""
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
"""What stands last. A conversation can end at the start or after an assistant."""
TO = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
"""Where a user or an assistant, whichever is due, leads."""
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, GONE, TRUNCATED = 0, 4, 8
"""A turn is one byte: the kind of its role plus what is wrong with it (``GONE``: blank or duplicate)."""
KEEPS = tuple({SYSTEM: {START: AFTER_SYSTEM}, USER: {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_ASSISTANT: AFTER_USER}, ASSISTANT: {AFTER_USER: AFTER_ASSISTANT}, OTHER: {}}[k] for k in range(4))
HEAD = 256
"""Characters of a text that travel with its numbers: they order turns of one number and role; texts alike in them stand by a hash."""
MEMO = 64
"""Conversations of up to this many turns are remembered by their bytes."""
FOUND = "_c string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


# The search ---------------------------------------------------------------------------------------


def choices(turn: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a turn in a state: initial, cost, next state."""
    out = [("D", DELETE, state)]
    if not turn & GONE:
        more = CUT_OFF if turn & TRUNCATED else 0
        kept = KEEPS[turn & 3].get(state)
        if kept is not None:
            out.append(("K", KEEP + more, kept))
        out.append(("R", REROLE + more, TO[state]))
    return out


CHOICES = {t: [choices(t, s) for s in range(4)] for t in range(12)}


def suffix_bounds(turns: bytes) -> list[array]:
    """For each state and each number of consumed turns the least cost of the rest, whatever its audit."""
    n = len(turns)
    h = [array("q", bytes(8 * (n + 1))) for _ in range(4)]
    for s, end in zip(range(4), (0, 2 * INSERT, INSERT, 0), strict=True):
        h[s][n] = end
    for i in range(n - 1, -1, -1):
        least = [min(c + h[to][i + 1] for _, c, to in options) for options in CHOICES[turns[i]]]
        one = [min(least[s], INSERT + least[TO[s]]) for s in range(4)]
        for s in range(4):
            h[s][i] = min(one[s], INSERT + one[TO[s]])
    return h


def earlier(a: tuple, b: tuple) -> bool:
    """Whether the edits of chain ``a`` come before those of ``b`` (neither is a beginning of the other)."""
    x = y = ""
    while a[2] > b[2]:
        x, a = a[1], a[0]
    while b[2] > a[2]:
        y, b = b[1], b[0]
    while a is not b:
        x, y, a, b = a[1], b[1], a[0], b[0]
    return x < y


def search(turns: bytes) -> tuple[int, str]:
    """Least cost and, of the audits of that cost, the least."""
    n, h = len(turns), suffix_bounds(turns)
    root = (None, "", 0)
    best_cost, best, agree = None, [], 0
    """Incumbent, and how many edits of the path at hand equal its first ones."""
    path: list[str] = []
    dominant: dict[int, tuple[int, tuple]] = {}
    stack = [(0, START, 0, root)]
    while stack:
        i, state, cost, chain = stack.pop()
        depth = chain[2]
        if depth:
            path[depth - 1 :] = chain[1]
            agree = min(agree, depth - 1)
            while agree < min(depth, len(best)) and path[agree] == best[agree]:
                agree += 1
        if best_cost is not None:
            bound = cost + h[state][i]
            if bound > best_cost:
                continue
            if bound == best_cost and agree < depth and (agree >= len(best) or path[agree] > best[agree]):
                continue
        node = 4 * i + state
        known = dominant.get(node)
        if known is not None and (known[0] < cost or (known[0] == cost and not earlier(chain, known[1]))):
            continue
        dominant[node] = (cost, chain)
        if i == n and state in (START, AFTER_ASSISTANT):
            best_cost, best, agree = cost, path[:depth], depth
            continue
        options = [(c + h[to][i + 1], e, i + 1, to, c) for e, c, to in CHOICES[turns[i]][state]] if i < n else []
        options.append((INSERT + h[TO[state]][i], "I", i, TO[state], INSERT))
        # the least bound, then the least initial, is taken next
        for rest, edit, j, to, c in sorted(options, reverse=True):
            if best_cost is None or cost + rest <= best_cost:
                stack.append((j, to, cost + c, (chain, edit, depth + 1)))
    return best_cost, "".join(best)


_remembered = lru_cache(maxsize=1 << 16)(search)


def repair(turns: bytes) -> tuple[int, str]:
    return _remembered(turns) if len(turns) <= MEMO else search(turns)


# Faults -------------------------------------------------------------------------------------------


def _ordered(rows: DataFrame) -> DataFrame:
    """Conversations whole and in order: by turn (nulls first), then role and text (see ``HEAD``); ``_side`` 0 stands before all turns."""
    order = ["_c", "_side", F.col("_turn").asc_nulls_first(), "_role", "_head", "_d1", "_d2"]
    return rows.repartition("_c").sortWithinPartitions(*order)


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The four columns under names of our own, apart from whatever else the table has; a null role or text is one space."""
    named = rows.select(
        F.col(f"`{conv}`").cast("string").alias("_c"), F.col(f"`{turn}`").cast("long").alias("_turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("_role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("_text"),
    )
    return named.withColumns({"_side": F.lit(1), "_head": F.left("_text", F.lit(HEAD)), "_d1": F.xxhash64("_role", "_text"), "_d2": F.xxhash64("_text", F.lit(1), "_role")})


def _fault() -> Column:
    """1 for a blank text, 2 for one whose last character other than white space ends no sentence, else 0."""
    body = F.rtrim(F.col("_text"), F.lit(BLANKS))
    return F.when(body == "", 1).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), 2).otherwise(0).cast("byte")


def _kind() -> Column:
    initial = F.left(F.col("_role"), F.lit(1))
    return F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER).cast("byte")


def _whole(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table, np.ndarray], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``work`` gets whole conversations, several at a time, and where each begins."""
    held: list[pa.Table] = []
    """Rows of the last conversation; a long one is not looked through again with every batch."""

    def done() -> pa.RecordBatch:
        t = pa.concat_tables(held)
        return work(t, _firsts(t))

    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        first = _firsts(part)
        if len(first) > 1:
            held.append(part.slice(0, first[-1]))
            yield done()
            held = [part.slice(first[-1])]
        elif held and held[-1].column("_c")[-1] != part.column("_c")[0]:
            yield done()
            held = [part]
        else:
            held.append(part)
    if held:
        yield done()


def _firsts(t: pa.Table) -> np.ndarray:
    codes = t.column("_c").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))


def judged(t: pa.Table, first: np.ndarray) -> pa.RecordBatch:
    """Counts and the proved repair of each conversation; rows of side 0 only name one."""
    n = len(first)
    conv = np.repeat(np.arange(n), np.diff(np.append(first, t.num_rows)))
    real = t.column("_side").to_numpy() == 1
    kind, fault, d1, d2 = (t.column(c).to_numpy()[real] for c in ("_kind", "_fault", "_d1", "_d2"))
    at = conv[real]
    # stable, so the first of equal turns is the earliest
    order = np.lexsort((d2, d1, at))
    again = np.zeros(len(at), bool)
    a, b = order[1:], order[:-1]
    again[a] = (at[a] == at[b]) & (d1[a] == d1[b]) & (d2[a] == d2[b])
    blank, duplicate = fault == 1, again & (fault != 1)
    truncated = (fault == 2) & ~duplicate
    x, y = kind[:-1], kind[1:]
    legal = ((x == SYSTEM) & (y == USER)) | ((x == USER) & (y == ASSISTANT)) | ((x == ASSISTANT) & (y == USER))
    illegal = (at[1:] == at[:-1]) & ~legal
    count = lambda of, flags: np.bincount(of[flags], minlength=n).astype(np.int64)
    turn = t.column("_turn")
    known = real & ~turn.is_null().to_numpy()
    turn, of = turn.filter(pa.array(known)).to_numpy(), conv[known]
    gaps = np.zeros(n, np.int64)
    if len(of):
        new = np.append(True, (of[1:] != of[:-1]) | (turn[1:] != turn[:-1]))
        edge = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        last = np.append(edge[1:], len(of)) - 1
        gaps[of[edge]] = turn[last] - turn[edge] + 1 - count(of, new)[of[edge]]
    code = (kind + np.where(blank | duplicate, GONE, np.where(truncated, TRUNCATED, FINE))).astype(np.uint8).tobytes()
    cut = np.searchsorted(at, np.arange(n + 1)).tolist()
    repairs = [repair(code[p:q]) for p, q in zip(cut[:-1], cut[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            t.column("_c").combine_chunks().take(pa.array(first)), pa.array(gaps), pa.array(count(at, blank)), pa.array(count(at, duplicate)), pa.array(count(at, truncated)),
            pa.array(count(at[1:], illegal)), pa.array([c for c, _ in repairs], pa.int64()), pa.array([a for _, a in repairs], pa.string()),
        ], ["_c", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
    )


def _found(turns: DataFrame, known: DataFrame | None) -> DataFrame:
    compact = turns.select("_c", "_side", "_turn", "_role", "_head", "_d1", "_d2", _kind().alias("_kind"), _fault().alias("_fault"))
    if known is not None:
        none = {"_side": F.lit(0), "_turn": F.lit(None).cast("long"), "_role": F.lit(""), "_head": F.lit(""), "_d1": F.lit(0).cast("long"), "_d2": F.lit(0).cast("long"), "_kind": F.lit(0).cast("byte"), "_fault": F.lit(0).cast("byte")}
        compact = compact.unionByName(known.select("_c").distinct().withColumns(none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _whole(batches, judged)

    return _ordered(compact).drop("_role", "_head").mapInArrow(run, FOUND)


def repairs(rows: DataFrame, known: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Turns are taken in order of ``turn`` (nulls first), those of one number by role and text (texts that share ``HEAD`` characters by a hash). A null role or text is one
    space; rows without a conversation are one conversation. The first fault of a turn counts: blank, duplicate (role and text stood before),
    truncated. ``known`` lists conversations to report even if they have no rows here: with zeros and an empty audit. Other columns are
    left out, whatever their names. An empty table gives an empty result.
    """
    named = known.select(F.col(f"`{conv}`").cast("string").alias("_c")) if known is not None else None
    kind = rows.schema[conv].dataType
    return _found(_turns(rows, conv, turn, role, text), named).withColumn("_c", F.col("_c").cast(kind)).withColumnRenamed("_c", conv)


# Applying the edits -------------------------------------------------------------------------------


def edited(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of every turn that the repaired conversation has."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(turns)
        if edit == "D":
            continue
        if edit == "K":
            state = KEEPS["sua".find(role[:1])][state]
        else:
            state = TO[state]
            role = "user" if state == AFTER_USER else "assistant"
        yield edit, role, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, str, Iterator[tuple[str, str]]]]:
    """Id, audit and the turns of each conversation, one after another as they stream past."""
    rows = (r for b in batches for lo in range(0, b.num_rows, 256) for r in zip(*(b.column(c).slice(lo, 256).to_pylist() for c in ("_side", "_c", "audit", "_role", "_text")), strict=True))
    held = next(rows, None)
    while held is not None:
        _, conv, audit, _, _ = held

        def turns() -> Iterator[tuple[str, str]]:
            nonlocal held
            while (held := next(rows, None)) is not None and held[0] == 1:
                yield held[3], held[4]

        own = turns()
        yield conv, audit, own
        for _ in own:
            pass


def _with_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's audit, then its turns in order."""
    heads = found.select("_c", F.lit(0).alias("_side"), F.lit(None).cast("long").alias("_turn"), F.lit("").alias("_role"), F.lit("").alias("_text"), F.lit("").alias("_head"), F.lit(0).cast("long").alias("_d1"), F.lit(0).cast("long").alias("_d2"), "audit")
    both = heads.unionByName(turns.withColumn("audit", F.lit(None).cast("string")))
    return _ordered(both).select("_side", "_c", "audit", "_role", "_text")


def repaired_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: ``conv, position, edit, role, text`` (``edit`` K, R or I; positions from 0); see ``repairs``."""
    turns = _turns(rows, conv, turn, role, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, audit, own in _conversations(batches):
            out = []
            for i, (e, r, t) in enumerate(edited(audit, own)):
                out.append((c, i, e, r, t))
                if len(out) == 256:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], ["_c", "position", "edit", "role", "text"])

    done = _with_audits(turns, _found(turns, None)).mapInArrow(run, "_c string, position bigint, edit string, role string, text string")
    return done.withColumn("_c", F.col("_c").cast(rows.schema[conv].dataType)).withColumnRenamed("_c", conv)


def repaired_digests(rows: DataFrame, known: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``repairs`` with ``repaired_sha256``, the SHA-256 of the repaired ``role:text`` lines; without turns that of the empty string."""
    turns = _turns(rows, conv, turn, role, text)
    named = known.select(F.col(f"`{conv}`").cast("string").alias("_c")) if known is not None else None
    found = _found(turns, named)
    # the counts travel with the audit, apart from the texts
    packed = found.select("_c", F.concat_ws(",", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit").alias("audit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for c, line, own in _conversations(batches):
            *counts, audit = line.split(",")
            digest, glue = hashlib.sha256(), b""
            for _, r, t in edited(audit, own):
                digest.update(glue + f"{r}:{t}".encode())
                glue = b"\n"
            out.append((c, *map(int, counts), audit, digest.hexdigest()))
            if len(out) == 1024:
                yield _digests(out)
                out = []
        if out:
            yield _digests(out)

    schema = FOUND + ", repaired_sha256 string"

    def _digests(out: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in schema.split(", ")]
        types = [pa.int64() if x.endswith("bigint") else pa.string() for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    done = _with_audits(turns, packed).mapInArrow(run, schema)
    return done.withColumn("_c", F.col("_c").cast(rows.schema[conv].dataType)).withColumnRenamed("_c", conv)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The four columns with faults put in by the CRC-32 of ``conv:turn`` (nulls are one space) modulo 20.

    0 drops the turn, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it the user's; the others stay.
    """
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv, turn)]
    code = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    out = rows.select(
        F.col(f"`{conv}`").alias(conv), F.col(f"`{turn}`").alias(turn), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("_r"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("_t"), code.alias("_code"),
    )
    out = out.where("_code <> 0").withColumn("_again", F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    new_role = F.when(F.col("_code") == 4, "user").otherwise(F.col("_r"))
    new_text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("_t", ".!?", "")).otherwise(F.col("_t"))
    return out.select(conv, turn, new_role.alias(role), new_text.alias(text))
