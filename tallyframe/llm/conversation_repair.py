"""Structure repair of conversations: faults of their turns, the cheapest edits that give a legal sequence, and the edited turns.

Turns are read in order of turn, then role, then the SHA-256 of role and text. A turn's first fault counts: blank, duplicate (role and text of an earlier
turn), truncated (does not end like a sentence). A legal sequence of role initials is `(s?(ua)+)?`. Edits: Keep 0, Rerole to user or
assistant 1, Delete 2, Insert an empty turn 5; blank and duplicate turns must go, a truncated turn that stays adds 5. Of the cheapest
audits (the edits' initials, in order) the first in ASCII order is taken.

Each turn is one letter of its conversation's signature. Distinct signatures, in blocks of BLOCK turns, are solved once, by memoised
recursion on their halves: for each state of the sequence before and after, the cheapest audit. Halves, and the blocks of long
conversations, are joined by their states; ties stay right since no audit of equal cost begins another. Signatures that are a large part of
all blocks are few by count and broadcast, the others meet their solutions by shuffle. Audits then go through the sorted turns once.

A conversation's turns are never held together: signatures are cut into blocks, counts are combined before they are shuffled, turns are
numbered by ranges. Only the audit, the result's own cell, grows with a conversation, and the edited text passes through one task
for each conversation in a stream, since one SHA-256 is taken of all of it.

Defined cases: null role or text is one space; a null conversation is one of its own; null turns come first; ties and repeated rows as
above; texts of any length count whole; an empty table gives no rows; extra columns take no part, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.llm.common import discard, materialize, numbered

#: Turns of a block: its signature is solved by itself.
BLOCK = 4_096
#: Signatures that more than this share of all blocks have, fewer than 1 / HOT by count, are broadcast.
HOT = 1 / 200
BLANKS = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
# states: nothing yet; after the system's turn; after a user's; after an assistant's
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: What is inserted or reroled to in each state, and the state that follows.
_DUE = {_START: ("user", _USER), _SYSTEM: ("user", _USER), _USER: ("assistant", _ASSISTANT), _ASSISTANT: ("user", _USER)}

Plans = dict[tuple[int, int], tuple[int, str]]


def damaged(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) with faults by a hash of conversation and turn: dropped, emptied, without sentence ends, repeated, reroled."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
    role = F.when(kind == 4, "user").otherwise(told("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind")).where("_kind <> 0")
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_kind", "_copy")


def _step(letter: str) -> Plans:
    """The plans of one turn: inserts before it, then the edit. d: must go; s, u, a, x: role; upper case: truncated."""
    out: Plans = {}
    for entry in range(4):
        state, cost, audit = entry, 0, ""
        for _ in range(3):  # three inserts come back to a state that one reaches
            ways = [(state, DELETE, "D")]
            if letter != "d":
                more, role = (CUT if letter.isupper() else 0), letter.lower()
                due, after = _DUE[state]
                ways.append((after, REROLE + more, "R"))
                if role == due[0]:
                    ways.append((after, KEEP + more, "K"))
                if role == "s" and state == _START:
                    ways.append((_SYSTEM, KEEP + more, "K"))
            for leaves, price, edit in ways:
                plan = (cost + price, audit + edit)
                if (entry, leaves) not in out or plan < out[entry, leaves]:
                    out[entry, leaves] = plan
            state, cost, audit = _DUE[state][1], cost + INSERT, audit + "I"
    return out


def joined(first: Plans, then: Plans) -> Plans:
    """The plans of two stretches one after the other."""
    out: Plans = {}
    for (entry, via), (cost, audit) in first.items():
        for (came, leaves), (more, rest) in then.items():
            if came == via:
                plan = (cost + more, audit + rest)
                if (entry, leaves) not in out or plan < out[entry, leaves]:
                    out[entry, leaves] = plan
    return out


def _solve(signature: str) -> Plans:
    if len(signature) == 1:
        return _step(signature)
    half = len(signature) // 2
    return joined(_solved(signature[:half]), _solved(signature[half:]))


_short = functools.lru_cache(20_000)(_solve)


def _solved(signature: str) -> Plans:
    """Memoised where signatures are short and recur."""
    return _short(signature) if len(signature) <= 64 else _solve(signature)


def finished(plans: Plans) -> tuple[int, str]:
    """The cheapest whole plan: from the start to a legal end, inserts at the end included."""
    ends = {_START: 0, _ASSISTANT: 0, _USER: 1, _SYSTEM: 2}
    return min((cost + INSERT * ends[leaves], audit + "I" * ends[leaves]) for (entry, leaves), (cost, audit) in plans.items() if entry == _START)


def _solve_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        solved = [_solved(s) for s in f["sig"]]
        whole = [finished(p) for p in solved]
        plans = [[{"entry": e, "leaves": x, "cost": c, "audit": a} for (e, x), (c, a) in p.items()] for p in solved]
        yield pd.DataFrame({"sig": f["sig"], "n": f["n"], "cost": [c for c, _ in whole], "audit": [a for _, a in whole], "plans": plans})


def _fold(f: pd.DataFrame) -> pd.DataFrame:
    """The blocks of one long conversation, joined in order."""
    total: Plans | None = None
    for plans in f.sort_values("block")["plans"]:
        here = {(p["entry"], p["leaves"]): (p["cost"], p["audit"]) for p in plans}
        if total is None:
            total = {k: v for k, v in here.items() if k[0] == _START}
        else:
            total = joined(total, here)
    cost, audit = finished(total)
    return pd.DataFrame({"conv": [f["conv"].iloc[0]], "cost": [cost], "audit": [audit]})


class Repair:
    """The repair of turns(conv_col, turn_col, role_col, text_col). conv below is '' for null, else '=' and the id."""

    def __init__(self, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        told = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
        rows = turns.select(self.key(conv_col).alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), told(role_col).alias("role"), told(text_col).alias("text"))
        self.rows = rows.withColumn("digest", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
        ends = F.rtrim("text", F.lit(BLANKS))
        initial = F.substring("role", 1, 1)
        light = self.rows.select(
            "conv", "turn", "digest", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("init"), F.col("role"),
            (ends == "").alias("blank"), (~F.right(ends, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        )
        placed = numbered(light, "conv", [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()], "repair-turns")
        several = placed.groupBy("conv", "digest").agg(F.min("_place").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
        seen = placed.join(several, ["conv", "digest"], "left").withColumn("again", F.coalesce(F.col("_place") > F.col("_first"), F.lit(False)))
        fault = F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("cut"), "truncated")
        letter = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper("init")).otherwise(F.col("init"))
        self.turns = materialize(seen.withColumn("fault", fault).select("conv", "turn", "_place", "_size", "init", "fault", letter.alias("letter")), "repair-faults")
        discard(placed)
        self.blocks = self._blocks()
        self.audits = self._audits()

    @staticmethod
    def key(conv_col: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(f"`{conv_col}`").cast("string")), F.lit(""))

    def _blocks(self) -> DataFrame:
        """(conv, block, n_blocks, sig, illegal): signatures, and pairs of neighbours that no legal sequence has."""
        block = F.floor(F.col("_place") / BLOCK).cast("long")
        n_blocks = F.ceil(F.max("_size") / BLOCK).cast("long")
        cut = self.turns.groupBy("conv", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("_place", "letter", "init"))).alias("t"), n_blocks.alias("n_blocks"))
        cut = cut.select("conv", "block", "n_blocks", F.array_join("t.letter", "").alias("sig"), F.col("t.init").alias("init"))
        legal = lambda a, b: F.concat(a, b).isin("su", "ua", "au")
        n = F.size("init") - 1
        within = F.zip_with(F.slice("init", F.lit(1), n), F.slice("init", F.lit(2), n), lambda a, b: ~legal(a, b))
        before = F.lag(F.element_at("init", -1)).over(W.partitionBy("conv").orderBy("block"))  # a row for each block
        across = F.when(before.isNotNull() & ~legal(before, F.element_at("init", 1)), 1).otherwise(0)
        return materialize(cut.select("conv", "block", "n_blocks", "sig", (F.size(F.filter(within, lambda x: x)) + across).cast("long").alias("illegal")), "repair-blocks")

    def _audits(self) -> DataFrame:
        """(conv, cost, audit)."""
        kinds = self.blocks.groupBy("sig").agg(F.count("*").alias("n"))
        schema = "sig string, n long, cost long, audit string, plans array<struct<entry int, leaves int, cost long, audit string>>"
        solved = materialize(kinds.mapInPandas(_solve_all, schema), "repair-plans")
        total = self.blocks.count()
        hot, cold = solved.where(F.col("n") > total * HOT), solved.where(F.col("n") <= total * HOT)
        many = self.blocks.join(F.broadcast(hot), "sig")
        few = self.blocks.join(F.broadcast(hot.select("sig")), "sig", "left_anti").join(cold, "sig")
        met = many.unionByName(few)
        long = met.where("n_blocks > 1").select("conv", "block", "plans").groupBy("conv").applyInPandas(_fold, "conv string, cost long, audit string")
        return materialize(met.where("n_blocks = 1").select("conv", "cost", "audit").unionByName(long), "repair-audits")

    def _edited(self, emit, schema: str) -> DataFrame:
        """emit(conv, role, text) over the edited turns of each conversation, in order."""
        rows = self.rows.select("conv", "turn", "role", "text", "digest", F.lit(None).cast("string").alias("audit"))
        heads = self.audits.select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit("").alias("digest"), "audit")
        by = [F.col("conv"), F.col("audit").asc_nulls_last(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
        stream = rows.unionByName(heads).repartition("conv").sortWithinPartitions(*by).select("conv", "audit", "role", "text")
        return stream.mapInPandas(lambda frames: emit(_replay(frames)), schema)

    def edited(self) -> DataFrame:
        """(conv, place, role, text): the turns of the repaired conversations."""
        return self._edited(_as_rows, "conv string, place long, role string, text string")

    def digests(self) -> DataFrame:
        """(conv, repaired_sha256): of `role:text`, one for each turn, joined by newlines."""
        return self._edited(_as_digests, "conv string, repaired_sha256 string")

    def faults(self) -> DataFrame:
        """(conv, gaps, blank, duplicate, truncated, illegal)."""
        kinds = ("blank", "duplicate", "truncated")
        per_turn = self.turns.groupBy("conv", "turn").agg(*(F.count_if(F.col("fault") == k).alias(k) for k in kinds))
        span = F.max("turn").cast("decimal(20,0)") - F.min("turn").cast("decimal(20,0)") + 1 - F.count("turn")
        counted = per_turn.groupBy("conv").agg(F.coalesce(span, F.lit(0)).try_cast("long").alias("gaps"), *(F.sum(k).alias(k) for k in kinds))
        return counted.join(self.blocks.groupBy("conv").agg(F.sum("illegal").alias("illegal")), "conv")


def _replay(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, str | None, str | None]]:
    """(conv, role, text) of each edited turn, and (conv, None, None) at a conversation's end."""
    conv, audit, at, state = None, "", 0, _START

    def inserts() -> Iterator[tuple[str, str, str]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role, state = _DUE[state]
            at += 1
            yield conv, role, ""

    for f in frames:
        for c, plan, role, text in zip(f["conv"], f["audit"], f["role"], f["text"], strict=True):
            if plan is not None:
                if conv is not None:
                    yield from inserts()
                    yield conv, None, None
                conv, audit, at, state = c, plan, 0, _START
                continue
            yield from inserts()
            edit = audit[at]
            at += 1
            if edit == "K":
                state = _SYSTEM if role.startswith("s") else _DUE[state][1]
                yield conv, role, text
            elif edit == "R":
                role, state = _DUE[state]
                yield conv, role, text
    if conv is not None:
        yield from inserts()
        yield conv, None, None


def _as_rows(turns: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    out, place, held = [], 0, 0
    for conv, role, text in turns:
        if role is None:
            place = 0
            continue
        out.append((conv, place, role, text))
        place, held = place + 1, held + len(text)
        if held > 1 << 22 or len(out) >= 10_000:
            yield pd.DataFrame(out, columns=["conv", "place", "role", "text"])
            out, held = [], 0
    yield pd.DataFrame(out, columns=["conv", "place", "role", "text"])


def _as_digests(turns: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    out, state, first = [], hashlib.sha256(), True
    for conv, role, text in turns:
        if role is None:
            out.append((conv, state.hexdigest()))
            state, first = hashlib.sha256(), True
        else:
            state.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
        if len(out) >= 10_000:
            yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
            out = []
    yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])


def audited(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation that has a turn."""
    repair = Repair(turns, **columns)
    return repair.faults().join(repair.audits, "conv").join(repair.digests(), "conv")
