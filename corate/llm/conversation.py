"""Conversation structure repair by aligning the turns to an alternating grammar.

The roles of a sound conversation are ``(system? (user assistant)+)?``. Repairing keeps, re-roles, deletes
and inserts turns at least cost, where a blank turn and a repeated one must go and a truncated one costs
a little if it stays. The turns are aligned (Wagner-Fischer) to every feasible length of the alternating
role string, nearest length first; the cheapest repair so far bounds the lengths that are tried and the
diagonals that are filled (Ukkonen's band). Of equally cheap repairs the one whose backtraced audit comes
first by ASCII is taken.

A conversation of any length is aligned in pieces of at most ``PIECE`` turns. What a piece needs of its
predecessors is only the last role given (none, s, u or a), so a piece is aligned once for each of the four
and each role it may end with. Insertions stand before the turn they precede, so an audit of a piece ends
with one of its turns and no audit is the beginning of another: the cheapest chain of pieces, ties by the
pieces' audits in order, is the audit of the whole conversation. Turns that must go take no part in the
alignment: a deletion comes before an insertion in ASCII, so each stands where its turn stood.

Turns are sorted over all tasks by range, and pieces are dealt by conversation and place. Only two things
pass a task conversation by conversation: the 16 costs of each piece, and at the end the turns as a sorted
stream, of which the audit letters are kept but no texts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import table, write_stage

PIECE = 32                                   # turns aligned at once
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
_NEVER = 1 << 60
# States: the role given last. What must still be inserted at the end of a conversation in each.
_NONE, _S, _U, _A = range(4)
_CLOSING = ("", "II", "I", "")
_ROLE = {"u": "user", "a": "assistant"}
_SPACE = r"\x20\x09-\x0D"


def _after(state: int) -> str:
    """The role that must follow (in state none also ``s`` may)."""
    return "a" if state == _U else "u"


def _targets(state: int, roles: list[str], length: int):
    """The role strings of ``length`` that may follow ``state``; one with a leading ``s`` only if a turn has it."""
    for lead in ("", "s") if state == _NONE and length and "s" in roles else ("",):
        first = _after(_S if lead else state)
        pair = first + ("a" if first == "u" else "u")
        yield (lead + pair * length)[:length]


def _align(roles: list[str], extra: list[int], target: str, limit: int) -> tuple[int, str] | None:
    """Least cost and ASCII-least audit of turning ``roles`` into ``target``, None if it is above ``limit``.

    ``best[i][j]`` is the cost of turns i.. against target j.., filled from the end. A path over a diagonal
    outside of 0..m-n pays a deletion and an insertion for each step away, which gives the band."""
    n, m = len(roles), len(target)
    shift = m - n
    least = INSERT * shift if shift > 0 else -DELETE * shift
    if least > limit:
        return None
    wide = (limit - least) // (DELETE + INSERT)
    low, high = min(0, shift) - wide, max(0, shift) + wide
    best = [[_NEVER] * (m + 1) for _ in range(n + 1)]
    best[n][m] = 0                            # a piece ends with one of its turns: nothing is inserted after the last
    for i in range(n - 1, -1, -1):
        row, below, role, more = best[i], best[i + 1], roles[i], extra[i]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            cost = DELETE + below[j]
            if j < m:
                t = target[j]
                if t == role:
                    cost = min(cost, more + below[j + 1])
                elif t != "s":
                    cost = min(cost, REROLE + more + below[j + 1])
                if t != "s":
                    cost = min(cost, INSERT + row[j + 1])
            row[j] = cost
    if best[0][0] > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n:                              # the least letter that stays on a cheapest path: D, I, K, R
        here = best[i][j]
        if here == DELETE + best[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and here == INSERT + best[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if target[j] == roles[i] else "R")
            i, j = i + 1, j + 1
    return best[0][0], "".join(audit)


def align_piece(roles: list[str], extra: list[int], state: int) -> list[tuple[int, str] | None]:
    """For each state the piece may end in the least cost and the audit, beginning in ``state``."""
    n = len(roles)
    found: list[tuple[int, str] | None] = [None] * 4
    # Re-roling all turns, and one more edit where the length has the wrong parity, bounds both u and a.
    limit = [_NEVER, _NEVER] + [REROLE * n + sum(extra) + DELETE] * 2
    limit[state] = min(limit[state], DELETE * n)
    apart = 0
    while apart <= n or INSERT * apart <= max(limit[_U], limit[_A]):
        for length in {n - apart, n + apart} if apart <= n else {n + apart}:
            for target in _targets(state, roles, length):
                end = ("sua".index(target[-1]) + 1) if target else state
                got = _align(roles, extra, target, limit[end])
                if got and (found[end] is None or got < found[end]):
                    found[end], limit[end] = got, got[0]
        apart += 1
    return found


@lru_cache(20_000)
def _solved(roles: str, extra: str, state: int):
    return align_piece(list(roles), [int(x) for x in extra], state)


def _solve(batches):
    """For each piece the costs and audits of all pairs of states, and the order of the audits by ASCII."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            roles = "".join(t["role"] if t["role"] in ("s", "u", "a") else "-" for t in r["turns"])
            extra = "".join(str(t["extra"]) for t in r["turns"])
            costs, audits, order = [], [], []
            for state in range(4):
                got = _solved(roles, extra, state) if state == _NONE or not r["first"] else [None] * 4
                told = sorted(x[1] for x in got if x)
                costs += [x[0] if x else None for x in got]
                audits += [x[1] if x else None for x in got]
                order += [told.index(x[1]) if x else None for x in got]
            out.append({"_c": r["_c"], "piece": r["piece"], "costs": costs, "audits": audits, "order": order})
        yield pa.RecordBatch.from_pylist(out, schema=_SOLVED_ARROW)


_SOLVED = "_c string, piece long, costs array<long>, audits array<string>, order array<int>"
_SOLVED_ARROW = pa.schema([("_c", pa.string()), ("piece", pa.int64()), ("costs", pa.list_(pa.int64())),
                           ("audits", pa.list_(pa.string())), ("order", pa.list_(pa.int32()))])


def _chain(batches):
    """The state after each piece of a conversation, on the cheapest chain."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            rest = [INSERT * len(x) for x in _CLOSING]
            best = []
            for p in reversed(r["pieces"]):
                step, now = [0] * 4, [_NEVER] * 4
                for a in range(4):
                    ways = [(p["costs"][4 * a + b] + rest[b], p["order"][4 * a + b], b) for b in range(4) if p["costs"][4 * a + b] is not None]
                    if ways:
                        now[a], _, step[a] = min(ways)
                best.append(step)
                rest = now
            state, path = _NONE, []
            for step in reversed(best):
                state = step[state]
                path.append(state)
            out.append({"_c": r["_c"], "path": path})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("_c", pa.string()), ("path", pa.list_(pa.int32()))]))


def _steps(batches):
    """The edits of each conversation from its sorted records: ``(conversation, edit, turn, role, text, fault)``
    with edit None once at the beginning; role and text are those after the edit, also for a deleted turn."""
    conv, state, path, audit = None, _NONE, iter(()), iter(())

    def inserted(state):
        role = _after(state)
        return "sua".index(role) + 1, (conv, "I", None, _ROLE[role], "", None)

    def closing():
        now = state
        for _ in _CLOSING[state]:
            now, edit = inserted(now)
            yield edit

    for batch in batches:
        for r in batch.to_pylist():
            if r["_c"] != conv:
                if conv is not None:
                    yield from closing()
                conv, state, path, audit = r["_c"], _NONE, iter(()), iter(())
                yield conv, None, None, None, None, None
            if r["kind"] <= 0:
                path = iter(r["path"] or path)
            elif r["kind"] == 1:
                audit = iter(r["audits"][4 * state + next(path)])
            else:
                fault = r["fault"]
                if fault in ("blank", "duplicate"):
                    yield conv, "D", r["turn"], r["role"], r["text"], fault
                else:
                    edit = next(audit)
                    while edit == "I":
                        state, step = inserted(state)
                        yield step
                        edit = next(audit)
                    role = r["role"]
                    if edit != "D":
                        role = _ROLE[_after(state)] if edit == "R" else role
                        state = "sua".index(role[0]) + 1
                    yield conv, edit, r["turn"], (r["role"] if edit == "D" else role), r["text"], fault, r["role"]
                again = "blank" if fault == "blank" else "duplicate"
                for _ in range(r["times"] - 1):
                    yield conv, "D", r["turn"], r["role"], r["text"], again
    if conv is not None:
        yield from closing()


_EDIT = "_c string, step long, edit string, turn long, role string, text string, fault string"
_EDIT_ARROW = pa.schema([("_c", pa.string()), ("step", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                         ("role", pa.string()), ("text", pa.string()), ("fault", pa.string())])


def _edit_rows(batches):
    rows, size, step = [], 0, 0
    for e in _steps(batches):
        if e[1] is None:
            step = 0
            continue
        rows.append(dict(zip(_EDIT_ARROW.names, (e[0], step, *e[1:6]), strict=True)))
        step, size = step + 1, size + len(e[4])
        if len(rows) == 4096 or size > 1 << 22:
            yield pa.RecordBatch.from_pylist(rows, schema=_EDIT_ARROW)
            rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, schema=_EDIT_ARROW)


_AUDIT = ("_c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_AUDIT_ARROW = pa.schema([("_c", pa.string()), *[(x, pa.int64()) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                          ("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Audit:
    """Counts and digest of one conversation; the texts pass through."""

    def __init__(self, conv):
        self.conv, self.count, self.letters, self.cost, self.digest, self.some = conv, dict.fromkeys(("blank", "duplicate", "truncated"), 0), [], 0, hashlib.sha256(), False
        self.low = self.last = self.before = None
        self.turns = self.illegal = 0

    def add(self, edit, turn, role, text, fault, was):
        self.letters.append(edit)
        self.cost += {"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[edit]
        if edit != "D":
            self.digest.update(("\n" * self.some + f"{role}:{text}").encode())
            self.some = True
            self.cost += TRUNCATED * (fault == "truncated")
        if edit != "I":
            if fault:
                self.count[fault] += 1
            if turn is not None and turn != self.last:
                self.low = turn if self.low is None else self.low
                self.last, self.turns = turn, self.turns + 1
            self.illegal += self.before is not None and self.before + was[:1] not in ("su", "ua", "au")
            self.before = was[:1]

    def row(self):
        gaps = 0 if self.last is None else self.last - self.low + 1 - self.turns
        return {"_c": self.conv, "gaps": gaps, **self.count, "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.letters), "repaired_sha256": self.digest.hexdigest()}


def _audit_rows(batches):
    now, rows = None, []
    for e in _steps(batches):
        if e[1] is None:
            if now:
                rows.append(now.row())
            now = _Audit(e[0])
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist(rows, schema=_AUDIT_ARROW)
                rows = []
        else:
            now.add(*e[1:6], e[6] if len(e) > 6 else e[3])
    if now:
        rows.append(now.row())
    yield pa.RecordBatch.from_pylist(rows, schema=_AUDIT_ARROW)


def _records(conversations: DataFrame, ids: DataFrame | None, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """What ``_steps`` reads, conversation by conversation in order: the states of its pieces, then for each
    piece its audits and its turns."""
    name = F.coalesce(F.col(conv).cast("string"), F.lit(" ")).alias("_c")
    d = conversations.select(name, F.col(turn).cast("long").alias("turn"), *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(y) for x, y in ((role, "role"), (text, "text"))])
    # A turn listed many times is one row from here on.
    d = d.groupBy("_c", "turn", "role", "text").agg(F.count("*").alias("times"))
    d = d.repartitionByRange("_c", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 32)).sortWithinPartitions(
        "_c", F.col("turn").asc_nulls_first(), "role", "text")
    d = d.withColumn("blank", ~F.col("text").rlike(f"[^{_SPACE}]")).withColumn("cut", ~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z"))
    same = F.md5(F.concat_ws(":", "_c", F.length("role"), "role", "text"))
    rows = write_stage(d.withColumn("_same", same).withColumn("pos", F.monotonically_increasing_id()), "conv-rows")
    firsts = rows.filter("not blank").groupBy("_same").agg(F.min("pos").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    rows = rows.join(write_stage(firsts, "conv-firsts"), "_same", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("_first"), "duplicate").when(F.col("cut"), "truncated")
    rows = rows.withColumn("fault", fault)
    stays = rows.filter("fault is null or fault = 'truncated'").select(
        "_c", F.expr(f"pos div {PIECE}").alias("piece"), "pos", F.substring("role", 1, 1).alias("role"), F.when(F.col("fault").isNull(), 0).otherwise(TRUNCATED).alias("extra"))
    pieces = stays.groupBy("_c", "piece").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "extra"))).alias("turns"))  # at most PIECE
    pieces = pieces.withColumn("first", F.col("piece") == F.min("piece").over(Window.partitionBy("_c")))
    solved = write_stage(pieces.select("_c", "piece", "turns", "first").mapInArrow(_solve, _SOLVED), "conv-pieces")
    paths = solved.groupBy("_c").agg(F.array_sort(F.collect_list(F.struct("piece", "costs", "order"))).alias("pieces")).mapInArrow(_chain, "_c string, path array<int>")
    none = {"pos": "long", "kind": "int", "path": "array<int>", "audits": "array<string>", "turn": "long", "role": "string", "text": "string", "times": "long", "fault": "string"}

    def records(df: DataFrame, **cols) -> DataFrame:
        return df.select("_c", *[cols.get(k, F.lit(None)).cast(t).alias(k) for k, t in none.items()])

    out = records(paths, pos=F.lit(-1), kind=F.lit(0), path=F.col("path"))
    # Pieces begin at a multiple of PIECE; the turns of a conversation that come before its own are not in its first piece.
    out = out.unionByName(records(solved, pos=F.col("piece") * PIECE, kind=F.lit(1), audits=F.col("audits")))
    out = out.unionByName(records(rows, pos=F.col("pos"), kind=F.lit(2), **{c: F.col(c) for c in ("turn", "role", "text", "times", "fault")}))
    if ids is not None:
        out = out.unionByName(records(ids.select(name).distinct(), pos=F.lit(-2), kind=F.lit(-1)))
    return out.repartition("_c").sortWithinPartitions("_c", "pos", "kind")


def _named(df: DataFrame, source: DataFrame, conv: str) -> DataFrame:
    """The conversation's name back in its own type (null again where it was null)."""
    back = F.when(F.col("_c") != " ", F.col("_c")).cast(source.schema[conv].dataType).alias(conv)
    return df.select(back, *[c for c in df.columns if c != "_c"])


def repair(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits that repair each conversation, in order: ``(conv_id, step, edit, turn, role, text, fault)``.

    ``edit`` is K (kept), R (other role), I (inserted, empty text, turn null) or D (deleted: role and text as
    they were). The repaired conversation is its rows without D. ``fault`` is the first of blank, duplicate
    (role and text seen earlier in the conversation) and truncated (last character not ``.!?``) that holds.

    Turns are taken in order of ``turn`` (nulls first), then role, then text. Null roles and texts are one
    space; a null conversation id is a conversation of its own. Rows listed twice are duplicates that stand
    side by side. Texts may be empty (blank) or of any length. Other columns are ignored; an empty table gives no rows."""
    rows = _records(conversations, None, conv, turn, role, text)
    return _named(rows.mapInArrow(_edit_rows, _EDIT), conversations, conv)


def audit(conversations: DataFrame, ids: DataFrame | None = None, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``gaps`` (turn numbers missing), the rows by fault, ``illegal`` (neighbours whose
    roles may not follow each other), ``cost`` and ``audit`` of the repair, and the SHA-256 of the repaired
    ``role:text`` lines. ``ids`` names conversations that are to be listed even without rows.
    Special cases as in ``repair``."""
    rows = _records(conversations, ids, conv, turn, role, text)
    return _named(rows.mapInArrow(_audit_rows, _AUDIT), conversations, conv)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn`` modulo 20: dropped (0), emptied (1), without
    punctuation (2), listed twice (3), given to the user (4). Nulls count as one space."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"),
                             (F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20).alias("_how")).filter("_how <> 0")
    d = d.withColumn("text", F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    d = d.withColumn("role", F.when(F.col("_how") == 4, "user").otherwise(F.col("role")))
    return d.withColumn("_again", F.explode(F.when(F.col("_how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_how", "_again")


def q_op11(spark, sf_dir):
    """All conversations, damaged and repaired."""
    c = table(spark, sf_dir, "conversations")
    return audit(damage(c), c.select("conv_id"))
