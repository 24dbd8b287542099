"""Repair of conversations at least cost, by a grammar-compressed shortest-path search.

A conversation is well formed when its role initials are ``(s?(ua)+)?``. Its rows become one symbol each:
must go (blank or duplicate), or its role's class, whole or truncated.

1. **Sequences.** Rows are sorted by conversation and turn and streamed once; a conversation becomes a string of
   symbols and its counts. Equal strings are one sequence from here on, whatever the number of conversations.
2. **Grammar.** Re-Pair over all distinct sequences, weighted by their conversations: tasks count adjacent pairs,
   Spark adds the counts, the most frequent pairs become rules, and the next round counts over the rewritten
   sequences. Tasks rewrite from the stored sequences by the rules so far, so a round leaves nothing behind.
3. **Transfer matrices.** For each symbol, the cheapest edits from each state of the pattern to each other, as a
   min-plus matrix of (cost, audit). A rule's matrix is the product of its two sides', computed bottom-up once.
   Audits are ropes, so a rule shares those of its sides; ties go to the ASCII-least audit. For given rows and
   states, audits of one cost are never prefixes of one another (a longer one only adds inserts, which cost), so
   the least audit of a product is made of least audits.
4. **Evaluation.** Each distinct sequence is rewritten by the grammar, and its matrices are multiplied. Its cost
   and audit go back to its conversations by a join.
5. **Replay.** Audits and rows are sorted by conversation and turn and streamed: the repaired rows are hashed one
   after the other, none is gathered.

A task holds one conversation's symbols and audit (a byte a row each), never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.common import share, stage

#: Symbols: must go; system, user, assistant, other role - whole in small letters, truncated in capitals.
SYMBOLS = "xsSuUaAoO"
#: Costs of the edits, and of keeping a truncated row.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rounds of pair replacement and new rules of a round.
ROUNDS, RULES = 6, 32
#: States of the pattern: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Steps of the pattern by the class of the row.
STEPS = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
WHITE = " \t\n\x0b\x0c\r"
#: Ropes up to this length are plain strings.
LEAF = 64
#: Symbols whose matrices are multiplied as a balanced tree before they meet the rest of a sequence.
TREE = 256


class Rope:
    """A string made of two shared parts, or a short one of its own."""

    __slots__ = ("left", "length", "right", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        self.length = len(text) if text is not None else left.length + right.length

    def __add__(self, other: Rope) -> Rope:
        if not other.length:
            return self
        if not self.length:
            return other
        if self.text is not None and other.text is not None and self.length + other.length <= LEAF:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if node.text is not None:
                out.append(node.text)
            else:
                todo += [node.right, node.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b:
                continue
            if a.text is None and (b.text is not None or a.length >= b.length):
                mine += [a.right, a.left]
                theirs.append(b)
            elif b.text is None:
                theirs += [b.right, b.left]
                mine.append(a)
            else:
                n = min(a.length, b.length)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                if a.length > n:
                    mine.append(Rope(a.text[n:]))
                if b.length > n:
                    theirs.append(Rope(b.text[n:]))
        return bool(theirs)


#: ``matrix[i][j]``: the cheapest (cost, audit) from state i to state j, None if there is none.
Matrix = list[list[tuple[int, Rope] | None]]


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; ties go to the least audit."""
    out: Matrix = [[None] * len(b[0]) for _ in a]
    for row, made in zip(a, out):
        for m, first in enumerate(row):
            if first is None:
                continue
            for j, second in enumerate(b[m]):
                if second is None:
                    continue
                cost = first[0] + second[0]
                if made[j] is None or cost < made[j][0]:
                    made[j] = (cost, first[1] + second[1])
                elif cost == made[j][0]:
                    audit = first[1] + second[1]
                    if audit < made[j][1]:
                        made[j] = (cost, audit)
    return out


def inserts() -> Matrix:
    """Any number of inserted rows."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        out[i][i] = (0, Rope(""))
    step: Matrix = [row[:] for row in out]
    for role in "ua":
        for i, j in STEPS[role]:
            step[i][j] = (INSERT, Rope("I"))
    return times(step, step)  # two lead from any state to any that can be reached


def of_symbol(symbol: str) -> Matrix:
    """Inserts, then the cheapest edit of one row."""
    edit: Matrix = [[None] * 4 for _ in range(4)]

    def offer(i: int, j: int, cost: int, letter: str) -> None:
        if edit[i][j] is None or (cost, letter) < (edit[i][j][0], str(edit[i][j][1])):
            edit[i][j] = (cost, Rope(letter))

    for i in range(4):
        offer(i, i, DELETE, "D")
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        for i, j in STEPS.get(symbol.lower(), ()):
            offer(i, j, extra, "K")
        for role in "ua":
            for i, j in STEPS[role]:
                offer(i, j, REROLE + extra, "R")
    return times(inserts(), edit)


def rewrite(codes: np.ndarray, rules: list[tuple[int, int]]) -> np.ndarray:
    """``codes`` (sequences with -1 between them) with each rule's pairs replaced, rule after rule, left to right."""
    for i, (left, right) in enumerate(rules):
        at = np.flatnonzero((codes[:-1] == left) & (codes[1:] == right))
        if not at.size:
            continue
        if left == right:  # of a run of pairs that overlap, every other one counts
            run = np.cumsum(np.r_[True, np.diff(at) > 1])
            first = np.r_[0, np.flatnonzero(np.diff(run)) + 1]
            at = at[(np.arange(len(at)) - first[run - 1]) % 2 == 0]
        codes = codes.copy()
        codes[at] = len(SYMBOLS) + i
        codes = np.delete(codes, at + 1)
    return codes


def coded(sequences: pa.Array) -> np.ndarray:
    """Symbol numbers of all sequences in a row, -1 after each."""
    place = np.full(256, -1, dtype=np.int32)
    place[np.frombuffer(SYMBOLS.encode(), dtype=np.uint8)] = np.arange(len(SYMBOLS))
    text = "\n".join(sequences.to_pylist()) + "\n"
    return place[np.frombuffer(text.encode(), dtype=np.uint8)]


def learn_grammar(sequences: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> list[tuple[int, int]]:
    """Re-Pair rules from ``(seq, n)``: rule i writes symbol ``len(SYMBOLS) + i`` for a pair seen twice or more."""
    learnt: list[tuple[int, int]] = []
    for _ in range(rounds):
        held = share(sequences.sparkSession, (learnt[:], rewrite, coded))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, again, numbers = held()
            base = len(known) + 64
            counts = np.zeros(base * base, dtype=np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                codes = again(numbers(batch["seq"]), known)
                ends = codes == -1
                weight = np.asarray(batch["n"])[np.cumsum(ends) - ends]
                inside = ~ends[:-1] & ~ends[1:]
                counts += np.bincount((codes[:-1] * base + codes[1:])[inside], weights=weight[:-1][inside],
                                      minlength=base * base).astype(np.int64)
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"a": seen // base, "b": seen % base, "n": counts[seen]})

        top = (sequences.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
               .where("n > 1").orderBy(F.desc("n"), "a", "b").limit(rules).collect())
        if not top:
            break
        learnt += [(r["a"], r["b"]) for r in top]
    return learnt


class Repairer:
    """The matrices of all symbols and rules."""

    def __init__(self, rules: list[tuple[int, int]]) -> None:
        self.rules = rules
        self.matrices = [of_symbol(c) for c in SYMBOLS]
        for left, right in rules:
            self.matrices.append(times(self.matrices[left], self.matrices[right]))
        self.after = inserts()

    def _tree(self, codes: list[int]) -> Matrix:
        level = [self.matrices[c] for c in codes]
        while len(level) > 1:
            level = [times(level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def solve(self, codes: list[int]) -> tuple[int, str]:
        """Cost and audit of a rewritten sequence."""
        row: Matrix = [[(0, Rope("")), None, None, None]]
        for lo in range(0, len(codes), TREE):
            row = times(row, self._tree(codes[lo:lo + TREE]))
        row = times(row, self.after)
        ends = [row[0][j] for j in (START, ASSISTANT) if row[0][j] is not None]
        cost, audit = min(ends, key=lambda e: (e[0], str(e[1])))
        return cost, str(audit)


def _solved(sequences: DataFrame, repairer: Repairer) -> DataFrame:
    """``(seq, cost, audit)`` of distinct sequences."""
    held = share(sequences.sparkSession, (repairer, rewrite, coded))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, again, numbers = held()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch["seq"].slice(lo, 1000)
                codes = again(numbers(part), own.rules)
                ends = np.flatnonzero(codes == -1)
                found = [own.solve(codes[a:b].tolist()) for a, b in zip(np.r_[0, ends[:-1] + 1], ends)]
                yield pa.RecordBatch.from_arrays([part, pa.array([f[0] for f in found], pa.int64()),
                                                  pa.array([f[1] for f in found], pa.string())], ["seq", "cost", "audit"])

    return sequences.select("seq").mapInArrow(run, "seq string, cost long, audit string")


def _starts(conv: pa.Array) -> np.ndarray:
    """Rows whose conversation is not that of the row before (the first row not counted)."""
    a, b = conv.slice(1), conv.slice(0, len(conv) - 1)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(a.is_null(), b.is_null()))
    return np.flatnonzero(~np.asarray(same)) + 1


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _sequences(rows: DataFrame) -> DataFrame:
    """``(conv, seq, gaps, blank, duplicate, truncated, illegal)`` from rows sorted by conversation and turn."""
    kind = dict(rows.dtypes)["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seq, turns, last, counts = None, None, None, None, None
        out: list[tuple] = []

        def close() -> tuple:
            least, most, distinct = turns
            gaps = most - least + 1 - distinct if distinct else 0
            return (conv, seq.decode(), gaps, *counts.tolist())

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["conv"]
            real = np.asarray(batch["real"])
            symbol = np.frombuffer("".join(batch["symbol"].to_pylist()).encode(), dtype=np.uint8)
            role = np.asarray(batch["role_class"])
            fault = np.asarray(batch["fault"])
            has_turn = np.asarray(batch["turn"].is_valid())
            turn = np.asarray(pc.fill_null(batch["turn"], 0))
            bounds = [0, *_starts(ids).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:]):
                who = ids[a].as_py()
                if a or seq is None or who != conv:
                    if seq is not None:
                        out.append(close())
                    conv, seq, turns, last, counts = who, bytearray(), (0, 0, 0), -1, np.zeros(4, dtype=np.int64)
                keep = real[a:b]
                seq += symbol[a:b][keep].tobytes()
                counts[:3] += np.bincount(fault[a:b][keep], minlength=4)[1:4]
                roles = np.r_[last, role[a:b][keep]]
                if len(roles) > 1:
                    pair = roles[:-1] * 4 + roles[1:]
                    # su, ua and au may stand side by side; before the first row there is nothing
                    counts[3] += int((~np.isin(pair, (1, 6, 9)) & (roles[:-1] >= 0)).sum())
                    last = roles[-1]
                seen = turn[a:b][keep & has_turn[a:b]]
                if len(seen):
                    least, most, distinct = turns
                    new = int((np.diff(seen) != 0).sum()) + (not distinct or int(seen[0]) != most)
                    turns = (least if distinct else int(seen[0]), int(seen[-1]), distinct + new)
            if len(out) >= 1000:
                yield made(out)
                out = []
        if seq is not None:
            out.append(close())
        if out:
            yield made(out)

    schema = f"conv {kind}, seq string, " + ", ".join(f"{c} long" for c in COUNTS)
    as_arrow = pa.schema([(n, {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string()) if n == "conv" else
                           pa.string() if n == "seq" else pa.int64()) for n in ("conv", "seq", *COUNTS)])

    def made(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), as_arrow)], schema=as_arrow)

    return rows.mapInArrow(run, schema)


def _replayed(rows: DataFrame) -> DataFrame:
    """``(conv, digest)``: rows sorted by conversation, the audit (``head``) first, edited and hashed as they pass."""
    kind = dict(rows.dtypes)["conv"]
    as_arrow = pa.schema([("conv", {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, line, odd, digest = None, None, 0, 0, False, None
        out: list[tuple] = []

        def role_now() -> str:
            return "user" if (line % 2 == 1) == odd else "assistant"

        def add(role: str, text: str) -> None:
            nonlocal line
            if line:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
            line += 1

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                add(role_now(), "")
                at += 1

        def close() -> None:
            insert()
            out.append((conv, digest.hexdigest()))

        for batch in batches:
            for who, head, role, text in zip(*(batch[c].to_pylist() for c in ("conv", "head", "role", "text"))):
                if head:
                    if audit is not None:
                        close()
                    conv, audit, at, line, digest = who, text, 0, 0, hashlib.sha256()
                    odd = (len(audit) - audit.count("D")) % 2 == 1
                    continue
                insert()
                edit, at = audit[at], at + 1
                if edit != "D":
                    add(role if edit == "K" else role_now(), text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), as_arrow)], schema=as_arrow)
                out = []
        if audit is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), as_arrow)], schema=as_arrow)

    return rows.mapInArrow(run, f"conv {kind}, digest string")


def repair(rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Per conversation ``(conv, seq, gaps, blank, duplicate, truncated, illegal, cost, audit, digest)``.

    Rows are taken by turn, NULL turns first; rows of one turn by role and then by the SHA-256 of their text, so
    that copies stand side by side. A row's first fault counts: blank (only white space), duplicate (role and
    text seen earlier), truncated (last visible character is not one of ``.!?``). Blank and duplicate rows must
    be deleted. Edits: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or assistant row 3;
    a truncated row that stays adds 3. ``audit`` has the initials of the cheapest edits that make the role
    initials ``(s?(ua)+)?``, ties to the ASCII-least; ``digest`` is the SHA-256 of the repaired ``role:text``
    lines. ``gaps`` counts turns missing between the least and the largest, ``illegal`` adjacent role initials
    other than su, ua and au.

    NULL roles and texts count as one space. A NULL conversation id is a conversation; ids that only ``ids``
    (one column) holds have no rows: zeros, an empty audit and the digest of an empty string. Conversation ids are
    whole numbers or text, turns whole numbers. Further columns are not looked at. Each conversation is streamed by
    one task in the order of its rows, as its digest needs.
    """
    base = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    base = base.withColumn("key", F.unhex(F.sha2("text", 256)))
    visible = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    small = base.select(
        "conv", "turn", "role", "key", F.lit(True).alias("real"), (visible == "").alias("is_blank"),
        (~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("is_cut"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("role_class"))
    if ids is not None:
        marks = ids.select(F.col(ids.columns[0]).alias("conv")).distinct()
        small = small.unionByName(marks.withColumn("real", F.lit(False)), allowMissingColumns=True)
    # one exchange, by conversation, serves the search for duplicates and the pass over the sorted rows
    copies = Window.partitionBy("conv", "role", "key").orderBy(F.col("turn").asc_nulls_first())
    copy = F.when(F.col("real"), F.row_number().over(copies)).otherwise(0)
    fault = F.when(~F.col("real"), 0).when(F.col("is_blank"), 1).when(F.col("copy") > 1, 2).when(F.col("is_cut"), 3).otherwise(0)
    symbol = F.when(F.col("fault").isin(1, 2), "x").otherwise(
        F.substring(F.lit("suaoSUAO"), F.col("role_class") + 1 + F.when(F.col("fault") == 3, 4).otherwise(0), F.lit(1)))
    ordered = (small.repartition("conv").withColumn("copy", copy).withColumn("fault", fault)
               .withColumn("symbol", F.when(F.col("real"), symbol).otherwise("x"))
               .withColumn("role_class", F.coalesce("role_class", F.lit(3)))
               .sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("real"), F.col("turn").asc_nulls_first(), "role", "key",
                                     "copy")
               .select("conv", "turn", "real", "symbol", "role_class", "fault"))
    found = stage(_sequences(ordered), "conversation-sequences")
    distinct = stage(found.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "distinct-sequences")
    solved = stage(_solved(distinct, Repairer(learn_grammar(distinct))), "solved-sequences")
    heads = stage(found.join(solved, "seq"), "conversation-audits")
    lines = heads.select("conv", F.lit(True).alias("head"), F.col("audit").alias("text")).unionByName(
        base.select("conv", F.lit(False).alias("head"), "turn", "role", "key", "text"), allowMissingColumns=True)
    lines = (lines.repartition("conv")
             .sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("head").desc(), F.col("turn").asc_nulls_first(), "role",
                                   "key").select("conv", "head", "role", "text"))
    digests = _replayed(lines).withColumnRenamed("conv", "_conv")
    return heads.join(digests, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` rows damaged by crc32 of ``conv_id:turn`` (NULL: one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user row.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    text = spaced("text")
    return (rows.select("conv_id", "turn", spaced("role").alias("role"), text.alias("text"), kind.alias("kind"))
            .where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))
