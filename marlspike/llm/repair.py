"""Conversation structure repair by dynamic programming over a grammar.

A conversation's rows, in order of turn, are symbols: the initial of the role (s, u, a,
none, any other) with the row's first fault, which is blank (nothing but blanks),
duplicate (role and text seen earlier) or truncated (the last character that is no blank
is none of . ! ?). An edit script keeps, reroles or deletes each row and inserts empty
turns, so that the initials read `(s?(ua)+)?`. The cheapest script is wanted, of several
the one whose audit, the initials of its edits, is least in ASCII order.

The automaton of that pattern has four states. A symbol is a 4 x 4 min-plus matrix: for
each state before and after it the least cost and its audit, inserts before the row
included. A stretch of rows is the product of its symbols. Every audit of a stretch ends
with the letter of its last row, so none of two audits of one stretch is the beginning of
the other and the least audit of a whole is made of least audits of its parts.

Re-Pair builds a grammar over all sequences: in each round Spark counts the adjacent pairs
of symbols, weighted by how often a sequence occurs, and the most frequent pairs that share
no symbol become rules (their number is bounded, so what the driver gets is too). Each
rule's matrix is the product of its two sides, bottom-up, with audits as ropes that share
the sides' ropes. The grammar is broadcast (RULES rules of at most CHUNK rows each); a task
rewrites its sequences by it and multiplies what is left, a matrix for each rule instead
of one for each row, whatever conversation it stands in.

A long conversation is dealt out by ranges of its rows into chunks of at most CHUNK rows,
whose matrices are found in different tasks; equal rows are counted before. Per
conversation a state vector then runs over its chunks' matrices. Its audit is one value, so
it is bounded by the size of a value. The repaired lines stream through their digest in
order, row by row; a digest is sequential, so that pass reads one conversation in one task,
in constant memory beside the audit. No pass holds a conversation's texts.

Defined results: null ids, turns, roles and texts: a null id is a conversation, a null turn
comes first and is ignored for gaps, a null role or text is one space (so is a null id or
turn in the hash that decides the damage). Rows of one turn are ordered by role, then by
the SHA-256 of their text. Rows that repeat all values are duplicates of the first. A role
without characters has no initial, so keeping such a row changes nothing. A conversation
without rows after the damage has zeros, an empty audit and the digest of nothing. A table
without rows gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.session import materialize

BLANKS = r"\x20\x09-\x0D"
ROLES = ["s", "u", "a", "", "other"]
FAULTS = ["", "blank", "duplicate", "truncated"]
TERMINALS = "ABCDEFGHIJKLMNOPQRST"  # ROLES by FAULTS
FIRST_RULE = 0x100
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
STATES = 4  # nothing yet, after s, after u, after a
CHUNK = 4096
RULES, ROUNDS = 192, 12

Rope = str | tuple
Matrix = list  # [state before][state after]: (cost, rope) or None


def leaves(rope: Rope):
    waiting = [rope]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            if part:
                yield part
        else:
            waiting += (part[1], part[0])


def text_of(rope: Rope) -> str:
    return "".join(leaves(rope))


def before(one: Rope, two: Rope) -> bool:
    """Whether the first rope's text is smaller, compared leaf by leaf."""
    while isinstance(one, tuple) and isinstance(two, tuple) and one[0] is two[0]:
        one, two = one[1], two[1]
    if one is two:
        return False
    a, b = leaves(one), leaves(two)
    x, y = next(a, ""), next(b, "")
    while x and y:
        size = min(len(x), len(y))
        if x[:size] != y[:size]:
            return x[:size] < y[:size]
        x, y = x[size:] or next(a, ""), y[size:] or next(b, "")
    return not x and bool(y)


def better(new: tuple, old: tuple | None) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and before(new[1], old[1])


def product(one: Matrix, two: Matrix) -> Matrix:
    out = [[None] * STATES for _ in one]
    for row, first in zip(out, one):
        for k, a in enumerate(first):
            if a is None:
                continue
            for j, b in enumerate(two[k]):
                if b is not None:
                    new = (a[0] + b[0], (a[1], b[1]) if a[1] and b[1] else a[1] or b[1])
                    if better(new, row[j]):
                        row[j] = new
    return out


def folded(parts: list[Matrix]) -> Matrix:
    """The product of a list that is not empty, halves first."""
    while len(parts) > 1:
        parts = [product(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def kept_state(state: int, initial: str) -> int | None:
    """The state after a row with this initial; None if the pattern does not allow it."""
    return {"": state, "s": 1 if state == 0 else None, "u": 2 if state != 2 else None, "a": 3 if state == 2 else None}.get(initial)


def turned_state(state: int) -> int:
    """The state after a user or assistant turn, whichever the pattern allows."""
    return 3 if state == 2 else 2


def inserts() -> Matrix:
    """The inserts that lead from one state to another, if any do."""
    out = [[None] * STATES for _ in range(STATES)]
    for start in range(STATES):
        state, count = start, 0
        while out[start][state] is None:
            out[start][state] = (INSERT * count, "I" * count)
            state, count = turned_state(state), count + 1
    return out


def terminal(role: str, fault: str) -> Matrix:
    out = [[None] * STATES for _ in range(STATES)]
    extra = TRUNCATED if fault == "truncated" else 0
    for state in range(STATES):
        edits = [(DELETE, "D", state)]
        if fault not in ("blank", "duplicate"):
            edits.append((REROLE + extra, "R", turned_state(state)))
            kept = kept_state(state, role)
            if kept is not None:
                edits.append((KEEP + extra, "K", kept))
        for cost, letter, after in edits:
            if better((cost, letter), out[state][after]):
                out[state][after] = (cost, letter)
    return product(inserts(), out)


@dataclass(frozen=True)
class Grammar:
    """rules: (pair of symbols, new symbol) in the order they are applied."""

    rules: tuple[tuple[str, str], ...] = ()

    def sizes(self) -> dict[str, int]:
        sizes = dict.fromkeys(TERMINALS, 1)
        for pair, symbol in self.rules:
            sizes[symbol] = sizes[pair[0]] + sizes[pair[1]]
        return sizes

    def rewrite(self, symbols: str) -> str:
        for pair, symbol in self.rules:
            symbols = symbols.replace(pair, symbol)
        return symbols

    def matrices(self) -> dict[str, Matrix]:
        kinds = [(r, f) for r in ROLES for f in FAULTS]
        found = {x: terminal(*kind) for x, kind in zip(TERMINALS, kinds)}
        for pair, symbol in self.rules:
            found[symbol] = product(found[pair[0]], found[pair[1]])
        return found

    def extended(self, pairs: list[tuple[str, int]], most: int, longest: int) -> "Grammar":
        """With rules for the most frequent of the pairs (pair, count), none of which shares
        a symbol with a more frequent one of this round, so that their counts hold."""
        sizes, taken, rules = self.sizes(), set(), list(self.rules)
        for pair, count in sorted(pairs, key=lambda x: (-x[1], x[0])):
            if len(rules) >= most:
                break
            if count > 1 and not taken & set(pair) and sizes[pair[0]] + sizes[pair[1]] <= longest:
                taken |= set(pair)
                rules.append((pair, chr(FIRST_RULE + len(rules))))
        return Grammar(tuple(rules))


def build_grammar(sequences: DataFrame, most: int = RULES, rounds: int = ROUNDS, longest: int = CHUNK) -> Grammar:
    """Re-Pair over written sequences (symbols, n): a round counts all adjacent pairs."""
    grammar = Grammar()

    def count(grammar):
        def run(batches):
            for batch in batches:
                found = Counter()
                for symbols, n in zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist()):
                    own = grammar.rewrite(symbols)
                    for pair in zip(own, own[1:]):
                        found["".join(pair)] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pair", "n"]
                )

        return run

    for _ in range(rounds):
        pairs = sequences.mapInArrow(count(grammar), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        # at most (20 + RULES) ** 2 pairs
        wider = grammar.extended([(r.pair, r.n) for r in pairs.collect()], most, longest)
        if wider == grammar:
            break
        grammar = wider
    return grammar


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) of conversations (conv_id, turn, role, text): by a
    hash of id and turn one row in twenty is dropped, emptied, loses its sentence ends,
    stands twice or becomes the user's."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(F.col("conv_id")), F.lit(":"), space(F.col("turn"))).cast("binary")) % 20
    text = space(F.col("text"))
    return conversations.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.when(kind == 4, "user").otherwise(space(F.col("role"))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
        kind.alias("kind"),
    ).filter("kind <> 0").drop("kind")


def symbol(role: Column, fault: Column) -> Column:
    initial = F.substring(role, 1, 1)
    place = F.when(initial == "", ROLES.index("")).otherwise(ROLES.index("other"))
    for i, known in enumerate("sua"):
        place = F.when(initial == known, i).otherwise(place)
    return F.substring(F.lit(TERMINALS), (place * len(FAULTS) + fault + 1).cast("int"), F.lit(1))


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, first, rest, copies): each distinct row of rows (conv,
    turn, role, text, copies) with the symbols of its first copy and of the others."""
    text = F.col("text")
    slim = rows.select(
        "conv", "turn", "role", "copies", digest().alias("digest"),
        (~text.rlike(f"[^{BLANKS}]")).alias("blank"),
        (~text.rlike(rf"[.!?][{BLANKS}]*\z")).alias("open"),
    )
    own = slim.groupBy("conv", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("open").alias("open")
    )
    first = own.groupBy("conv", "role", "digest").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("early")
    )
    a, b = own.alias("a"), first.alias("b")
    same = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.role") == F.col("b.role"))
    met = a.join(b, same & (F.col("a.digest") == F.col("b.digest")))
    seen = F.col("a.turn").isNotNull() & (F.col("b.early") | (F.col("a.turn") > F.col("b.least")))
    fault = F.when(F.col("a.blank"), 1).when(seen, 2).when(F.col("a.open"), 3).otherwise(0)
    rest = F.when(F.col("a.blank"), 1).otherwise(2)
    return met.select(
        "a.conv", "a.turn", "a.role", "a.digest",
        symbol(F.col("a.role"), fault).alias("first"), symbol(F.col("a.role"), rest).alias("rest"), "a.copies",
    )


def _chunks(longest: int):
    """Ordered rows to (conv, part, run, symbols): chunks of a conversation, `part` and `run`
    in the order of its rows."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        conv, held, size = None, [], 0
        out = {"conv": [], "run": [], "symbols": []}

        def close():
            nonlocal held, size, number
            if size:
                out["conv"].append(conv)
                out["run"].append(number)
                out["symbols"].append("".join(held))
                number += 1
            held, size = [], 0

        def batch_of(kind):
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(out["conv"], kind), pa.array([part] * len(out["run"]), pa.int32()),
                    pa.array(out["run"], pa.int64()), pa.array(out["symbols"], pa.string()),
                ],
                ["conv", "part", "run", "symbols"],
            )
            for values in out.values():
                values.clear()
            return made

        kind = None
        for batch in batches:
            kind = batch.schema.field("conv").type
            columns = [batch.column(x).to_pylist() for x in ("conv", "first", "rest", "copies")]
            for own, first, rest, copies in zip(*columns):
                if own != conv:
                    close()
                    conv = own
                held.append(first)
                size, left = size + 1, copies - 1
                while left or size >= longest:
                    take = min(left, longest - size)
                    held.append(rest * take)
                    size, left = size + take, left - take
                    if size >= longest:
                        close()
            yield batch_of(kind)
        close()
        if out["conv"]:
            yield batch_of(kind)

    return run


def facts(symbols: str) -> tuple[int, int, int, int]:
    """Numbers of blank, duplicate, truncated rows and illegal neighbours of a sequence."""
    place = [TERMINALS.index(x) for x in symbols]
    count = Counter(p % len(FAULTS) for p in place)
    initials = [ROLES[p // len(FAULTS)] for p in place]
    illegal = sum(a + b not in LEGAL if len(a) == len(b) == 1 else True for a, b in zip(initials, initials[1:]))
    return count[1], count[2], count[3], illegal


CHUNKED = (
    "part int, run long, head string, tail string, blank long, duplicate long, truncated long, "
    "illegal long, costs array<long>, audits array<string>"
)


def _matrices(shared):
    """Chunks to their facts and matrices."""

    def run(batches):
        grammar = shared.value
        known, kept = grammar.matrices(), {}
        for batch in batches:
            rows = []
            for symbols in batch.column("symbols").to_pylist():
                found = kept.get(symbols)
                if found is None:
                    flat = [x for row in folded([known[x] for x in grammar.rewrite(symbols)]) for x in row]
                    costs = [-1 if x is None else x[0] for x in flat]
                    found = (*facts(symbols), costs, [None if x is None else text_of(x[1]) for x in flat])
                    if len(symbols) <= 64 and len(kept) < 50_000:
                        kept[symbols] = found
                rows.append((symbols[0], symbols[-1], *found))
            names = ["head", "tail", "blank", "duplicate", "truncated", "illegal", "costs", "audits"]
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.string())]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            made = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("part"), batch.column("run"), *made], ["conv", "part", "run", *names]
            )

    return run


def closed(vector: list) -> tuple[int, str]:
    """The cheapest script: inserts at the end, in a state that the pattern allows to end in."""
    best = None
    for x in (product([vector], inserts())[0][i] for i in (0, 3)):
        if x is not None and better(x, best):
            best = x
    return best[0], text_of(best[1])


SCRIPTS = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _scripts(batches):
    """Chunks in order to one row for each conversation: its facts, cost and audit."""
    start = [(0, ""), None, None, None]
    conv, tail, vector, sums, going = None, None, start, np.zeros(4, np.int64), False
    out, kind = [], None

    def made():
        columns = list(zip(*out)) if out else [[] for _ in range(7)]
        kinds = [kind, *[pa.int64()] * 5, pa.string()]
        names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names)
        out.clear()
        return batch

    for batch in batches:
        kind = batch.schema.field("conv").type
        for row in batch.to_pylist():
            if not going or row["conv"] != conv:
                if going:
                    out.append((conv, *sums.tolist(), *closed(vector)))
                conv, tail, vector, sums, going = row["conv"], None, start, np.zeros(4, np.int64), True
            sums += [row["blank"], row["duplicate"], row["truncated"], row["illegal"]]
            if tail is not None:
                sums[3] += facts(tail + row["head"])[3]
            tail = row["tail"]
            flat = [None if c < 0 else (c, a) for c, a in zip(row["costs"], row["audits"])]
            vector = product([vector], [flat[i : i + STATES] for i in range(0, STATES**2, STATES)])[0]
        yield made()
    if going:
        out.append((conv, *sums.tolist(), *closed(vector)))
        yield made()


def scripts(rows: DataFrame, longest: int = CHUNK, most: int = RULES) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal, cost, audit) of each conversation that
    has rows (conv, turn, role, text, copies)."""
    kind = rows.schema["conv"].dataType.simpleString()
    marked = materialize(faults(rows), "faults")
    order = ["conv", "turn", "role", "digest"]
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "first", "rest", "copies")
    chunks = materialize(
        ordered.mapInArrow(_chunks(longest), f"conv {kind}, part int, run long, symbols string"), "chunks"
    )
    sequences = materialize(chunks.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "sequences")
    shared = rows.sparkSession.sparkContext.broadcast(build_grammar(sequences, most, longest=longest))
    found = chunks.mapInArrow(_matrices(shared), f"conv {kind}, {CHUNKED}")
    placed = found.repartition("conv").sortWithinPartitions("conv", "part", "run")
    return placed.mapInArrow(_scripts, f"conv {kind}, {SCRIPTS}")


class Replay:
    """Applies an audit to a conversation's rows, one after the other."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def turn(self) -> str:
        self.state = turned_state(self.state)
        return "assistant" if self.state == 3 else "user"

    def inserted(self):
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self.turn(), ""

    def row(self, role: str, text: str):
        """The repaired rows that this one leads to, inserts before it included."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = kept_state(self.state, role[:1])
            yield role, text
        elif edit == "R":
            yield self.turn(), text


def with_scripts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """found (conv, audit, ...) and rows, by conversation: first its audit, then its rows in order."""
    lines = rows.select(
        "conv", F.lit(1).alias("line"), "turn", "role", digest().alias("digest"), "text", "copies",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields if f.name != "conv"],
    )
    heads = found.select(
        "conv", F.lit(0).alias("line"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"),
        F.lit(0).alias("copies"), *[c for c in found.columns if c != "conv"],
    )
    order = ["conv", "line", "turn", "role", "digest"]
    return heads.unionByName(lines).repartition("conv").sortWithinPartitions(*order).drop("turn", "digest")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, place, role, text) of all conversations after the repair."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches):
        conv, replay, place = None, None, 0
        for batch in batches:
            out = []

            def put(lines):
                nonlocal place
                for role, text in lines:
                    out.append((conv, place, role, text))
                    place += 1

            for row in batch.to_pylist():
                if row["line"] == 0:
                    if replay is not None:
                        put(replay.inserted())
                    conv, replay, place = row["conv"], Replay(row["audit"]), 0
                for _ in range(row["copies"]):
                    put(replay.row(row["role"], row["text"]))
            yield _rows(out, batch.schema.field("conv").type)
        if replay is not None:
            out = []
            put(replay.inserted())
            yield _rows(out, batch.schema.field("conv").type)

    def _rows(out, kind):
        columns = list(zip(*out)) if out else [[] for _ in range(4)]
        kinds = [kind, pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, kinds)], ["conv", "place", "role", "text"]
        )

    return with_scripts(rows, found.select("conv", "audit")).mapInArrow(
        run, f"conv {kind}, place long, role string, text string"
    )


def with_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """found with repaired_sha256, the digest of each conversation's repaired lines."""
    names = found.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)

    def run(batches):
        head, replay, sha, lines = None, None, None, 0
        for batch in batches:
            out = []

            def put(repaired):
                nonlocal lines
                for role, text in repaired:
                    sha.update((("\n" if lines else "") + f"{role}:{text}").encode())
                    lines += 1

            def close():
                if replay is not None:
                    put(replay.inserted())
                    out.append(head | {"repaired_sha256": sha.hexdigest()})

            fields = [pa.field(n, batch.schema.field(n).type) for n in names]
            target = pa.schema([*fields, pa.field("repaired_sha256", pa.string())])
            for row in batch.to_pylist():
                if row["line"] == 0:
                    close()
                    head, replay = {n: row[n] for n in names}, Replay(row["audit"])
                    sha, lines = hashlib.sha256(), 0
                for _ in range(row["copies"]):
                    put(replay.row(row["role"], row["text"]))
            yield pa.RecordBatch.from_pylist(out, target)
        if replay is not None:
            out = []
            close()
            yield pa.RecordBatch.from_pylist(out, target)

    return with_scripts(rows, found).mapInArrow(run, f"{schema}, repaired_sha256 string")


def summaries(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each of
    conversations (conv), those without rows included."""
    turns = rows.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("n"))
    spans = turns.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    found = conversations.select("conv").distinct().alias("c")
    for other, name in ((spans, "s"), (scripts(rows), "f")):
        found = found.join(other.alias(name), F.col("c.conv").eqNullSafe(F.col(f"{name}.conv")), "left")
    counts = [F.coalesce(x, F.lit(0)).alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("c.conv", *counts, F.coalesce("audit", F.lit("")).alias("audit"))


def op12_repair(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = damage(conversations)
    found = summaries(rows, conversations.select(F.col("conv_id").alias("conv")))
    return with_digests(rows, found).withColumnRenamed("conv", "conv_id")


SQL = r"""
WITH s AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
-- crc32 of the key, which is ASCII, bit by bit
h AS (
  SELECT *, xor(list_reduce(list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT),
    lambda a, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda r, _: xor(r >> 1, (r & 1) * 3988292384), xor(a, b)),
    4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM s),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE kind <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place,
    substr(role, 1, 1) AS initial
  FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS earlier
  FROM n),
-- states: 0 nothing yet, 1 after s, 2 after u, 3 after a; inserts before a row, then its edit
i(low, mid, cost, audit, lines) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
    (1, 1, 0, '', []), (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
    (2, 2, 0, '', []), (2, 3, 3, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 3, 'I', ['user:'])),
e(mid, high, edit, initial) AS (
  SELECT unnest([0, 1, 2, 3]), unnest([0, 1, 2, 3]), 'D', NULL
  UNION ALL SELECT unnest([0, 1, 2, 3]), unnest([2, 2, 3, 2]), 'R', NULL
  UNION ALL SELECT unnest([0, 1, 2, 3]), unnest([0, 1, 2, 3]), 'K', ''
  UNION ALL SELECT unnest([0, 0, 1, 2, 3]), unnest([1, 2, 2, 3, 2]), 'K', unnest(['s', 'u', 'u', 'a', 'u'])),
r AS (
  WITH RECURSIVE walk(conv_id, place, state, best) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} FROM f
    UNION ALL
    SELECT f.conv_id, f.place, e.high, min({
      'cost': walk.best.cost + i.cost + CASE e.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
        + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END,
      'audit': walk.best.audit || i.audit || e.edit,
      'lines': walk.best.lines || i.lines || CASE e.edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text]
        ELSE [CASE WHEN e.mid = 2 THEN 'assistant:' ELSE 'user:' END || f.text] END})
    FROM walk JOIN f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.place = walk.place + 1
    JOIN i ON i.low = walk.state
    JOIN e ON e.mid = i.mid AND (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R' OR e.initial = f.initial))
    GROUP BY f.conv_id, f.place, e.high)
  SELECT * FROM walk),
last AS (SELECT conv_id, max(place) AS place FROM f GROUP BY conv_id),
w AS (
  SELECT r.conv_id, min({'cost': r.best.cost + i.cost, 'audit': r.best.audit || i.audit, 'lines': r.best.lines || i.lines}) AS best
  FROM r JOIN last ON last.conv_id IS NOT DISTINCT FROM r.conv_id AND last.place = r.place
  JOIN i ON i.low = r.state AND i.mid IN (0, 3) GROUP BY r.conv_id),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
o AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.best.cost, 0)::BIGINT AS cost,
  coalesce(w.best.audit, '') AS audit, sha256(coalesce(array_to_string(w.best.lines, chr(10)), '')) AS repaired_sha256
FROM o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""

QUERIES = {"op12_repair": (op12_repair, SQL)}
