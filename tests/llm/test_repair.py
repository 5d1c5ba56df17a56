import hashlib
import zlib
from functools import lru_cache
from itertools import product as every

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspike.llm import repair
from tests.llm.support import write

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def table(spark, rows, extra=()):
    return spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(f"extra {n}") for n in extra})


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else regex.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """(cost, audit, lines) by trying every script, suffix by suffix: rows are (role, text, fault)."""

    @lru_cache(maxsize=None)
    def go(at, state, inserted):
        found = []
        if at == len(rows) and state in (0, 3):
            found.append((0, "", ()))
        if inserted < 2:  # a third insert in a row can be left out with the first
            low = go(at, 3 if state == 2 else 2, inserted + 1)
            if low:
                found.append((low[0] + 3, "I" + low[1], (("assistant:" if state == 2 else "user:"),) + low[2]))
        if at < len(rows):
            role, text, fault = rows[at]
            low = go(at + 1, state, 0)
            if low:
                found.append((low[0] + 4, "D" + low[1], low[2]))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                low = go(at + 1, 3 if state == 2 else 2, 0)
                if low:
                    line = ("assistant:" if state == 2 else "user:") + text
                    found.append((low[0] + 3 + extra, "R" + low[1], (line,) + low[2]))
                step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
                after = state if role == "" else step.get((state, role[:1]))
                if after is not None and (low := go(at + 1, after, 0)):
                    found.append((low[0] + extra, "K" + low[1], (f"{role}:{text}",) + low[2]))
        return min(found, default=None)

    return go(0, 0, 0)


def brute(rows):
    convs = {}
    for row in rows:
        convs.setdefault(row[0], [])
    for row in damaged(rows):
        convs[row[0]].append(row[1:])
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in own:
            last = regex.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [m[2] for m in marked]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(tuple(marked))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, sha))
    return sorted(out, key=str)


def got(found):
    return sorted(map(tuple, found.collect()), key=str)


def random_rows(seed, conversations=60, most=14):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    texts = ["Fine.", "Why?", "no end", "", " \t", None, "Yes! ", "a\nb.\n", "é…", "Same words."]
    rows = []
    for conv in range(conversations):
        for turn in range(int(rng.integers(1, most))):
            text = texts[rng.integers(len(texts))]
            if rng.random() < 0.5:
                text = f"{turn} {text}"
            rows.append((conv, None if rng.random() < 0.05 else int(turn + rng.integers(0, 2)), roles[rng.integers(len(roles))], text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_query_equals_brute_force(spark, tmp_path, seed):
    rows = random_rows(seed)
    rows += [(None, 1, "user", "Who?"), (None, None, "assistant", None), (None, 2, None, "x.")]
    rows += [(1000, 5, "user", "again.")] * 7 + [(1001, t, "assistant", "long " * 20_000 + ".") for t in range(3)]
    folder = write(table(spark, rows, ["text_", "conv", "line", "copies"]), tmp_path, "conversations")
    assert got(repair.op12_repair(spark, folder)) == brute(rows)


def test_conversations_that_lose_all_rows(spark, tmp_path):
    gone = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    folder = write(table(spark, [(c, 0, "user", "x.") for c in gone]), tmp_path, "conversations")
    empty = hashlib.sha256(b"").hexdigest()
    assert got(repair.op12_repair(spark, folder)) == sorted([(c, 0, 0, 0, 0, 0, 0, "", empty) for c in gone], key=str)


def test_no_rows(spark, tmp_path):
    folder = write(table(spark, []), tmp_path, "conversations")
    assert repair.op12_repair(spark, folder).count() == 0


def test_chunks_and_rules_do_not_change_scripts(spark):
    rows = random_rows(7, 12, 60)
    plain = repair.damage(table(spark, rows))
    expected = [(r[0], *r[2:8]) for r in brute(rows) if r[7]]
    for longest, most in ((4096, 192), (3, 192), (5, 0), (1, 40)):
        found = [r for r in got(repair.scripts(plain, longest, most)) if r[6]]
        assert found == expected


def test_repaired_rows(spark):
    rows = random_rows(9, 20)
    plain = repair.damage(table(spark, rows))
    found = repair.scripts(plain)
    held = {}
    for r in sorted(repair.repaired(plain, found).collect(), key=lambda r: (r.conv, r.place)):
        held.setdefault(r.conv, []).append((r.role, r.text))
    digests = {r[0]: r[8] for r in brute(rows)}
    for conv, lines in held.items():
        assert regex.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in lines))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest() == digests[conv]


def exhaustive(symbols):
    """The best script of symbols by enumeration of edits and inserts before each row."""
    kinds = [(repair.ROLES[i // 4], repair.FAULTS[i % 4]) for i in map(repair.TERMINALS.index, symbols)]
    best = None
    for edits in every("KRD", repeat=len(kinds)):
        for added in every((0, 1, 2), repeat=len(kinds) + 1):
            state, cost, audit, good = 0, 0, "", True
            for (role, fault), edit, count in zip([*kinds, ("", "")], [*edits, ""], added):
                for _ in range(count):
                    state = 3 if state == 2 else 2
                cost, audit = cost + 3 * count, audit + "I" * count + edit
                if edit == "D":
                    cost += 4
                elif edit:
                    good &= fault not in ("blank", "duplicate")
                    cost += 3 * (fault == "truncated") + 3 * (edit == "R")
                    after = repair.kept_state(state, role) if edit == "K" else (3 if state == 2 else 2)
                    good &= after is not None
                    state = after
                if not good:
                    break
            if good and state in (0, 3) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=repair.TERMINALS, min_size=1, max_size=4))
def test_matrices_equal_enumeration(symbols):
    known = repair.Grammar().matrices()
    whole = repair.folded([known[x] for x in symbols])
    assert repair.closed(repair.product([[(0, ""), None, None, None]], whole)[0]) == exhaustive(symbols)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="DIKR", max_size=3), max_size=6), st.lists(st.text(alphabet="DIKR", max_size=3), max_size=6))
def test_ropes_compare_as_texts(one, two):
    def rope(parts):
        if len(parts) < 2:
            return parts[0] if parts else ""
        return (rope(parts[: len(parts) // 2]), rope(parts[len(parts) // 2 :]))

    assert repair.before(rope(one), rope(two)) == ("".join(one) < "".join(two))


def test_a_grammar_shortens_and_expands_back(spark):
    sequences = spark.createDataFrame([("FI" * 40, 5), ("BFI" * 10, 3), ("T", 1)], "symbols string, n long")
    grammar = repair.build_grammar(sequences)
    assert len(grammar.rewrite("FI" * 40)) < 10

    def expand(text):
        for pair, symbol in reversed(grammar.rules):
            text = text.replace(symbol, pair)
        return text

    assert expand(grammar.rewrite("FI" * 40 + "BFI" * 3)) == "FI" * 40 + "BFI" * 3
