"""Conversation repair against a row-by-row search, an exhaustive one for short rows, and a replay of the edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from termspark.llm import conversations as conv
from termspark.llm.queries import QUERIES, damaged_turns

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GIVEN = re.compile(r"[^\x20\x09-\x0d]")


def damaged(rows):
    for c, t, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(":".join(" " if v is None else str(v) for v in (c, t)).encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        for _ in range((1, 2)[fault == 3] if fault else 0):
            yield c, t, role, text


def marked(rows):
    """Faults of rows in order."""
    seen = set()
    for _, _, role, text in rows:
        shown = GIVEN.findall(text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
        seen.add((role, text))
        yield fault


def cheapest(rows):
    """(cost, audit) row by row, every way kept as a text."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "")}

    def inserted():
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for role in "ua":
                    if (state, role) in step:
                        offer(best, step[state, role], cost + 5, audit + "I")

    def offer(where, state, cost, audit):
        where[state] = min(where.get(state, (10**9, "")), (cost, audit))

    for (_, _, role, _), fault in zip(rows, marked(rows)):
        inserted()
        after = {}
        extra = 5 * (fault == "truncated")
        for state, (cost, audit) in best.items():
            offer(after, state, cost + 2, audit + "D")
            if fault not in ("blank", "duplicate"):
                if (state, role[:1]) in step:
                    offer(after, step[state, role[:1]], cost + extra, audit + "K")
                for to in "ua":
                    if (state, to) in step:
                        offer(after, step[state, to], cost + extra + 1, audit + "R")
        best = after
    inserted()
    return min(best[s] for s in ("", "a") if s in best)


def replayed(rows, audit):
    """The repaired rows, and what the edits cost."""
    rest, made, cost = list(zip(rows, marked(rows))), [], 0
    for edit in audit:
        after_u = made and made[-1][0][:1] == "u"
        turn = "assistant" if after_u else "user"
        if edit == "I":
            made.append((turn, ""))
            cost += 5
            continue
        (_, _, role, text), fault = rest.pop(0)
        cost += {"K": 0, "R": 1, "D": 2}[edit]
        if edit == "D":
            continue
        assert fault not in ("blank", "duplicate")
        cost += 5 * (fault == "truncated")
        made.append((role if edit == "K" else turn, text))
    assert not rest
    return made, cost


def slow_report(given):
    given = list(given)
    out = {}
    for c in {r[0] for r in given}:
        rows = [r for r in damaged(given) if r[0] == c]
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [r[1] for r in rows if r[1] is not None]
        cost, audit = cheapest(rows) if rows else (0, "")
        made, again = replayed(rows, audit)
        assert again == cost
        initials = "".join(role[:1] for role, _ in made)
        assert re.fullmatch("(s?(ua)+)?", initials)
        faults = list(marked(rows))
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def fast_report(df):
    made = conv.structure_report(damaged_turns(df), df).collect()
    assert len({r["conv_id"] for r in made}) == len(made)
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in made}


def test_given_conversations(spark, tables):
    df = tables("conversations")
    assert fast_report(df) == slow_report(tuple(r) for r in df.collect())
    assert {tuple(r) for r in QUERIES["op11_conversation_repair"](spark, SF).select("conv_id", *NAMES).collect()} == {
        (c, *v) for c, v in slow_report(tuple(r) for r in df.collect()).items()
    }


def test_hot_and_odd_conversations(spark, clashing):
    """A third of all rows in one conversation, more than one level of segments, nulls everywhere, other roles."""
    rng = random.Random(5)
    roles, ends = ["user", "assistant", "system", "tool", "", "User", "admin"], [".", "!", "?", "", " \t", ". "]
    rows = []
    for t in range(70_000):
        rows.append((1, t + t // 1000, rng.choice(roles[:2]) if t % 9 else rng.choice(roles), f"w{rng.randrange(60_000)}{rng.choice(ends)}"))
    for c in range(2, 80):
        for t in range(rng.randrange(1, 12) if c % 20 else 300):
            rows.append((c, t, rng.choice(roles), f"w{rng.randrange(6)}{rng.choice(ends)}"))
    rows += [(500, n, "ua"[n % 2], f"t{n}.") for n in range(256)] + [(501, n, "user", f"t{n}.") for n in range(512)]
    rows += [(None, 1, "user", "no id."), (600, None, None, None), (601, None, "user", "x."), (601, None, "user", "x.")]
    rows += [(602, 5, "user", None), (602, 9, None, "x."), (603, 1, "user", "\x1c"), (604, 1, "user", "a " * 90_000)]
    rng.shuffle(rows)
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(7)).withColumns({c: F.lit(1) for c in ("kind", "seg", "ord")})
    assert fast_report(df) == slow_report(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conv.structure_report(df, df).count() == 0 and conv.repair_conversations(df).count() == 0
    gone = next((c, 0) for c in itertools.count() if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(*gone, "user", "x.")], SCHEMA)
    assert fast_report(one) == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows(spark, tables):
    df = tables("conversations")
    made = conv.repair_conversations(damaged_turns(df)).collect()
    given = [tuple(r) for r in df.collect()]
    for c, values in slow_report(given).items():
        mine = [(r["role"], r["text"]) for r in sorted((r for r in made if r["conv_id"] == c), key=lambda r: r["place"])]
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in mine).encode()).hexdigest() == values[-1]


def accepted(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


@pytest.mark.parametrize("marks", ["".join(m) for n in (1, 2, 3) for m in itertools.product("ABCDEMNOP", repeat=n)][::7])
def test_every_edit_sequence(marks):
    """The least of all edit sequences of up to three insertions at a place."""
    cost = {"K": 0, "R": 1, "D": 2}
    best = (10**9, "")
    for edits in itertools.product("KRD", repeat=len(marks)):
        options = []
        for mark, edit in zip(marks, edits):
            number = "ABCDEFGHIJKLMNOP".index(mark)
            if edit == "D":
                options.append([("", 2)])
            elif number // 4 in (1, 2):
                options.append([])
            else:
                extra = 5 * (number // 4 == 3) + cost[edit]
                options.append([(x, extra) for x in ("suao"[number % 4] if edit == "K" else "ua")])
        for way in itertools.product(*options):
            for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(marks) + 1):
                if sum(map(len, gaps)) > 2:
                    continue
                initials = gaps[0] + "".join(x + g for (x, _), g in zip(way, gaps[1:]))
                if accepted(initials):
                    audit = "I" * len(gaps[0]) + "".join(e + "I" * len(g) for e, g in zip(edits, gaps[1:]))
                    best = min(best, (sum(c for _, c in way) + 5 * sum(map(len, gaps)), audit))
    grammar = conv.Grammar(["AB", "BC"])
    matrix, symbols, vias = grammar.solve(conv.shape_of(marks))
    end = matrix.best_end()
    extra, closing = conv.closings()[end]
    assert (matrix.cost[0][end] + extra, grammar.audit_of(symbols, vias, 0, end) + closing) == best


def test_grammar_changes_nothing(spark):
    """Pairs counted without overlap, and the same solutions with and without rules."""
    pairs = dict(zip(*conv.pair_counts(["AAAA", "AAA", "AB"], [1, 10, 5], [])))
    assert pairs == {"AA": 12, "AB": 5}
    rng = random.Random(3)
    shapes = ["".join(rng.choice("BCBCBCXMA") for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    df = spark.createDataFrame([(s, 1 + n % 3) for n, s in enumerate(shapes)], "shape string, n bigint")
    rules = conv.learn_grammar(df)
    assert len(rules) > 10
    plain, ruled = conv.Grammar([]), conv.Grammar(rules)
    for shape in shapes:
        one, two = plain.solve(shape), ruled.solve(shape)
        assert len(two[1]) < len(one[1]) or len(shape) < 8
        assert one[0].flat() == two[0].flat()
        for i, k in itertools.product(range(4), repeat=2):
            if one[0].cost[i][k] < conv.NEVER:
                assert plain.audit_of(*one[1:], i, k) == ruled.audit_of(*two[1:], i, k)
