"""Conversation structure repair by dynamic programming over a grammar of role/fault sequences.

A conversation's rows stand in the order of ``turn`` (NULL first; rows of one turn by a 128-bit hash of
role and text). Each row becomes one symbol: its role's initial and its first fault (blank, duplicate,
truncated). The cheapest edits that make the initials read ``(s?(ua)+)?`` are found by a four-state
automaton: a symbol is a min-plus matrix from state to state, and a sequence is the product of its symbols.

Sequences repeat between conversations, so a Re-Pair grammar is learnt from all of them: in each round
Spark counts adjacent pairs of symbols over all different sequences, weighted by how often each occurs, and the
most frequent pairs become rules. Every rule gets its matrix once, bottom-up, and every conversation uses it.
A cell also has a rope, the audit of its edits: the rule's cell knows through which state its two halves
meet, and the text of the audit is only written out at the end. Two audits of a row of a matrix never
are prefixes of one another, so their order follows from the halves' orders and no texts are compared.

Conversations of any length are cut into segments of 256 rows (in-group places come from range pieces);
matrices of up to 256 segments are multiplied in a task, and so on level by level, and the chosen states
go down the same levels. Only the digest of a repaired conversation's text is sequential by nature: its
rows stream, sorted, through one task and are not held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termspark.llm.common import map_rows, read_once, struct, with_batch_bounds
from termspark.operators.numbering import ordinals
from termspark.session import drop_staged

# --- fixed values: costs of the edits, white space and sentence ends ---
RELABEL, DELETE, INSERT, UNDELETED_CUT = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
# --- end of fixed values ---

# rows of a segment, and segments of a level's unit, as a power of two
FAN_BITS = 8
# rounds of the grammar and rules of a round at most: bounds what is collected and sent to tasks
ROUNDS, RULES_A_ROUND = 6, 32
# different sequences whose solutions a task keeps at once
KEPT_SHAPES = 20_000

# states: nothing yet, after s, after u, after a
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
NEXT = {
    (START, "s"): AFTER_S,
    (START, "u"): AFTER_U,
    (AFTER_S, "u"): AFTER_U,
    (AFTER_U, "a"): AFTER_A,
    (AFTER_A, "u"): AFTER_U,
}
INITIALS = "suao"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
# a row's mark is the letter of 4 * fault + initial; of blank and duplicate rows only the deletion counts
MARKS = "ABCDEFGHIJKLMNOP"
DELETED = "X"
FIRST_RULE = 0x100
NEVER = 1 << 60


def shape_of(marks: str) -> str:
    """The symbols of a sequence of marks."""
    return marks.translate({ord(m): DELETED for m in MARKS[4:12]})


def closings() -> dict[int, tuple[int, str]]:
    """For each state, the insertions that end a conversation there."""
    return {START: (0, ""), AFTER_S: (2 * INSERT, "II"), AFTER_U: (INSERT, "I"), AFTER_A: (0, "")}


def _insertions(state: int) -> list[tuple[int, int, str]]:
    """The states reached by insertions alone, each at its least cost."""
    found, cost, audit = [(state, 0, "")], 0, ""
    seen = {state}
    while True:
        state = AFTER_A if state == AFTER_U else AFTER_U
        if state in seen:
            return found
        seen.add(state)
        cost, audit = cost + INSERT, audit + "I"
        found.append((state, cost, audit))


def symbol_cells(symbol: str) -> list[list[tuple[int, str] | None]]:
    """The least (cost, audit) from state to state over one row, with any insertions before it."""
    cells: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]
    number = MARKS.find(symbol)
    initial = INITIALS[number % 4] if number >= 0 else ""
    extra = UNDELETED_CUT if number // 4 == TRUNCATED else 0
    for start in STATES:
        for state, cost, audit in _insertions(start):
            moves = [(state, cost + DELETE, audit + "D")]
            if symbol != DELETED:
                if (state, initial) in NEXT:
                    moves.append((NEXT[state, initial], cost + extra, audit + "K"))
                role = "a" if state == AFTER_U else "u"
                moves.append((NEXT[state, role], cost + extra + RELABEL, audit + "R"))
            for end, total, text in moves:
                if cells[start][end] is None or (total, text) < cells[start][end]:
                    cells[start][end] = (total, text)
    return cells


class Matrix:
    """Costs from state to state, the order of a row's audits, and the state where the two halves meet."""

    __slots__ = ("cost", "order", "via")

    def __init__(self, cost: list[list[int]], order: list[list[int]], via: list[list[int]] | None = None):
        self.cost, self.order, self.via = cost, order, via

    @classmethod
    def of_symbol(cls, symbol: str) -> Matrix:
        cells = symbol_cells(symbol)
        cost = [[c[0] if c else NEVER for c in row] for row in cells]
        texts = [sorted(c[1] for c in row if c) for row in cells]
        return cls(cost, [[t.index(c[1]) if c else 4 for c in row] for row, t in zip(cells, texts)])

    def then(self, other: Matrix) -> Matrix:
        """The min-plus product; of equal costs the least audit, which the first halves decide."""
        cost, order, via = [], [], []
        for mine, ranks in zip(self.cost, self.order):
            middles = [j for j in sorted(STATES, key=ranks.__getitem__) if mine[j] < NEVER]
            costs, meets, keys = [], [], []
            for k in STATES:
                best, at = NEVER, -1
                for j in middles:
                    total = mine[j] + other.cost[j][k]
                    if total < best:
                        best, at = total, j
                costs.append(best)
                meets.append(at)
                keys.append((ranks[at], other.order[at][k]) if at >= 0 else (9, 9))
            ranked = sorted(keys)
            cost.append(costs)
            via.append(meets)
            order.append([ranked.index(key) for key in keys])
        return Matrix(cost, order, via)

    def best_end(self) -> int:
        """The state where the cheapest whole conversation ends, before its closing insertions."""
        ends = closings()
        return min(STATES, key=lambda k: (self.cost[START][k] + ends[k][0], self.order[START][k]))

    def flat(self) -> tuple[list[int], list[int]]:
        return [c for row in self.cost for c in row], [o for row in self.order for o in row]

    @classmethod
    def of_flat(cls, cost: list[int], order: list[int]) -> Matrix:
        return cls([cost[i : i + 4] for i in range(0, 16, 4)], [order[i : i + 4] for i in range(0, 16, 4)])


def product(matrices: list[Matrix]) -> tuple[Matrix, list[list[list[int]] | None]]:
    """The product of a sequence, and for each factor but the first the states before it by (start, end)."""
    made, vias = matrices[0], [None]
    for matrix in matrices[1:]:
        made = made.then(matrix)
        vias.append(made.via)
    return made, vias


def states_along(vias: list, start: int, end: int) -> list[int]:
    """The states before each factor and after the last one, on the best way from ``start`` to ``end``."""
    states = [end]
    for via in reversed(vias[1:]):
        states.append(via[start][states[-1]])
    return [start, *reversed(states)]


class Grammar:
    """Rules over pairs of symbols, with one matrix for each symbol."""

    def __init__(self, rules: list[str]):
        self.rules = list(rules)
        self.matrices = {s: Matrix.of_symbol(s) for s in dict.fromkeys(shape_of(MARKS))}
        self.texts = {s: symbol_cells(s) for s in self.matrices}
        self.halves = {}
        for n, (left, right) in enumerate(self.rules):
            symbol = chr(FIRST_RULE + n)
            self.halves[symbol] = (left, right)
            self.matrices[symbol] = self.matrices[left].then(self.matrices[right])

    def encode(self, shapes: str) -> str:
        """Sequences, one per line, in symbols of the grammar."""
        for n, pair in enumerate(self.rules):
            shapes = shapes.replace(pair, chr(FIRST_RULE + n))
        return shapes

    def audit(self, symbol: str, start: int, end: int) -> str:
        """The rope of a cell, written out."""
        if symbol not in self.halves:
            return self.texts[symbol][start][end][1]
        left, right = self.halves[symbol]
        middle = self.matrices[symbol].via[start][end]
        return self.audit(left, start, middle) + self.audit(right, middle, end)

    def solve(self, shape: str) -> tuple[Matrix, str, list]:
        """The matrix of a sequence of at least one symbol, its symbols, and the states between them."""
        symbols = self.encode(shape)
        made, vias = product([self.matrices[s] for s in symbols])
        return made, symbols, vias

    def audit_of(self, symbols: str, vias: list, start: int, end: int) -> str:
        states = states_along(vias, start, end)
        return "".join(self.audit(s, states[n], states[n + 1]) for n, s in enumerate(symbols))


def pair_counts(shapes: list[str], weights: list[int], rules: list[str]) -> tuple[list[str], list[int]]:
    """How often each pair of adjacent symbols stands in the encoded sequences, overlaps counted once."""
    text = Grammar(rules).encode("\n".join(shapes))
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    if len(codes) < 2:
        return [], []
    breaks = codes == 10
    line = np.cumsum(breaks)
    first = np.concatenate(([True], codes[1:] != codes[:-1]))
    run = np.maximum.accumulate(np.where(first, np.arange(len(codes)), 0))
    counted = ~breaks[:-1] & ~breaks[1:]
    counted &= (codes[:-1] != codes[1:]) | ((np.arange(len(codes) - 1) - run[:-1]) % 2 == 0)
    pairs, at = np.unique((codes[:-1] << 21 | codes[1:])[counted], return_inverse=True)
    sums = np.zeros(len(pairs), np.int64)
    np.add.at(sums, at, np.asarray(weights, np.int64)[line[:-1][counted]])
    return [chr(p >> 21) + chr(p & 0x1FFFFF) for p in pairs.tolist()], sums.tolist()


def chosen_pairs(ranked: list[str]) -> list[str]:
    """Of pairs, most frequent first, those that compete with none chosen before."""
    lefts, rights, chosen = set(), set(), []
    for pair in ranked:
        left, right = pair
        if left in rights or right in lefts or (left == right and left in lefts | rights):
            continue
        lefts.add(left)
        rights.add(right)
        chosen.append(pair)
    return chosen


def learn_grammar(shapes: DataFrame, rounds: int = ROUNDS, rules_a_round: int = RULES_A_ROUND) -> list[str]:
    """Re-Pair rules from ``shapes(shape, n)``, all different sequences and how often each occurs.

    A round is one aggregation; at most ``rules_a_round`` pairs reach the driver. The rules decide how much
    work is shared, never what comes out. No sequences: no rules.
    """
    rules: list[str] = []
    for _ in range(rounds):
        known = list(rules)

        def start():
            def work(batch: pa.RecordBatch) -> dict:
                pairs, sums = pair_counts(batch["shape"].to_pylist(), batch["n"].to_pylist(), known)
                return {"pair": pairs, "uses": sums}

            return work

        counted = map_rows(shapes, {"shape": "string", "n": "bigint"}, struct("pair string, uses bigint"), start)
        totals = counted.groupBy("pair").agg(F.sum("uses").alias("uses")).filter("uses > 1")
        ranked = totals.orderBy(F.desc("uses"), "pair").limit(rules_a_round).collect()
        if not ranked:
            break
        rules += chosen_pairs([r["pair"] for r in ranked])
    return rules


# --- rows, segments, units ---


def _plain(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``, a NULL role or text as one space."""
    return rows.select(
        F.col("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def _hashed(plain: DataFrame) -> DataFrame:
    hashes = {f"h{n}": F.xxhash64(F.lit(n), F.col("role"), F.col("text")) for n in (1, 2)}
    return plain.withColumns(hashes)


def _places(plain: DataFrame) -> DataFrame:
    """``conv_id, turn, h1, h2, fault, initial, ord``: rows without their text, at their places."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    last = F.right(trimmed, F.lit(1))
    fault = F.when(trimmed == "", BLANK).when(last.isin(*STOPS), NONE).otherwise(TRUNCATED)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    light = _hashed(plain).select("conv_id", "turn", "h1", "h2", fault.alias("fault"), initial.alias("initial"))
    return ordinals(light, ["conv_id"], ["turn", "h1", "h2"])


def _segments(places: DataFrame) -> DataFrame:
    """Segments of 256 rows: ``conv_id, seg, n, marks, first_turn, last_turn, n_turns``."""
    groups = places.filter(F.col("fault") != BLANK).groupBy("conv_id", "h1", "h2")
    groups = groups.agg(F.min("ord").alias("earliest"), F.count("*").alias("copies")).filter("copies > 1")
    again = groups.select(F.col("conv_id").alias("_conv"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "earliest")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    known = places.join(again, same, "left")
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("ord") > F.col("earliest"), DUPLICATE)
    mark = F.coalesce(fault, F.col("fault")) * 4 + F.col("initial")
    letter = F.char((F.lit(ord(MARKS[0])) + mark).cast("bigint"))
    row = F.struct("ord", letter.alias("mark"))
    seg = F.shiftright((F.col("ord") - 1).cast("bigint"), FAN_BITS)
    grouped = known.groupBy("conv_id", seg.alias("seg")).agg(
        F.sort_array(F.collect_list(row)).alias("held"),
        F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
        F.size(F.collect_set("turn")).cast("bigint").alias("n_turns"),
        F.count("*").alias("n"),
    )
    marks = F.array_join(F.transform("held", lambda r: r["mark"]), "")
    return grouped.select("conv_id", "seg", "n", marks.alias("marks"), "first_turn", "last_turn", "n_turns")


SUMMARY = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string, last_initial string, first_turn bigint, last_turn bigint, n_turns bigint"
SUMS = ["blank", "duplicate", "truncated", "illegal", "n_turns"]
UNIT = f"{SUMMARY}, cost array<bigint>, order array<int>"
LEGAL = {"su", "ua", "au"}


def summary_of(marks: str) -> dict:
    """Faults and illegal neighbours of a sequence of marks."""
    numbers = [MARKS.index(m) for m in marks]
    initials = "".join(INITIALS[n % 4] for n in numbers)
    faults = [n // 4 for n in numbers]
    return {
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1)),
        "first_initial": initials[0],
        "last_initial": initials[-1],
    }


def joined_summaries(parts: list[dict]) -> dict:
    """The summary of units that follow one another."""
    made = dict(parts[0])
    for part in parts[1:]:
        made.update({s: made[s] + part[s] for s in SUMS})
        made["illegal"] += made["last_initial"] + part["first_initial"] not in LEGAL
        # a turn that goes on over the limit counts once
        made["n_turns"] -= made["last_turn"] is not None and made["last_turn"] == part["first_turn"]
        made["first_turn"] = part["first_turn"] if made["first_turn"] is None else made["first_turn"]
        made["last_turn"] = part["last_turn"] if part["last_turn"] is not None else made["last_turn"]
        made["last_initial"] = part["last_initial"]
    return made


def _numbers(summary: dict, cost: int) -> list[int]:
    """gaps, blank, duplicate, truncated, illegal, cost."""
    first, last = summary["first_turn"], summary["last_turn"]
    gaps = 0 if first is None else min(last - first + 1 - summary["n_turns"], (1 << 63) - 1)
    return [gaps, *(summary[s] for s in SUMS[:4]), cost]


def _solved(segments: DataFrame, rules: list[str]) -> DataFrame:
    """The unit of each segment, and the numbers and audit it has as a whole conversation."""

    def start():
        grammar, kept = Grammar(rules), {}

        def solve(shape: str) -> tuple:
            if shape not in kept:
                if len(kept) >= KEPT_SHAPES:
                    kept.clear()
                made, symbols, vias = grammar.solve(shape)
                end = made.best_end()
                extra, closing = closings()[end]
                audit = grammar.audit_of(symbols, vias, START, end) + closing
                kept[shape] = (*made.flat(), made.cost[START][end] + extra, audit)
            return kept[shape]

        def work(batch: pa.RecordBatch) -> dict:
            made: dict[str, list] = {f.name: [] for f in out}
            for row in batch.select(["marks", "first_turn", "last_turn", "n_turns"]).to_pylist():
                cost, order, total, audit = solve(shape_of(row["marks"]))
                row |= summary_of(row["marks"])
                row |= {"cost": cost, "order": order, "numbers": _numbers(row, total), "audit": audit}
                for name, values in made.items():
                    values.append(row[name])
            return made

        return work

    columns = {"marks": "string", "first_turn": "bigint", "last_turn": "bigint", "n_turns": "bigint"}
    out = struct(f"{UNIT}, numbers array<bigint>, audit string")
    return map_rows(segments, columns, out, start, ["conv_id", "seg", "n", "marks"])


def _next_level(units: DataFrame) -> DataFrame:
    """Units of up to 256 of ``units(conv_id, unit, ...)``, with the states along each best way inside."""
    names = [f.name for f in struct(UNIT)]
    child = F.struct("unit", *names)
    grouped = units.groupBy("conv_id", F.shiftright("unit", FAN_BITS).alias("above")).agg(
        F.sort_array(F.collect_list(child)).alias("children")
    )

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            made: dict[str, list] = {f.name: [] for f in out}
            for children in batch["children"].to_pylist():
                row = joined_summaries(children)
                matrix, vias = product([Matrix.of_flat(c["cost"], c["order"]) for c in children])
                ways = [
                    bytes(states_along(vias, i, k)) if matrix.cost[i][k] < NEVER else b"" for i in STATES for k in STATES
                ]
                end = matrix.best_end()
                extra, closing = closings()[end]
                row["cost"], row["order"] = matrix.flat()
                row |= {"units": [c["unit"] for c in children], "ways": ways, "end": end, "closing": closing}
                row["numbers"] = _numbers(row, matrix.cost[START][end] + extra)
                for name, values in made.items():
                    values.append(row[name])
            return made

        return work

    inside = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in struct(UNIT))
    columns = {"children": f"array<struct<unit: bigint, {inside}>>"}
    out = struct(f"{UNIT}, units array<bigint>, ways array<binary>, end int, closing string, numbers array<bigint>")
    made = map_rows(grouped, columns, out, start, ["conv_id", "above"])
    return made.select(F.col("_row.conv_id"), F.col("_row.above").alias("unit"), *[f.name for f in out])


def _long_audits(solved: DataFrame, rules: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """Numbers of conversations of 256 rows or more, and the audits of their segments."""
    names = [f.name for f in struct(UNIT)]
    units = solved.select(F.col("_row.conv_id").alias("conv_id"), F.col("_row.seg").alias("unit"), *names)
    if units.isEmpty():
        return None
    levels: list[DataFrame] = []
    while True:
        level, _ = read_once(_next_level(units), "conversation-level")
        levels.append(level)
        if level.filter("unit > 0").isEmpty():
            break
        units = level.select("conv_id", "unit", *names)
    top = levels[-1]
    way = top.select("conv_id", "unit", F.lit(START).alias("i"), F.col("end").alias("k"))
    for level in reversed(levels):
        above = way.select(F.col("conv_id").alias("_conv"), F.col("unit").alias("_unit"), "i", "k")
        same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("unit") == F.col("_unit"))
        states = F.element_at("ways", F.col("i") * 4 + F.col("k") + 1)
        steps = level.join(above, same).select("conv_id", "units", F.hex(states).alias("states"))
        steps = steps.select("conv_id", F.posexplode("units").alias("at", "unit"), "states")

        def state(place: Column) -> Column:
            return F.substring("states", 2 * place + 2, F.lit(1)).cast("int")

        way = steps.select("conv_id", "unit", state(F.col("at")).alias("i"), state(F.col("at") + 1).alias("k"))
    parts = solved.select(
        F.col("_row.conv_id").alias("_conv"), F.col("_row.seg").alias("seg"), F.col("_row.marks").alias("marks")
    )
    ways = parts.join(way, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("unit") == F.col("seg")))

    def start():
        grammar = Grammar(rules)

        def work(batch: pa.RecordBatch) -> dict:
            audits = []
            for marks, i, k in zip(*(batch[c].to_pylist() for c in ("marks", "i", "k"))):
                _, symbols, vias = grammar.solve(shape_of(marks))
                audits.append(grammar.audit_of(symbols, vias, i, k))
            return {"audit": audits}

        return work

    written = map_rows(
        ways, {"marks": "string", "i": "int", "k": "int"}, struct("audit string"), start, ["conv_id", "seg"]
    ).select("_row.conv_id", "_row.seg", "audit")
    ends = top.select("conv_id", F.lit(NEVER).alias("seg"), F.col("closing").alias("audit"))
    return top.select("conv_id", "numbers"), written.unionByName(ends)


def _edits(plain: DataFrame) -> DataFrame:
    """``conv_id, seg, numbers, audit``: the numbers of each conversation with rows, and its audit in parts."""
    places = _places(plain)
    segments, segments_path = read_once(_segments(places), "segments")
    faults = F.translate("marks", MARKS[4:12], DELETED * 8)
    shapes, shapes_path = read_once(segments.groupBy(faults.alias("shape")).agg(F.count("*").alias("n")), "shapes")
    rules = learn_grammar(shapes)
    drop_staged(plain.sparkSession, shapes_path)
    solved, _ = read_once(_solved(segments, rules), "solved")
    drop_staged(plain.sparkSession, segments_path)
    # a first segment that is not full is a whole conversation
    whole = (F.col("_row.seg") == 0) & (F.col("_row.n") < (1 << FAN_BITS))
    edits = solved.filter(whole).select("_row.conv_id", F.lit(0).cast("bigint").alias("seg"), "numbers", "audit")
    long = _long_audits(solved.filter(~whole), rules)
    if long is None:
        return edits
    numbers, audits = long
    none = F.lit(None)
    numbers = numbers.select("conv_id", F.lit(-1).cast("bigint").alias("seg"), "numbers", none.cast("string").alias("audit"))
    audits = audits.select("conv_id", "seg", none.cast("array<bigint>").alias("numbers"), "audit")
    return edits.unionByName(numbers).unionByName(audits)


class _Replay:
    """One conversation's edits, done row by row."""

    def __init__(self):
        self.numbers, self.parts, self.audit, self.at = [0] * 6, [], None, 0
        self.digest, self.state, self.place, self.made = hashlib.sha256(), START, 0, []

    def _put(self, edit: str, role: str, text: str) -> None:
        self.digest.update((("\n" if self.place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.made.append((self.place, edit, role, text))
        self.place += 1

    def _insert_all(self) -> None:
        if self.audit is None:
            self.audit = "".join(self.parts)
        while self.audit[self.at : self.at + 1] == "I":
            role = "assistant" if self.state == AFTER_U else "user"
            self.state = NEXT[self.state, role[0]]
            self.at += 1
            self._put("I", role, "")

    def row(self, role: str, text: str) -> None:
        self._insert_all()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "R":
            role = "assistant" if self.state == AFTER_U else "user"
        self.state = NEXT[self.state, role[0]]
        self._put(edit, role, text)

    def end(self) -> None:
        self._insert_all()

    def taken(self) -> list[tuple]:
        """What was repaired since the last call; it is not held any longer."""
        made, self.made = self.made, []
        return made


EXISTS, EDITS, ROW = range(3)
REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string, n_repaired bigint"
)
REPAIRED = "place bigint, edit string, role string, text string"


def _replayed(rows: DataFrame, ids: DataFrame | None, out: T.StructType, repaired: bool) -> DataFrame:
    plain = _plain(rows)
    edits = _edits(plain)
    empty = {"seg": "bigint", "numbers": "array<bigint>", "audit": "string"}
    empty |= {"turn": "bigint", "h1": "bigint", "h2": "bigint", "role": "string", "text": "string"}

    def row_of(df: DataFrame, kind: int) -> DataFrame:
        given = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()]
        return df.select("conv_id", F.lit(kind).alias("kind"), *given)

    every = row_of(edits, EDITS).unionByName(row_of(_hashed(plain), ROW))
    if ids is not None:
        every = every.unionByName(row_of(ids.select("conv_id").distinct(), EXISTS))
    placed = every.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "seg", "turn", "h1", "h2")
    key = T.StructField("conv_id", rows.schema["conv_id"].dataType)
    full = T.StructType([key, *out.fields])
    fields = to_arrow_schema(full)
    asked = ["kind", "numbers", "audit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = None, None
        made: list[list] = [[] for _ in fields]

        def give(values: tuple) -> None:
            for column, value in zip(made, (current, *values)):
                column.append(value)

        def finish() -> None:
            held.end()
            if repaired:
                for values in held.taken():
                    give(values)
            else:
                give((*held.numbers, held.audit, held.digest.hexdigest(), held.place))

        for batch in batches:
            columns = [batch[c].to_pylist() for c in asked]
            for conv, kind, numbers, audit, role, text in zip(batch["conv_id"].to_pylist(), *columns):
                if held is None or conv != current:
                    if held is not None:
                        finish()
                    held, current = _Replay(), conv
                if kind == ROW:
                    held.row(role, text)
                    for values in held.taken():
                        if repaired:
                            give(values)
                elif kind == EDITS:
                    held.numbers = numbers or held.numbers
                    held.parts.append(audit or "")
            if made[0]:
                yield pa.RecordBatch.from_arrays([pa.array(m, f.type) for m, f in zip(made, fields)], schema=fields)
                made = [[] for _ in fields]
        if held is not None:
            finish()
            yield pa.RecordBatch.from_arrays([pa.array(m, f.type) for m, f in zip(made, fields)], schema=fields)

    return with_batch_bounds(placed).select("conv_id", *asked).mapInArrow(run, full)


def structure_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``: faults, cost, audit, and digest of the repair.

    ``ids`` may name further conversations that have no rows: zeros, an empty audit and the digest of no
    text. A NULL role or text is one space; NULL turns come first and count for no gap; NULL conv_ids are
    one conversation. Rows of one turn stand in the order of a hash of role and text, so the result
    does not depend on the order of ``rows``; repeated rows are duplicates. Other columns are not read. An
    empty table gives no rows but those of ``ids``.
    """
    return _replayed(rows, ids, struct(REPORT), repaired=False)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id, place`` (from 0), ``edit`` (K, R or I), ``role, text``.

    Deleted rows are left out; a conversation of which nothing is left has no rows. NULLs, ties and other
    columns as in ``structure_report``.
    """
    return _replayed(rows, None, struct(REPAIRED), repaired=True)
