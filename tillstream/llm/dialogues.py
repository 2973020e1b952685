"""Operator 13: repair the order of roles in conversations at the least cost.

A row is one of ten symbols: the role's kind with its fault, or a row that
has to go. Frequent neighbours become symbols of a grammar (Re-Pair, by a few
rounds of counting over all distinct sequences). Every symbol has a min-plus
matrix over the states of the wanted order, and each cell of it a rope: the
state between the two halves, from which the edits can be spelled out. A rule's
matrix is made once from those of its two symbols and serves all conversations;
a conversation's is the product over what is left of its sequence.

Of two ways with equal costs the one whose edits stand first in ASCII order is
taken. Both read the same rows, and each row ends in a letter that is no
insertion, so neither is a beginning of the other and what follows can't change
their order: a place in the order of the cells stands for their text.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.llm.tables import kept, read_table

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after the system's row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What a row with this role's initial leads to.
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Symbols: the kind of role, s, u, a or o for others, in upper case if the row is truncated; x for a row that can't
#: stay, and y for the second and further ones of equal rows.
GONE, AGAIN = "x", "y"
NONE = 1 << 40
#: Rows in a block of a conversation; its edits are spelled out together.
BLOCK = 4096
#: Symbols of the grammar's rules begin here.
FIRST_RULE = 0xE000


@dataclass(frozen=True)
class Matrix:
    """Cells are in the order 4 * before + after. ``rank`` orders the cells of one state before by their edits."""

    cost: tuple[int, ...]
    rank: tuple[int, ...]
    middle: tuple[int, ...]
    edits: tuple[str, ...] = ()


def _ranks(keys: list) -> tuple[int, ...]:
    """The place of each cell among those of its row."""
    out = [0] * 16
    for q in STATES:
        for place, r in enumerate(sorted(STATES, key=lambda r: keys[4 * q + r])):
            out[4 * q + r] = place
    return tuple(out)


@functools.cache
def symbol_matrix(symbol: str) -> Matrix:
    """The cheapest edits of one row, with insertions before it, from each state to each."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    inserted = [{q: (0, "")} for q in STATES]
    for q in STATES:
        at = q
        for n in (1, 2):
            at = ASSISTANT if at == USER else USER
            inserted[q].setdefault(at, (INSERT * n, "I" * n))
    for q in STATES:
        for m, (cost, before) in inserted[q].items():
            ways = [(m, DELETE, "D")]
            if symbol not in (GONE, AGAIN):
                more = TRUNCATED if symbol.isupper() else 0
                ways += [(STEPS[k][m], REROLE + more, "R") for k in "ua" if m in STEPS[k]]
                own = STEPS.get(symbol.lower(), {})
                ways += [(own[m], more, "K")] if m in own else []
            for r, price, letter in ways:
                found = (cost + price, before + letter)
                best[q, r] = min(best.get((q, r), found), found)
    cells = [best.get((q, r), (NONE, "~")) for q in STATES for r in STATES]
    return Matrix(tuple(c for c, _ in cells), _ranks([e for _, e in cells]), (0,) * 16, tuple(e for _, e in cells))


def product(a: Matrix, b: Matrix) -> Matrix:
    """First ``a``, then ``b``."""
    cost, middle, keys = [], [], []
    for q in STATES:
        for r in STATES:
            c, rank, m = min((a.cost[4 * q + m] + b.cost[4 * m + r], a.rank[4 * q + m], m) for m in STATES)
            cost.append(min(c, NONE))
            middle.append(m)
            keys.append((c >= NONE, rank, b.rank[4 * m + r]))
    return Matrix(tuple(cost), _ranks(keys), tuple(middle))


class Grammar:
    """Rules as pairs of symbols, in the order in which they were made; each has a matrix with its rope."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrices: dict[str, Matrix] = {}
        for k, rule in enumerate(rules):
            self.matrices[chr(FIRST_RULE + k)] = product(*map(self.matrix, rule))
        self.spelled: dict[tuple[str, int, int], str] = {}
        self.known: dict[str, list[Matrix]] = {}

    def matrix(self, symbol: str) -> Matrix:
        return self.matrices[symbol] if symbol in self.matrices else symbol_matrix(symbol)

    def compress(self, sequence: str) -> str:
        for k, rule in enumerate(self.rules):
            sequence = sequence.replace(rule, chr(FIRST_RULE + k))
        return sequence

    def edits(self, symbol: str, q: int, r: int) -> str:
        """The edits of a cell: those of the two halves of its rope."""
        if ord(symbol) < FIRST_RULE:
            return symbol_matrix(symbol).edits[4 * q + r]
        if (symbol, q, r) not in self.spelled:
            left, right = self.rules[ord(symbol) - FIRST_RULE]
            m = self.matrices[symbol].middle[4 * q + r]
            self.spelled[symbol, q, r] = self.edits(left, q, m) + self.edits(right, m, r)
        return self.spelled[symbol, q, r]

    def products(self, packed: str) -> list[Matrix]:
        """The products of the first, the first two, ... symbols; sequences that were met lately are remembered."""
        if packed not in self.known:
            if len(self.known) >= 1000:
                self.known.clear()
            out = [self.matrix(packed[0])]
            for symbol in packed[1:]:
                out.append(product(out[-1], self.matrix(symbol)))
            self.known[packed] = out
        return self.known[packed]

    def spell(self, packed: str, q: int, r: int) -> str:
        """The cheapest edits of a sequence from state q to r."""
        steps, parts = self.products(packed), []
        for k in range(len(packed) - 1, 0, -1):
            m = steps[k].middle[4 * q + r]
            parts.append(self.edits(packed[k], m, r))
            r = m
        return self.edits(packed[0], q, r) + "".join(reversed(parts))


def pairs(sequence: str) -> Counter:
    return Counter(map("".join, zip(sequence, sequence[1:])))


def grammar(sequences: DataFrame, rounds: int = 5, each: int = 16) -> Grammar:
    """Re-Pair over the column ``seq``, weighed by ``n``: in each round the most frequent pairs become rules.

    Pairs of one round don't take symbols from each other. At most ``rounds`` *
    ``each`` rules; how many there are changes the work, not the results.
    """
    rules: list[str] = []
    for _ in range(rounds):
        now = Grammar(list(rules))

        def counted(batches: Iterator[pa.RecordBatch], now: Grammar = now) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total: Counter = Counter()
                for seq, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for pair, times in pairs(now.compress(seq)).items():
                        total[pair] += times * n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["pair", "n"]
                )

        sums = sequences.mapInArrow(counted, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        found = sums.where("n > 1").orderBy(F.desc("n"), "pair").limit(each).collect()
        chosen: list[str] = []
        for pair in (r.pair for r in found):
            if not any(pair[0] == c[1] or pair[1] == c[0] for c in chosen) and pair[0] != pair[1]:
                chosen.append(pair)
        chosen = chosen or [r.pair for r in found[:1]]
        if not chosen:
            break
        rules += chosen
    return Grammar(rules)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def placed(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, n): the distinct rows in the order of conversations; n is how many there are.

    Equal rows are counted before they are sorted, so no group of them comes
    together; a conversation of any length is cut by ranges.
    """
    blank = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    counted = rows.groupBy(*order).agg(F.count("*").alias("n"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = counted.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return kept(spread.withColumn("place", F.monotonically_increasing_id()), "dialogues")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn, n, kind, fault, symbol) of ``placed`` rows, without their texts.

    ``fault`` is the first that holds: blank, duplicate (role and text stand
    earlier), truncated, or an empty string; it is that of the first of n equal rows, the
    others are duplicates unless they are blank.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    key = F.sha2(F.concat_ws(":", F.length("role").cast("string"), F.concat("role", "text")), 256)
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id", "place", "turn", "n", key.alias("key"), (trimmed == "").alias("blank"),
        F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ended"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("kind"),
    )
    several = narrow.where(~F.col("blank")).groupBy("conv_id", "key").agg(F.min("place").alias("first"), F.count("*").alias("c"))
    several = several.where("c > 1").select(F.col("conv_id").alias("conv_"), F.col("key").alias("key_"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("key") == F.col("key_"))
    narrow = narrow.join(several, same, "left")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("place") > F.col("first"), "duplicate").when(~F.col("ended"), "truncated")
    ).otherwise("")
    symbol = F.when(fault.isin("blank", "duplicate"), GONE).when(fault == "truncated", F.upper("kind")).otherwise(F.col("kind"))
    return kept(
        narrow.select("conv_id", "place", "turn", "n", "kind", fault.alias("fault"), symbol.alias("symbol")), "faults"
    )


def part_of(place: Column) -> Column:
    return F.shiftright(place, 33)


def _illegal(a: str | None, b: str) -> bool:
    return a is not None and a + b not in ("su", "ua", "au")


def blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, part, block, place, seq, first, last, illegal): the symbols of ``faults`` rows, up to BLOCK of them together.

    ``place`` is that of the first symbol's row. ``illegal`` counts neighbours that may not follow one another,
    up to this block's last row and from the last block of the same part on; ``first`` is set on a part's first block.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, part, block, begin, seq, held, first, last, illegal = None, None, 0, 0, [], 0, None, None, 0

        def close() -> None:
            nonlocal block, seq, held, first, illegal
            out.append((conv, part, block, begin, "".join(seq), first, last, illegal))
            block, seq, held, first, illegal = block + 1, [], 0, None, 0

        for batch in batches:
            columns = [_column(batch, c) for c in ("conv_id", "place", "n", "kind", "symbol")]
            for c, place, n, kind, symbol in zip(*columns):
                if part != place >> 33 or c != conv:
                    if held:
                        close()
                    conv, part, block, first, last = c, place >> 33, 0, kind, None
                illegal += _illegal(last, kind) + n - 1
                last = kind
                while n:
                    if not held:
                        begin = place
                    take = min(n, BLOCK - held)
                    seq.append(symbol + AGAIN * (take - 1))
                    symbol, held, n = AGAIN, held + take, n - take
                    if held == BLOCK:
                        close()
            if len(out) > 1000:
                yield _batch(out, schema)
                out = []
        if held:
            close()
        yield _batch(out, schema)

    names = ["conv_id", "part", "block", "place", "seq", "first", "last", "illegal"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))
    near = rows.select("conv_id", "place", "n", "kind", "symbol", part_of(F.col("place")).alias("part"))
    near = near.repartition("part").sortWithinPartitions("place").drop("part")
    ddl = "conv_id long, part long, block long, place long, seq string, first string, last string, illegal long"
    return kept(near.mapInArrow(cut, ddl), "blocks")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def ways(cut: DataFrame, rules: Grammar) -> DataFrame:
    """(conv_id, part, block, before, after, cost, illegal, tail): the states around each block on its conversation's
    cheapest way. The last three columns are set on a conversation's last block, for all of it."""

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rules.products(rules.compress(s))[-1] for s in _column(batch, "seq")]
            costs = pa.array([m.cost for m in found], pa.list_(pa.int64()))
            ranks = pa.array([m.rank for m in found], pa.list_(pa.int64()))
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("conv_id", "part", "block", "first", "last", "illegal")]
            yield pa.RecordBatch.from_arrays([*rest, costs, ranks], ["conv_id", "part", "block", "first", "last", "illegal", "costs", "ranks"])

    names = ["conv_id", "part", "block", "before", "after", "cost", "illegal", "tail"]
    schema = pa.schema([(c, pa.string() if c == "tail" else pa.int64()) for c in names])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, begun = None, False
        # Of each block: its place, and for each state after it the state before.
        keys: list[tuple[int, int]] = []
        back: list[bytes] = []
        now: dict[int, tuple[int, int]] = {}
        illegal, last = 0, None

        def close() -> None:
            ends = {START: "", USER: "I", SYSTEM: "II", ASSISTANT: ""}
            cost, _, at = min((c + INSERT * len(ends[q]), rank, q) for q, (c, rank) in now.items())
            tail, found = ends[at], []
            for (part, block), before in zip(reversed(keys), reversed(back)):
                final = not found
                own = (cost, illegal, tail) if final else (None, None, None)
                found.append((conv, part, block, before[at], at, *own))
                at = before[at]
            out.extend(found)

        for batch in batches:
            columns = [_column(batch, c) for c in ("conv_id", "part", "block", "first", "last", "illegal", "costs", "ranks")]
            for c, part, block, first, end, wrong, costs, ranks in zip(*columns):
                if not begun or c != conv:
                    if begun:
                        close()
                    conv, begun, keys, back, now, illegal, last = c, True, [], [], {START: (0, 0)}, 0, None
                illegal += wrong + (first is not None and _illegal(last, first))
                last = end
                options = {}
                for r in STATES:
                    cost, rank, m = min((now[q][0] + costs[4 * q + r], now[q][1], q) for q in now)
                    if cost < NONE:
                        options[r] = (cost, (rank, ranks[4 * m + r]), m)
                order = {key: k for k, key in enumerate(sorted(o[1] for o in options.values()))}
                now = {r: (cost, order[key]) for r, (cost, key, _) in options.items()}
                keys.append((part, block))
                back.append(bytes(options[r][2] if r in options else 0 for r in STATES))
            if len(out) > 1000:
                yield _batch(out, schema)
                out = []
        if begun:
            close()
        yield _batch(out, schema)

    rows = cut.mapInArrow(
        weighed, "conv_id long, part long, block long, first string, last string, illegal long, costs array<long>, ranks array<long>"
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    ddl = "conv_id long, part long, block long, before long, after long, cost long, illegal long, tail string"
    return kept(rows.mapInArrow(chosen, ddl), "ways")


def _next(state: int, letter: str, symbol: str) -> int:
    """The state after one edit."""
    if letter == "D":
        return state
    if letter == "K":
        return STEPS[symbol.lower()][state]
    return ASSISTANT if state == USER else USER


def by_row(seq: str, place: int, state: int, audit: str) -> Iterator[tuple[int, int, str]]:
    """(place, state before, edits) of the rows of a block, but for rows that are only deleted."""
    at, begun, own = iter(audit), state, ""
    for i, symbol in enumerate(seq):
        if i and symbol != AGAIN:
            if own.strip("D"):
                yield place, begun, own
            place, begun, own = place + 1, state, ""
        letter = "I"
        while letter == "I":
            letter = next(at)
            state, own = _next(state, letter, symbol), own + letter
    own += "".join(at)
    if own.strip("D"):
        yield place, begun, own


def audits(cut: DataFrame, states: DataFrame, rules: Grammar) -> DataFrame:
    """(conv_id, part, block, place, seq, before, audit): the edits of each block; the last block's have the insertions
    at the end of the conversation."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [_column(batch, c) for c in ("seq", "before", "after", "tail")]
            texts = [rules.spell(rules.compress(s), q, r) + (t or "") for s, q, r, t in zip(*columns)]
            keep = ["conv_id", "part", "block", "place", "seq", "before"]
            rest = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], [*keep, "audit"])

    own = states.select(
        F.col("conv_id").alias("conv_"), F.col("part").alias("part_"), F.col("block").alias("block_"), "before", "after", "tail"
    )
    same = F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("part") == F.col("part_")) & (F.col("block") == F.col("block_"))
    joined = cut.join(own, same).select("conv_id", "part", "block", "place", "seq", "before", "after", "tail")
    ddl = "conv_id long, part long, block long, place long, seq string, before long, audit string"
    return kept(joined.mapInArrow(spelled, ddl), "audits")


def repaired(rows: DataFrame, edits: DataFrame, by: tuple[str, ...] = ("conv_id", "part")) -> DataFrame:
    """(conv_id, place, nth, role, text): the rows after the edits, in the order of (place, nth).

    ``rows`` are ``placed``, ``edits`` are ``audits``. A row meets its edits sorted, in tasks by the columns ``by``:
    conv_id and part split a long conversation; conv_id alone leaves each one together and in order.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("place", pa.int64()), ("block", pa.int64()), ("state", pa.int64()), ("edits", pa.string())])
        for batch in batches:
            out = []
            columns = [_column(batch, c) for c in ("conv_id", "part", "block", "place", "seq", "before", "audit")]
            for conv, part, block, place, seq, before, audit in zip(*columns):
                out += [(conv, part, at, block, state, own) for at, state, own in by_row(seq, place, before, audit)]
            yield _batch(out, schema)

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("nth", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        held: tuple = ()
        nth = 0
        for batch in batches:
            out = []
            columns = [_column(batch, c) for c in ("conv_id", "place", "block", "state", "edits", "role", "text")]
            for conv, place, block, state, own, role, text in zip(*columns):
                if block < 0:
                    held, nth = (role, text), 0
                    continue
                for letter in own:
                    new = ("assistant" if state == USER else "user") if letter in "IR" else held[0]
                    if letter != "D":
                        out.append((conv, place, nth, new, "" if letter == "I" else held[1]))
                        nth, state = nth + 1, _next(state, letter, new[:1])
            yield _batch(out, schema)

    lists = edits.mapInArrow(listed, "conv_id long, part long, place long, block long, state long, edits string")
    texts = rows.select(
        "conv_id", part_of(F.col("place")).alias("part"), "place", F.lit(-1).cast("long").alias("block"),
        F.lit(None).cast("long").alias("state"), F.lit(None).cast("string").alias("edits"), "role", "text",
    )
    both = texts.unionByName(lists, allowMissingColumns=True)
    both = both.repartition(*by).sortWithinPartitions("conv_id", "place", "block")
    return both.mapInArrow(applied, "conv_id long, place long, nth long, role string, text string")


def report(narrow: DataFrame, states: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation that has rows."""
    def rows_with(fault: str) -> Column:
        # The second and further ones of equal rows are duplicates, or blank as the first is.
        later = {"blank": (F.col("fault") == "blank"), "duplicate": (F.col("fault") != "blank")}
        more = F.when(later[fault], F.col("n") - 1).otherwise(0) if fault in later else F.lit(0)
        return F.sum(F.when(F.col("fault") == fault, 1).otherwise(0) + more).alias(fault)

    counts = narrow.groupBy("conv_id").agg(*[rows_with(f) for f in ("blank", "duplicate", "truncated")])
    turns = narrow.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("turns")
    )
    wide = "decimal(20,0)"
    gaps = F.coalesce(F.col("high").cast(wide) - F.col("low").cast(wide) + 1 - F.col("turns").cast(wide), F.lit(0)).cast("long")
    ends = states.where(F.col("cost").isNotNull()).select("conv_id", "cost", "illegal")
    parts = F.array_sort(F.collect_list(F.struct("part", "block", "audit")))
    texts = edits.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda x: x["audit"]), "").alias("audit"))
    found = counts
    for more in (turns, ends, texts):
        more = more.withColumnRenamed("conv_id", "conv_")
        found = found.join(more, F.col("conv_id").eqNullSafe(F.col("conv_"))).drop("conv_")
    return found.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def hashed(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows that stand in order in one task for each conversation.

    A SHA-256 can only be taken from one end to the other; a task holds one row of a conversation at a time.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
        now, conv, out = None, None, []
        for batch in batches:
            for c, role, text in zip(*[_column(batch, x) for x in ("conv_id", "role", "text")]):
                if now is None or c != conv:
                    if now is not None:
                        out.append((conv, now.hexdigest()))
                    now, conv = hashlib.sha256(), c
                else:
                    now.update(b"\n")
                now.update(f"{role}:{text}".encode())
            if len(out) > 1000:
                yield _batch(out, schema)
                out = []
        if now is not None:
            out.append((conv, now.hexdigest()))
        yield _batch(out, schema)

    return rows.mapInArrow(digests, "conv_id long, repaired_sha256 string")


@dataclass(frozen=True)
class Repair:
    """What was found and done: ``rows`` in order, ``report`` per conversation, ``edits`` per block."""

    rows: DataFrame
    report: DataFrame
    edits: DataFrame


def repair(conversations: DataFrame) -> Repair:
    """Finds the cheapest edits that give each conversation the order of roles `(s?(ua)+)?`, by initials.

    ``conversations`` has conv_id, turn, role and text; a null role or text
    counts as one space, a null conv_id is a conversation of its own, null turns
    come first, and rows of one turn are ordered by role and text. Keep costs 0, Rerole to user or
    assistant 1, Delete 2, Insert of an empty user or assistant row 5; a truncated row that is not
    deleted adds 5; a blank or duplicate row has to be deleted. Of equally cheap edits the ASCII-least initials
    are taken. Texts and conversations may be of any length; an empty table gives empty results. Other
    columns are not read.
    """
    rows = placed(conversations)
    narrow = faults(rows)
    cut = blocks(narrow)
    rules = grammar(kept(cut.groupBy("seq").agg(F.count("*").alias("n")), "sequences"))
    states = ways(cut, rules)
    edits = audits(cut, states, rules)
    return Repair(rows, report(narrow, states, edits), edits)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of conversations with planted faults, by the CRC-32 of conv_id:turn modulo 20 (nulls: one space)."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key) % 20).alias("kind"),
    ).where("kind <> 0")
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("time")
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times).drop("time")


def op13_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations")
    found = repair(damaged(table))
    hashes = hashed(repaired(found.rows, found.edits, ("conv_id",)))
    out = table.select("conv_id").distinct()
    for more in (found.report, hashes):
        more = more.withColumnRenamed("conv_id", "conv_")
        out = out.join(more, F.col("conv_id").eqNullSafe(F.col("conv_")), "left").drop("conv_")
    nothing = hashlib.sha256(b"").hexdigest()
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.select(
        "conv_id", *[column.alias(c) for c, column in zero.items()],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


QUERIES = {"op13_dialogues": op13_dialogues}
