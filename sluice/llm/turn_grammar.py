"""Repair of conversations: the cheapest edits that give turns in a legal order, found on a grammar.

A row is a letter (its role and its fault), a conversation a string of letters. Legal is an optional system
turn, then user and assistant in turn: four states. What a string of letters can do is a 4 x 4 min-plus matrix
(cheapest edits from state to state, of equal ones the least audit), and the matrix of two strings after each
other is the product of theirs. Equal strings are handled once. Over the distinct strings Re-Pair rounds
replace the pairs of symbols that occur most, each by a symbol of its own; the matrix of a rule comes from
those of its two symbols, bottom-up, and serves every place of every conversation where the rule stands.

An audit of a matrix is the audits of its parts behind each other. It is stored spelled out, since ties are
decided on the letters; strings are cut into blocks of ``BLOCK`` rows, so a rule spells at most two letters
a row of a block and state pair. Blocks of a long conversation are multiplied in groups of ``FAN``. Rows are
numbered by range sorts that cut inside a conversation; only the last pass, which applies the audit and takes a
digest of the whole text, reads a conversation in one task, row by row and without keeping it.

Equal costs never hide a better audit: two audits over the same rows of which one continues the other differ by
insertions and so in cost; hence the least audit of a part is part of the least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.operators.lookups import left_join_unique
from sluice.operators.numbering import dense_number
from sluice.scratch import materialize

BLOCK = 512  # rows of a string
FAN = 32  # matrices that are multiplied in one group
ROUNDS = 10  # Re-Pair rounds at most; what is left of a string is multiplied symbol by symbol

# Costs of the edits and of a truncated row that stays, roles by initial, what counts as white space.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

# Letters: the initial of the role (o: any other), upper case if truncated, X if the row has to go.
_LETTERS = "suaoSUAOX"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
Matrix = list  # 16 entries by from * 4 + to: (cost, audit) or None


def times(left: Matrix, right: Matrix) -> Matrix:
    """Cheapest way through ``left`` and then ``right``; of equal costs the least audit in ASCII order."""
    out: Matrix = [None] * 16
    for x in _STATES:
        for m in _STATES:
            if (a := left[4 * x + m]) is None:
                continue
            for y in _STATES:
                if (b := right[4 * m + y]) is None:
                    continue
                cost, known = a[0] + b[0], out[4 * x + y]
                if known is None or cost < known[0]:
                    out[4 * x + y] = (cost, a[1] + b[1])
                elif cost == known[0]:
                    out[4 * x + y] = min(known, (cost, a[1] + b[1]))
    return out


def _next(state: int) -> int:
    """The state after a user or assistant turn that is legal in ``state``."""
    return _ASSISTANT if state == _USER else _USER


def _insertions() -> Matrix:
    """Any number of inserted turns."""
    out: Matrix = [None] * 16
    for x in _STATES:
        y, n = x, 0
        while out[4 * x + y] is None:
            out[4 * x + y] = (INSERT * n, "I" * n)
            y, n = _next(y), n + 1
    return out


_INSERTED = _insertions()


def terminal(letter: str) -> Matrix:
    """Insertions and then one row."""
    row: Matrix = [None] * 16

    def offer(x: int, y: int, cost: int, edit: str) -> None:
        row[4 * x + y] = min(filter(None, [row[4 * x + y], (cost, edit)]))

    stays = TRUNCATED if letter in "SUAO" else 0
    for x in _STATES:
        offer(x, x, DELETE, "D")
        if letter == "X":
            continue
        offer(x, _next(x), REROLE + stays, "R")
        kept = {"s": _SYSTEM if x == _START else None, "u": _USER if _next(x) == _USER else None, "a": _ASSISTANT if x == _USER else None}.get(letter.lower())
        if kept is not None:
            offer(x, kept, stays, "K")
    return times(_INSERTED, row)


def finish(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    whole = times(matrix, _INSERTED)
    return min(w for w in (whole[_START], whole[_ASSISTANT]) if w is not None)


_MATRIX = "costs array<long>, audits array<string>"
_ARROW = [pa.field("costs", pa.list_(pa.int64())), pa.field("audits", pa.list_(pa.string()))]


def _read(costs: list, audits: list) -> Matrix:
    return [None if c is None else (c, a) for c, a in zip(costs, audits)]


def _columns(found: list[Matrix]) -> list[pa.Array]:
    return [pa.array([[None if e is None else e[k] for e in m] for m in found], f.type) for k, f in enumerate(_ARROW)]


def _rules(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [c.to_pylist() for c in batch.columns[1:]]
        found = [times(_read(*r[:2]), _read(*r[2:])) for r in zip(*sides)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(found)], ["symbol", "costs", "audits"])


def _products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column is a list of matrices in order; the product takes its place."""
    for batch in batches:
        found = []
        for parts in batch.columns[-1].to_pylist():
            product = None
            for p in parts:
                m = _read(p["costs"], p["audits"])
                product = m if product is None else times(product, m)
            found.append(product)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *_columns(found)], [*batch.schema.names[:-1], "costs", "audits"])


def _finished(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [finish(_read(c, a)) for c, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        cost, audit = pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), cost, audit], ["conv", "cost", "audit"])


def _replaced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put rule symbols in place of pairs: those that occur more often first, equal ones by their symbols."""
    for batch in batches:
        out = []
        for symbols, rules in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            rank = {(r["a"], r["b"]): (-r["n"], r["a"], r["b"]) for r in rules or ()}
            names = {(r["a"], r["b"]): r["symbol"] for r in rules or ()}
            places = sorted((rank[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in rank)
            named: dict[int, int] = {}
            taken = [False] * len(symbols)
            for _, i in places:
                if not taken[i] and not taken[i + 1]:
                    taken[i] = taken[i + 1] = True
                    named[i] = names[symbols[i], symbols[i + 1]]
            out.append([named.get(i, s) for i, s in enumerate(symbols) if i in named or not taken[i]])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["string", "symbols"])


def string_matrices(strings: DataFrame) -> DataFrame:
    """(string), distinct and not empty, of the letters above -> (string, costs, audits).

    Every round counts the pairs of neighbouring symbols over all strings and names those that occur twice or
    more. A string is a row, so its symbols are bounded; pairs that stand in very many strings are looked up
    with one row a string and pair.
    """
    spark = strings.sparkSession
    table = spark.createDataFrame([(i, *zip(*[e or (None, None) for e in terminal(c)])) for i, c in enumerate(_LETTERS)], f"symbol long, {_MATRIX}")
    seqs = materialize(strings.select("string", F.expr(f"transform(split(string, ''), c -> bigint(instr('{_LETTERS}', c)) - 1)").alias("symbols")), "sequences")
    for number in range(1, ROUNDS + 1):
        several = seqs.filter(F.size("symbols") > 1)
        neighbours = F.expr("transform(sequence(0, size(symbols) - 2), i -> struct(symbols[i] AS a, symbols[i + 1] AS b))")
        counts = several.select(F.explode(neighbours).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        # A number of the round and of the row: stored before it is used.
        rules = materialize(counts.withColumn("symbol", F.monotonically_increasing_id() + F.lit(number << 55)), "rules")
        if rules.isEmpty():
            break
        left, right = (table.select(F.col("symbol").alias(s), F.col("costs").alias(f"{s}_costs"), F.col("audits").alias(f"{s}_audits")) for s in "ab")
        sides = rules.join(left, "a").join(right, "b").select("symbol", "a_costs", "a_audits", "b_costs", "b_audits")
        table = table.unionAll(materialize(sides.mapInArrow(_rules, f"symbol long, {_MATRIX}"), "rule-matrices"))
        held = several.select("string", F.explode(F.array_distinct(neighbours)).alias("p")).select("string", "p.a", "p.b")
        found = held.join(rules, ["a", "b"]).groupBy("string").agg(F.collect_list(F.struct("a", "b", "n", "symbol")).alias("rules"))
        seqs = materialize(seqs.join(found, "string", "left").mapInArrow(_replaced, "string string, symbols array<long>"), "sequences")
    placed = seqs.select("string", F.posexplode("symbols").alias("place", "symbol")).join(table, "symbol")
    parts = placed.groupBy("string").agg(F.sort_array(F.collect_list(F.struct("place", "costs", "audits"))).alias("parts"))
    return parts.mapInArrow(_products, f"string string, {_MATRIX}")


def _rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows with the columns that order them: turns ascending, nulls first, then role and digest of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    turn = F.col(turn_col).cast("long")
    return rows.select(
        F.col(conv_col).alias("conv"), turn.isNotNull().alias("late"), turn.alias("turn"), role.alias("role"), text.alias("text"), F.sha2(text, 256).alias("key")
    )


_ORDER = ["late", "turn", "role", "key"]


def faults(rows: DataFrame) -> DataFrame:
    """The rows of ``_rows`` without their text: conv, number in the conversation, letter and fault."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    slim = rows.select("conv", *_ORDER, (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    numbered = materialize(dense_number(slim, _ORDER, "number", within=["conv"]), "numbered-turns")
    # Blank rows are no one's duplicate; the others count from the second of their kind.
    firsts = numbered.filter(~F.col("blank")).groupBy("conv", "role", "key").agg(F.min("number").alias("number")).select("conv", "number", F.lit(True).alias("first"))
    judged = left_join_unique(numbered, firsts.withColumnsRenamed({"conv": "first_conv", "number": "first_number"}), [("conv", "first_conv"), ("number", "first_number")], null_safe=True)
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(fault.isin("blank", "duplicate"), "X").when(fault == "truncated", F.upper(kind)).otherwise(kind)
    return judged.select("conv", "number", fault.alias("fault"), letter.alias("letter"))


def audits(rows: DataFrame) -> DataFrame:
    """(conv, number, letter) -> (conv, cost, audit) of every conversation."""
    block = F.expr(f"(number - 1) div {BLOCK}L").alias("block")
    letters = F.sort_array(F.collect_list(F.struct("number", "letter")))
    blocks = rows.groupBy("conv", block).agg(F.array_join(F.transform(letters, lambda x: x.letter), "").alias("string"))
    blocks = materialize(blocks, "blocks")
    matrices = materialize(string_matrices(blocks.select("string").distinct()), "string-matrices")
    parts = blocks.join(matrices, "string").select("conv", "block", "costs", "audits")
    kind = rows.schema["conv"].dataType.simpleString()
    while not blocks.filter("block > 0").isEmpty():
        grouped = parts.groupBy("conv", F.expr(f"block div {FAN}L").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("block", "costs", "audits"))).alias("parts")
        )
        parts = blocks = materialize(grouped.mapInArrow(_products, f"conv {kind}, block long, {_MATRIX}"), "block-products")
    return parts.select("conv", "costs", "audits").mapInArrow(_finished, f"conv {kind}, cost long, audit string")


def plan(
    rows: DataFrame, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, blank, duplicate, truncated, cost, audit) of every conversation, null ids being one of them.

    The rows of a conversation stand in the order of their turns, null turns first; rows of one turn by role
    and by digest of the text, so that the result does not depend on the order of the input. A null role or
    text is one space. The first fault of a row counts: blank, a duplicate of an earlier row (role and text),
    truncated (its last character that is not white space ends no sentence). Edits are Keep (0), Rerole (3),
    Delete (4, the only one for blank rows and duplicates) and Insert (3); a truncated row that stays adds 3.
    ``audit`` has the initials of the cheapest edits, of equal ones the least.

    ``ids`` (column ``conv_col``) names conversations that may have no rows; those have cost 0 and an empty
    audit. Texts may be of any length, a conversation of any number of rows. An empty table without ids gives
    no rows. Other columns are not read, whatever their names.
    """
    judged = materialize(faults(_rows(rows, conv_col, turn_col, role_col, text_col)), "judged-turns")
    count = lambda name: F.count_if(F.col("fault") == name).alias(name)
    counts = judged.groupBy("conv").agg(count("blank"), count("duplicate"), count("truncated"))
    found = audits(judged).withColumnRenamed("conv", "own")
    whole = counts.join(found, F.col("conv").eqNullSafe(F.col("own"))).drop("own")
    if ids is not None:
        given = ids.select(F.col(conv_col).alias("own")).distinct()
        whole = given.join(whole, F.col("own").eqNullSafe(F.col("conv")), "left").select(
            F.col("own").alias("conv"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("blank", "duplicate", "truncated", "cost")], F.coalesce("audit", F.lit("")).alias("audit")
        )
    return whole


class _Walk:
    """One conversation, read row by row."""

    def __init__(self, conv, audit: str) -> None:
        self.conv, self.audit, self.at, self.state, self.place = conv, audit, 0, _START, 0
        self.illegal, self.turns, self.least, self.last, self.initial = 0, 0, None, None, None
        self.digest = hashlib.sha256()

    def _put(self, role: str, text: str, edit: str) -> tuple:
        self.state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[:1]]
        self.place += 1
        line = f"{role}:{text}"
        self.digest.update((line if self.place == 1 else "\n" + line).encode())
        return self.conv, self.place, role, text, edit

    def _legal(self) -> str:
        return ROLES["a" if self.state == _USER else "u"]

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put(self._legal(), "", "I")

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None:
            self.turns += turn != self.last
            self.least, self.last = turn if self.least is None else self.least, turn
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            yield self._put(role if edit == "K" else self._legal(), text, edit)

    def summary(self) -> tuple:
        gaps = 0 if self.last is None else self.last - self.least + 1 - self.turns
        return self.conv, gaps, self.illegal, self.digest.hexdigest()


def _walks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple | None, _Walk | None]]:
    """(repaired row, None), and (None, walk) at the end of each conversation."""
    walk = None
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            for conv, audit, turn, role, text in zip(*(c.to_pylist() for c in batch.slice(k, 500).columns)):
                if audit is None:
                    yield from ((r, None) for r in walk.row(turn, role, text))
                    continue
                if walk is not None:
                    yield from ((r, None) for r in walk.inserted())
                    yield None, walk
                walk = _Walk(conv, audit)
    if walk is not None:
        yield from ((r, None) for r in walk.inserted())
        yield None, walk


_REPAIRED = "place long, role string, text string, edit string"
_SUMMARY = "gaps long, illegal long, repaired_sha256 string"


def _walked(rows: DataFrame, plans: DataFrame, schema: str, summaries: bool) -> DataFrame:
    """All rows behind the audit of their conversation, walked through in one pass."""
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("late", "turn", "role", "text", "key")]
    marks = plans.select("conv", F.lit(0).alias("kind"), "audit", *nothing)
    both = marks.unionAll(rows.select("conv", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "late", "turn", "role", "text", "key"))
    placed = both.repartition("conv").sortWithinPartitions("conv", "kind", *_ORDER).select("conv", "audit", "turn", "role", "text")
    full = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), *T.StructType.fromDDL(schema).fields])
    types = [pa.int64() if f.dataType == T.LongType() else pa.string() for f in full.fields[1:]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        kinds, out, held = [first.schema.field("conv").type, *types], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], full.names)

        for row, walk in _walks(chain([first], batches)):
            if (walk is None) == summaries:
                continue
            out.append(walk.summary() if summaries else row)
            held += len(out[-1][3])
            if len(out) >= 5_000 or held > 4_000_000:
                yield packed()
                out, held = [], 0
        if out:
            yield packed()

    return placed.mapInArrow(run, full)


def repaired(rows: DataFrame, plans: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place, role, text, edit): the rows after the edits of ``plans`` (``plan`` of the same rows)."""
    return _walked(_rows(rows, conv_col, turn_col, role_col, text_col), plans, _REPAIRED, False)


def summaries(rows: DataFrame, plans: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, gaps, illegal, repaired_sha256) of every conversation of ``plans``.

    ``gaps`` counts the numbers missing between the least and the greatest turn, ``illegal`` neighbouring rows
    whose roles do not follow each other, both before the repair; the digest is that of the repaired rows.
    """
    return _walked(_rows(rows, conv_col, turn_col, role_col, text_col), plans, _SUMMARY, True)
