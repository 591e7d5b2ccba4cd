"""Repair of the turn structure of conversations by a grammar-compressed dynamic program.

Rows of a conversation stand in the order of ``turn`` (null first); rows of one turn in that
of the digest of their role and text. A row's first fault counts: *blank* (nothing but spaces
and 0x09-0x0D), *duplicate* (role and text seen earlier), *truncated* (the last other character
is not ``.``, ``!`` or ``?``). The edits Keep (0), Rerole to user or assistant (3), Delete
(4; the only one for blank and duplicate rows), Insert of an empty user or assistant row (3),
and 3 more for each truncated row that stays, are chosen at the least cost so that the roles'
initials give ``(s?(ua)+)?``; of equally cheap edits those with the least initials in ASCII.

*Order.* One range exchange by (conversation, turn, digest) sorts all rows and numbers them,
so a conversation with a third of all rows lies in many tasks. Consecutive rows of a
conversation with the same ``number >> UNIT_BITS`` are a unit; nothing else is ever grouped.

*Grammar.* Units become strings of role and fault symbols. Each task takes the distinct strings
of a batch, replaces their most frequent adjacent pairs by new symbols, again and again
(Re-Pair), and computes for every rule, bottom up, one min-plus matrix: for each state
before (start, after s, after u, after a) and after it the least cost and the rope of its audit. Equal
strings and equal parts of strings share these matrices, whichever conversation they are from.

*Units to conversations.* A conversation's matrices are multiplied in groups of ``FAN_IN`` up to one; the audits of
such products carry the state at each unit's end as a digit, which later says how each unit is edited.

Of two edits with the same cost that end in the same state neither audit can begin the other (they
would differ by insertions, which cost), so the least audit of a whole goes through least ones of its parts.

Defined results: null role and null text read as one space; null turns come first and count in
no gap; rows with a null conversation are one conversation. Repeated rows are duplicates. Texts may be of any length. An
empty table gives no conversation. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, materialize, tidy

WHITE = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
UNIT_BITS = 10
FAN_IN_BITS = 5
#: Matrices of strings that a task remembers.
REMEMBERED = 20_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: start, after s, after u, after a; STEP has the state after a role's initial.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ACCEPTED = (START, ASSISTANT)
#: A row's code: which of these letters stands for its initial (s, u, a, any other) and fault (none, blank, duplicate, truncated).
CODES = "ABCDEFGHIJKLMNOP"
INITIALS, FAULTS = "suax", "-bdt"
LEGAL = {"su", "ua", "au"}


def _flat(rope) -> str:
    """Text of a rope: a string, or a pair of ropes."""
    if type(rope) is str:
        return rope
    out, stack = [], [rope]
    while stack:
        x = stack.pop()
        if type(x) is str:
            out.append(x)
        else:
            stack += (x[1], x[0])
    return "".join(out)


def _edits(rope) -> str:
    """A rope's edits without the states between units."""
    return _flat(rope).translate({ord(str(s)): None for s in STATES})


def _joined(a, b):
    if not a or not b:
        return a or b
    return a + b if type(a) is str and type(b) is str and len(a) + len(b) <= 64 else (a, b)


def _better(new, old):
    """The cheaper of two (cost, rope) entries; the least edits in ASCII of equally cheap ones."""
    if old is None or new[0] < old[0]:
        return new
    return new if new[0] == old[0] and _edits(new[1]) < _edits(old[1]) else old


def _times(left, right, mark: bool = False):
    """Min-plus product of two matrices; ``mark`` puts the state between them into the ropes."""
    out = []
    for row in left:
        made = [None] * 4
        for k, entry in enumerate(row):
            if entry is not None:
                rope = _joined(entry[1], str(k)) if mark else entry[1]
                for j, other in enumerate(right[k]):
                    if other is not None:
                        made[j] = _better((entry[0] + other[0], _joined(rope, other[1])), made[j])
        out.append(made)
    return out


def _insertions():
    """Matrix of any number of insertions."""
    one = [[(0, "") if i == j else None for j in STATES] for i in STATES]
    for initial in ROLES:
        for i, j in STEP[initial].items():
            one[i][j] = (INSERT, "I")
    out = one
    for _ in STATES:  # no cheapest way meets a state twice
        out = _times(out, one)
    return out


def _row_matrix(initial: str, fault: str):
    """Matrix of one row and the insertions before it."""
    out = [[None] * 4 for _ in STATES]
    for i in STATES:
        out[i][i] = (DELETE, "D")
    if fault in "-t":
        more = TRUNCATED if fault == "t" else 0
        for i, j in STEP.get(initial, {}).items():
            out[i][j] = _better((KEEP + more, "K"), out[i][j])
        for to in ROLES:
            for i, j in STEP[to].items():
                out[i][j] = _better((REROLE + more, "R"), out[i][j])
    return _times(_insertions(), out)


def _decoded(code: str) -> tuple[str, str]:
    at = CODES.index(code)
    return INITIALS[at // 4], FAULTS[at % 4]


def re_pair(sequences: list[list[int]], first: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Re-Pair: sequences of symbols under ``first``, in which pairs are replaced, and the rules of symbols ``first``, ``first + 1``, ...

    A round replaces the most frequent pairs that have no symbol in common, wherever they stand, and
    ends when no pair comes twice. The result has the same texts.
    """
    import numpy as np

    sizes = np.array([len(s) + 1 for s in sequences], np.int64)
    flat = np.array([x for s in sequences for x in (*s, -1)], np.int64)
    ends = np.cumsum(sizes) - 1
    rules: list[tuple[int, int]] = []
    while len(flat):
        inside = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
        width = first + len(rules)
        pairs, counts = np.unique(flat[inside] * width + flat[inside + 1], return_counts=True)
        order = np.lexsort((pairs, -counts))
        taken, used = {}, set()
        for at in order[counts[order] >= 2][:256].tolist():
            a, b = divmod(int(pairs[at]), width)
            if a not in used and b not in used:
                used |= {a, b}
                taken[a] = (b, len(rules))
                rules.append((a, b))
        if not taken:
            break
        second, becomes = np.full(width, -2), np.zeros(width, np.int64)
        for a, (b, rule) in taken.items():
            second[a], becomes[a] = b, first + rule
        hit = inside[second[flat[inside]] == flat[inside + 1]]
        # of a run of one symbol every second place begins a pair
        same = flat[hit] == flat[hit + 1]
        joined = np.concatenate(([False], (np.diff(hit) == 1) & same[1:] & same[:-1]))
        run = np.maximum.accumulate(np.where(joined, 0, np.arange(len(hit))))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        flat[hit] = becomes[flat[hit]]
        keep = np.ones(len(flat), bool)
        keep[hit + 1] = False
        flat = flat[keep]
        ends = np.flatnonzero(flat < 0)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else []
    return [flat[a:b].tolist() for a, b in zip(starts, ends, strict=True)], rules


def matrices(strings: list[str]) -> list:
    """Matrix of each string of codes, through one grammar for all of them."""
    terminals = {c: i for i, c in enumerate(CODES)}
    deleted = terminals[CODES[FAULTS.index("b")]]  # rows that must go are alike, whatever their role

    def symbol(code):
        return deleted if _decoded(code)[1] in "bd" else terminals[code]

    symbols = {c: symbol(c) for c in CODES}
    short, rules = re_pair([[symbols[c] for c in s] for s in strings], len(CODES))
    made = [_row_matrix(*_decoded(c)) for c in CODES]
    for a, b in rules:
        made.append(_times(made[a], made[b]))
    out = []
    for sequence in short:
        whole = made[sequence[0]]
        for x in sequence[1:]:
            whole = _times(whole, made[x])
        out.append(whole)
    return out


def _packed(found: list):
    """Arrow structs of matrices: 16 costs and 16 audits, null where there is no way."""
    import pyarrow as pa

    entries = [e for m in found for row in m for e in row]
    ends = pa.array(range(0, len(entries) + 1, 16), pa.int32())
    costs = pa.array([None if e is None else e[0] for e in entries], pa.int64())
    audits = pa.array([None if e is None else _flat(e[1]) for e in entries], pa.string())
    lists = [pa.ListArray.from_arrays(ends, costs), pa.ListArray.from_arrays(ends, audits)]
    return pa.StructArray.from_arrays(lists, names=["costs", "audits"])


_MATRIX = "struct<costs:array<bigint>,audits:array<string>>"


def _unpacked(m: dict):
    entries = [None if c is None else (c, a) for c, a in zip(m["costs"], m["audits"], strict=True)]
    return [entries[i : i + 4] for i in range(0, 16, 4)]


def _unit_matrix(codes: Column) -> Column:
    def run(batches):
        known = {}
        for held in batches:
            if len(known) > REMEMBERED:
                known.clear()
            strings = held.to_pylist()
            new = [s for s in dict.fromkeys(strings) if s not in known]
            known.update(zip(new, matrices(new), strict=True))
            yield _packed([known[s] for s in strings])

    return arrow_column(run, _MATRIX, codes)


def _product(group: Column) -> Column:
    """Product of an array of matrices."""

    def run(batches):
        for held in batches:
            out = []
            for group in held.to_pylist():
                whole = _unpacked(group[0])
                for m in group[1:]:
                    whole = _times(whole, _unpacked(m), mark=True)
                out.append(whole)
            yield _packed(out)

    return arrow_column(run, _MATRIX, group)


def _cheapest(matrix: Column) -> Column:
    """Cost and marked audit of a conversation from its matrix."""

    def run(batches):
        import pyarrow as pa

        after = _insertions()
        for held in batches:
            found = []
            for m in held.to_pylist():
                best, ends = None, _times(_unpacked(m)[:1], after)[0]
                for state in ACCEPTED:
                    if ends[state] is not None:
                        best = _better(ends[state], best)
                found.append(best)
            columns = [pa.array([c for c, _ in found], pa.int64()), pa.array([_flat(a) for _, a in found], pa.string())]
            yield pa.StructArray.from_arrays(columns, names=["cost", "marked"])

    return arrow_column(run, "struct<cost:bigint,marked:string>", matrix)


def _actions(unit: Column) -> Column:
    """Edits of a unit in order: which row (from 1), which edit, which new role."""

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("at", pa.int32()), ("edit", pa.string()), ("role", pa.string())]))
        for held in batches:
            out = []
            for unit in held.to_pylist():
                state, at, edits = unit["state"], 0, []
                for edit in unit["edits"]:
                    at += edit != "I"
                    initial = None
                    if edit == "K":
                        initial = _decoded(unit["codes"][at - 1])[0]
                    elif edit in "RI":
                        initial = "a" if state == USER else "u"
                    if initial:
                        state = STEP[initial][state]
                    edits.append({"at": None if edit == "I" else at, "edit": edit, "role": ROLES[initial] if edit in "RI" else None})
                out.append(edits)
            yield pa.array(out, kind)

    return arrow_column(run, "array<struct<at:int,edit:string,role:string>>", unit)


class Repair(NamedTuple):
    """``report``: a row per conversation; ``messages``: a row per edit, in the order of ``unit, step``."""

    report: DataFrame
    messages: DataFrame


def _number(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, digest, code, number``: all rows in order, written."""
    role_c, text_c = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), role_c.alias("role"), text_c.alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # rows that are alike in all are dealt out by where they were read; which of them is where makes no difference
    rows = rows.withColumn("digest", digest).withColumn("like", F.monotonically_increasing_id())
    keys = ["conv", "turn", "digest", "like"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("like")
    return materialize(ordered.withColumn("number", F.monotonically_increasing_id()), "conversation_rows")


def _coded(ordered: DataFrame) -> DataFrame:
    """``conv, turn, number, code`` of every row."""
    ended = F.rtrim(F.col("text"), F.lit(WHITE))
    firsts = ordered.groupBy("conv", "digest").agg(F.min("number").alias("number")).select("number", F.lit(True).alias("first"))
    narrow = ordered.select(
        "conv",
        "turn",
        "number",
        F.substring("role", 1, 1).alias("initial"),
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("truncated"), 3).otherwise(0)
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    code = F.substring(F.lit(CODES), 4 * initial + fault + 1, F.lit(1))
    return narrow.join(firsts, "number", "left").select("conv", "turn", "number", code.alias("code"))


def _same(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on ``conv``, null being a value, without the right ``conv``."""
    right = right.withColumnRenamed("conv", "__conv")
    return left.join(right, F.col("conv").eqNullSafe(F.col("__conv")), how).drop("__conv")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Repair every conversation of ``rows``.

    Report: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``. ``gaps``
    counts the whole numbers between the smallest and the greatest turn that no row has, ``illegal`` the adjacent rows
    whose initials are none of su, ua, au. Messages: ``conv, unit, step, edit, role, text``, also of deleted rows.
    """
    ordered = _number(rows, conv, turn, role, text)
    coded = materialize(_coded(ordered), "conversation_codes")
    unit = F.shiftright("number", UNIT_BITS)
    grouped = coded.groupBy("conv", unit.alias("unit")).agg(F.sort_array(F.collect_list(F.struct("number", "code"))).alias("held"))
    codes = F.array_join(F.transform("held", lambda x: x["code"]), "")
    units = grouped.select("conv", "unit", codes.alias("codes"), F.transform("held", lambda x: x["number"]).alias("numbers"))
    units = materialize(units.withColumn("matrix", _unit_matrix(F.col("codes"))), "conversation_units")

    # narrow rows give a unit's place and what stands on both sides of its start
    spec = Window.partitionBy("conv").orderBy("unit")
    # all faults of an initial are one letter: initials of the codes
    initials = F.translate("codes", CODES, "".join(_decoded(c)[0] for c in CODES))
    placed = units.select("conv", "unit", initials.alias("initials")).select(
        "conv", "unit", F.substring("initials", 1, 1).alias("head"), F.substring("initials", -1, 1).alias("tail"), _illegal("initials").alias("inside")
    )
    before = F.concat(F.lag("tail").over(spec), "head")
    meets = F.when(before.isNotNull() & ~before.isin(*LEGAL), 1).otherwise(0)
    placed = placed.select("conv", "unit", (F.row_number().over(spec) - 1).alias("place"), (F.col("inside") + meets).alias("illegal"))
    placed = materialize(placed, "conversation_places", narrow=True)

    found = _conversation_matrices(units, placed).select("conv", _cheapest(F.col("matrix")).alias("best"))
    found = materialize(found.select("conv", "best.*"), "conversation_edits", narrow=True)
    return Repair(_report(coded, placed, found), _messages(ordered, units, placed, found))


def _illegal(initials: str) -> Column:
    """How many adjacent letters of a string are not one of the legal pairs: all pairs but the legal ones."""
    pairs = F.greatest(F.length(initials) - 1, F.lit(0))
    # a legal pair is counted by the places where its first letter stands before its second
    legal = sum((F.size(F.split(F.col(initials), f"{p[0]}(?={p[1]})", -1)) - 1 for p in sorted(LEGAL)), F.lit(0))
    return (pairs - legal).cast("bigint")


def _conversation_matrices(units: DataFrame, placed: DataFrame) -> DataFrame:
    """``conv, matrix`` of each conversation: products of its units' in groups, up to one."""
    most = placed.agg(F.max("place")).first()[0] or 0
    both = (units["conv"].eqNullSafe(placed["conv"])) & (units["unit"] == placed["unit"])
    level = units.join(placed, both).select(units["conv"], "place", "matrix")
    while most > 0:
        held = F.sort_array(F.collect_list(F.struct("place", "matrix")))
        up = level.groupBy("conv", F.shiftright("place", FAN_IN_BITS).alias("place")).agg(held.alias("held"))
        level = up.select("conv", "place", _product(F.transform("held", lambda x: x["matrix"])).alias("matrix"))
        most >>= FAN_IN_BITS
        if most > 0:
            level = materialize(level, "conversation_level")
    return level.select("conv", "matrix")


def _report(coded: DataFrame, placed: DataFrame, found: DataFrame) -> DataFrame:
    per_fault = {"blank": 1, "duplicate": 2, "truncated": 3}
    fault = F.pmod(F.ascii("code") - F.lit(ord(CODES[0])), F.lit(4))
    faults = coded.groupBy("conv").agg(*[F.count_if(fault == n).alias(c) for c, n in per_fault.items()])
    turns = coded.where(F.col("turn").isNotNull()).groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
    turns = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("bigint").alias("gaps"))
    illegal = placed.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    audit = F.translate("marked", "".join(map(str, STATES)), "")
    out = _same(_same(_same(found.select("conv", "cost", audit.alias("audit")), faults), turns), illegal)
    return out.select("conv", F.coalesce("gaps", F.lit(0).cast("bigint")).alias("gaps"), *per_fault, "illegal", "cost", "audit")


def _messages(ordered: DataFrame, units: DataFrame, placed: DataFrame, found: DataFrame) -> DataFrame:
    digits = f"[{''.join(map(str, STATES))}]"
    parts = F.split("marked", f"(?<={digits})", -1)  # each part ends with the state after it
    cut = found.select("conv", F.posexplode(parts).alias("place", "part"), parts.alias("parts"))
    entry = F.when(F.col("place") > 0, F.right(F.get("parts", F.col("place") - 1), F.lit(1)).cast("int")).otherwise(F.lit(START))
    cut = cut.select("conv", "place", F.regexp_replace("part", digits, "").alias("edits"), entry.alias("state"))

    def on(a, b, column):
        return a["conv"].eqNullSafe(b["conv"]) & (a[column] == b[column])

    narrow = units.select("conv", "unit", "codes", "numbers")
    whole = narrow.join(placed, on(narrow, placed, "unit")).select(narrow["conv"], narrow["unit"], "codes", "numbers", "place")
    whole = whole.join(cut, on(whole, cut, "place")).select(whole["conv"], "unit", "codes", "numbers", "edits", "state")
    steps = whole.select("conv", "unit", "numbers", F.posexplode(_actions(F.struct("codes", "edits", "state"))).alias("step", "do"))
    steps = materialize(steps.select("conv", "unit", "step", "do.edit", F.get("numbers", F.col("do.at") - 1).alias("number"), F.col("do.role").alias("new")), "conversation_steps")
    texts = ordered.select("number", "role", "text")
    kept = steps.where(F.col("edit") != "I").join(texts, "number")
    kept = kept.select("conv", "unit", "step", "edit", F.coalesce("new", "role").alias("role"), "text")
    made = steps.where(F.col("edit") == "I").select("conv", "unit", "step", "edit", F.col("new").alias("role"), F.lit("").alias("text"))
    return kept.unionByName(made)


def digests(messages: DataFrame) -> DataFrame:
    """``conv, sha256`` of each conversation's ``role:text`` lines, joined by line feeds, without deleted rows.

    The digest of a text can only be made from its start to its end, so one task reads a conversation's lines; it
    holds one batch of them at a time.
    """
    kept = messages.where(F.col("edit") != "D").select("conv", "unit", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    kind = dict(kept.dtypes)["conv"]

    def run(batches):
        import hashlib

        import pyarrow as pa

        now, digest, out = None, None, []
        for batch in batches:
            convs = batch.column(0)
            for at in range(0, batch.num_rows, 256):
                lines = batch.column(1).slice(at, 256).to_pylist()
                for conv, line in zip(convs.slice(at, 256).to_pylist(), lines, strict=True):
                    if digest is None or conv != now:
                        if digest is not None:
                            out.append((now, digest.hexdigest()))
                        now, digest = conv, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(line.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], convs.type), pa.array([d for _, d in out])], names=["conv", "sha256"])
                out = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], convs.type), pa.array([digest.hexdigest()])], names=["conv", "sha256"])

    rows = kept.repartition("conv").sortWithinPartitions("conv", "unit", "step").select("conv", "line")
    return rows.mapInArrow(tidy(run), f"conv {kind}, sha256 string")
