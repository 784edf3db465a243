"""Conversation structure repair by a run-length dynamic programme (operator 12).

A conversation's rows stand in the order of their turns.  Each row may be kept
(cost 0), reroled to user or assistant (1) or deleted (2); messages of either
role with an empty text may be inserted (5).  The roles that remain must begin
with at most one system message, followed by user and assistant by turns, or be
nothing.  Blank rows and repeats must be deleted; a truncated row that stays
costs 5 more.  The cheapest edits are taken, and of those the ones whose
initials (K, R, D, I) come first as a string.

*Runs.*  What a row allows depends on its symbol alone: the initial of its role
and whether it must go or is truncated.  Equal neighbours are collapsed to a
run (symbol, count).  Four states tell what the kept roles end with; a symbol
is a min-plus matrix over them, and its powers for 1, 2, 4, ... rows are kept,
so a run of k rows is log k products (``before``).  From the costs that are
left after a run, ``unroll`` reads off the choices of its rows, halving the run
along the same powers; halves that look alike are unrolled once.

*Conversations of any length.*  Rows are sorted by (conversation, turn) over
ranges, so that one with very many rows lies in many partitions, and gathered
into parts of up to ``PART`` rows.  A conversation that lies wholly inside a
partition, in one part, is solved where it is.  Of the others (at most two a
partition, and those longer than a part) every part is reduced to its matrix;
one pass from the last part to the first carries the four costs that are left,
one from the first to the last the state; both read some numbers a part and
keep nothing else.  Then each part unrolls its own rows.

Cases: a null role or text is one space; rows without a turn come first; rows
of the same turn are ordered by role and text; rows with a null conv_id are one
conversation; rows that repeat are duplicates of each other; a role with
another initial fits nowhere and can be reroled; an empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, memo

#: Most rows, and characters of text, of a part.
PART, PART_CHARS = 1000, 1 << 20

#: States: nothing yet, after system, after user, after assistant.  The state after an inserted or reroled message.
NEXT = (2, 2, 3, 2)
FITS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {2: "user", 3: "assistant"}
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5

#: What it costs to end in each state: an assistant must be the last, or there is nothing.
LAST = (0, 2 * INSERT, INSERT, 0)

NEVER = 1 << 60


def _moves(symbol: str, state: int):
    """(letter, cost, next state) of what can be done with a row, in the order of the letters.  Symbols: x must go; else
    the initial of the role (o: another), in upper case if truncated."""
    yield "D", DELETE, state
    if symbol != "x":
        more = TRUNCATED if symbol.isupper() else 0
        if (state, symbol.lower()) in FITS:
            yield "K", more, FITS[state, symbol.lower()]
        yield "R", REROLE + more, NEXT[state]


def _product(x, y):
    return tuple(tuple(min(NEVER, *(a + b for a, b in zip(row, col))) for col in zip(*y)) for row in x)


def _apply(matrix, costs):
    return tuple(min(NEVER, *(a + b for a, b in zip(row, costs))) for row in matrix)


@memo
def power(symbol: str, j: int):
    """Min-plus matrix of 2^j rows with this symbol: least cost from a state before them to one after them."""
    if j:
        half = power(symbol, j - 1)
        return _product(half, half)
    out = []
    for state in range(4):
        row, paid = [NEVER] * 4, 0
        for _ in range(3):  # no insert before the row, one or two
            for _, cost, to in _moves(symbol, state):
                row[to] = min(row[to], paid + cost)
            state, paid = NEXT[state], paid + INSERT
        out.append(tuple(row))
    return tuple(out)


def before(symbol: str, count: int, costs):
    """Costs that are left before a run, from those after it."""
    for j in range(count.bit_length()):
        if count >> j & 1:
            costs = _apply(power(symbol, j), costs)
    return costs


@memo
def _halved(symbol: str, j: int, state: int, costs) -> tuple[str, int]:
    """Choices for 2^j rows from a state, and the state after them; ``costs`` that are left after them, least one 0."""
    if j:
        middle = _apply(power(symbol, j - 1), costs)
        first, state = _level(symbol, j - 1, state, middle)
        second, state = _level(symbol, j - 1, state, costs)
        return first + second, state
    left, letters = _apply(power(symbol, 0), costs), ""
    while True:
        moves = [*_moves(symbol, state), ("I", INSERT, None)]
        for letter, cost, to in sorted(moves):
            if letter == "I" and cost + left[NEXT[state]] == left[state]:
                letters, state = letters + "I", NEXT[state]
                break
            if to is not None and cost + costs[to] == left[state]:
                return letters + letter, to


def _level(symbol: str, j: int, state: int, costs):
    least = min(costs)
    return _halved(symbol, j, state, tuple(c - least for c in costs))


def unroll(symbol: str, count: int, state: int, costs) -> tuple[str, int]:
    """Choices for a run of ``count`` rows from a state, and the state after it; ``costs`` that are left after it."""
    out = []
    while count:
        j = min(count.bit_length() - 1, 12)  # longer halves would only fill the memory of halves seen
        count -= 1 << j
        letters, state = _level(symbol, j, state, before(symbol, count, costs))
        out.append(letters)
    return "".join(out), state


def runs_of(symbols: str) -> list[tuple[str, int]]:
    return [(s, len(list(g))) for s, g in groupby(symbols)]


def costs_before(runs, costs):
    for symbol, count in reversed(runs):
        costs = before(symbol, count, costs)
    return costs


def choices(runs, state: int, costs) -> tuple[str, int]:
    """Choices for the rows of runs, and the state after them."""
    after = [costs]
    for symbol, count in reversed(runs[1:]):
        after.append(before(symbol, count, after[-1]))
    out = []
    for (symbol, count), left in zip(runs, reversed(after)):
        letters, state = unroll(symbol, count, state, left)
        out.append(letters)
    return "".join(out), state


def closing(state: int) -> str:
    """Inserts after the last row."""
    return "I" * (LAST[state] // INSERT)


def edited(audit: str, state: int, roles: list, texts: list) -> tuple[list, list]:
    """Roles and texts after the edits of ``audit``, from a state."""
    out, at = ([], []), 0
    for letter in audit:
        if letter != "D":
            state = FITS[state, roles[at][0]] if letter == "K" else NEXT[state]
            out[0].append(roles[at] if letter == "K" else ROLE[state])
            out[1].append("" if letter == "I" else texts[at])
        at += letter != "I"
    return out


# ---- rows ------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) damaged by crc32(conv_id:turn) % 20: 0 drops a row, 1 empties its text, 2 takes
    [.!?] out of it, 3 repeats it, 4 makes it the user's.  Nulls are one space there, and so are null roles and texts."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(part("text"), ".!?", "")).otherwise(part("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return (rows.withColumn("kind", kind).filter("kind <> 0").withColumn("copy", copies)
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(part("role")).alias("role"), text.alias("text")))


def _initial(role: str) -> str:
    return role[0] if role and role[0] in "sua" else "o"


def _flaw(text: str) -> str:
    """b blank, t truncated, k neither."""
    text = text.rstrip(" \t\n\x0b\x0c\r")
    return "b" if not text else "k" if text[-1] in ".!?" else "t"


def _symbols(initials: str, flaws: str) -> str:
    """Of rows whose flaws are b, d (duplicate), t or k."""
    return "".join("x" if f in "bd" else i.upper() if f == "t" else i for i, f in zip(initials, flaws))


def _flaws(roles: list, texts: list, repeats=None) -> str:
    """Flaws of a part's rows; duplicates are at the places ``repeats``, or those seen before in the part."""
    if repeats is None:
        seen: set = set()
        repeats = {k for k, row in enumerate(zip(roles, texts)) if row in seen or seen.add(row)}
    return "".join("d" if f != "b" and k in repeats else f for k, f in enumerate(map(_flaw, texts)))


def _illegal(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _turns(turns: list) -> tuple:
    """First and last turn of sorted ones, and how many differ; nulls aside."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _counts(initials: str, flaws: str) -> tuple:
    return flaws.count("b"), flaws.count("d"), flaws.count("t"), _illegal(initials)


def _batch(rows: list, names: list, types: list):
    import pyarrow as pa

    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


_PART_NAMES = ["conv_id", "part", "whole", "turns", "roles", "texts"]


def _parts(most: int):
    """Sorted rows to parts of up to ``most`` rows.  A part is whole if it holds all rows of a conversation for sure."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        number, held, chars, first, broken, key, kind = TaskContext.get().partitionId() << 33, [], 0, True, False, None, pa.int64()
        types = lambda: [kind, pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]

        def done(whole):
            nonlocal held, chars, number
            row = (key, number, whole, *map(list, zip(*held)))
            held, chars, number = [], 0, number + 1
            return row

        for batch in batches:
            out, kind = [], batch.column("conv_id").type
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
                if held and conv != key:
                    out.append(done(not first and not broken))
                    first = broken = False
                elif len(held) >= most or held and chars + len(row[2]) > PART_CHARS:
                    broken = True
                    out.append(done(False))
                key = conv
                held.append(row)
                chars += len(row[2])
            yield _batch(out, _PART_NAMES, types())
        if held:
            yield _batch([done(False)], _PART_NAMES, types())  # the next partition may go on with it
    return run


_SOLVED = {"blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "first_turn": "long", "last_turn": "long", "turns": "long",
           "outer": "string", "cost": "long", "audit": "string", "roles": "array<string>", "texts": "array<string>"}


def _types():
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    return lambda spec: [kinds[k] for k in spec.values()]


def _mapped(df: DataFrame, spec: dict, row_of) -> DataFrame:
    """``row_of(row)`` for every row (a dict), with the columns conv_id and part in front of those of ``spec``."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = _types()
        for batch in batches:
            rows = batch.to_pylist()
            yield _batch([(r["conv_id"], r["part"], *row_of(r)) for r in rows], ["conv_id", "part", *spec],
                         [batch.column("conv_id").type, pa.int64(), *types(spec)])
    return df.mapInArrow(run, _schema(df, spec))


def _schema(df: DataFrame, spec: dict) -> str:
    return ", ".join([f"conv_id {df.schema['conv_id'].dataType.simpleString()}, part long", *(f"{k} {v}" for k, v in spec.items())])


def _carried(df: DataFrame, spec: dict, start, step, backwards: bool = False) -> DataFrame:
    """Each conversation's parts in turn, with something carried along: ``step(row, carried)`` gives a row and what to carry
    on.  Only the part in hand and that are kept."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, carried, fresh, types = None, None, True, _types()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if fresh or r["conv_id"] != key:
                    key, carried, fresh = r["conv_id"], start, False
                row, carried = step(r, carried)
                out.append((key, r["part"], *row))
            yield _batch(out, ["conv_id", "part", *spec], [batch.column("conv_id").type, pa.int64(), *types(spec)])
    order = F.col("part").desc() if backwards else F.col("part")
    return df.repartition("conv_id").sortWithinPartitions("conv_id", order).mapInArrow(run, _schema(df, spec))


def _solve_whole(r: dict) -> tuple:
    initials, flaws = "".join(map(_initial, r["roles"])), _flaws(r["roles"], r["texts"])
    runs = runs_of(_symbols(initials, flaws))
    audit, state = choices(runs, 0, LAST)
    audit += closing(state)
    low, high, n = _turns(r["turns"])
    return (*_counts(initials, flaws), low, high, n, initials[0] + initials[-1], costs_before(runs, LAST)[0], audit, *edited(audit, 0, r["roles"], r["texts"]))


_MATRIX = {"initials": "string", "flaws": "string", "first_turn": "long", "last_turn": "long", "turns": "long", "matrix": "array<long>"}


def _reduce(r: dict) -> tuple:
    """A part as its rows' symbols and the min-plus matrix from the state before it to that after it."""
    initials, flaws = "".join(map(_initial, r["roles"])), _flaws(r["roles"], r["texts"], set(r["repeats"] or ()))
    runs, matrix = runs_of(_symbols(initials, flaws)), []
    for to in range(4):
        matrix.append(costs_before(runs, tuple(0 if s == to else NEVER for s in range(4))))
    return initials, flaws, *_turns(r["turns"]), [c for row in zip(*matrix) for c in row]


def _costs_left(r: dict, costs):
    m = r["matrix"]
    return (list(costs),), _apply([m[4 * s : 4 * s + 4] for s in range(4)], costs)


def _ends(r: dict) -> tuple:
    runs = runs_of(_symbols(r["initials"], r["flaws"]))
    return ([choices(runs, s, tuple(r["costs"]))[1] for s in range(4)],)


def _states(r: dict, state: int):
    return (state,), r["ends"][state]


def _solve_part(r: dict) -> tuple:
    """A part's own choices; the cost is what its edits add."""
    runs, costs = runs_of(_symbols(r["initials"], r["flaws"])), tuple(r["costs"])
    audit, state = choices(runs, r["state"], costs)
    cost = costs_before(runs, costs)[r["state"]] - costs[state]
    if r["final"]:
        audit += closing(state)
        cost += LAST[state]
    return (*_counts(r["initials"], r["flaws"]), r["first_turn"], r["last_turn"], r["turns_known"], r["initials"][0] + r["initials"][-1], cost,
            audit, *edited(audit, r["state"], r["roles"], r["texts"]))


def repair(rows: DataFrame, part: int = PART) -> DataFrame:
    """The repaired conversations in parts: conv_id, part (rising along the conversation), whole (the part is all of it),
    outer (initials of its first and last row before), blank, duplicate, truncated, illegal (inside the part), first_turn,
    last_turn, turns (different ones), cost, audit, roles and texts (repaired)."""
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    spread = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions(*order)
    kind = rows.schema["conv_id"].dataType.simpleString()
    parts = cut(spread.mapInArrow(_parts(part), f"conv_id {kind}, part long, whole boolean, turns array<long>, roles array<string>, texts array<string>"))
    whole = _mapped(parts.filter("whole"), _SOLVED, _solve_whole).withColumn("whole", F.lit(True))

    open_ = parts.filter("not whole")
    # Repeats of an earlier row anywhere in the conversation: counted first, so a row that stands in a third of it is one key.
    each = open_.select("conv_id", "part", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "row"))
    each = each.select("conv_id", "part", "at", F.xxhash64("row").alias("h"), F.xxhash64(F.lit("repeat"), "row").alias("g"))
    first = each.groupBy("conv_id", "h", "g").agg(F.min(F.struct("part", "at")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("c"), "h", "g", "first")
    repeats = (each.join(first, ["h", "g"]).filter(F.col("conv_id").eqNullSafe(F.col("c")) & (F.struct("part", "at") > F.col("first")))
               .groupBy("part").agg(F.collect_list("at").alias("repeats")))
    reduced = cut(_mapped(open_.join(repeats, "part", "left"), _MATRIX, _reduce))
    left = cut(_carried(reduced.select("conv_id", "part", "matrix"), {"costs": "array<long>"}, LAST, _costs_left, backwards=True))
    known = reduced.drop("matrix").join(left.drop("conv_id"), "part")
    states = _carried(_mapped(known, {"ends": "array<long>"}, _ends), {"state": "long"}, 0, _states)
    final = open_.groupBy("conv_id").agg(F.max("part").alias("part")).select("part", F.lit(True).alias("final"))
    full = (known.withColumnRenamed("turns", "turns_known").join(states.drop("conv_id"), "part").join(final, "part", "left")
            .join(open_.select("part", "roles", "texts"), "part"))
    return whole.unionByName(_mapped(full, _SOLVED, _solve_part).withColumn("whole", F.lit(False)))


_DIGEST = {"gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string",
           "repaired_sha256": "string"}
_SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _digested(batches: Iterator) -> Iterator:
    """One row per conversation from its parts in turn: of the repaired text only the running hash is kept."""
    import pyarrow as pa

    key = found = None

    def begin():
        return {k: 0 for k in _SUMS} | {"audit": [], "sha": hashlib.sha256(), "any": False, "low": None, "high": None, "turns": 0, "outer": ""}

    def done():
        gaps = 0 if found["low"] is None else found["high"] - found["low"] + 1 - found["turns"]
        return key, gaps, *(found[k] for k in _SUMS), "".join(found["audit"]), found["sha"].hexdigest()

    types = _types()
    for batch in batches:
        out, kind = [], batch.column("conv_id").type
        for r in batch.to_pylist():
            if found is None or r["conv_id"] != key:
                out += [done()] if found else []
                key, found = r["conv_id"], begin()
            for k in _SUMS:
                found[k] += r[k]
            found["illegal"] += _illegal(found["outer"][-1:] + r["outer"][:1])
            found["outer"] = r["outer"]
            if r["first_turn"] is not None:
                found["turns"] += r["turns"] - (found["high"] == r["first_turn"])
                found["low"] = r["first_turn"] if found["low"] is None else found["low"]
                found["high"] = r["last_turn"]
            found["audit"].append(r["audit"])
            for role, text in zip(r["roles"], r["texts"]):
                found["sha"].update((b"\n" if found["any"] else b"") + f"{role}:{text}".encode())
                found["any"] = True
        yield _batch(out, ["conv_id", *_DIGEST], [kind, *types(_DIGEST)])
    if found:
        yield _batch([done()], ["conv_id", *_DIGEST], [kind, *types(_DIGEST)])


def digest(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows``, from the parts that ``repair`` returns: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256 (of ``role:text`` lines).

    The hash of a text can't be put together from its parts', so the parts of a conversation that has several are read in
    turn by one task, which keeps the running hash and the audit."""
    message = F.transform(F.arrays_zip("roles", "texts"), lambda r: F.concat(r["roles"], F.lit(":"), r["texts"]))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    whole = parts.filter("whole").select("conv_id", gaps.alias("gaps"), *_SUMS, "audit", F.sha2(F.array_join(message, "\n"), 256).alias("repaired_sha256"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    several = parts.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    found = whole.select("conv_id", *_DIGEST).union(several.mapInArrow(_digested, ", ".join([f"conv_id {kind}", *(f"{k} {v}" for k, v in _DIGEST.items())])))
    ids = rows.select(F.col("conv_id").alias("own_id")).distinct()
    none = {k: F.lit(0) if v == "long" else F.sha2(F.lit(""), 256) if "sha" in k else F.lit("") for k, v in _DIGEST.items()}
    return ids.join(found, F.col("own_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("own_id").alias("conv_id"), *[F.coalesce(F.col(k).cast(v), none[k].cast(v)).alias(k) for k, v in _DIGEST.items()])
