"""Conversation structure repair: least edits that make the turn order legal.

Legal is an optional system turn and then any number of user, assistant pairs
(or nothing at all). Edits: keep a row (0), give it the role that is due (2),
delete it (3), insert an empty turn of the role that is due (2); a truncated
row that stays adds 1, blank and duplicate rows must go. The cheapest edits
come from a Viterbi search over four states: nothing yet, after a system, a
user, an assistant turn. Among equally cheap ones the edits whose initials
(D, I, K, R) are least in ASCII order are taken.

The search is parallel by rank convergence. Rows are put in order by range
partitions and cut into chunks of at most ``CHUNK``. Every chunk first computes
its costs to go from a speculative vector at its right end; then, pass by pass,
a chunk whose right neighbour's vector is not the one it started from plus a
constant is run again, only until old and new vectors differ by a constant.
When no chunk changes, the constants are added up to the true cost, the state
in which each chunk is entered is stitched from left to right, and every chunk
traces its edits by its costs to go, which constants do not alter. Only
chunk summaries (a few numbers) of one conversation ever pass one task.

Defined results: null roles and texts are one space; null turns come first;
rows of one turn are ordered by role, the text's first 64 characters and its
MD5; equal rows stay beside each other and all but the first are duplicates;
a null conversation id is one conversation; a role with another initial than
s, u or a, or none, can only be re-roled or deleted; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType)

from mailsift.llm._store import written

CHUNK_BITS = 12                  # chunks of up to 4,096 rows
SPACES = "\t\n\x0b\x0c\r "
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
DUE = {0: 2, 1: 2, 2: 3, 3: 2}   # the state after the turn that is due
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}
LEGAL = ("su", "ua", "au")
END = (0, 4, 2, 0)               # costs after the last row: the inserts that are still due
TAIL = {0: "", 1: "ua", 2: "a", 3: ""}
ROLES = {2: "user", 3: "assistant"}
# A row's code is a letter: its role initial s, u, a or x, three for each (whole, truncated, must go).
CODES = [(i, kind) for i in "suax" for kind in range(3)]
_CODE = {chr(65 + n): pair for n, pair in enumerate(CODES)}


def _options(code: str, state: int) -> list[tuple[str, str, int, int]]:
    """``(initial, move, cost, next state)`` of the edits that use up a row, in ASCII order."""
    initial, kind = _CODE[code]
    out = [("D", "D", DELETE, state)]
    if kind < 2:
        extra = TRUNCATED if kind == 1 else 0
        if state in KEPT[initial]:
            out.append(("K", "K", KEEP + extra, KEPT[initial][state]))
        due = DUE[state]
        out.append(("R", "U" if due == 2 else "A", REROLE + extra, due))
    return out


# What the two steps below gave before: few (code, state, vector) triples occur.
_SEEN: dict = {}
SEEN_MOST = 1 << 16


def _kept(key: tuple, value):
    if len(_SEEN) >= SEEN_MOST:
        _SEEN.clear()
    _SEEN[key] = value
    return value


def _back(code: str, after: tuple) -> tuple[tuple, int]:
    """Costs to go before a row from those after it: less their minimum, and the minimum."""
    if (code, after) in _SEEN:
        return _SEEN[code, after]
    here = [min(cost + after[to] for _, _, cost, to in _options(code, q)) for q in range(4)]
    for _ in range(2):
        here = [min(here[q], INSERT + here[DUE[q]]) for q in range(4)]
    low = min(here)
    return _kept((code, after), (tuple(x - low for x in here), low))


def _step(code: str, state: int, after: tuple) -> tuple[str, int]:
    """The least moves of cheapest cost through a row, and the state after it."""
    if (code, state, after) in _SEEN:
        return _SEEN[code, state, after]
    here, low = _back(code, after)
    begun, moves = state, ""
    while True:
        want = here[state] + low
        edits = {i: (move, to) for i, move, cost, to in _options(code, state)
                 if cost + after[to] == want}
        if "D" not in edits and INSERT + here[DUE[state]] + low == want:
            state = DUE[state]
            moves += "u" if state == 2 else "a"
            continue
        move, to = edits[min(edits)]
        return _kept((code, begun, after), (moves + move, to))


def _normal(costs) -> tuple[tuple, int]:
    low = min(costs)
    return tuple(x - low for x in costs), low


def run_back(codes: str, right) -> list[int]:
    """Costs to go at the left end of a chunk from those at its right end."""
    vec, total = _normal(right)
    for code in reversed(codes):
        vec, low = _back(code, vec)
        total += low
    return [x + total for x in vec]


def run_again(codes: str, old_right, old_left, right) -> list[int]:
    """As ``run_back``, only until old and new vectors differ by a constant."""
    (old, was), (new, total) = _normal(old_right), _normal(right)
    for code in reversed(codes):
        if old == new:
            return [x + total - was for x in old_left]
        (old, a), (new, b) = _back(code, old), _back(code, new)
        was, total = was + a, total + b
    return [x + total for x in new]


def trace(codes: str, right, state: int) -> tuple[str, int]:
    """Moves of a chunk entered in ``state``, and the state after it.

    Moves: K, D; U, A (re-roled to user, assistant); u, a (inserted before the row).
    """
    vecs = [_normal(right)[0]]
    for code in reversed(codes):
        vecs.append(_back(code, vecs[-1])[0])
    vecs.reverse()
    moves = []
    for code, after in zip(codes, vecs[1:]):
        move, state = _step(code, state, after)
        moves.append(move)
    return "".join(moves), state


def parallel(a: Column, b: Column) -> Column:
    """Whether two cost vectors differ by a constant."""
    return F.forall(F.zip_with(a, b, lambda x, y: x - y), lambda d: d == (a[0] - b[0]))


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("x")


def ordered_rows(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, text_key, pos``, written once; ``pos`` grows with the order.

    Range partitions cut large conversations, and even many equal rows, over tasks.
    """
    clean = rows.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit(" ")).alias("text")) \
        .withColumn("text_key", F.md5("text")).withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
            F.substring("text", 1, 64), F.col("text_key"), F.col("tie")]
    return written(clean.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
                   .withColumn("pos", F.monotonically_increasing_id()), "turns")


def with_faults(turns: DataFrame) -> DataFrame:
    """Adds ``fault`` (blank, duplicate, truncated or null) and ``code``; drops the text."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    facts = turns.select("conv_id", "turn", "role", "text_key", "pos", (bare == "").alias("blank"),
                         (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    seen = (facts.groupBy(F.col("conv_id").alias("of_conv"), F.col("role").alias("of_role"),
                          F.col("text_key").alias("of_text"))
            .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1").drop("n"))
    same = (F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("role") == F.col("of_role"))
            & (F.col("text_key") == F.col("of_text")))
    kind = F.when(F.col("fault").isin("blank", "duplicate"), 2) \
        .when(F.col("fault") == "truncated", 1).otherwise(0)
    number = F.array_position(F.array(*[F.lit(c) for c in "suax"]), _initial(F.col("role"))) - 1
    return (facts.join(seen, same, "left")
            .withColumn("fault", F.when(F.col("blank"), "blank")
                        .when(F.col("pos") > F.col("first"), "duplicate")
                        .when(F.col("cut"), "truncated"))
            .withColumn("code", F.char(65 + number * 3 + kind))
            .select("conv_id", "turn", "pos", "fault", "code"))


def cut_chunks(coded: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """``conv_id, chunk, first_pos, codes``: the row codes of each chunk in order."""
    return (coded.groupBy("conv_id", F.shiftright("pos", bits).alias("chunk"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))
            .select("conv_id", "chunk", F.col("rows")[0]["pos"].alias("first_pos"),
                    F.array_join(F.col("rows.code"), "").alias("codes")))


_COSTS = ArrayType(LongType())


def _mapped(df: DataFrame, keep: list[str], args: list[str], more: list[StructField], fn) -> DataFrame:
    """``keep`` and the fields that ``fn(*args)`` gives for each row."""
    kind = StructType([df.schema[k] for k in keep] + more)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            rows = [fn(*r) for r in zip(*[c.to_pylist() for c in batch.columns[n:]])]
            types = types or [pa.list_(pa.int64()) if isinstance(f.dataType, ArrayType) else
                              pa.string() if isinstance(f.dataType, StringType) else pa.int64()
                              for f in more]
            columns = list(zip(*rows)) if rows else [[] for _ in more]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *[pa.array(list(c), t) for c, t in zip(columns, types)]],
                kind.names)

    return df.select(*keep, *args).mapInArrow(run, kind)


def converge(chunks: DataFrame) -> DataFrame:
    """``conv_id, chunk, n_chunks, right, left, delta``: costs to go at both ends of each chunk.

    ``right`` is the vector the chunk was last run from, ``left`` what came of it;
    the true vector at its right end is ``right`` plus a constant, ``delta``.
    """
    field = [StructField("left", _COSTS)]
    began = _mapped(chunks, ["conv_id", "chunk"], ["codes"], field,
                    lambda codes: (run_back(codes, END),))
    state = written(began.withColumn("right", F.array(*[F.lit(x).cast("long") for x in END])), "costs")
    along = Window.partitionBy("conv_id").orderBy("chunk")
    end = F.array(*[F.lit(x).cast("long") for x in END])
    while True:
        beside = state.withColumn("true", F.coalesce(F.lead("left").over(along), end))
        wrong = ~parallel(F.col("true"), F.col("right"))
        if beside.filter(wrong).isEmpty():
            return beside.withColumn("delta", F.col("true")[0] - F.col("right")[0]).drop("true")
        odd = beside.filter(wrong).select(F.col("conv_id").alias("of_conv"),
                                          F.col("chunk").alias("of_chunk"), "right", "left", "true")
        same = (F.col("chunk") == F.col("of_chunk")) & F.col("conv_id").eqNullSafe(F.col("of_conv"))
        again = _mapped(odd.join(chunks, same).drop("of_conv", "of_chunk")
                        .withColumnRenamed("left", "old"), ["conv_id", "chunk", "true"],
                        ["codes", "right", "old", "true"], field,
                        lambda *a: (run_again(*a),))
        state = written(beside.filter(~wrong).select("conv_id", "chunk", "left", "right").unionByName(
            again.withColumnRenamed("true", "right")), "costs")


def _crossed(a: str, b: str) -> int:
    return int(_CODE[a][0] + _CODE[b][0] not in LEGAL)


def _ends(codes: str, right) -> tuple:
    """End state for each entry state, first and last row code, illegal neighbours inside."""
    return ([trace(codes, right, q)[1] for q in range(4)], codes[0], codes[-1],
            sum(_crossed(a, b) for a, b in zip(codes, codes[1:])))


def _stitch(ends: DataFrame) -> DataFrame:
    """``conv_id, chunk, entry, joint``: the state in which each chunk is entered, and whether
    its first row and the row before it are illegal neighbours. Rows stream by in order."""
    kind = StructType([ends.schema["conv_id"], ends.schema["chunk"], StructField("entry", LongType()),
                       StructField("joint", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began, at, state, last = False, None, 0, ""
        for batch in batches:
            entry, joint = [], []
            for conv, to, first, final in zip(*[batch.column(i).to_pylist() for i in (0, 2, 3, 4)]):
                if not began or conv != at:
                    began, at, state, last = True, conv, 0, ""
                entry.append(state)
                joint.append(_crossed(last, first) if last else 0)
                state, last = to[state], final
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(entry, pa.int64()),
                 pa.array(joint, pa.int64())], kind.names)

    lined = ends.select("conv_id", "chunk", "ends", "first", "final").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "chunk")
    return lined.mapInArrow(run, kind)


def edit_chunks(chunks: DataFrame) -> DataFrame:
    """Per chunk: its moves (and the inserts after the last row), cost share and illegal pairs.

    ``conv_id, chunk, first_pos, moves, tail, cost, illegal``; costs and counts of a
    conversation are the sums over its chunks.
    """
    on = ["of_conv", "of_chunk"]
    same = (F.col("chunk") == F.col("of_chunk")) & F.col("conv_id").eqNullSafe(F.col("of_conv"))

    def beside(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(F.col("conv_id").alias("of_conv"), F.col("chunk").alias("of_chunk"), *columns)

    ahead = Window.partitionBy("conv_id").orderBy("chunk")
    costs = converge(chunks).withColumn("is_last", F.lead("chunk").over(ahead).isNull())
    facts = written(_mapped(
        chunks.join(beside(costs, "right", "left", "delta", "is_last"), same).drop(*on)
        .withColumn("is_last", F.col("is_last").cast("long")),
        ["conv_id", "chunk", "first_pos", "codes", "right", "left", "delta", "is_last"],
        ["codes", "right"], [StructField("ends", _COSTS), StructField("first", StringType()),
                             StructField("final", StringType()), StructField("inside", LongType())],
        _ends), "ends")
    entered = facts.join(beside(_stitch(facts), "entry", "joint"), same).drop(*on)
    first = F.lag("chunk").over(ahead).isNull()
    whole = written(_mapped(
        entered, ["conv_id", "chunk", "first_pos", "left", "delta", "is_last", "inside", "joint"],
        ["codes", "right", "entry"], [StructField("moves", StringType()),
                                      StructField("state", LongType())], trace), "edits")
    tail = F.element_at(F.create_map(*[F.lit(x) for p in TAIL.items() for x in p]),
                        F.col("state").cast("int"))
    return whole.select(
        "conv_id", "chunk", "first_pos", "moves",
        F.when(F.col("is_last") == 1, tail).otherwise("").alias("tail"),
        (F.col("delta") + F.when(first, F.col("left")[0]).otherwise(0)).alias("cost"),
        (F.col("inside") + F.col("joint")).alias("illegal"))


def audits(edits: DataFrame) -> DataFrame:
    """``conv_id, illegal, cost, audit`` per conversation."""
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "chunk", F.concat("moves", "tail").alias("moves")))), lambda c: c["moves"]), "")
    return edits.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.translate(whole, "uaUA", "IIRR").alias("audit"))


def repaired_rows(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """``conv_id, pos, place, edit, role, text``: what the repaired conversations consist of."""
    steps = F.regexp_extract_all("moves", F.lit("[ua]*[KUAD]"), 0)
    moves = edits.select("first_pos", F.posexplode(F.transform(
        steps, lambda s, i: F.when(i == F.size(steps) - 1, F.concat(s, F.col("tail"))).otherwise(s)))
        .alias("at", "step")).select((F.col("first_pos") + F.col("at")).alias("of_pos"), "step")

    def line(m: Column) -> Column:
        role = F.when(m == "K", F.col("role")).when(F.lower(m) == "u", "user").otherwise("assistant")
        added = m.isin("u", "a")
        return F.struct(F.when(added, "insert").when(m == "K", "keep").otherwise("rerole").alias("edit"),
                        role.alias("role"), F.when(added, "").otherwise(F.col("text")).alias("text"))

    kept = F.filter(F.split("step", ""), lambda m: (m != "D") & (m != ""))
    return (turns.join(moves, F.col("pos") == F.col("of_pos"))
            .select("conv_id", "pos", F.posexplode(F.transform(kept, line)).alias("place", "line"))
            .select("conv_id", "pos", "place", "line.*"))


def line_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha256`` over ``role:text`` lines joined by newlines.

    A digest has to see a conversation in order: its rows stream through one
    task, one at a time, and are never gathered.
    """
    kind = StructType([repaired.schema["conv_id"], StructField("sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began, at, digest, id_type = False, None, None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([at], id_type),
                                               pa.array([digest.hexdigest()])], kind.names)

        for batch in batches:
            id_type = batch.column(0).type
            ids, hashes = [], []
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if began and conv == at:
                    digest.update(b"\n")
                else:
                    if began:
                        ids.append(at)
                        hashes.append(digest.hexdigest())
                    began, at, digest = True, conv, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(hashes, pa.string())],
                                             kind.names)
        if began:
            yield row()

    return (repaired.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "place")
            .select("conv_id", "role", "text").mapInArrow(run, kind))


def fault_counts(coded: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated`` per conversation."""
    count = lambda fault: F.count(F.when(F.col("fault") == fault, 1)).alias(fault)
    gaps = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    return coded.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
                                        *[count(f) for f in ("blank", "duplicate", "truncated")])


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", bits: int = CHUNK_BITS) -> tuple[DataFrame, DataFrame]:
    """``(report, repaired)``: counts, cost and audit per conversation; the repaired rows."""
    turns = ordered_rows(rows, id_col, turn_col, role_col, text_col)
    coded = written(with_faults(turns), "faults")
    edits = written(edit_chunks(written(cut_chunks(coded, bits), "chunks")), "moves")
    audit = audits(edits).withColumnRenamed("conv_id", "of_conv")
    report = fault_counts(coded).join(audit, F.col("conv_id").eqNullSafe(F.col("of_conv"))) \
        .drop("of_conv")
    return report, repaired_rows(turns, edits)
