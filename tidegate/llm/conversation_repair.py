"""Repair of conversations: the cheapest edits that make roles alternate, in parallel along long ones.

A row is blank, a duplicate (role and text seen earlier in the conversation), truncated (no
closing mark at its end), or sound. Keep costs 0, a change of role 3, deletion 4 (required for
blank rows and duplicates), insertion of an empty turn 3, and a truncated row that stays 3.
The initials of the roles must come out as ``(s?(ua)+)?``: a machine of four states (start,
after s, after u, after a), so a row maps the costs to go behind it, one for each state, to
those before it (Viterbi in min-plus algebra), and rows forget: costs that start
differently soon differ by a constant only.

A conversation is cut into chunks of ``CHUNK`` rows. Every chunk runs backwards from speculative
costs behind it, those of an end; then, pass by pass, the chunks whose right neighbour
came out otherwise than assumed, beyond a constant, run again from what it came out as. Constants are
summed up along the conversation. Of those conversations that do not settle within ``PASSES``
(rows of one role, say, where costs depend on the parity of what follows), the transfer
matrices of the chunks are multiplied in doubling steps, which gives the costs behind every
chunk, and they run once more from these.

With the costs to go, the least of the cheapest audits is traced forwards, at each step the first letter
that stays cheapest; a chunk traces from all four states, and doubling steps join what the states lead to.
Every step works on chunks or rows, never on a whole conversation; only the digest of a conversation, which is
sequential by its definition, streams its rows through one task, in bounded memory.

Defined results: NULL roles and texts are one space; rows with a NULL turn come first; rows of one
turn stay in the table's order; rows with a NULL id are one conversation; repeated rows are
duplicates; an empty table gives an empty result; other columns are ignored, whatever their names.
Rows count as duplicates if 128 bits of hash of role and text are equal.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import GROUP_ROWS, SEQ, number_rows
from .common import ROW, SPACES, Workspace, keyed_rows

#: Rows of a chunk; passes before the transfer matrices are multiplied.
CHUNK, PASSES = 1024, 6
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States: nothing yet, after s, after u, after a.
_START, _S, _U, _A = range(4)
#: The role a row is changed to, or an inserted turn has, leads to this state.
_FORCED = (_U, _U, _A, _U)
_KEEP = {"s": {_START: _S}, "u": {_START: _U, _S: _U, _A: _U}, "a": {_U: _A}, "x": {}}
#: Costs to go at the end of a conversation.
_END = (0, 2 * INSERT, INSERT, 0)
_NEVER = 1 << 40
#: Kinds of rows, a letter each: role initial (x: another) by sound, truncated, must go.
_INITIALS, _KINDS = "suax", "abcdefghijkl"


class Machine:
    """Costs and moves by kind of row and costs to go, worked out once; costs to go are numbered
    after their least is taken off, of which there are few."""

    def __init__(self):
        self.costs: list[tuple[int, ...]] = []
        self._numbers: dict[tuple[int, ...], int] = {}
        self._steps: dict[tuple[int, str], tuple[int, int]] = {}
        self._moves: dict[tuple[int, str, int], tuple[str, int]] = {}

    def number(self, costs) -> tuple[int, int]:
        """The number of some costs, and the least of them."""
        least = min(costs)
        key = tuple(_NEVER if c >= _NEVER // 2 else c - least for c in costs)
        if key not in self._numbers:
            self._numbers[key] = len(self.costs)
            self.costs.append(key)
        return self._numbers[key], least

    @staticmethod
    def _taken(right, kind: str, state: int) -> dict[str, tuple[int, int]]:
        """Ways to take the row in a state: cost to go and next state."""
        initial, fault = _INITIALS[_KINDS.index(kind) // 3], _KINDS.index(kind) % 3
        ways = {"D": (DELETE + right[state], state)}
        if fault < 2:
            extra = TRUNCATED * fault
            if state in _KEEP[initial]:
                after = _KEEP[initial][state]
                ways["K"] = (extra + right[after], after)
            after = _FORCED[state]
            ways["R"] = (REROLE + extra + right[after], after)
        return ways

    def _before(self, right, kind: str) -> list[int]:
        """Costs to go before the row, with insertions before it."""
        out = [min(c for c, _ in self._taken(right, kind, state).values()) for state in range(4)]
        for state in (_U, _A, _START, _S):      # u and a lead to each other, a second insertion never pays
            out[state] = min(out[state], INSERT + out[_FORCED[state]])
        return out

    def step(self, right: int, kind: str) -> tuple[int, int]:
        key = right, kind
        if key not in self._steps:
            self._steps[key] = self.number(self._before(self.costs[right], kind))
        return self._steps[key]

    def move(self, right: int, kind: str, state: int) -> tuple[str, int]:
        """What becomes of the row, and the state behind it.

        A letter for each turn inserted before it (u, a), then K, D, or U, A for a change of role.
        """
        key = right, kind, state
        if key not in self._moves:
            costs, code = self.costs[right], ""
            before = self._before(costs, kind)
            while True:
                ways = self._taken(costs, kind, state)
                if ways["D"][0] == before[state]:
                    way = "D"
                elif INSERT + before[_FORCED[state]] == before[state]:
                    state = _FORCED[state]
                    code += "ua"[state == _A]
                    continue
                else:
                    way = "K" if "K" in ways and ways["K"][0] == before[state] else "R"
                state = ways[way][1]
                code += way if way != "R" else "UA"[state == _A]
                break
            self._moves[key] = code, state
        return self._moves[key]

    def back(self, kinds: str, right) -> tuple[list[int], int]:
        """Numbers of the costs to go before each row and behind the last, and the constant taken off."""
        number, total = self.number(right)
        path = [number]
        for kind in reversed(kinds):
            number, least = self.step(number, kind)
            total += least
            path.append(number)
        return path[::-1], total

    def trace(self, kinds: str, path: list[int], state: int) -> tuple[list[str], int]:
        codes = []
        for kind, right in zip(kinds, path[1:]):
            code, state = self.move(right, kind, state)
            codes.append(code)
        return codes, state


def _tail(state: int) -> str:
    """Turns inserted at the end of a conversation."""
    return {_S: "ua", _U: "a"}.get(state, "")


def _map(df: DataFrame, step, schema: str) -> DataFrame:
    """``step(machine, row)`` for every row, as tuples of the columns behind conv and no."""
    fields = [c.split() for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}

    def run(batches):
        machine = Machine()
        for batch in batches:
            names = batch.schema.names
            rows = [step(machine, dict(zip(names, row)))
                    for row in zip(*[c.to_pylist() for c in batch.columns])]
            columns = list(zip(*rows)) if rows else [[]] * (len(fields) - 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("no")]
                + [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields[2:])], [n for n, _ in fields])

    return df.mapInArrow(run, schema)


_COSTS = ("conv string, no long, last boolean, kinds string, right array<long>, left array<long>, "
          "least long, again boolean")


def _costs_step(machine: Machine, row: dict) -> tuple:
    """Run a chunk backwards unless it ran from the same costs before."""
    if row["right"] == row["behind"]:
        return row["last"], row["kinds"], row["right"], row["left"], row["least"], False
    path, least = machine.back(row["kinds"], row["behind"])
    return row["last"], row["kinds"], row["behind"], list(machine.costs[path[0]]), least, True


def _numbers(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _neighbour(df: DataFrame, by: int, column: str, name: str) -> DataFrame:
    """The column of the chunk ``by`` places further on, NULL beyond the conversation."""
    other = df.select("conv", (F.col("no") - by).alias("no"), F.col(column).alias(name))
    return df.join(other, ["conv", "no"], "left")


def _settled(ws: Workspace, chunks: DataFrame) -> DataFrame:
    """Costs to go behind and before every chunk."""
    cur = ws.keep(_map(chunks.withColumn("right", F.lit(None).cast("array<long>"))
                       .withColumn("left", F.lit(None).cast("array<long>")).withColumn("least", F.lit(0).cast("long"))
                       .withColumn("behind", _numbers(_END)), _costs_step, _COSTS), "speculative")
    alone = cur.where("last and no = 0")
    cur = cur.where("not (last and no = 0)")
    if cur.isEmpty():
        return alone
    for _ in range(PASSES):
        beside = _neighbour(cur.drop("again"), 1, "left", "next")
        cur = ws.keep(_map(beside.withColumn("behind", F.coalesce("next", "right")), _costs_step, _COSTS), "pass")
        if cur.where("again").isEmpty():
            return alone.unionByName(cur)
    # Some conversations may go on changing: the costs behind their chunks by transfer matrices.
    open_ = ws.keep(cur.where("again").select("conv").distinct(), "open")
    matrices = ws.keep(_map(cur.join(open_, "conv", "left_semi").select("conv", "no", "last", "kinds"),
                            _matrix_step, "conv string, no long, matrix array<long>"), "matrices")
    for by in _doublings(matrices):
        matrices = ws.keep(_map(_neighbour(matrices, by, "matrix", "next"), _product_step,
                                "conv string, no long, matrix array<long>"), "matrices")
    behind = _map(matrices, _row_step, "conv string, no long, left array<long>").select(
        "conv", (F.col("no") - 1).alias("no"), F.col("left").alias("known"))
    cur = cur.drop("again").join(behind, ["conv", "no"], "left")
    return alone.unionByName(ws.keep(_map(
        cur.withColumn("behind", F.coalesce("known", "right")), _costs_step, _COSTS), "settled"))


def _doublings(chunks: DataFrame):
    """1, 2, 4, .. below the most chunks of a conversation."""
    most, by = chunks.agg(F.max("no")).first()[0] or 0, 1
    while by <= most:
        yield by
        by *= 2


def _matrix_step(machine: Machine, row: dict) -> tuple:
    """Cost from each state before the chunk to each state behind it, row by row; the end is part of the last."""
    if row["last"]:
        path, least = machine.back(row["kinds"], _END)
        return ([c + least for s in range(4) for c in [machine.costs[path[0]][s]] * 4],)
    columns = []
    for state in range(4):
        path, least = machine.back(row["kinds"], [0 if s == state else _NEVER for s in range(4)])
        columns.append([min(c + least, _NEVER) for c in machine.costs[path[0]]])
    return ([columns[t][s] for s in range(4) for t in range(4)],)


def _product_step(machine: Machine, row: dict) -> tuple:
    a, b = row["matrix"], row["next"]
    if b is None:
        return (a,)
    return ([min(_NEVER, *(a[4 * s + k] + b[4 * k + t] for k in range(4))) for s in range(4) for t in range(4)],)


def _row_step(machine: Machine, row: dict) -> tuple:
    """The product up to the end holds the cost to go in every column."""
    number, _ = machine.number(row["matrix"][::4])
    return (list(machine.costs[number]),)


def _leads_step(machine: Machine, row: dict) -> tuple:
    """The state behind the chunk for each state before it."""
    path, _ = machine.back(row["kinds"], row["right"])
    return ([machine.trace(row["kinds"], path, state)[1] for state in range(4)],)


def _trace_step(machine: Machine, row: dict) -> tuple:
    path, _ = machine.back(row["kinds"], row["right"])
    codes, state = machine.trace(row["kinds"], path, row["state"])
    return codes, _tail(state) if row["last"] else ""


def _traced(ws: Workspace, costs: DataFrame) -> DataFrame:
    """conv, no, codes (one a row), tail."""
    schema = "conv string, no long, codes array<string>, tail string"
    alone = costs.where("last and no = 0").withColumn("state", F.lit(_START))
    many = costs.where("not (last and no = 0)")
    out = _map(alone.select("conv", "no", "last", "kinds", "right", "state"), _trace_step, schema)
    if many.isEmpty():
        return ws.keep(out, "codes")
    leads = ws.keep(_map(many.select("conv", "no", "kinds", "right"), _leads_step,
                         "conv string, no long, leads array<int>"), "leads")
    for by in _doublings(leads):        # the states from the beginning to behind each chunk
        leads = ws.keep(_neighbour(leads, -by, "leads", "earlier").select(
            "conv", "no", F.expr("if(earlier is null, leads, transform(earlier, s -> leads[s]))").alias("leads")), "leads")
    entered = leads.select("conv", (F.col("no") + 1).alias("no"), F.col("leads")[_START].alias("state"))
    many = many.join(entered, ["conv", "no"], "left").withColumn("state", F.coalesce("state", F.lit(_START)))
    return ws.keep(out.unionByName(_map(many.select("conv", "no", "last", "kinds", "right", "state"),
                                        _trace_step, schema)), "codes")


def _conv_key(column: Column) -> Column:
    """An id as text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _illegal(initials: str) -> str:
    return f"not ({initials} in ('su', 'ua', 'au'))"


def _letters(column: str) -> Column:
    return F.expr(f"transform(sequence(1, length({column})), i -> substring({column}, i, 1))")


@dataclass
class Repair:
    """``turns``: conv_id, conv (the id as text), seq, sub, role, text in the order of seq and sub;
    ``report``: conv_id, conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""

    turns: DataFrame
    report: DataFrame


def repair_conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> Repair:
    ws = Workspace(df.sparkSession, "repair")
    rows = keyed_rows(ws, df, conv_id=df[id_col], conv=_conv_key(df[id_col]), turn=df[turn_col].cast("long"),
                      role=F.coalesce(df[role_col], F.lit(" ")), text=F.coalesce(df[text_col], F.lit(" ")))
    ended = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv", "turn", ROW, (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"))
    numbered = ws.keep(number_rows(narrow, ["conv"], ["turn", ROW], ws.folder("numbered")), "rows")
    first = numbered.where("not blank").groupBy("conv", "h1", "h2").agg(F.min(SEQ).alias(SEQ)).select(
        "conv", SEQ, F.lit(True).alias("first"))
    faults = ws.keep(numbered.join(first, ["conv", SEQ], "left").select(
        "conv", SEQ, GROUP_ROWS, "turn", ROW, "initial",
        F.expr("case when blank then 'blank' when first is null then 'duplicate' when cut then 'truncated' end")
        .alias("fault")), "faults")
    kind = F.substring(F.lit(_KINDS), F.expr(
        f"3 * locate(initial, '{_INITIALS}') - 2 + case fault when 'truncated' then 1 when 'blank' then 2 "
        "when 'duplicate' then 2 else 0 end"), F.lit(1))
    chunks = faults.withColumn("kind", kind).groupBy("conv", F.expr(f"{SEQ} div {CHUNK}").alias("no")).agg(
        F.sort_array(F.collect_list(F.struct(SEQ, "kind", "initial", ROW))).alias("rows"),
        F.max(GROUP_ROWS).alias("n"))
    chunks = ws.keep(chunks.select(
        "conv", "no", F.expr(f"no = (n - 1) div {CHUNK}").alias("last"), F.expr("array_join(rows.kind, '')").alias("kinds"),
        F.expr("array_join(rows.initial, '')").alias("initials"), F.expr(f"rows.{ROW}").alias("keys")), "chunks")

    costs = _settled(ws, chunks.select("conv", "no", "last", "kinds"))
    codes = _traced(ws, costs)
    total = costs.groupBy("conv").agg(
        (F.sum("least") + F.max(F.expr(f"if(no = 0, left[{_START}], null)"))).alias("cost"))
    audits = codes.groupBy("conv").agg(F.expr(
        "array_join(transform(array_sort(collect_list(struct(no, translate(concat(array_join(codes, ''), tail), "
        "'uaUA', 'IIRR') as audit))), c -> c.audit), '')").alias("audit"))
    inside = chunks.select("conv", F.expr(
        f"size(filter(sequence(1, length(initials)), i -> i > 1 and {_illegal('substring(initials, i - 1, 2)')}))"
    ).cast("long").alias("illegal"))
    ends = chunks.select("conv", "no", F.expr("right(initials, 1)").alias("end"))
    across = chunks.where("no > 0").select("conv", (F.col("no") - 1).alias("no"), F.expr("left(initials, 1)").alias("begin"))
    across = across.join(ends, ["conv", "no"]).where(_illegal("concat(end, begin)")).select(
        "conv", F.lit(1).cast("long").alias("illegal"))
    illegal = inside.unionByName(across).groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    counts = faults.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    ids = rows.groupBy("conv").agg(F.min("conv_id").alias("conv_id"))
    report = ids
    for part in (counts, illegal, total, audits):
        report = report.join(part, "conv")

    coded = chunks.select("conv", "no", "keys").join(codes, ["conv", "no"]).select(
        "conv", "no", F.posexplode(F.arrays_zip("keys", "codes")).alias("at", "row")).select(
            "conv", (F.col("no") * CHUNK + F.col("at")).alias("seq"), F.col("row.keys").alias(ROW),
            F.col("row.codes").alias("code"))
    # Joined through the key of the row, of which there is one each.
    done = rows.select("conv_id", ROW, "role", "text").join(coded.where("code <> 'D'"), ROW)
    # A turn for each letter of the code; the last letter says what becomes of the row itself.
    named = "case lower(letter) when 'u' then 'user' when 'a' then 'assistant' else role end"
    turns = done.select("conv_id", "conv", "seq", "role", "text", F.posexplode(_letters("code")).alias("sub", "letter")) \
        .where("letter <> 'D'").select(
            "conv_id", "conv", "seq", "sub", F.expr(named).alias("role"),
            F.expr("if(letter in ('u', 'a'), '', text)").alias("text"))
    tails = codes.where("tail <> ''").join(ids, "conv").select(
        "conv_id", "conv", F.lit(None).cast("string").alias("role"),
        F.posexplode(_letters("tail")).alias("sub", "letter")).select(
            "conv_id", "conv", F.lit((1 << 62)).alias("seq"), "sub", F.expr(named).alias("role"), F.lit("").alias("text"))
    return Repair(turns.unionByName(tails), report)


def digests(turns: DataFrame) -> DataFrame:
    """conv, repaired_sha256: of the turns as ``role:text``, newline-joined.

    A digest is sequential: a conversation's rows stream through one task, sorted, a batch at a time.
    """
    def run(batches):
        name, state = None, None
        for batch in batches:
            out = []
            for conv, role, text in zip(batch.column("conv"), batch.column("role"), batch.column("text")):
                conv, line = conv.as_py(), f"{role.as_py()}:{text.as_py()}".encode()
                if conv != name:
                    if state is not None:
                        out.append((name, state.hexdigest()))
                    name, state = conv, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["conv", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([state.hexdigest()], pa.string())], ["conv", "repaired_sha256"])

    dealt = turns.repartition("conv").sortWithinPartitions("conv", "seq", "sub")
    return dealt.select("conv", "role", "text").mapInArrow(run, "conv string, repaired_sha256 string")


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by the checksum of id and turn: rows that are dropped,
    emptied, stripped of closing marks, repeated, or given the role user."""
    def text(column):
        return F.coalesce(df[column].cast("string"), F.lit(" "))

    fault = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("fault")
    rows = df.select(df["conv_id"], df["turn"], text("role").alias("role"), text("text").alias("text"), fault)
    return rows.where("fault <> 0").select(
        "conv_id", "turn", F.expr("if(fault = 4, 'user', role)").alias("role"),
        F.expr("case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end").alias("text"),
        F.explode(F.expr("if(fault = 3, array(0, 1), array(0))")).alias("copy")).drop("copy")


def repair_damaged(df: DataFrame) -> DataFrame:
    """What the repair of the damaged rows did, for every conversation of the table."""
    repair = repair_conversations(damaged(df))
    ids = df.select(df["conv_id"].alias("conv_id")).distinct().withColumn("conv", _conv_key(F.col("conv_id")))
    out = ids.join(repair.report.drop("conv_id"), "conv", "left").join(digests(repair.turns), "conv", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
