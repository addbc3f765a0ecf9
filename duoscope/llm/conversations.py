"""Conversations whose rows went missing or wrong, repaired with the cheapest edits.

A row is *blank* (no visible character), a *duplicate* (role and text stand earlier in the
conversation) or *truncated* (its last visible character ends no sentence); its first such fault
counts. Edits turn the sequence of role initials into ``(s?(ua)+)?``: Keep costs 0, Rerole (to
user or assistant) 3, Delete 4 (blank and duplicate rows must go), Insert (an empty user or
assistant row) 3; a truncated row that stays costs 3 more. Of the cheapest edits those count
whose initials, in order, are least by ASCII.

*Hirschberg's division.* What stands so far is one of four states: nothing, after s, after u,
after a; from a state, an edit leads to one state. To recover the edits of a stretch between two
states, costs run forward to its middle from the left state and backward from the right one, four
numbers each; the crossing is the state of least sum, and both halves follow by recursion. So no
table of moves is kept: memory is linear in the stretch (its letters), whatever its length. Ties:
the forward pass also ranks, among the four states, the least edits that lead there. An insert
belongs to the row after it, so two such strings have as many rows' letters and part before one
of them ends; the rank of the prefix decides, and the crossing of least rank is the audit's.

*Long conversations.* The same division works on blocks. Rows are ordered by range of
(conversation, turn), so a conversation spans as many tasks as it needs, and stand in blocks of at
most ``BLOCK`` rows. A block is summarised by the least cost and the rank from each state to each
state; summaries compose. One aggregation brings the summaries of a conversation in one
partition together, one more those of its partitions; there the crossings between partitions are
chosen, then those between blocks, then the edits of each block, in parallel. First places of
texts are found by an aggregation over (conversation, digest of role and text), and what meets again
per block is bounded by the block. No task takes the rows of a conversation together, except that
``digests`` hashes its repaired text as a stream, since SHA-256 has no other order.

Defined results: null role or text count as one space, so such a row is blank or has no usable
role; null turns come first; rows of one turn stand by role, then by the SHA-256 of the text, so repeated
rows are neighbours; very long texts go whole, in blocks of fewer rows; null ids are a
conversation; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from duoscope.llm.common import cut, pick, prepare

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows and bytes of text after which a block ends (a row at least).
BLOCK, BLOCK_BYTES = 512, 1 << 20
#: States: nothing out yet, after s, after u, after a.
START, S, U, A = range(4)
_INF = 1 << 40
#: Least inserts from a state to a state: START and S lead to U, U to A, A to U.
_FILL = {START: {START: 0, U: 1, A: 2}, S: {S: 0, U: 1, A: 2}, U: {U: 0, A: 1}, A: {A: 0, U: 1}}
#: Inserts that complete the sequence, from each state.
_TAIL = {START: 0, S: 2, U: 1, A: 0}
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: A row's letter: its role's initial, or x for one that can't stay; upper case if truncated; D if
#: it must go.
_GONE = "D"


def _edits(letter: str, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, initial, next state) of each edit of a row."""
    yield DELETE, "D", state
    if letter == _GONE:
        return
    more = TRUNCATED if letter.isupper() else 0
    role = letter.lower()
    if role == "s" and state == START:
        yield KEEP + more, "K", S
    if role == "u" and state != U:
        yield KEEP + more, "K", U
    if role == "a" and state == U:
        yield KEEP + more, "K", A
    yield REROLE + more, "R", A if state == U else U


def _least_steps(letter: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(from, to): the least cost and initials of inserts and then the row's edit."""
    least: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        for middle, n in _FILL[start].items():
            for cost, initial, end in _edits(letter, middle):
                found = (cost + INSERT * n, "I" * n + initial)
                least[start, end] = min(found, least.get((start, end), found))
    return least


_STEP = {letter: _least_steps(letter) for letter in "suaxSUAXD"}

#: Costs and ranks of ways from one state: [(cost, rank)] by the state they lead to.
Vector = list[tuple[int, int]]


def _ranked(found: list[tuple[int, object] | None]) -> Vector:
    """(cost, key) by state to (cost, rank of key); keys of states that can't be reached last."""
    order = sorted(i for i in range(4) if found[i] is not None)
    order.sort(key=lambda i: found[i][1])
    rank = {i: r for r, i in enumerate(order)}
    return [(found[i][0], rank[i]) if i in rank else (_INF, 9) for i in range(4)]


def _forward(vector: Vector, letter: str) -> Vector:
    """The least cost, and the least audit's rank, to each state after one row more."""
    out = [None] * 4
    for (start, end), (cost, initials) in _STEP[letter].items():
        if vector[start][0] < _INF:
            # Of equal costs the least prefix, then the least letters.
            found = (vector[start][0] + cost, (vector[start][1], initials))
            if out[end] is None or found < out[end]:
                out[end] = found
    return _ranked(out)


def _backward(costs: list[int], letter: str) -> list[int]:
    out = [_INF] * 4
    for (start, end), (cost, _) in _STEP[letter].items():
        out[start] = min(out[start], cost + costs[end])
    return out


def _unit(state: int) -> Vector:
    return [(0, 0) if i == state else (_INF, 9) for i in range(4)]


def _crossing(vector: Vector, costs: list[int]) -> int:
    """Of the cheapest crossings the one with the audit-least way to it."""
    return min((vector[i][0] + costs[i], vector[i][1], i) for i in range(4))[2]


def audit_between(letters: str, start: int, end: int) -> str:
    """The least of the cheapest edits that lead through all rows from a state to a state."""
    if len(letters) <= 1:
        return _STEP[letters][start, end][1] if letters else ""
    middle = len(letters) // 2
    vector, costs = _unit(start), [0 if i == end else _INF for i in range(4)]
    for letter in letters[:middle]:
        vector = _forward(vector, letter)
    for letter in reversed(letters[middle:]):
        costs = _backward(costs, letter)
    crossing = _crossing(vector, costs)
    return (audit_between(letters[:middle], start, crossing)
            + audit_between(letters[middle:], crossing, end))


#: The ways through a stretch: one vector for each state it is entered in.
Summary = list[Vector]


def summary(letters: str) -> Summary:
    out = []
    for start in range(4):
        vector = _unit(start)
        for letter in letters:
            vector = _forward(vector, letter)
        out.append(vector)
    return out


def _through(vector: Vector, stretch: Summary) -> Vector:
    """``_forward`` over a whole stretch."""
    out = [None] * 4
    for end in range(4):
        for start in range(4):
            if vector[start][0] < _INF and stretch[start][end][0] < _INF:
                found = (vector[start][0] + stretch[start][end][0], (vector[start][1], stretch[start][end][1]))
                if out[end] is None or found < out[end]:
                    out[end] = found
    return _ranked(out)


def compose(stretches: list[Summary]) -> Summary:
    out = []
    for start in range(4):
        vector = _unit(start)
        for stretch in stretches:
            vector = _through(vector, stretch)
        out.append(vector)
    return out


def crossings(stretches: list[Summary], start: int, end: int) -> list[int]:
    """The state after each stretch, the last one's being ``end``: divided like the rows."""
    if len(stretches) <= 1:
        return [end] * len(stretches)
    middle = len(stretches) // 2
    vector, costs = _unit(start), [0 if i == end else _INF for i in range(4)]
    for stretch in stretches[:middle]:
        vector = _through(vector, stretch)
    for stretch in reversed(stretches[middle:]):
        costs = [min(stretch[i][j][0] + costs[j] for j in range(4)) for i in range(4)]
    crossing = _crossing(vector, costs)
    return crossings(stretches[:middle], start, crossing) + crossings(stretches[middle:], crossing, end)


def finish(whole: Summary) -> tuple[int, int]:
    """(least cost, state after the last row) of a conversation with rows; inserts may follow."""
    vector = whole[START]
    end = _crossing(vector, [INSERT * _TAIL[i] for i in range(4)])
    return vector[end][0] + INSERT * _TAIL[end], end


def repaired(roles: list[str], texts: list[str], audit: str, state: int) -> list[tuple[str, str]]:
    """(role, text) that the edits leave."""
    out, i = [], 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            out.append((roles[i], texts[i]))
            state = {"s": S, "u": U, "a": A}[roles[i][0]]
        else:
            state = A if state == U else U
            out.append(("user" if state == U else "assistant", "" if edit == "I" else texts[i]))
        i += edit != "I"
    return out


# ------------------------------------------------------------------ Spark

def damaged(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv, turn, role, text after reproducible damage by crc32(``conv:turn``) % 20.

    0 drops a row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 sets its role to user. Nulls
    count as one space (turns stay null besides the key).
    """
    df = pick(convs, conv=conv_col, turn=turn_col, role=role_col, text=text_col)

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    df = df.select("conv", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                   (F.crc32(F.concat(spaced("conv"), F.lit(":"), spaced("turn"))) % 20).alias("kind"))
    kind = F.col("kind")
    return df.where("kind <> 0").select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows of (conv, turn, role, text) in order, in blocks; written once.

    ``block`` is the place of the block's first row among all rows; ``part`` the partition that holds it.
    """
    keys = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("hash"),
            F.col("row")]
    dealt = (rows.select("conv", F.col("turn").cast("long").alias("turn"), "role", "text",
                         F.sha2("text", 256).alias("hash"), F.monotonically_increasing_id().alias("row"))
             .repartitionByRange(*keys).sortWithinPartitions(*keys)
             .withColumn("row", F.monotonically_increasing_id()))
    schema = T.StructType([
        rows.schema["conv"], T.StructField("block", T.LongType()), T.StructField("letters", T.StringType()),
        T.StructField("blank", T.LongType()), T.StructField("illegal", T.LongType()),
        T.StructField("turns", T.LongType()), T.StructField("least", T.LongType()),
        T.StructField("greatest", T.LongType()), T.StructField("keys", T.ArrayType(T.BinaryType())),
        T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("texts", T.ArrayType(T.StringType()))])

    def block(conv, first: int, rows: list[tuple]) -> dict:
        letters, keys, roles, texts, blank = [], [], [], [], 0
        for _, role, text in rows:
            last = text.rstrip(_SPACE)[-1:]
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters.append(_GONE if not last else letter if last in ".!?" else letter.upper())
            blank += not last
            keys.append(None if not last else
                        hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())
            roles.append(role)
            texts.append(text)
        turns = [t for t, _, _ in rows if t is not None]
        return {"conv": conv, "block": first, "letters": "".join(letters), "blank": blank,
                "illegal": sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
                "turns": len(set(turns)), "least": min(turns, default=None), "greatest": max(turns, default=None),
                "keys": keys, "roles": roles, "texts": texts}

    def run(batches):
        conv, first, rows, size = None, None, [], 0
        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("conv", "row", "turn", "role", "text")]
            for c, row, turn, role, text in zip(*columns):
                if rows and (c != conv or len(rows) >= most or size >= BLOCK_BYTES):
                    out.append(block(conv, first, rows))
                    rows, size = [], 0
                if not rows:
                    conv, first = c, row
                rows.append((turn, role, text))
                size += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if rows:
            yield pa.RecordBatch.from_pylist([block(conv, first, rows)], schema=arrow)

    arrow = to_arrow_schema(schema)
    out = dealt.select("conv", "row", "turn", "role", "text").mapInArrow(run, schema)
    return cut(out.withColumn("part", F.shiftright("block", 33)))


def _first_places(blocks: DataFrame) -> DataFrame:
    """(conv, block, firsts): the rows of a block whose role and text stand nowhere earlier."""
    at = blocks.select("conv", "block", F.posexplode("keys").alias("i", "key")).where("key IS NOT NULL")
    first = at.groupBy("conv", "key").agg(F.min(F.col("block") + F.col("i")).alias("row"),
                                          F.min("block").alias("block"))
    return first.groupBy("conv", "block").agg(
        F.collect_list((F.col("row") - F.col("block")).cast("int")).alias("firsts"))


_SUMMARY = T.ArrayType(T.LongType())


def _flat(s: Summary) -> list[int]:
    return [-1 if c >= _INF else c * 16 + r for vector in s for c, r in vector]


def _summary(flat: list[int]) -> Summary:
    pairs = [(_INF, 9) if x < 0 else divmod(x, 16) for x in flat]
    return [pairs[i:i + 4] for i in range(0, 16, 4)]


def _map(df: DataFrame, fields: list[T.StructField], one) -> DataFrame:
    """``one(row) -> iterable of dicts`` over the rows of each Arrow batch."""
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = [x for row in batch.to_pylist() for x in one(row)]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, schema)


def _join(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    other = b.withColumnsRenamed({k: f"{k}_b" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"{k}_b"))
    return a.join(other, test, how).drop(*[f"{k}_b" for k in keys])


def edits(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (conv, turn, role, text): their blocks, (conv, cost, end) and each block's edits.

    The last frame holds (conv, block, duplicate, truncated, start, end, audit): the edits that lead
    through the block's rows, without the inserts after a conversation's last row.
    """
    prepare(rows.sparkSession)
    blocks = _blocks(rows, block)
    conv = blocks.schema["conv"]
    narrow = _join(blocks.select("conv", "block", "part", "letters"), _first_places(blocks), ["conv", "block"], "left")

    def coded(row):
        firsts = set(row["firsts"] or ())
        letters = "".join(c if i in firsts else _GONE for i, c in enumerate(row["letters"]))
        yield {"conv": row["conv"], "block": row["block"], "part": row["part"], "letters": letters,
               "duplicate": sum(a != b for a, b in zip(row["letters"], letters)),
               "truncated": sum(c.isupper() and c != _GONE for c in letters), "summary": _flat(summary(letters))}

    long = T.LongType()
    code = cut(_map(narrow, [conv, T.StructField("block", long), T.StructField("part", long),
                             T.StructField("letters", T.StringType()), T.StructField("duplicate", long),
                             T.StructField("truncated", long), T.StructField("summary", _SUMMARY)], coded))

    # Up: blocks of one partition, then partitions of one conversation.
    whole = F.sort_array(F.collect_list(F.struct("block", "summary"))).alias("blocks")

    def part(row):
        yield {"conv": row["conv"], "part": row["part"],
               "summary": _flat(compose([_summary(b["summary"]) for b in row["blocks"]]))}

    parts = _map(code.groupBy("conv", "part").agg(whole),
                 [conv, T.StructField("part", long), T.StructField("summary", _SUMMARY)], part)

    def conversation(row):
        stretches = [_summary(p["summary"]) for p in row["parts"]]
        cost, end = finish(compose(stretches))
        states = [START, *crossings(stretches, START, end)]
        for p, a, b in zip(row["parts"], states, states[1:]):
            yield {"conv": row["conv"], "part": p["part"], "start": a, "end": b, "cost": cost}

    state = [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    between = cut(_map(parts.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("part", "summary"))).alias("parts")),
        [conv, T.StructField("part", long), *state, T.StructField("cost", long)], conversation))
    last = between.groupBy("conv").agg(F.max("cost").alias("cost"),
                                       F.max_by("end", "part").alias("end"))

    # Down: states between the blocks of a partition, then the edits of each block.
    def inner(row):
        states = [row["start"], *crossings([_summary(b["summary"]) for b in row["blocks"]], row["start"], row["end"])]
        for b, x, y in zip(row["blocks"], states, states[1:]):
            yield {"conv": row["conv"], "block": b["block"], "start": x, "end": y}

    met = _join(code.groupBy("conv", "part").agg(whole), between.drop("cost"), ["conv", "part"])
    at = _map(met, [conv, T.StructField("block", long), *state], inner)

    def solved(row):
        yield {k: row[k] for k in ("conv", "block", "duplicate", "truncated", "start", "end")} \
            | {"audit": audit_between(row["letters"], row["start"], row["end"])}

    audits = _map(_join(code.drop("part", "summary"), at, ["conv", "block"]),
                  [conv, T.StructField("block", long), T.StructField("duplicate", long),
                   T.StructField("truncated", long), *state, T.StructField("audit", T.StringType())], solved)
    return blocks, last, audits


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired rows of (conv, turn, role, text): conv, block, i (order), role, text, edit.

    Rows of a conversation stand in the order of (block, i). Deleted rows are not returned.
    """
    blocks, last, audits = edits(rows, block)
    merged = _join(blocks.select("conv", "block", "part", "roles", "texts"), audits, ["conv", "block"])
    ends = audits.groupBy("conv").agg(F.max("block").alias("block")).withColumn("final", F.lit(True))
    merged = _join(merged, ends, ["conv", "block"], "left")

    def one(row):
        audit = row["audit"] + "I" * (_TAIL[row["end"]] if row["final"] else 0)
        out = repaired(row["roles"], row["texts"], audit, row["start"])
        for i, ((role, text), edit) in enumerate(zip(out, audit.replace("D", ""))):
            yield {"conv": row["conv"], "block": row["block"], "i": i, "role": role, "text": text, "edit": edit}

    return _map(merged, [blocks.schema["conv"], T.StructField("block", T.LongType()),
                         T.StructField("i", T.IntegerType()), T.StructField("role", T.StringType()),
                         T.StructField("text", T.StringType()), T.StructField("edit", T.StringType())], one)


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digests(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation with rows: conv, the counts and cost, audit, repaired_sha256.

    ``gaps``: turns missing between the least and the greatest. ``illegal``: neighbours that are not
    su, ua or au. The digest is of ``role:text``, joined by newlines. The blocks of a conversation
    and their edits come to one task in order and are hashed one at a time.
    """
    blocks, last, audits = edits(rows, block)
    conv = blocks.schema["conv"]
    texts = blocks.select("conv", "block", F.lit(1).alias("kind"), "blank", "illegal", "turns", "least", "greatest",
                          "roles", "texts")
    told = audits.select("conv", "block", F.lit(0).alias("kind"), "duplicate", "truncated", "start", "audit")
    ends = last.select("conv", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("kind"), "cost", "end")
    merged = (texts.unionByName(told, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
              .repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "block", "kind"))
    schema = T.StructType([conv, *[T.StructField(c, T.LongType()) for c in _REPORT],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    class Stream:
        """What is known of a conversation from its blocks so far."""

        def __init__(self, head):
            self.row = {"conv": head["conv"], "cost": head["cost"], "blank": 0, "duplicate": 0, "truncated": 0,
                        "illegal": 0}
            self.end, self.sha, self.audit, self.empty = head["end"], hashlib.sha256(), [], True
            self.role = self.least = self.greatest = None
            self.turns = 0

        def put(self, pairs):
            for role, text in pairs:
                self.sha.update((f"{role}:{text}" if self.empty else f"\n{role}:{text}").encode())
                self.empty = False

        def add(self, told, block):
            for name, source in (("blank", block), ("illegal", block), ("duplicate", told), ("truncated", told)):
                self.row[name] += source[name]
            if self.role is not None:
                self.row["illegal"] += self.role + block["roles"][0][:1] not in ("su", "ua", "au")
            self.role = block["roles"][-1][:1]
            if block["least"] is not None:
                self.turns += block["turns"] - (self.greatest == block["least"])
                self.least = block["least"] if self.least is None else self.least
                self.greatest = block["greatest"]
            self.put(repaired(block["roles"], block["texts"], told["audit"], told["start"]))
            self.audit.append(told["audit"])

        def done(self):
            tail = "I" * _TAIL[self.end]
            self.put(repaired([], [], tail, self.end))
            gaps = 0 if self.least is None else self.greatest - self.least + 1 - self.turns
            return self.row | {"gaps": gaps, "audit": "".join(self.audit) + tail,
                               "repaired_sha256": self.sha.hexdigest()}

    def run(batches):
        now = told = None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                if row["block"] < 0:
                    if now is not None:
                        out.append(now.done())
                    now = Stream(row)
                elif row["kind"] == 0:
                    told = row
                else:
                    now.add(told, row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.done()], schema=arrow)

    return merged.mapInArrow(run, schema)


def report(convs: DataFrame, rows: DataFrame, conv_col: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """``digests`` for every conversation of ``convs``; those without rows have zeros and empty repairs."""
    ids = pick(convs, conv=conv_col).distinct()
    out = _join(ids, digests(rows, block), ["conv"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("conv").alias(conv_col), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _REPORT],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
