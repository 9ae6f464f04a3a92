"""Operator 12: repair of conversation structure by weighted interval parsing.

The roles of a sound conversation spell ``(s?(ua)+)?``. Rows are kept (K), get
another role (R), are deleted (D), or a row without text is inserted (I); each
edit has a cost, and a conversation gets its cheapest edits, ties to the least
audit string.

The repair grammar is in Chomsky normal form over spans of rows: its symbols
``(p, q)`` derive what leads the pattern from state p to q, with the rules
``(p, r) -> (p, q) (q, r)``, one row's edits at the leaves, and the closure of insertions
around every leaf. A cell holds the least (cost, audit) of a symbol over a span.
Cells are combined bottom-up by span length. Since every derivation of such a
symbol divides at every place of its span, one division of each span is enough, so
a conversation of n rows needs n - 1 spans and not all pairs of places.
Least cells stay least in longer spans: a row's edits and the insertions determine the cost, so
two audits of one span and cost never begin with one another.

Spark's part: rows are range-sorted by (conversation, turn, role, text hashes), so a
conversation of any size is dealt to as many tasks as it needs; each task
turns its rows into one letter each (fault and role), parses blocks of letters to
cells, and a conversation's blocks are combined in their order. Texts travel once, to be
hashed in order next to their conversation's audit (a hash of one text is sequential by nature; it is
streamed, so memory does not grow with the conversation).

Defined results: NULL text, role: one space; NULL conv_id: a conversation of its
own; NULL turn: first. Rows of one turn: by role, then by hashes of the text. Empty role: its
initial is a space. Repeated rows: all but the first are duplicates. Roles
other than system, user, assistant are never kept. Very long texts: whole. Empty table:
empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listingmart.llm.common import map_batches, query, scratch_path, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of one block of letters.
BLOCK = 4096
#: Blank is what has none but these characters; a sound text ends with one of STOPS.
BLANKS, STOPS = " \t\n\x0b\x0c\r", ".!?"

# States of the pattern: nothing yet, after s, after u, after a. Which state a role initial leads to:
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPTED = (0, 3)
_STATES = range(4)
_LEGAL = {"su", "ua", "au"}
# Letter of a row: 4 * role (s, u, a, other) + fault (none, truncated, duplicate, blank), from "A" on.
_ROLES = "sua?"

Cells = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cells, right: Cells) -> Cells:
    """The cells of a span from those of its two parts: (p, r) -> (p, q) (q, r)."""
    out: Cells = {}
    for (p, q), (c1, a1) in left.items():
        for (q2, r), (c2, a2) in right.items():
            if q == q2:
                c = c1 + c2
                old = out.get((p, r))
                if old is None or c < old[0] or (c == old[0] and a1 + a2 < old[1]):
                    out[p, r] = (c, a1 + a2)
    return out


def _insertions() -> Cells:
    """Closure of insertions: the empty span's cells."""
    cells: Cells = {(p, p): (0, "") for p in _STATES}
    once: Cells = cells | {(p, q): (INSERT, "I") for (p, role), q in _STEP.items() if role != "s"}
    while (more := combine(cells, once)) != cells:
        cells = more
    return cells


EMPTY = _insertions()


@lru_cache(64)
def leaf(letter: str) -> Cells:
    """One row's edits, insertions around them."""
    role, fault = divmod(ord(letter) - 65, 4)
    cells: Cells = {(p, p): (DELETE, "D") for p in _STATES}
    if fault < 2:
        late = TRUNCATED * (fault == 1)
        for (p, to), q in _STEP.items():
            options = [(KEEP + late, "K")] if to == _ROLES[role] else []
            if to != "s":
                options.append((REROLE + late, "R"))
            if options:
                cells[p, q] = min(options)
    return combine(combine(EMPTY, cells), EMPTY)


def parse(letters: str) -> Cells:
    """The cells of a whole span of rows, bottom-up by span length."""
    spans = [leaf(x) for x in letters] or [EMPTY]
    while len(spans) > 1:
        spans = [combine(*spans[i:i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


_short = lru_cache(50_000)(parse)


def cells_of(letters: str) -> Cells:
    return _short(letters) if len(letters) <= 16 else parse(letters)


def best(cells: Cells) -> tuple[int, str]:
    """Cost and audit of the cheapest repair."""
    return min(cells[0, q] for q in _ACCEPTED if (0, q) in cells)


def _roles(letters: str) -> str:
    return "".join(_ROLES[(ord(x) - 65) // 4] for x in letters)


def _illegal(roles: str) -> int:
    return sum(roles[i:i + 2] not in _LEGAL for i in range(len(roles) - 1))


class Replay:
    """The lines of a repaired conversation, from its audit and its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, ""

    def _next(self) -> str:
        self.last = "assistant" if self.last == "user" else "user"
        return self.last

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._next() + ":"

    def row(self, role: str, text: str):
        """The lines before and at the next row."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.last = {"s": "", "u": "user", "a": "assistant"}[role[0]]
            yield f"{role}:{text}"
        elif edit == "R":
            yield f"{self._next()}:{text}"


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults: (conv_id, turn, role, text, copy)."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault")).filter("fault != 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _rows(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = F.lit(" ")
    rows = conversations.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                                F.coalesce(F.col(role).cast("string"), space).alias("role"),
                                F.coalesce(F.col(text).cast("string"), space).alias("text"))
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), F.col("text"))})


_ORDER = ["turn", "role", "h1", "h2"]


def _letter(fault: Column) -> Column:
    role = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return F.char(F.lit(65) + 4 * role + fault)


def _blocks(batches):
    """(conv_id, part, block, letters): the letters of consecutive rows of a conversation, sorted."""
    part, block, conv, held = TaskContext.get().partitionId(), 0, None, []
    began = False
    for b in batches:
        out = []
        for c, letter in zip(b.column("conv_id").to_pylist(), b.column("letter").to_pylist(), strict=True):
            if held and (c != conv or len(held) >= BLOCK):
                out.append((conv, part, block, "".join(held)))
                held, block = [], block + 1
            conv, began = c, True
            held.append(letter)
        if out:
            yield _block_rows(out)
    if began and held:
        yield _block_rows([(conv, part, block, "".join(held))])


def _block_rows(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.record_batch({"conv_id": pa.array(cols[0], pa.int64()), "part": pa.array(cols[1], pa.int32()),
                            "block": pa.array(cols[2], pa.int64()), "letters": pa.array(cols[3], pa.string())})


def _parsed(batches):
    """Conversations from their blocks, which come in order: counts, cost and audit."""
    def rows():
        for b in batches:
            yield from zip(b.column("conv_id").to_pylist(), b.column("letters").to_pylist(), strict=True)

    out = []
    for conv, blocks in groupby(rows(), key=lambda r: r[0]):
        cells, faults, illegal, last = None, [0] * 4, 0, ""
        for _, letters in blocks:
            cells = cells_of(letters) if cells is None else combine(cells, cells_of(letters))
            for k in range(4):
                faults[k] += sum(letters.count(chr(65 + k + 4 * r)) for r in range(4))
            roles = last + _roles(letters)
            illegal, last = illegal + _illegal(roles), roles[-1]
        out.append((conv, faults[3], faults[2], faults[1], illegal, *best(cells)))
        if len(out) >= 1000:
            yield _parsed_rows(out)
            out = []
    if out:
        yield _parsed_rows(out)


def _parsed_rows(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    names = ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")
    return pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, cols[:6], strict=True)} | {"audit": pa.array(cols[6], pa.string())})


_PARSED = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of every conversation that has rows."""
    rows = _rows(conversations, conv, turn, role, text).select(
        "conv_id", *_ORDER, F.substring("role", 1, 1).alias("initial"), F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1).alias("end"))
    # equal (role, text) in ascending turns: all but the first are duplicates
    n = F.row_number().over(W.partitionBy("conv_id", "role", "h1", "h2").orderBy(F.col("turn").asc_nulls_first()))
    fault = (F.when(F.col("end") == "", 3).when(F.col("n") > 1, 2).when(~F.lit(STOPS).contains(F.col("end")), 1).otherwise(0))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1"), F.col("h2"), F.col("n")]
    dealt = rows.withColumn("n", n).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("letter", _letter(fault))
    blocks = map_batches(dealt.select("conv_id", "letter"), _blocks, "conv_id long, part int, block long, letters string")
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").select("conv_id", "letters")
    return map_batches(ordered, _parsed, _PARSED)


def _replayed(batches):
    """A conversation's audit comes first, its rows follow in order; the repaired lines go on as they come."""
    replay = None
    for b in batches:
        conv, lines = [], []
        for c, kind, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "kind", "role", "text")), strict=True):
            if kind == 0:
                replay = Replay(text)
                continue
            new = list(replay.inserted() if kind == 2 else replay.row(role, text))
            conv += [c] * len(new)
            lines += new
        yield pa.record_batch({"conv_id": pa.array(conv, pa.int64()), "line": pa.array(lines, pa.string())})


def _hashed(batches):
    """The sha256 of each conversation's repaired lines, streamed."""
    replay = digest = None
    for b in batches:
        conv, out = [], []
        for c, kind, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "kind", "role", "text")), strict=True):
            if kind == 0:
                replay, digest, joint = Replay(text), hashlib.sha256(), b""
                continue
            for line in replay.inserted() if kind == 2 else replay.row(role, text):
                digest.update(joint + line.encode())
                joint = b"\n"
            if kind == 2:
                conv.append(c)
                out.append(digest.hexdigest())
        yield pa.record_batch({"conv_id": pa.array(conv, pa.int64()), "repaired_sha256": pa.array(out, pa.string())})


def _with_audits(conversations: DataFrame, found: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation's audit (kind 0), its rows in order (1), its end (2), next to each other in one task."""
    rows = _rows(conversations, conv, turn, role, text).select("conv_id", F.lit(1).alias("kind"), *_ORDER, "text")
    ends = found.select("conv_id", F.explode(F.array(F.lit(0), F.lit(2))).alias("kind"), F.lit(None).cast("long").alias("turn"),
                        F.lit("").alias("role"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"),
                        F.col("audit").alias("text"))
    order = ["conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "h1", "h2"]
    return rows.unionByName(ends).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text")


def repaired_lines(conversations: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(conv_id, line): the repaired conversations, ``role:text`` line by line in order within each task."""
    return map_batches(_with_audits(conversations, found, conv, turn, role, text), _replayed, "conv_id long, line string")


def repaired_hashes(conversations: DataFrame, found: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """(conv_id, repaired_sha256): of each conversation's repaired lines, joined by line ends."""
    return map_batches(_with_audits(conversations, found, conv, turn, role, text), _hashed, "conv_id long, repaired_sha256 string")


def gaps(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, gaps): turn numbers missing between a conversation's first and last."""
    t = F.col(turn).cast("long")
    return conversations.groupBy(F.col(conv).cast("long").alias("conv_id")).agg(
        F.coalesce(F.max(t) - F.min(t) + 1 - F.count_distinct(t), F.lit(0)).cast("long").alias("gaps"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    original = table(spark, sf, "conversations")
    rows = damaged(original)
    path = scratch_path(spark, "repair-audits")
    audits(rows).write.parquet(path)  # read twice below: as a result and beside the texts
    found = spark.read.schema(_PARSED).parquet(path)
    counted = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    same = [F.col("o.conv_id").eqNullSafe(F.col(f"{x}.conv_id")) for x in "gfh"]
    met = (original.select(F.col("conv_id").cast("long")).distinct().alias("o")
           .join(gaps(rows).alias("g"), same[0], "left").join(found.alias("f"), same[1], "left")
           .join(repaired_hashes(rows, found).alias("h"), same[2], "left"))
    return met.select("o.conv_id", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in counted],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
