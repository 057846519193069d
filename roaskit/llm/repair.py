"""Conversation structure repair by weighted interval parsing.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.  Rows are kept, given another role,
deleted, or rows are inserted, each at a cost; the cheapest sequence of edits wins, and of equally cheap ones the
ASCII-least string of the edits' initials (K, R, D, I).

**Grammar.**  A nonterminal ``X[p, q]`` derives the spans of rows that an edit can turn into a string which leads the
pattern from state p to state q (0 nothing yet, 1 after ``s``, 2 after ``u``, 3 after ``a``).  In Chomsky normal form:
``X[p, q] -> X[p, r] X[r, q]`` for any r, ``X[p, q] -> row`` for each edit of one row, and inserted rows as unary rules,
which are closed once: ``INSERTS[p, q]`` is the cheapest inserted string between two states.  A cell holds the least
(cost, audit) of its nonterminal over a span.  Audits of one span and equal cost cannot be prefixes of each other (one
would hold more inserts, so cost more), so the least audit of a span is made of the least audits of its parts.

**Parsing.**  The chart of a piece of at most ``PIECE`` rows is filled bottom-up by span length over all splits (CYK).
Nonterminals are closed under cutting, so a longer conversation is parsed from the top cells of its pieces, joined in
pairs, spans of doubled length in each round.  A chart depends only on the kinds of its rows (initial, truncated,
to be deleted), so workers remember charts by that string.

**On Spark.**  Rows are range-partitioned by conversation and place, so one huge conversation is many tasks: a task parses
the pieces of what it holds.  A second step joins the few cells of each conversation's pieces and gets its audit.  A
third streams each conversation's rows beside its audit and hashes the repaired text; nothing but the audit, which is
one value of the result, is held.  Equal rows of one turn are folded into one row with a count first.

Defined cases: nulls in role and text, and in the id and turn that choose the damage, read as one space; a null
conversation id is a conversation; rows that tie on their turn stand by role, then by digest of their text; a role that
starts with none of s, u, a cannot be kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roaskit.llm.common import importable_in_workers

# --- fixed values: the contract's pattern, costs and edits --------------------------------------------------
STATES = range(4)
STEPS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
FINAL = ((0, 0), (0, 3))
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
GIVEN = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
SPACE = r"\x20\x09-\x0D"
# ------------------------------------------------------------------------------------------------------------
#: Rows of a chart that is filled over all splits.
PIECE = 16
#: Charts that a worker remembers.
REMEMBERED = 1 << 16

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def _least(cells: Cells, key: tuple[int, int], cell: Cell) -> None:
    if key not in cells or cell < cells[key]:
        cells[key] = cell


def _joined(one: Cells, two: Cells) -> Cells:
    """The binary rules over two neighbouring spans."""
    out: Cells = {}
    for (p, r), (cost, audit) in one.items():
        for q in STATES:
            if (r, q) in two:
                more, rest = two[r, q]
                _least(out, (p, q), (cost + more, audit + rest))
    return out


def _inserts() -> Cells:
    """The closure of inserted rows: the least (cost, audit) of an empty span between two states."""
    cells: Cells = {(p, p): (0, "") for p in STATES}
    one = dict(cells)
    for role in GIVEN:
        for step in STEPS[role]:
            _least(one, step, (INSERT_COST, "I"))
    while (grown := _joined(cells, one)) != cells:
        cells = grown
    return cells


INSERTS = _inserts()


def _closed(cells: Cells) -> Cells:
    """Cells with inserted rows before and after the span."""
    return _joined(_joined(INSERTS, cells), INSERTS)


#: Kinds of rows: the initial (or ``-``) of a row that may stay, upper case if it is truncated; ``x`` must be deleted.
MUST_GO = "x"


def row_cells(kind: str) -> Cells:
    """The edits of one row."""
    cells: Cells = {(p, p): (DELETE_COST, "D") for p in STATES}
    if kind != MUST_GO:
        extra = TRUNCATED_COST if kind.isupper() or kind == "+" else 0
        for step in STEPS.get(kind.lower(), ()):
            _least(cells, step, (extra, "K"))
        for role in GIVEN:
            for step in STEPS[role]:
                _least(cells, step, (REROLE_COST + extra, "R"))
    return _closed(cells)


@lru_cache(REMEMBERED)
def parse(kinds: str) -> Cells:
    """CYK over the rows of one piece: the cells of the whole span."""
    chart = {(k, k + 1): row_cells(kind) for k, kind in enumerate(kinds)}
    for length in range(2, len(kinds) + 1):
        for start in range(len(kinds) - length + 1):
            cells: Cells = {}
            for split in range(start + 1, start + length):
                for key, cell in _joined(chart[start, split], chart[split, start + length]).items():
                    _least(cells, key, cell)
            chart[start, start + length] = cells
    return chart[0, len(kinds)]


def joined_pieces(pieces: list[Cells]) -> Cells:
    """The cells of neighbouring pieces, joined in pairs until one span is left."""
    if not pieces:
        return dict(INSERTS)
    while len(pieces) > 1:
        pieces = [_joined(*pieces[k:k + 2]) if k + 1 < len(pieces) else pieces[k] for k in range(0, len(pieces), 2)]
    return pieces[0]


def best(cells: Cells) -> Cell:
    """The least (cost, audit) of a well-formed conversation."""
    return min(cells[key] for key in FINAL if key in cells)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by ``crc32(conv_id:turn) % 20``, with nulls in role and text as one space."""
    def told(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), told("role").alias("role"),
        told("text").alias("text"), (F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20).alias("harm"))
    text = F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("harm") == 3, 2).otherwise(1)
    return rows.where("harm <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


#: A row of the order: its conversation, place, and what the parse has to know.  Nulls are told by a flag.
ORDER = ["has_conv", "conv", "has_turn", "turn_no", "role", "digest"]


def _rows(damaged_rows: DataFrame) -> DataFrame:
    """Equal rows folded, and each row's fault, kind and place."""
    rows = damaged_rows.select(
        F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn_no"), "role",
        F.unhex(F.sha2(F.col("text"), 256)).alias("digest"), "text", "copies")
    folded = rows.groupBy(*ORDER).agg(F.sum("copies").alias("copies"), F.first("text").alias("text"))
    said = ["has_conv", "conv", "role", "digest"]
    firsts = folded.groupBy(*said).agg(F.min(F.struct("has_turn", "turn_no")).alias("first"))
    told = folded.join(firsts, said)
    stripped = F.regexp_replace("text", rf"(?<![{SPACE}])[{SPACE}]+\z", "")
    blank = stripped == ""
    again = F.struct("has_turn", "turn_no") != F.col("first")
    cut = ~blank & ~stripped.rlike(r"[.!?]\z")
    initial = F.coalesce(F.nullif(F.substring("role", 1, 1), F.lit("")), F.lit("-"))
    known = initial.isin(*STEPS)
    kind = (F.when(blank | again, MUST_GO).when(known & cut, F.upper(initial)).when(known, initial)
            .when(cut, "+").otherwise("-"))
    return told.select(*ORDER, "copies", "text", initial.alias("initial"), blank.alias("blank"), (~blank & again).alias("again"),
                       (~blank & ~again & cut).alias("cut"), kind.alias("kind"))


PIECES = ("has_conv boolean, conv long, place long, rows long, blank long, duplicate long, truncated long, illegal long, "
          "low long, high long, turns long, first string, last string, states array<int>, costs array<long>, audits array<string>")


class _Piece:
    """What one conversation's neighbouring rows sum up to; also of joined pieces."""

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.first = self.last = ""

    def add(self, copies: int, blank: bool, again: bool, cut: bool, initial: str, turn: int | None) -> None:
        if self.rows and self.last + initial not in LEGAL:
            self.illegal += 1
        if not self.rows:
            self.first = initial
        self.illegal += (copies - 1) * (initial + initial not in LEGAL)
        self.last = initial
        self.blank += copies if blank else 0
        self.duplicate += copies if again else 0 if blank else copies - 1
        self.truncated += 1 if cut else 0
        self.rows += copies
        if turn is not None:
            self.turns += self.high != turn
            self.low, self.high = turn if self.low is None else self.low, turn

    def join(self, other: "_Piece") -> None:
        """The next piece of the conversation follows."""
        if not other.rows:
            return
        if not self.rows:
            self.__dict__.update(other.__dict__)
            return
        self.illegal += other.illegal + (self.last + other.first not in LEGAL)
        self.turns += other.turns - (other.low is not None and other.low == self.high)
        self.low, self.high = other.low if self.low is None else self.low, self.high if other.high is None else other.high
        self.last = other.last
        for name in ("rows", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(other, name))


def _kinds(kind: str, copies: int) -> str:
    """Copies stand side by side; the first may stay, the others repeat it."""
    return kind + MUST_GO * (copies - 1)


def _parse_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, to one row for each piece of at most ``PIECE`` rows of a conversation (or of one row's copies)."""
    names = [f.split()[0] for f in PIECES.split(", ")]
    schema = pa.schema(list(zip(names, [pa.bool_(), *[pa.int64()] * 10, pa.string(), pa.string(), pa.list_(pa.int32()),
                                        pa.list_(pa.int64()), pa.list_(pa.string())])))
    out: list[dict] = []
    piece, kinds, at, place = _Piece(), [], None, 0

    def closed() -> dict:
        text = "".join(kinds)
        cells = joined_pieces([parse(text[k:k + PIECE]) for k in range(0, len(text), PIECE)])
        keys = sorted(cells)
        return {"has_conv": at[0], "conv": at[1], "place": place, **piece.__dict__,
                "states": [4 * p + q for p, q in keys], "costs": [cells[k][0] for k in keys], "audits": [cells[k][1] for k in keys]}

    for batch in batches:
        for no, conv, place_now, has, turn, copies, initial, blank, again, cut, kind in zip(*[c.to_pylist() for c in batch.columns]):
            if at != (no, conv) or piece.rows >= PIECE:
                if piece.rows:
                    out.append(closed())
                piece, kinds, at, place = _Piece(), [], (no, conv), place_now
            piece.add(copies, blank, again, cut, initial, turn if has else None)
            kinds.append(_kinds(kind, copies))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if piece.rows:
        out.append(closed())
    yield pa.RecordBatch.from_pylist(out, schema)


SUMMARY = ("has_conv boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of conversation and place, to one row for each conversation."""
    schema = pa.schema([("has_conv", pa.bool_()), *[(f.split()[0], pa.int64()) for f in SUMMARY.split(", ")[1:-1]], ("audit", pa.string())])
    out: list[dict] = []
    whole, cells, at = _Piece(), [], None

    def closed() -> dict:
        cost, audit = best(joined_pieces(cells))
        gaps = 0 if whole.low is None else whole.high - whole.low + 1 - whole.turns
        return {"has_conv": at[0], "conv": at[1], "gaps": gaps, "blank": whole.blank, "duplicate": whole.duplicate,
                "truncated": whole.truncated, "illegal": whole.illegal, "cost": cost, "audit": audit}

    for batch in batches:
        for r in batch.to_pylist():
            if at != (r["has_conv"], r["conv"]):
                if at is not None:
                    out.append(closed())
                whole, cells, at = _Piece(), [], (r["has_conv"], r["conv"])
            if r["rows"]:
                one = _Piece()
                one.__dict__.update({k: r[k] for k in one.__dict__})
                whole.join(one)
                cells.append({(s // 4, s % 4): (c, a) for s, c, a in zip(r["states"], r["costs"], r["audits"])})
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if at is not None:
        out.append(closed())
    yield pa.RecordBatch.from_pylist(out, schema)


class Repair:
    """Applies an audit to the rows of one conversation, in order; ``lines`` is what is to be hashed."""

    def __init__(self, audit: str):
        self.audit, self.at, self.count, self.before = audit, 0, 0, ""

    def _line(self, role: str, text: str, initial: str) -> str:
        self.count, self.before = self.count + 1, initial
        return ("\n" if self.count > 1 else "") + f"{role}:{text}"

    def _next(self) -> str:
        """What the pattern wants after the row before, if that is no kept row."""
        return "a" if self.before == "u" else "u"

    def inserted(self) -> Iterator[str]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            initial = self._next()
            yield self._line(GIVEN[initial], "", initial)

    def row(self, role: str, text: str, copies: int) -> Iterator[str]:
        for _ in range(copies):
            yield from self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                yield self._line(role, text, role[:1])
            elif edit == "R":
                initial = self._next()
                yield self._line(GIVEN[initial], text, initial)


RESULT = SUMMARY + ", repaired_sha256 string"


def _hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's summary, then its rows in order, to the summary with the digest of the repaired text."""
    fields = [f.split()[0] for f in SUMMARY.split(", ")]
    out: list[dict] = []
    summary = repair = digest = None

    def closed() -> dict:
        for line in repair.inserted():
            digest.update(line.encode())
        return summary | {"repaired_sha256": digest.hexdigest()}

    schema = pa.schema([("has_conv", pa.bool_()), *[(f, pa.int64()) for f in fields[1:-1]], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    for batch in batches:
        for r in batch.to_pylist():
            if r["audit"] is not None:
                if summary is not None:
                    out.append(closed())
                summary, repair, digest = {f: r[f] for f in fields}, Repair(r["audit"]), hashlib.sha256()
            else:
                for line in repair.row(r["role"], r["text"], r["copies"]):
                    digest.update(line.encode())
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if summary is not None:
        out.append(closed())
    yield pa.RecordBatch.from_pylist(out, schema)


def repair_conversations(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations``: faults, cheapest edits and digest of the repaired ``rows``.

    ``rows`` (conv_id, turn, role, text, copies; role and text never null) are the conversations' rows to repair,
    ``damaged(conversations)`` if not given.
    """
    spark = conversations.sparkSession
    importable_in_workers(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = _rows(damaged(conversations) if rows is None else rows)
    ordered = ready.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER).withColumn("place", F.monotonically_increasing_id())
    pieces = (ordered.select("has_conv", "conv", "place", "has_turn", "turn_no", "copies", "initial", "blank", "again", "cut", "kind")
              .mapInArrow(_parse_pieces, PIECES))
    ids = conversations.select(F.col("conv_id").isNotNull().alias("has_conv"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")).distinct()
    empty = ids.select("has_conv", "conv", F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("rows"))
    summaries = (pieces.unionByName(empty, allowMissingColumns=True).repartition("has_conv", "conv")
                 .sortWithinPartitions("has_conv", "conv", "place").mapInArrow(_join_pieces, SUMMARY))
    # a conversation's summary stands before its rows, which follow in the same order as above
    both = (ready.select(*ORDER, "copies", "text").withColumn("is_row", F.lit(True))
            .unionByName(summaries.withColumn("is_row", F.lit(False)), allowMissingColumns=True))
    told = (both.repartition("has_conv", "conv").sortWithinPartitions("has_conv", "conv", "is_row", *ORDER[2:])
            .select(*[f.split()[0] for f in SUMMARY.split(", ")], "role", "text", "copies")
            .mapInArrow(_hash_repaired, RESULT))
    return told.select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), "gaps", "blank", "duplicate", "truncated",
                       "illegal", "cost", "audit", "repaired_sha256")
