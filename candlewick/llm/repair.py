"""Conversation structure repair: the cheapest edits that turn a conversation's roles into `(system? (user assistant)+)?`.

Turns are kept, given another role, deleted or put in; the audit is the string of the edits' initials, and of equally cheap
audits the one least in ASCII counts. A dynamic programme goes over the turns with four states (nothing yet, after a
system, a user, an assistant turn) and holds one audit for each. Audits are linked nodes that share their beginnings; a
node knows the hash of its whole audit and ancestors at distances of powers of two that divide its depth (two on average).
A tie finds the longest common prefix over these ancestors by hash; the prefixes are then compared edit by edit up to where
they are one, and what was compared is remembered, so a collision of hashes cannot change a result and nothing is
compared twice.

Two sorted passes stream over the turns of a task: the first, of narrow rows, finds the audits; the second meets each audit
with the texts in the same order and writes the repaired turns one after the other. A task holds a few numbers for each turn of
one conversation, never its texts. All turns of a conversation go to one task, as the digest of a conversation is one
sequence.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from candlewick.llm.text import BLANKS

# What the edits cost; any turn cut off in mid-sentence costs more unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
# States: nothing yet, after a system, a user, an assistant turn.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_ALTERNATING = ("su", "ua", "au")
_MODULUS = (1 << 61) - 1
_BASE = 1_000_003
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPAIRED = "conv_id long, place long, edit string, role string, text string"
_BATCH_ROWS = 4096


class Audit:
    """An edit after the audit before it."""

    __slots__ = ("above", "depth", "edit", "hash", "same")

    def __init__(self, before: "Audit | None", edit: str, modulus: int):
        self.edit = edit
        self.depth = before.depth + 1 if before else 0
        self.hash = (before.hash * _BASE + ord(edit)) % modulus if before else 0
        self.same = self
        self.above = []
        if before:
            # The ancestors 1, 2, 4 ... up, as far as these distances divide the depth.
            node, reach = before, 1
            while True:
                self.above.append(node)
                if self.depth % (2 * reach):
                    break
                # `node` has depth - reach, which 2 * reach does not divide: its farthest link reaches `reach` up.
                node, reach = node.above[-1], 2 * reach

    def at(self, depth: int) -> "Audit":
        """The beginning of so many edits."""
        node = self
        while node.depth > depth:
            for power in range(len(node.above) - 1, -1, -1):
                if node.depth - (1 << power) >= depth:
                    node = node.above[power]
                    break
        return node

    def known(self) -> "Audit":
        """The node that stands for all that were found to have the same edits."""
        node = self
        while node.same is not node:
            node.same = node.same.same
            node = node.same
        return node

    def edits(self) -> str:
        found, node = [], self
        while node.depth:
            found.append(node.edit)
            node = node.above[0]
        return "".join(reversed(found))


def _verified(a: Audit, b: Audit) -> bool:
    """Whether two audits of one depth have the same edits."""
    pairs = []
    while (one := a.known()) is not (other := b.known()):
        if a.edit != b.edit:
            return False
        pairs.append((one, other))
        a, b = a.above[0], b.above[0]
    for one, other in pairs:
        one.known().same = other.known()
    return True


def less(a: Audit, b: Audit) -> bool:
    """Whether audit a comes before b in ASCII order; a beginning comes before what goes on from it."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x.hash == y.hash and _verified(x, y):
        return a.depth < b.depth
    # Both differ here: climb while they still differ. Equal hashes below may lie, which `_verified` shows.
    while x.depth:
        for power in range(len(x.above) - 1, -1, -1):
            if x.above[power].hash != y.above[power].hash:
                x, y = x.above[power], y.above[power]
                break
        else:
            if not _verified(x.above[0], y.above[0]):
                return a.edits() < b.edits()
            return x.edit < y.edit if x.edit != y.edit else a.edits() < b.edits()
    return a.edits() < b.edits()


class Repair:
    """The cheapest audits of the turns so far, by state."""

    def __init__(self, modulus: int = _MODULUS):
        self.modulus = modulus
        self.best = [(0, Audit(None, "", modulus)), None, None, None]
        self._insert()

    def _offer(self, best: list, state: int, cost: int, before: Audit, edit: str) -> None:
        held = best[state]
        if held is None or cost < held[0]:
            best[state] = (cost, Audit(before, edit, self.modulus))
        elif cost == held[0]:
            found = Audit(before, edit, self.modulus)
            if less(found, held[1]):
                best[state] = (cost, found)

    def _insert(self) -> None:
        best = self.best
        for state, after in ((_NOTHING, _USER), (_SYSTEM, _USER), (_ASSISTANT, _USER), (_USER, _ASSISTANT)):
            if best[state]:
                self._offer(best, after, best[state][0] + INSERT, best[state][1], "I")

    def turn(self, initial: str, must_go: bool, truncated: bool) -> None:
        best: list = [None] * 4
        extra = TRUNCATED if truncated else 0
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, audit = held
            self._offer(best, state, cost + DELETE, audit, "D")
            if must_go:
                continue
            after = _ASSISTANT if state == _USER else _USER
            if initial == ("a" if state == _USER else "u"):
                self._offer(best, after, cost + extra, audit, "K")
            if initial == "s" and state == _NOTHING:
                self._offer(best, _SYSTEM, cost + extra, audit, "K")
            self._offer(best, after, cost + REROLE + extra, audit, "R")
        self.best = best
        self._insert()

    def result(self) -> tuple[int, str]:
        ends = [held for held in (self.best[_NOTHING], self.best[_ASSISTANT]) if held]
        first = ends[0]
        for other in ends[1:]:
            if other[0] < first[0] or (other[0] == first[0] and less(other[1], first[1])):
                first = other
        return first[0], first[1].edits()


class _Conversation:
    """The narrow rows of one conversation, in order."""

    def __init__(self):
        self.repair, self.seen, self.counts = Repair(), set(), dict.fromkeys(_COUNTS, 0)
        self.initial = self.first = self.last = None
        self.turns = 0

    def turn(self, turn, initial, blank, cut, digest) -> None:
        counts = self.counts
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + initial not in _ALTERNATING:
            counts["illegal"] += 1
        self.initial = initial
        duplicate = not blank and digest in self.seen
        truncated = not blank and not duplicate and cut
        self.seen.add(digest)
        for name, fault in (("blank", blank), ("duplicate", duplicate), ("truncated", truncated)):
            counts[name] += fault
        self.repair.turn(initial, blank or duplicate, truncated)

    def result(self) -> tuple:
        self.counts["gaps"] = self.last - self.first + 1 - self.turns if self.turns else 0
        self.counts["cost"], audit = self.repair.result()
        return (*self.counts.values(), audit)


def _batched(rows, names: list[str], kinds: list[pa.DataType]):
    """Record batches of the rows of a generator."""
    held = []

    def made():
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*held, strict=True), kinds, strict=True)], names
        )

    for row in rows:
        held.append(row)
        if len(held) >= _BATCH_ROWS:
            yield made()
            held = []
    if held:
        yield made()


def _rows(batches):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _audits(batches):
    def found():
        now, conversation = None, None
        for conv_id, *turn in _rows(batches):
            if conversation is None or conv_id != now:
                if conversation:
                    yield (now, *conversation.result())
                now, conversation = conv_id, _Conversation()
            conversation.turn(*turn)
        if conversation:
            yield (now, *conversation.result())

    yield from _batched(found(), ["conv_id", *_COUNTS, "audit"], [pa.int64()] * 7 + [pa.string()])


class _Replay:
    """The repaired turns of one conversation, as its audit tells."""

    def __init__(self, audit: str):
        self.audit, self.place, self.state = audit, 0, _NOTHING

    def inserted(self):
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            self.place += 1
            yield "I", self._alternate(), ""

    def turn(self, role: str, text: str):
        """What stands for one given turn: the turns put in before it, and itself unless it is deleted."""
        yield from self.inserted()
        edit = self.audit[self.place]
        self.place += 1
        if edit == "K":
            self.state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
            yield edit, role, text
        elif edit == "R":
            yield edit, self._alternate(), text

    def _alternate(self) -> str:
        self.state = _ASSISTANT if self.state == _USER else _USER
        return ASSISTANT if self.state == _ASSISTANT else USER


def _prepared(conversations: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
    )


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    order = [F.col("conv_id"), *[F.col(name) for name in before], F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def audited(conversations: DataFrame) -> DataFrame:
    """`conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit` of every conversation in `conv_id, turn, role, text`.

    Turns go by `turn` (NULL first), then role and text; NULL roles and texts are one space. Rows without a `conv_id` form
    one conversation. A turn's first fault counts: blank; role and text seen earlier; last character not one of `.!?`.
    `gaps` are turn numbers missing between the least and the greatest, `illegal` neighbours whose role initials do not
    alternate. Other columns are left aside; a table without rows gives none.
    """
    bare = F.btrim(F.col("text"), F.lit(BLANKS))
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    narrow = _in_order(_prepared(conversations)).select(
        "conv_id", "turn", F.substr("role", F.lit(1), F.lit(1)).alias("initial"), (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"), digest.alias("digest"),
    )
    return narrow.mapInArrow(_audits, _AUDIT)


def _with_audits(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns in order, each conversation headed by a row with its audit."""
    turns = _prepared(conversations).select("*", F.lit(1).alias("kind"), F.lit(None).cast(_struct()).alias("audit"))
    heads = audits.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.lit(0).alias("kind"), F.struct(*_COUNTS, "audit").alias("audit"),
    )
    return _in_order(heads.unionByName(turns), "kind")


def _struct() -> str:
    return "struct<" + ",".join(f"{name}:bigint" for name in _COUNTS) + ",audit:string>"


def repaired_turns(conversations: DataFrame, audits: DataFrame | None = None) -> DataFrame:
    """`conv_id, place, edit, role, text`: the turns of the repaired conversations, in order from place 0."""

    def replayed(batches):
        def found():
            now, replay, place = None, None, 0
            for conv_id, _, role, text, kind, audit in _rows(batches):
                if kind:
                    made = replay.turn(role, text)
                else:
                    made = replay.inserted() if replay else ()
                for edit, *turn in made:
                    yield (now, place, edit, *turn)
                    place += 1
                if not kind:
                    now, replay, place = conv_id, _Replay(audit["audit"]), 0
            for edit, *turn in replay.inserted() if replay else ():
                yield (now, place, edit, *turn)
                place += 1

        names = ["conv_id", "place", "edit", "role", "text"]
        yield from _batched(found(), names, [pa.int64(), pa.int64(), *[pa.string()] * 3])

    audits = audited(conversations) if audits is None else audits
    return _with_audits(conversations, audits).mapInArrow(replayed, _REPAIRED)


def repair_digests(conversations: DataFrame) -> DataFrame:
    """What `audited` gives, and `repaired_sha256` of the repaired turns `role:text`, joined by newlines."""

    def digested(batches):
        def found():
            now, head, replay, digest, first = None, None, None, None, True

            def told(turns):
                nonlocal first
                for _, role, text in turns:
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False

            for conv_id, _, role, text, kind, audit in _rows(batches):
                if kind:
                    told(replay.turn(role, text))
                    continue
                if replay:
                    told(replay.inserted())
                    yield (now, *head, digest.hexdigest())
                now, head, first = conv_id, tuple(audit.values()), True
                replay, digest = _Replay(audit["audit"]), hashlib.sha256()
            if replay:
                told(replay.inserted())
                yield (now, *head, digest.hexdigest())

        yield from _batched(found(), ["conv_id", *_COUNTS, "audit", "repaired_sha256"], [pa.int64()] * 7 + [pa.string()] * 2)

    return _with_audits(conversations, audited(conversations)).mapInArrow(digested, _AUDIT + ", repaired_sha256 string")


def damaged(conversations: DataFrame, fault: Column) -> DataFrame:
    """The turns with faults: 0 drops a row, 1 empties its text, 2 removes `.!?`, 3 repeats it, 4 makes its role user."""
    rows = _prepared(conversations).select("*", fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, USER).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")
