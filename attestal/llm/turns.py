"""Conversation structure repair: the cheapest edits after which turns alternate.

A whole conversation has no turn, or an optional system turn and then pairs of
a user and an assistant turn. Its turns are read once, in order: conversations
are dealt to tasks by their id and sorted by turn there, and ``mapInPandas``
walks the rows, carrying one small state over from Arrow batch to Arrow batch.

The state is that of a shortest path through the grammar: for each of its four
places the cost of the cheapest edits that lead there, and the order of their
audits among each other. Costs matter only by their differences, so there are
few such states; they are numbered once (``STEPS``), and a turn is one look-up.
What has to be remembered per turn is the number of the step taken, two bytes.
Of a giant conversation these numbers leave the task in pieces, as rows; a
second walk, backwards over the pieces, spells its audit.

The digest of the repaired text needs no second look at the texts: each place
keeps the running digest of its own repaired text.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import SPACES, bound_batches, stored

#: Turns after which the steps of a conversation leave the task as a row.
PIECE = 1 << 16

#: Places of the grammar: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
WHOLE = (START, ASSISTANT)
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Where an inserted or renamed turn leads, and the role that it gets.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

KEEP, RENAME, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1
MOST_INSERTS = 2

#: What the grammar sees of a turn: its initial (s, u, a, other), the same of a truncated one, or that it must go.
INITIALS = "sua"
MUST_GO = 8
SYMBOLS = 9

Place = tuple[int, int]  # cost over the cheapest place, rank of its audit among the places'


def _reach(places: tuple[Place | None, ...]) -> Iterator[tuple[int, int, int, int]]:
    """(place to stand at, cost, place before, inserts): standing still, or moving on by inserted turns."""
    for before, known in enumerate(places):
        if known is not None:
            at = before
            for inserts in range(MOST_INSERTS + 1):
                yield at, known[0] + INSERT * inserts, before, inserts
                at = NEXT[at]


def _step(places: tuple[Place | None, ...], symbol: int):
    """The places after a turn, what all of them cost more, and for each the place before and the edits, as audit letters.

    Audits of different places differ before either ends, or one is the other
    and inserted turns; so rank, inserts and the new letter order them.
    """
    found: dict[int, tuple] = {}
    for at, cost, before, inserts in _reach(places):
        offers = [(at, DELETE, "D")]
        if symbol != MUST_GO:
            late = UNFINISHED * (symbol // 4)
            kept = MOVES.get((at, INITIALS[symbol % 4])) if symbol % 4 < 3 else None
            offers += [(NEXT[at], RENAME + late, "R")] + ([] if kept is None else [(kept, KEEP + late, "K")])
        for to, price, letter in offers:
            offer = (cost + price, places[before][1], "I" * inserts + letter, before)
            if to not in found or offer < found[to]:
                found[to] = offer
    least: dict[int, int] = {}
    fresh = tuple((found[p][0], 0) if p in found else None for p in range(4))
    for at, cost, _, _ in _reach(fresh):
        least[at] = min(cost, least.get(at, cost))
    # whatever follows a dearer place can follow a cheaper one; the last assistant turn can stand for a
    # system turn, and for the start when a later system turn is deleted
    for place in list(found):
        cost, limit = found[place][0], least[place]
        if ASSISTANT in least and place in (START, SYSTEM):
            limit = min(limit, least[ASSISTANT] + (DELETE if place == START else 0))
        if cost > limit:
            del found[place]
    floor = min(f[0] for f in found.values())
    ranks = {key: i for i, key in enumerate(sorted({f[1:3] for f in found.values()}))}
    after = tuple((found[p][0] - floor, ranks[found[p][1:3]]) if p in found else None for p in range(4))
    return after, floor, {p: (f[3], f[2]) for p, f in found.items()}


@cache
def _machine() -> tuple[list[tuple], list[tuple]]:
    """All states by number, each as its places, and the steps from them; state 0 is the start."""
    states = [((0, 0), None, None, None)]
    numbers, table = {states[0]: 0}, []
    for places in states:
        for symbol in range(SYMBOLS):
            after, cost, back = _step(places, symbol)
            if after not in numbers:
                numbers[after] = len(states)
                states.append(after)
            table.append((numbers[after], cost, back))
    return states, table


def steps() -> list[tuple[int, int, dict[int, tuple[int, str]]]]:
    """By state * SYMBOLS + symbol: the next state, the cost, and the way back from each place."""
    return _machine()[1]


@cache
def ends() -> list[tuple[int, int, int]]:
    """By state: the cost of ending there, the place, and the inserted turns that close the conversation from it."""
    table = []
    for places in _machine()[0]:
        closing = [(cost, places[before][1], inserts, before) for at, cost, before, inserts in _reach(places) if at in WHOLE]
        cost, _, inserts, before = min(closing)
        table.append((cost, before, inserts))
    return table


def letters_back(codes: array, place: int) -> tuple[list[str], int]:
    """Audit letters of some turns, last turn first, and the place before them."""
    table, letters = steps(), []
    for code in reversed(codes):
        place, edit = table[code][2][place]
        letters.append(edit)
    return letters, place


def _told(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


class Walk:
    """One conversation on its way through a task."""

    def __init__(self, key: tuple[bool, str]) -> None:
        self.key = key
        self.state = self.cost = self.turns = self.parts = 0
        self.codes = array("H")
        self.digests = {START: hashlib.sha256()}
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.before: tuple[str, str] | None = None
        self.turn: tuple[bool, int] | None = None
        self.numbered: tuple[int, int] | None = None
        self.distinct = 0
        self.late: set[bytes] = set()

    def meets(self, turn: tuple[bool, int]) -> None:
        if turn != self.turn:
            self.turn, self.late = turn, set()

    def counts(self, turn: tuple[bool, int]) -> None:
        has, number = turn
        if has:
            if self.numbered is None or number != self.numbered[1]:
                self.distinct += 1
            self.numbered = (number if self.numbered is None else self.numbered[0], number)

    def takes(self, role: str, text: str) -> None:
        end = text.rstrip(SPACES)[-1:]
        told_late = bool(self.late) and _told(role, text) in self.late
        must_go = True
        if not end:
            self.faults["blank"] += 1
        elif told_late or self.before == (role, text):
            self.faults["duplicate"] += 1
        else:
            must_go = False
        initial = INITIALS.find(role[:1]) if role else -1
        symbol = initial if initial >= 0 else 3
        if not must_go and end not in ".!?":
            self.faults["truncated"] += 1
            symbol += 4
        if self.before is not None and self.before[0][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = (role, text)
        self.turns += 1

        code = self.state * SYMBOLS + (MUST_GO if must_go else symbol)
        self.state, cost, back = steps()[code]
        self.cost += cost
        self.codes.append(code)
        line = f"{role}:{text}".encode("utf-8", "surrogatepass")
        plain = f":{text}".encode("utf-8", "surrogatepass")
        digests = {}
        for place, (before, edits) in back.items():
            digest, at = self.digests[before], before
            if edits != "D":
                digest, at = self._inserted(digest, at, len(edits) - 1)
                if edits[-1] == "K":
                    self._line(digest, at, line)
                elif edits[-1] == "R":
                    self._line(digest, at, ROLE[NEXT[at]].encode() + plain)
            digests[place] = digest
        self.digests = digests

    @staticmethod
    def _line(digest, at: int, line: bytes) -> None:
        digest.update(line if at == START else b"\n" + line)

    def _inserted(self, digest, at: int, inserts: int):
        digest = digest.copy()
        for _ in range(inserts):
            self._line(digest, at, ROLE[NEXT[at]].encode() + b":")
            at = NEXT[at]
        return digest, at

    def piece(self) -> dict:
        """The steps so far, as a row; the walk goes on without them."""
        row = self._row() | {"part": self.parts, "codes": self.codes.tobytes()}
        self.parts, self.codes = self.parts + 1, array("H")
        return row

    def end(self) -> dict:
        cost, place, inserts = ends()[self.state]
        digest, _ = self._inserted(self.digests[place], place, inserts)
        low, high = self.numbered or (0, -1)
        row = self._row() | self.faults
        row |= {"part": self.parts, "whole": True, "place": place, "inserts": inserts, "cost": self.cost + cost, "illegal": self.illegal}
        row |= {"turns": self.turns, "gaps": high - low + 1 - self.distinct, "repaired_sha256": digest.hexdigest()}
        if self.parts:
            return row | {"codes": self.codes.tobytes()}
        letters, _ = letters_back(self.codes, place)
        return row | {"audit": "".join(reversed(letters)) + "I" * inserts}

    def _row(self) -> dict:
        return {"has_conv": self.key[0], "conv": self.key[1]}


#: What a walk tells: of a whole conversation, or of a piece of a giant one.
TOLD = {
    "has_conv": "boolean", "conv": "string", "part": "long", "whole": "boolean", "turns": "long", "gaps": "long", "blank": "long",
    "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string", "repaired_sha256": "string",
    "place": "long", "inserts": "long", "codes": "binary",
}
_EMPTY = {"boolean": False, "long": 0, "string": None, "binary": None}


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({c: [r.get(c, _EMPTY[t]) for r in rows] for c, t in TOLD.items()})


def _walker(piece: int):
    def walk_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk = None
        for frame in frames:
            done = []
            columns = [frame[c].tolist() for c in ("has_conv", "conv", "has_turn", "turn", "role", "text", "copies", "same")]
            for has, conv, has_turn, turn, role, text, copies, same in zip(*columns, strict=True):
                if walk is None or walk.key != (has, conv):
                    if walk is not None:
                        done.append(walk.end())
                    walk = Walk((has, conv))
                walk.meets((has_turn, turn))
                if same is not None:
                    walk.late.add(bytes(same))
                    continue
                if copies:
                    walk.counts((has_turn, turn))
                for _ in range(copies):
                    walk.takes(role, text)
                    if len(walk.codes) >= piece:
                        done.append(walk.piece())
            if done:
                yield _frame(done)
        if walk is not None:
            yield _frame([walk.end()])

    return walk_all


def _spell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of giant conversations, the last one first: the audit of each."""
    key, place = None, 0
    for frame in frames:
        told = []
        for has, conv, part, whole, end, inserts, codes in zip(
            *(frame[c].tolist() for c in ("has_conv", "conv", "part", "whole", "place", "inserts", "codes")), strict=True
        ):
            if key != (has, conv) or whole:
                key, place = (has, conv), end
            steps_taken = array("H")
            steps_taken.frombytes(bytes(codes))
            letters, place = letters_back(steps_taken, place)
            told.append((has, conv, part, "".join(reversed(letters)) + "I" * inserts))
        yield pd.DataFrame(told, columns=["has_conv", "conv", "part", "piece"])


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _read(rows: DataFrame, conversation: str, turn: str, role: str, text: str, copies: Column | None) -> DataFrame:
    """Rows with fixed names and without nulls; a row of no copies only names its conversation."""
    times = F.lit(1) if copies is None else copies
    there = times > 0
    number = F.when(there, F.col(turn).cast("long"))
    return rows.select(
        F.col(conversation).isNotNull().alias("has_conv"), F.coalesce(F.col(conversation).cast("string"), F.lit("")).alias("conv"),
        number.isNotNull().alias("has_turn"), F.coalesce(number, F.lit(0).cast("long")).alias("turn"),
        F.when(there, _filled(role)).otherwise("").alias("role"), F.when(there, _filled(text)).otherwise("").alias("text"),
        times.cast("int").alias("copies"),
    )


def _repeats(read: DataFrame) -> DataFrame:
    """(conversation, turn, ``same``): turns whose role and text an earlier turn number of the conversation has too.

    Only digests are shuffled, and only those with a repeat meet again.
    """
    text = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    told = read.where("copies > 0").select("has_conv", "conv", "has_turn", "turn", F.unhex(F.sha2(text, 256)).alias("same"))
    at = F.struct("has_turn", "turn")
    again = told.groupBy("has_conv", "conv", "same").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last")
    found = told.join(again.drop("last"), ["has_conv", "conv", "same"]).where(at > F.col("first"))
    return found.select("has_conv", "conv", "has_turn", "turn", "same").distinct()


_ORDER = ("has_conv", "conv", "has_turn", "turn", "kind", "role", "text")


def repair(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: Column | None = None,
    piece: int = PIECE,
) -> DataFrame:
    """One row per conversation: its faults, the cheapest repair and the digest of the repaired text.

    Turns are taken by turn number (null first), then by role and text; equal
    rows are copies, of which the first stays. A null conversation id is one
    conversation. A null role or text reads as one space, and a turn whose role
    does not start with s, u or a cannot be kept as it is. ``copies`` may say how
    often a row counts; with 0 it only names its conversation, so that one that
    lost all turns still has its row: no faults, no edits, the digest of nothing.
    Other columns are not read. An empty table gives an empty result.

    Faults, one per turn: ``blank``, ``duplicate`` (role and text of an earlier
    turn), ``truncated`` (no final ``.!?``). ``illegal`` counts neighbours out of
    order, ``gaps`` the missing turn numbers. ``audit`` holds one letter per edit,
    (K)eep 0, (R)ename to user or assistant 2, (D)elete 3, (I)nsert an empty turn 2;
    ``cost`` adds 1 for each truncated turn that stays; of the cheapest audits
    the least in ASCII is told. It is one value, so it ends at 2 GB.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    kind = rows.schema[conversation].dataType
    read = _read(rows, conversation, turn, role, text, copies)
    marks = _repeats(read).withColumn("kind", F.lit(0))
    stream = read.withColumn("kind", F.lit(1)).unionByName(marks, allowMissingColumns=True).fillna({"copies": 0, "role": "", "text": ""})
    ordered = stream.repartition("has_conv", "conv").sortWithinPartitions(*_ORDER)
    told = ordered.mapInPandas(_walker(piece), ", ".join(f"{c} {t}" for c, t in TOLD.items()))
    told = stored(told, "turns")
    pieces = told.where("codes is not null").select("has_conv", "conv", "part", "whole", "place", "inserts", "codes")
    pieces = pieces.repartition("has_conv", "conv").sortWithinPartitions("has_conv", "conv", F.desc("part"))
    spelt = pieces.mapInPandas(_spell, "has_conv boolean, conv string, part long, piece string")
    audits = spelt.groupBy("has_conv", "conv").agg(F.array_sort(F.collect_list(F.struct("part", "piece"))).alias("pieces"))
    audits = audits.select("has_conv", "conv", F.array_join("pieces.piece", "").alias("spelt"))
    whole = told.where("whole").withColumn("giant", F.col("part") > 0)
    giants = whole.where("giant").join(audits, ["has_conv", "conv"]).withColumn("audit", F.col("spelt")).drop("spelt")
    return whole.where("not giant").unionByName(giants).select(
        F.when(F.col("has_conv"), F.col("conv").cast(kind)).alias(conversation),
        "turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )


def repaired_turns(
    rows: DataFrame,
    found: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: Column | None = None,
) -> DataFrame:
    """The turns that ``repair`` leaves: conversation, ``position`` from 0, ``edit``, ``role``, ``text``.

    ``found`` is the result of ``repair`` for the same rows. Each audit travels
    ahead of its conversation's turns, which are read in the same order.
    """
    bound_batches(rows.sparkSession)
    kind = rows.schema[conversation].dataType
    read = _read(rows, conversation, turn, role, text, copies).withColumn("kind", F.lit(1)).withColumn("audit", F.lit(None).cast("string"))
    key = F.col(conversation)
    audits = found.select(
        key.isNotNull().alias("has_conv"), F.coalesce(key.cast("string"), F.lit("")).alias("conv"), F.lit(False).alias("has_turn"),
        F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("copies"),
        F.lit(0).alias("kind"), "audit",
    )
    # a turn number of no turn sorts with the audit, which comes first by its kind
    front = F.when(F.col("kind") == 0, -1).otherwise(0)
    stream = read.unionByName(audits).withColumn("front", front)
    ordered = stream.repartition("has_conv", "conv").sortWithinPartitions("has_conv", "conv", "front", *_ORDER[2:])
    turns = ordered.mapInPandas(_apply, "has_conv boolean, conv string, position long, edit string, role string, text string")
    return turns.select(F.when(F.col("has_conv"), F.col("conv").cast(kind)).alias(conversation), "position", "edit", "role", "text")


def _apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["has_conv", "conv", "position", "edit", "role", "text"]
    key, edits, at, position, place = None, "", 0, 0, START
    for frame in frames:
        done = []

        def inserted() -> None:
            """The inserted turns that come next."""
            nonlocal at, place, position
            while at < len(edits) and edits[at] == "I":
                place = NEXT[place]
                done.append((*key, position, "I", ROLE[place], ""))
                at, position = at + 1, position + 1

        for has, conv, kind, role, text, copies, audit in zip(
            *(frame[c].tolist() for c in ("has_conv", "conv", "kind", "role", "text", "copies", "audit")), strict=True
        ):
            if kind == 0:
                key, edits, at, position, place = (has, conv), audit, 0, 0, START
                inserted()
                continue
            for _ in range(copies):
                edit, at = edits[at], at + 1
                if edit != "D":
                    place = MOVES[place, role[:1]] if edit == "K" else NEXT[place]
                    done.append((*key, position, edit, role if edit == "K" else ROLE[place], text))
                    position += 1
                inserted()
        if done:
            yield pd.DataFrame(done, columns=names)


def damage(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows damaged by the ``crc32`` of ``conversation:turn`` modulo 20, with ``copies`` (0: dropped, 2: repeated).

    0 drops a row, 1 empties its text, 2 takes away ``.!?``, 3 repeats it, 4 makes it the user's; a null reads as one space.
    """
    fate = F.crc32(F.concat(_filled(conversation), F.lit(":"), _filled(turn))) % 20
    said = F.when(fate == 1, "").when(fate == 2, F.translate(_filled(text), ".!?", "")).otherwise(_filled(text))
    return rows.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.when(fate == 4, "user").otherwise(_filled(role)).alias("role"),
        said.alias("text"), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )
