"""Keyed state of the streams: per-field records, Merkle forests and part bitmaps.

Each processor keeps one value a key, read and written once a micro-batch. All of them
take input in any order and any number of times: what a key has already seen changes
nothing, so the state grows with the keys, not with deliveries.

A key costs some calls between Python and the state store and an Arrow batch of its own in
each micro-batch, about a millisecond. ``FieldRecords`` and ``PartBitmaps`` keep the same
state for a group of keys in one value: a micro-batch that holds rows of many keys reads and
writes each group once. One of few rows would write whole groups for them, so small batches
are better off with a value a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def _struct(**types: T.DataType) -> T.StructType:
    """Spelled out, as workers have no session to parse a DDL text."""
    return T.StructType([T.StructField(name, t) for name, t in types.items()])


_INT, _LONG, _TEXT, _FLAG = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()


class FieldRecord(StatefulProcessor):
    """The current record of a key under partial updates.

    An update names the fields it writes (``written``; a written null clears the field) or
    removes the whole record (``removed``). Its place in time is ``seq``, an array of longs.
    Each field keeps the value and the ``seq`` of its latest write, so a late or repeated
    update loses field by field; a removal wins over all earlier writes, late ones included.
    Emits the record of a key that changed in this batch; ``live`` is false after a removal.
    """

    def __init__(self, fields: T.StructType):
        self.fields = fields
        self.names = fields.names
        n = len(self.names)
        self.schema = T.StructType(
            [T.StructField(f.name, f.dataType) for f in fields.fields]
            + [T.StructField(f"_seq{i}", T.ArrayType(T.LongType())) for i in range(n)]
            + [T.StructField("_removed", T.ArrayType(T.LongType())), T.StructField("_live", T.BooleanType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("record", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n = len(self.names)
        old = (*[None] * (2 * n + 1), False)
        if (known := self.state.get()) is not None:
            old = tuple(list(v) if i >= n and v is not None and i <= 2 * n else v for i, v in enumerate(known))
        values, seqs, removed = list(old[:n]), list(old[n:2 * n]), old[2 * n]
        for r in rows:
            seq = list(r.seq)
            if r.removed:
                if removed is None or seq > removed:
                    removed = seq
                continue
            for i, name in enumerate(self.names):
                if name in r.written and (seqs[i] is None or seq > seqs[i]):
                    values[i], seqs[i] = r[name], seq
        for i in range(n):
            if removed is not None and seqs[i] is not None and seqs[i] < removed:
                values[i], seqs[i] = None, None     # the removal answers for all writes before it
        live = any(s is not None for s in seqs)
        new = (*values, *seqs, removed, live)
        if new != old:
            self.state.update(new)
            yield Row(aid=key[0], live=live, **dict(zip(self.names, values)))

    def close(self) -> None:
        pass


class FieldRecords(StatefulProcessor):
    """The records of a group of keys, as :class:`FieldRecord` keeps one: an array a column, a
    place in it a key. Takes and gives data frames (``transformWithStateInPandas``), the fields in
    them and in the state as text, which no frame rounds; of ``written`` it takes one bit a field,
    and of ``seq`` a text of the same order."""

    def __init__(self, names: list[str]):
        self.names = names
        values, seqs = [f"value{i}" for i in range(len(names))], [f"seq{i}" for i in range(len(names))]
        self.schema = _struct(**{c: T.ArrayType(_TEXT) for c in ("aid", *values, *seqs, "removed")}, live=T.ArrayType(_FLAG))
        self.out = _struct(aid=_TEXT, live=_FLAG, **{c: _TEXT for c in values})

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("record", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, records, before = len(self.names), {}, {}
        if (known := self.state.get()) is not None:
            records = dict(zip(known[0], map(list, zip(*known[1:]))))
        for df in rows:
            columns = [df[c].tolist() for c in ("aid", "removed", "bits", "seq", *self.out.names[2:])]
            for aid, removed, bits, seq, *values in zip(*columns):
                record = records.get(aid)
                if record is None:
                    record = records[aid] = [*[None] * (2 * n + 1), False]
                if aid not in before:
                    before[aid] = tuple(record)
                if removed:
                    if record[2 * n] is None or seq > record[2 * n]:
                        record[2 * n] = seq
                    continue
                for i in range(n):
                    if bits >> i & 1 and (record[n + i] is None or seq > record[n + i]):
                        record[i], record[n + i] = values[i], seq
        out = []
        for aid, old in before.items():
            record = records[aid]
            removed, seqs = record[2 * n], record[n:2 * n]
            for i, seq in enumerate(seqs):
                if removed is not None and seq is not None and seq < removed:
                    record[i] = record[n + i] = None     # the removal answers for all writes before it
            record[-1] = any(s is not None for s in record[n:2 * n])
            if tuple(record) != old:
                out.append((aid, record[-1], *record[:n]))
            elif old == (*[None] * (2 * n + 1), False):
                del records[aid]     # an update that wrote nothing
        if out:
            self.state.update((list(records), *map(list, zip(*records.values()))))
            yield pd.DataFrame(out, columns=self.out.names)

    def close(self) -> None:
        pass


class MerkleForest(StatefulProcessor):
    """The tree hash of an archive's chunks as their digests arrive.

    State holds the maximal complete subtrees of the chunks that are there: a digest joins its
    sibling as soon as both are known, and an odd last node moves up unchanged. Chunks in
    order leave at most one subtree a level. When the root is there, the archive is emitted
    and its state shrinks to the mark that this attempt is done. Digests of a done or an
    earlier attempt (a lower ``rc``) change nothing; a higher ``rc`` starts a new forest.
    """

    OUT = _struct(aid=_TEXT, rc=_INT, n_parts=_INT, tree_hash=_TEXT)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("forest", _struct(
            rc=_INT, done=_FLAG, levels=T.ArrayType(_INT), places=T.ArrayType(_INT), digests=T.ArrayType(_TEXT)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rc, done, nodes = -1, False, {}
        if (known := self.state.get()) is not None:
            rc, done, levels, places, digests = known
            nodes = dict(zip(zip(levels, places), digests))
        before, out = (rc, done, len(nodes)), []
        changed = False
        for r in rows:
            if r.rc > rc:
                rc, done, nodes, changed = r.rc, False, {}, True
            if r.rc < rc or done or not 1 <= r.part_no <= r.cc:
                continue
            if _covered(nodes, r.part_no - 1, r.cc):
                continue
            changed = True
            root = _join(nodes, r.part_no - 1, r.digest, r.cc)
            if root is not None:
                out.append(Row(aid=key[0], rc=rc, n_parts=r.cc, tree_hash=root))
                done, nodes = True, {}
        if changed or before != (rc, done, len(nodes)):
            self.state.update((rc, done, [k[0] for k in nodes], [k[1] for k in nodes], list(nodes.values())))
        yield from out

    def close(self) -> None:
        pass


def _covered(nodes: dict, place: int, width: int) -> bool:
    """Whether a subtree that is there already holds this leaf."""
    level = 0
    while True:
        if (level, place) in nodes:
            return True
        if width == 1:
            return False
        level, place, width = level + 1, place >> 1, (width + 1) >> 1


def _join(nodes: dict, place: int, digest: str, width: int) -> str | None:
    """Adds a leaf and joins it upwards; the root's digest when the tree is complete."""
    level = 0
    while width > 1:
        if place ^ 1 < width:
            other = nodes.pop((level, place ^ 1), None)
            if other is None:
                nodes[level, place] = digest
                return None
            left, right = (other, digest) if place & 1 else (digest, other)
            digest = hashlib.sha256(bytes.fromhex(left) + bytes.fromhex(right)).hexdigest()
        level, place, width = level + 1, place >> 1, (width + 1) >> 1
    return digest


class PartBitmap(StatefulProcessor):
    """Which parts of an (archive, phase) are there, one bit each, until as many as the chunk
    count are; the key is emitted then, once. The bitmap shrinks to a mark, which goes when
    event time is ``keep_ms`` past the last delivery; a delivery after that would be a new run."""

    OUT = _struct(aid=_TEXT, phase=_TEXT, cc=_INT, n_parts=_LONG)

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("parts", _struct(bits=T.BinaryType(), n=_INT, done=_FLAG, last_ms=_LONG))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        bits, n, done, last = 0, 0, False, 0
        if (known := self.state.get()) is not None:
            raw, n, done, last = known
            bits = int.from_bytes(bytes(raw), "little")
        cc, was = None, last
        for r in rows:
            cc, last = r.cc, max(last, r.at_ms)
            bit = 1 << r.part_no
            if not done and not bits & bit:
                bits, n = bits | bit, n + 1
        if cc is None:
            return
        if not done and n >= cc:
            done, bits = True, 0
            yield Row(aid=key[0], phase=key[1], cc=cc, n_parts=n)
        if done and last > was or done and not was:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(last + self.keep_ms)
        self.state.update((bits.to_bytes((bits.bit_length() + 7) // 8, "little"), n, done, last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class PartBitmaps(StatefulProcessor):
    """The bitmaps and marks of a group of keys, as :class:`PartBitmap` keeps one: an array a column, a
    place in it an (archive, phase). The group has one timer, at the time that its first mark goes
    or before; when it fires, the marks whose time has come go. Takes and gives data frames
    (``transformWithStateInPandas``)."""

    OUT = PartBitmap.OUT

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("groups", _struct(
            aid=T.ArrayType(_TEXT), phase=T.ArrayType(_TEXT), bits=T.ArrayType(T.BinaryType()), n=T.ArrayType(_INT),
            done=T.ArrayType(_FLAG), last_ms=T.ArrayType(_LONG), timer_ms=_LONG))

    def _known(self) -> tuple[dict, int]:
        """``{(aid, phase): [bits, n, done, last_ms]}`` and the time of the timer, 0 for none."""
        if (known := self.state.get()) is None:
            return {}, 0
        aids, phases, bits, n, done, last, timer = known
        numbers = [int.from_bytes(bytes(b), "little") for b in bits]
        return dict(zip(zip(aids, phases), map(list, zip(numbers, n, done, last)))), timer

    def _update(self, keys: dict, timer: int) -> None:
        """Writes the group, its timer set to the first mark's time if that is earlier or there was none."""
        due = min((last + self.keep_ms for _, _, done, last in keys.values() if done), default=0)
        if due and (not timer or due < timer):
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            timer = due
        if not keys:
            self.state.clear()
            return
        bits, n, done, last = zip(*keys.values())
        self.state.update(([a for a, _ in keys], [p for _, p in keys], [b.to_bytes((b.bit_length() + 7) // 8, "little") for b in bits],
                           list(n), list(done), list(last), timer))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        keys, timer = self._known()
        counts, out = {}, []
        for df in rows:
            for aid, phase, part, cc, at in zip(*[df[c].tolist() for c in ("aid", "phase", "part_no", "cc", "at_ms")]):
                k = keys.setdefault((aid, phase), [0, 0, False, 0])
                counts[aid, phase], k[3] = cc, max(k[3], at)
                if not k[2] and not k[0] >> part & 1:
                    k[0], k[1] = k[0] | 1 << part, k[1] + 1
        for (aid, phase), cc in counts.items():
            k = keys[aid, phase]
            if not k[2] and k[1] >= cc:
                k[0], k[2] = 0, True
                out.append((aid, phase, cc, k[1]))
        if counts:
            self._update(keys, timer)
        if out:
            yield pd.DataFrame(out, columns=self.OUT.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, (keys, _) = timerValues.getCurrentWatermarkInMs(), self._known()
        self._update({key: k for key, k in keys.items() if not k[2] or k[3] + self.keep_ms > now}, 0)
        return iter(())

    def close(self) -> None:
        pass
