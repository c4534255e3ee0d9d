"""Stateful operators on streams: previous slot values under reorgs, alerts and absence.

Each equals its batch counterpart on the same rows; see the functions in ``operators``.

A row of its own for every sample or change would cost a few calls to the state server.  So tasks
pack rows by key before the shuffle, sorted, as columns in one binary value; the state keeps such
values, and what comes out is unpacked by tasks again.
"""

import sys
from bisect import bisect_left, bisect_right, insort
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor


#: Rows that a task packs at once, and rows of a packed value.
ROWS = 500_000
CHUNK = 10_000


def _gathered(batches):
    """The batches of a task, as tables of ``ROWS`` rows or a batch more."""
    waiting, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rows += batch.num_rows
        if rows >= ROWS:
            yield pa.Table.from_batches(waiting).combine_chunks()
            waiting, rows = [], 0
    if rows:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _numbers(column, null=0) -> np.ndarray:
    return column.combine_chunks().fill_null(null).to_numpy(zero_copy_only=False)


def _known(column) -> np.ndarray:
    return column.combine_chunks().is_valid().to_numpy(zero_copy_only=False)


def _codes(column) -> tuple:
    """A number for each value, null among them, and the values."""
    found = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _borders(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)


def _pieces(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and every ``CHUNK`` rows inside them."""
    starts = _borders(keys)
    ends = np.append(starts[1:], len(keys))
    return np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(starts, ends)] or [np.zeros(0, int)])


def _numeric(packed, *kinds) -> list:
    """The columns of a packed value whose rows are numbers of these kinds."""
    rows = len(packed) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(packed, kind, rows, at))
        at += out[-1].nbytes
    return out


def _several(batch):
    """Row numbers of a batch of packed values, a bounded number of bytes together."""
    sizes = np.cumsum([v.as_buffer().size for v in batch.column("packed")])
    found = np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(sizes // (8 << 20))) + 1)
    return (f for f in found if len(f))


# ---- previous value of a changed slot, kept on write

#: Heights of a piece of a slot's changes: the state reads and writes pieces.
HEIGHTS = 1024
LOWEST = -(1 << 63)
COMMITTED, VALUE = 1, 2
LIVE, NEW, PREVIOUS = 1, 2, 4


class Changes(NamedTuple):
    """Changes of one slot by height: net sign, newest commit's sequence and value, and whether there
    is a commit and a value in it."""

    height: np.ndarray
    net: np.ndarray
    seq: np.ndarray
    flags: np.ndarray
    value: pa.Array

    def cut(self, a, b):
        return Changes(self.height[a:b], self.net[a:b], self.seq[a:b], self.flags[a:b], self.value.slice(a, b - a))

    def packed(self) -> bytes:
        return b"".join([len(self.height).to_bytes(8, "little"), *(c.tobytes() for c in self[:4]), *_binary(self.value)])


def _binary(values) -> tuple:
    """Offsets and bytes of binary values."""
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset) if len(values) else np.zeros(1, np.int32)
    data = values.buffers()[2]
    return (offsets - offsets[0]).tobytes(), b"" if data is None else memoryview(data)[offsets[0]:offsets[-1]]


def _read_binary(packed, rows: int, at: int) -> tuple:
    """Values written by :func:`_binary`, and where they end."""
    offsets = np.frombuffer(packed, np.int32, rows + 1, at)
    start = at + offsets.nbytes
    end = start + int(offsets[-1])
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed[start:end])]), end


def _changes(packed) -> Changes:
    packed = bytes(packed)
    rows, at, out = int.from_bytes(packed[:8], "little"), 8, []
    for kind in (np.int64, np.int64, np.int64, np.uint8):
        out.append(np.frombuffer(packed, kind, rows, at))
        at += out[-1].nbytes
    return Changes(*out, _read_binary(packed, rows, at)[0])


def _newest(height, net, seq, flags, value, key=None) -> tuple:
    """One change for each height (of each key): signs added up, the commit of the greatest sequence,
    of equal ones the first.  With the keys, if there are any."""
    order = np.lexsort((-np.arange(len(height)), seq, flags & COMMITTED, height, *([] if key is None else [key])))
    moved = height[order][1:] != height[order][:-1]
    if key is not None:
        moved |= key[order][1:] != key[order][:-1]
    first = np.flatnonzero(np.concatenate([[True], moved]))
    pick = order[np.append(first[1:], len(order)) - 1]
    out = Changes(height[pick], np.add.reduceat(net[order], first), seq[pick], flags[pick], value.take(pa.array(pick)))
    return out, None if key is None else key[pick]


def _together(parts: list) -> Changes:
    return _newest(*(np.concatenate(c) for c in list(zip(*parts))[:4]), pa.concat_arrays([p.value for p in parts]))[0]


def _pack_changes(batches):
    for rows in _gathered(batches):
        (a, addresses), (s, slots) = _codes(rows.column("address")), _codes(rows.column("slot"))
        committed = _numbers(rows.column("sign")) == 1
        value = rows.column("value").combine_chunks()
        flags = committed * COMMITTED + (committed & _known(rows.column("value"))) * VALUE
        changes, key = _newest(_numbers(rows.column("block_number"), LOWEST), _numbers(rows.column("sign")),
                               _numbers(rows.column("seq"), LOWEST), flags.astype(np.uint8), value.fill_null(b""), a * len(slots) + s)
        starts = _pieces(key)
        yield pa.RecordBatch.from_arrays([
            addresses.take(pa.array(key[starts] // len(slots))), slots.take(pa.array(key[starts] % len(slots))),
            pa.array([changes.cut(x, y).packed() for x, y in zip(starts, np.append(starts[1:], len(key)))], pa.binary())],
            ["address", "slot", "packed"])


class SlotProcessor(StatefulProcessor):
    """Keeps the changes of one slot by height, in pieces of ``HEIGHTS``, and which pieces hold a live
    one.  When some changes come, it emits anew these and, for each, the next live one above, whose
    previous value is another now."""

    def init(self, handle) -> None:
        self.pieces = handle.getMapState("pieces", "piece bigint", "packed binary")
        self.state = handle.getValueState("state", "version bigint, live binary")

    def _piece(self, piece: int):
        found = self.pieces.getValue((piece,))
        return None if found is None else _changes(found[0])

    def _before(self, live: list, piece: int) -> tuple:
        """Value, if any, of the last live change in the pieces below."""
        i = bisect_left(live, piece)
        if not i:
            return b"", False
        if self.top is None or self.top[0] != live[i - 1]:
            self._remember(live[i - 1], self._piece(live[i - 1]))
        return self.top[1:]

    def _remember(self, piece: int, held: Changes) -> None:
        last = np.flatnonzero(held.net > 0)[-1]
        self.top = piece, held.value[int(last)].as_py(), bool(held.flags[last] & VALUE)

    def _out(self, key, version: int, live: list, piece: int, held: Changes, emit: np.ndarray):
        """The changes to emit, with the values before them."""
        place, alive = np.arange(len(emit)), held.net > 0
        before = np.concatenate([[-1], np.maximum.accumulate(np.where(alive, place, -1))[:-1]])[emit]
        alive = alive[emit]
        below = self._before(live, piece) if (alive & (before < 0)).any() else (b"", False)
        known = np.append((held.flags & VALUE) > 0, below[1])
        values = pa.concat_arrays([held.value, pa.array([below[0]], pa.binary())])
        new, old = alive & known[:-1][emit], alive & known[before]
        flags = (alive * LIVE + new * NEW + old * PREVIOUS).astype(np.uint8)
        return Row(address=key[0], slot=key[1], version=version, packed=b"".join([
            len(flags).to_bytes(8, "little"), held.height[emit].tobytes(), flags.tobytes(),
            *_binary(held.value.filter(pa.array(emit))), *_binary(values.take(pa.array(before % len(values))))]))

    def handleInputRows(self, key, rows, timerValues):
        came = _together([_changes(r["packed"]) for r in rows])
        version, known = self.state.get() if self.state.exists() else (0, b"")
        version, live = version + 1, np.frombuffer(bytes(known), np.int64).tolist()
        self.top = None
        home = came.height // HEIGHTS
        starts = _borders(home)
        # whether a change below has met no live one above it so far
        waiting, at = False, None

        def following(upto):
            """Emit the first live change of the next piece, below ``upto``, that has one."""
            i = bisect_right(live, at)
            if i == len(live) or (upto is not None and live[i] >= upto):
                return None
            held = self._piece(live[i])
            return self._out(key, version, live, live[i], held, np.arange(len(held.net)) == np.argmax(held.net > 0))

        for a, b in zip(starts, np.append(starts[1:], len(home))):
            part, piece = came.cut(a, b), int(home[a])
            if waiting and (row := following(piece)):
                yield row
                waiting = False
            at = piece
            held = self._piece(piece)
            held = part if held is None else _together([held, part])
            self.pieces.updateValue((piece,), (held.packed(),))
            alive = held.net > 0
            i = bisect_left(live, piece)
            if i < len(live) and live[i] == piece:
                if not alive.any():
                    del live[i]
            elif alive.any():
                insort(live, piece)
            emit = np.isin(held.height, part.height)
            ends = len(emit)
            above = np.append(np.minimum.accumulate(np.where(alive, np.arange(ends), ends)[::-1])[::-1], ends)
            nexts = above[1:][emit]
            emit[nexts[nexts < ends]] = True
            if waiting and above[0] < ends:
                emit[above[0]] = True
            waiting = (waiting and not alive.any()) or bool((nexts == ends).any())
            yield self._out(key, version, live, piece, held, emit)
            if alive.any():
                self._remember(piece, held)
        if waiting and (row := following(None)):
            yield row
        self.state.update((version, np.array(live, np.int64).tobytes()))

    def close(self) -> None:
        pass


SLOT = ("address binary, slot binary, block_number bigint, version bigint, live boolean, value binary, previous_value binary")


def _unpack_changes(batches):
    for batch in batches:
        for some in _several(batch):
            heights, flags, new, old = [], [], [], []
            for i in some:
                packed = batch.column("packed")[int(i)].as_py()
                rows = int.from_bytes(packed[:8], "little")
                heights.append(np.frombuffer(packed, np.int64, rows, 8))
                flags.append(np.frombuffer(packed, np.uint8, rows, 8 + 8 * rows))
                value, at = _read_binary(packed, rows, 8 + 9 * rows)
                new.append(value)
                old.append(_read_binary(packed, rows, at)[0])
            whose = pa.array(np.repeat(some, [len(h) for h in heights]))
            height, flag = np.concatenate(heights), np.concatenate(flags)
            new, old = (pc.if_else(pa.array((flag & f) > 0), pa.concat_arrays(v), pa.scalar(None, pa.binary()))
                        for f, v in ((NEW, new), (PREVIOUS, old)))
            yield pa.RecordBatch.from_arrays([
                batch.column("address").take(whose), batch.column("slot").take(whose), pa.array(height, mask=height == LOWEST),
                batch.column("version").take(whose), pa.array((flag & LIVE) > 0), new, old],
                ["address", "slot", "block_number", "version", "live", "value", "previous_value"])


def previous_slot_values(diffs: DataFrame) -> DataFrame:
    """A stream of new versions of storage changes with the value the slot held before.  ``diffs``
    are signed changes in any order; :func:`read_previous` takes the newest version of each."""
    rows = diffs.select("address", "slot", "block_number", F.col("sign").cast("bigint").alias("sign"), "seq", "value")
    packed = rows.mapInArrow(_pack_changes, "address binary, slot binary, packed binary")
    return packed.groupBy("address", "slot").transformWithState(
        SlotProcessor(), "address binary, slot binary, version bigint, packed binary", "append", "None").mapInArrow(_unpack_changes, SLOT)


def read_previous(versions: DataFrame) -> DataFrame:
    """The current storage changes with their previous values."""
    keys = ["address", "slot", "block_number"]
    newest = versions.groupBy(*keys).agg(F.max(F.struct("version", "live", "value", "previous_value")).alias("v"))
    return newest.where("v.live").select(*keys, "v.value", "v.previous_value")


# ---- alerts and absence

#: Samples that are put in order together, besides those of chunks that reach beyond.
MERGE = 1_000_000
HOT, GIVEN, SINCE = 1, 2, 4
STATES = ["inactive", "pending", "firing", "absent"]
INACTIVE, PENDING, FIRING, ABSENT = (i << 3 for i in range(4))


def _pack_samples(batches):
    for rows in _gathered(batches):
        if rows.column("micros").null_count:
            raise ValueError("a sample has no time")
        code, names = _codes(rows.column("name"))
        micros = _numbers(rows.column("micros"))
        flags = (_numbers(rows.column("hot"), False) * HOT + _known(rows.column("value")) * GIVEN).astype(np.uint8)
        order = np.lexsort((micros, code))
        code, columns = code[order], (micros[order], _numbers(rows.column("value"), 0.0)[order], flags[order])
        starts = _pieces(code)
        ends = np.append(starts[1:], len(code))
        yield pa.RecordBatch.from_arrays([
            names.take(pa.array(code[starts])), pa.array(columns[0][starts]), pa.array(columns[0][ends - 1]),
            pa.array([b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(starts, ends)], pa.binary())],
            ["name", "first", "last", "packed"])


class AlertProcessor(StatefulProcessor):
    """Holds the samples of one series until the watermark is past them, then takes them in order
    through inactive, pending and firing.  A timer after the last sample reports absence.

    Times are microseconds here, since several samples may share a millisecond.  One timer stands
    at the earliest sample that waits.  Samples wait in sorted chunks, which are merged from the
    earliest on, so that a task holds the chunks that overlap and not all that waited."""

    def __init__(self, hold_ms: int, absent_ms: int):
        self.hold, self.absent = hold_ms * 1000, absent_ms * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("chunks", "first bigint, last bigint, chunk bigint", "packed binary")
        self.state = handle.getValueState("state", "since bigint, last bigint, absent boolean, due bigint, chunks bigint")

    def _known(self):
        return self.state.get() if self.state.exists() else (None, None, False, None, 0)

    def handleInputRows(self, key, rows, timerValues):
        since, last, absent, due, chunks = self._known()
        first = None
        for r in rows:
            self.waiting.updateValue((r["first"], r["last"], chunks), (bytes(r["packed"]),))
            chunks += 1
            first = r["first"] if first is None else min(first, r["first"])
        if due is None or first < due:
            self.handle.registerTimer(first // 1000)
            due = first
        self.state.update((since, last, absent, due, chunks))
        yield from ()

    def _ready(self, keys: list, now: int, rest: list):
        """The samples up to ``now``, in order, some at a time; what comes after it goes to ``rest``."""
        held, fresh = [], 0
        for i, k in enumerate(keys):
            held.append(_numeric(bytes(self.waiting.getValue(k)[0]), np.int64, np.float64, np.uint8))
            self.waiting.removeKey(k)
            fresh += len(held[-1][0])
            ends = i + 1 == len(keys)
            if fresh >= MERGE or ends:
                columns = [np.concatenate(c) for c in zip(*held)]
                order = np.argsort(columns[0], kind="stable")
                columns = [c[order] for c in columns]
                # no chunk that is still to come has a sample below its first
                cut = np.searchsorted(columns[0], now, "right") if ends else np.searchsorted(columns[0], keys[i + 1][0])
                for a in range(0, cut, CHUNK):
                    yield [c[a:min(a + CHUNK, cut)] for c in columns]
                held, fresh = [[c[cut:] for c in columns]], 0
        rest += held

    def _row(self, key, micros, value, since, flags):
        return Row(name=key[0], part=int(micros[0]), packed=b"".join(
            np.ascontiguousarray(c, t).tobytes() for c, t in ((micros, np.int64), (value, np.float64), (since, np.int64), (flags, np.uint8))))

    def _states(self, key, micros, value, flags, since, last, absent):
        """The state at each of some samples in order, and absence before it."""
        hot = (flags & HOT) > 0
        was = np.concatenate([[since is not None], hot[:-1]])
        start = np.maximum.accumulate(np.where(hot & ~was, np.arange(len(hot)), -1))
        began = np.where(start >= 0, micros[start], 0 if since is None else since)
        state = np.where(~hot, INACTIVE, np.where(micros >= began + self.hold, FIRING, PENDING))
        before = np.concatenate([[micros[0] if last is None or absent else last], micros[:-1]])
        gap = np.flatnonzero(before + self.absent < micros)
        open_ = np.concatenate([[0 if since is None else since], began[:-1]])
        out = self._row(key, np.insert(micros, gap, before[gap] + self.absent), np.insert(value, gap, 0.0), np.insert(began, gap, open_[gap]),
                        np.insert((flags & GIVEN) + hot * SINCE + state, gap, was[gap] * SINCE + ABSENT))
        return out, int(began[-1]) if hot[-1] else None, int(micros[-1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000 + 999
        since, last, absent, due, chunks = self._known()
        came = False
        if due is not None and due <= now:
            keys = sorted(tuple(k) for k in self.waiting.keys())
            later = [k[0] for k in keys if k[0] > now]
            rest = []
            for micros, value, flags in self._ready([k for k in keys if k[0] <= now], now, rest):
                row, since, last = self._states(key, micros, value, flags, since, last, absent)
                absent, came = False, True
                yield row
            for micros, value, flags in rest:
                for a in range(0, len(micros), CHUNK):
                    some = [c[a:a + CHUNK] for c in (micros, value, flags)]
                    self.waiting.updateValue((int(some[0][0]), int(some[0][-1]), chunks), (b"".join(c.tobytes() for c in some),))
                    chunks += 1
                    later.append(int(some[0][0]))
            due = min(later, default=None)
            if due is not None:
                self.handle.registerTimer(due // 1000)
        if last is not None:
            if not absent and last + self.absent <= now:
                yield self._row(key, [last + self.absent], [0.0], [0 if since is None else since], [ABSENT + (since is not None) * SINCE])
                absent = True
            elif came:
                self.handle.registerTimer((last + self.absent) // 1000)
        self.state.update((since, last, absent, due, chunks))

    def close(self) -> None:
        pass


ALERT = "name string, millis bigint, value double, active_since bigint, state string"


def _unpack_alerts(batches):
    for batch in batches:
        for some in _several(batch):
            found = [_numeric(batch.column("packed")[int(i)].as_py(), np.int64, np.float64, np.int64, np.uint8) for i in some]
            whose = pa.array(np.repeat(some, [len(f[0]) for f in found]))
            micros, value, since, flags = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([
                batch.column("name").take(whose), pa.array(micros // 1000), pa.array(value, mask=(flags & GIVEN) == 0),
                pa.array(since // 1000, mask=(flags & SINCE) == 0), pa.array(STATES, pa.string()).take(pa.array(flags >> 3))],
                ["name", "millis", "value", "active_since", "state"])


def alerts(samples: DataFrame, condition, hold_ms: int, delay: str, absent_ms: int) -> DataFrame:
    """State of an alert at each sample, as ``metrics.alert_states`` gives it, once the watermark
    (``delay`` behind the newest sample of any series) is past it; and a row ``absent`` where a
    series has had no sample for ``absent_ms`` though others go on."""
    rows = samples.withWatermark("ts", delay).select(
        "name", F.unix_micros("ts").alias("micros"), "value", F.coalesce(condition, F.lit(False)).alias("hot"))
    packed = rows.mapInArrow(_pack_samples, "name string, first bigint, last bigint, packed binary")
    found = packed.groupBy("name").transformWithState(
        AlertProcessor(hold_ms, absent_ms), "name string, part bigint, packed binary", "append", "EventTime")
    # one series may be most of the samples: its rows are unpacked and written by many tasks
    return found.repartition("name", "part").mapInArrow(_unpack_alerts, ALERT)


# executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
