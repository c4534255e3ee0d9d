"""Flat rows of blocks, transactions and logs to nested notifications, by Arrow offsets.

The rows come sorted by block, transaction and place, so nesting copies no row: a list is a
pair of offsets into the rows below it.  A task holds one Arrow batch and the block that runs
over its end.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

#: Notifications of a block by its fork class: kind, old and new side; fork 1 replaces fork 0.
STEPS = {"plain": [("ChainCommitted", None, 0)],
         "replaced": [("ChainCommitted", None, 0), ("ChainReorged", 0, 1)],
         "orphaned": [("ChainCommitted", None, 0), ("ChainReverted", 0, None)],
         "dup_revert": [("ChainCommitted", None, 0), ("ChainReverted", 0, None), ("ChainReverted", 0, None)]}


def _lists(values, starts, ends, kind):
    """A list per (start, end), over a copy of the values only where these are not in a row."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if not (np.array_equal(starts, offsets[:-1]) and offsets[-1] == len(values)):
        values = values.take(pa.array(np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _typed(values, kind.value_type), type=kind)


def _typed(values, kind):
    # columns that cannot be null arrive as such
    return values if values.type == kind else values.cast(kind)


def _struct(kind, *columns):
    return pa.StructArray.from_arrays([_typed(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))


def _borders(sorted_keys):
    """Where runs of equal keys start."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, int)


def _state(logs, at, blocks, kind):
    """Last value of every slot by account, of each of ``blocks`` blocks; null without any."""
    columns = [logs.column(n) for n in ("address", "slot")]
    address, slot = (c.dictionary_encode() for c in columns)
    a, s = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (address, slot))
    width, depth = len(address.dictionary) + 1, len(slot.dictionary) + 1
    key = (at * width + a) * depth + s
    order = np.argsort(key, kind="stable")
    ends = np.append(_borders(key[order])[1:], len(order)) - 1 if len(order) else np.zeros(0, int)
    last = order[ends]
    last = last[logs.column("data").is_valid().to_numpy(zero_copy_only=False)[last]]
    account = key[last] // depth
    inner = _borders(account)
    block = account[inner] // width
    slots = pa.MapArray.from_arrays(pa.array(np.append(inner, len(last)), pa.int32()), columns[1].take(pa.array(last)),
                                    logs.column("data").take(pa.array(last)), type=kind.item_type)
    outer = np.searchsorted(block, np.arange(blocks + 1))
    return pa.MapArray.from_arrays(pa.array(outer, pa.int32()), columns[0].take(pa.array(last[inner])), slots, type=kind,
                                   mask=pa.array(outer[1:] == outer[:-1]))


def _blocks(ids, header, txs, logs, kind):
    """Block structs of the heights ``ids`` from their transactions and logs, all in order."""
    def numbers(rows, name):
        return rows.column(name).to_numpy(zero_copy_only=False)
    tx_block, log_block = numbers(txs, "block_number"), numbers(logs, "block_number")
    tx_at, log_at = np.searchsorted(ids, tx_block), np.searchsorted(ids, log_block)
    tx_key, log_key = (at * (1 << 20) + numbers(rows, "tx_index") for at, rows in ((tx_at, txs), (log_at, logs)))
    receipt = kind.field("receipts").type
    entry = receipt.value_type.field("logs").type
    made = _struct(entry.value_type, *[logs.column(n) for n in ("address", "topics", "data")])
    per_tx = _lists(made, np.searchsorted(log_key, tx_key), np.searchsorted(log_key, tx_key, side="right"), entry)
    parts = txs.column("tx")
    receipts = _struct(receipt.value_type, parts.field("status"), parts.field("used"), per_tx)
    starts, ends = np.searchsorted(tx_at, np.arange(len(ids))), np.searchsorted(tx_at, np.arange(len(ids)), side="right")
    transactions = kind.field("transactions").type
    return _struct(kind, header, _lists(parts.field("tx"), starts, ends, transactions), _lists(receipts, starts, ends, receipt),
                   _state(logs, log_at, len(ids), kind.field("state").type))


def _notifications(rows, schema):
    head = rows.column("head")
    known = head.is_valid().to_numpy(zero_copy_only=False)
    is_tx = rows.column("tx").is_valid().to_numpy(zero_copy_only=False)
    numbers = rows.column("block_number").to_numpy(zero_copy_only=False)
    ids = numbers[known]
    # logs of blocks that do not exist belong nowhere
    is_log = ~known & ~is_tx & np.isin(numbers, ids)
    heads = head.filter(pa.array(known))
    kind = schema.field("new").type.value_type
    forks = heads.field("kind").to_numpy(zero_copy_only=False)
    first = _blocks(ids, heads.field("b0"), rows.filter(pa.array(is_tx)), rows.filter(pa.array(is_log)), kind)
    # the replacing fork leaves out the last transaction of the block
    replaced = np.flatnonzero(forks == "replaced")
    kept = np.isin(numbers, ids[replaced]) & (rows.column("tx_index").fill_null(9).to_numpy(zero_copy_only=False) != 9)
    second = _blocks(ids[replaced], heads.field("b1").take(pa.array(replaced)), rows.filter(pa.array(kept & is_tx)),
                     rows.filter(pa.array(kept & is_log)), kind)
    both = pa.concat_arrays([first, second])
    place = {0: np.arange(len(ids)), 1: np.full(len(ids), -1)}
    place[1][replaced] = len(ids) + np.arange(len(replaced))
    at, seq, kinds, sides = [], [], [], {1: [], 2: []}
    for fork, steps in STEPS.items():
        mine = np.flatnonzero(forks == fork)
        for number, step in enumerate(steps):
            at.append(mine)
            seq.append(ids[mine] * 4 + number)
            kinds.append(np.full(len(mine), step[0], object))
            for side in (1, 2):
                sides[side].append(np.full(len(mine), -1) if step[side] is None else place[step[side]][mine])
    order = np.argsort(np.concatenate(seq), kind="stable")
    out = []
    for side, name in ((1, "old"), (2, "new")):
        found = np.concatenate(sides[side])[order]
        sizes = (found >= 0).astype(np.int32)
        out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                            both.take(pa.array(found[found >= 0])), type=schema.field(name).type))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(seq)[order]), pa.array(np.concatenate(kinds)[order], pa.string()), *out],
                                      schema=schema)


def nest(schema):
    """Turns sorted flat rows into notifications; blocks stay whole where a batch ends inside one."""
    def run(batches):
        waiting = []
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column("block_number").to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(numbers, numbers[-1]))
            if cut or (waiting and waiting[-1].column("block_number")[-1].as_py() != numbers[0]):
                yield _notifications(pa.concat_batches([*waiting, batch.slice(0, cut)]), schema)
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield _notifications(pa.concat_batches(waiting), schema)
    return run


# executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
