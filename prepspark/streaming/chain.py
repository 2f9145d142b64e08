"""AU2 on a stream: hash chains that go on from micro-batch to micro-batch.

The state of a dataset is its last sequence number and hash, kept by Structured Streaming's state store and
restored from the checkpoint after a restart.  Of a micro-batch, a dataset's rows are linked in the order of
their numbers; a row whose number is not above the last one is a repetition or comes too late, and is
handed on as rejected, without a hash.  Memory is one dataset's rows of one micro-batch.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.audit import GENESIS

STATE = "last long, hash string"


def _linked(key, frames, state: GroupState):
    last, prev = state.get if state.exists else (None, GENESIS)
    rows = pd.concat(list(frames)).sort_values("__o", kind="stable", na_position="first")
    orders, prevs, hashes = [], [], []
    for o, p in zip(rows["__o"].tolist(), rows["__p"].tolist()):
        o = None if pd.isna(o) else int(o)
        orders.append(o)
        if o is None or last is not None and o <= last:
            prevs.append(None)
            hashes.append(None)
            continue
        prevs.append(prev)
        prev = hashlib.sha256(((p or "") + prev).encode("utf-8")).hexdigest()
        hashes.append(prev)
        last = o
    if last is not None:
        state.update((last, prev))
    yield pd.DataFrame({
        "__g": [key[0]] * len(orders), "__o": pd.array(orders, "Int64"), "prev_hash": pd.Series(prevs, dtype=object),
        "current_hash": pd.Series(hashes, dtype=object), "accepted": [h is not None for h in hashes]})


def stream_chain(events: DataFrame, by: str, order: str, payload: str) -> DataFrame:
    """(by, order, prev_hash, current_hash, accepted) of a streaming frame, to be written in append mode."""
    source = events.select(F.col(by).cast("string").alias("__g"), F.col(order).cast("long").alias("__o"), F.col(payload).cast("string").alias("__p"))
    out = source.groupBy("__g").applyInPandasWithState(
        _linked, "__g string, __o long, prev_hash string, current_hash string, accepted boolean", STATE, "append", GroupStateTimeout.NoTimeout)
    return out.withColumnsRenamed({"__g": by, "__o": order})
