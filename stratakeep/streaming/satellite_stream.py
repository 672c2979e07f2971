"""A satellite as a stream: the state of a key is the digest of its last row.

A batch load compares with stored rows; a stream that never ends would read them
again for every micro-batch. Here Spark keeps one digest per key in its state
store, so a micro-batch reads no stored row, and a restart goes on from the
checkpoint.

Calling Python costs far more than a row does, so keys are dealt by a hash into
``STATE_GROUPS`` groups and the state of a group holds the digests of its keys. A
micro-batch calls once for each group that it has rows of and reads and writes
the state of these groups only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stratakeep.operators.satellite import HASH_DIFF
from stratakeep.plans.warehouse import Warehouse


# Groups that keys are dealt into. Fixed value: state already stored depends on it.
STATE_GROUPS = 4096

_GROUP = "_group"
_KEY = "_key"


def changed_rows(rows: DataFrame, hash_key: str, order: Sequence[str]) -> DataFrame:
    """Rows of a stream whose digest differs from the row before of their key.

    Rows of one micro-batch are taken in ``order``; a row is compared with the one
    before it in the micro-batch or else with the last of earlier ones. All rows of a
    group of keys in one micro-batch meet in one task, so the size of a micro-batch
    bounds it.
    """
    columns = rows.columns

    def follow(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        whole = pd.concat(list(frames)).sort_values([_KEY, *order, HASH_DIFF], kind="stable", ignore_index=True)
        keys, digests = whole[_KEY].tolist(), whole[HASH_DIFF].tolist()
        last = dict(zip(*state.get, strict=True)) if state.exists else {}
        changed = []
        for key, digest in zip(keys, digests, strict=True):
            changed.append(key not in last or last[key] != digest)
            last[key] = digest
        state.update((list(last.keys()), list(last.values())))
        yield whole.loc[changed, columns]

    key = F.col(hash_key).cast("string")
    dealt = rows.withColumns({_KEY: key, _GROUP: F.pmod(F.xxhash64(key), F.lit(STATE_GROUPS))})
    return dealt.groupBy(_GROUP).applyInPandasWithState(
        follow, rows.schema, "keys array<string>, digests array<string>", "append", GroupStateTimeout.NoTimeout
    )


def stream_satellite(
    rows: DataFrame, hash_key: str, order: Sequence[str], root: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Append the changed rows of a stream in satellite form (see
    ``satellite_rows``) to a table, and stop when no more has arrived.

    Each micro-batch is a load named after the stream and its number, so one
    that is replayed replaces what it wrote before. No other run may write
    to ``table``, whose keys' state lies in ``checkpoint``.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        vault = Warehouse(batch.sparkSession, root, f"stream-{table}-{stream}-{batch_id}", owner=f"stream {stream}")
        with vault.writing(table):
            vault.append(batch, table)

    changed = changed_rows(rows, hash_key, order)
    return changed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
