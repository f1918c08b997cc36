"""An idempotent receiver that can be asked, corrected and trusted with conflicts.

``dedup.unique_readings`` is the fast receiver: it remembers keys only. This one also
remembers when a key was first seen and what it said, so it can

* report a key that comes again with another payload instead of dropping it,
* forget single messages or whole stations on command, after which they are accepted again,
* list what it remembers.

Readings and commands are one stream, dealt by station and a part of the sequence number, so
that a busy station fills many tasks. Times are those of the micro-batch, which a retry keeps.
What is older than the horizon counts as forgotten, and leaves the state when its part is
swept, at most every quarter of the horizon.

A part remembers neighbouring numbers in blocks. A micro-batch reads and writes each block it
touches once, and everything else in Python goes over whole arrays: a call to the state costs
far more than a message.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.decode import decode
from ..operators.validate import accepted

ACCEPTED, CONFLICT, FORGOTTEN = "accepted", "conflict", "forgotten"
FORGET, CLEAR = "forget", "clear"
PARTS = 64
#: Numbers of a part that are remembered together.
BLOCK = 256
COMMAND = "command STRING, station_id BIGINT, s_no BIGINT"
OUTCOME = ("outcome string, station_id bigint, s_no bigint, value string, kafka_partition int, "
           "kafka_offset bigint, first_seen_ms bigint")


def _block(numbers: np.ndarray) -> np.ndarray:
    return numbers // (PARTS * BLOCK)


class _Receiver(StatefulProcessor):
    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState(
            "seen", "block bigint", "s_no array<bigint>, digest array<bigint>, first_seen_ms array<bigint>")
        self.swept = handle.getValueState("swept", "at_ms bigint")

    def _load(self, blocks: list[int], now: int) -> np.ndarray:
        """Numbers, digests and times, one row each, of what these blocks remember."""
        found = [np.array(kept, np.int64).reshape(3, -1) for b in blocks if (kept := self.seen.getValue((b,)))]
        known = np.concatenate([np.zeros((3, 0), np.int64), *found], axis=1)
        return known[:, known[2] > now - self.horizon_ms]

    def _save(self, known: np.ndarray, blocks: np.ndarray) -> None:
        """Write the given blocks anew from ``known``, which holds all of their numbers."""
        known = known[:, np.argsort(known[0])]
        places = _block(known[0])
        for block in np.unique(blocks):
            start, stop = np.searchsorted(places, block), np.searchsorted(places, block, "right")
            if stop > start:
                self.seen.updateValue((int(block),), tuple(known[:, start:stop].tolist()))
            elif self.seen.containsKey((int(block),)):
                self.seen.removeKey((int(block),))

    def _sweep(self, now: int) -> None:
        if self.swept.exists() and now - self.swept.get()[0] < self.horizon_ms / 4:
            return
        for block in self._blocks():
            if min(self.seen.getValue((block,))[2]) <= now - self.horizon_ms:
                self._save(self._load([block], now), np.array([block]))
        self.swept.update((now,))

    def _blocks(self) -> list[int]:
        return [key[0] for key in list(self.seen.keys())]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        now = int(batch.now_ms.iloc[0])
        self._sweep(now)
        is_command = batch.command.notna().to_numpy()
        commands = batch[is_command]
        readings = batch[~is_command].sort_values(["kafka_offset", "kafka_partition"]) \
            .drop_duplicates(["s_no", "digest"])
        # Commands first: what they forget may come again in the same micro-batch.
        clear = (commands.command == CLEAR).any()
        blocks = np.unique(_block(batch.s_no.to_numpy()[~is_command | (batch.command == FORGET).to_numpy()]))
        known = self._load(sorted({*blocks.tolist(), *self._blocks()}) if clear else blocks.tolist(), now)
        gone = np.ones(known.shape[1], bool) if clear else np.isin(known[0], commands.s_no.to_numpy())
        forgotten, known = known[:, gone], known[:, ~gone]

        numbers, digests = readings.s_no.to_numpy(), readings.digest.to_numpy()
        place = pd.Index(known[0]).get_indexer(numbers)
        seen, again = place >= 0, readings.s_no.duplicated().to_numpy()
        fresh = ~seen & ~again
        # An unseen number that comes again has another payload, as equal copies are gone.
        told, first = np.zeros(len(numbers), np.int64), np.full(len(numbers), now)
        told[seen], first[seen] = known[1, place[seen]], known[2, place[seen]]
        conflict = ~fresh & (~seen | (digests != told))

        added = np.stack([numbers[fresh], digests[fresh], first[fresh]])
        self._save(np.concatenate([known, added], axis=1), _block(np.concatenate([forgotten[0], added[0]])))
        out = readings.assign(outcome=np.where(fresh, ACCEPTED, CONFLICT), first_seen_ms=first)[fresh | conflict]
        if forgotten.size or len(out):
            dropped = pd.DataFrame({"outcome": FORGOTTEN, "s_no": forgotten[0], "value": None,
                                    "kafka_partition": None, "kafka_offset": None, "first_seen_ms": forgotten[2]})
            frame = dropped.astype({"kafka_partition": "Int64", "kafka_offset": "Int64"})
            frame = pd.concat([frame, out[frame.columns]]) if len(out) else frame
            frame.insert(1, "station_id", key[0])
            yield frame


def received(arrivals: DataFrame, commands: DataFrame | None, horizon_ms: int) -> DataFrame:
    """Outcomes of valid readings and of commands (``command``, ``station_id``, ``s_no``).

    ``forget`` drops one message, ``clear`` all of a station. A message is remembered for
    ``horizon_ms`` after it was first seen. Equal copies make no row.
    """
    part = F.pmod(F.col("s_no"), F.lit(PARTS)).cast("int")
    none, zero = F.lit(None), F.lit(0).cast("bigint")  # a null would turn offsets into floats
    messages = accepted(decode(arrivals)).select(
        "station_id", part.alias("part"), "s_no", none.cast("string").alias("command"), "value",
        "kafka_partition", "kafka_offset", F.xxhash64("value").alias("digest"))
    if commands is not None:
        every = F.sequence(F.lit(0), F.lit(PARTS - 1))
        where = F.when(F.col("command") == CLEAR, every).otherwise(F.array(part))
        messages = messages.unionByName(commands.where(F.col("command").isin(FORGET, CLEAR)).select(
            "station_id", F.explode(where).alias("part"), F.coalesce("s_no", zero).alias("s_no"),
            "command", none.cast("string").alias("value"), zero.cast("int").alias("kafka_partition"),
            zero.alias("kafka_offset"), zero.alias("digest")))
    return messages.withColumn("now_ms", F.unix_millis(F.current_timestamp())) \
        .groupBy("station_id", "part").transformWithStateInPandas(_Receiver(horizon_ms), OUTCOME, "Append", "None")


def remembered(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """The messages a receiver remembers, and since when."""
    state = spark.read.format("statestore").option("operatorId", operator_id).option("stateVarName", "seen") \
        .load(checkpoint)
    kept = F.arrays_zip(*[F.col(f"user_map_value.{name}") for name in ("s_no", "digest", "first_seen_ms")])
    return state.select("key.station_id", F.inline(kept).alias("s_no", "digest", "first_seen_ms")).drop("digest")
