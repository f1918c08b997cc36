"""The receiver against a plain dictionary, and how often it calls its state."""

import numpy as np
import pandas as pd

from gaugeline.streaming.receiver import ACCEPTED, CLEAR, CONFLICT, FORGET, FORGOTTEN, PARTS, _Receiver

HOUR_MS = 3_600_000


class State:
    """Map and value state in memory that counts its calls."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def _do(self, result):
        self.calls += 1
        return result

    def keys(self):
        return self._do(iter(list(self.rows)))

    def iterator(self):
        return self._do(iter(list(self.rows.items())))

    def containsKey(self, key):
        return self._do(key in self.rows)

    def getValue(self, key):
        return self._do(self.rows.get(key))

    def updateValue(self, key, value):
        self._do(self.rows.update({key: value}))

    def removeKey(self, key):
        self._do(self.rows.pop(key))

    def exists(self):
        return () in self.rows

    def get(self):
        return self.rows[()]

    def update(self, value):
        self.rows[()] = value


class Handle:
    def __init__(self):
        self.map, self.value = State(), State()

    def getMapState(self, *_):
        return self.map

    def getValueState(self, *_):
        return self.value


def started():
    handle, receiver = Handle(), _Receiver(HOUR_MS)
    receiver.init(handle)
    return receiver, handle.map


def batch(now, readings, commands=()):
    rows = [(n, None, f"v{d}", 0, offset, d, now) for offset, (n, d) in enumerate(readings)]
    rows += [(n, c, None, 0, 0, 0, now) for c, n in commands]
    return pd.DataFrame(rows, columns=["s_no", "command", "value", "kafka_partition", "kafka_offset", "digest", "now_ms"])


def outcomes(receiver, rows):
    half = len(rows) // 2
    frames = list(receiver.handleInputRows((7,), iter([rows[:half], rows[half:]]), None))
    return sorted((r.outcome, r.s_no, r.first_seen_ms) for f in frames for r in f.itertuples())


def test_state_is_called_per_block_and_not_per_message():
    receiver, state = started()
    numbers = [(n * PARTS, n) for n in range(5_000)]
    assert len(outcomes(receiver, batch(1, numbers))) == 5_000
    assert outcomes(receiver, batch(2, numbers)) == []
    assert state.calls < 500


def test_receiver_equals_a_plain_dictionary():
    random = np.random.default_rng(3)
    receiver, _ = started()
    known, now = {}, 1_000
    for _ in range(60):
        now += int(random.integers(1, HOUR_MS // 6))
        readings = [(int(n) * PARTS - 64_000, int(d)) for n, d in zip(random.integers(0, 2_000, 300), random.integers(0, 2, 300))]
        commands = [(FORGET, n) for n, _ in readings[:5]] + [(FORGET, 10 ** 15)] + [(CLEAR, 0)] * int(random.random() < 0.1)
        known = {n: k for n, k in known.items() if k[1] > now - HOUR_MS}
        wanted = []
        for command, number in commands:
            for n in [number] if command == FORGET else list(known):
                if n in known:
                    wanted.append((FORGOTTEN, n, known.pop(n)[1]))
        for n, d in dict.fromkeys(readings):
            if n not in known:
                known[n] = (d, now)
                wanted.append((ACCEPTED, n, now))
            elif known[n][0] != d:
                wanted.append((CONFLICT, n, known[n][1]))
        assert outcomes(receiver, batch(now, readings, commands)) == sorted(wanted)
