"""What rows that wait for the watermark cost: F2, F4."""

import random

import pandas as pd

from kestrel.streaming import ordered as O


class Handle:
    """The state of one key, with its calls counted."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def state(self, kind):
        handle = self

        class State:
            rows = {} if kind == "map" else []

            def __getattribute__(self, name):
                handle.calls += 1
                return object.__getattribute__(self, name)

            def exists(self):
                return len(self.rows) > 0

            def get(self):
                return self.rows[0] if kind == "value" else iter(list(self.rows))

            def update(self, value):
                self.rows = [value]

            def put(self, rows):
                self.rows = list(rows)

            def appendList(self, rows):
                self.rows = self.rows + list(rows)

            def clear(self):
                self.rows = []

            def containsKey(self, key):
                return key in self.rows

            def getValue(self, key):
                return self.rows[key]

            def updateValue(self, key, value):
                self.rows[key] = value

            def removeKey(self, key):
                del self.rows[key]

            def keys(self):
                return iter(list(self.rows))

        return State()

    def getMapState(self, *_):
        return self.state("map")

    def getListState(self, *_):
        return self.state("list")

    def getValueState(self, *_):
        return self.state("value")


class At:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def expire(machine, handle, watermark):
    out = []
    for at in sorted(t for t in handle.timers if t < watermark):
        out += [tuple(r) for frame in machine.handleExpiredTimer((7,), At(watermark), At(at)) for r in frame.itertuples(index=False)]
        handle.timers.discard(at)
    return out


def test_a_key_has_few_state_calls_however_many_rows_wait():
    rng = random.Random(4)
    rows = [(7, 10 * rng.randrange(9000), k) for k in range(20_000)]
    handed = []

    def fold(key, some, state):
        handed.append(len(some))
        times = [r[1] for r in some]
        assert times == sorted(times) and (state is None or state[1] < times[0])  # rows of one time come in one call
        n = state[0] if state else 0
        return [(*r, n + i) for i, r in enumerate(some)], (n + len(some), times[-1])

    handle = Handle()
    machine = O.OrderedFold(fold, ["k", "ms", "v"], "ms", ["v"], ["k", "ms", "v", "place"])
    machine.init(handle)
    got, seen = [], 0
    for part, watermark in ((rows[:12_000], 30_005), ([r for r in rows[12_000:] if r[1] >= 30_000], 60_000), ([], 1_000_000)):
        if part:
            list(machine.handleInputRows((7,), iter([pd.DataFrame(part, columns=["k", "ms", "v"])]), At(watermark)))
        seen += len(part)
        got += expire(machine, handle, watermark)
        want = sorted((r for r in [*rows[:12_000], *[r for r in rows[12_000:] if r[1] >= 30_000]][:seen] if r[1] < watermark), key=lambda r: r[1:])
        assert [r[:3] for r in got] == want
    assert [r[3] for r in got] == list(range(seen)) and seen > 15_000 and not handle.timers
    assert max(handed) < O.TOGETHER + 100 and handle.calls < 100
