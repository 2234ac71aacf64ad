"""What the stateful step costs by the size of its input: calls to the state."""

import random

from paystrata.streaming import newest


class _State:
    """A map or value state in memory that counts calls; reading all of a map is one."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def _call(self, result=None):
        self.calls += 1
        return result

    def getValue(self, key):
        return self._call(self.held.get(key))

    def updateValue(self, key, value):
        self._call(self.held.__setitem__(key, value))

    def removeKey(self, key):
        self._call(self.held.pop(key, None))

    def iterator(self):
        return self._call(iter(list(self.held.items())))

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def exists(self):
        return self._call(bool(self.held))

    def clear(self):
        self._call(self.held.clear())


class _Handle:
    def __init__(self):
        self.states, self.timers = [], []

    def getMapState(self, *_):
        self.states.append(_State())
        return self.states[-1]

    def getValueState(self, *_):
        return self.getMapState()

    def registerTimer(self, millis):
        self.timers.append(millis)


class _Clock:
    def __init__(self, millis):
        self.getCurrentWatermarkInMs = lambda: millis


def _bucket(ttl):
    step, handle = newest.NewestAndLate(ttl), _Handle()
    step.init(handle)
    return step, handle, lambda: sum(state.calls for state in handle.states)


def _rows(versions):
    return iter([{"transaction_id": key, "micros": micros, "rank": rank, "value": f"{key}/{micros}/{rank}"}
                 for key, micros, rank in versions])


def test_a_bucket_costs_calls_by_cell_and_keeps_every_newest_row():
    """a large batch asks the state far less than once a transaction, and tags the same rows."""
    step, handle, calls = _bucket(10 ** 9)
    pick, known = random.Random(5), {}
    for size in (3, 6, 200, 10_000, 10_000):
        versions = [(f"T{pick.randrange(15_000)}", pick.randrange(50) * 1000, pick.choice("abc")) for _ in range(size)]
        best = {}
        for key, micros, rank in versions:
            if (micros, rank) > best.get(key, known.get(key, (-1, ""))):
                best[key] = micros, rank
        before = calls()
        tagged = [row["value"] for row in step.handleInputRows((0,), _rows(versions), _Clock(0)) if row["kind"] == "newest"]
        assert sorted(tagged) == sorted(f"{key}/{micros}/{rank}" for key, (micros, rank) in best.items())
        known.update(best)
        if size == 10_000:
            assert calls() - before < size / 5
    held = {key: tuple(own) for cell in step._all().values() for key, own in cell.items()}
    assert held == known and step.shape.get()[1] == len(known) and len(handle.timers) == 1


def test_a_packed_bucket_forgets_and_shrinks():
    step, handle, _ = _bucket(60_000)
    list(step.handleInputRows((0,), _rows([(f"T{n}", 0, "a") for n in range(5000)] + [("T7", 90_000_000, "b")]), _Clock(0)))
    list(step.handleExpiredTimer((0,), _Clock(100_000), None))
    assert step._all() == {"T7": {"T7": [90_000_000, "b"]}} and len(handle.timers) == 2
    list(step.handleExpiredTimer((0,), _Clock(200_000), None))
    assert step._all() == {} and step.shape.get() is None
