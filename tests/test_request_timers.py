"""What a stream of requests asks of its state."""

from types import SimpleNamespace

from loomtable.streaming.stateful import Requests


class State:
    def __init__(self):
        self.value, self.timers, self.calls = None, set(), []

    def __getattr__(self, name):
        def call(*x):
            self.calls.append(name)
            if name == "update":
                self.value = x[0]
            elif name == "clear":
                self.value = None
            elif name == "registerTimer":
                self.timers.add(x[0])
            elif name == "deleteTimer":
                self.timers.discard(x[0])
            return {"get": self.value, "exists": self.value is not None, "listTimers": sorted(self.timers)}.get(name)

        return call


def test_a_request_that_goes_on_keeps_its_timer():
    held, machine = State(), Requests(60_000)
    machine.handle = machine.state = held
    at = lambda s, usage=None: {"__us": s * 1_000_000, "__begun": 0, "has_content": True, "usage_tokens": usage}
    time = lambda s: SimpleNamespace(getCurrentWatermarkInMs=lambda: s * 1000)

    def expire(s):
        done = []
        for t in [t for t in sorted(held.timers) if t <= s * 1000]:
            held.timers.discard(t)
            done += machine.handleExpiredTimer((1,), time(s), None)
        return done

    assert not list(machine.handleInputRows((1,), [at(1), at(2)], None))
    held.calls.clear()
    assert not list(machine.handleInputRows((1,), [at(50)], None))
    assert held.calls == ["get", "update"]
    assert not expire(61) and not expire(100) and held.timers == {110_000}  # it was silent for less than a minute
    (done,) = expire(110)
    assert done.token_latencies_ms == [1000.0, 48000.0] and held.value is None and not held.timers
    list(machine.handleInputRows((1,), [at(200)], None))
    (done,) = machine.handleInputRows((1,), [at(201, 7)], None)
    assert done.completion_tokens == 7 and held.value is None and not held.timers
    (done,) = machine.handleInputRows((1,), [at(300, 1)], None)
    assert done.total_latency_ms == 300_000.0 and not held.timers
