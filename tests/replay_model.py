"""Plain sequential model of the reference's per-batch processing (test oracle).

Per sensor: running n, K, Ex, Ex2 (K = first reading), thresholds mean +- 2 sd including the
current batch; per reading in order: state 1/-1 on breach, else 2 if the old state was not 0,
else 0; once per batch the alarm machine with an acknowledgement flag per batch.
"""

from __future__ import annotations

import math

PRIORITY = ["TEMPERATURE", "PRESSURE", "HUMIDITY", "LIGHT"]


class Stat:
    def __init__(self):
        self.n, self.k, self.ex, self.ex2 = 0, 0.0, 0.0, 0.0

    def add(self, x):
        if self.n == 0:
            self.k = x
        self.n += 1
        self.ex += x - self.k
        self.ex2 += (x - self.k) * (x - self.k)

    def mean(self):
        return 0.0 if self.n == 0 else self.k + self.ex / self.n

    def var(self):
        return 0.0 if self.n < 2 else (self.ex2 - self.ex * self.ex / self.n) / (self.n - 1)

    def std(self):
        return math.sqrt(max(self.var(), 0.0))


def replay(batches, acks=None, sigmas=2.0, priority=PRIORITY):
    """batches: list of (batch, [(ord, sensor, x), ...]) in processing order.

    Returns (rows, ends, alarm): rows = {(ord, sensor): (code, state, lo, hi)},
    ends = {(batch, sensor): state}, alarm = [(batch, type, ack, alarm_after, command)]."""
    stats, states, alarm = {}, {}, 0
    rows, ends, trace = {}, {}, []
    for bi, (batch, readings) in enumerate(batches):
        if not readings:
            continue
        for _, s, x in readings:
            stats.setdefault(s, Stat()).add(x)
        band = {s: (st.mean() - sigmas * st.std(), st.mean() + sigmas * st.std()) for s, st in stats.items()}
        for o, s, x in sorted(readings):
            lo, hi = band[s]
            old = states.get(s, 0)
            if x > hi:
                new, code = 1, 1
            elif x < lo:
                new, code = -1, -1
            else:
                code = 0
                new = 2 if old != 0 else 0
            states[s] = new
            rows[(o, s)] = (code, new, lo, hi)
        for s in states:
            ends[(batch, s)] = states[s]
        typ = next((s for s in priority if states.get(s, 0) in (1, -1)), "")
        ack = True if acks is None else acks[bi]
        on = typ != ""
        cmd = None
        if on:
            if alarm in (0, 3):
                cmd = "ON"
                alarm = 1 if ack else 3
        else:
            if alarm in (1, 2):
                cmd = "OFF"
                alarm = 0 if ack else 2
        trace.append((batch, typ, ack, alarm, cmd))
    return rows, ends, trace
