"""Keyed stateful processors (``transformWithState``) for per-row and timer
rules on streams. Each mirrors a batch operator; tests check both agree.

Event-time rules buffer rows in list state and replay them in
(event time, arrival) order once the watermark has passed them (one timer
per key and micro-batch, for the earliest row), so rows that arrive slightly
out of order are handled in event-time order, as the batch form does. State per key is the not-yet-final rows plus one open
alarm; it is cleared as the watermark moves.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from typing import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_BUF = "t long, a long, v double, s string"


_UNITS = 10 ** 8


def _exact(value) -> Decimal | None:
    """As ``rolling.exact``: eight places, or None (then the value counts as a row only)."""
    v = None if value is None else Decimal(str(value))
    if v is None or not v.is_finite() or abs(v) >= 10 ** 30:
        return None
    return v.quantize(Decimal(1) / _UNITS, rounding=ROUND_HALF_UP)


def _avg_half_up(total: Decimal, n: int) -> float | None:
    """As ``rolling.avg_half_up``."""
    return ((2 * int(total * _UNITS) * 10_000 + n * _UNITS) // (2 * n * _UNITS)) / 10_000 if n else None


class _EventTimeRule(StatefulProcessor):
    """Base of timer rules: items open/extend an alarm, other rows reset it;
    the alarm fires ``delay`` seconds after it opened unless reset first."""

    def __init__(self, delay_s: int, min_items: int = 1):
        self.delay = int(delay_s)
        self.min_items = int(min_items)

    # subclass hooks -----------------------------------------------------
    def to_buffer(self, row) -> tuple:
        raise NotImplementedError

    def is_item(self, x: tuple) -> bool:
        raise NotImplementedError

    def emit(self, key, f: int, l: int, n: int) -> Row:
        raise NotImplementedError

    # ---------------------------------------------------------------------
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", _BUF)
        self.alarm = handle.getValueState("alarm", "f long, l long, n int")
        self.last = handle.getValueState("last", "v double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [self.to_buffer(r) for r in rows]
        if new:
            self.buf.appendList(new)
            self.handle.registerTimer(min(new)[0] * 1000)  # one timer a batch: it sets the next one
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter(self._advance(key, timerValues.getCurrentWatermarkInMs()))

    def _advance(self, key, wm: int) -> list:
        items = sorted(self.buf.get()) if self.buf.exists() else []
        ready = [x for x in items if x[0] * 1000 <= wm]
        rest = [x for x in items if x[0] * 1000 > wm]
        st = self.alarm.get() if self.alarm.exists() else None
        out = []
        for x in ready:
            if st is not None and x[0] > st[0] + self.delay:
                if st[2] >= self.min_items:
                    out.append(self.emit(key, *st))
                st = None
            if self.is_item(x):
                if st is None:
                    st = (x[0], x[0], 1)
                    self.handle.registerTimer((x[0] + self.delay) * 1000 + 1)
                else:
                    st = (st[0], x[0], st[2] + 1)
            elif st is not None:
                self.handle.deleteTimer((st[0] + self.delay) * 1000 + 1)
                st = None
        if st is not None and (st[0] + self.delay) * 1000 < wm:
            if st[2] >= self.min_items:
                out.append(self.emit(key, *st))
            st = None
        if st is None:
            self.alarm.clear()
        else:
            self.alarm.update(st)
        if rest:
            self.buf.put(rest)
            self.handle.registerTimer(rest[0][0] * 1000)
        else:
            self.buf.clear()
        return out

    def close(self) -> None:
        pass


class LoginFailTimerProcessor(_EventTimeRule):
    """Stream form of ``fold.login_fail_timer``. Input: user_id, timestamp (s),
    event_id, login_state; output: user_id, first_fail_time, last_fail_time,
    warning_msg."""

    OUTPUT = "user_id long, first_fail_time long, last_fail_time long, warning_msg string"

    def to_buffer(self, r):
        return (int(r["timestamp"]), int(r["event_id"]), 0.0, r["login_state"])

    def is_item(self, x):
        return x[3] == "fail"

    def emit(self, key, f, l, n):
        return Row(user_id=key[0], first_fail_time=f, last_fail_time=l, warning_msg=f"login fail {n}")


class RisingAlarmProcessor(_EventTimeRule):
    """Stream form of ``fold.rising_alarm``. Input: id, timestamp (s),
    event_id, temperature; output: id, armed_ts, fired_ts, warning_msg."""

    OUTPUT = "id string, armed_ts long, fired_ts long, warning_msg string"

    def __init__(self, interval_s: int, first_arms: bool = True):
        super().__init__(interval_s, 1)
        self.first_arms = first_arms

    def to_buffer(self, r):
        v = r["temperature"]
        return (int(r["timestamp"]), int(r["event_id"]), None if v is None else float(v), "")

    def is_item(self, x):
        # A NULL reading is no rise, nor is the one after it.
        first = not self.last.exists()
        prev = None if first else self.last.get()[0]
        self.last.update((x[2],))
        return self.first_arms if first else None not in (prev, x[2]) and x[2] > prev

    def emit(self, key, f, l, n):
        return Row(id=key[0], armed_ts=f, fired_ts=f + self.delay,
                   warning_msg=f"sensor {key[0]} rose continuously for {self.delay}s")


class _ArrivalOrdered(StatefulProcessor):
    """Per-row rules in arrival order (rows of one micro-batch sorted by arrival)."""

    arrival = "event_id"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return iter([o for r in sorted(rows, key=lambda r: r[self.arrival]) for o in self.step(key, r)])

    def close(self) -> None:
        pass


class RunningCountProcessor(_ArrivalOrdered):
    """Keyed value state with default 0, +1 per row: (id, event_id, cnt). State
    is read and written once per key and micro-batch."""

    OUTPUT = "id string, event_id long, cnt long"

    def init(self, handle):
        self.count = handle.getValueState("count", "c long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        c = self.count.get()[0] if self.count.exists() else 0
        ids = sorted(r[self.arrival] for r in rows)
        self.count.update((c + len(ids),))
        return iter([Row(id=key[0], event_id=e, cnt=c + i) for i, e in enumerate(ids, 1)])


class JumpAlarmProcessor(_ArrivalOrdered):
    """|value − last value| ≥ threshold: (id, event_id, last_temperature, temperature)."""

    OUTPUT = "id string, event_id long, last_temperature double, temperature double"

    def __init__(self, threshold: float = 10.0):
        self.threshold = threshold

    def init(self, handle):
        self.last = handle.getValueState("last", "v double")

    def step(self, key, r):
        v = r["temperature"]
        if self.last.exists():
            prev = self.last.get()[0]
            if abs(v - prev) >= self.threshold:
                yield Row(id=key[0], event_id=r["event_id"], last_temperature=prev, temperature=v)
        self.last.update((v,))


class CountWindowProcessor(_ArrivalOrdered):
    """Count window (size, slide) average over the last ≤ size values:
    (id, n, event_id, cnt, avg_temp). State is bounded to ``size`` values."""

    OUTPUT = "id string, n long, event_id long, cnt long, avg_temp double"

    def __init__(self, size: int = 10, slide: int = 2):
        self.size, self.slide = size, slide

    def init(self, handle):
        self.window = handle.getListState("window", "v double")
        self.count = handle.getValueState("count", "c long")

    def step(self, key, r):
        n = (self.count.get()[0] if self.count.exists() else 0) + 1
        self.count.update((n,))
        vals = [x[0] for x in self.window.get()] if self.window.exists() else []
        vals = (vals + [None if r["temperature"] is None else float(r["temperature"])])[-self.size:]
        self.window.put([(x,) for x in vals])
        if n % self.slide == 0:
            known = [x for x in map(_exact, vals) if x is not None]
            yield Row(id=key[0], n=n, event_id=r["event_id"], cnt=len(vals), avg_temp=_avg_half_up(sum(known, Decimal(0)), len(known)))


class ChangelogProcessor(_ArrivalOrdered):
    """Retract/insert rows of a running (count, avg): (id, event_id, op, cnt, avg_temp, seq)."""

    OUTPUT = "id string, event_id long, op string, cnt long, avg_temp double, seq int"

    def init(self, handle):
        self.acc = handle.getValueState("acc", "n long, k long, s decimal(38,8)")

    def step(self, key, r):
        n, k, s = self.acc.get() if self.acc.exists() else (0, 0, Decimal(0))
        if n:
            yield Row(id=key[0], event_id=r["event_id"], op="-", cnt=n, avg_temp=_avg_half_up(s, k), seq=0)
        v = _exact(r["temperature"])
        n, k, s = n + 1, k + (v is not None), s + (v or 0)
        self.acc.update((n, k, s))
        yield Row(id=key[0], event_id=r["event_id"], op="+", cnt=n, avg_temp=_avg_half_up(s, k), seq=1)


def apply(df, key: str, processor: StatefulProcessor, time_mode: str = "None", output_mode: str = "Append"):
    """groupBy(key).transformWithState(processor) with the processor's schema."""
    return df.groupBy(key).transformWithState(
        statefulProcessor=processor, outputStructType=processor.OUTPUT,
        outputMode=output_mode, timeMode=time_mode)


class _EventTimeReplay(StatefulProcessor):
    """Buffer rows; once the watermark has passed them, replay them in
    (event time, arrival) order through ``on_row`` — event-time order even
    when rows arrive slightly out of order."""

    def to_buffer(self, row) -> tuple:  # (t, a, v, s)
        raise NotImplementedError

    def on_row(self, key, x: tuple):
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", _BUF)
        self.prev = handle.getListState("prev", _BUF)  # last rows already replayed (bounded)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [self.to_buffer(r) for r in rows]
        if new:
            self.buf.appendList(new)
            self.handle.registerTimer(min(new)[0] * 1000)  # one timer a batch: it sets the next one
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        items = sorted(self.buf.get()) if self.buf.exists() else []
        ready = [x for x in items if x[0] * 1000 <= wm]
        rest = [x for x in items if x[0] * 1000 > wm]
        out = [o for x in ready for o in self.on_row(key, x)]
        if rest:
            self.buf.put(rest)
            self.handle.registerTimer(rest[0][0] * 1000)
        else:
            self.buf.clear()
        return iter(out)

    def close(self) -> None:
        pass


class SequenceMatchProcessor(_EventTimeReplay):
    """Strict contiguity ``begin.next…`` of n login states within ``within_s``
    (stream form of ``patterns.match_sequence`` / ``login_fail_times``).
    Keeps the last n − 1 replayed rows per user."""

    OUTPUT = "user_id long, first_fail_time long, last_fail_time long, warning_msg string"

    def __init__(self, states: list[str], within_s: float):
        self.states, self.within = list(states), within_s

    def to_buffer(self, r):
        return (int(r["timestamp"]), int(r["event_id"]), 0.0, r["login_state"])

    def on_row(self, key, x):
        hist = (list(self.prev.get()) if self.prev.exists() else []) + [x]
        hist = hist[-len(self.states):]
        self.prev.put(hist[-(len(self.states) - 1):] if len(self.states) > 1 else [])
        if len(hist) == len(self.states) and all(h[3] == s for h, s in zip(hist, self.states)) \
                and hist[-1][0] - hist[0][0] < self.within:
            yield Row(user_id=key[0], first_fail_time=hist[0][0], last_fail_time=hist[-1][0],
                      warning_msg=f"login fail {len(hist)} times")


class FailPairProcessor(_EventTimeReplay):
    """Consecutive failures at most ``within_s`` apart (stream form of
    ``rules.login_fail_pairs``)."""

    OUTPUT = "user_id long, first_fail_time long, last_fail_time long, warning_msg string"

    def __init__(self, within_s: int):
        self.within = within_s

    def to_buffer(self, r):
        return (int(r["timestamp"]), int(r["event_id"]), 0.0, r["login_state"])

    def on_row(self, key, x):
        last = list(self.prev.get()) if self.prev.exists() else []
        self.prev.put([x])
        if last and last[0][3] == "fail" and x[3] == "fail" and x[0] - last[0][0] <= self.within:
            yield Row(user_id=key[0], first_fail_time=last[0][0], last_fail_time=x[0], warning_msg="login fail")


class KeyedHistoryProcessor(_ArrivalOrdered):
    """Previous ≤ ``max_len`` items of the key per row (list state bounded to max_len)."""

    OUTPUT = "id string, event_id long, history string"

    def __init__(self, max_len: int = 5):
        self.max_len = max_len

    def init(self, handle):
        self.hist = handle.getListState("hist", "x string")

    def step(self, key, r):
        h = [x[0] for x in self.hist.get()] if self.hist.exists() else []
        yield Row(id=key[0], event_id=r["event_id"], history=",".join(h))
        self.hist.put([(x,) for x in (h + [str(r["event_id"])])[-self.max_len:]])


class LatestValueMapProcessor(_ArrivalOrdered):
    """Map state per key: map key → (arrival, value); emits each update. A NULL
    value removes its map key and a NULL map key clears the key's map (neither
    emits): what they free is gone from the state."""

    OUTPUT = "user_id long, event_type string, value double, event_id long"

    def init(self, handle):
        self.state = handle.getMapState("latest", "k string", "a long, v double")

    def step(self, key, r):
        k = (r["event_type"],)
        if k[0] is None:
            self.state.clear()
            return
        if r["value"] is None:
            if self.state.containsKey(k):
                self.state.removeKey(k)
            return
        old = self.state.getValue(k) if self.state.containsKey(k) else None
        if old is None or r["event_id"] > old[0]:
            self.state.updateValue(k, (r["event_id"], r["value"]))
            yield Row(user_id=key[0], event_type=r["event_type"], value=r["value"], event_id=r["event_id"])


class UvRunningProcessor(StatefulProcessor):
    """Per window: a row each time a new bitmap offset is seen (stream form of
    ``distinct.uv_running``). Key = window_end (ms); input has h, event_id and a
    watermarked time column. Apply with ``time_mode="EventTime"``: a window's
    bits are dropped once the watermark passes its end, after which Spark drops
    its late rows too."""

    OUTPUT = "window_end long, event_id long, uv long"

    def init(self, handle):
        self.handle = handle
        self.bits = handle.getMapState("bits", "h long", "a long")
        self.count = handle.getValueState("count", "c long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.count.get()[0] if self.count.exists() else 0
        if not seen:
            self.handle.registerTimer(int(key[0]))
        c, out = seen, []
        for r in sorted(rows, key=lambda r: r["event_id"]):
            h = (int(r["h"]),)
            if not self.bits.containsKey(h):
                self.bits.updateValue(h, (int(r["event_id"]),))
                c += 1
                out.append(Row(window_end=key[0], event_id=r["event_id"], uv=c))
        if c != seen:
            self.count.update((c,))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.bits.clear()
        self.count.clear()
        return iter(())

    def close(self) -> None:
        pass


class RisingAlarmProcessingTime(StatefulProcessor):
    """Rising alarm on the processing-time clock (timeMode='ProcessingTime'):
    a rise with no timer arms one ``interval_s`` of wall-clock time later, a
    non-rise deletes it. Results depend on the wall clock."""

    OUTPUT = "id string, armed_ms long, fired_ms long, warning_msg string"

    def __init__(self, interval_s: int, first_arms: bool = True):
        self.interval_ms, self.first_arms = int(interval_s * 1000), first_arms

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last", "v double")
        self.timer = handle.getValueState("timer", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for r in sorted(rows, key=lambda r: r["event_id"]):
            v = float(r["temperature"])
            prev = self.last.get()[0] if self.last.exists() else None
            rise = self.first_arms if prev is None else v > prev
            if rise and not self.timer.exists():
                self.handle.registerTimer(now + self.interval_ms)
                self.timer.update((now + self.interval_ms,))
            elif not rise and self.timer.exists():
                self.handle.deleteTimer(self.timer.get()[0])
                self.timer.clear()
            self.last.update((v,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        t = expiredTimerInfo.getExpiryTimeInMs()
        self.timer.clear()
        return iter([Row(id=key[0], armed_ms=t - self.interval_ms, fired_ms=t,
                         warning_msg=f"sensor {key[0]} rose continuously for {self.interval_ms // 1000}s")])

    def close(self) -> None:
        pass
