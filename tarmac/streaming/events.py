"""Go-around and hold alerts on a stream of track points.

State is kept per aircraft and time bucket, with the same halo copies as in batch, so
the backlog of a busy aircraft spreads over tasks and old buckets can be dropped. Points
wait in state until the watermark has passed them, which a timer every ``tick_s`` seconds of event time
looks after; the rules then go on in time order from where they stood. An alert so comes out when
the watermark is past its point, not when its bucket ends. State of a bucket holds the points
that the watermark has not passed, and what the rules remember: a few values and the
points of one hold window.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tarmac.config import DEFAULT, Thresholds
from tarmac.operators.ordered import BUCKET, HOME, with_halo

#: A query with these alerts is started with these settings (see ``flows.start``).
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

POINT = (
    "us bigint, airport string, dist_nm double, alt_ft double, agl_ft double, "
    "vertical_rate_ms double, true_track_deg double, on_ground boolean, own boolean"
)
_FIELDS = [f.split()[0] for f in POINT.split(", ")]
OUTPUT = "kind string, airport string, icao24 string, ts timestamp, since timestamp"


def _when(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us", tz="UTC")


def _wrap(turn: float) -> float:
    return (turn + 180.0) % 360.0 - 180.0


class Watch:
    """The two rules over one aircraft, fed point by point in time order. Times are microseconds."""

    #: What the rules remember between points; all of it is plain numbers and text.
    MEMORY = ("prev", "near_prev", "low", "ground", "climb", "fired", "turned", "loose")

    def __init__(self, t: Thresholds, memory: str | None = None) -> None:
        self.t = t
        self.prev: list | None = None  # us, distance, airport, climb rate
        self.near_prev: list | None = None  # us, heading
        self.low: list | None = None  # us, height, airport
        self.ground = self.climb = self.fired = None
        self.recent: deque[list] = deque()  # us, altitude, turn, whether the gap before is too long
        self.turned, self.loose = 0.0, 0  # sums over ``recent`` but for its first point
        if memory is not None:
            held = json.loads(memory)
            self.recent.extend(held.pop("recent"))
            self.__dict__.update(held)

    def memory(self) -> str:
        return json.dumps({**{k: getattr(self, k) for k in self.MEMORY}, "recent": list(self.recent)})

    def feed(self, p: dict[str, Any]) -> Iterator[tuple[str, str, int, int]]:
        """(kind, airport, us, since) of the alerts at this point."""
        yield from self._go_around(p)
        if p["dist_nm"] <= self.t.hold_nm:
            yield from self._hold(p)

    def _go_around(self, p: dict[str, Any]) -> Iterator[tuple[str, str, int, int]]:
        t, prev, us, vr = self.t, self.prev, p["us"], p["vertical_rate_ms"]
        if prev is not None and us - prev[0] > t.segment_gap_s * 1_000_000:
            prev = None
        self.prev = [us, p["dist_nm"], p["airport"], vr]
        approach = (
            prev is not None and prev[2] == p["airport"] and vr is not None
            and p["dist_nm"] <= t.approach_nm and vr < t.approach_descent_ms
            and p["alt_ft"] is not None and p["alt_ft"] < t.approach_max_alt_ft and p["dist_nm"] < prev[1]
        )
        height = p["agl_ft"]
        if approach and p["dist_nm"] <= t.field_nm and height is not None and height < t.low_agl_ft:
            self.low = [us, height, p["airport"]]
        if p["on_ground"]:
            self.ground = us
        if vr is None or vr <= t.climb_ms:
            return
        if prev is None or prev[3] is None or prev[3] <= t.climb_ms:
            self.climb = us
        low = self.low
        if (
            low is not None and low[2] == p["airport"] and us - low[0] <= t.go_around_horizon_s * 1_000_000
            and (self.ground is None or self.ground < low[0]) and self.climb is not None
            and us - self.climb >= t.climb_sustain_s * 1_000_000 and height is not None and height - low[1] > t.regain_ft
        ):
            again = self.fired is not None and self.fired >= self.climb
            self.fired = us
            if not again:
                yield "go-around", p["airport"], us, low[0]

    def _hold(self, p: dict[str, Any]) -> Iterator[tuple[str, str, int, int]]:
        t, prev, us, heading = self.t, self.near_prev, p["us"], p["true_track_deg"]
        self.near_prev = [us, heading]
        gap = None if prev is None else us - prev[0]
        known = gap is not None and gap <= t.segment_gap_s * 1_000_000
        turn = _wrap(heading - prev[1]) if known and heading is not None and prev[1] is not None else 0.0
        loose = int(gap is None or gap > t.max_sample_gap_s * 1_000_000)
        if self.recent:  # the first point's own turn and gap lie before the window
            self.turned += turn
            self.loose += loose
        self.recent.append([us, p["alt_ft"], turn, loose])
        while self.recent[0][0] < us - t.hold_window_s * 1_000_000:
            self.recent.popleft()
            self.turned -= self.recent[0][2]
            self.loose -= self.recent[0][3]
        if abs(abs(self.turned) - t.hold_turn_deg) < 1e-6 or len(self.recent) < 2:
            # Close to the limit the sum is taken anew, since a running one gathers rounding.
            self.turned = sum(x[2] for x in list(self.recent)[1:])
        if len(self.recent) < 2 or self.loose or abs(self.turned) < t.hold_turn_deg:
            return
        heights = [x[1] for x in self.recent if x[1] is not None]
        if heights and max(heights) - min(heights) <= 2 * t.hold_alt_band_ft:
            yield "hold", p["airport"], us, self.recent[0][0]


class Alerts(StatefulProcessor):
    def __init__(self, t: Thresholds, width_s: int, tick_s: int) -> None:
        self.t, self.width_s, self.tick_s = t, width_s, tick_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", POINT)
        self.rules = handle.getValueState("rules", "memory string")

    def _end(self, key: Any) -> int:
        return (int(key[1]) + 1) * self.width_s * 1000

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        tick, due = self.tick_s * 1_000_000, set()
        for pdf in rows:
            clean = pdf[_FIELDS].astype(object).where(pdf[_FIELDS].notna(), None)
            self.waiting.appendList([tuple(r) for r in clean.itertuples(index=False, name=None)])
            due.update((-(-pdf["us"] // tick) * self.tick_s * 1000).unique().tolist())
        # One timer for each tick that has points, and one for the end of the bucket.
        for at in {*due, self._end(key)}:
            self.handle.registerTimer(int(at))
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        # No point up to the watermark can come any more.
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        points = sorted((dict(zip(_FIELDS, r, strict=True)) for r in self.waiting.get()), key=lambda p: p["us"])
        ready = [p for p in points if p["us"] <= passed]
        out = []
        if ready:
            watch = Watch(self.t, self.rules.get()[0] if self.rules.exists() else None)
            out = [
                (kind, airport, key[0], _when(us), _when(since))
                for p in ready for kind, airport, us, since in watch.feed(p) if p["own"]
            ]
            self.rules.update((watch.memory(),))
            left = [tuple(p[f] for f in _FIELDS) for p in points[len(ready) :]]
            self.waiting.put(left) if left else self.waiting.clear()
        if passed >= self._end(key) * 1000:
            self.waiting.clear()
            self.rules.clear()
        if out:
            yield pd.DataFrame(out, columns=["kind", "airport", "icao24", "ts", "since"])

    def close(self) -> None:
        pass


def stream_events(points: DataFrame, t: Thresholds = DEFAULT, delay: str = "15 minutes", tick_s: int = 60) -> DataFrame:
    """Alerts (kind, airport, icao24, ts, since): one per go-around, one per holding point.

    An alert comes out with the first micro-batch whose watermark is at most ``tick_s`` past its
    point. Holding points of one pattern are merged downstream, as in batch.
    """
    width = max(t.bucket_s, t.go_around_horizon_s + t.segment_gap_s)
    # As in batch: every point that a rule reads must see the point before it.
    back = max(t.go_around_horizon_s, t.hold_window_s) + t.segment_gap_s
    late = points.withWatermark("ts", delay)
    halo = with_halo(late, "ts", width_s=width, lookback_s=back)
    rows = halo.select(
        "icao24", F.col(BUCKET), "ts", F.unix_micros("ts").alias("us"), "airport", "dist_nm",
        "alt_ft", "agl_ft", "vertical_rate_ms", "true_track_deg", "on_ground", (F.col(BUCKET) == F.col(HOME)).alias("own"),
    )
    return rows.groupBy("icao24", BUCKET).transformWithStateInPandas(
        statefulProcessor=Alerts(t, width, tick_s), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )
