"""The keyed stream operator against the plain state machine, over cuts of the input and of the buffer."""

import datetime as dt
import random

import pandas as pd
import pytest

from cellwatch.streaming.day_state import advance, in_order

from tests import day_machine
from tests.test_confirm import random_events


def frame(events):
    return pd.DataFrame(
        {
            "seq": [e["seq"] for e in events],
            "day": [(e["date"] - dt.date(1970, 1, 1)).days for e in events],
            "event_time": pd.array([e["time"] for e in events], dtype="Int64"),
            "source": [e["kind"] for e in events],
            "held": [f"{e['time']} {e['risk']}" if e["kind"] == "meteo" else None for e in events],
        }
    )


def said(cell, out):
    """Alerts, outcomes and labelled rows in the words of the state machine."""
    alerts, outcomes, training = [], [], []
    for r in out.itertuples():
        date = dt.date(1970, 1, 1) + dt.timedelta(days=int(r.day))
        time, risk = r.held.split() if r.held else (None, None)
        seen, low = int(time) if time else None, risk == "LOW"
        sensor, fire = bool(r.sensor_on), bool(r.fire_on)
        if r.source == "fire":
            outcomes.append((cell, date, sensor, True, sensor, r.event_time, "sensor_fire" if sensor else "fire_pending", seen, int(low)))
        if r.alert:
            origin, one = "sensor_fire" if fire else "sensor", int(fire and low)
            alerts.append((cell, date, r.event_time, origin, fire, seen, one))
            outcomes.append((cell, date, True, fire, fire, r.event_time, origin, seen, one))
            training.append((cell, date, 1, origin, r.event_time, fire, True, one))
        if r.negative:
            training.append((cell, date, 0, "none", seen, fire, sensor, 0))
    return alerts, outcomes, training


@pytest.mark.parametrize("seed", range(6))
def test_equals_state_machine_over_any_cuts(seed):
    rng = random.Random(seed)
    events = random_events(seed, 3, 150, 4, hot=0.5)
    for cell in {e["cell"] for e in events}:
        mine = sorted((e for e in events if e["cell"] == cell), key=lambda e: e["seq"])
        found, state, at = ([], [], []), None, 0
        while at < len(mine):
            end = min(len(mine), at + rng.randrange(1, 9))
            out, state = advance(frame(mine[at:end]), state)
            for a, b in zip(found, said(cell, out)):
                a.extend(b)
            at = end
        want = day_machine.run(mine)
        for a, b in zip(found, want):
            assert sorted(a, key=str) == sorted(b, key=str)


def test_buffer_puts_rows_in_order():
    rng = random.Random(1)
    rows = pd.DataFrame({"seq": range(200), "source": "meteo", "event_time": 0, "day": 0})
    near = rows.iloc[sorted(range(200), key=lambda i: i + rng.randrange(20))]
    pieces = [near.iloc[i : i + 13] for i in range(0, 200, 13)]
    parts = list(in_order(iter(pieces), 25))
    assert len(parts) > 3 and max(map(len, parts)) <= 50
    assert [s for p in parts for s in p["seq"]] == list(range(200))
    assert list(in_order(iter([]), 5)) == []
