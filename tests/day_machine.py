"""Plain per-event state machine, written from the rules, to test against."""


def run(events, state=None):
    """events: dicts with cell, date, time, seq, kind, risk; any mix of cells, in order."""
    cells = dict(state or {})
    alerts, outcomes, training = [], [], []
    for e in sorted(events, key=lambda e: e["seq"]):
        s = cells.setdefault(e["cell"], {"date": None, "snap": None, "sensor": False, "fire": False, "alert": False})
        if s["date"] is not None and s["date"] != e["date"]:
            if s["snap"] is not None and not s["alert"]:
                training.append((e["cell"], s["date"], 0, "none", s["snap"][0], s["fire"], s["sensor"], 0))
            s.update(snap=None, sensor=False, fire=False, alert=False)
        s["date"] = e["date"]
        if e["kind"] == "meteo":
            s["snap"] = (e["time"], e["risk"])
            continue
        low = s["snap"] is not None and s["snap"][1] == "LOW"
        seen = s["snap"][0] if s["snap"] else None
        confirm = False
        if e["kind"] == "fire":
            s["fire"] = True
            origin = "sensor_fire" if s["sensor"] else "fire_pending"
            outcomes.append((e["cell"], e["date"], s["sensor"], True, s["sensor"], e["time"], origin, seen, int(low)))
            confirm = s["sensor"]
        elif e["kind"] == "sensor":
            s["sensor"] = True
            confirm = True
        if confirm and not s["alert"] and s["snap"] is not None:
            origin = "sensor_fire" if s["fire"] else "sensor"
            risk = int(s["fire"] and low)
            alerts.append((e["cell"], e["date"], e["time"], origin, s["fire"], seen, risk))
            outcomes.append((e["cell"], e["date"], True, s["fire"], s["fire"], e["time"], origin, seen, risk))
            training.append((e["cell"], e["date"], 1, origin, e["time"], s["fire"], True, risk))
            s["alert"] = True
    return alerts, outcomes, training, cells


def upsert(rows):
    return sorted({(r[0], r[1]): r for r in rows}.values())
