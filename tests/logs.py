"""Event logs written by hand or at random, and record tables worked out from definitions.

Nothing here keeps state: every record is found by looking back over the list of
the vehicle's or person's events, so it shares no method with the operators.
"""

from __future__ import annotations

import random

from headway import schemas as S

COLUMNS = S.EVENTS.names


def event(kind, time=0.0, **attributes):
    if "delay" in attributes:
        attributes["delay"] = float(attributes["delay"])
    return {"time": float(time), "type": kind, **attributes}


def numbered(events):
    return [{**dict.fromkeys(COLUMNS), **e, "seq": i} for i, e in enumerate(events)]


def frame(spark, events):
    rows = [tuple(e[c] for c in COLUMNS) for e in numbered(events)]
    return spark.createDataFrame(rows, S.EVENTS)


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "vehicle_id string")


def kms(spark, lengths):
    return spark.createDataFrame(list(lengths.items()), "link_id string, km double")


def random_log(seed, n, vehicles=3, persons=4):
    rng = random.Random(seed)
    kinds = [
        S.DRIVER_STARTS, S.PERSON_ENTERS, S.PERSON_LEAVES, S.ENTERS_TRAFFIC, S.LEAVES_TRAFFIC, S.ENTERED_LINK,
        S.LEFT_LINK, S.ARRIVES, S.DEPARTS, S.DEPARTURE, S.ACTIVITY_START, S.PERSON_ENTERS, S.ENTERED_LINK, S.LEFT_LINK,
        S.ENTERS_TRAFFIC,
    ]
    out, time = [], 0.0
    for _ in range(n):
        time += rng.choice([0, 0, 1, 2])
        v = f"v{int(rng.random() ** 2 * vehicles)}"
        person = rng.choice([f"p{int(rng.random() ** 2 * persons)}", f"pt_{v}", None])
        out.append(
            event(
                rng.choice(kinds),
                time,
                person=person if rng.random() < 0.95 else "p0",
                vehicle=v,
                vehicleId=v,
                driverId=rng.choice([f"pt_{v}", f"pt_{v}", "p0", None]),
                link=rng.choice(["a", "b", "c", "nowhere", None]),
                facility=rng.choice(["s1", "s2", None]),
                delay=rng.choice([float("nan"), float(rng.randint(-5, 5))]),
                actType=rng.choice(["home", "work", "car interaction", "pt interaction"]),
                computationalRoutingMode=rng.choice(["pt", "car", None]),
            )
        )
    return out


def _of(events, buses):
    for bus in sorted(buses):
        yield bus, [
            e for e in numbered(events) if (e["vehicleId"] if e["type"] == S.DRIVER_STARTS else e["vehicle"]) == bus
        ]


def _back(log, i, test):
    return next((j for j in range(i - 1, -1, -1) if test(log[j])), None)


def _starts(e):
    return e["type"] == S.DRIVER_STARTS and e["driverId"] is not None


def boardings(events, buses):
    out = []
    for bus, log in _of(events, buses):
        for i, e in enumerate(log):
            if e["type"] != S.PERSON_ENTERS or e["person"] is None:
                continue
            j = _back(log, i, lambda x: _starts(x) or x["type"] == S.LEAVES_TRAFFIC)
            if j is not None and _starts(log[j]) and log[j]["driverId"] != e["person"]:
                out.append((e["person"], bus))
    return sorted(out)


def delays(events, buses):
    out = []
    for _, log in _of(events, buses):
        log = [e for e in log if e["type"] == S.DEPARTS or (e["type"] == S.ARRIVES and e["facility"] is not None)]
        for a, d in zip(log, log[1:]):
            if a["type"] == S.ARRIVES and d["type"] == S.DEPARTS:
                out.append((a["facility"], a["delay"], d["delay"]))
    return sorted(out, key=repr)


def _joins(e):
    return e["type"] == S.ENTERS_TRAFFIC and e["link"] is not None


def _on_link(e):
    return e["type"] in (S.ENTERS_TRAFFIC, S.ENTERED_LINK) and e["link"] is not None


def _since(log, i):
    """Position of the join that keeps the bus in traffic at row i, if any."""
    j = _back(log, i, lambda x: _joins(x) or x["type"] == S.LEAVES_TRAFFIC)
    return j if j is not None and _joins(log[j]) else None


def _driver(log, i, km):
    for j in range(i - 1, -1, -1):
        if _starts(log[j]):
            return log[j]["driverId"]
        if log[j]["type"] == S.LEAVES_TRAFFIC and _since(log, j) is not None:
            if log[_back(log, j, _on_link)]["link"] in km:
                return None
    return None


def _aboard(log, start, end, km):
    n = 0
    for i in range(start, end):
        e = log[i]
        if e["person"] is not None and e["person"] != _driver(log, i, km):
            n += (e["type"] == S.PERSON_ENTERS) - (e["type"] == S.PERSON_LEAVES)
    return n


def traversals(events, buses, km):
    out, bad = [], []
    for bus, log in _of(events, buses):
        for i, e in enumerate(log):
            if e["type"] not in (S.LEFT_LINK, S.LEAVES_TRAFFIC):
                continue
            start = _since(log, i)
            if start is None:
                continue
            at = _back(log, i, _on_link)
            link = log[at]["link"]
            if link in km:
                out.append((bus, link, km[link], e["time"] - log[at]["time"], _aboard(log, start, at, km) > 0))
            left = _aboard(log, start, i, km)
            if e["type"] == S.LEAVES_TRAFFIC and left:
                bad.append((bus, e["time"], left))
    return sorted(out), sorted(bad)


def trips(events, blacklist):
    out = []
    log = [e for e in numbered(events) if e["person"] and not e["person"].startswith("pt")]
    for person in sorted({e["person"] for e in log}):
        own, part = [e for e in log if e["person"] == person], []
        for e in own:
            part.append(e)
            if e["type"] != S.ACTIVITY_START or e["actType"] in (None, "pt interaction"):
                continue
            begin = [x for x in part if x["type"] == S.DEPARTURE and x["computationalRoutingMode"]]
            if begin:
                used = [x["vehicle"] for x in part if x["type"] == S.PERSON_ENTERS and x["seq"] > begin[0]["seq"] and x["vehicle"]]
                if set(used) - set(blacklist):
                    t = begin[0]["time"]
                    out.append((person, t, e["time"] - t, begin[0]["computationalRoutingMode"], used))
            part = []
    return sorted(out)
