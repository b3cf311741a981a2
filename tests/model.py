"""Plain-Python model of the three queries, row by row, for brute-force comparison.

Rows are dicts with keys time, seq, vid, speed, xway, lane, dir, seg, pos.
"""

from __future__ import annotations

from collections import defaultdict


def _by_vid(rows, keys=("vid",)):
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["time"], r["seq"])):
        groups[tuple(r[k] for k in keys) if len(keys) > 1 else r["vid"]].append(r)
    return groups


def speed_radar(rows, limit=90):
    out = []
    for vid, rs in _by_vid([r for r in rows if r["speed"] > limit]).items():
        first, top = rs[0], None
        for r in rs:
            top = r["speed"] if top is None else max(top, r["speed"])
            out.append((first["time"], vid, first["xway"], first["seg"], first["dir"], top))
    return sorted(out)


def accident_reporter(rows, size=4, keys=("vid",)):
    out = []
    for key, rs in _by_vid(rows, keys).items():
        vid = rs[0]["vid"]
        for i in range(size - 1, len(rs)):
            win = rs[i - size + 1 : i + 1]
            if all(w["pos"] == win[0]["pos"] for w in win):
                f = win[0]
                out.append((f["time"], rs[i]["time"], vid, f["xway"], f["seg"], f["dir"], f["pos"]))
    return sorted(out)


def fold(session):
    first = last = session[0]
    for r in session:
        if r["dir"] == 0:
            if r["seg"] <= first["seg"] and r["pos"] < first["pos"]:
                first = r
            elif r["seg"] >= last["seg"] and r["pos"] > last["pos"]:
                last = r
        else:
            if r["seg"] >= first["seg"] and r["pos"] > first["pos"]:
                first = r
            elif r["seg"] <= last["seg"] and r["pos"] < last["pos"]:
                last = r
    return first, last


def sessions(rows, gap, lo=52, hi=56, keys=("vid",)):
    out = []
    for key, rs in _by_vid([r for r in rows if lo <= r["seg"] <= hi], keys).items():
        vid = rs[0]["vid"]
        cur = [rs[0]]
        for r in rs[1:]:
            if r["time"] - cur[-1]["time"] <= gap:
                cur.append(r)
            else:
                out.append((vid, cur))
                cur = [r]
        out.append((vid, cur))
    return out


def stretch_crossings(rows, gap, lo=52, hi=56, interval=30.0, factor=2.23694, limit=None, keys=("vid",)):
    out = []
    for vid, sess in sessions(rows, gap, lo, hi, keys):
        first, last = fold(sess)
        if (first["seg"] == lo and last["seg"] == hi) or (first["seg"] == hi and last["seg"] == lo):
            avg = (abs(first["pos"] - last["pos"]) / ((len(sess) - 1) * interval)) * factor
            if limit is None or avg > limit:
                out.append((first["time"], last["time"], vid, first["xway"], first["dir"], avg))
    return sorted(out)


def endpoints(rows, gap, lo=52, hi=56):
    out = []
    for vid, sess in sessions(rows, gap, lo, hi):
        first, last = fold(sess)
        out.append((vid, sess[0]["time"], len(sess), first["seq"], last["seq"]))
    return sorted(out)
