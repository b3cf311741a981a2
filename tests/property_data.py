"""Random report streams: mixed directions, segments unrelated to positions, tied times."""

import random


def random_reports(seed, vids=4, per_vid=90):
    rnd = random.Random(seed)
    rows = []
    for vid in range(vids):
        t = rnd.randint(0, 50)
        pos = rnd.randint(0, 3)
        for _ in range(per_vid):
            t += rnd.choice([0, 10, 30, 30, 30, 31, 32, 60, 400])
            if rnd.random() < 0.4:
                pos = rnd.randint(0, 3) * 100
            rows.append(
                (t, vid, rnd.randint(80, 130), rnd.randint(0, 2), 1, rnd.choice([0, 0, 1, 2]),
                 rnd.randint(51, 57), pos)
            )
    rnd.shuffle(rows)
    return rows
