"""Small made-up inputs with the awkward cases: ties, nulls, a key with a third of the rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

START = datetime(2024, 3, 1)
EVENTS = "id bigint, user bigint, ts timestamp_ntz, kind string, value double"


def awkward_events(seed: int, n: int = 400) -> list[tuple]:
    """Events of seven users, one of them null and one with more than a third of the rows."""
    rng = random.Random(seed)
    users = [1, 1, 1, 1, 2, 3, 4, 5, 6, None]
    rows = []
    for i in range(n):
        ts = START + timedelta(minutes=rng.choice([0, 10, 29, 30, 31]) + 60 * rng.randrange(60))
        kind = rng.choice(["view", "purchase", "click"])
        rows.append((i, rng.choice(users), ts, kind, rng.randrange(10_000) / 100))
    rng.shuffle(rows)
    return rows
