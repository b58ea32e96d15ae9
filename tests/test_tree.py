"""Cells of a hot key, composed up a tree."""

import os
import random

import pandas as pd

from attestal.operators import throttle as T


def test_composed_steps_equal_one_after_the_other():
    """On every entry time a first cell can be entered with."""
    rnd = random.Random(2)
    for _ in range(300):
        rows, t = [], 0
        for number in range(rnd.randrange(1, 6)):
            times = sorted(t + rnd.randrange(12) for _ in range(rnd.randrange(1, 8)))
            t = times[-1]
            rows.append((number, times, [rnd.choice([1, 3, 9]) for _ in times], [rnd.random() < 0.15 for _ in times]))
        summed = []
        for number, times, waits, forced in rows:
            cell = pd.DataFrame({"k": "k", "c": number, "t": times, T._WAIT: waits, T._FORCE: forced, T._LAST: None})
            out = T._sum_up_fn(["k", "c"], ["t"], "t")(cell).assign(**{T._NODE: number, T._PARENT: 0}).drop(columns="c")
            summed.append(out)
        whole = T._compose_fn()(pd.concat(summed).sample(frac=1, random_state=1)).iloc[0]
        for entry in [None, *range(-12, int(whole["top"]) + 1)]:
            last = entry
            for _, times, waits, forced in rows:
                for t, w, f in zip(times, waits, forced, strict=True):
                    if last is None or f or t > last + w:
                        last = t if last is None else max(last, t)
            assert T._through(whole["below"], whole["leave"], entry) == last


def test_no_group_is_larger_than_the_fan(spark, monkeypatch, tmp_path):
    """A key in many cells: every group handed to Python while cells are composed, measured."""
    monkeypatch.setattr(T, "CELL_ROWS", 12)
    monkeypatch.setattr(T, "FAN", 3)

    def measured(plain):
        def build(*args):
            inner = plain(*args)

            def step(cells):
                with open(tmp_path / f"{os.getpid()}-{random.random()}", "w") as out:
                    out.write(str(len(cells)))
                return inner(cells)

            return step

        return build

    monkeypatch.setattr(T, "_compose_fn", measured(T._compose_fn))
    monkeypatch.setattr(T, "_enter_fn", measured(T._enter_fn))
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.7 else "b", rnd.randrange(4000), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t long, id long").repartition(2)
    got = {r["id"] for r in T.throttle(df, ["k"], "t", ["id"], 40, hot_rows=100, max_steps=0).collect()}
    want, last = set(), {}
    for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if k not in last or t > last[k] + 40:
            want.add(i)
            last[k] = t
    assert got == want
    sizes = [int((tmp_path / name).read_text()) for name in os.listdir(tmp_path)]
    assert max(sizes) == 3 and len(sizes) > 100
