import random

import pytest

from tickloom.operators import signals


def greedy(closes, length=3, up=True):
    """Index of the last bar of each match, matching past the last row."""
    hits, i = [], 0
    while i + length <= len(closes):
        window = closes[i : i + length]
        steps = zip(window, window[1:])
        ok = all(a is not None and b is not None and (b > a if up else b < a) for a, b in steps)
        if ok:
            hits.append(i + length - 1)
            i += length
        else:
            i += 1
    return hits


def matched(df, length=3, up=True):
    rows = signals.run_matches(df, length, up).orderBy("time").collect()
    return [(r.time.day - 1) * 1440 + r.time.hour * 60 + r.time.minute for r in rows]


def test_ties_break_a_run(bars):
    df = bars({"A": list(enumerate([1.0, 2.0, 3.0, 4.0, 5.0, 5.0, 6.0, 7.0]))})
    assert matched(df) == [2, 7]


def test_nulls_break_a_run(bars):
    closes = [1.0, 2.0, None, 3.0, 4.0, 5.0]
    assert matched(bars({"A": list(enumerate(closes))})) == greedy(closes) == [5]


@pytest.mark.parametrize("up", [True, False])
@pytest.mark.parametrize("length", [3, 4])
def test_equals_greedy_matching_across_chunks(bars, up, length):
    rng = random.Random(length * 2 + up)
    closes = [None if rng.random() > 0.97 else float(rng.randint(1, 40)) for _ in range(3000)]
    # Sparse minutes put runs over day edges, some days holding a single bar.
    minutes = sorted(rng.sample(range(40000), 3000))
    df = bars({"A": list(zip(minutes, closes))})
    assert matched(df, length, up) == [minutes[i] for i in greedy(closes, length, up)]


def test_a_run_over_many_days(bars):
    minutes = [700 * i for i in range(60)]
    df = bars({"A": [(m, float(i)) for i, m in enumerate(minutes)]})
    assert matched(df) == minutes[2::3]


def test_spike_counts_its_own_bar_and_keeps_the_text(bars):
    quiet = bars({"A": [(i, 10.0) for i in range(9)]}, volume=1.0)
    burst = bars({"A": [(9, 11.0)]}, volume=100.0)
    (row,) = signals.volume_spikes(quiet.unionByName(burst)).collect()
    # 100 against the mean of nine ones and itself: 100 / 10.9
    assert (row.signal_type, row.side, row.price, row.detail) == (
        "VOLUME_SPIKE", "WATCH", 11.0, "volume gap 9.17x",
    )


def test_bars_stay_whole_per_symbol(bars):
    df = bars({"A": [(0, 1.0), (2, 2.0), (4, 3.0)], "B": [(1, 3.0), (3, 2.0), (5, 1.0)]})
    got = [(r.symbol, r.signal_type) for r in signals.signal_table(df).orderBy("symbol").collect()]
    assert got == [("A", "TREND_3UP"), ("B", "TREND_3DOWN")]
