"""Global rank and itineraries against brute force."""

import itertools
import random
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import rows
from skytally.operators import global_rank, itinerary_counts, best_itineraries, leg_union, legs
from skytally.operators.ranking import top_n, bottom_n


def test_global_rank_many_partitions(spark):
    rnd = random.Random(7)
    data = [(f"k{i:05d}", rnd.randint(1, 40)) for i in range(3000)]
    df = spark.createDataFrame(data, "id string, popularity long").repartition(13)
    ranked = global_rank(df, [F.col("popularity").desc(), F.col("id").asc()])
    got = sorted((r["rank"], r["id"], r["popularity"]) for r in ranked.collect())
    expected = sorted(data, key=lambda t: (-t[1], t[0]))
    assert got == [(i + 1, k, p) for i, (k, p) in enumerate(expected)]
    assert dict(ranked.dtypes)["rank"] == "bigint"


def test_top_and_bottom_n(spark):
    data = [("b", 5), ("a", 5), ("c", 1), ("d", 9), ("e", 1)]
    df = spark.createDataFrame(data, "id string, popularity long")
    assert [r["id"] for r in top_n(df, 3).collect()] == ["d", "a", "b"]
    assert [r["id"] for r in bottom_n(df, 3).collect()] == ["c", "e", "a"]


def _leg_lines(rnd, n, days=6, airports=("A", "B", "C", "D", "E"), hub="H"):
    out = []
    for i in range(n):
        # a third of the flights touch one hub airport
        o = hub if i % 3 == 0 else rnd.choice(airports)
        t = rnd.choice([a for a in airports + (hub,) if a != o])
        day = 1 + rnd.randrange(days)
        delay = rnd.choice([-5, 0, 3, 3, 12, 20, 45])
        out.append((f"2008-02-{27 + day - 1:02d}" if day <= 3 else f"2008-03-{day - 3:02d}", 1000 + i, o, t, delay))
    return out


def test_itineraries_equal_all_pairs(spark, lines_df):
    rnd = random.Random(3)
    flights = _leg_lines(rnd, 400)
    lines = [f"{d},{f},{o},{t},XX,0.00,{a}.00" for d, f, o, t, a in flights]
    df = lines_df(lines)

    import datetime as dt
    parsed = [(dt.date.fromisoformat(d), f, o, t, float(a)) for d, f, o, t, a in flights]
    pairs = defaultdict(list)
    for a, b in itertools.product(parsed, parsed):
        if a[3] == b[2] and b[0] == a[0] + dt.timedelta(days=2):
            pairs[(a[0], a[2], a[3], b[3])].append((a[4] + b[4], a[1], b[1]))
    exp_counts = sorted((k[0], k[1], k[2], k[3], len(v), min(x[0] for x in v)) for k, v in pairs.items())
    exp_best = sorted((k[0], k[1], k[2], k[3], min(v)[1], min(v)[2], min(v)[0]) for k, v in pairs.items())

    got_counts = rows(itinerary_counts(legs(df)), "flight_date", "x", "y", "z", "n", "best")
    got_best = rows(best_itineraries(legs(df)), "flight_date", "x", "y", "z", "flight1", "flight2", "total_delay")
    assert got_counts == exp_counts
    assert got_best == exp_best
    assert len(exp_best) > 20


def test_leap_day_connection(lines_df):
    lines = ["2008-02-28,1,A,B,X,0,1.00", "2008-03-01,2,B,C,X,0,2.00",   # leap year: Feb 28 + 2 = Mar 1
             "2008-02-27,3,A,B,X,0,1.00", "2008-02-29,4,B,C,X,0,2.00",
             "2007-02-28,5,A,B,X,0,1.00", "2007-03-01,6,B,C,X,0,2.00",   # not a leap year: Mar 1 is +1
             "2007-03-02,7,B,C,X,0,2.00"]
    got = rows(best_itineraries(legs(lines_df(lines))), "flight_date", "flight1", "flight2")
    assert [(str(d), f1, f2) for d, f1, f2 in got] == [
        ("2007-02-28", 5, 7), ("2008-02-27", 3, 4), ("2008-02-28", 1, 2)]
    u = rows(leg_union(legs(lines_df(["2008-03-01,2,B,C,X,0,2.00"]))), "d", "via", "leg")
    assert [(str(d), v, g) for d, v, g in u] == [("2008-02-28", "B", 2), ("2008-03-01", "C", 1)]


def test_hot_airport_third_of_rows(spark, lines_df):
    """One origin holds a third of all lines; results still equal brute force."""
    from collections import Counter

    from skytally.plans import queries as Q

    rnd = random.Random(21)
    airports = [f"A{i:02d}" for i in range(30)]
    carriers = [f"C{i:02d}" for i in range(40)]
    lines = []
    for i in range(6000):
        o = "HUB" if i % 3 == 0 else rnd.choice(airports)
        d = rnd.choice(airports)
        c = rnd.choice(carriers[:12]) if o == "HUB" else rnd.choice(carriers)  # many ties at the hub
        lines.append(f"{c},{o},{d},{rnd.choice([-3, 0, 5, 20])}.00,{rnd.choice([-1, 14, 15, 30])}.00")
    df = lines_df(lines).repartition(7)

    dep = Counter()
    ends = Counter()
    for line in lines:
        c, o, d, dd, ad = line.split(",")
        ends[o] += 1
        ends[d] += 1
        if float(dd) < 15:
            dep[(o, c)] += 1
    expected = []
    for o in {k[0] for k in dep}:
        items = sorted(((n, c) for (oo, c), n in dep.items() if oo == o), key=lambda t: (-t[0], t[1]))[:10]
        expected += [(o, c, n, r + 1) for r, (n, c) in enumerate(items)]
    assert rows(Q.top10_carriers_by_airport(df)) == sorted(expected)
    assert rows(Q.airport_popularity(df)) == sorted(ends.items())
    ranked = rows(Q.airports_ranked(df), "rank", "id", "popularity")
    assert [(i, p) for _, i, p in ranked] == sorted(ends.items(), key=lambda t: (-t[1], t[0]))


def test_ten_best_itineraries_against_all_pairs(lines_df):
    """Many flights per route and day, many ties, repeated lines and equal sums of different parts."""
    from collections import defaultdict

    from skytally.operators import top_itineraries
    from skytally.plans import queries as Q

    rnd = random.Random(8)
    lines = []
    for _ in range(900):
        o, t = rnd.sample("ABC", 2)
        lines.append(f"2008-01-{rnd.choice((1, 3, 5)):02d},{rnd.randrange(60)},{o},{t},X,0,{rnd.choice((-2, 0, 0.5, 1, 3, 7))}")
    lines += lines[:50] + ["2008-01-01,1,A,D,X,0,1.00", "2008-01-03,2,D,E,X,0,1.00"]
    flights = sorted({(x[0], int(x[1]), x[2], x[3], float(x[6])) for x in (line.split(",") for line in lines)})
    pairs = defaultdict(list)
    for d, f1, x, y, a in flights:
        for d2, f2, y2, z, b in flights:
            if y == y2 and int(d2[-2:]) == int(d[-2:]) + 2:
                pairs[d, x, y, z].append((a + b, a, f1, b, f2))
    for k in (1, 10, 13):
        want = sorted((*key, rank + 1, f1, f2, a, b, total) for key, own in pairs.items()
                      for rank, (total, a, f1, b, f2) in enumerate(sorted(own)[:k]))
        got = top_itineraries(legs(lines_df(lines).repartition(5)), k).collect()
        assert sorted((str(r["flight_date"]), *list(r)[1:]) for r in got) == want
    assert max(len(own) for own in pairs.values()) > 1000
    best = rows(Q.itinerary_top10(lines_df(lines)).where("rank = 1").drop("rank"))
    assert best == rows(best_itineraries(legs(lines_df(lines))))
