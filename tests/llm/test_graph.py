import random

from tapemill.llm.graph import components


def brute_force(links):
    of = {}
    for a, b in links:
        of.setdefault(a, a), of.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            if (of[a], of[b]) != (low, low):
                of[a] = of[b] = low
                changed = True
    return of


def test_random_links_chains_and_stars(spark):
    random.seed(2)
    links = [(random.randint(0, 200), random.randint(0, 200)) for _ in range(120)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(100)] + [(5, 5), (7, 8), (7, 8)]
    frame = spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long")
    found = components(frame).collect()
    expected = brute_force([(a, b) for a, b in links if a != b])
    assert len(found) == len(expected)
    assert {row["id"]: row["component"] for row in found} == expected


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
