"""Connected components against a walk in memory."""

import random

from revloom.llm.components import components


def plain(edges):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for v in sorted(near):
        todo = [] if v in out else [v]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = v
                todo += near[x]
    return sorted(out.items())


def check(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    assert sorted(map(tuple, components(df).select("id", "root").collect())) == plain(edges)


def test_shapes(spark):
    draw = random.Random(3)
    names = list(range(-50, 250))
    draw.shuffle(names)
    chain = list(zip(names[:120], names[1:121], strict=True))
    star = [(names[150], n) for n in names[151:200]]
    random_pairs = [(draw.choice(names[200:]), draw.choice(names[200:])) for _ in range(60)]
    check(spark, chain + star + random_pairs + star[:5] + [(5000, 5000), (None, 7000), (7000, None)])


def test_no_edges(spark):
    check(spark, [(1, 1)])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
