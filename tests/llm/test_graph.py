import random

from tallyspark.llm.graph import components


def test_like_union_find(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 60)]
    rng.shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 80)]
    noise = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = chain + star + noise + [(5, 5), (None, 3), (3, None)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()))
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0
