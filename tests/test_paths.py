import random

from pyspark.sql import functions as F

from tallystone.operators import paths
from tallystone.plans import registry

DIR = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
    return row[-1]


def test_fuzzy_match_is_brute_force(spark):
    r = random.Random(4)
    names = [("p" + str(r.randint(0, 1)), "".join(r.choice("abé") for _ in range(r.choice([0, 1, 2, 3, 5, 8, 13, 40])))) for _ in range(150)]
    wanted = [(p, "".join(c for c in n if r.random() > 0.1) + r.choice(["", "a", "xé"])) for p, n in names] + [("p0", "zzzzzz"), ("gone", "a"), ("p0", None), (None, "a")]
    out = paths.fuzzy_match(spark.createDataFrame(wanted, "parent string, db_name string"), spark.createDataFrame(names, "parent string, name string"))
    expect = set()
    for p, w in {x for x in wanted if None not in x}:
        best = min(((edits(w, n), n) for q, n in set(names) if q == p), default=(9, ""))
        if best[0] <= 2:
            expect.add((p, w, best[1], best[0]))
    found = [tuple(x) for x in out.select("parent", "db_name", "name", "distance").collect()]
    assert len(found) == len(set(found)) and set(found) == expect and {x[3] for x in expect} == {0, 1, 2}


def test_fuzzy_match_names_takes_every_length(spark):
    """The query leaves no ASCII name out: each finds one, as it lacks one character of its own name."""
    names = registry.disk_of(spark, DIR).where(~paths.non_ascii(F.col("name"))).select("parent", F.expr("substring(name, 2)").alias("db_name")).distinct()
    found = registry.QUERIES["fuzzy_match_names"](spark, DIR)
    assert found.count() == names.count()
    assert found.where("char_length(name) < 4").count() and found.where("char_length(name) > 9").count()
