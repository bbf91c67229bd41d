"""Texts that hold names, against every text and name; medians from counts."""

import random
import statistics
from collections import defaultdict

import duckdb
import pytest
from compare import same
from pyspark.sql import functions as F

from threadloom.operators import containment, dedup, drafts, reliability
from threadloom.plans import catalogue, views


@pytest.mark.parametrize("piece", [2, 5])
@pytest.mark.parametrize("any_case", [True, False])
def test_containing(spark, piece, any_case):
    rng = random.Random(piece)
    word = lambda most: "".join(rng.choices("abAB é", k=rng.randint(0, most)))
    texts = [(i, rng.choice([None, "s1", "s2"]), rng.choice([None, "", word(40), "license " * 9 + word(3)])) for i in range(300)] + [(7, "s1", "a second text of one key aab")]
    names = [(word(rng.choice([1, 3, 8])), rng.choice(["s1", "s2"])) for _ in range(120)] + [(None, "s1"), ("license", "s2"), ("license", "s2")]
    t, n = spark.createDataFrame(texts, "key long, at string, text string"), spark.createDataFrame(names, "name string, at string")
    fold = (lambda x: x.lower()) if any_case else (lambda x: x)
    for within in ([], ["at"]):
        want = {(k, m, *([a] if within else [])) for k, a, x in texts for m, b in names if x and m and fold(m) in fold(x) and (not within or a == b)}
        got = [tuple(r) for r in containment.containing(t, n, "key", "text", "name", within, any_case, piece).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert containment.containing(t, n.limit(0), "key", "text", "name").count() == 0
    assert containment.containing(t.limit(0), n, "key", "text", "name").count() == 0


def test_rules_by_project_is_project_rules_of_each(spark):
    rows = [(i, t, level, b) for i, (t, level, b) in enumerate([("x" * 150 + " Acme here", "other", "project_domain"), ("none", "acme-app", "project_domain"), ("none", "acm", "project_domain"), ("acme", None, "meta_user"), (None, " Acme ", "project_domain"), ("", "", "project_domain"), ("beta and ACME", "beta", "project_domain")])]
    rules = spark.createDataFrame(rows, "seq long, rule_text string, level string, bucket string")
    projects = ["Acme", "beta", " gamma", "", None]
    got = drafts.rules_by_project(rules, spark.createDataFrame([(p,) for p in projects], "project string")).collect()
    want = {(p, r["seq"]) for p in projects if p and p.strip() for r in drafts.project_rules(rules, p).collect()}
    assert {(r["project"], r["seq"]) for r in got} == want and len(got) == len(want) and ("Acme", 0) in want


def test_medians(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None, "hot", "hot"]), rng.choice([None, rng.randint(0, 9)]), rng.randint(0, 3)) for _ in range(901)] + [("none", None, 1)]
    frame = spark.createDataFrame(rows, "provider string, x long, y long").withColumn("turns", F.lit(1))
    per = defaultdict(lambda: ([], []))
    for p, x, y in rows:
        per[p][0].extend([] if x is None else [x])
        per[p][1].append(y)
    got = {r["provider"]: (r["x_median"], r["y_median"]) for r in reliability.medians(frame, "provider", ["x", "y"]).collect()}
    assert got == {p: (float(statistics.median(x)) if x else None, float(statistics.median(y))) for p, (x, y) in per.items()}
    plan = reliability.per_provider(frame, ["x", "y"])
    assert "median(" not in plan._jdf.queryExecution().optimizedPlan().toString() and plan.count() == len(per)


def test_pieces_of_long_texts_are_made_in_one_pass(spark):
    """A megabyte has a million pieces; cutting each from the text's start would take hours."""
    rng = random.Random(2)
    long = "".join(rng.choices("abcdefgh é", k=1_000_000))
    texts = spark.createDataFrame([(1, long), (2, "x" + long[-30:]), (3, None)], "key long, text string")
    names = spark.createDataFrame([(long[500_000:500_040],), (long[-20:],), ("zz",), ("a",)], "name string")
    got = {tuple(r) for r in containment.containing(texts, names, "key", "text", "name").collect()}
    assert got == {(k, n) for k, t in ((1, long), (2, "x" + long[-30:])) for n in (long[500_000:500_040], long[-20:], "zz", "a") if n in t}


def test_links_of_long_moves_carry_no_text(spark):
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh ", k=300_000)).strip()
    keys = spark.createDataFrame([(7, long), (8, long[1000:200_000].strip()), (9, "nothing that is in any other one")], "id long, key string")
    assert [tuple(r) for r in dedup.move_links(keys).collect()] == [(7, 8)]
    rows = [(long, "u", "gen", 2), (long[1000:200_000], "u", "gen", 5)]
    got = dedup.merge_moves(spark.createDataFrame(rows, "move string, owner string, level string, occurrences long")).collect()
    assert [(len(r["move"]), r["occurrences"], r["merged"]) for r in got] == [(len(long), 7, 2)]


def test_only_pieces_that_names_have_leave_the_tasks_that_cut_them(spark):
    texts = spark.createDataFrame([(i, "lorem ipsum dolor sit amet " * 50 + f"name{i:03d}") for i in range(100)], "key long, text string")
    own = containment.pieces(spark.createDataFrame([("name007",)], "low string"), "low", [5], ["low"], capped=True)
    held = containment.pieces(texts, "text", [5], ["key"], known=containment.known_pieces(own))
    assert own.count() == 3 and 3 <= held.where("key = 7").count() <= 4 and held.count() < 300


@pytest.mark.parametrize("most", [400, containment.HELD])
def test_naming_gives_each_row_each_name_once(spark, most):
    rng = random.Random(4)
    word = lambda most: "".join(rng.choices("abAB é", k=rng.randint(0, most)))
    texts = [(i // 2, rng.choice([None, "", word(40), word(400), "a" * 90 + word(9)])) for i in range(300)]
    names = sorted({word(rng.choice([1, 3, 8, 30])) for _ in range(150)} | {"a" * 70, "a" * 64, "license"}) + [None, "aab", "aab"]
    t, n = spark.createDataFrame(texts, "key long, text string"), spark.createDataFrame([(x,) for x in names], "name string")
    for fold, any_case in ((str, False), (str.lower, True)):
        want = sorted((k, m) for k, x in texts for m in {m for m in names if m} if x and fold(m) in fold(x))
        assert sorted(tuple(r) for r in containment.naming(t, n, ["key"], "text", "name", any_case, most=most).collect()) == want


def test_names_of_equal_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(containment._Hashes, "of", lambda self, start, length: start.astype("uint64") * 0)
    monkeypatch.setattr(containment._Hashes, "all", lambda self, size: self.sums[size:] * 0)
    known = containment._Names(containment.pa.chunked_array([["abc", "abd", "abcd", "b"]]))
    row, name = known.held(*(lambda b, e: (b, e[1:]))(*containment._binary(containment.pa.array(["xabdabd", "", "ab", "abcabcd"]))))
    assert sorted(zip(row.tolist(), name.tolist(), strict=True)) == [(0, 1), (0, 3), (2, 3), (3, 0), (3, 2), (3, 3)]


def repeated(duck, folder):
    """Documents and labels of which some come twice, as files, and a connection that reads them."""
    c = duck.cursor()
    c.execute(f"copy (select * from documents union all select * from documents where doc_id % 3 = 0) to '{folder}/documents.parquet'")
    c.execute(f"copy (select * from labels union all select * from labels where doc_id % 5 = 0) to '{folder}/labels.parquet'")
    own = duckdb.connect()
    for t in ("documents", "labels"):
        own.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return own


@pytest.mark.parametrize("name", ["rules_naming", "rules_by_project"])
def test_texts_and_what_they_hold_are_not_shuffled(spark, duck, sf, tmp_path, name):
    own = repeated(duck, tmp_path)
    found = catalogue.QUERIES[name](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and "HashAggregate" not in plan
    same(found, own.execute(catalogue.SQL[name]))


@pytest.mark.parametrize("domain", [True, False])
def test_rules_in_place_are_the_rules(spark, duck, sf, tmp_path, domain):
    repeated(duck, tmp_path)
    rows = [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (0, 2), (None, 0), (0, None), (None, None)]
    labels = spark.createDataFrame([(i, q, t) for i, (q, t) in enumerate(rows)] + [(1, 0, 0), (2, 0, 1), (0, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    texts = spark.createDataFrame([(i, f"text {i}", None, "s") for i in [*range(14), 3, 0, None]], "doc_id long, text string, lang string, source string")
    texts.coalesce(2).write.parquet(f"{tmp_path}/odd/documents.parquet")
    labels.write.parquet(f"{tmp_path}/odd/labels.parquet")
    for folder in (f"{tmp_path}/odd", str(tmp_path)):
        want = views.rules(spark, folder)
        want = (want.where("bucket = 'project_domain'") if domain else want).drop("bucket")
        got = views.rules_in_place(spark, folder, domain)
        assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("name", ["rules_naming", "rules_by_project"])
def test_texts_are_not_shuffled_for_labels_of_any_size(spark, sf, name):
    folder = f"{sf}/../sf0.01"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3k")
    try:
        assert "SortMergeJoin" in views.rules(spark, folder)._jdf.queryExecution().executedPlan().toString()
        plan = catalogue.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
