"""Every registered query of the library against its SQL; those without SQL against what must hold."""

import pytest
from compare import same

from threadloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_sql(name, spark, duck, sf):
    same(catalogue.QUERIES[name](spark, sf), duck.execute(catalogue.SQL[name]))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_louvain_covers_and_beats_components(spark, sf):
    from threadloom.operators import graph
    from threadloom.plans import views

    edges = graph.cochange(views.mention_events(spark, sf), min_weight=1).cache()
    found = graph.louvain(edges)
    nodes = {r["src"] for r in edges.select("src").collect()}
    assert {r["node"] for r in found.collect()} == nodes
    single = graph.components(edges).withColumnRenamed("component", "community")
    assert graph.modularity(edges, found).first()[0] >= graph.modularity(edges, single).first()[0] - 1e-9
    assert graph.community_labels(found).count() == found.select("community").distinct().count()


def test_pairs_are_symmetric(spark, sf):
    from threadloom.operators import graph
    from threadloom.plans import views

    w = {(r["src"], r["dst"]): r["weight"] for r in graph.co_mentions(views.mention_events(spark, sf)).collect()}
    assert w and all(w[b, a] == n for (a, b), n in w.items())


def test_sanitise_levels(spark, sf):
    from threadloom.operators import sanitize
    from threadloom.plans.catalogue_more import _profile

    p = _profile(spark, sf)
    names = {r["target_id"] for r in p["top_entities"].collect()}
    stripped = {r["target_id"] for r in sanitize.sanitise(p, "named_stripped")["top_entities"].collect()}
    assert len(stripped) == len(names) and not stripped & names
    assert set(sanitize.sanitise(p, "entities_removed")) == {"scale", "moves", "rules", "drifts", "provider_cognition"}
    assert sanitize.sanitise(p, "none").keys() == p.keys()
    with pytest.raises(ValueError):
        sanitize.sanitise(p, "half")
