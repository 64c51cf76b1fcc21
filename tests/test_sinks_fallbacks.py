import os

from railtrace.operators import extract as X
from railtrace.sinks.writers import write_table
from railtrace.sources import gtfs as G
from railtrace.sources.routes import read_extracted_routes
from tests.gtfs_fixture import write_feeds


def test_registry_beyond_broadcast_limit(spark, tmp_path, monkeypatch):
    """Above the size limit the registry is joined by shuffle, same result."""
    t = G.read_feeds(spark, G.feed_registry(spark, write_feeds(str(tmp_path / "feeds"))))
    expected = sorted(tuple(r) for r in X.extract_routes(t, "night").collect())
    monkeypatch.setattr(X, "MAX_BROADCAST_ROWS", 0)
    df = X.extract_routes(t, "night")  # no broadcast hint on the registry now
    assert sorted(tuple(r) for r in df.collect()) == expected


def test_single_file_csv(spark, tmp_path):
    t = G.read_feeds(spark, G.feed_registry(spark, write_feeds(str(tmp_path / "feeds"))))
    routes = X.extract_routes(t, "day")
    write_table(routes, str(tmp_path / "csv"), fmt="csv", single_file=True)
    parts = [f for f in os.listdir(tmp_path / "csv") if f.startswith("part-")]
    assert len(parts) == 1
    back = read_extracted_routes(spark, str(tmp_path / "csv"), fmt="csv")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in routes.collect())
