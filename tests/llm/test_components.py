"""Components: each edge is followed once, however many rounds the longest path takes."""

from conftest import rows

from pairmill.llm import common


def test_edges_inside_a_component_are_not_read_again(spark, monkeypatch):
    edges = [(100, i) for i in range(1, 40)] + [(1, 50), (50, 2), (2, 51), (51, 3), (7, 7), (60, 61), (61, 60)]
    stored, keep = [], common.durable

    def watched(df, label):
        stored.append((df.columns, keep(df, label)))
        return stored[-1][1]

    monkeypatch.setattr(common, "durable", watched)
    found = common.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert rows(found) == sorted([(i, 1) for i in [*range(1, 40), 50, 51, 100]] + [(60, 60), (61, 60)])
    links = [table.count() for columns, table in stored if columns == ["a", "b"]]
    # In one direction, then what is left between components, until nothing is.
    assert links[0] == 44 and links == sorted(links, reverse=True) and links[-1] == 0


def test_long_paths_and_no_edges(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
    assert rows(common.components(path)) == [(i, 0) for i in range(41)]
    assert rows(common.components(path.where("a < 0"))) == []
