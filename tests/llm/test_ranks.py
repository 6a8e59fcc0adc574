"""Ranks in a total order against Python's sort."""

from __future__ import annotations

from mailgauge.llm.ranks import ranked


def key(value):
    return (value is not None, value if value is not None else 0)


def test_ranks_of_groups_and_crowded_values(spark):
    rows = [(g, v, i) for i in range(300) for g, v in [(None if i % 5 == 0 else f"g{i % 3}", None if i % 7 == 0 else i % 4)]]
    rows += [("hot", 1, -1)] * 200  # equal in every column
    frame = spark.createDataFrame(rows, "g string, v long, i long").repartition(7)
    out = ranked(frame, ["g"], ["v", "i"]).collect()
    assert sorted(map(key, (r.i for r in out))) == sorted(map(key, (i for _, _, i in rows)))
    for group in {g for g, _, _ in rows}:
        found = sorted((r for r in out if r.g == group), key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(len(found)))
        assert {r.size for r in found} == {len(found)}
        expected = sorted(((v, i) for g, v, i in rows if g == group), key=lambda p: (key(p[0]), key(p[1])))
        assert [(r.v, r.i) for r in found] == expected


def test_one_group_and_no_rows(spark):
    frame = spark.range(50).selectExpr("50 - id AS n")
    out = ranked(frame, [], ["n"])
    assert sorted((r.rank, r.n, r.size) for r in out.collect()) == [(i, i + 1, 50) for i in range(50)]
    assert ranked(frame.filter("false"), [], ["n"]).count() == 0
    assert out.columns == ["n", "rank", "size"]
