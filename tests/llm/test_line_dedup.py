from __future__ import annotations

from collections import Counter

from opsreport.llm.line_dedup import BLANK, drop_boilerplate


def plain(rows, ratio, least):
    """(host, text) rows the slow way."""
    pages = Counter(h for h, _ in rows if h is not None)
    seen: Counter = Counter()
    for h, t in rows:
        for line in {x.strip(BLANK) for x in (t or "").split("\n")} - {""}:
            seen[h, line] += 1
    bad = {k for k, n in seen.items() if k[0] is not None and n >= least and n > ratio * pages[k[0]]}
    return [
        None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(BLANK)) not in bad)
        for h, t in rows
    ]


def test_equals_the_plain_version(spark):
    rows = []
    for i in range(300):
        host = None if i % 50 == 7 else ("hot" if i % 3 else f"h{i % 20}")
        lines = [f"own {i}", "  menu ", "menu", "", f"of a third {i % 3}", f"rare {i % 40}"]
        rows.append((i, host, None if i % 41 == 0 else "\n".join(lines[i % 2 :])))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in drop_boilerplate(df, ratio=0.2, least_pages=3).collect()}
    assert [got[i] for i in range(300)] == plain([r[1:] for r in rows], 0.2, 3)
    plan = drop_boilerplate(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_small_hosts_keep_their_copies(spark):
    rows = [(i, "small", "same\ntext") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert {r.text for r in drop_boilerplate(df).collect()} == {"same\ntext"}


def test_a_text_of_boilerplate_alone_stays_empty(spark):
    rows = [(i, "a", "menu" if i < 9 else "own") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = drop_boilerplate(df, counts=True).collect()
    assert sorted((r.text, r.n_lines, r.n_dropped) for r in got) == [("", 1, 1)] * 9 + [("own", 1, 0)]


def test_edges(edges, nothing, clashing):
    rows = drop_boilerplate(edges, least_pages=2, ratio=0.3).collect()
    assert len(rows) == 10 and [r.text for r in rows if r.doc_id == 3] == [None]
    assert {r.text for r in rows if r.doc_id in (1, 2)} == {""}
    assert drop_boilerplate(nothing).count() == 0
    out = drop_boilerplate(clashing)
    assert out.columns == clashing.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, clashing.collect()))


def test_a_group_of_copies_is_one_page_of_the_pipeline(spark):
    import corpus_pipeline

    rows = [(i, "a", "copied one\ncopied two") for i in range(30)]
    rows += [(100 + i, "a", f"menu\nown {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, df, "").collect()}
    assert {got[i] for i in range(30)} == {"copied one\ncopied two"}
    assert all(got[100 + i] == f"own {i}" for i in range(30))
