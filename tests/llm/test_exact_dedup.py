import hashlib
from collections import defaultdict

import pytest

from helpers import odd_rows, table
from incidentlab.llm.exact_dedup import tree_merge_dedup
from incidentlab.llm.textops import numbered, without_rows


def check(rows, got, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    for text, ids in groups.items():
        own = by[hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        best = None if not known else (max if keep == "max" else min)(known)
        assert sorted(map(str, (r.doc_id for r in own))) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in own} == {(best, len(ids))}
        kept = [r for r in own if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == best


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("partitions,fan_in", [(1, 8), (13, 2), (40, 8)])
def test_groups(spark, keep, partitions, fan_in):
    rows = odd_rows() + [(i, f"text {i % 7}" if i % 3 else "hot") for i in range(10, 400)]
    df = table(spark, rows).repartition(partitions)
    check(rows, tree_merge_dedup(df, keep, fan_in=fan_in).collect(), keep)


def test_empty_table(spark):
    assert tree_merge_dedup(table(spark, [])).count() == 0


def test_bad_keep(spark):
    with pytest.raises(ValueError):
        tree_merge_dedup(table(spark, []), keep="any")


def test_rows_that_stay(spark, tmp_path):
    rows = odd_rows()
    table(spark, rows).repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = without_rows(numbered(docs, "row"), tree_merge_dedup(docs).filter("not kept"), "row")
    assert out.columns == docs.columns
    assert out.count() == len({t or "" for _, t in rows})


def test_no_python_in_the_plan(spark):
    plan = tree_merge_dedup(table(spark, odd_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
