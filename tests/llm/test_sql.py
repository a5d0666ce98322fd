"""Corpus queries against their SQL, on whole tables."""

import duckdb
import pytest

from cueloom.llm import queries, sql
from cueloom.llm.common import table
from cueloom.llm.decontaminate import drop_contaminated

TABLES = ("documents", "benchmark", "conversations", "embeddings")


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cursor = duck.execute(sql.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    result = queries.queries()[name](spark, sf_dir)
    assert sorted(result.columns) == sorted(names)
    assert sorted(map(tuple, result.select(*names).collect())) == sorted(cursor.fetchall())


def test_items_without_id_count_as_in_sql(spark, tmp_path):
    passage = " ".join(f"Word{i}" for i in range(15))
    docs = [(1, f"a {passage} b"), (2, "few WORDS here"), (3, f"few words {passage}"), (4, "clean"), (5, None), (6, "named one")]
    items = [(None, passage), (None, "few words"), (7, "named one"), (8, passage + " more"), (None, None), (None, "-")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    cursor = duck.execute(sql.oracle_sql()["op4_decontaminate"])
    names = [d[0] for d in cursor.description]
    expected = sorted(cursor.fetchall())
    found = queries.queries()["op4_decontaminate"](spark, str(tmp_path))
    assert sorted(map(tuple, found.select(*names).collect())) == expected
    assert [r[names.index("contaminated")] for r in expected] == [True, True, True, False, False, True]
    kept = drop_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), table(spark, str(tmp_path), "benchmark"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5]
