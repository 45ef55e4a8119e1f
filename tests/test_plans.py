"""What the registered queries ask of the cluster."""

import os

import pytest

from __spark_entry__ import queries
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")

# Narrow jobs: all work on a row happens where the row is read. The tables of the smallest scale
# come in one small file each, so no spreading shuffle is added either.
NARROW = ["chunk_recursive", "chunk_offsets", "chunk_tokens", "chunk_semantic", "sentences",
          "chunk_ids", "embed_hashed", "embed_model", "page_content", "page_markdown", "page_links",
          "links_resolved", "page_output_path", "embed_valid_only"]


def test_no_query_pairs_rows_without_a_key(spark):
    for name, query in queries().items():
        plan = plan_of(query(spark, SF_DIR))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


@pytest.mark.parametrize("name", NARROW)
def test_narrow_jobs_do_not_shuffle(spark, name, monkeypatch):
    from docpipe import session

    monkeypatch.setattr(session, "SPREAD_BYTES", 1 << 40)
    assert "Exchange" not in plan_of(queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name, columns", [
    ("page_output_path", "page_id:bigint,url:string"),
    ("chunk_recursive", "doc_id:bigint,text:string"),
    ("embed_valid_only", "vec_id:bigint,label:int"),
])
def test_scans_read_only_what_they_need(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan_of(queries()[name](spark, SF_DIR))


def test_page_filter_reaches_the_scan(spark):
    assert "PushedFilters: [IsNotNull(html), Not(EqualTo(html,))]" in plan_of(
        queries()["page_markdown"](spark, SF_DIR))


def test_costly_columns_are_computed_once(spark):
    assert plan_of(queries()["embed_hashed"](spark, SF_DIR)).count("crc32") == 1
    plan = plan_of(queries()["page_markdown"](spark, SF_DIR))
    assert plan.count("td-main") == 1
    # A sentence's words are hashed once, not again for each of its words.
    assert plan_of(queries()["chunk_semantic"](spark, SF_DIR)).count("crc32") == 1


def test_small_inputs_are_spread_and_large_ones_left_alone(spark):
    from docpipe.session import spread

    wide = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert spread(wide.repartition(64), "doc_id").rdd.getNumPartitions() == 64
