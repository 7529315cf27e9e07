"""The registered queries against their SQL, and the pipeline stage by stage against plain Python."""

import os
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from checks.verify import connect, rows_of
from repopulse.llm import line_quality
from repopulse.llm import token_files as tf
from repopulse.llm.oracles import ORACLES
from repopulse.llm.queries import QUERIES
from repopulse.session import cut_lineage

from .test_operators import groups, words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    made = QUERIES[name](spark, SF)
    result = connect(SF).execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(made.columns)
    assert rows_of(made.columns, made.collect()) == rows_of(columns, result.fetchall())


def test_each_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, cut_lineage(stage(spark, docs, SF), "stage")
        left[name] = docs.collect()
        if name != "token ids":
            assert docs.schema == given.schema
    judged = line_quality.judge(spark.read.parquet(f"{SF}/documents.parquet"),
                                line_quality.fit_field(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r.doc_id for r in left["quality rules"]} == {r.doc_id for r in judged.where("kept").collect()}
    expected = {r.doc_id for r, g in zip(left["quality rules"], groups([(r.doc_id, r.text) for r in left["quality rules"]]), strict=True) if g[3]}
    assert {r.doc_id for r in left["near-dedup"]} == expected and len(left["near-dedup"]) == len(expected)
    items = [" ".join(words(r.text, True)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {r.doc_id for r in left["near-dedup"] if any(f" {i} " in f" {' '.join(words(r.text, True))} " for i in items)}
    clean = {r.doc_id for r in left["decontamination"]}
    assert clean <= expected - dirty and len(expected - dirty - clean) <= 2
    copies = Counter(r.doc_id for r in left["mixing"])
    assert set(copies) <= clean and max(copies.values()) <= 2
    texts, whole = {r.doc_id: r.text for r in left["mixing"]}, Tokenizer.from_file(tf.default_vocabulary())
    at = 0
    for r in sorted(left["token ids"], key=lambda r: r.start):
        ids = [*whole.encode(texts[r.doc_id], add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert Counter(r.doc_id for r in left["token ids"]) == copies


def test_entry_imports_without_the_optional_part(tmp_path):
    root = Path(__file__).resolve().parents[2]
    for name in ("__spark_entry__.py", "checks", "repopulse"):
        (tmp_path / name).symlink_to(root / name)
    code = "import __spark_entry__ as e; assert 'monthly_metrics' in e.queries() and 'pipeline' not in e.queries() and not any(q.startswith('op') for q in e.queries())"
    blocked = f"import sys; sys.modules['corpus_pipeline'] = None; {code}"
    subprocess.run([sys.executable, "-c", blocked], cwd=tmp_path, check=True)


def test_stages_on_odd_rows(spark):
    """Missing values, repeated rows, very long texts and columns of clashing names go through every stage, and no rows at all."""
    from . import odd

    more = [(500 + i, " ".join(f"own{i}w{k}" for k in range(80)), None, None if i % 2 else "s1", i, True, "c", "s", "b", "k", "z", "h", "t", "l") for i in range(6)]
    given = odd.frame(spark, [*odd.rows(), *more, more[0], (None, *more[1][1:])])
    for docs in (given, given.limit(0)):
        before = docs.collect()
        for name, stage in corpus_pipeline.STAGES:
            schema, docs = docs.schema, cut_lineage(stage(spark, docs, SF), "odd-stage")
            rows, left = docs.collect(), Counter(map(tuple, before))
            if name == "token ids":
                assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in before)
                continue
            assert docs.schema == schema
            most = 2 if name == "mixing" else 1
            assert all(n <= most * left[r] for r, n in Counter(map(tuple, rows)).items()), name
            if name == "quality rules":
                assert all(len(words(r.text)) >= 50 for r in rows)
            if name == "near-dedup":
                assert len({r.text for r in rows}) == len(rows) and {r.text for r in before} >= {r.text for r in rows}
            before = rows
        assert len(before) > 5 or docs.count() == 0
