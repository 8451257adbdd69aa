from __future__ import annotations

import json
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline as pipeline

ROOT = Path(__file__).resolve().parents[2]


def test_stages_equal_their_operators(spark, sf_dir, tmp_path):
    from test_contamination import brute as matched
    from test_near_duplicates import brute as grouped

    from pricefold.llm.queries import table

    docs = table(spark, sf_dir, "documents")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        before = [(row.doc_id, row.text) for row in docs.collect()] if "text" in docs.columns else []
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = Counter(row.doc_id for row in docs.select("doc_id").collect())
        if name != "token_files":
            assert docs.columns == columns
        if name == "language":
            assert kept[name] == Counter(doc for doc, _ in before)
        if name == "near_duplicates":
            assert kept[name] == Counter(row[0] for row in grouped(before) if row[3])
        if name == "decontamination":
            items = [(row.item_id, row.text) for row in table(spark, sf_dir, "benchmark").collect()]
            assert kept[name] == Counter(row[0] for row in matched(before, items) if not row[-1])
        if name == "mixing":
            assert set(kept[name]) <= {doc for doc, _ in before} and max(kept[name].values()) <= 2
    assert kept["token_files"] == kept["mixing"]


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_documents_of_all_kinds(spark, odd_documents, sf_dir, tmp_path, monkeypatch, few):
    monkeypatch.setattr(pipeline, "_FEW", few)
    odd_documents.selectExpr("*", "1 as copies", "2 as identified", "3 as doc", "4 as place").write.parquet(str(tmp_path / "0"))
    docs = spark.read.parquet(str(tmp_path / "0"))
    for number, (name, stage) in enumerate(pipeline.STAGES, 1):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if name == "near_duplicates":
            texts = [row.text for row in docs.collect()]
            assert len(texts) == len(set(texts))
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_no_documents(spark, no_documents, sf_dir, tmp_path):
    docs = no_documents
    for number, (_, stage) in enumerate(pipeline.STAGES, 1):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
    assert docs.collect() == []


def test_the_rest_works_without_this_part(tmp_path):
    """With the folders gone, the entry still has all other queries."""
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    for name in ("workload", "pricefold"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    script = (
        "import sys, json; sys.path.insert(0, sys.argv[1]);"
        "import __spark_entry__ as e; print(json.dumps([sorted(e.queries()), [m for m in sys.modules if 'llm' in m]]))"
    )
    done = subprocess.run([sys.executable, "-c", script, str(tmp_path)], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    names, loaded = json.loads(done.stdout.splitlines()[-1])
    assert not loaded and "adjusted_days" in names and not any(name.startswith("op") and name[2:3].isdigit() for name in names)


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert all(sum(name.startswith(f"op{number}_") for name in names) == 1 for number in range(1, 14))
    assert "pipeline" in names and [name for name, _ in pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "token_files"
    ]


@pytest.mark.parametrize("name", ["near_duplicates", "decontamination", "mixing"])
def test_decisions_stay_with_their_rows_when_the_splits_change(spark, sf_dir, tmp_path, monkeypatch, name):
    """Fewer cores deal files to partitions in another way; here, from the first stored table on."""
    from pricefold.llm import common
    from pricefold.llm.queries import table

    stage, path, setting = dict(pipeline.STAGES)[name], str(tmp_path / "docs"), "spark.sql.files.minPartitionNum"
    table(spark, sf_dir, "documents").repartition(12, "doc_id").write.parquet(path)
    answers, counted = [], common.counted

    def then_fewer(*args, **kwargs):
        made = counted(*args, **kwargs)
        spark.conf.set(setting, "1")
        return made

    try:
        for change in (False, True):
            spark.conf.set(setting, "12")
            if change:
                monkeypatch.setattr(common, "counted", then_fewer)
                monkeypatch.setattr("pricefold.llm.near_duplicates.counted", then_fewer)
            answers.append(sorted(row.doc_id for row in stage(spark, spark.read.parquet(path), sf_dir).collect()))
    finally:
        spark.conf.unset(setting)
    assert answers[0] == answers[1]


def test_a_stage_frees_what_those_before_it_wrote(spark, sf_dir, tmp_path):
    from pricefold.llm.common import freed, gathered, stored

    folders: list[str] = []
    with gathered(folders):
        one, other = (stored(spark.range(n), "scratch") for n in (3, 4))
        assert len(folders) == 2 and one.count() == 3
    stored(spark.range(5), "not-gathered")
    assert len(folders) == 2
    freed(spark, folders, one)
    assert len(folders) == 1 and one.count() == 3 and not Path(other.inputFiles()[0].removeprefix("file://")).exists()
    freed(spark, folders, spark.range(1))
    assert folders == []
