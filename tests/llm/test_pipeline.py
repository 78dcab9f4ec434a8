import hashlib
import importlib.util
import shutil
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest

import corpus_pipeline as C
from emporia.llm import decontam, pii, quality
from emporia.llm import queries as Q
from tests.llm.test_decontam import brute as brute_leaks
from tests.llm.test_simhash import brute_components, brute_fingerprint

ROOT = Path(C.__file__).resolve().parent
SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = {i: t for (i, t), y in zip(rows, model.score(pa.array([t for _, t in rows], pa.string())), strict=True)
            if y >= 0.5}
    assert 0 < len(kept) < len(rows)
    label = brute_components({i: brute_fingerprint(t or "") for i, t in kept.items()})
    kept = {i: t for i, t in kept.items() if label[i] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {i for i, _ in brute_leaks(bench, [*kept.items()])}
    kept = {i: pii.replace(t or "", Q.PII_KEY)[0] for i, t in kept.items() if i not in leaks}
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(Q.word_bpe_path())
    got = {r.doc_id: r for r in C.run(spark, SF).collect()}
    assert leaks and set(got) == set(kept)
    for i, t in kept.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded_sha256 == hashlib.sha256(
            library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_odd_rows_and_columns(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "bigint(1) as n_chars")
    clash = docs.selectExpr("*", "'old' as __score", "'old' as ids", "'old' as n_tokens", "'old' as items")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, clash, SF)
        assert out.columns == clash.columns, name
        assert all(r.ids == "old" for r in out.collect())
        assert stage(spark, clash.where("false"), SF).count() == 0
    assert C.STAGES[-1][1](spark, clash, SF).count() == 12
    assert C.decontamination_stage(spark, docs, SF).count() == 12


def test_entry_works_without_the_subpackage(tmp_path):
    for p in ("emporia", "__spark_entry__.py"):
        src = ROOT / p
        if src.is_dir():
            shutil.copytree(src, tmp_path / p, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / p)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'revenue_by_category' in q and 'pipeline' not in q"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)
    spec = importlib.util.spec_from_file_location("entry", ROOT / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" in names and "op4_licenses" in entry.oracle_sql()


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "emporia").rglob("*.py"):
        if "llm" not in p.parts:
            assert "emporia.llm" not in p.read_text()


def test_leaks_and_benchmark_of_the_tables(spark):
    found = {tuple(r) for r in Q.QUERIES["op9_decontam"](spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert found == brute_leaks(bench, rows)
    assert decontam.THRESHOLD < decontam.QUESTION
