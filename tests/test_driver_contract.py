"""The entry module works when loaded from another directory in a fresh
process, including queries whose Python code runs inside tasks."""
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(f"""
    import importlib.util
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spec = importlib.util.spec_from_file_location("entry_mod", "{ROOT}/__spark_entry__.py")
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    assert m.entry(spark).count() > 0
    from feedloom.plans.catalog import REGISTRY
    assert set(REGISTRY) <= set(m.queries()) and set(REGISTRY) <= set(m.oracle_sql()) <= set(m.queries())
    assert m.queries()["sheet_scan"](spark, "/root/testdata/sf0.001").count() > 0
    print("CONTRACT-OK")
""")


def test_entry_from_other_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "CONTRACT-OK" in out.stdout, out.stderr[-3000:]


def test_entry_without_the_optional_parts(tmp_path):
    """The optional subpackage and the pipeline can be taken away."""
    import shutil

    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    (tmp_path / "repo/feedloom/llm/__pycache__").mkdir(parents=True)      # what a deleted folder may leave behind
    (tmp_path / "repo/feedloom/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"")
    code = ("import __spark_entry__ as e; from feedloom.plans.catalog import REGISTRY; import bench; "
            "assert set(e.queries()) == set(REGISTRY) == set(e.oracle_sql()); print('WITHOUT-OK')")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=300)
    assert "WITHOUT-OK" in out.stdout, out.stderr[-3000:]
