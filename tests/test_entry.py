import os
import subprocess
import sys
import textwrap

import __spark_entry__ as entry


def test_registry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["folder", "qid", "rank", "Id", "score", "ExtractedSubject"]
    assert rows.count() > 0


def test_python_workers_find_the_package_from_another_folder(tmp_path):
    """As the driver does: the entry file is loaded by its path, without PYTHONPATH."""
    code = f"""
        import importlib.util, sys
        path = {os.path.abspath(entry.__file__)!r}
        spec = importlib.util.spec_from_file_location("__spark_entry__", path)
        e = importlib.util.module_from_spec(spec)
        sys.modules["__spark_entry__"] = e
        spec.loader.exec_module(e)
        from mailweave.session import local_session
        spark = local_session(2, partitions=2, memory="2g")
        print("ROWS", e.queries()["variants_generated"](spark, "/root/testdata/sf0.001").count())
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    assert "ROWS 80" in said.stdout, said.stderr[-2000:]
