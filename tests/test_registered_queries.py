"""Every registered query against its SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from checks import compare, ingest_checks, registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


def test_entry_and_registry_agree(spark):
    assert __spark_entry__.entry(spark).count() > 0
    named = {name: sql for name, (_, sql) in registry.ALL.items()}
    assert all(named.values())
    assert set(named) <= set(__spark_entry__.queries())
    assert named.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("missing", ["stridelake.llm", "sentencepiece", "public_tokenizers"])
def test_entry_loads_without_the_queries_for_training_data(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; "
            "from checks import registry; assert set(e.queries()) == set(registry.ALL)")
    root = Path(__spark_entry__.__file__).parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("name", sorted(registry.ALL))
def test_query_matches_sql(spark, con, name):
    query, sql = registry.ALL[name]
    assert compare.difference(query(spark, SF_DIR), con, sql) == ""


def test_files_without_a_start_reach_the_device_operator(spark, monkeypatch):
    seen = []
    to_activity = ingest_checks.normalize.to_activity
    monkeypatch.setattr(
        ingest_checks.normalize, "to_activity", lambda raw: seen.append(raw) or to_activity(raw))
    ingest_checks._device_activities(spark, SF_DIR)
    assert seen[0].where("session.start_time IS NULL").count() > 0
