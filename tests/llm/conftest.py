import sys
from pathlib import Path
from uuid import uuid4

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table."""
    def make(rows, parts=3):
        full = [(i, t, *(*rest, *("en", "s")[len(rest) :]), len(t or "")) for i, t, *rest in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)

    return make


@pytest.fixture
def stored(documents, tmp_path):
    """The same, written and read again."""
    def make(rows, parts=3):
        df = documents(rows, parts)
        path = str(tmp_path / uuid4().hex)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return make


@pytest.fixture
def replanned(spark, monkeypatch):
    """Makes a module's scans be split in another way after each step it stores, as on a
    cluster whose cores change."""
    names = ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    splits = [("1", "40"), ("0", "1")]

    def make(module):
        put, turn = module.store, []

        def store(df, name):
            made = put(df, name)
            turn.append(name)
            for key, value in zip(names, splits[len(turn) % 2], strict=True):
                spark.conf.set(key, value)
            return made

        monkeypatch.setattr(module, "store", store)

    yield make
    for key in names:
        spark.conf.unset(key)
