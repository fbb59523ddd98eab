import pytest


@pytest.fixture(autouse=True)
def _quiet(spark):
    """The corpus operators write work tables below the session's checkpoint folder."""
    assert spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


@pytest.fixture()
def docs_of(spark):
    def make(texts, ids=None, **extra):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, *(v[k] for v in extra.values())) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        kinds = "".join(f", `{c}` {'long' if c == 'n_chars' else 'string'}" for c in extra)
        return spark.createDataFrame(rows, "doc_id long, text string" + kinds)

    return make
