import pytest
from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (id, text) pairs, with columns whose names operators use inside."""

    def build(rows, **extra):
        full = [(i, t, extra.get("lang"), "s", None if t is None else len(t)) for i, t in rows]
        frame = spark.createDataFrame(full, DOC_SCHEMA).repartition(3)
        for clash in ("id", "print", "word", "key", "class", "row", "n"):
            frame = frame.withColumn(clash, F.lit("clash"))
        return frame

    return build


@pytest.fixture(scope="session")
def piece_model():
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()
