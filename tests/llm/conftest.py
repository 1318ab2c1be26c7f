import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture()
def docs(spark):
    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long, sig string, key long, block int"):
        width = len(schema.split(","))
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)

    return make
