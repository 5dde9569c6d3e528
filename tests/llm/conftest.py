from __future__ import annotations

import pytest

SF_MID = "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from blotter.session import build_session
    yield build_session("local[4]", shuffle_partitions=4)


def docs_of(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    full = [tuple(r) + (None,) * (len(schema.split(",")) - len(r)) for r in rows]
    return spark.createDataFrame(full, schema)
