import pytest

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text) with columns whose names clash with internal ones."""
    def build(rows):
        return spark.createDataFrame(
            [(i, t, "x", 1, 2, "g", 3, 4, [5], 6, "y", 7, 8, 9) for i, t in rows],
            "doc_id long, text string, node string, a int, component_id int, grp string, _d int, _t int, _ranges array<int>, "
            "_changed int, _text string, `dotted.name` int, _BAD_ID int, _gone int")
    return build
