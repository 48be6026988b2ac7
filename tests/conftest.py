import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from cellframe.session import local_session

    session = local_session("8", "tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """The worked 4 x 6 count table, plus a cell without counts."""
    counts = [[4, 0, 6, 0, 0, 0], [0, 2, 0, 2, 0, 1], [1, 1, 1, 1, 1, 15], [0, 0, 3, 0, 7, 0]]
    rows = [(f"c{i}", f"g{j}", float(v)) for i, line in enumerate(counts) for j, v in enumerate(line) if v]
    expr = spark.createDataFrame(rows, "cell_id string, gene_id string, value double")
    cells = spark.createDataFrame([(f"c{i}",) for i in range(4)], "cell_id string")
    genes = spark.createDataFrame([(f"g{j}",) for j in range(6)], "gene_id string")
    net = spark.createDataFrame(
        [("T", "g0", 1.0), ("T", "g2", 1.0), ("B", "g1", 1.0), ("B", "g3", 1.0)], "source string, target string, weight double"
    )
    return expr, cells, genes, net
