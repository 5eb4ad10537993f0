import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from posturn.session import build_session
    ckpt = tempfile.mkdtemp(prefix="posturn-test-ckpt-")
    s = build_session("local[4]", app_name="posturn-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    return con


def register_tables(con, sf_dir):
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split():
        p = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{p}')")
