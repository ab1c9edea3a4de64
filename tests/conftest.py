import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import local_session

    s = local_session("tests", 4)
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def small():
    d = "/root/testdata/sf0.001"
    if not Path(d).exists():
        pytest.skip("the given tables aren't here")
    return d
