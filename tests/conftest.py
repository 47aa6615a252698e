import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH", "")) if p)


@pytest.fixture(scope="session")
def spark():
    from spanloom.session import local_session, reachable

    session = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    reachable(session)
    yield session
    session.stop()
