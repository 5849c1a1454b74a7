import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ":".join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from quillspark.session import local

    s = local(4, 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
