import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from assayer.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", "assayer-tests", 4, "6g")
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return s


@pytest.fixture(scope="session")
def rows():
    def collect(df, *cols):
        d = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in d.collect()), key=repr)
    return collect
