import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricebars.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app="pricebars-tests")
    yield s


@pytest.fixture
def write_json(tmp_path):
    """Write JSON text files into a fresh folder and return the folder."""
    import json

    def _write(files: dict, sub="raw"):
        d = tmp_path / sub
        d.mkdir(exist_ok=True)
        for name, content in files.items():
            text = content if isinstance(content, str) else json.dumps(content)
            (d / name).write_text(text)
        return str(d)

    return _write
