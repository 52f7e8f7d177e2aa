import os
import subprocess
import sys

import pytest

from wheelpace import session

_PROGRAM = """
import sys
from wheelpace.session import fresh_path, local_session, scratch, settle
folder = sys.argv[1]
spark = local_session("1", folder=folder or None)
try:
    with scratch(spark):
        print("rows", settle(spark.range(3), "t").count())
except ValueError as error:
    print("error", error)
"""


@pytest.mark.parametrize("given", [True, False])
def test_shared_folder_comes_from_the_session_only(tmp_path, given):
    """A process without any configuration of the installation."""
    folder = tmp_path / "shared"
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "none"), "PYTHONPATH": os.path.dirname(os.path.dirname(__file__))}
    out = subprocess.run([sys.executable, "-c", _PROGRAM, str(folder) if given else ""], env=env, capture_output=True,
                         text=True, timeout=120).stdout
    assert ("rows 3" in out) if given else ("error spark.checkpoint.dir is not set" in out)
    assert not given or not [p for p in os.listdir(folder) if p.startswith("t-")]


def test_only_handed_out_paths_can_be_deleted(spark, tmp_path):
    with pytest.raises(ValueError):
        session.discard(spark, str(tmp_path))
