import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tokenloom.session import get_spark
    s = get_spark("local[4]", app="tokenloom-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
    })
    # the shared checkpoint folder comes from the session (spark.checkpoint.dir);
    # tokenloom.session.checkpoint_dir makes a fresh one only when it is unset
    yield s
    s.stop()


def py_regex(pattern: str) -> str:
    """Java/RE2 ``\\x{HHHH}`` escapes -> Python ``\\uHHHH``."""
    import re
    return re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: "\\u" + m.group(1).rjust(4, "0"), pattern)
