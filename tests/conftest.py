import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from palaver.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(shuffle_partitions=4, app="palaver-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def hot_messages(spark):
    """A small message table in which one conversation holds a third of all rows."""
    rows = []
    for turn in range(60):
        role = "system" if turn == 0 else ("user" if turn % 2 else "assistant")
        rows.append((7, turn, role, "x" * (turn % 9) + "é😀"[: turn % 3]))
    rows += [(1, 0, "user", "only a question")]
    rows += [(2, 0, "user", "no system"), (2, 1, "assistant", "fine"), (2, 2, "user", "trailing")]
    rows += [(3, 0, "system", "s"), (3, 1, "assistant", ""), (3, 2, "assistant", "two in a row")]
    for conv in range(10, 40):
        for turn in range(4):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], f"{conv}-{turn} " * turn))
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


@pytest.fixture(scope="session")
def by_conversation(hot_messages):
    """The same table as Python lists, for brute-force expectations."""
    out = {}
    for r in sorted(hot_messages.collect(), key=lambda r: (r.conv_id, r.turn)):
        out.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    return out
